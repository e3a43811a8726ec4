"""Queries for streams over stored tables, atomic refresh, file listings, clustering, port counts, QUALIFY, table
functions, rule groups, single-file limits, names and SQL sources, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from medallion.functions.columns import AGE_BRACKETS, AGE_ELSE, SENIORITY_BRACKETS, SENIORITY_ELSE
from medallion.operators import cdc, quality
from medallion.operators.aggregate import aggregate
from medallion.operators.filter import all_except, limited
from medallion.operators.forecast import seasonal_forecast
from medallion.operators.prepare import prepare
from medallion.operators.sqlnode import qualify, run_sql
from medallion.operators.unique import unique
from medallion.plans.driver import SCD2_SQL, flat_history, register, tbl
from medallion.plans.graph import Counts, Node, run_graph
from medallion.plans.hr_driver import _sql, run_hr
from medallion.plans.streams import (_ENTITY_SQL, EVENT_COLS, EVENT_RULES, EVENTS, MIN_VALUE, events_silver, land_events)
from medallion.session import work_dir
from medallion.sinks import export
from medallion.sinks.tables import Table
from medallion.sources.files import file_listing, read_json_stream
from medallion.sources.tables import FlowSpec, table_source
from medallion.streaming.flows import Pipeline, View
from medallion.streaming.tables import StreamedTable


# ---------------------------------------------------------------------------------------- history
@register("scd2_text_sequence", SCD2_SQL)
def q_scd2_text_sequence(spark, sf):
    """A sequence of text, whose order is that of the times it names."""
    e = tbl(spark, sf, "events")
    moment = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lpad(F.col("event_id").cast("string"), 19, "0"))
    h = cdc.scd2(e.withColumn("moment", moment), ["user_id"], ["moment"], ["event_type"])
    times = [F.struct(F.substring(c + ".moment", 1, 26).cast("timestamp_ntz").alias("ts"),
                      F.substring(c + ".moment", 27, 19).cast("long").alias("event_id")) for c in (cdc.START_AT, cdc.END_AT)]
    end = F.when(F.col(cdc.END_AT).isNotNull(), times[1])
    return flat_history(h.drop("moment").withColumns({cdc.START_AT: times[0], cdc.END_AT: end}))


# ---------------------------------------------------------------------------------------- streams
def streamed_events(spark, sf) -> tuple[StreamedTable, StreamedTable, list[dict]]:
    """Bronze filled by two flows, silver by streams over bronze, in two runs: the first between bronze's runs, the
    second after both; the counts of silver's rules."""
    root = work_dir(spark, "streamed")
    bronze, silver, counts = StreamedTable(spark, f"{root}/bronze"), StreamedTable(spark, f"{root}/silver"), []
    for phase in (1, 2):
        land_events(spark, sf, f"{root}/landing", phase)
        for flow in ("A", "B"):
            bronze.append(flow, read_json_stream(spark, f"{root}/landing/entity={flow}/*", flow, f"{root}/schema/{flow}"))
        for flow in bronze.flows():
            counts.append(silver.append(flow, events_silver(bronze.stream(flow)), EVENT_RULES))
    return bronze, silver, counts


@register("stream_from_table", f"""
SELECT event_id, ts, user_id, event_type, value, props, {_ENTITY_SQL} AS source_entity
FROM events WHERE value >= {MIN_VALUE}
""")
def q_stream_from_table(spark, sf):
    """Silver as a stream over the stored bronze table, with a checkpoint of its own, over two runs."""
    return streamed_events(spark, sf)[1].read().select(*EVENT_COLS, "source_entity")


@register("stream_refresh_reader", f"""
SELECT 'before' AS moment, COUNT(*) AS rows FROM events WHERE value >= {MIN_VALUE} AND ts >= TIMESTAMP '2024-01-16'
UNION ALL SELECT 'during', COUNT(*) FROM events WHERE value >= {MIN_VALUE} AND ts >= TIMESTAMP '2024-01-16'
UNION ALL SELECT 'after', COUNT(*) FROM events WHERE value >= {MIN_VALUE}
""")
def q_stream_refresh_reader(spark, sf):
    """What another reader of silver sees before, during and after a full refresh that brings more files."""
    root = work_dir(spark, "refresh-reader")
    flows = [FlowSpec(e, f"{root}/landing/entity={e}/*") for e in ("A", "B")]
    reader, seen = Pipeline(spark, root), {}

    def look(moment):
        seen[moment] = reader.catalog.read("silver_events").agg(F.lit(moment).alias("moment"), F.count("*").alias("rows"))

    p = Pipeline(spark, root)
    land_events(spark, sf, f"{root}/landing", 1)
    p.run([(EVENTS, flows)])
    look("before")
    land_events(spark, sf, f"{root}/landing", 2)
    p.full_refresh([(EVENTS, flows)], {"silver_rows": lambda work: look("during") or work.catalog.read("silver_events")})
    look("after")
    return seen["before"].unionByName(seen["during"]).unionByName(seen["after"])


@register("views_by_declaration", """
WITH m AS (SELECT o_custkey, COUNT(*) AS n, SUM(o_totalprice) AS total FROM orders GROUP BY o_custkey)
SELECT c_mktsegment, COUNT(*) AS customers, CAST(SUM(n) AS BIGINT) AS orders, ROUND(SUM(total), 2) AS total
FROM m JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
""")
def q_views_by_declaration(spark, sf):
    """Views given in no order, refreshed in the one that their declared tables ask for."""
    p = Pipeline(spark, work_dir(spark, "declared"))
    p.run([], {
        "by_segment": View(("with_segment",), lambda rows: rows.groupBy("c_mktsegment").agg(
            F.count("*").alias("customers"), F.sum("n").alias("orders"), F.round(F.sum("total"), 2).alias("total"))),
        "with_segment": View(("by_customer", "customers"), lambda sums, customers: sums.join(
            customers, F.col("o_custkey") == F.col("c_custkey"))),
        "by_customer": lambda work: tbl(spark, sf, "orders").groupBy("o_custkey").agg(
            F.count("*").alias("n"), F.sum("o_totalprice").alias("total")),
        "customers": lambda work: tbl(spark, sf, "customer"),
    })
    return p.catalog.read("by_segment")


# ---------------------------------------------------------------------------------------- files
@register("table_files", """
SELECT o_orderpriority, CAST(o_orderkey % 4 AS INTEGER) AS part, COUNT(*) AS rows, true AS has_bytes
FROM orders GROUP BY o_orderpriority, o_orderkey % 4
""")
def q_table_files(spark, sf):
    """Rows and bytes of every file of a table that four tasks wrote into folders by priority."""
    part = F.pmod(F.col("o_orderkey"), F.lit(4)).cast("int")
    path = work_dir(spark, "files") + "/orders"
    tbl(spark, sf, "orders").withColumn("part", part).repartitionById(4, F.col("part")) \
        .write.partitionBy("o_orderpriority").parquet(path)
    files = file_listing(spark.read.parquet(path), F.min("o_orderpriority").alias("o_orderpriority"), F.min("part").alias("part"),
                         F.count_distinct("o_orderpriority", "part").alias("kinds"))
    return files.where("kinds = 1").select("o_orderpriority", "part", "rows", (F.col("file_size") > 0).alias("has_bytes"))


@register("clustered_read", """
SELECT COUNT(*) AS rows, true AS fewer_files, true AS same_rows FROM orders
WHERE o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '1995-04-01'
""")
def q_clustered_read(spark, sf):
    """K6: a table clustered by date and a copy that isn't: files whose statistics meet a filter, and the rows found."""
    orders, root = tbl(spark, sf, "orders").repartition(16), work_dir(spark, "clustered")
    in_spring = (F.col("o_orderdate") >= "1995-01-01") & (F.col("o_orderdate") < "1995-04-01")
    out = []
    for name, cluster in (("clustered", ["o_orderdate"]), ("plain", None)):
        t = Table(spark, f"{root}/{name}", cluster_by=cluster, cluster_files=16)
        t.overwrite(orders)
        spans = file_listing(t.read(), F.min("o_orderdate").alias("low"), F.max("o_orderdate").alias("high"))
        met = spans.agg(F.count_if((F.col("high") >= "1995-01-01") & (F.col("low") < "1995-04-01")).alias("met"),
                        F.count("*").alias("files"))
        out.append(met.join(F.broadcast(t.read().where(in_spring).agg(F.count("*").alias("rows"))), F.col("files") > 0))
    one, other = out
    return one.join(F.broadcast(other.select(F.col("rows").alias("other"), F.col("met").alias("all_met"),
                                             F.col("files").alias("all_files"))), F.col("all_files") > 0) \
        .select("rows", ((F.col("met") / F.col("files") < 0.5) & (F.col("all_met") == F.col("all_files"))).alias("fewer_files"),
                (F.col("rows") == F.col("other")).alias("same_rows"))


# ---------------------------------------------------------------------------------------- nodes
@register("node_counts_observed", """
SELECT 'f' AS node, 'filtered_data' AS port, COUNT(*) AS rows FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'f', 'excluded_data', COUNT(*) FROM orders WHERE NOT coalesce(o_orderstatus = 'F', false)
UNION ALL SELECT 'a', 'aggregated_data', COUNT(DISTINCT o_custkey) FROM orders WHERE o_orderstatus = 'F'
""")
def q_node_counts_observed(spark, sf):
    """The rows of all ports, excluded ones too, observed on the one pass of the sink's job."""
    counts = Counts()
    run_graph(spark, [
        Node("s", "source", {"dataframe": tbl(spark, sf, "orders")}),
        Node("f", "filter", {"condition": "o_orderstatus = 'F'"}, {"data": "s.data"}),
        Node("a", "aggregate", {"group_bys": ["o_custkey"], "aggregations": [
            {"columnExpr": {"expr": "*"}, "fn": "COUNT", "alias": "n"}]}, {"data": "f.filtered_data"}),
        Node("o", "output", {"sink": lambda df: df.write.format("noop").mode("overwrite").save()}, {"data": "a.aggregated_data"}),
    ], counts=counts)
    return spark.createDataFrame(counts.rows(), "node string, port string, rows long")


@register("sql_qualify", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1
""")
def q_sql_qualify(spark, sf):
    """QUALIFY on a column that is not selected, within a common table expression's reader."""
    return run_sql(spark, """
        WITH some AS (SELECT * FROM ord WHERE o_orderstatus <> :open)
        SELECT o_custkey, o_orderkey, o_totalprice FROM some -- the newest order of each customer
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1
        ORDER BY o_custkey""", {"ord": tbl(spark, sf, "orders")}, {"open": "P"})


@register("qualify_rank", """
SELECT o_orderkey, o_orderpriority FROM orders
QUALIFY rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) <= 3
""")
def q_qualify_rank(spark, sf):
    """W5 as an operator: a window condition on a frame; ranked limits are applied in every task before the shuffle."""
    return qualify(tbl(spark, sf, "orders"), "rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, "
                   "o_orderkey) <= 3").select("o_orderkey", "o_orderpriority")


@register("forecast_by_segment", """
WITH m AS (SELECT c_mktsegment, (year(o_orderdate) * 12 + month(o_orderdate)) AS step, COUNT(*) AS v
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
e AS (SELECT c_mktsegment, max(step) AS last FROM m GROUP BY 1),
f AS (SELECT c_mktsegment, last + unnest(range(1, 13)) AS step FROM e)
SELECT f.c_mktsegment, CAST(f.step AS BIGINT) AS step, avg(m.v) AS forecast
FROM f LEFT JOIN m ON m.c_mktsegment = f.c_mktsegment AND m.step % 12 = f.step % 12 GROUP BY 1, 2
""")
def q_forecast_by_segment(spark, sf):
    """Next year's monthly orders of each market segment by a table function over a partitioned table."""
    joined = tbl(spark, sf, "orders").join(tbl(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    monthly = joined.groupBy("c_mktsegment", (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("step")) \
        .agg(F.count("*").alias("v"))
    return seasonal_forecast(spark, monthly, "c_mktsegment", "step", "v", 12, 12)


@register("concat_in_order", """
SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ' | ' ORDER BY o_orderkey) AS orders FROM orders GROUP BY o_custkey
""")
def q_concat_in_order(spark, sf):
    """CONCAT in the order of the values, numbers by number."""
    return aggregate(tbl(spark, sf, "orders"), ["o_custkey"], [
        {"columnExpr": {"expr": "o_orderkey"}, "fn": "CONCAT", "alias": "orders", "separator": " | ", "order": True}])


@register("star_except_limit", """
SELECT * EXCLUDE (o_orderpriority, o_orderstatus) FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
""")
def q_star_except_limit(spark, sf):
    """All columns but two (any letter case), the first hundred rows of an order."""
    return limited(all_except(tbl(spark, sf, "orders"), ["O_OrderPriority", "o_orderstatus"]), 100,
                   ["o_totalprice DESC", "o_orderkey"])


@register("sql_expression_source", """
SELECT o_orderpriority, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus = 'O' GROUP BY 1
""")
def q_sql_expression_source(spark, sf):
    """A source node whose table is SQL text."""
    tbl(spark, sf, "orders").createOrReplaceTempView("orders_of_source")
    rows = table_source(spark, "SELECT * FROM orders_of_source WHERE o_orderstatus = 'O'", is_expression=True)
    return rows.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


# ---------------------------------------------------------------------------------------- rules
@register("quality_rule_groups", """
SELECT rule, action, CAST(failed AS BIGINT) AS failed, CAST(n - failed AS BIGINT) AS passed FROM
  (SELECT COUNT(*) AS n, COUNT(*) FILTER (o_totalprice <= 1000) AS a, COUNT(*) FILTER (o_orderdate < DATE '1992-06-01') AS b,
          COUNT(*) FILTER (o_custkey IS NULL) AS c, COUNT(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS d FROM orders) x,
  (VALUES ('worth', 'drop', 1), ('recent', 'drop', 2), ('o_custkey_not_null', 'drop', 3),
          ('o_orderstatus_accepted_values', 'warn', 4)) AS r(rule, action, i),
  LATERAL (SELECT CASE i WHEN 1 THEN a WHEN 2 THEN b WHEN 3 THEN c ELSE d END AS failed)
""")
def q_quality_rule_groups(spark, sf):
    """Q4, Q6: a group of rules with one action and two guardrails, counted in one pass."""
    rules = quality.expect_all({"worth": "o_totalprice > 1000", "recent": "o_orderdate >= DATE '1992-06-01'"}, "drop")
    rules += [quality.not_null("o_custkey"), quality.accepted_values("o_orderstatus", ["F", "O"])]
    return quality.apply_expectations(tbl(spark, sf, "orders"), rules, "orders").metrics.drop("dataset")


# ---------------------------------------------------------------------------------------- exports and names
@register("export_limits", """
SELECT c_mktsegment, COUNT(*) AS rows, 'refused' AS bad_name, 'refused' AS too_many FROM customer GROUP BY c_mktsegment
""")
def q_export_limits(spark, sf):
    """A one-file export within its limits, a row limit that refuses, and a name that leaves its folder."""
    c, path = tbl(spark, sf, "customer"), work_dir(spark, "export") + "/one"

    def outcome(action) -> str:
        try:
            action()
            return "accepted"
        except ValueError:
            return "refused"

    export.export_csv(c, f"{path}/{export.validate_name('customers')}", single_file=True)
    back = spark.read.option("header", "true").csv(f"{path}/customers")
    bad_name = outcome(lambda: export.validate_name("../customers"))
    too_many = outcome(lambda: export.check_single_file_limits(c, max_rows=10))
    return back.groupBy("c_mktsegment").agg(F.count("*").alias("rows"), F.lit(bad_name).alias("bad_name"),
                                            F.lit(too_many).alias("too_many"))


@register("prepare_exact_names", """
SELECT c_custkey AS "cust.key", upper(c_mktsegment) AS "market`segment", coalesce(c_mktsegment, 'none') AS "a b" FROM customer
""")
def q_prepare_exact_names(spark, sf):
    """Steps on columns whose names hold dots, backticks and blanks."""
    c = tbl(spark, sf, "customer").select(F.col("c_custkey").alias("cust.key"), F.col("c_mktsegment").alias("market`segment"),
                                          F.col("c_mktsegment").alias("a b"))
    return prepare(c, [{"type": "text_case", "column": "market`segment", "case": "upper"},
                       {"type": "fill_null", "column": "a b", "with": "none"}])


# ---------------------------------------------------------------------------------------- the HR application, whole rows
def _bracket_sql(value: str, bounds: list[tuple], rest: str) -> str:
    return "CASE " + " ".join(f"WHEN {value} < {b} THEN '{name}'" for b, name in bounds) + f" ELSE '{rest}' END"


@register("hr_silver_employees", _sql(f"""
SELECT e.source_entity, e.employee_id, CAST(e.extract_ts AS DATE) AS extract_date, e.extract_ts, e.updated_at,
       c.c_name AS first_name, c.c_mktsegment AS last_name, e.gender, e.birth_date, e.age, e.hire_date,
       CAST(e.seniority_years AS DOUBLE) AS seniority_years, e.job_title, e.contract_type,
       'Site ' || c.c_nationkey AS work_location, CAST(NULL AS VARCHAR) AS manager_id,
       lower('EMP' || c.c_custkey || '@Example.com') AS email, CASE WHEN c.c_custkey % 3 = 0 THEN 0.8 ELSE 1.0 END::DOUBLE AS fte,
       e.status, e.department_id, e.department_name, e.business_unit, e.region, d.country, d.cost_center,
       {_bracket_sql("e.age", AGE_BRACKETS, AGE_ELSE)} AS age_bracket,
       {_bracket_sql("e.seniority_years", SENIORITY_BRACKETS, SENIORITY_ELSE)} AS seniority_bracket, true AS has_file
FROM emp_kept e JOIN customer c ON c.c_custkey = CAST(substr(e.employee_id, 6) AS BIGINT)
LEFT JOIN departments d ON d.department_id = e.department_id
"""))
def q_hr_silver_employees(spark, sf):
    """Every column of the silver employees."""
    s = run_hr(spark, sf).catalog.read("silver_employees")
    typed = {"seniority_years": F.col("seniority_years").cast("double"), "extract_ts": F.col("extract_ts").cast("timestamp_ntz"),
             "updated_at": F.col("updated_at").cast("timestamp_ntz")}
    return s.withColumns(typed).withColumn("has_file", F.col("_source_file").isNotNull()).drop("_source_file")


@register("hr_silver_absences", _sql("""
SELECT source_entity, absence_id, employee_id, absence_type, start_date, CAST(end_date AS DATE) AS end_date, days,
       CAST(start_date AS TIMESTAMP) + INTERVAL 8 HOUR AS event_timestamp, absence_month, comment FROM abs_kept
"""))
def q_hr_silver_absences(spark, sf):
    """Z3: every column of the silver absences."""
    s = run_hr(spark, sf).catalog.read("silver_absences")
    return s.withColumns({"event_timestamp": F.col("event_timestamp").cast("timestamp_ntz"),
                          "absence_month": F.col("absence_month").cast("timestamp_ntz")})


# ---------------------------------------------------------------------------------------- forms that had small tables only
@register("unique_orders_in_order", """
SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY o_custkey
""")
def q_unique_orders_in_order(spark, sf):
    """The first order of each customer in the order of a partitioned input, the result in that order."""
    rows = tbl(spark, sf, "orders").repartition(7).orderBy("o_orderdate", "o_orderkey")
    return unique(rows, ["o_custkey"], False, keep_input_order=True).select("o_custkey", "o_orderkey")


@register("graph_files_of_customers", """
SELECT c_mktsegment, COUNT(*) AS customers, ROUND(SUM(c_acctbal), 2) AS balance FROM customer WHERE c_nationkey > 3 GROUP BY 1
""")
def q_graph_files_of_customers(spark, sf):
    """A CSV source of several files in a graph, with its types inferred."""
    path = work_dir(spark, "export") + "/customers_csv"
    export.export_csv(tbl(spark, sf, "customer").repartition(5), path)
    ports = run_graph(spark, [
        Node("files", "source", {"file_source": {"path": path, "format": "csv", "options": {"header": True, "inferSchema": "'true'"}}}),
        Node("some", "filter", {"condition": "c_nationkey > 3"}, {"data": "files.data"}),
        Node("sums", "aggregate", {"group_bys": ["c_mktsegment"], "aggregations": [
            {"columnExpr": {"expr": "*"}, "fn": "COUNT", "alias": "customers"},
            {"columnExpr": {"expr": "ROUND(SUM(c_acctbal), 2)", "type": "expr"}, "fn": "-", "alias": "balance"}]},
             {"data": "some.filtered_data"})])
    return ports["sums.aggregated_data"]
