"""More operator queries over the driver's tables: the forms and edge cases that ``driver`` and ``streams`` leave out."""

from __future__ import annotations

from pyspark.sql import functions as F

from medallion.operators import cdc, quality, windows
from medallion.operators.aggregate import aggregate
from medallion.operators.classify import HR_REASON_PATTERNS, classify_distinct
from medallion.operators.join import join
from medallion.operators.unique import unique
from medallion.plans import hr360
from medallion.plans.driver import SCD2_SQL, flat_history, register, tbl
from medallion.plans.graph import Node, run_graph
from medallion.plans.hr_driver import _label_sql, _sql, run_hr
from medallion.plans.streams import EVENT_COLS, EVENTS, MIN_VALUE, land_events
from medallion.session import work_dir
from medallion.sinks import export
from medallion.sinks.tables import Catalog, Table
from medallion.sources.tables import FlowSpec
from medallion.streaming.flows import Pipeline, quality_summary


# ---------------------------------------------------------------------------------------- CDC
_NULL_KEYS = "(SELECT * REPLACE (nullif(user_id % 7, 0) AS user_id) FROM events)"


def _null_key_events(spark, sf):
    return tbl(spark, sf, "events").withColumn("user_id", F.nullif(F.col("user_id") % 7, F.lit(0).cast("long")))


@register("scd2_null_keys", SCD2_SQL.replace("FROM events)", f"FROM {_NULL_KEYS} e)", 1))
def q_scd2_null_keys(spark, sf):
    """A NULL key is a key with a history of its own."""
    return flat_history(cdc.scd2(_null_key_events(spark, sf), ["user_id"], ["ts", "event_id"], ["event_type"]))


_HOT = "(SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id) FROM events)"


@register("scd2_hot_key", SCD2_SQL.replace("FROM events)", f"FROM {_HOT} e)", 1))
def q_scd2_hot_key(spark, sf):
    """A third of all rows under one key."""
    hot = tbl(spark, sf, "events").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).cast("long"))
    return flat_history(cdc.scd2(hot, ["user_id"], ["ts", "event_id"], ["event_type"]))


@register("scd1_from_snapshots", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 5 <> 0
UNION ALL SELECT o_orderkey, o_totalprice + 1 FROM orders WHERE o_orderkey % 5 = 0 AND o_orderkey % 10 <> 0
""")
def q_scd1_from_snapshots(spark, sf):
    """Two snapshots (a fifth changed, half of these deleted) → change feed → current state."""
    first = tbl(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    second = first.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 5 == 0, F.col("o_totalprice") + 1)
                              .otherwise(F.col("o_totalprice"))).where("o_orderkey % 10 <> 0")
    feed = cdc.changes_from_snapshots([(1, first), (2, second)], ["o_orderkey"]) \
        .where("_change_type <> 'update_preimage'")
    return cdc.scd1(feed, ["o_orderkey"], ["_snapshot_version"]).where("_change_type <> 'delete'") \
        .select("o_orderkey", "o_totalprice")


@register("consistency_broken", """
SELECT COUNT(DISTINCT user_id) FILTER (user_id % 5 = 0) AS differences FROM events
""")
def q_consistency_broken(spark, sf):
    """The check finds exactly the keys that were tampered with."""
    e = tbl(spark, sf, "events")
    current = cdc.scd1(e, ["user_id"], ["ts", "event_id"]).withColumn(
        "value", F.when(F.col("user_id") % 5 == 0, F.col("value") + 1).otherwise(F.col("value")))
    latest = windows.latest_per_key(e, ["user_id"], ["ts", "event_id"], count_as=None)
    return cdc.count_differences(current, latest, ["user_id"], ["event_id", "value"])


# ---------------------------------------------------------------------------------------- streaming
class _Failure(RuntimeError):
    pass


@register("stream_retry_quarantine", f"""
SELECT 'quarantine' AS kind, COUNT(*) AS n FROM events WHERE NOT coalesce(value >= {MIN_VALUE}, true)
UNION ALL SELECT 'silver', COUNT(*) FROM events WHERE value >= {MIN_VALUE}
UNION ALL SELECT 'failed min_value', COUNT(*) FROM events WHERE NOT coalesce(value >= {MIN_VALUE}, true)
UNION ALL SELECT 'passed min_value', COUNT(*) FROM events WHERE coalesce(value >= {MIN_VALUE}, true)
""")
def q_stream_retry_quarantine(spark, sf):
    """Q5/Q8/T5: a failure between the silver and the quarantine commit; the retry brings each exactly once."""
    root = work_dir(spark, "events-retry")
    land_events(spark, sf, f"{root}/landing", 1)
    land_events(spark, sf, f"{root}/landing", 2)
    flows = [FlowSpec(e, f"{root}/landing/entity={e}/*") for e in ("A", "B")]
    p, append, failed = Pipeline(spark, root), Table.append, []

    def once(self, df, txn=None, **kw):
        if self.path.endswith("_quarantine") and not failed:
            failed.append(self.path)
            raise _Failure("injected")
        return append(self, df, txn=txn, **kw)

    Table.append = once
    try:
        p.run([(EVENTS, flows)])
    except Exception:
        if not failed:
            raise
    finally:
        Table.append = append
    p.run([(EVENTS, flows)])
    counts = [p.catalog.read(t).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
              for kind, t in (("quarantine", "silver_events_quarantine"), ("silver", "silver_events"))]
    rule = quality_summary(p, "silver_events").where("rule = 'min_value'")
    counts += [rule.select(F.lit(f"{c} min_value").alias("kind"), F.col(c).alias("n")) for c in ("failed", "passed")]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@register("stream_full_refresh", f"""
SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE value >= {MIN_VALUE}
""")
def q_stream_full_refresh(spark, sf):
    """Half of the files, a full refresh, the other half in a normal run, a second full refresh."""
    root = work_dir(spark, "events-refresh")
    flows = [FlowSpec(e, f"{root}/landing/entity={e}/*") for e in ("A", "B")]
    p, plan = Pipeline(spark, root), [(EVENTS, flows)]
    land_events(spark, sf, f"{root}/landing", 1)
    p.run(plan)
    p.full_refresh(plan)
    land_events(spark, sf, f"{root}/landing", 2)
    p.run(plan)
    p.full_refresh(plan)
    p.run(plan)  # nothing new
    return p.catalog.read("silver_events").select(*EVENT_COLS)


# ---------------------------------------------------------------------------------------- aggregates, unique, joins
@register("percentile_unaliased", """
SELECT l_returnflag, quantile_cont(l_extendedprice, 0.9) AS "percentile(l_extendedprice, 0.9, 1)",
       quantile_cont(l_quantity, 0.5) AS "median(l_quantity)", COUNT(*) AS n
FROM lineitem GROUP BY l_returnflag
""")
def q_percentile_unaliased(spark, sf):
    """The names that Spark gives, from the plan that holds no group in one task."""
    return aggregate(tbl(spark, sf, "lineitem"), ["l_returnflag"], [
        {"columnExpr": {"expr": "l_extendedprice"}, "fn": "PERCENTILE", "percentage": 0.9},
        {"columnExpr": {"expr": "l_quantity"}, "fn": "MEDIAN"},
        {"columnExpr": {"expr": "*"}, "fn": "COUNT", "alias": "n"}])


@register("agg_first_last", """
SELECT o_orderstatus, min(o_orderstatus) AS first_status, max(o_orderstatus) AS last_status,
       string_agg(o_orderpriority, '|' ORDER BY o_orderpriority) AS priorities
FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders) GROUP BY o_orderstatus
""")
def q_agg_first_last(spark, sf):
    """FIRST and LAST of a column that is constant in its group; CONCAT with a separator."""
    rows = tbl(spark, sf, "orders").select("o_orderstatus", "o_orderpriority").distinct()
    return aggregate(rows, ["o_orderstatus"], [
        {"columnExpr": {"expr": "o_orderstatus"}, "fn": "FIRST", "alias": "first_status"},
        {"columnExpr": {"expr": "o_orderstatus"}, "fn": "LAST", "alias": "last_status"},
        {"columnExpr": {"expr": "o_orderpriority"}, "fn": "CONCAT", "separator": "|", "order": True, "alias": "priorities"}])


@register("unique_desc_nan", """
SELECT k, CASE WHEN bool_or(nan_value) THEN 'nan' ELSE 'number' END AS kept
FROM (SELECT event_id % 50 AS k, event_type = 'error' AS nan_value FROM events) GROUP BY k
""")
def q_unique_desc_nan(spark, sf):
    """Sorted descending, NaN comes before every number."""
    e = tbl(spark, sf, "events").select(
        (F.col("event_id") % 50).alias("k"),
        F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("v"),
        F.when(F.col("event_type") == "error", "nan").otherwise("number").alias("kept"))
    return unique(e, ["k"], False, [("v", "DESC")]).select("k", "kept")


@register("unique_input_order", """
SELECT n_regionkey, min(n_nationkey) AS n_nationkey FROM nation GROUP BY n_regionkey
""")
def q_unique_input_order(spark, sf):
    """First row of each key in input order, the result sorted by input order."""
    rows = tbl(spark, sf, "nation").orderBy("n_nationkey").coalesce(1)
    return unique(rows, ["n_regionkey"], False, keep_input_order=True).select("n_regionkey", "n_nationkey")


@register("join_types", """
WITH c AS (SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0),
o AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey % 5 <> 0),
s AS (SELECT * FROM c WHERE c_custkey IN (SELECT o_custkey FROM o))
SELECT 'right' AS how, COUNT(*) AS n, COUNT(c_custkey) AS matched FROM c RIGHT JOIN o ON c_custkey = o_custkey
UNION ALL SELECT 'full', COUNT(*), COUNT(c_custkey) FROM c FULL OUTER JOIN o ON c_custkey = o_custkey
UNION ALL SELECT 'left_semi', COUNT(*), COUNT(c_custkey) FROM s
UNION ALL SELECT 'left_anti', (SELECT COUNT(*) FROM c) - COUNT(*), (SELECT COUNT(*) FROM c) - COUNT(*) FROM s
""")
def q_join_types(spark, sf):
    """The join types that are passed through."""
    c = tbl(spark, sf, "customer").select("c_custkey", "c_mktsegment").where("c_custkey % 3 <> 0")
    o = tbl(spark, sf, "orders").select("o_orderkey", "o_custkey").where("o_custkey % 5 <> 0")
    on = [{"left_input": 0, "right_input": 1, "join_keys": [{"left": "c_custkey", "right": "o_custkey"}]}]
    out = None
    for how in ("right", "full", "left_semi", "left_anti"):
        n = join([c, o], how, conditions=on)["joined_data"].agg(
            F.lit(how).alias("how"), F.count("*").alias("n"), F.count("c_custkey").alias("matched"))
        out = n if out is None else out.unionByName(n)
    return out


@register("classify_null_text", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL
            WHEN o_orderpriority ILIKE '%urgent%' THEN 'now' WHEN o_orderpriority ILIKE '%low%' THEN 'later'
            ELSE 'some day' END AS label FROM orders
""")
def q_classify_null_text(spark, sf):
    """Distinct texts classified once; rows without a text stay, without a label."""
    rows = tbl(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority"))
                                           .alias("text"))
    return classify_distinct(rows, "text", {"now": ["urgent"], "later": ["low"]}, "label", "some day", as_json=False) \
        .select("o_orderkey", "label")


# ---------------------------------------------------------------------------------------- quality
@register("quality_fail_action", """
SELECT 'raised' AS outcome, COUNT(*) AS violations FROM orders WHERE o_totalprice > 300000
""")
def q_quality_fail_action(spark, sf):
    """Q3/Q4/Q6: a fail rule stops the write; the same rule as a warning counts its violations."""
    o = tbl(spark, sf, "orders")
    rule = ("plausible_total", "o_totalprice <= 300000")
    warned = quality.apply_expectations(o, [quality.Expectation(*rule, "warn")], "orders")
    strict = quality.apply_expectations(o, [quality.Expectation(*rule, "fail")], "orders")
    try:
        strict.kept.write.format("noop").mode("overwrite").save()
        outcome = "written"
    except Exception as problem:
        outcome = "raised" if "expectation failed" in str(problem) else "other"
    return warned.metrics.select(F.lit(outcome).alias("outcome"), F.col("failed").alias("violations"))


# ---------------------------------------------------------------------------------------- sinks
@register("export_split_append", """
SELECT 'a-b' AS value, COUNT(*) AS n, 'ab' AS name FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'ab', COUNT(*), 'ab_2' FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'none', COUNT(*), 'none' FROM orders WHERE o_orderstatus NOT IN ('O', 'F')
""")
def q_export_split_append(spark, sf):
    """The second part comes later under names that collide; each value keeps its own group."""
    o = tbl(spark, sf, "orders")
    rows = o.select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderstatus") == "O", "a/b")
                    .when(F.col("o_orderstatus") == "F", "ab").alias("status"))
    path = work_dir(spark, "export") + "/split_append"
    export.export_split(rows.where("o_orderstatus = 'O'"), path, "status", fmt="json")
    export.export_split(rows.where("o_orderstatus <> 'O'"), path, "status", fmt="json", mode="append")
    value = F.coalesce(F.replace("status", F.lit("/"), F.lit("-")), F.lit("none"))
    return spark.read.json(path).groupBy(value.alias("value"), F.col(export.GROUP_COL).alias("name")) \
        .agg(F.count("*").alias("n"))


@register("export_json_types", """
SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS day, o_totalprice > 100000 AS large,
       CAST(o_totalprice AS DECIMAL(12, 2)) AS money FROM orders
""")
def q_export_json_types(spark, sf):
    """Numbers, dates, booleans and decimals through a JSON export and back."""
    o = tbl(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day"),
                                        (F.col("o_totalprice") > 100000).alias("large"),
                                        F.col("o_totalprice").cast("decimal(12,2)").alias("money"))
    path = work_dir(spark, "export") + "/types"
    export.export_json(o, path)
    return spark.read.schema(o.schema).json(path)


@register("graph_file_source", """
SELECT n_regionkey, COUNT(*) AS nations FROM nation WHERE n_regionkey > 0 GROUP BY n_regionkey
""")
def q_graph_file_source(spark, sf):
    """A CSV file as the source node of a graph, filtered and aggregated."""
    path = work_dir(spark, "export") + "/nation_csv"
    export.export_csv(tbl(spark, sf, "nation"), path)
    ports = run_graph(spark, [
        Node("files", "source", {"file_source": {"path": path, "format": "csv", "options": {
            "header": True, "inferSchema": "'true'"}}}),
        Node("some", "filter", {"condition": "n_regionkey > 0"}, {"data": "files.data"}),
        Node("count", "aggregate", {"group_bys": ["n_regionkey"], "aggregations": [
            {"columnExpr": {"expr": "*"}, "fn": "COUNT", "alias": "nations"}]}, {"data": "some.filtered_data"})])
    return ports["count.aggregated_data"]


@register("merge_stored_buckets", """
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'merged' ELSE p_name END AS p_name FROM part
""")
def q_merge_stored_buckets(spark, sf):
    """K3: a bucketed table opened again without its layout; the merge finds the stored buckets."""
    part = tbl(spark, sf, "part").select("p_partkey", "p_name")
    path = work_dir(spark, "merge-buckets") + "/part"
    Table(spark, path, bucket_by=["p_partkey"], buckets=3).overwrite(part)
    t = Table(spark, path)
    t.merge(part.where("p_partkey % 3 = 0").withColumn("p_name", F.lit("merged")), ["p_partkey"])
    return t.read()


@register("table_comment", """
SELECT 'nations of the world' AS comment, 'gold' AS quality, COUNT(*) AS n FROM nation
""")
def q_table_comment(spark, sf):
    """Comment and properties kept with the table, read back through the catalog."""
    catalog = Catalog(spark, work_dir(spark, "described"))
    catalog.table("nation").overwrite(tbl(spark, sf, "nation"), comment="nations of the world",
                                      properties={"quality": "gold"})
    m = catalog.table("nation").manifest()
    return catalog.read("nation").agg(F.lit(m.comment).alias("comment"), F.lit(m.properties["quality"]).alias("quality"),
                                      F.count("*").alias("n"))


# ---------------------------------------------------------------------------------------- the HR application
def _hr(spark, sf):
    return run_hr(spark, sf).catalog


@register("hr_broken_copy", _sql("""
SELECT COUNT(*) AS differences, COUNT(*) AS active FROM emp_current WHERE status = 'Active'
"""))
def q_hr_broken_copy(spark, sf):
    """The consistency check on a current table in which every employee of one status was changed."""
    c = _hr(spark, sf)
    broken = c.read("gold_employees_current").withColumn(
        "status", F.when(F.col("status") == "Active", F.lit("Broken")).otherwise(F.col("status")))
    found = hr360.consistency(broken, c.read("silver_employees"))
    wanted = c.read("gold_employees_current").agg(F.count_if(F.col("status") == "Active").alias("active"))
    return found.join(wanted, F.col("differences") == F.col("active")).select("differences", "active")


@register("hr_key_listing", _sql("""
, newest AS (SELECT source_entity, max(extract_ts) AS extract_ts FROM emp_kept GROUP BY source_entity),
last_file AS (SELECT k.* FROM emp_kept k JOIN newest n ON k.source_entity = n.source_entity AND k.extract_ts = n.extract_ts),
one AS (SELECT max(employee_id) AS employee_id FROM last_file),
rows AS (SELECT 'version' AS kind, employee_id, updated_at, department_id, job_title FROM emp_kept
UNION ALL SELECT 'latest', employee_id, max(updated_at), max_by(department_id, updated_at), max_by(job_title, updated_at)
FROM last_file GROUP BY employee_id)
SELECT * FROM rows WHERE employee_id IN (SELECT employee_id FROM one)
""").replace("abs_kept AS (SELECT * FROM abs_silver WHERE NOT v_days)\n\n,", "abs_kept AS (SELECT * FROM abs_silver WHERE NOT v_days),"))
def q_hr_key_listing(spark, sf):
    """Versions and latest rows of the employee with the greatest id."""
    c = _hr(spark, sf)
    last = c.read("silver_employees_last_extract")
    employee = last.agg(F.max("employee_id")).first()[0]
    return hr360.key_listing(c.read("silver_employees"), last, employee) \
        .withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


@register("hr_days_by_reason", _sql(f"""
SELECT {_label_sql('a.comment', HR_REASON_PATTERNS, list(HR_REASON_PATTERNS)[-1])} AS reason_category,
       CAST(SUM(a.days) AS BIGINT) AS total_absence_days
FROM abs_kept a JOIN emp_current e ON upper(trim(a.employee_id)) = upper(trim(e.employee_id))
WHERE a.comment IS NOT NULL GROUP BY 1
"""))
def q_hr_days_by_reason(spark, sf):
    """Days by reason from the stored KPI table."""
    c = _hr(spark, sf)
    return hr360.rollups(c.read("gold_absenteeism_by_department"), c.read("gold_absence_reasons_by_department"),
                         c.read("gold_employee_360"))["days_by_reason"] \
        .withColumn("total_absence_days", F.col("total_absence_days").cast("long"))


@register("hr_top_absentees", _sql("""
SELECT e.employee_id, e.department_name, CAST(coalesce(a.days, 0) AS BIGINT) AS absence_days_ytd,
       CAST(coalesce(a.n, 0) AS BIGINT) AS absence_events_ytd
FROM emp_current e
LEFT JOIN (SELECT employee_id, SUM(days) AS days, COUNT(*) AS n FROM abs_kept
           WHERE year(start_date) = year(DATE '2026-01-01') GROUP BY employee_id) a ON e.employee_id = a.employee_id
WHERE e.status = 'Active' ORDER BY absence_days_ytd DESC, e.employee_id LIMIT 20
"""))
def q_hr_top_absentees(spark, sf):
    """The employees with most days of absence (a top-k report)."""
    c = _hr(spark, sf)
    return hr360.rollups(c.read("gold_absenteeism_by_department"), c.read("gold_absence_reasons_by_department"),
                         c.read("gold_employee_360"))["top_absentees"]
