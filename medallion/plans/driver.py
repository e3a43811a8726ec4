"""Queries registered for the driver: each operator applied to the driver's tables, plus an oracle SQL.

Every query reads whole tables (or data Spark derives from them) — no id subsets, sampling or row caps; a
``LIMIT`` appears only where it is the feature (top-k).  Each returns a lazy DataFrame whose column names
and types equal the oracle SQL's (DuckDB), so the driver's order-insensitive comparison applies.
Doubles that come from sums or averages are rounded on both sides; integer results are BIGINT.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.functions.columns import (
    SENIORITY_BRACKETS, SENIORITY_ELSE, age_years, bracket, seniority_years,
)
from medallion.operators import cdc, classify as cls, quality, sets, windows
from medallion.operators.aggregate import Measures, aggregate
from medallion.operators.filter import split_filter
from medallion.operators.join import join, master_join
from medallion.operators.prepare import prepare
from medallion.operators.sqlnode import expression_select, run_sql, table_function
from medallion.operators.unique import unique
from medallion.plans.graph import Node, row_counts, run_graph

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return wrap


def tbl(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


# ============================================================================ Z7 headcount (flagship)
HEADCOUNT_SQL_NODE = """
SELECT region, nation,
       COUNT(*) AS headcount,
       ROUND(AVG(c_acctbal), 2) AS avg_acctbal,
       CAST(SUM(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) AS BIGINT) AS building_count,
       CAST(ROUND(SUM(CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 1) AS DOUBLE)
         AS high_balance_pct
FROM Active_customers
GROUP BY region, nation
"""


@register("headcount", """
SELECT r.r_name AS region, n.n_name AS nation,
       COUNT(*) AS headcount,
       ROUND(AVG(c.c_acctbal), 2) AS avg_acctbal,
       CAST(SUM(CASE WHEN c.c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) AS BIGINT) AS building_count,
       CAST(ROUND(SUM(CASE WHEN c.c_acctbal > 5000 THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 1) AS DOUBLE)
         AS high_balance_pct
FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE c.c_acctbal > 0
GROUP BY r.r_name, n.n_name
""")
def q_headcount(spark, sf):
    """Master-data joins → split filter → SQL node with conditional KPIs, run as a node graph."""
    nation = tbl(spark, sf, "nation")
    region = tbl(spark, sf, "region")
    geo = master_join(nation, region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    people = master_join(tbl(spark, sf, "customer"), geo.withColumnRenamed("n_nationkey", "c_nationkey"),
                         "c_nationkey").withColumnRenamed("r_name", "region").withColumnRenamed("n_name", "nation")
    ctx = run_graph(spark, [
        Node("src", "source", {"dataframe": people}),
        Node("active", "filter", {"condition": "c_acctbal > 0"}, {"data": "src.data"}),
        Node("kpi", "sql", {"query": HEADCOUNT_SQL_NODE, "sources": ["Active_customers"]},
             {"data": ["active.filtered_data"]}),
    ])
    return ctx["kpi.result"]


# ============================================================================ P1 split filter
SPLIT_COND = "nullif(o_orderpriority, '5-LOW') <> '1-URGENT' AND o_totalprice > 100000"


@register("split_filter_included", f"SELECT * FROM orders WHERE coalesce({SPLIT_COND}, false)")
def q_split_in(spark, sf):
    return split_filter(tbl(spark, sf, "orders"), SPLIT_COND)["filtered_data"]


@register("split_filter_excluded", f"SELECT * FROM orders WHERE NOT coalesce({SPLIT_COND}, false)")
def q_split_out(spark, sf):
    return split_filter(tbl(spark, sf, "orders"), SPLIT_COND)["excluded_data"]


# ============================================================================ P5–P14 prepare chain
@register("prepare_text", """
SELECT p_partkey, upper(p_name) AS p_name,
       upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS p_type,
       ltrim('  ' || p_brand || ' ') AS padded
FROM part
""")
def q_prepare_text(spark, sf):
    out = prepare(tbl(spark, sf, "part"), [
        {"type": "text_case", "column": "p_name", "case": "upper"},
        {"type": "text_case", "column": "p_type", "case": "title"},
        {"type": "formula", "target": "padded", "expression": "concat('  ', p_brand, ' ')"},
        {"type": "trim", "column": "padded", "side": "left"},
        {"type": "text_case", "column": "p_name", "case": "lower", "enabled": False},
    ])
    return out.select("p_partkey", "p_name", "p_type", "padded")


@register("prepare_replace", """
WITH a AS (
  SELECT p_partkey,
         CASE WHEN contains(lower(p_name), lower('RING')) THEN 'ring item' ELSE p_name END AS p_name1,
         CASE WHEN lower(p_type) = lower('economy') THEN 'ECO' ELSE p_type END AS p_type,
         CASE WHEN starts_with(lower(p_brand), lower('brand#1')) THEN 'B1x' ELSE p_brand END AS p_brand,
         CASE WHEN regexp_matches(CAST(p_size AS VARCHAR), '(?i)^[0-9]$') THEN 0 ELSE p_size END AS p_size
  FROM part)
SELECT p_partkey,
       CASE WHEN ends_with(lower(p_name1), lower('BOLT')) THEN 'bolt item' ELSE p_name1 END AS p_name,
       p_type, p_brand, p_size,
       coalesce(CASE WHEN p_size > 45 THEN NULL ELSE p_size END, -1) AS opt_size
FROM a
""")
def q_prepare_replace(spark, sf):
    out = prepare(tbl(spark, sf, "part"), [
        {"type": "replace_value", "column": "p_name", "match_mode": "contains", "match": "RING", "with": "ring item"},
        {"type": "replace_value", "column": "p_type", "match_mode": "exact", "match": "economy", "with": "ECO"},
        {"type": "replace_value", "column": "p_brand", "match_mode": "prefix", "match": "brand#1", "with": "B1x"},
        {"type": "replace_value", "column": "p_name", "match_mode": "suffix", "match": "BOLT", "with": "bolt item"},
        {"type": "replace_value", "column": "p_size", "match_mode": "regex", "match": "^[0-9]$", "with": "0"},
        {"type": "formula", "target": "opt_size", "expression": "CASE WHEN p_size > 45 THEN NULL ELSE p_size END"},
        {"type": "fill_null", "column": "opt_size", "with": "-1"},
    ])
    return out.select("p_partkey", "p_name", "p_type", "p_brand", "p_size", "opt_size")


@register("prepare_regex", r"""
SELECT p_partkey,
       regexp_replace(p_brand, 'Brand#', 'B-', 'g') AS p_brand,
       regexp_extract(p_name, '^(\w+) (\w+)$', 2) AS noun,
       regexp_extract(regexp_replace(p_brand, 'Brand#', 'B-', 'g'), '([0-9]+)', 1) AS brand_no,
       regexp_extract(p_type, 'Z+', 0) AS no_match
FROM part
""")
def q_prepare_regex(spark, sf):
    out = prepare(tbl(spark, sf, "part"), [
        {"type": "regex_replace", "column": "p_brand", "pattern": "Brand#", "replacement": "B-"},
        {"type": "extract", "column": "p_name", "pattern": r"^(\w+) (\w+)$", "group": 2, "target": "noun"},
        {"type": "extract", "column": "p_brand", "pattern": "([0-9]+)", "group": "1", "target": "brand_no"},
        {"type": "extract", "column": "p_type", "pattern": "Z+", "target": "no_match"},
    ])
    return out.select("p_partkey", "p_brand", "noun", "brand_no", "no_match")


@register("prepare_dates", """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d_txt,
       strptime(strftime(o_orderdate, '%d/%m/%Y %H:%M'), '%d/%m/%Y %H:%M') AS ts_txt,
       CAST(NULL AS DATE) AS bad_date
FROM orders
""")
def q_prepare_dates(spark, sf):
    out = prepare(tbl(spark, sf, "orders"), [
        {"type": "formula", "target": "d_txt",
         "expression": "CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END"},
        {"type": "formula", "target": "ts_txt", "expression": "date_format(o_orderdate, 'dd/MM/yyyy HH:mm')"},
        {"type": "formula", "target": "bad_date", "expression": "concat(o_orderpriority, '-xx')"},
        {"type": "parse_date", "column": "d_txt", "kind": "date"},
        {"type": "parse_date", "column": "ts_txt", "kind": "timestamp", "format": "dd/MM/yyyy HH:mm"},
        {"type": "parse_date", "column": "bad_date", "kind": "date", "format": "yyyy-MM-dd"},
    ])
    return out.select("o_orderkey", "d_txt", F.col("ts_txt").cast("timestamp_ntz").alias("ts_txt"), "bad_date")


@register("prepare_cast", """
SELECT p_partkey,
       TRY_CAST(CASE WHEN p_size > 45 THEN 'x' || CAST(p_size AS VARCHAR) ELSE CAST(p_size AS VARCHAR) END AS INTEGER)
         AS size_txt,
       CAST(p_size AS DOUBLE) AS size_dbl
FROM part
""")
def q_prepare_cast(spark, sf):
    out = prepare(tbl(spark, sf, "part"), [
        {"type": "formula", "target": "size_txt",
         "expression": "CASE WHEN p_size > 45 THEN concat('x', p_size) ELSE CAST(p_size AS STRING) END"},
        {"type": "cast", "column": "size_txt", "to": "int"},
        {"type": "formula", "target": "size_dbl", "expression": "p_size"},
        {"type": "cast", "column": "size_dbl", "to": "double", "on_error": "error"},
    ])
    return out.select("p_partkey", "size_txt", "size_dbl")


# ============================================================================ P4 F4 F5 brackets
@register("brackets", """
WITH d AS (SELECT o_orderkey, datediff('day', CAST(o_orderdate AS DATE), DATE '2003-01-01') AS days FROM orders)
SELECT o_orderkey,
       CAST(floor(days / 365.25) AS INTEGER) AS age,
       CAST(round(days / 365.25, 1) AS DOUBLE) AS seniority_years,
       CASE WHEN CAST(floor(days / 365.25) AS INTEGER) < 6 THEN '<6'
            WHEN CAST(floor(days / 365.25) AS INTEGER) < 8 THEN '6-7'
            WHEN CAST(floor(days / 365.25) AS INTEGER) < 10 THEN '8-9'
            ELSE '10+' END AS age_bracket,
       CASE WHEN round(days / 365.25, 1) < 2 THEN '0-2 ans'
            WHEN round(days / 365.25, 1) < 5 THEN '2-5 ans'
            WHEN round(days / 365.25, 1) < 10 THEN '5-10 ans'
            WHEN round(days / 365.25, 1) < 20 THEN '10-20 ans'
            ELSE '20+ ans' END AS seniority_bracket
FROM d
""")
def q_brackets(spark, sf):
    o = tbl(spark, sf, "orders")
    as_of = "2003-01-01"
    x = o.select("o_orderkey", age_years(F.to_date("o_orderdate"), as_of).alias("age"),
                 seniority_years(F.to_date("o_orderdate"), as_of).alias("sen"))
    return x.select(
        "o_orderkey", "age", F.col("sen").cast("double").alias("seniority_years"),
        bracket(F.col("age"), [(6, "<6"), (8, "6-7"), (10, "8-9")], "10+").alias("age_bracket"),
        bracket(F.col("sen"), SENIORITY_BRACKETS, SENIORITY_ELSE).alias("seniority_bracket"))


# ============================================================================ J1 J4–J10 joins
@register("master_join", """
SELECT c.c_custkey, c.c_name, n.n_name, r.r_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def q_master_join(spark, sf):
    c = tbl(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = tbl(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    r = tbl(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return master_join(master_join(c, n, "c_nationkey"), r, "n_regionkey").select(
        "c_custkey", "c_name", "n_name", "r_name")


@register("join_keys_nocase", """
WITH s AS (SELECT ' ' || lower(c_mktsegment) || ' ' AS seg_label, COUNT(*) AS n_customers
           FROM customer GROUP BY c_mktsegment)
SELECT c.c_custkey, c.c_mktsegment, s.seg_label, s.n_customers
FROM customer c LEFT JOIN s ON upper(trim(c.c_mktsegment)) = upper(trim(s.seg_label))
""")
def q_join_nocase(spark, sf):
    c = tbl(spark, sf, "customer")
    seg = (c.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_customers"))
           .select(F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")).alias("seg_label"), "n_customers"))
    out = join([c.select("c_custkey", "c_mktsegment"), seg], "left", match_case=False,
               conditions=[{"left_input": 0, "right_input": 1,
                            "join_keys": [{"left": "c_mktsegment", "right": "seg_label"}]}])
    return out["joined_data"]


def _split(spark, sf):
    c = tbl(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    e = tbl(spark, sf, "events").select("event_id", "user_id", "event_type")
    return join([c, e], "split_join", conditions=[
        {"left_input": 0, "right_input": 1, "join_keys": [{"left": "c_custkey", "right": "user_id"}]}])


@register("join_split_matched", """
SELECT c.c_custkey, c.c_name, c.c_mktsegment, e.event_id, e.user_id, e.event_type
FROM customer c JOIN events e ON c.c_custkey = e.user_id
""")
def q_split_matched(spark, sf):
    return _split(spark, sf)["joined_data"]


@register("join_left_unmatched", """
SELECT c_custkey, c_name, c_mktsegment FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)
""")
def q_left_unmatched(spark, sf):
    return _split(spark, sf)["left_unmatched"]


@register("join_right_unmatched", """
SELECT event_id, user_id, event_type FROM events e
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE e.user_id = c.c_custkey)
""")
def q_right_unmatched(spark, sf):
    return _split(spark, sf)["right_unmatched"]


@register("join_projection", """
SELECT n.n_name AS name, n.n_nationkey AS key, n.n_regionkey AS rk, r.r_name AS right_name
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def q_join_projection(spark, sf):
    left = tbl(spark, sf, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"),
                                           F.col("n_regionkey").alias("region_key"))
    right = tbl(spark, sf, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))
    out = join([left, right], "split_join", conditions=[
        {"left_input": 0, "right_input": 1, "join_keys": [{"left": "region_key", "right": "key"}]}],
        columns=[{"ordered": ["name"], "edits": [{"column": "region_key", "alias": "rk"}]},
                 {"edits": [{"column": "key", "checked": False}]}])
    return out["joined_data"]


@register("join_theta", """
SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, o.o_orderkey, o.o_totalprice
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey AND l.l_extendedprice * 4 > o.o_totalprice
""")
def q_join_theta(spark, sf):
    l = tbl(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    o = tbl(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return join([l, o], "inner", conditions=[
        {"left_input": 0, "right_input": 1, "join_keys": [{"left": "l_orderkey", "right": "o_orderkey"}],
         "join_conditions": "t0.l_extendedprice * 4 > t1.o_totalprice"}])["joined_data"]


@register("join_nway", """
SELECT l.l_orderkey AS okey, l.l_suppkey AS skey, l.l_extendedprice AS price, l.l_linenumber AS ckey_3,
       o.o_orderkey AS okey_2, o.o_custkey AS ckey, o.o_totalprice AS price_2,
       c.c_custkey AS ckey_3_dup, c.c_nationkey AS nkey, c.c_name AS name,
       s.s_suppkey AS skey_4, s.s_nationkey AS nkey_4, s.s_name AS name_4
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_nationkey = s.s_nationkey
""")
def q_join_nway(spark, sf):
    l = tbl(spark, sf, "lineitem").select(F.col("l_orderkey").alias("okey"), F.col("l_suppkey").alias("skey"),
                                          F.col("l_extendedprice").alias("price"),
                                          F.col("l_linenumber").alias("ckey_3"))
    o = tbl(spark, sf, "orders").select(F.col("o_orderkey").alias("okey"), F.col("o_custkey").alias("ckey"),
                                        F.col("o_totalprice").alias("price"))
    c = tbl(spark, sf, "customer").select(F.col("c_custkey").alias("ckey"), F.col("c_nationkey").alias("nkey"),
                                          F.col("c_name").alias("name"))
    s = tbl(spark, sf, "supplier").select(F.col("s_suppkey").alias("skey"), F.col("s_nationkey").alias("nkey"),
                                          F.col("s_name").alias("name"))

    def edge(i, j, a, b):
        return {"left_input": i, "right_input": j, "join_keys": [{"left": a, "right": b}]}

    return join([l, o, c, s], "inner", conditions=[
        edge(0, 1, "okey", "okey"), edge(1, 2, "ckey", "ckey"), edge(0, 3, "skey", "skey"),
        edge(2, 3, "nkey", "nkey")])["joined_data"]


# ============================================================================ A1–A12 aggregates
def _spec(expr, fn, alias, typ="column", **kw):
    d = {"columnExpr": {"expr": expr, "type": typ}, "fn": fn, "alias": alias}
    d.update(kw)
    return d


@register("agg_basic", """
SELECT l_returnflag, l_linestatus,
       SUM(l_quantity) AS sum_qty, ROUND(AVG(l_extendedprice), 4) AS avg_price,
       COUNT(l_orderkey) AS n, MIN(l_discount) AS min_disc, MAX(l_tax) AS max_tax,
       ROUND(AVG(l_quantity), 6) AS mean_qty,
       ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def q_agg_basic(spark, sf):
    out = aggregate(tbl(spark, sf, "lineitem"), [{"expr": "l_returnflag"}, {"expr": "l_linestatus"}], [
        _spec("l_quantity", "SUM", "sum_qty"), _spec("l_extendedprice", "AVG", "avg_price"),
        _spec("l_orderkey", "COUNT", "n"), _spec("l_discount", "MIN", "min_disc"),
        _spec("l_tax", "MAX", "max_tax"), _spec("l_quantity", "MEAN", "mean_qty"),
        _spec("l_extendedprice * (1 - l_discount)", "SUM", "revenue", "expr"),
        _spec("l_returnflag", "-", None),
    ])
    return out.select("l_returnflag", "l_linestatus", "sum_qty", F.round("avg_price", 4).alias("avg_price"),
                      "n", "min_disc", "max_tax", F.round("mean_qty", 6).alias("mean_qty"),
                      F.round("revenue", 2).alias("revenue"))


@register("agg_stats", """
SELECT l_returnflag,
       median(l_quantity) AS med_qty,
       ROUND(stddev_samp(l_extendedprice), 4) AS sd_price,
       ROUND(var_samp(l_discount), 8) AS var_disc,
       arg_max(l_orderkey * 10 + l_linenumber, l_extendedprice) AS top_line
FROM lineitem GROUP BY l_returnflag
""")
def q_agg_stats(spark, sf):
    out = aggregate(tbl(spark, sf, "lineitem"), ["l_returnflag"], [
        _spec("l_quantity", "MEDIAN", "med_qty"), _spec("l_extendedprice", "STDDEV", "sd_price"),
        _spec("l_discount", "VARIANCE", "var_disc"),
        _spec("l_orderkey * 10 + l_linenumber, l_extendedprice", "MAX_BY", "top_line", "expr"),
    ])
    return out.select("l_returnflag", "med_qty", F.round("sd_price", 4).alias("sd_price"),
                      F.round("var_disc", 8).alias("var_disc"), "top_line")


@register("agg_percentile", """
SELECT l_linestatus,
       ROUND(quantile_cont(l_extendedprice, 0.9), 4) AS p90,
       ROUND(quantile_cont(l_extendedprice, 1.0), 4) AS p_clamped,
       ROUND(quantile_cont(l_extendedprice, 0.5), 4) AS p_default
FROM lineitem GROUP BY l_linestatus
""")
def q_agg_percentile(spark, sf):
    out = aggregate(tbl(spark, sf, "lineitem"), ["l_linestatus"], [
        _spec("l_extendedprice", "PERCENTILE", "p90", percentage=0.9),
        _spec("l_extendedprice", "PERCENTILE", "p_clamped", percentage=1.7),
        _spec("l_extendedprice", "PERCENTILE", "p_default", percentage="abc"),
    ])
    return out.select("l_linestatus", *[F.round(c, 4).alias(c) for c in ("p90", "p_clamped", "p_default")])


@register("agg_concat", """
SELECT n_regionkey, string_agg(n_name, ' | ' ORDER BY n_name) AS nations,
       string_agg(CAST(n_nationkey AS VARCHAR), ', ' ORDER BY CAST(n_nationkey AS VARCHAR)) AS keys
FROM nation GROUP BY n_regionkey
""")
def q_agg_concat(spark, sf):
    return aggregate(tbl(spark, sf, "nation"), ["n_regionkey"], [
        _spec("n_name", "CONCAT", "nations", separator=" | ", order=True),
        _spec("CAST(n_nationkey AS STRING)", "CONCAT", "keys", "expr", order=True),
    ])


@register("agg_distinct", """
SELECT o_orderstatus, COUNT(DISTINCT o_custkey) AS customers, COUNT(*) AS orders
FROM orders GROUP BY o_orderstatus
""")
def q_agg_distinct(spark, sf):
    return aggregate(tbl(spark, sf, "orders"), ["o_orderstatus"], [
        _spec("o_custkey", "COUNT_DISTINCT", "customers"), _spec("1", "COUNT", "orders", "expr")])


@register("agg_groups_only", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def q_agg_groups_only(spark, sf):
    return aggregate(tbl(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], [])


@register("agg_global", """
SELECT COUNT(*) AS orders, ROUND(SUM(o_totalprice), 2) AS total, MAX(o_orderdate) AS last_order,
       bool_or(o_orderstatus = 'P') AS any_pending
FROM orders
""")
def q_agg_global(spark, sf):
    out = aggregate(tbl(spark, sf, "orders"), [], [
        _spec("1", "COUNT", "orders", "expr"), _spec("o_totalprice", "SUM", "total"),
        _spec("o_orderdate", "MAX", "last_order"), _spec("o_orderstatus = 'P'", "BOOL_OR", "any_pending", "expr")])
    return out.select("orders", F.round("total", 2).alias("total"), "last_order", "any_pending")


@register("agg_expr_keys", """
SELECT year(o_orderdate) AS "year(o_orderdate)", o_orderstatus AS status, COUNT(*) AS orders
FROM orders GROUP BY year(o_orderdate), o_orderstatus
""")
def q_agg_expr_keys(spark, sf):
    return aggregate(tbl(spark, sf, "orders"), [{"expr": "year(o_orderdate)"}, {"expr": "o_orderstatus"}], [
        _spec("o_orderstatus", "-", "status"), _spec("o_orderstatus", "_", None),
        _spec("1", "COUNT", "orders", "expr")]).drop("o_orderstatus").withColumn(
        "year(o_orderdate)", F.col("`year(o_orderdate)`").cast("long"))


# ============================================================================ A13 A16 A17 application KPIs
@register("conditional_kpis", """
SELECT c_mktsegment, COUNT(*) AS customers,
       CAST(SUM(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS BIGINT) AS in_debt,
       CAST(ROUND(SUM(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 1) AS DOUBLE) AS in_debt_pct
FROM customer GROUP BY c_mktsegment
""")
def q_conditional_kpis(spark, sf):
    debt = F.when(F.col("c_acctbal") < 0, 1).otherwise(0)
    return tbl(spark, sf, "customer").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"), F.sum(debt).cast("long").alias("in_debt"),
        F.round(F.sum(debt) * F.lit(100.0) / F.count(F.lit(1)), 1).cast("double").alias("in_debt_pct"))


YTD_AS_OF = "1996-06-30"


def ytd_kpis(customers: DataFrame, orders: DataFrame, as_of: str) -> DataFrame:
    """A16 + J3: year-to-date aggregate joined back to the active population, zero-filled."""
    year = int(str(as_of)[:4])
    # a range on the column itself (not year(col) = ...) so the predicate reaches the Parquet scan
    in_year = (F.col("o_orderdate") >= F.lit(f"{year}-01-01").cast("timestamp_ntz")) & \
        (F.col("o_orderdate") < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz"))
    ytd = (orders.where(in_year)
           .groupBy("o_custkey")
           .agg(F.sum("o_totalprice").alias("total_ytd"), F.count(F.lit(1)).alias("orders_ytd")))
    active = customers.where(F.col("c_acctbal") > 0)
    j = active.join(ytd, active["c_custkey"] == ytd["o_custkey"], "left")
    return j.select(*[active[c] for c in active.columns],
                    F.round(F.coalesce(F.col("total_ytd"), F.lit(0.0)), 2).alias("total_ytd"),
                    F.coalesce(F.col("orders_ytd"), F.lit(0)).cast("long").alias("orders_ytd"))


@register("ytd_kpis", f"""
WITH ytd AS (SELECT o_custkey, SUM(o_totalprice) AS total_ytd, COUNT(*) AS orders_ytd FROM orders
             WHERE year(o_orderdate) = year(DATE '{YTD_AS_OF}') GROUP BY o_custkey)
SELECT c.*, ROUND(COALESCE(ytd.total_ytd, 0), 2) AS total_ytd, CAST(COALESCE(ytd.orders_ytd, 0) AS BIGINT) AS orders_ytd
FROM customer c LEFT JOIN ytd ON c.c_custkey = ytd.o_custkey WHERE c.c_acctbal > 0
""")
def q_ytd(spark, sf):
    return ytd_kpis(tbl(spark, sf, "customer"), tbl(spark, sf, "orders"), YTD_AS_OF)


@register("month_type_kpis", """
SELECT c.c_mktsegment, date_trunc('month', o.o_orderdate) AS month, o.o_orderpriority,
       COUNT(DISTINCT o.o_custkey) AS customers, COUNT(o.o_orderkey) AS orders,
       ROUND(SUM(o.o_totalprice), 2) AS total,
       ROUND(ROUND(SUM(o.o_totalprice), 2) / COUNT(o.o_orderkey), 1) AS avg_per_order
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY ALL
""")
def q_month_type(spark, sf):
    o = tbl(spark, sf, "orders")
    c = tbl(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    ctx = run_graph(spark, [
        Node("o", "source", {"dataframe": o}), Node("c", "source", {"dataframe": c}),
        Node("j", "join", {"join_type": "inner", "conditions": [
            {"left_input": 0, "right_input": 1, "join_keys": [{"left": "o_custkey", "right": "c_custkey"}]}]},
            {"left": "o.data", "right": "c.data"}),
        Node("m", "prepare", {"actions": [
            {"type": "formula", "target": "month", "expression": "CAST(date_trunc('month', o_orderdate) AS TIMESTAMP_NTZ)"}]},
            {"data": "j.joined_data"}),
        Node("a", "aggregate", {
            "group_bys": [{"expr": "c_mktsegment"}, {"expr": "month"}, {"expr": "o_orderpriority"}],
            "aggregations": [_spec("o_custkey", "COUNT_DISTINCT", "customers"),
                             _spec("o_orderkey", "COUNT", "orders"), _spec("o_totalprice", "SUM", "total")]},
            {"data": "m.prepared_data"}),
        Node("r", "prepare", {"actions": [
            {"type": "formula", "target": "total", "expression": "ROUND(total, 2)"},
            # exact decimal division, so a .x5 average rounds up whatever the binary noise of the sum
            {"type": "formula", "target": "avg_per_order",
             "expression": "CAST(ROUND(CAST(total AS DECIMAL(18, 2)) / orders, 1) AS DOUBLE)"}]},
            {"data": "a.aggregated_data"}),
    ])
    return ctx["r.prepared_data"]


# ============================================================================ A14 J2 W1–W3 W6 last delivery
def events_as_deliveries(spark, sf):
    """Events read as deliveries: entity = event_type, file = day of ts, key = user_id, version = (ts, id)."""
    return tbl(spark, sf, "events").withColumn("_source_file", F.date_format("ts", "yyyy-MM-dd"))


LAST_DELIVERY_SQL = """
WITH e AS (SELECT *, strftime(ts, '%Y-%m-%d') AS _source_file FROM events),
lf AS (SELECT event_type, arg_max(_source_file, ts) AS last_source_file FROM e GROUP BY event_type),
ranked AS (
  SELECT e.*,
         COUNT(*) OVER (PARTITION BY e.event_type, e.user_id) AS versions_in_file,
         LAG(e.value) OVER (PARTITION BY e.event_type, e.user_id ORDER BY e.ts, e.event_id) AS previous_value,
         LAG(e.props) OVER (PARTITION BY e.event_type, e.user_id ORDER BY e.ts, e.event_id) AS previous_props,
         ROW_NUMBER() OVER (PARTITION BY e.event_type, e.user_id ORDER BY e.ts DESC, e.event_id DESC) AS rn
  FROM e JOIN lf ON e.event_type = lf.event_type AND e._source_file = lf.last_source_file)
SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1
"""


def _last_delivery(spark, sf):
    return windows.last_delivery_latest(
        events_as_deliveries(spark, sf), entity=["event_type"], key=["user_id"], file_col="_source_file",
        file_order="ts", version_order=["ts", "event_id"],
        previous={"previous_value": "value", "previous_props": "props"})


@register("last_delivery_latest", LAST_DELIVERY_SQL)
def q_last_delivery(spark, sf):
    return _last_delivery(spark, sf)


@register("correction_report", f"""
WITH latest AS ({LAST_DELIVERY_SQL})
SELECT event_type, user_id, event_id, ts, versions_in_file, previous_value, value
FROM latest WHERE versions_in_file > 1 ORDER BY ts DESC, event_id LIMIT 20
""")
def q_correction_report(spark, sf):
    rep = windows.corrections(_last_delivery(spark, sf), [F.col("ts").desc(), F.col("event_id")], 20)
    return rep.select("event_type", "user_id", "event_id", "ts", "versions_in_file", "previous_value", "value")


@register("unique_sorted", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id) AS rn FROM events)
WHERE rn = 1
""")
def q_unique_sorted(spark, sf):
    return unique(tbl(spark, sf, "events"), ["user_id"], all_columns=False,
                  sort=[("value", "DESC"), ("event_id", "ASC")])


@register("unique_stable", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events)
WHERE rn = 1
""")
def q_unique_stable(spark, sf):
    return unique(tbl(spark, sf, "events"), ["user_id", "event_type"], all_columns=False)


@register("unique_all_columns", "SELECT DISTINCT lang, source, n_chars, text FROM documents")
def q_unique_all(spark, sf):
    return unique(tbl(spark, sf, "documents").select("lang", "source", "n_chars", "text"))


# ============================================================================ C1–C8 CDC
SCD1_SQL = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
"""


@register("scd1_current", SCD1_SQL)
def q_scd1(spark, sf):
    return cdc.scd1(tbl(spark, sf, "events"), ["user_id"], ["ts", "event_id"])


SCD2_SQL = """
WITH w AS (
  SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_type,
            ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
c AS (SELECT *, SUM(CASE WHEN rn = 1 OR event_type IS DISTINCT FROM prev_type THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl
      FROM w),
i AS (
  SELECT user_id, isl,
         first(ts ORDER BY ts, event_id) AS start_ts, first(event_id ORDER BY ts, event_id) AS start_event_id,
         last(event_id ORDER BY ts, event_id) AS event_id, last(ts ORDER BY ts, event_id) AS ts,
         last(event_type ORDER BY ts, event_id) AS event_type, last(value ORDER BY ts, event_id) AS value,
         last(props ORDER BY ts, event_id) AS props
  FROM c GROUP BY user_id, isl)
SELECT event_id, ts, user_id, event_type, value, props, start_ts, start_event_id,
       LEAD(start_ts) OVER (PARTITION BY user_id ORDER BY isl) AS end_ts,
       LEAD(start_event_id) OVER (PARTITION BY user_id ORDER BY isl) AS end_event_id
FROM i
"""


def _scd2_events(spark, sf):
    return cdc.scd2(tbl(spark, sf, "events"), ["user_id"], ["ts", "event_id"], ["event_type"])


def flat_history(h: DataFrame) -> DataFrame:
    cols = [c for c in h.columns if c not in (cdc.START_AT, cdc.END_AT)]
    return h.select(*cols, F.col(f"{cdc.START_AT}.ts").alias("start_ts"),
                    F.col(f"{cdc.START_AT}.event_id").alias("start_event_id"),
                    F.col(f"{cdc.END_AT}.ts").alias("end_ts"), F.col(f"{cdc.END_AT}.event_id").alias("end_event_id"))


@register("scd2_history", SCD2_SQL)
def q_scd2(spark, sf):
    return flat_history(_scd2_events(spark, sf))


@register("scd2_open", f"SELECT * FROM ({SCD2_SQL}) WHERE end_ts IS NULL")
def q_scd2_open(spark, sf):
    return flat_history(cdc.current_versions(_scd2_events(spark, sf)))


@register("scd2_multi_version", f"""
SELECT user_id, COUNT(*) AS versions FROM ({SCD2_SQL}) GROUP BY user_id HAVING COUNT(*) >= 50
""")
def q_scd2_multi(spark, sf):
    return cdc.multi_version_keys(_scd2_events(spark, sf), ["user_id"], 50)


CHANGE_CUT = "2024-01-15"


@register("change_feed", f"""
WITH b AS (SELECT * EXCLUDE (rn) FROM (
             SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
             FROM events WHERE ts < TIMESTAMP '{CHANGE_CUT}') WHERE rn = 1),
a AS ({SCD1_SQL}),
j AS (SELECT b.event_id AS b_event_id, b.ts AS b_ts, b.user_id AS b_user_id, b.event_type AS b_event_type,
             b.value AS b_value, b.props AS b_props,
             a.event_id AS a_event_id, a.ts AS a_ts, a.user_id AS a_user_id, a.event_type AS a_event_type,
             a.value AS a_value, a.props AS a_props
      FROM b FULL OUTER JOIN a ON b.user_id = a.user_id)
SELECT b_event_id AS event_id, b_ts AS ts, b_user_id AS user_id, b_event_type AS event_type, b_value AS value,
       b_props AS props, CASE WHEN a_user_id IS NULL THEN 'delete' ELSE 'update_preimage' END AS _change_type
FROM j WHERE b_user_id IS NOT NULL AND (a_user_id IS NULL OR b_event_id IS DISTINCT FROM a_event_id
      OR b_ts IS DISTINCT FROM a_ts OR b_event_type IS DISTINCT FROM a_event_type
      OR b_value IS DISTINCT FROM a_value OR b_props IS DISTINCT FROM a_props)
UNION ALL
SELECT a_event_id, a_ts, a_user_id, a_event_type, a_value, a_props,
       CASE WHEN b_user_id IS NULL THEN 'insert' ELSE 'update_postimage' END
FROM j WHERE a_user_id IS NOT NULL AND (b_user_id IS NULL OR b_event_id IS DISTINCT FROM a_event_id
      OR b_ts IS DISTINCT FROM a_ts OR b_event_type IS DISTINCT FROM a_event_type
      OR b_value IS DISTINCT FROM a_value OR b_props IS DISTINCT FROM a_props)
""")
def q_change_feed(spark, sf):
    e = tbl(spark, sf, "events")
    before = cdc.scd1(e.where(F.col("ts") < F.lit(CHANGE_CUT).cast("timestamp_ntz")), ["user_id"], ["ts", "event_id"])
    after = cdc.scd1(e, ["user_id"], ["ts", "event_id"])
    return cdc.change_feed(before, after, ["user_id"])


@register("consistency_check", "SELECT CAST(0 AS BIGINT) AS differences")
def q_consistency(spark, sf):
    e = tbl(spark, sf, "events")
    current = cdc.scd1(e, ["user_id"], ["ts", "event_id"])
    latest = windows.latest_per_key(e, ["user_id"], ["ts", "event_id"], count_as=None)
    return cdc.count_differences(current, latest, ["user_id"], ["event_id", "ts", "event_type", "value", "props"])


# ============================================================================ Q1–Q8 quality
ORDER_RULES = [
    quality.Expectation("valid_key", "o_orderkey IS NOT NULL", "fail"),
    quality.Expectation("big_enough", "o_totalprice > 5000", "drop"),
    quality.Expectation("known_priority", "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')", "warn"),
    quality.Expectation("recent", "o_orderdate >= TIMESTAMP '1993-01-01 00:00:00'", "drop"),
    quality.Expectation("not_pending", "nullif(o_orderstatus, 'P') <> 'X'", "drop"),
]
_V_BIG = "NOT coalesce(o_totalprice > 5000, true)"
_V_PRIO = "NOT coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM'), true)"
_V_RECENT = "NOT coalesce(o_orderdate >= TIMESTAMP '1993-01-01 00:00:00', true)"
_V_PEND = "NOT coalesce(nullif(o_orderstatus, 'P') <> 'X', true)"


def _orders_quality(spark, sf):
    return quality.apply_expectations(tbl(spark, sf, "orders"), ORDER_RULES, "orders")


@register("expect_kept", f"SELECT * FROM orders WHERE NOT ({_V_BIG} OR {_V_RECENT} OR {_V_PEND})")
def q_expect_kept(spark, sf):
    return _orders_quality(spark, sf).kept


@register("expect_quarantine", f"""
SELECT *, concat_ws(',', CASE WHEN {_V_BIG} THEN 'big_enough' END, CASE WHEN {_V_PRIO} THEN 'known_priority' END,
                        CASE WHEN {_V_RECENT} THEN 'recent' END, CASE WHEN {_V_PEND} THEN 'not_pending' END)
         AS failed_rules
FROM orders WHERE {_V_BIG} OR {_V_RECENT} OR {_V_PEND}
""")
def q_expect_quarantine(spark, sf):
    q = _orders_quality(spark, sf).quarantine
    return q.withColumn("failed_rules", F.array_join(quality.FAILED_RULES, ",")).drop(quality.FAILED_RULES)


@register("expect_metrics", f"""
SELECT 'orders' AS dataset, rule, action, CAST(failed AS BIGINT) AS failed, CAST(n - failed AS BIGINT) AS passed
FROM (SELECT COUNT(*) AS n,
             COUNT(*) FILTER (WHERE o_orderkey IS NULL) AS f0,
             COUNT(*) FILTER (WHERE {_V_BIG}) AS f1, COUNT(*) FILTER (WHERE {_V_PRIO}) AS f2,
             COUNT(*) FILTER (WHERE {_V_RECENT}) AS f3, COUNT(*) FILTER (WHERE {_V_PEND}) AS f4 FROM orders) c,
     (VALUES ('valid_key', 'fail', 0), ('big_enough', 'drop', 1), ('known_priority', 'warn', 2),
             ('recent', 'drop', 3), ('not_pending', 'drop', 4)) AS r(rule, action, i),
     LATERAL (SELECT CASE i WHEN 0 THEN f0 WHEN 1 THEN f1 WHEN 2 THEN f2 WHEN 3 THEN f3 ELSE f4 END AS failed)
""")
def q_expect_metrics(spark, sf):
    return _orders_quality(spark, sf).metrics


# ============================================================================ U1–U4 sets and comparison
def _impl_pair(spark, sf):
    o = tbl(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    other = o.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "P", F.round("o_totalprice", 0))
                         .otherwise(F.col("o_totalprice")))
    return o, other


_PAIR_SQL = """a AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders),
b AS (SELECT o_orderkey, o_orderstatus,
             CASE WHEN o_orderstatus = 'P' THEN round(o_totalprice, 0) ELSE o_totalprice END AS o_totalprice
      FROM orders)"""


@register("table_compare", f"""
WITH {_PAIR_SQL},
t AS (SELECT *, 1 AS na, 0 AS nb FROM a UNION ALL SELECT *, 0 AS na, 1 AS nb FROM b),
g AS (SELECT o_orderkey, o_orderstatus, o_totalprice, SUM(na) AS na, SUM(nb) AS nb FROM t GROUP BY ALL)
SELECT 'orders' AS table_name, CAST(SUM(na) AS BIGINT) AS left_rows, CAST(SUM(nb) AS BIGINT) AS right_rows,
       CAST(COUNT(*) FILTER (WHERE na > 0 AND nb = 0) AS BIGINT) AS left_only_distinct,
       CAST(COUNT(*) FILTER (WHERE nb > 0 AND na = 0) AS BIGINT) AS right_only_distinct,
       CAST(SUM(greatest(na - nb, 0)) AS BIGINT) AS left_only_rows,
       CAST(SUM(greatest(nb - na, 0)) AS BIGINT) AS right_only_rows,
       SUM(na) = SUM(nb) AS same_count,
       SUM(greatest(na - nb, 0)) = 0 AND SUM(greatest(nb - na, 0)) = 0 AS identical
FROM g
""")
def q_table_compare(spark, sf):
    a, b = _impl_pair(spark, sf)
    return sets.compare_tables(a, b, "orders")


@register("except_both", f"""
WITH {_PAIR_SQL}
SELECT *, 'left_only' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL
SELECT *, 'right_only' AS side FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
""")
def q_except_both(spark, sf):
    a, b = _impl_pair(spark, sf)
    left, right = sets.except_both(a, b)
    return sets.union_all([left.withColumn("side", F.lit("left_only")), right.withColumn("side", F.lit("right_only"))])


@register("union_by_name", """
SELECT o_orderkey, o_totalprice, NULL::VARCHAR AS c_name FROM orders
UNION ALL
SELECT c_custkey AS o_orderkey, c_acctbal AS o_totalprice, c_name FROM customer
""")
def q_union_by_name(spark, sf):
    o = tbl(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    c = tbl(spark, sf, "customer").select(F.col("c_name"), F.col("c_acctbal").alias("o_totalprice"),
                                          F.col("c_custkey").alias("o_orderkey"))
    return sets.union_by_name([o, c])


@register("top_k", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def q_top_k(spark, sf):
    return tbl(spark, sf, "orders").orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey")).limit(20)


# ============================================================================ F11 JSON, X1–X4 classify / expressions / TVF
@register("json_extract", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def q_json_extract(spark, sf):
    from medallion.functions.columns import json_path
    return tbl(spark, sf, "events").select("event_id", json_path("props", "$.k").cast("int").alias("k"))


# Our own label configuration for the driver's documents (license lines, contact data, credentials, prose).
DOC_PATTERNS = {
    "license": ["licen[cs]e", "apache|gnu|mit"],
    "contact": ["[a-z0-9._%+-]+@[a-z0-9-]+[.][a-z]+"],
    "credential": ["token|passw|secret"],
}
DOC_DEFAULT = "prose"


def _doc_label_sql(col: str) -> str:
    scores = {}
    for lab, pats in DOC_PATTERNS.items():
        scores[lab] = " + ".join(f"(CASE WHEN regexp_matches({col}, '{p}', 'i') THEN 1 ELSE 0 END)" for p in pats)
    best = "greatest(" + ", ".join(f"({s})" for s in scores.values()) + ")"
    whens = " ".join(f"WHEN ({s}) = {best} AND ({s}) > 0 THEN '{lab}'" for lab, s in scores.items())
    return f"CASE {whens} ELSE '{DOC_DEFAULT}' END"


@register("classify_distinct", f"""
SELECT lang, category, COUNT(*) AS docs, CAST(SUM(n_chars) AS BIGINT) AS chars,
       COUNT(DISTINCT text) AS distinct_texts
FROM (SELECT *, {_doc_label_sql('text')} AS category FROM documents WHERE text IS NOT NULL)
GROUP BY lang, category
""")
def q_classify_distinct(spark, sf):
    d = tbl(spark, sf, "documents")
    labelled = cls.classify_distinct(d, "text", DOC_PATTERNS, "category_json", DOC_DEFAULT)
    x = expression_select(labelled, ["get_json_object(category_json, '$.response[0]') AS category"], keep_all=True)
    return x.groupBy("lang", "category").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("n_chars").cast("long").alias("chars"),
        F.count_distinct("text").alias("distinct_texts"))


@register("expression_select", """
SELECT upper(event_type) AS kind, value * 2 AS double_value, * FROM events
""")
def q_expression_select(spark, sf):
    return expression_select(tbl(spark, sf, "events"), ["upper(event_type) AS kind", "value * 2 AS double_value"])


@register("table_function", """
SELECT event_type, COUNT(*) AS n, ROUND(SUM(value), 2) AS total FROM events GROUP BY event_type
""")
def q_table_function(spark, sf):
    return table_function(spark, "SELECT event_type, COUNT(*) AS n, ROUND(SUM(value), 2) AS total "
                                 "FROM __input__ GROUP BY event_type", tbl(spark, sf, "events"))


# ============================================================================ S7 measures, P16 SQL node, P18/P19 graph
LINE_MEASURES = {
    "revenue": "ROUND(SUM(l_extendedprice * (1 - l_discount)), 2)",
    "qty": "SUM(l_quantity)",
    "orders": "COUNT(DISTINCT l_orderkey)",
}


@register("measures_query", """
SELECT l_returnflag, l_linestatus, ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS revenue,
       COUNT(DISTINCT l_orderkey) AS orders
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def q_measures(spark, sf):
    return Measures(tbl(spark, sf, "lineitem"), LINE_MEASURES).query(["l_returnflag", "l_linestatus"],
                                                                    ["revenue", "orders"])


@register("measures_dims_only", "SELECT DISTINCT l_returnflag FROM lineitem")
def q_measures_dims(spark, sf):
    return Measures(tbl(spark, sf, "lineitem"), LINE_MEASURES).query(["l_returnflag"], [])


@register("measures_only", "SELECT SUM(l_quantity) AS qty, COUNT(DISTINCT l_orderkey) AS orders FROM lineitem")
def q_measures_only(spark, sf):
    return Measures(tbl(spark, sf, "lineitem"), LINE_MEASURES).query([], ["qty", "orders"])


@register("sql_node", """
SELECT o_orderstatus, COUNT(*) AS n FROM orders WHERE o_totalprice > 200000 GROUP BY o_orderstatus
""")
def q_sql_node(spark, sf):
    return run_sql(spark, "SELECT o_orderstatus, COUNT(*) AS n FROM Big_orders WHERE o_totalprice > :min_total "
                          "GROUP BY o_orderstatus", {"Big_orders": tbl(spark, sf, "orders")},
                   {"min_total": 200000, "unused": 1})


def _graph(spark, sf, disabled=False):
    return run_graph(spark, [
        Node("src", "source", {"dataframe": tbl(spark, sf, "orders")}),
        Node("f", "filter", {"condition": "o_orderstatus = 'F'"}, {"data": "src.data"}, disabled=disabled),
        Node("u", "unique", {"unique_by_all_columns": False, "columns": ["o_custkey"],
                             "sort_expressions": [{"columnExpr": {"expr": "o_totalprice"}, "sortBy": "DESC"}]},
             {"data": "f.filtered_data"}),
    ])


@register("disable_node", "SELECT * FROM orders WHERE false")
def q_disable_node(spark, sf):
    return _graph(spark, sf, disabled=True)["f.filtered_data"]


@register("node_row_counts", """
SELECT 'f' AS node, 'filtered_data' AS port, COUNT(*) AS rows FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT 'f', 'excluded_data', COUNT(*) FROM orders WHERE NOT coalesce(o_orderstatus = 'F', false)
UNION ALL
SELECT 'u', 'unique_data', COUNT(DISTINCT o_custkey) FROM orders WHERE o_orderstatus = 'F'
""")
def q_node_row_counts(spark, sf):
    ctx = _graph(spark, sf)
    return row_counts(ctx, ["f.filtered_data", "f.excluded_data", "u.unique_data"])


@register("unique_node_sorted", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rn
  FROM orders WHERE o_orderstatus = 'F') WHERE rn = 1
""")
def q_unique_node(spark, sf):
    return _graph(spark, sf)["u.unique_data"]
