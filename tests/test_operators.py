import re

import pytest
from pyspark.sql import functions as F

from medallion.functions.columns import AGE_BRACKETS, AGE_ELSE, SENIORITY_BRACKETS, SENIORITY_ELSE, bracket
from medallion.operators import cdc, quality, sets, windows
from medallion.operators.aggregate import Measures, aggregate, clamp_percentile
from medallion.operators.classify import HR_REASON_PATTERNS, classify, classify_distinct
from medallion.operators.filter import disable, split_filter
from medallion.operators.join import join, projection
from medallion.operators.prepare import prepare
from medallion.operators.sqlnode import expression_select, run_sql, table_function
from medallion.operators.unique import unique


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))


def test_split_filter_null_goes_to_excluded(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, s string")
    out = split_filter(df, "s = 'a'")
    assert rows(out["filtered_data"], "id") == [(1,)]
    assert rows(out["excluded_data"], "id") == [(2,), (3,)]
    empty = split_filter(df, "")
    assert empty["filtered_data"].count() == 3 and empty["excluded_data"].count() == 0
    assert disable(df).count() == 0 and disable(df).columns == df.columns


def test_brackets_null_goes_to_else(spark):
    df = spark.createDataFrame([(19,), (20,), (44,), (55,), (None,)], "age int")
    got = rows(df.select("age", bracket(F.col("age"), AGE_BRACKETS, AGE_ELSE).alias("b")), "age", "b")
    assert dict((a, b) for a, b in got) == {19: "<20", 20: "20-34", 44: "35-44", 55: "55+", None: "55+"}
    s = spark.createDataFrame([(1.9,), (2.0,), (None,)], "y double")
    got = dict(rows(s.select("y", bracket(F.col("y"), SENIORITY_BRACKETS, SENIORITY_ELSE).alias("b")), "y", "b"))
    assert got == {1.9: "0-2 ans", 2.0: "2-5 ans", None: "20+ ans"}


def test_prepare_chain(spark):
    df = spark.createDataFrame([("  Ab ", "12", None, "2024-02-30"), ("x.y", "zz", 3, "2024-01-05")],
                               "s string, n string, k int, d string")
    out = prepare(df, [
        {"type": "trim", "column": "s"},
        {"type": "text_case", "column": "s", "case": "upper"},
        {"type": "cast", "column": "n", "to": "int"},
        {"type": "fill_null", "column": "k", "with": "7"},
        {"type": "replace_value", "column": "s", "match_mode": "exact", "match": "ab", "with": "hit"},
        {"type": "parse_date", "column": "d"},
        {"type": "extract", "column": "s", "pattern": "(\\w)\\.(\\w)", "group": 2, "target": "g"},
        {"type": "formula", "target": "x", "expression": "k * 2", "enabled": False},
    ])
    got = sorted(map(tuple, out.select("s", "n", "k", "g").collect()), key=str)
    assert got == [("X.Y", None, 3, "Y"), ("hit", 12, 7, "")]
    assert out.where("d IS NULL").count() == 1  # impossible date -> NULL, not an error
    with pytest.raises(ValueError, match="actions\\[0\\]"):
        prepare(df, [{"type": "nope"}])
    with pytest.raises(ValueError, match="not found"):
        prepare(df, [{"type": "trim", "column": "missing"}])


def test_join_split_and_collisions(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, name string")
    b = spark.createDataFrame([(1, "X"), (4, "w")], "id int, name string")
    out = join([a, b], "split_join", conditions=[{"left_input": 0, "right_input": 1,
                                                   "join_keys": [{"left": "id", "right": "id"}]}])
    assert out["joined_data"].columns == ["id", "name", "right_id", "right_name"]
    assert rows(out["left_unmatched"], "id") == [(2,), (3,)]
    assert rows(out["right_unmatched"], "id") == [(4,)]
    # case- and space-insensitive string keys
    c = spark.createDataFrame([(" X ",)], "name string")
    nocase = join([a, c], "inner", conditions=[{"left_input": 0, "right_input": 1,
                                                "join_keys": [{"left": "name", "right": "name"}]}])
    assert nocase["joined_data"].count() == 1
    # semi join projects the left input only
    semi = join([a, b], "left_semi", conditions=[{"left_input": 0, "right_input": 1,
                                                  "join_keys": [{"left": "id", "right": "id"}]}])
    assert semi["joined_data"].columns == ["id", "name"]
    with pytest.raises(ValueError, match="cross"):
        join([a, b], "inner", conditions=[])
    with pytest.raises(ValueError, match="already used"):
        projection([a.alias("t0"), b.alias("t1")], [{}, {"edits": [{"column": "id", "alias": "name"}]}])


def test_join_nway_dup_naming_and_connectivity(spark):
    a = spark.createDataFrame([(1, 10)], "k int, k_3 int")
    b = spark.createDataFrame([(1, 2)], "k int, j int")
    c = spark.createDataFrame([(2, 5)], "k int, v int")
    edges = [{"left_input": 0, "right_input": 1, "join_keys": [{"left": "k", "right": "k"}]},
             {"left_input": 1, "right_input": 2, "join_keys": [{"left": "j", "right": "k"}]}]
    out = join([a, b, c], "left", conditions=edges)["joined_data"]
    assert out.columns == ["k", "k_3", "k_2", "j", "k_3_dup", "v"]
    with pytest.raises(ValueError, match="not connected"):
        join([a, b, c], "inner", conditions=edges[:1])


def test_aggregate_node(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", 3.0, None), ("b", 2.0, "y")], "g string, v double, s string")
    out = aggregate(df, [{"expr": "g"}], [
        {"columnExpr": {"expr": "v"}, "fn": "PERCENTILE", "percentage": 7, "alias": "p"},
        {"columnExpr": {"expr": "s"}, "fn": "CONCAT", "alias": "c"},
        {"columnExpr": {"expr": "g"}, "fn": "-"},
        {"columnExpr": {"expr": "v > 2", "type": "expr"}, "fn": "BOOL_OR", "alias": "bo"},
    ])
    assert out.columns == ["g", "p", "c", "bo"]
    assert rows(out, "g", "p", "c", "bo") == [("a", 3.0, "x", True), ("b", 2.0, "y", False)]
    assert aggregate(df, ["g"], []).count() == 2
    assert aggregate(df, [], []) is df
    assert clamp_percentile(True) == 0.5 and clamp_percentile(float("nan")) == 0.5 and clamp_percentile(-1) == 0.0
    m = Measures(df, {"total": "SUM(v)"})
    assert m.query([], ["total"]).collect()[0][0] == 6.0
    with pytest.raises(ValueError):
        m.query(None, ["total"])


def test_unique_sorted_and_stable(spark):
    df = spark.createDataFrame([(1, "k", None), (2, "k", 5.0), (3, "k", 5.0), (4, "j", 1.0)],
                               "id int, key string, v double")
    best = unique(df, ["key"], all_columns=False, sort=[("v", "DESC")])
    assert rows(best, "key", "id") == [("j", 4), ("k", 2)]  # NULLS LAST, tie -> input order
    first = unique(df, ["key"], all_columns=False)
    assert rows(first, "key", "id") == [("j", 4), ("k", 1)]
    text_desc = unique(df, ["v"], all_columns=False, sort=[("key", "DESC")])
    assert text_desc.count() == 3
    assert unique(df, [], all_columns=False) is df


def test_quality_null_is_not_a_violation_and_fail_raises(spark):
    df = spark.createDataFrame([(1, None), (2, 10), (3, 200)], "id int, age int")
    rules = [quality.Expectation("plausible", "age BETWEEN 16 AND 75", "drop"),
             quality.Expectation("has_id", "id IS NOT NULL", "fail"),
             quality.Expectation("young", "age < 50", "warn")]
    r = quality.apply_expectations(df, rules, "t")
    assert rows(r.kept, "id") == [(1,)]
    assert rows(r.quarantine.select("id", F.array_join(quality.FAILED_RULES, ",").alias("f")), "id", "f") == \
        [(2, "plausible"), (3, "plausible,young")]
    m = {x["rule"]: (x["failed"], x["passed"]) for x in r.metrics.collect()}
    assert m == {"plausible": (2, 1), "has_id": (0, 3), "young": (1, 2)}
    assert dict((x[1], x[3]) for x in quality.observed_metrics(r, "t")) == {"plausible": 2, "has_id": 0, "young": 1}
    bad = spark.createDataFrame([(None, 20)], "id int, age int")
    with pytest.raises(Exception, match="expectation failed"):
        quality.apply_expectations(bad, rules, "t").kept.collect()


def test_scd1_and_scd2(spark):
    data = [("e1", 1, 1, "A", "x"), ("e1", 1, 2, "B", "y"), ("e1", 2, 1, "B", "z"), ("e1", 3, 1, "A", "w"),
            ("e2", 1, 1, "C", "q")]
    df = spark.createDataFrame(data, "k string, f int, u int, dep string, other string")
    cur = cdc.scd1(df, ["k"], ["f", "u"])
    assert rows(cur, "k", "dep", "other") == [("e1", "A", "w"), ("e2", "C", "q")]
    h = cdc.scd2(df, ["k"], ["f", "u"], ["dep"], strategy="segments")
    got = rows(h.select("k", "dep", "other", F.col("__START_AT.f").alias("sf"), F.col("__START_AT.u").alias("su"),
                        F.col("__END_AT.f").alias("ef")), "k", "sf", "su", "dep", "other", "ef")
    # A -> B -> A gives three versions; the B version keeps its last row's untracked value
    assert got == [("e1", 1, 1, "A", "x", 1), ("e1", 1, 2, "B", "z", 3), ("e1", 3, 1, "A", "w", None),
                   ("e2", 1, 1, "C", "q", None)]
    ref = cdc.scd2(df, ["k"], ["f", "u"], ["dep"], strategy="window")
    assert sets.compare_tables(h, ref).collect()[0]["identical"]
    unknown = df.unionByName(spark.createDataFrame([(None, 1, 1, "A", "x"), (None, 2, 1, "B", "y")], df.schema))
    both = [cdc.scd2(unknown, ["k"], ["f", "u"], ["dep"], strategy=s) for s in ("segments", "window")]
    assert both[0].where("k is null").count() == 2  # a NULL key is a key, in either plan
    assert sets.compare_tables(*both).collect()[0]["identical"]
    with pytest.raises(Exception, match="NULL value in the sequence"):
        cdc.scd1(spark.createDataFrame([("e", None, 1)], "k string, f int, u int"), ["k"], ["f", "u"]).collect()


def test_scd2_segments_equal_window_on_events(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    a = cdc.scd2(e, ["user_id"], ["ts", "event_id"], ["event_type"])
    b = cdc.scd2_window(e, ["user_id"], ["ts", "event_id"], ["event_type"])
    r = sets.compare_tables(a, b).collect()[0]
    assert r["identical"] and r["left_rows"] > 0


def test_change_feed(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k int, v string")
    got = rows(cdc.change_feed(before, after, ["k"]), "k", "v", "_change_type")
    assert got == [(2, "B", "update_postimage"), (2, "b", "update_preimage"), (3, "c", "delete"),
                   (4, "d", "insert")]


def test_latest_per_key_and_last_file(spark):
    df = spark.createDataFrame([
        ("FR", "f1", 1, "e1", 1, "D1"), ("FR", "f2", 2, "e1", 1, "D1"), ("FR", "f2", 2, "e1", 2, "D2"),
        ("FR", "f2", 2, "e2", 1, "D3"), ("BE", "g1", 5, "e9", 1, "D4")],
        "ent string, file string, ts int, emp string, upd int, dep string")
    last = windows.last_delivery_latest(df, ["ent"], ["emp"], "file", "ts", ["upd"], {"prev_dep": "dep"})
    assert rows(last, "ent", "emp", "dep", "versions_in_file", "prev_dep") == [
        ("BE", "e9", "D4", 1, None), ("FR", "e1", "D2", 2, "D1"), ("FR", "e2", "D3", 1, None)]


def test_sets_and_compare(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (3,)], "x int")
    r = sets.compare_tables(a, b).collect()[0]
    assert (r["left_rows"], r["right_rows"], r["left_only_distinct"], r["right_only_distinct"],
            r["left_only_rows"], r["right_only_rows"], r["identical"]) == (3, 2, 1, 1, 2, 1, False)
    l, rr = sets.except_both(a, b)
    assert rows(l, "x") == [(2,)] and rows(rr, "x") == [(3,)]
    u = sets.union_by_name([a, spark.createDataFrame([("z", 9)], "y string, x int")])
    assert u.columns == ["x", "y"] and u.count() == 4


def test_sql_node_params_and_tvf(spark):
    df = spark.createDataFrame([(1,), (5,)], "x int")
    out = run_sql(spark, "SELECT x, CAST(x AS STRING)::INT AS y FROM My_input WHERE x > :lo", {"My_input": df},
                  {"lo": 2})
    assert rows(out, "x") == [(5,)]
    assert table_function(spark, "SELECT count(*) AS n FROM __input__", df).collect()[0]["n"] == 2
    e = expression_select(df, ["x + 1 AS y"])
    assert e.columns == ["y", "x"]
    assert expression_select(df, []) is df


def test_classify(spark):
    df = spark.createDataFrame([(1, "Rendez-vous chez le médecin"), (2, "Mariage de ma soeur"),
                                (3, None), (4, "rien de spécial"), (5, "Rendez-vous chez le médecin")],
                               "id int, comment string")
    out = classify(df, "comment", HR_REASON_PATTERNS, "j")
    got = dict(rows(out.select("id", F.get_json_object("j", "$.response[0]").alias("l")), "id", "l"))
    assert got == {1: "santé", 2: "famille", 3: None, 4: "personnel", 5: "santé"}
    d = classify_distinct(df, "comment", HR_REASON_PATTERNS, "j")
    assert sorted(map(str, d.select("id", "j").collect())) == sorted(map(str, out.select("id", "j").collect()))


def test_percentiles_equal_sparks_own(spark):
    from medallion.operators.percentile import exact_percentiles
    l = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    ranks = [0.0, 0.37, 0.5, 0.9, 1.0]
    for segments in (1, 4, 50):
        a = dict(map(tuple, exact_percentiles(l, ["l_returnflag"], F.col("l_extendedprice"), ranks, segments=segments).collect()))
        b = dict(map(tuple, l.groupBy("l_returnflag").agg(F.percentile("l_extendedprice", ranks)).collect()))
        assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)
    both = [{"columnExpr": {"expr": "l_quantity"}, "fn": "MEDIAN", "alias": "m"},
            {"columnExpr": {"expr": "l_quantity"}, "fn": "PERCENTILE", "percentage": 0.9},
            {"columnExpr": {"expr": "l_quantity"}, "fn": "SUM", "alias": "s"}]
    out = aggregate(l, ["l_returnflag"], both)
    ref = l.groupBy("l_returnflag").agg(F.median("l_quantity").alias("m"), F.percentile("l_quantity", 0.9),
                                        F.sum("l_quantity").alias("s"))
    assert out.columns == ref.columns and sorted(map(tuple, out.collect())) == sorted(map(tuple, ref.collect()))
    assert aggregate(l, [], both).collect()[0]["m"] == l.agg(F.median("l_quantity")).collect()[0][0]
    nothing = aggregate(l.where("false"), [], both).collect()
    assert len(nothing) == 1 and nothing[0]["m"] is None and nothing[0]["s"] is None


def test_changes_from_snapshots(spark):
    s1 = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s2 = spark.createDataFrame([(1, "A"), (2, "b"), (3, "c")], "k int, v string")
    s3 = spark.createDataFrame([(1, "A"), (3, "c")], "k int, v string")
    ch = cdc.changes_from_snapshots([(2, s2), (1, s1), (3, s3)], ["k"])
    got = rows(ch, "_snapshot_version", "k", "_change_type")
    assert got == [(1, 1, "insert"), (1, 2, "insert"), (2, 1, "update_postimage"), (2, 1, "update_preimage"),
                   (2, 3, "insert"), (3, 2, "delete")]
    current = cdc.scd1(ch.where("_change_type <> 'update_preimage'"), ["k"], ["_snapshot_version"])
    assert rows(current.where("_change_type <> 'delete'"), "k", "v") == [(1, "A"), (3, "c")]


def test_graph_toposort_disabled_and_observed_counts(spark, tmp):
    from medallion.plans.graph import Node, observe_ports, row_counts, run_graph
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, s string")
    nodes = [  # deliberately out of order
        Node("agg", "aggregate", {"group_bys": [{"expr": "s"}], "aggregations": [
            {"columnExpr": {"expr": "id"}, "fn": "COUNT", "alias": "n"}]}, {"data": "f.filtered_data"}),
        Node("f", "filter", {"condition": "id > 1"}, {"data": "src.data"}),
        Node("src", "source", {"dataframe": df}),
    ]
    ctx = run_graph(spark, nodes)
    assert rows(ctx["agg.aggregated_data"], "s", "n") == [("b", 1), (None, 1)]
    obs = observe_ports(ctx, ["f.filtered_data", "f.excluded_data"])
    ctx["f.filtered_data"].write.parquet(f"{tmp}/kept")
    ctx["f.excluded_data"].write.parquet(f"{tmp}/dropped")
    assert obs["f.filtered_data"].get["rows"] == 2 and obs["f.excluded_data"].get["rows"] == 1
    counts = {r["port"]: r["rows"] for r in row_counts(ctx, ["f.filtered_data", "f.excluded_data"]).collect()}
    assert counts == {"filtered_data": 2, "excluded_data": 1}
    off = run_graph(spark, [Node("src", "source", {"dataframe": df}),
                            Node("f", "filter", {"condition": "id > 1"}, {"data": "src.data"}, disabled=True)])
    assert off["f.filtered_data"].count() == 0 and off["f.filtered_data"].columns == ["id", "s"]
    with pytest.raises(ValueError, match="cycle"):
        run_graph(spark, [Node("a", "filter", {}, {"data": "b.filtered_data"}),
                          Node("b", "filter", {}, {"data": "a.filtered_data"})])


def test_guardrails_and_column_checks(spark):
    from medallion.functions.columns import col_exact
    from medallion.operators.prepare import require_columns
    df = spark.createDataFrame([(1, "CDI"), (None, "Freelance")], "`a.b` int, contract string")
    r = quality.apply_expectations(df, [quality.not_null("a.b", "drop"),
                                        quality.accepted_values("contract", ["CDI", "CDD"], "warn")], "g")
    assert r.kept.count() == 1
    assert {x["rule"]: x["failed"] for x in r.metrics.collect()} == {"a.b_not_null": 1,
                                                                     "contract_accepted_values": 1}
    assert df.select(col_exact("a.b")).where("`a.b` = 1").count() == 1  # dotted name taken literally
    require_columns(df, ["a.b", "contract"])
    with pytest.raises(ValueError, match="not found"):
        require_columns(df, ["missing"])


def test_skew_safe_plans_combine_a_hot_key_in_every_task(spark):
    """SCD 1 is an aggregate; unique by any order and keep-latest limit a key's rows in every task before the shuffle."""
    hot = spark.range(0, 3000).select((F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))).alias("k"),
                                      F.col("id").alias("seq"), (F.col("id") % 5).cast("string").alias("v"))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    plans = [cdc.scd1(hot, ["k"], ["seq"]),
             unique(hot, ["k"], all_columns=False, sort=[("v", "DESC"), ("seq", "ASC")])]
    assert "Window" not in plan(plans[0])
    latest = windows.latest_per_key(hot, ["k"], ["seq"], previous={"pv": "v"})
    for df, limit, shuffles in ((plans[1], 1, 1), (latest, 2, 2)):
        assert re.search(rf"WindowGroupLimit .*row_number\(\), {limit}, Partial", plan(df))
        assert plan(df).count("Exchange hashpartitioning") == shuffles
    top = {r["k"]: r for r in latest.collect()}
    assert (top[7]["seq"], top[7]["v"], top[7]["pv"], top[7]["versions_in_file"]) == (2997, "2", "4", 1001)
    assert top[4]["pv"] is None and top[4]["versions_in_file"] == 1
    u = {r["k"]: (r["v"], r["seq"]) for r in plans[1].collect()}
    assert u[7] == ("4", 9)  # hot key: the largest text value, then the smallest seq
    ref = cdc.scd2(hot.withColumn("ts", F.timestamp_seconds("seq")), ["k"], ["ts"], ["v"], strategy="window")
    got = cdc.scd2(hot.withColumn("ts", F.timestamp_seconds("seq")), ["k"], ["ts"], ["v"])
    assert sets.compare_tables(got, ref).collect()[0]["identical"]
    numeric = [cdc.scd2(hot, ["k"], ["seq"], ["v"], strategy=s) for s in ("segments", "window")]
    assert sets.compare_tables(*numeric).collect()[0]["identical"]


def test_graph_output_node(spark, tmp):
    from medallion.plans.graph import Node, run_graph
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    upd = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    ctx = run_graph(spark, [
        Node("src", "source", {"dataframe": df}),
        Node("upd", "source", {"dataframe": upd}),
        Node("t", "output", {"root": tmp, "table": "kpi", "mode": "view", "comment": "demo"}, {"data": "src.data"}),
        Node("m", "output", {"root": tmp, "table": "kpi", "mode": "merge", "keys": ["k"]}, {"data": "upd.data"}),
        Node("e", "output", {"path": f"{tmp}/exp", "format": "csv", "split_by": "v"}, {"data": "src.data"}),
    ])
    assert rows(ctx["t.data"], "k", "v") == [(1, "a"), (2, "b")]
    assert rows(ctx["m.data"], "k", "v") == [(1, "a"), (2, "B"), (3, "c")]
    assert ctx["e.data"].count() == 2 and "file_group" in ctx["e.data"].columns
    with pytest.raises(ValueError, match="keys"):
        run_graph(spark, [Node("src", "source", {"dataframe": df}),
                          Node("x", "output", {"root": tmp, "table": "t2", "mode": "merge"}, {"data": "src.data"})])


def test_plan_shapes_for_scale(spark):
    import __spark_entry__ as E
    from medallion.plans.inspect import plan_summary
    sf = "/root/testdata/sf0.001"
    q = E.queries()
    split = plan_summary(q["split_filter_included"](spark, sf))
    assert any("GreaterThan(o_totalprice,100000.0)" in p for p in split["pushed_filters"])
    ytd = plan_summary(q["ytd_kpis"](spark, sf))
    assert any("GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p for p in ytd["pushed_filters"])
    assert all(s.count(":") <= 5 for s in ytd["read_schemas"])  # pruned columns, not whole tables
    master = plan_summary(q["master_join"](spark, sf))
    assert master["BroadcastHashJoin"] >= 2 and master["SortMergeJoin"] == 0
    for name in ("join_nway", "join_theta", "change_feed", "classify_distinct", "headcount"):
        s = plan_summary(q[name](spark, sf))
        assert s["CartesianProduct"] == 0 and s["BroadcastNestedLoopJoin"] == 0, name
        assert s["BatchEvalPython"] == 0 and s["ArrowEvalPython"] == 0, name  # no Python UDF in the plan


def test_unique_desc_keeps_nan_first_and_survives_the_least_integer(spark):
    df = spark.createDataFrame([(1, float("nan"), "nan"), (1, 5.0, "five"), (1, None, "null"), (2, None, "only")],
                               "k int, v double, s string")
    got = {r.k: r.s for r in unique(df, ["k"], False, [("v", "DESC")]).collect()}
    assert got == {1: "nan", 2: "only"}
    ints = spark.createDataFrame([(1, -2**31, "least"), (1, 7, "seven")], "k int, v int, s string")
    assert unique(ints, ["k"], False, [("v", "DESC")]).first().s == "seven"
    assert unique(ints, ["k"], False, [("v", "ASC")]).first().s == "least"
