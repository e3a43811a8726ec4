"""Streamed tables, atomic refresh, QUALIFY text, port counts, forecasts, CONCAT, EXCEPT and limits."""

import pytest
from pyspark.sql import functions as F

from medallion.operators.aggregate import aggregate
from medallion.operators.filter import all_except, limited
from medallion.operators.forecast import seasonal_forecast
from medallion.operators.quality import Expectation
from medallion.operators.sqlnode import run_sql, without_qualify
from medallion.plans.driver_extra import streamed_events
from medallion.plans.graph import Counts, Node, run_graph
from medallion.plans.streams import EVENTS, land_events
from medallion.sources.tables import FlowSpec
from medallion.streaming.flows import Pipeline, View, refresh_order
from medallion.streaming.tables import StreamedTable

SF = "/root/testdata/sf0.001"


def test_stream_over_a_table_reads_each_row_once(spark):
    bronze, silver, counts = streamed_events(spark, SF)
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert bronze.read().count() == events.count() == sum(c["rows"] for c in counts)
    assert 0 < counts[0]["rows"] < events.count()  # the second run saw only what came after the first
    assert sum(c["min_value"] for c in counts) == events.where("value < 2").count()
    again = silver.append("A", bronze.stream("A"))
    assert again["rows"] == 0 and silver.read().count() == events.where("value >= 2").count()


def test_failed_batch_leaves_no_rows_and_is_read_again(spark, tmp):
    source, target = StreamedTable(spark, f"{tmp}/source"), StreamedTable(spark, f"{tmp}/target")
    spark.createDataFrame([(1,), (None,)], "v int").write.parquet(f"{tmp}/rows")
    rows = spark.readStream.schema("v int").parquet(f"{tmp}/rows")
    source.append("one", rows)
    with pytest.raises(Exception, match="expectation failed"):
        target.append("one", source.stream("one"), [Expectation("known", "v IS NOT NULL", "fail")])
    kept = target.append("one", source.stream("one"), [Expectation("known", "v IS NOT NULL", "drop")])
    assert kept == {"rows": 2, "known": 1} and [r.v for r in target.read().collect()] == [1]


def test_interrupted_refresh_keeps_the_old_tables_until_it_is_done(spark, tmp, monkeypatch):
    plan = [(EVENTS, [FlowSpec("A", f"{tmp}/landing/entity=A/*")])]
    land_events(spark, SF, f"{tmp}/landing", 1)
    p, reader = Pipeline(spark, tmp), Pipeline(spark, tmp)
    p.run(plan)
    before = reader.catalog.read("silver_events").count()
    land_events(spark, SF, f"{tmp}/landing", 2)
    real = Pipeline._merge_cdc

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(Pipeline, "_merge_cdc", broken)
    with pytest.raises(Exception, match="lost"):
        p.full_refresh(plan)
    assert reader.catalog.read("silver_events").count() == before
    monkeypatch.setattr(Pipeline, "_merge_cdc", real)
    with pytest.raises(ValueError, match="full refresh"):
        p.run([])
    p.run(plan)  # completes the refresh
    events = spark.read.parquet(f"{SF}/events.parquet").where("value >= 2 AND event_type IN ('click', 'view', 'purchase')")
    assert reader.catalog.read("silver_events").count() == events.count() > before
    p.run(plan)  # nothing new
    assert reader.catalog.read("silver_events").count() == events.count()


@pytest.mark.parametrize("text", [
    "SELECT a FROM t", "SELECT 'QUALIFY' AS q FROM t -- QUALIFY x", "SELECT a FROM (SELECT a FROM t /* QUALIFY */) x"])
def test_text_without_the_clause_is_untouched(text):
    assert without_qualify(text) == text


def test_qualify_text(spark):
    t = spark.createDataFrame([(1, "x", 3), (1, "y", 2), (2, "z", None)], "a int, b string, c int")
    got = run_sql(spark, """WITH w AS (SELECT * FROM t) SELECT a, upper(b) AS b FROM w WHERE b <> 'FROM ('
                            qualify row_number() OVER (PARTITION BY a ORDER BY c DESC) = 1 AND a IN (SELECT 1 UNION SELECT 2)
                            ORDER BY a DESC LIMIT 5""".replace(" AND a IN (SELECT 1 UNION SELECT 2)", ""), {"t": t})
    assert [tuple(r) for r in got.collect()] == [(2, "Z"), (1, "X")]


def test_port_counts_take_one_scan(spark):
    df = spark.range(100).withColumn("v", F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(F.col("id")))
    counts, plans = Counts(), []

    def sink(out):
        out.write.format("noop").mode("overwrite").save()
        plans.append(out._jdf.queryExecution().executedPlan().toString())

    run_graph(spark, [Node("s", "source", {"dataframe": df}), Node("f", "filter", {"condition": "v < 50"}, {"data": "s.data"}),
                      Node("u", "unique", {}, {"data": "f.filtered_data"}),
                      Node("o", "output", {"sink": sink}, {"data": "u.unique_data"})], counts=counts)
    assert sorted(counts.rows()) == [("f", "excluded_data", 63), ("f", "filtered_data", 37), ("u", "unique_data", 37)]
    assert plans[0].split("Initial Plan")[0].count("Range (") == 1


def test_forecast_of_groups_with_gaps(spark):
    rows = [("a", i, float(i % 3)) for i in range(9) if i != 4] + [("b", 0, None), ("b", 1, 5.0), (None, 2, 7.0)]
    df = spark.createDataFrame(rows, "g string, s int, v double")
    got = {(r.g, r.s): r.forecast for r in seasonal_forecast(spark, df, "g", "s", "v", 3, 2).collect()}
    assert got == {("a", 9): 0.0, ("a", 10): 1.0, ("b", 2): None, ("b", 3): None, (None, 3): None, (None, 4): None}
    assert seasonal_forecast(spark, df.where("false"), "g", "s", "v", 3, 2).count() == 0


def test_concat_separators_nulls_and_order(spark):
    df = spark.createDataFrame([(1, 10), (1, 9), (1, None), (2, None)], "k int, v int")
    entry = {"columnExpr": {"expr": "v"}, "fn": "CONCAT", "alias": "x", "order": True}
    for separator in (" | ", "'", "\\", "\\'n"):
        got = dict(map(tuple, aggregate(df, ["k"], [{**entry, "separator": separator}]).collect()))
        assert got == {1: f"9{separator}10", 2: ""}


def test_except_and_limit(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "k int, `v.w` string")
    assert all_except(df, ["K"]).columns == ["v.w"]
    with pytest.raises(ValueError):
        all_except(df, ["nope"])
    assert [r.k for r in limited(df, 2, ["`v.w` DESC NULLS LAST"]).collect()] == [1, 3] and limited(df, 0).count() == 0


def test_views_come_after_what_they_read():
    def build(*_):
        return None

    views = {"c": View(("b", "stored"), build), "x": build, "b": View(("a", "x"), build), "a": View((), build)}
    assert refresh_order(views) == ["x", "a", "b", "c"]
    with pytest.raises(ValueError, match="circle"):
        refresh_order({"a": View(("b",), build), "b": View(("a",), build)})
