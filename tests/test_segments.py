"""Segments and what rests on them: hot keys of any order type, against plain Python and the per-key window."""

import random

import pytest
from pyspark.sql import functions as F

from medallion.operators import cdc, sets
from medallion.operators.segments import Segments
from medallion.sinks.tables import Table
from medallion.streaming.flows import CdcSpec, Pipeline


def history(rows):
    """SCD 2 by a loop: (k, v of the last row, start, end)."""
    out, by_key = [], {}
    for k, s, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        versions = by_key.setdefault(k, [])
        if versions and versions[-1][1] == v:
            continue
        if versions:
            versions[-1][3] = s
        versions.append([k, v, s, None])
    for versions in by_key.values():
        out += map(tuple, versions)
    return sorted(out, key=str)


def flat(df):
    return sorted(map(tuple, df.select("k", "v", "__START_AT.s", F.col("__END_AT.s").alias("e")).collect()), key=str)


def test_places_follow_the_order_and_split_a_hot_key(spark):
    df = spark.range(0, 5000, 1, 4).select(F.struct(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k")).alias("k"),
                                           F.struct(F.col("id").cast("string").alias("s")).alias("o"))
    placed = Segments(df, "k", "o", 40).place(df, "p", "x").collect()
    ranked = sorted(placed, key=lambda r: (r.k.k, r.o.s))
    assert [r.p for r in ranked] == sorted(r.p for r in placed)
    hot = {r.p for r in placed if r.k.k == 7}
    assert 8 < len(hot) < 25 and all(r.x for r in placed if r.k.k == 7)
    sizes = [sum(r.p == p for r in placed) for p in {r.p for r in placed}]
    assert 34 <= len(sizes) <= 41 and max(sizes) < 500


@pytest.mark.parametrize("tries", range(3))
def test_history_across_segments(spark, tries):
    rng = random.Random(tries)
    rows = [(rng.choice([None, "hot", "hot", "hot", *"abcdefgh"]), f"{i:05d}", rng.choice([None, "x", "x", "y"]))
            for i in range(1500)]
    rows += [("long", f"{i:05d}", "same") for i in range(600)]  # one version over many segments
    rows += [("ends", f"{i:05d}", "a" if i < 598 else "b") for i in range(600)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, s string, v string").repartition(4)
    for segments in (1, 2, 30):
        assert flat(cdc.scd2(df, ["k"], ["s"], ["v"], segments=segments)) == history(rows)


def test_identical_rows_and_last_values_of_a_version(spark):
    rows = [("k", 1, "a", "old")] * 400 + [("k", 2, "a", "new")] * 400 + [("k", 3, "b", "end")] * 400
    df = spark.createDataFrame(rows, "k string, s int, v string, other string").repartition(5)
    got = cdc.scd2(df, ["k"], ["s"], ["v"], segments=20)
    assert sets.compare_tables(got, cdc.scd2_window(df, ["k"], ["s"], ["v"])).collect()[0]["identical"]
    assert {(r.v, r.other, r["__START_AT"].s) for r in got.collect()} == {("a", "new", 1), ("b", "end", 3)}


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([("k", 1, "a")], "k string, s int, v string")
    assert cdc.scd2(df, ["k"], ["s"], ["v"]).count() == 1
    assert cdc.scd2(df.where("false"), ["k"], ["s"], ["v"]).count() == 0


def test_history_takes_two_shuffles_and_no_join(spark):
    df = spark.createDataFrame([("k", "1", "a")], "k string, s string, v string")
    plan = cdc.scd2(df, ["k"], ["s"], ["v"])._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert main.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_percentiles_of_cut_groups_frequent_values_and_nulls(spark):
    from medallion.operators.percentile import exact_percentiles
    rng = random.Random(4)
    rows = [("hot", rng.gauss(0, 1)) for _ in range(3000)] + [("hot", 0.25)] * 2000 + [(None, float(i % 7)) for i in range(500)]
    rows += [("few", 1.5), ("few", None), ("none", None), ("nan", float("nan")), ("nan", 1.0), ("nan", 2.0)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    ranks = [0.0, 0.013, 0.5, 0.999, 1.0]
    want = {r.k: r.p for r in df.where("v is not null").groupBy("k").agg(F.percentile("v", ranks).alias("p")).collect()}
    for segments in (1, 40):
        got = {r.k: r.percentiles for r in exact_percentiles(df, ["k"], F.col("v"), ranks, segments=segments).collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], nan_ok=True) for k in want)


def test_percentile_plan_carries_no_array_beside_rows(spark):
    from medallion.operators.percentile import exact_percentiles
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    out = exact_percentiles(df, ["k"], F.col("v"), [0.5])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "percentile_approx" not in plan and "lambda" not in plan.split("Subquery")[0]
    assert "ReusedExchange" in plan  # the shuffle of the counts serves the pieces' sums as well


def test_bounds_from_the_table_that_the_rows_are_part_of(spark):
    rows = [(i % 40, i, "abc"[i // 7 % 3]) for i in range(3000)]
    table = spark.createDataFrame(rows, "k int, t int, v string")
    part = table.where("k < 11")
    want = sorted(map(str, cdc.scd2(part, ["k"], ["t"], ["v"], strategy="window").collect()))
    for near in (table, table.where("false"), table.where("k = 39")):
        got = cdc.scd2(part, ["k"], ["t"], ["v"], segments=16, near=near)
        assert sorted(map(str, got.collect())) == want


def test_histories_computed_anew_take_no_bounds_from_a_join(spark, tmp):
    silver = Table(spark, f"{tmp}/silver", bucket_by=["k"], buckets=2)
    silver.append(spark.createDataFrame([(i % 5, i, "ab"[i % 2]) for i in range(60)], "k int, t int, v string"))
    spec = CdcSpec("history", ["k"], ["t"], 2, ["v"])
    batch = silver.read().where("k < 3")
    rebuilt = Pipeline._rebuilt(silver, spec, silver, batch, [0, 1], ["v"], None)
    assert rebuilt._jdf.queryExecution().optimizedPlan().toString().count("Join LeftSemi") == 1
    want = cdc.scd2(batch, ["k"], ["t"], ["v"])
    assert sorted(map(str, rebuilt.collect())) == sorted(map(str, want.collect()))
