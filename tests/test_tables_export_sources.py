import json
import os

import pytest
from pyspark.sql import functions as F

from medallion.sinks import export
from medallion.sinks.tables import Catalog, Table, validate_table_name
from medallion.sources.files import parse_json_lines, read_files, read_json_batch
from medallion.sources.tables import PipelineConfig, table_source


def test_table_versions_merge_and_txn(spark, tmp):
    t = Table(spark, os.path.join(tmp, "t"), bucket_by=["k"], buckets=4)
    t.overwrite(spark.createDataFrame([(i, f"v{i}") for i in range(20)], "k int, v string"),
                comment="demo", properties={"quality": "gold"})
    t.merge(spark.createDataFrame([(1, "new"), (100, "ins")], "k int, v string"), ["k"], txn=("w", 0))
    t.merge(spark.createDataFrame([(1, "again")], "k int, v string"), ["k"], txn=("w", 0))  # replay: skipped
    got = {r["k"]: r["v"] for r in t.read().collect()}
    assert len(got) == 21 and got[1] == "new" and got[100] == "ins"
    assert t.read(version=0).count() == 20  # time travel
    assert t.manifest().comment == "demo" and t.manifest().properties == {"quality": "gold"}
    with pytest.raises(ValueError, match="duplicate keys"):
        t.merge(spark.createDataFrame([(5, "a"), (5, "b")], "k int, v string"), ["k"])
    ops = [r["operation"] for r in t.history().orderBy("version").collect()]
    assert ops == ["CREATE", "MERGE"]
    d = t.detail().collect()[0]
    assert d["num_files"] >= 1 and d["size_in_bytes"] > 0


def test_append_by_name_and_clustering(spark, tmp):
    t = Table(spark, os.path.join(tmp, "a"), cluster_by=["k"])
    t.append(spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string"))
    t.append(spark.createDataFrame([("c", 3)], "v string, k int"))
    t.append(spark.createDataFrame([(4,)], "k int"))
    assert sorted(map(tuple, t.read().collect()), key=str) == [(1, "a"), (2, "b"), (3, "c"), (4, None)]
    with pytest.raises(ValueError, match="not in the target"):
        t.append(spark.createDataFrame([(5, 1)], "k int, extra int"))
    t.set_comment("commented", {"owner": "hr"})
    assert t.manifest().properties["owner"] == "hr"
    c = Catalog(spark, os.path.join(tmp, "cat"))
    c.refresh("mv_demo", spark.range(3))
    assert c.view("mv_demo").count() == 3 and spark.table("mv_demo").count() == 3
    for bad in ["", "cat..t", "a.b.c.d"]:
        with pytest.raises(ValueError):
            validate_table_name(bad)


def test_csv_rendering_guard_and_single_file_limits(spark, tmp):
    df = spark.createDataFrame(
        [(1, True, float("nan"), "=SUM(A1)", "2024-01-02 03:04:05", "2024-01-02 03:04:05.000123")],
        "i int, b boolean, d double, s string, t1 string, t2 string") \
        .withColumn("t1", F.col("t1").cast("timestamp")).withColumn("t2", F.col("t2").cast("timestamp"))
    r = export.rendered(df).collect()[0]
    assert (r["i"], r["b"], r["d"], r["s"], r["t1"], r["t2"]) == \
        ("1", "True", "nan", "'=SUM(A1)", "2024-01-02 03:04:05", "2024-01-02 03:04:05.000123")
    path = os.path.join(tmp, "one")
    export.export_csv(df, path, single_file=True)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    old = export.MAX_ROWS
    export.MAX_ROWS = 0
    try:
        with pytest.raises(ValueError, match="write to a table instead"):
            export.export_csv(df, os.path.join(tmp, "two"), single_file=True)
    finally:
        export.MAX_ROWS = old
    with pytest.raises(ValueError):
        export.validate_name("../x")
    assert export.validate_name("report.csv") == "report.csv"


def test_split_export_and_append_checks(spark, tmp):
    df = spark.createDataFrame([(1, "a/b"), (2, "ab"), (3, None), (4, "a/b")], "id int, g string")
    path = os.path.join(tmp, "split")
    export.export_split(df, path, "g", fmt="json")
    names = sorted(d for d in os.listdir(path) if d.startswith(export.GROUP_COL))
    assert names == ["file_group=ab", "file_group=ab_2", "file_group=none"]
    export.export_split(df.where("id = 2"), path, "g", fmt="json")  # overwrite drops stale groups
    assert sorted(d for d in os.listdir(path) if d.startswith(export.GROUP_COL)) == ["file_group=ab"]
    export.export_split(df, path, "g", fmt="json", mode="append")  # a/b comes to ab: the stored name stays with ab
    got = {(r.id, r[export.GROUP_COL]) for r in spark.read.json(path).collect()}
    assert got == {(2, "ab"), (1, "ab_2"), (4, "ab_2"), (3, "none")} and spark.read.json(path).count() == 5
    with pytest.raises(ValueError, match="more than 2 groups"):
        export.export_split(df, os.path.join(tmp, "s2"), "g", max_groups=2)
    with pytest.raises(ValueError, match="only scalar"):
        export.export_split(df.select("id", F.array("g").alias("arr")), os.path.join(tmp, "s3"), "arr")
    jp = os.path.join(tmp, "j")
    export.export_json(df, jp)
    export.export_json(df.select("g", "id"), jp, mode="append")  # reordered: aligned to the header
    with pytest.raises(ValueError, match="differ"):
        export.export_json(df.select("id"), jp, mode="append")
    assert spark.read.json(jp).count() == 8


def test_rescue_unknown_wrong_typed_and_malformed(spark, tmp):
    land = os.path.join(tmp, "land")
    os.makedirs(land)
    with open(os.path.join(land, "a.json"), "w") as f:
        f.write(json.dumps({"id": 1, "x": 2.5}) + "\n")
        f.write(json.dumps({"id": 2, "x": "oops", "extra": "e"}) + "\n")
        f.write("not json at all\n")
    from pyspark.sql import types as T
    schema = T.StructType.fromDDL("id long, x double")  # the schema persisted from earlier files
    df = read_json_batch(spark, land, "FR", schema)
    rows = {(r["id"], r["x"], r["_rescued_data"]) for r in df.collect()}
    assert (1, 2.5, None) in rows
    rescued = {r[0]: r[2] for r in rows}
    assert json.loads(rescued[2]) == {"x": "oops", "extra": "e"}
    assert json.loads(rescued[None]) == {"_line": "not json at all"}
    assert df.where("source_entity = 'FR' AND _source_file LIKE '%a.json'").count() == 3


def test_read_files_options_and_sources(spark, tmp):
    p = os.path.join(tmp, "c")
    spark.createDataFrame([(1, "x")], "a int, b string").write.option("header", True).csv(p)
    df = read_files(spark, p, "csv", headerRows=1, inferSchema=True, sep="','")
    assert df.columns == ["a", "b"] and df.collect()[0]["a"] == 1
    with pytest.raises(ValueError):
        read_files(spark, p, "xlsx")
    spark.range(5).createOrReplaceTempView("five")
    assert table_source(spark, "five").count() == 5
    assert table_source(spark, "SELECT id FROM five WHERE id > 2", is_expression=True).count() == 2
    mv = table_source(spark, "five", metric_view={"dimensions": [], "measures": ["n"]}, measures={"n": "COUNT(*)"})
    assert mv.collect()[0]["n"] == 5
    spark.conf.set("medallion.root", tmp)
    spark.conf.set("medallion.as_of", "2026-01-01")
    spark.conf.set("medallion.employees.FR", "/landing/fr")
    cfg = PipelineConfig.from_conf(spark)
    assert cfg.root == tmp and cfg.as_of == "2026-01-01"
    assert [(f.entity, f.path) for f in cfg.employee_flows()] == [("FR", "/landing/fr")]


def test_optimize_compacts_small_segments(spark, tmp):
    t = Table(spark, os.path.join(tmp, "o"), bucket_by=["k"], buckets=2)
    for i in range(5):
        t.append(spark.createDataFrame([(i, f"v{i}"), (i + 10, "w")], "k int, v string"))
    before = sorted(map(tuple, t.read().collect()))
    n_before = len(t.manifest().entries)
    assert t.optimize(min_segments=3) == n_before
    assert len(t.manifest().entries) <= 2
    assert sorted(map(tuple, t.read().collect())) == before
    assert sorted(map(tuple, t.read(version=t.version() - 1).collect())) == before
    assert t.optimize(min_segments=3) == 0  # nothing small left to merge


def test_concurrent_bucket_rewrite_is_refused(spark, tmp):
    t = Table(spark, os.path.join(tmp, "cc"), bucket_by=["k"], buckets=2)
    t.overwrite(spark.createDataFrame([(i, "a") for i in range(10)], "k int, v string"))
    base = t.version()
    t.merge(spark.createDataFrame([(1, "first writer")], "k int, v string"), ["k"])
    stale = t.read(version=base)
    buckets = sorted({e["bucket"] for e in t.manifest().entries})
    with pytest.raises(RuntimeError, match="another writer"):
        t.replace_buckets(stale, buckets, base_version=base)
    assert {r["k"]: r["v"] for r in t.read().collect()}[1] == "first writer"


def test_optimize_unbucketed(spark, tmp):
    t = Table(spark, os.path.join(tmp, "u"))
    for i in range(4):
        t.append(spark.range(i * 10, i * 10 + 10).withColumnRenamed("id", "k"))
    assert t.optimize(min_segments=2) == 4 and len(t.manifest().entries) == 1
    assert sorted(r[0] for r in t.read().collect()) == list(range(40))


def test_hot_bucket_is_split_across_writers(spark, tmp):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        hot = spark.range(0, 200000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                            F.col("id").alias("v"))
        t = Table(spark, os.path.join(tmp, "hot"), bucket_by=["k"], buckets=4)
        t.overwrite(hot)
        hot_bucket = [e for e in t.manifest().entries]
        files = {e["bucket"]: len([f for f in os.listdir(e["path"]) if f.endswith(".parquet")]) for e in hot_bucket}
        assert max(files.values()) > 1  # the bucket holding key 7 (a third of the rows) has several writers
        assert t.read().count() == 200000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_merge_upsert_where_an_added_key_meets_a_changed_one(spark, tmp):
    from medallion.plans.streams import q_merge_upsert

    def rows(parts):
        spark.createDataFrame([(k, f"part {k}", "b", "t", size, 10.0) for k, size in parts],
                              "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
                              "p_retailprice double").write.mode("overwrite").parquet(f"{tmp}/part.parquet")
        return sorted(tuple(r) for r in q_merge_upsert(spark, tmp).select("p_partkey", "p_size", "p_retailprice").collect())

    assert rows([(1, 1), (2, 20), (1_000_001, 45), (1_000_002, 20), (3, 2), (1_000_003, 30)]) == [
        (1, 1, 10.0), (2, 20, 10.0), (3, 2, 10.0), (1_000_001, 1, 10.0), (1_000_001, 45, 11.0), (1_000_002, 20, 10.0),
        (1_000_003, 2, 10.0)]
    with pytest.raises(ValueError, match="duplicate keys"):
        rows([(7, 45), (7, 45)])


def test_rescue_looks_up_each_key_once(spark):
    lines = ['{"a": 1, "b": "x", "c": null}', '{"a": "n/a", "b": null, "z": 5}', '{"b": "y", "q": null}', "no json", "{}"]
    names = [f"f{i}" for i in range(12)]
    schema = spark.createDataFrame([], "a int, b string, c double, " + ", ".join(f"{n} int" for n in names)).schema
    df = parse_json_lines(spark.createDataFrame([(s,) for s in lines], "line string"), "line", schema)
    got = [(r.a, r.b, json.loads(r._rescued_data) if r._rescued_data else None) for r in df.collect()]
    assert got == [(1, "x", None), (None, None, {"a": "n/a", "z": "5"}), (None, "y", None), (None, None, {"_line": "no json"}),
                   (None, None, None)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "array_contains" in plan and plan.count("lambdafunction(CASE WHEN") == 0
