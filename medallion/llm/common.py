"""Shared pieces of the training-data operators: table access, folds, checkpoints, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.session import checkpoint_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo n (null for a null key)."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there, so that a lost executor costs a
    read instead of the work before.  The files go when the frame does, where the cluster cleans checkpoints."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def vocabulary_copy(spark: SparkSession, path: str):
    """The bytes of a small driver-side model file as a broadcast, so executors need no such file."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


HEAVY = 1024


def heavy_keys(sizes: DataFrame, key: str, n: str, heavy: int = HEAVY) -> DataFrame:
    """Of ``sizes`` (one row for each key, its number of rows in ``n``) those keys that hold more than a ``heavy``-th
    of all rows: fewer than ``heavy`` of them by counting, so they can be broadcast."""
    total = sizes.agg(F.sum(n)).first()[0] or 0
    return sizes.where(F.col(n) > total // heavy)


def sums_beside(rows: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over their key in ``out`` (null keys are one key).  Sums are added in every
    task before the shuffle; heavy keys meet their rows by broadcast, the others by a join that no key can load."""
    sums = cut(rows.groupBy(key).agg(F.sum(value).alias(out), F.count("*").alias("__n"))
               .withColumnRenamed(key, "__key"))
    heavy = heavy_keys(sums, "__key", "__n")
    some = F.broadcast(heavy.select(F.col("__key").alias("__heavy"), F.col(out).alias("__sum")))
    rows = rows.join(some, F.col(key).eqNullSafe(F.col("__heavy")), "left").drop("__heavy")
    # a row that has its sum goes anywhere in the second join: its key is a number that no light key has
    salted = F.when(F.col("__sum").isNull(), F.xxhash64(key)).otherwise(F.xxhash64(*rows.columns))
    light = F.when(F.col("__sum").isNull(), F.col(key))
    light_sums = sums.join(heavy.select("__key"), sums["__key"].eqNullSafe(heavy["__key"]), "left_anti") \
        .select("__key", out, F.xxhash64("__key").alias("__hash"))
    on = (F.col("__salted") == F.col("__hash")) & F.col("__light").eqNullSafe(F.col("__key")) & F.col("__sum").isNull()
    return rows.withColumns({"__salted": salted, "__light": light}).join(light_sums, on, "left") \
        .withColumn(out, F.coalesce("__sum", out)).drop("__sum", "__salted", "__light", "__key", "__hash")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected graph: (node, component), component = smallest node reachable.

    Alternating large-star / small-star steps: every step is a grouped minimum (pre-combined in each task) and
    a join on the node, which adaptive execution splits where one node has very many neighbours.  Each step's
    edges are checkpointed; the number of steps grows with the logarithm of the longest path.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e, state = cut(e), None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        joined = e.join(low, "u")
        e = (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        e = cut(e)
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == state:
            break
        state = now
    return e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component") \
        .unionByName(e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component")))


def give_back() -> None:
    """Return freed memory to the system.  Python workers are reused by later stages beside a busy JVM, so a task
    that used large arrays or a cache calls this when it ends."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def runs(batches, n_keys: int):
    """Consecutive rows with equal values in the first ``n_keys`` columns, as one Arrow table for each run.
    For partitions that are sorted by those columns; holds one run and one batch at a time."""
    import pyarrow as pa

    held, held_key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(n_keys))))
        begin = 0
        for end in [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]] + [len(keys)]:
            if held and keys[begin] != held_key:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
            held_key, begin = keys[begin], end
    if held:
        yield held_key, pa.Table.from_batches(held)
