"""Latest delivery and keep-latest with version counts and previous values.

The two newest rows of a key come from a ranked window whose filter Spark turns into a limit of two rows for each key
in every task before the shuffle (``WindowGroupLimit``), and once more after it: a key with a third of all rows sends two
rows from each task.  Its number of rows is a count that is pre-combined likewise.  The keys travel as one struct, so that
both parts are partitioned alike, meet without another shuffle, and NULL keys are equal.  The newest file comes from a
declarative aggregate and meets the rows in a null-safe equi-join (broadcast by adaptive execution when small,
skew-split otherwise).

Order values are structs ``(order columns..., tie-break)``: ``updated_at`` ties are broken by a stable
row hash instead of arbitrarily.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.functions.columns import null_safe_join, quote_ident


def _q(name: str) -> Column:
    return F.col(quote_ident(name))


def order_key(order: list[str], df: DataFrame, tie_break: bool = True) -> Column:
    parts = [_q(c).alias(f"o{i}") for i, c in enumerate(order)]
    if tie_break:
        parts.append(F.xxhash64(*[_q(c) for c in df.columns]).alias("h"))
    return F.struct(*parts)


def last_file(df: DataFrame, entity: list[str], file_col: str, order_col: str) -> DataFrame:
    """Per entity, the file holding the greatest ``order_col`` (A14); ties go to the greatest file name."""
    return (df.groupBy(*[_q(e) for e in entity])
            .agg(F.max_by(_q(file_col), F.struct(_q(order_col), _q(file_col))).alias("last_source_file")))


def rows_of_last_file(df: DataFrame, entity: list[str], file_col: str, order_col: str) -> DataFrame:
    """Rows that belong to their entity's newest file (J2: inner join on entity and file).

    The join key has only a few values (one file per entity).  Adaptive execution broadcasts the per-entity table
    once its measured size allows it, and splits the skewed partitions of the shuffle join otherwise.
    """
    lf = last_file(df, entity, file_col, order_col).withColumnRenamed("last_source_file", file_col)
    return null_safe_join(df, lf, entity + [file_col], "inner")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], count_as: str | None = "versions_in_file",
                   previous: dict[str, str] | None = None) -> DataFrame:
    """One row per key: the newest by ``order``, with the number of rows of the key and values of the
    previous row (``previous = {output_name: column}``; NULL when the key has a single row).
    """
    previous = previous or {}
    x = df.select("*", F.struct(*[_q(k) for k in keys]).alias("__k"), order_key(order, df).alias("__ok"))
    kept = F.struct(*[_q(c) for c in df.columns if c != count_as and c not in previous])
    if not previous:  # the newest row and the count are one aggregate
        out = x.groupBy("__k").agg(F.max_by(kept, "__ok").alias("__row"), F.count(F.lit(1)).alias("__n"))
    else:
        newest_first = Window.partitionBy("__k").orderBy(F.desc("__ok"))
        top = x.select("*", F.row_number().over(newest_first).alias("__rank")).where(F.col("__rank") <= 2)
        second = F.struct(*[_q(column).alias(f"p{i}") for i, column in enumerate(previous.values())])
        out = top.groupBy("__k").agg(F.first(F.when(F.col("__rank") == 1, kept), ignorenulls=True).alias("__row"),
                                     F.first(F.when(F.col("__rank") == 2, second), ignorenulls=True).alias("__p"))
        if count_as:
            out = out.join(x.groupBy("__k").agg(F.count(F.lit(1)).alias("__n")), "__k")
    count = [F.col("__n").alias(count_as)] if count_as else []
    return out.select("__row.*", *count, *[F.col(f"__p.p{i}").alias(name) for i, name in enumerate(previous)])


def last_delivery_latest(df: DataFrame, entity: list[str], key: list[str], file_col: str, file_order: str,
                         version_order: list[str], previous: dict[str, str] | None = None) -> DataFrame:
    """The last-extract view: newest file per entity, one row per (entity, key) in it, with
    ``versions_in_file`` and previous values."""
    newest = rows_of_last_file(df, entity, file_col, file_order)
    return latest_per_key(newest, entity + key, version_order, "versions_in_file", previous)


def corrections(latest: DataFrame, sort: list[Column], k: int = 20) -> DataFrame:
    """Version-change report (W6): keys corrected inside the file, newest first, top ``k``."""
    return latest.where(F.col("versions_in_file") > 1).orderBy(*sort).limit(k)
