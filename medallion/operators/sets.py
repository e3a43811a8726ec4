"""Set operators and table comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions.columns import quote_ident


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """Positional UNION ALL."""
    return reduce(lambda a, b: a.union(b), dfs)


def union_by_name(dfs: list[DataFrame], allow_missing: bool = True) -> DataFrame:
    """UNION ALL aligned by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def except_both(a: DataFrame, b: DataFrame, multiset: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows of ``a`` not in ``b`` and of ``b`` not in ``a`` — distinct (EXCEPT) or multiset (EXCEPT ALL)."""
    if multiset:
        return a.exceptAll(b), b.exceptAll(a)
    return a.subtract(b), b.subtract(a)


def compare_tables(a: DataFrame, b: DataFrame, name: str = "table") -> DataFrame:
    """One-row comparison report (U4) computed in a single aggregation over both inputs.

    Rows of each side are tagged and grouped by all columns; per distinct row the two multiplicities give
    row counts, distinct EXCEPT counts in both directions, multiset differences and an equality flag.
    """
    cols = [quote_ident(c) for c in a.columns]
    tagged = (a.select(*cols, F.lit(1).alias("__a"), F.lit(0).alias("__b"))
              .unionByName(b.select(*cols, F.lit(0).alias("__a"), F.lit(1).alias("__b"))))
    per_row = tagged.groupBy(*cols).agg(F.sum("__a").alias("na"), F.sum("__b").alias("nb"))
    return per_row.agg(
        F.lit(name).alias("table_name"),
        F.sum("na").cast("long").alias("left_rows"),
        F.sum("nb").cast("long").alias("right_rows"),
        F.count_if((F.col("na") > 0) & (F.col("nb") == 0)).cast("long").alias("left_only_distinct"),
        F.count_if((F.col("nb") > 0) & (F.col("na") == 0)).cast("long").alias("right_only_distinct"),
        F.sum(F.greatest(F.col("na") - F.col("nb"), F.lit(0))).cast("long").alias("left_only_rows"),
        F.sum(F.greatest(F.col("nb") - F.col("na"), F.lit(0))).cast("long").alias("right_only_rows"),
    ).withColumn("same_count", F.col("left_rows") == F.col("right_rows")) \
     .withColumn("identical", (F.col("left_only_rows") == 0) & (F.col("right_only_rows") == 0))
