"""Exact percentiles with linear interpolation (A3, A6): counts by (group, value) in segments, then the wanted segments.

1. Rows are counted by (group, value), pre-combined in every task, so a frequent value is one row of each task.  Every
   value has its place among sampled bounds (see ``segments.py``): a group of ordinary size is one piece, a hot group many.
2. Sums of the pieces' counts, running totals over a group's few pieces, tell which pieces hold the ranks
   floor(p (n - 1)) and ceil(p (n - 1)) of each wanted p.
3. Only the counts of these pieces are sorted, and the values at the ranks are read off.

Nothing grows beside the rows, no group is held in one task, and the plan is the same for all sizes: one scan besides
the sample of the bounds; the shuffle of the counts serves both steps.  Values are compared and returned as doubles, as
Spark's own percentile does (NaN is the greatest).
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.operators.segments import Segments


def exact_percentiles(df: DataFrame, keys: list[str], value: Column, ranks: list[float], out: str = "percentiles",
                      segments: int | None = None) -> DataFrame:
    """``keys`` and ``out``: an array with the percentile of ``value`` for each of ``ranks``.  Groups whose values are
    all NULL are absent."""
    base = df.select(F.struct(*keys).alias("__k"), F.struct(value.cast("double").alias("v")).alias("__o")) \
        .where("__o.v is not null")
    counted = Segments(base, "__k", "__o", segments).place(base, "__p", "__x") \
        .groupBy("__k", "__p", F.col("__o.v").alias("__v")).agg(F.count("*").alias("__n"))
    whole = Window.partitionBy("__k")
    pieces = counted.groupBy("__k", "__p").agg(F.sum("__n").alias("__t")) \
        .select("__k", "__p", F.sum("__t").over(whole).alias("__size"),
                (F.sum("__t").over(whole.orderBy("__p")) - F.col("__t")).alias("__first"),
                F.sum("__t").over(whole.orderBy("__p")).alias("__end"))
    exact = [F.lit(float(p)) * (F.col("__size") - 1) for p in ranks]

    def holds(place: Column) -> Column:
        return (place >= F.col("__first")) & (place < F.col("__end"))

    wanted = pieces.where(reduce(or_, (holds(f(x)) for x in exact for f in (F.floor, F.ceil)))).drop("__end")
    by_value = Window.partitionBy("__k", "__p").orderBy("__v")
    spans = counted.join(wanted, ["__k", "__p"]) \
        .withColumn("__end", F.col("__first") + F.sum("__n").over(by_value)) \
        .select("__k", "__v", "__size", "__end", (F.col("__end") - F.col("__n")).alias("__first"))
    picks = [F.max(F.when(holds(f(x)), F.col("__v"))).alias(f"__{name}{i}")
             for i, x in enumerate(exact) for name, f in (("low", F.floor), ("high", F.ceil))]
    found = spans.groupBy("__k", "__size").agg(*picks)
    results = [F.when(x == F.floor(x), F.col(f"__low{i}")).otherwise(
        F.col(f"__low{i}") + (x - F.floor(x)) * (F.col(f"__high{i}") - F.col(f"__low{i}"))) for i, x in enumerate(exact)]
    return found.select("__k.*", F.array(*results).alias(out))
