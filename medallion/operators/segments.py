"""Segments: a sorted whole cut at sampled bounds, so that ordered work on a hot key is spread over tasks.

Windows by key alone send all rows of a key to one task.  Here rows get a place among bounds of (key, order): a key of
ordinary size lies in one segment, two at most where a bound falls into it, and a hot key of any order type - text,
structs, times - in as many as its share of the rows asks for.  Windows then run by (key, segment), and what crosses a
bound is carried over by the first and last results of each piece, at most two rows for each bound.

The bounds are every ``PER``-th of a uniform sample, taken by scalar subqueries (a count, then the sample) when the query
runs: planning starts no job, and a task sends on its share of the sample alone.  Their number follows
``spark.sql.shuffle.partitions``.  A row finds its place by binary search in generated code, a projection for each
halving.  Bounds decide how rows are dealt, never a result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions.columns import quote_ident

PER = 16  # sampled rows for each bound


class Segments:
    """Bounds of ``key`` and ``order`` (two struct columns of ``df``) and the segments that they cut.  ``near``: another
    frame with these columns from which the bounds are taken, for a ``df`` whose count and sample cost a join."""

    def __init__(self, df: DataFrame, key: str, order: str, segments: int | None = None, near: DataFrame | None = None):
        self.key, self.order = key, order
        self.n = segments or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df if near is None else near
        rows = df.agg(F.count(F.lit(1))).scalar()
        sample = df.where(F.rand(17) * rows < self.n * PER).select(F.struct(F.col(key).alias("k"), F.col(order).alias("o")).alias("v"))
        self.bounds = sample.agg(F.sort_array(F.collect_list("v")).alias("v")) \
            .select(F.slice(F.filter("v", lambda _, i: i % PER == PER - 1), 1, self.n)).scalar()

    def place(self, df: DataFrame, place: str, crosses: str) -> DataFrame:
        """``df`` with each row's segment in ``place``, the number of bounds that are not above the row, and in
        ``crosses`` whether a bound of that segment lies within the row's key, so that the key may go on beside it."""
        value = F.struct(F.col(self.key).alias("k"), F.col(self.order).alias("o"))
        steps = [F.lit(0)]  # one select, whose later columns refer to earlier ones: a projection for each halving
        for i in reversed(range(max(self.n - 1, 0).bit_length() + 1)):
            at = F.col(f"__s{len(steps) - 1}")
            inside = F.get("__bounds", at + F.lit((1 << i) - 1)) <= value  # NULL beyond the last bound
            steps.append(F.when(inside, at + F.lit(1 << i)).otherwise(at))
        at = F.col(f"__s{len(steps) - 1}")
        beside = [F.get("__bounds", at + i).getField("k").eqNullSafe(F.col(self.key)) for i in (-1, 0)]
        found = df.select("*", self.bounds.alias("__bounds"), *[s.alias(f"__s{i}") for i, s in enumerate(steps)],
                          (((at > 0) & beside[0]) | ((at < F.size("__bounds")) & beside[1])).alias(crosses))
        return found.select(*[F.col(quote_ident(c)) for c in df.columns], at.alias(place), crosses)
