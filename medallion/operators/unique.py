"""Unique (O4, O5, W4): one row per key, optionally the first by a sort order.

Without a sort, and where the sort fits one ascending struct, the plan is an aggregate: ``min_by(row, order_key)`` has a
map-side partial step.  Any other sort (DESC on text or numbers) is a ranked window that Spark limits to one row for
each key in every task before the shuffle (``WindowGroupLimit``).  Either way a key holding a third of the rows is one
row of each task.
Ties are broken by input order (a hidden ``monotonically_increasing_id``), which makes the choice stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.functions.columns import as_column, quote_ident, struct_order_key


def _free(df: DataFrame, base: str) -> str:
    name = base
    while name in df.columns:
        name += "_"
    return name


def unique(df: DataFrame, columns: list[str] | None = None, all_columns: bool = True,
           sort: list[tuple] | None = None, keep_input_order: bool = False) -> DataFrame:
    """Deduplicate on ``columns`` (all columns by default).

    ``sort``: ``[(expr, 'ASC'|'DESC')]`` with NULLS LAST; the first row per key in that order is kept,
    ties by input order.  Without ``sort`` the first row in input order is kept.  ``keep_input_order``
    re-sorts the result by input order (a global sort — off unless a consumer needs it).
    """
    cols = list(df.columns) if all_columns else [c for c in (columns or []) if isinstance(c, str)]
    if not cols:
        return df
    if all_columns:
        return df.dropDuplicates(cols)
    idx = _free(df, "__input_order")
    tagged = df.withColumn(idx, F.monotonically_increasing_id())
    keys = [(e, d) for e, d in (sort or []) if e]
    order = struct_order_key(keys + [(idx, "ASC")], tagged.schema)
    if order is not None:
        row = F.struct(*[F.col(quote_ident(c)) for c in tagged.columns])
        best = (tagged.groupBy(*[F.col(quote_ident(c)) for c in cols])
                .agg(F.min_by(row, order).alias("__row"))
                .select("__row.*"))
    else:
        first = Window.partitionBy(*[F.col(quote_ident(c)) for c in cols]).orderBy(
            *[(as_column(e).desc_nulls_last() if str(d).upper() == "DESC" else as_column(e).asc_nulls_last())
              for e, d in keys], F.col(idx))
        place = _free(tagged, "__place")
        best = tagged.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).drop(place)
    if keep_input_order:
        best = best.orderBy(idx)
    return best.drop(idx)
