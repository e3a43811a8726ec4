"""Split filter (P1/P2), star, EXCEPT and limit (P3, O3) and node disabling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions.columns import as_column, quote_ident


def split_filter(df: DataFrame, condition) -> dict[str, DataFrame]:
    """Rows where ``condition`` is TRUE go to ``filtered_data``; FALSE *and NULL* go to ``excluded_data``.

    An empty condition keeps everything and returns an empty (same-schema) excluded port.  Both ports are
    plain filters over the same input, so each stays a single scan with the predicate pushed to the source.
    """
    if condition is None or (isinstance(condition, str) and not condition.strip()):
        return {"filtered_data": df, "excluded_data": df.limit(0)}
    cond = as_column(condition)
    # WHERE already drops NULL, so the kept port is a plain filter the scan can push down;
    # the excluded port is "not TRUE" (FALSE or NULL)
    return {"filtered_data": df.filter(cond), "excluded_data": df.filter(~F.coalesce(cond, F.lit(False)))}


def split_counts(df: DataFrame, condition, observation) -> DataFrame:
    """``df`` whose next action also counts what a split by ``condition`` keeps and excludes."""
    cond = F.lit(True) if condition is None or str(condition).strip() == "" else as_column(condition)
    kept = F.coalesce(cond, F.lit(False))
    return df.observe(observation, F.count_if(kept).alias("filtered_data"), F.count_if(~kept).alias("excluded_data"))


def all_except(df: DataFrame, columns: list[str]) -> DataFrame:
    """``SELECT * EXCEPT (columns)``: names without regard to letter case; one that isn't there is an error."""
    known = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in known]
    if missing:
        raise ValueError(f"except: no columns {missing}")
    gone = {c.lower() for c in columns}
    return df.select(*[F.col(quote_ident(c)) for c in df.columns if c.lower() not in gone])


def limited(df: DataFrame, n: int, order: list | None = None) -> DataFrame:
    """The first ``n`` rows by ``order`` (SQL text such as ``a DESC NULLS LAST``); without an order any ``n`` rows (O3)."""
    if n < 0:
        raise ValueError("limit: a number of rows from 0 on")
    if not order:
        return df.limit(n)
    return df.sparkSession.sql(f"SELECT * FROM {{df}} ORDER BY {', '.join(order)} LIMIT {int(n)}", df=df)


def disable(value):
    """A disabled node passes empty inputs and outputs that keep their schema (``limit(0)``)."""
    if isinstance(value, DataFrame):
        return value.limit(0)
    if isinstance(value, list):
        return [disable(v) for v in value]
    if isinstance(value, dict):
        return {k: disable(v) for k, v in value.items()}
    return value
