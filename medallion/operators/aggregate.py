"""Group aggregates from a configuration (A1–A12) and named measures over a table.

Everything but MEDIAN and PERCENTILE maps onto Spark's own aggregates, which are pre-combined in every task: a hot
group costs one partial row for each task.  MEDIAN and PERCENTILE are exact and use the plan of ``percentile.py``, which
never holds a group in one task, at any size; its result is joined to the other aggregates on the group.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions.columns import null_safe_join, quote_ident
from medallion.operators.percentile import exact_percentiles

MIDDLE, LIST_SEPARATOR = 0.5, ", "  # fixed values: defaults of PERCENTILE and CONCAT
# Functions whose column may have any name; all others take the text between the brackets as SQL.
OF_ONE_COLUMN = frozenset("SUM AVG MEAN COUNT MIN MAX STDDEV VARIANCE FIRST LAST".split())


def clamp_percentile(p) -> float:
    """``p`` within [0, 1]; the middle for what is no finite number."""
    usable = type(p) in (int, float) and math.isfinite(p)
    return min(max(float(p), 0.0), 1.0) if usable else MIDDLE


@dataclass(frozen=True)
class Measure:
    """One entry of ``aggregations``: ``{columnExpr: {expr, type}, fn, alias, percentage, separator, order}``."""

    function: str
    source: str
    is_expression: bool
    alias: str | None
    options: dict

    @classmethod
    def read(cls, entry: dict) -> Measure:
        column = entry.get("columnExpr") or {}
        return cls((entry.get("fn") or "-").upper(), column.get("expr", ""), column.get("type") == "expr",
                   entry.get("alias") or None, entry)

    @property
    def passes_through(self) -> bool:
        return self.function in ("-", "_")

    @property
    def rank(self) -> float | None:
        """The wanted percentile, for functions that are one."""
        if self.function == "MEDIAN":
            return MIDDLE
        return clamp_percentile(self.options.get("percentage")) if self.function == "PERCENTILE" else None

    @property
    def name(self) -> str:
        if self.rank is None or self.alias:
            return self.alias or ""
        return f"median({self.source})" if self.function == "MEDIAN" else f"percentile({self.source}, {self.rank}, 1)"

    def _argument(self) -> Column:
        return F.expr(self.source) if self.is_expression else F.col(self.source)

    def _listagg(self) -> str:
        """LISTAGG in the order of the values, if asked for; no value at all gives an empty text."""
        separator = self.options.get("separator")
        separator = separator if isinstance(separator, str) else LIST_SEPARATOR
        literal = "'" + separator.replace("\\", "\\\\").replace("'", "\\'") + "'"
        argument = self.source if self.is_expression else quote_ident(self.source)
        order = f" WITHIN GROUP (ORDER BY {argument})" if self.options.get("order") else ""
        return f"coalesce(listagg(CAST({argument} AS STRING), {literal}){order}, '')"

    def column(self) -> Column:
        if self.passes_through:
            out = self._argument()
        elif self.function == "CONCAT":
            out = F.expr(self._listagg())
        elif self.function == "COUNT_DISTINCT":
            out = F.count_distinct(F.expr(self.source) if self.is_expression or not self.source else self._argument())
        elif self.function in OF_ONE_COLUMN and not self.is_expression and self.source != "*":
            out = F.call_function(self.function, F.col(self.source))
        else:
            out = F.expr(f"{self.function}({self.source})")
        return out.alias(self.alias) if self.alias else out


def aggregate(df: DataFrame, group_bys: list | None = None, aggregations: list | None = None) -> DataFrame:
    """``df`` grouped by SQL expressions and aggregated, in the order of the lists.

    Without aggregations the distinct groups, or ``df`` itself if there are no groups either; without groups one row.
    A pass-through that only repeats a group is left out.
    """
    groups = [g for g in ((g or {}).get("expr") if isinstance(g, dict) else g for g in group_bys or []) if g]
    measures = [Measure.read(a) for a in aggregations or []]
    measures = [m for m in measures if not (m.passes_through and not m.alias and m.source in groups)]
    keys = [F.expr(g).alias(g) for g in groups]
    if not measures:
        return df.select(*keys).distinct() if keys else df
    ranked = [m for m in measures if m.rank is not None]
    if not ranked:
        return df.groupBy(*keys).agg(*(m.column() for m in measures))

    # a global aggregate is one group, so that every join below has an equal key
    places = [f"__group{i}" for i in range(len(groups))] or ["__group"]
    values = [F.expr(g).alias(p) for g, p in zip(groups, places)] or [F.lit(0).alias("__group")]
    marked = df.select("*", *values)
    others = [m.column() for m in measures if m.rank is None]
    count = F.count(F.lit(1)).alias("__rows")
    out = marked.groupBy(*places).agg(count, *others) if groups else df.agg(count, *others).select(values[0], "*")
    plain_names = iter(out.columns[len(places) + 1:])
    wanted = {m.source: sorted({x.rank for x in ranked if x.source == m.source}) for m in ranked}
    numbers = {source: f"__ranks{i}" for i, source in enumerate(wanted)}
    for source, ranks in wanted.items():
        found = exact_percentiles(marked, places, F.expr(source), ranks, numbers[source])
        out = null_safe_join(out, found, places, "left")
    shown = [F.col(f"`{next(plain_names)}`") if m.rank is None
             else F.col(numbers[m.source])[wanted[m.source].index(m.rank)].alias(m.name) for m in measures]
    return out.select(*(F.col(p).alias(g) for g, p in zip(groups, places)), *shown)


class Measures:
    """Named aggregate expressions over a table; ``query`` picks dimensions and measures."""

    def __init__(self, df: DataFrame, measures: dict[str, Column | str]):
        self.df = df
        self.measures = {name: F.expr(m) if isinstance(m, str) else m for name, m in measures.items()}

    def query(self, dims: list[str] | None, measures: list[str] | None) -> DataFrame:
        """Measures for each combination of the dimensions; dimensions alone are listed once each, measures alone give
        one row, and with neither the table comes back.  A list that is None was not chosen yet: an error."""
        if dims is None or measures is None:
            raise ValueError("measures: choose the dimensions and the measures, if only as empty lists")
        missing = sorted(set(measures) - set(self.measures))
        if missing:
            raise ValueError(f"measures: {', '.join(missing)} not defined; there are {', '.join(sorted(self.measures))}")
        chosen = [self.measures[m].alias(m) for m in measures]
        if chosen:
            return self.df.groupBy(*dims).agg(*chosen)
        return self.df.select(*dims).distinct() if dims else self.df
