"""Column expressions shared by the operators.  All are built-in Spark expressions (JVM-side, codegen'd)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the reference's for equal results): bracket ladders of the HR application.
# Age: below 20 -> '<20', below 35 -> '20-34', below 45 -> '35-44', below 55 -> '45-54', otherwise '55+'.
AGE_BRACKETS = [(20, "<20"), (35, "20-34"), (45, "35-44"), (55, "45-54")]
AGE_ELSE = "55+"
# Seniority in years: below 2 -> '0-2 ans', below 5 -> '2-5 ans', below 10 -> '5-10 ans', below 20 -> '10-20 ans',
# otherwise '20+ ans'.
SENIORITY_BRACKETS = [(2, "0-2 ans"), (5, "2-5 ans"), (10, "5-10 ans"), (20, "10-20 ans")]
SENIORITY_ELSE = "20+ ans"
# Days per year used by the age and seniority formulas.
DAYS_PER_YEAR = "365.25"


def quote_ident(name: str) -> str:
    """Backtick-quote a column name so dots and backticks in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def col_exact(name: str) -> Column:
    return F.col(quote_ident(name))


def as_column(c) -> Column:
    return c if isinstance(c, Column) else F.expr(c)


def bracket(value, bounds: list[tuple], else_label: str) -> Column:
    """First-match CASE ladder: ``value < bound_i`` gives ``label_i``; NULL and the rest fall to ``else_label``."""
    v = as_column(value)
    out = None
    for bound, label in bounds:
        out = F.when(v < F.lit(bound), F.lit(label)) if out is None else out.when(v < F.lit(bound), F.lit(label))
    return F.lit(else_label) if out is None else out.otherwise(F.lit(else_label))


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        return F.lit(as_of.isoformat()[:10]).cast("date")
    return F.lit(str(as_of)).cast("date")


def age_years(birth, as_of=None) -> Column:
    """Whole years: ``CAST(floor(datediff(as_of, birth) / 365.25) AS INT)``; ``as_of`` defaults to today."""
    days = F.datediff(_as_of(as_of), as_column(birth))
    return F.floor(days / F.lit(DAYS_PER_YEAR).cast("decimal(5,2)")).cast("int")


def seniority_years(hire, as_of=None) -> Column:
    """Years with one decimal: ``ROUND(datediff(as_of, hire) / 365.25, 1)`` (a decimal, as in SQL)."""
    days = F.datediff(_as_of(as_of), as_column(hire))
    return F.round(days / F.lit(DAYS_PER_YEAR).cast("decimal(5,2)"), 1)


def json_path(col, path: str) -> Column:
    """Extract a scalar at a JSON path as text, e.g. ``json_path('j', '$.response[0]')``."""
    return F.get_json_object(as_column(col), path)


def distinct_from(a, b) -> Column:
    """``a IS DISTINCT FROM b`` — NULL-safe inequality."""
    return ~as_column(a).eqNullSafe(as_column(b))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL equals NULL; the keys of ``left`` stay."""
    own = [f"__r{i}" for i in range(len(keys))]
    other = right.select(*[col_exact(k).alias(o) for k, o in zip(keys, own)],
                         *[col_exact(c) for c in right.columns if c not in keys])
    return left.join(other, [left[quote_ident(k)].eqNullSafe(other[o]) for k, o in zip(keys, own)], how).drop(*own)


def struct_order_key(keys: list[tuple], schema: T.StructType | None = None) -> Column | None:
    """Encode ``[(expr, 'ASC'|'DESC')]`` with NULLS LAST as one ascending struct, for ``min_by``.

    Returns None when a DESC key cannot be negated for every value (numbers have NaN and a least integer; text).
    """
    parts = []
    for i, (expr, direction) in enumerate(keys):
        c = as_column(expr)
        parts.append(c.isNull().alias(f"n{i}"))
        if str(direction).upper() == "DESC":
            dt = _type_of(expr, schema)
            if isinstance(dt, T.DateType):
                parts.append((-F.unix_date(c)).alias(f"k{i}"))
            elif isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
                parts.append((-F.unix_micros(c.cast("timestamp"))).alias(f"k{i}"))
            else:
                return None
        else:
            parts.append(c.alias(f"k{i}"))
    return F.struct(*parts)


def _type_of(expr, schema):
    if schema is None or isinstance(expr, Column):
        return None
    names = {f.name: f.dataType for f in schema.fields}
    key = expr.strip("`")
    return names.get(key)
