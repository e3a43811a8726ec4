"""Free SQL node (P16, P17) with QUALIFY (W5), expression select (X3) and table-function node."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a named parameter is ``:name`` not preceded by another colon (so ``x::STRING`` is a cast).
PARAM_PATTERN = r"(?<!:):(\w+)"


# Quoted texts and names, comments, brackets and words of a statement.
TOKEN = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`(?:[^`]|``)*`|--[^\n]*|/\*.*?\*/|[()]|\w+""", re.S)


def qualify(df: DataFrame, condition: str) -> DataFrame:
    """Rows for which ``condition``, which may use window functions, is TRUE."""
    name = "__qualify"
    return df.withColumn(name, F.expr(condition)).where(F.col(name)).drop(name)


def without_qualify(query: str) -> str:
    """``query`` with a QUALIFY clause outside all brackets written as a column of the SELECT that it ends, and a filter
    around it.  Spark has no such clause; ORDER BY and LIMIT behind it stay behind the filter.  Other text is as it was."""
    depth, words = 0, []
    for token in TOKEN.finditer(query):
        depth += (token[0] == "(") - (token[0] == ")")
        if depth == 0 and token[0][0].isalpha():
            words.append((token[0].upper(), token.start(), token.end()))
    at = next((w for w in words if w[0] == "QUALIFY"), None)
    if at is None:
        return query
    select = [w for w in words if w[0] == "SELECT" and w[1] < at[1]][-1]
    source = next(w for w in words if w[0] == "FROM" and w[1] > select[1])
    end = next((w[1] for w in words if w[0] in ("ORDER", "LIMIT", "UNION", "EXCEPT", "INTERSECT") and w[1] > at[2]), len(query))
    condition, rest = query[at[2]:end], query[end:]
    inner = f"{query[select[1]:source[1]]}, ({condition.strip()}) AS __qualify {query[source[1]:at[1]]}"
    return f"{query[:select[1]]}SELECT * EXCEPT (__qualify) FROM ({inner}) WHERE __qualify {rest}"


def run_sql(spark: SparkSession, query: str, views: dict[str, DataFrame] | None = None,
            params: dict | None = None) -> DataFrame:
    """Register each input as a temp view under its node name and run ``query``.

    ``:name`` markers are bound from ``params`` when a value is supplied (``spark.sql(q, args=...)``); a QUALIFY clause
    becomes a filter around its SELECT.
    """
    query = without_qualify(query)
    for name, df in (views or {}).items():
        if df is not None:
            df.createOrReplaceTempView(name)
    names = set(re.findall(PARAM_PATTERN, query))
    args = {n: (params or {})[n] for n in names if n in (params or {})}
    return spark.sql(query, args=args) if args else spark.sql(query)


def expression_select(df: DataFrame, expressions: list[str] | None, keep_all: bool = True) -> DataFrame:
    """New SQL expressions first, then every input column (or only the expressions); none → unchanged."""
    if not expressions:
        return df
    return df.selectExpr(*expressions, "*") if keep_all else df.selectExpr(*expressions)


def table_function(spark: SparkSession, sql: str, df: DataFrame, placeholder: str = "__input__") -> DataFrame:
    """Run a table-valued SQL statement whose FROM clause names ``placeholder``, bound to ``df``.

    Uses Spark's DataFrame parameters (``spark.sql(query, input=df)``): the input is referenced by the
    statement's plan directly, no session view is created.  Literal braces in the statement are escaped.
    """
    query = sql.replace("{", "{{").replace("}", "}}").replace(placeholder, "{input}")
    return spark.sql(query, input=df)
