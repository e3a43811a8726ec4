"""Plan inspection: the facts about a physical plan that matter at scale, read from ``explain("formatted")``."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def formatted_plan(df: DataFrame) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def plan_summary(df: DataFrame) -> dict:
    """Pushed filters and read schemas of every scan, and counts of the operators that shuffle or broadcast."""
    text = formatted_plan(df)
    count = {name: len(re.findall(rf"\b{name}\b", text)) for name in (
        "Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
        "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "BatchEvalPython", "ArrowEvalPython")}
    return {
        "pushed_filters": [p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", text) if p],
        "read_schemas": re.findall(r"ReadSchema: struct<([^>]*)>", text),
        **count,
    }
