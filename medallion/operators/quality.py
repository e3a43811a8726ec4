"""Data-quality expectations (Q1–Q8): warn, drop or fail, with per-rule metrics and a quarantine port.

A rule is violated when its predicate is FALSE.  A NULL predicate is not a violation unless
``null_is_violation`` is set (a NULL birth date breaks only the rule that tests it for NULL).

Everything happens in the one pass that produces the kept rows:

* ``drop`` and ``fail`` become one filter; a violated ``fail`` rule calls ``raise_error`` inside that filter,
  so the job fails before anything is committed — no second scan, nothing half-written;
* per-rule counts are gathered with an ``Observation`` on the same pass (``result.observation``), or, for
  batch reports, as one aggregate (``result.metrics``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from medallion.functions.columns import as_column

ACTIONS = ("warn", "drop", "fail")
FAILED_RULES = "_failed_rules"


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str | Column
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"expectation {self.name!r}: action must be one of {ACTIONS}")


def expect_all(rules: dict[str, str], action: str) -> list[Expectation]:
    """A group of expectations sharing one action (Q4)."""
    return [Expectation(n, p, action) for n, p in rules.items()]


def not_null(column: str, action: str = "drop") -> Expectation:
    """Guardrail: column must be present (Q6)."""
    return Expectation(f"{column}_not_null", f"`{column}` IS NOT NULL", action)


def accepted_values(column: str, values: list, action: str = "warn") -> Expectation:
    """Guardrail: column within a value list (Q6)."""
    return Expectation(f"{column}_accepted_values", F.col(f"`{column}`").isin(values), action)


@dataclass
class QualityResult:
    kept: DataFrame
    quarantine: DataFrame
    metrics: DataFrame
    observation: Observation
    rules: list


def violated(e: Expectation, null_is_violation: bool) -> Column:
    return F.coalesce(~as_column(e.predicate), F.lit(bool(null_is_violation)))


def apply_expectations(df: DataFrame, rules: list[Expectation], dataset: str = "dataset",
                       null_is_violation: bool = False, observation_name: str | None = None) -> QualityResult:
    if not rules:
        obs = Observation(observation_name or f"quality_{dataset}")
        kept = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        empty = df.withColumn(FAILED_RULES, F.array().cast("array<string>")).limit(0)
        metrics = df.sparkSession.createDataFrame(
            [], "dataset string, rule string, action string, failed long, passed long")
        return QualityResult(kept, empty, metrics, obs, [])
    flags = {e.name: violated(e, null_is_violation) for e in rules}
    x = df.withColumn(FAILED_RULES, F.filter(
        F.array(*[F.when(flags[e.name], F.lit(e.name)) for e in rules]), lambda v: v.isNotNull()))
    fail = [e for e in rules if e.action == "fail"]
    drop = [e for e in rules if e.action == "drop"]
    any_fail = reduce(lambda a, b: a | b, [flags[e.name] for e in fail], F.lit(False))
    any_drop = reduce(lambda a, b: a | b, [flags[e.name] for e in drop], F.lit(False))
    obs = Observation(observation_name or f"quality_{dataset}")
    observed = x.observe(obs, F.count(F.lit(1)).alias("rows"),
                         *[F.count_if(flags[e.name]).alias(e.name) for e in rules])
    msg = F.concat(F.lit(f"expectation failed on {dataset}: "), F.array_join(F.col(FAILED_RULES), ", "))
    guard = F.when(any_fail, F.raise_error(msg).cast("boolean")).otherwise(~any_drop)
    kept = observed.where(guard).drop(FAILED_RULES)
    quarantine = x.where(F.when(any_fail, F.raise_error(msg).cast("boolean")).otherwise(any_drop))
    counts = x.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(flags[e.name]).alias(f"__r{i}")
                                                        for i, e in enumerate(rules)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(e.name).alias("rule"), F.lit(e.action).alias("action"),
                 F.col(f"__r{i}").alias("failed")) for i, e in enumerate(rules)]))
    metrics = (counts.select(F.col("__rows"), stacked.alias("m"))
               .select(F.lit(dataset).alias("dataset"), F.col("m.rule").alias("rule"),
                       F.col("m.action").alias("action"), F.col("m.failed").cast("long").alias("failed"),
                       (F.col("__rows") - F.col("m.failed")).cast("long").alias("passed")))
    return QualityResult(kept, quarantine, metrics, obs, list(rules))


def observed_metrics(result: QualityResult, dataset: str, batch_id: int | None = None) -> list[tuple]:
    """Rows ``(dataset, rule, action, failed, passed, batch_id)`` read from the observation after the
    action that consumed ``result.kept`` (Q5)."""
    got = result.observation.get
    rows = int(got.get("rows", 0))
    return [(dataset, e.name, e.action, int(got.get(e.name, 0)), rows - int(got.get(e.name, 0)), batch_id)
            for e in result.rules]
