"""Table, SQL-expression and metric-view sources (S4, S5, S7, S8), master data (S10), parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from medallion.operators.aggregate import Measures


def table_source(spark: SparkSession, table_name: str | None = None, is_expression: bool = False,
                 metric_view: dict | None = None, measures: dict | None = None) -> DataFrame:
    """The source node over a table name, a SQL text, or a metric view (dims + named measures)."""
    if not table_name:
        raise ValueError("source: 'tableName' is required for a table source")
    if metric_view is not None:
        if measures is None:
            raise ValueError("source: a metric view needs its measure definitions")
        return Measures(spark.table(table_name), measures).query(
            metric_view.get("dimensions"), metric_view.get("measures"))
    if is_expression:
        return spark.sql(table_name)
    return spark.table(table_name)


def master_table(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A small literal reference table (S10); it is written with ``Table.overwrite`` by the caller."""
    return spark.createDataFrame(rows, schema)


@dataclass
class FlowSpec:
    """One source feeding a target table: its entity code and landing folder."""
    entity: str
    path: str
    glob: str = "*.json"


@dataclass
class PipelineConfig:
    """Parameters of one pipeline run (S12): entity landing folders, storage root, reference date."""
    root: str
    employees: dict[str, str] = field(default_factory=dict)  # entity -> landing folder of employee extracts
    absences: dict[str, str] = field(default_factory=dict)  # entity -> landing folder of absence events
    as_of: str | None = None  # reference date for ages and year-to-date KPIs; None = today
    max_files_per_trigger: int | None = None

    @staticmethod
    def from_conf(spark: SparkSession, prefix: str = "medallion.") -> "PipelineConfig":
        """Read ``<prefix>root``, ``<prefix>as_of`` and ``<prefix>employees.<ENTITY>`` / ``absences.<ENTITY>``
        from the session conf — the equivalent of pipeline parameters."""
        conf = dict(spark.sparkContext.getConf().getAll())
        runtime = getattr(spark.conf, "getAll", None)  # session-level settings (Spark 4)
        if runtime is not None:
            conf.update(runtime if isinstance(runtime, dict) else runtime())
        conf = {k: v for k, v in conf.items() if k.startswith(prefix)}
        cfg = PipelineConfig(root=conf.get(prefix + "root", ""), as_of=conf.get(prefix + "as_of"))
        for k, v in conf.items():
            rest = k[len(prefix):]
            if rest.startswith("employees."):
                cfg.employees[rest.split(".", 1)[1]] = v
            elif rest.startswith("absences."):
                cfg.absences[rest.split(".", 1)[1]] = v
        return cfg

    def employee_flows(self) -> list[FlowSpec]:
        return [FlowSpec(e, p) for e, p in sorted(self.employees.items())]

    def absence_flows(self) -> list[FlowSpec]:
        return [FlowSpec(e, p) for e, p in sorted(self.absences.items())]
