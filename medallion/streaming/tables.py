"""Tables that streams fill and streams read (S9, T1), on Spark's own file sink and file source.

A streamed table is a folder with one sub-folder for each flow that fills it.  A flow is a Structured Streaming query
with its own checkpoint; the file sink logs which files each batch committed, and every reader - batch or stream - sees
the files of that log only, so a batch that was written twice or half is read once.  A stream over the table is a query
of its own with its own checkpoint: it goes on where it stopped, whenever its writer ran, and neither knows the other.
Flows are separate folders, so a new source is added without touching the state of the others.

Rules run inside the stream: failed rows stop it or are left out, and their counts are observed on the same pass.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.quality import Expectation, violated
from medallion.sinks.fs import FS


class StreamedTable:
    """Under ``path``: ``data/<flow>`` (the file sink's folders), ``_checkpoints/<flow>`` and ``_schemas/<flow>.json``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.fs = spark, path.rstrip("/"), FS(spark)

    def flows(self) -> list[str]:
        return sorted(name.removesuffix(".json") for name in self.fs.ls(f"{self.path}/_schemas"))

    def schema(self, flow: str) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.fs.read_text(f"{self.path}/_schemas/{flow}.json")))

    def append(self, flow: str, stream: DataFrame, rules: list[Expectation] = (), null_is_violation: bool = False) -> dict:
        """Write what ``stream`` has not delivered yet.  Returns the number of rows read and of violations by rule."""
        violations = {e.name: violated(e, null_is_violation) for e in rules}
        seen = stream.observe("rules", F.count(F.lit(1)).alias("rows"),
                              *[F.count_if(c).alias(name) for name, c in violations.items()])
        kept = reduce(DataFrame.where, [~violations[e.name] for e in rules if e.action == "drop"], seen)
        for e in rules:
            if e.action == "fail":
                stop = F.raise_error(F.lit(f"expectation failed on {flow}: {e.name}")).cast("boolean")
                kept = kept.where(F.when(violations[e.name], stop).otherwise(True))
        self.fs.write_text(f"{self.path}/_schemas/{flow}.json", stream.schema.json())
        query = kept.writeStream.format("parquet").option("path", f"{self.path}/data/{flow}") \
            .option("checkpointLocation", f"{self.path}/_checkpoints/{flow}").trigger(availableNow=True).start()
        query.awaitTermination()
        counts = {"rows": 0, **{name: 0 for name in violations}}
        for progress in query.recentProgress:
            observed = progress["observedMetrics"].get("rules")
            for name in counts:
                counts[name] += int(observed[name]) if observed else 0
        return counts

    def read(self) -> DataFrame:
        """All committed rows of all flows; columns are matched by name."""
        frames = [self.spark.read.schema(self.schema(f)).parquet(f"{self.path}/data/{f}") for f in self.flows()
                  if self.fs.exists(f"{self.path}/data/{f}")]
        if not frames:
            raise FileNotFoundError(f"streamed table {self.path} has no rows yet")
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    def stream(self, flow: str, max_files_per_trigger: int | None = None) -> DataFrame:
        """The rows that ``flow`` appended, as a stream."""
        reader = self.spark.readStream.schema(self.schema(flow))
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.parquet(f"{self.path}/data/{flow}")
