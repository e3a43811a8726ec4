"""Append flows, incremental runs, stream-to-CDC (T1–T9) on Structured Streaming.

One streaming query per source flow (``trigger(availableNow=True)``, its own checkpoint = its own file
log), so flows progress independently and a new source is added without a full refresh (T1, T2).  Each
micro-batch is handled in ``foreachBatch`` (T9):

1. **bronze** — append the parsed rows to the bronze table, idempotent on ``(flow, batch_id)``;
2. **silver** — read back exactly the segment just written (no recomputation from the source files), apply
   the stateless transform and the expectations: dropped rows go to a quarantine table, a violated fail rule
   raises inside the write job so nothing of the batch reaches silver (the query stops; the next run retries
   the same batch id), per-rule counts come from an ``Observation`` on that same write (Q5);
3. **gold** — CDC merges of the silver batch into bucketed targets: SCD 1 reduces batch winners with the
   current rows of the touched buckets; SCD 2 rebuilds the history of the batch's keys from the silver log
   (also bucketed by key, so only touched buckets are read) and replaces those buckets.  Both are
   order-independent, so late or out-of-order files give the same result (T7).

Materialized views are then refreshed in batch (T6, T8).  A full refresh (T3) starts a new epoch with fresh checkpoints
and fills shadow tables from the landing files; readers see the old tables until one pointer, the pipeline's state
file, switches all of them at once.
"""

from __future__ import annotations

import copy
import json
import uuid
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.functions.columns import null_safe_join
from medallion.operators import cdc
from medallion.operators.quality import Expectation, apply_expectations, observed_metrics
from medallion.sinks.fs import FS
from medallion.sinks.tables import Catalog, Table, bucket_expr
from medallion.sources.files import read_json_stream
from medallion.sources.tables import FlowSpec

METRICS_TABLE = "_quality_metrics"
KIND_COL = "_kind"  # segment tag of SCD 2 targets: "open" (current versions) or "closed"


def _tag_kind(versions: DataFrame) -> DataFrame:
    return versions.withColumn(KIND_COL, F.when(F.col(cdc.END_AT).isNull(), "open").otherwise("closed"))


@dataclass
class CdcSpec:
    target: str
    keys: list[str]
    sequence: list[str]
    scd_type: int = 1
    track_history: list[str] | None = None  # SCD 2: columns whose change opens a version (None = all)
    # SCD 2 plan (see cdc.scd2).  None: "window" for in-order rows, which are a batch and one open version for each key,
    # "segments" where histories are computed anew - first loads and late rows - whatever a key's share of the log
    strategy: str | None = None


@dataclass
class Dataset:
    """A bronze → silver → gold chain fed by one or more source flows."""
    bronze: str
    silver: str | None = None
    transform: Callable[[DataFrame], DataFrame] | None = None
    expectations: list[Expectation] = field(default_factory=list)
    cdc: list[CdcSpec] = field(default_factory=list)
    buckets: int = 16  # bucket count of silver and CDC targets (size it so a bucket fits one task)
    null_is_violation: bool = False
    # table name -> {"comment": str, "properties": {...}}, set once when the table is first written (K5)
    describe: dict = field(default_factory=dict)


@dataclass(frozen=True)
class View:
    """A materialized view by declaration: the tables it reads, and the query over them in that order."""
    reads: tuple[str, ...]
    query: Callable[..., DataFrame]

    def __call__(self, pipeline: Pipeline) -> DataFrame:
        return self.query(*[pipeline.catalog.read(name) for name in self.reads])


def refresh_order(views: dict[str, Callable]) -> list[str]:
    """The names of ``views``, each after the views that it reads; else as given.  Views that read each other in a
    circle are an error."""
    reads = {name: set(getattr(view, "reads", ())) for name, view in views.items()}
    open_, order = list(views), []
    while open_:
        name = next((n for n in open_ if not reads[n] & set(open_)), None)
        if name is None:
            raise ValueError(f"views that read each other in a circle: {sorted(open_)}")
        open_.remove(name)
        order.append(name)
    return order


@dataclass
class RunStats:
    flow: str
    batches: int = 0
    bronze_rows: int = 0
    metrics: list = field(default_factory=list)


class Pipeline:
    """Tables under ``root/tables``, checkpoints and schemas under ``root/_checkpoints``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fs = FS(spark)
        self.catalog = Catalog(spark, f"{self.root}/tables", lambda: self._state()["at"])

    # ---------------------------------------------------------------- tables
    def table(self, name: str, ds: Dataset | None = None, keys: list[str] | None = None) -> Table:
        if keys and ds is not None:
            return self.catalog.table(name, bucket_by=keys, buckets=ds.buckets)
        return self.catalog.table(name)

    def _cdc_keys(self, ds: Dataset) -> list[str] | None:
        return ds.cdc[0].keys if ds.cdc else None

    # ---------------------------------------------------------------- one flow
    def run_flow(self, ds: Dataset, flow: FlowSpec, epoch: str = "0",
                 max_files_per_trigger: int | None = None) -> RunStats:
        """Process the flow's unseen files (``availableNow``) through bronze, silver and gold."""
        name = f"{ds.bronze}__{flow.entity}"
        cp = f"{self.root}/_checkpoints/{epoch}/{name}"
        stream = read_json_stream(self.spark, flow.path, flow.entity, f"{cp}/_schema", flow.glob,
                                  max_files_per_trigger)
        stats = RunStats(name)
        # batch ids restart with a new checkpoint, so the writer id names the checkpoint epoch too
        writer = f"{name}@{epoch}"

        def handle(batch: DataFrame, batch_id: int) -> None:
            self._process_batch(ds, writer, batch, batch_id, stats)

        q = (stream.writeStream.foreachBatch(handle)
             .option("checkpointLocation", f"{cp}/stream")
             .trigger(availableNow=True)
             .queryName(f"{name}_{epoch}")
             .start())
        q.awaitTermination()
        return stats

    def _process_batch(self, ds: Dataset, writer: str, batch: DataFrame, batch_id: int, stats: RunStats) -> None:
        txn = (writer, batch_id)
        bronze = self.table(ds.bronze)
        if not bronze.committed(txn):
            bronze.append(batch, txn=txn)
        rows = bronze.read_entries(bronze.batch_entries(writer))
        stats.batches += 1
        if ds.silver is None:
            return
        silver_rows = ds.transform(rows) if ds.transform else rows
        keys = self._cdc_keys(ds)
        silver = self.table(ds.silver, ds, keys)
        quarantine, metrics = self.catalog.table(f"{ds.silver}_quarantine"), self.catalog.table(METRICS_TABLE)
        result = apply_expectations(silver_rows, ds.expectations, ds.silver, ds.null_is_violation,
                                    observation_name=f"q_{writer}_{batch_id}")
        # Each table has its own commit.  A retry finds out for each what is missing; the bronze segment that all of
        # it derives from is fixed, so what is written late equals what would have been written then.
        observed = None
        if not silver.committed(txn):
            silver.append(result.kept, txn=txn)
            observed = observed_metrics(result, ds.silver, batch_id)
        elif ds.expectations and not metrics.committed(txn):
            result.kept.write.format("noop").mode("overwrite").save()  # fills the observation again
            observed = observed_metrics(result, ds.silver, batch_id)
        if observed is not None:
            stats.metrics.extend(observed)
            stats.bronze_rows += int(result.observation.get.get("rows", 0))
        if ds.expectations and observed is not None:
            dropped = sum(m[3] for m in observed if m[2] in ("drop", "fail"))
            if (dropped or not quarantine.exists()) and not quarantine.committed(txn):
                quarantine.append(result.quarantine if dropped else result.quarantine.limit(0), txn=txn)
            # the metrics come last: once they are there, the batch's quarantine is too
            metrics.append(self.spark.createDataFrame(
                [m + (writer,) for m in observed],
                "dataset string, rule string, action string, failed long, passed long, batch_id long, "
                "flow string"), txn=txn)
        entries = silver.batch_entries(writer)
        new_silver = silver.read_entries(entries)
        for spec in ds.cdc:
            touched = None
            if silver.bucket_by == spec.keys and silver.buckets == ds.buckets:
                touched = sorted({e["bucket"] for e in entries})  # the silver segment is bucketed alike
            self._merge_cdc(ds, spec, silver, new_silver, txn, touched)
        self._describe(ds)

    def _describe(self, ds: Dataset) -> None:
        """Apply the dataset's table comments / properties once (tables keep them in their manifests)."""
        for name, d in ds.describe.items():
            t = self.catalog.table(name)
            if t.exists() and t.manifest().comment is None:
                t.set_comment(d.get("comment"), d.get("properties"))

    # ---------------------------------------------------------------- CDC
    def _merge_cdc(self, ds: Dataset, spec: CdcSpec, silver: Table, batch: DataFrame, txn,
                   touched: list | None = None) -> None:
        target = self.table(spec.target, ds, spec.keys)
        if target.committed(txn):
            return
        if touched is None:  # at most `buckets` values
            touched = [r[0] for r in batch.select(bucket_expr(spec.keys, ds.buckets).alias("b")).distinct().collect()]
        if not touched:
            target.create_if_absent(_cdc_schema(batch, spec)) if not target.exists() else None
            return
        base = target.version()
        if spec.scd_type == 1:
            current = target.read(version=base, buckets=touched) if base is not None else batch.limit(0)
            merged = cdc.scd1(current.unionByName(batch), spec.keys, spec.sequence)
            target.replace_buckets(merged, touched, txn=txn, op="CDC SCD1", base_version=base)
            return
        tracked = spec.track_history or [c for c in batch.columns if c not in spec.keys + spec.sequence]
        # buckets with late rows (all of them on a first load) are rebuilt from the silver log; in the others only
        # the open versions are looked at.  Both parts are one commit.
        bucket = bucket_expr(spec.keys, ds.buckets)
        late = touched if base is None else self._late_buckets(target, spec, batch, touched, base, bucket)
        in_order = [b for b in touched if b not in late]
        parts = []
        if late:
            rows = batch.where(bucket.isin(late)) if in_order else batch
            parts.append(self._rebuilt(target, spec, silver, rows, late, tracked, base))
        if in_order:
            rows = batch.where(bucket.isin(in_order)) if late else batch
            parts.append(self._reopened(target, spec, rows, in_order, tracked, base))
        versions = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        target.replace_buckets(_tag_kind(versions), touched, txn=txn, op="CDC SCD2" if late else "CDC SCD2 APPEND",
                               drop_kinds={"open"}, whole=late, kind_col=KIND_COL, base_version=base)

    @staticmethod
    def _late_buckets(target: Table, spec: CdcSpec, batch: DataFrame, touched: list, base: int, bucket) -> list:
        """Buckets of keys with a row that does not come after the last row of the key's open version."""
        seq = F.struct(*[F.col(c) for c in spec.sequence])
        first = batch.groupBy(*spec.keys).agg(F.min(seq).alias("__first"))
        last = target.read(version=base, buckets=touched, kinds={"open"}).select(*spec.keys, seq.alias("__last"))
        late = null_safe_join(first, last, spec.keys, "inner").where(F.col("__first") <= F.col("__last"))
        return [r[0] for r in late.select(bucket.alias("b")).distinct().collect()]  # at most the number of buckets

    @staticmethod
    def _rebuilt(target: Table, spec: CdcSpec, silver: Table, batch: DataFrame, buckets: list, tracked: list,
                 base: int | None) -> DataFrame:
        """The whole history of these buckets, that of the batch's keys computed anew from the silver log."""
        keys_df = batch.select(*spec.keys).distinct()
        stored = silver.read(buckets=buckets)
        log = null_safe_join(stored, keys_df, spec.keys, "left_semi")
        rebuilt = cdc.scd2(log, spec.keys, spec.sequence, tracked, strategy=spec.strategy or "segments", near=stored)
        if base is None:
            return rebuilt
        others = null_safe_join(target.read(version=base, buckets=buckets), keys_df, spec.keys, "left_anti")
        return others.unionByName(rebuilt)

    @staticmethod
    def _reopened(target: Table, spec: CdcSpec, batch: DataFrame, buckets: list, tracked: list, base: int) -> DataFrame:
        """In-order rows: the open versions of these buckets, and the versions that the batch closes.

        A key's open version enters as one row (its values are those of its last row, sequence included); the
        closed history is neither read nor rewritten.
        """
        seq = F.struct(*[F.col(c) for c in spec.sequence])
        cols = batch.columns
        open_cur = target.read(version=base, buckets=buckets, kinds={"open"})
        keys_df = batch.select(*spec.keys).distinct()
        affected = null_safe_join(open_cur, keys_df, spec.keys, "left_semi")
        untouched = null_safe_join(open_cur, keys_df, spec.keys, "left_anti")
        starts = affected.select(*spec.keys, seq.alias("__pseudo"), F.col(cdc.START_AT).alias("__orig"))
        versions = cdc.scd2(affected.select(*cols).unionByName(batch), spec.keys, spec.sequence, tracked,
                            strategy=spec.strategy or "window")
        fixed = versions.join(starts, [versions[k].eqNullSafe(starts[k]) for k in spec.keys] +
                              [versions[cdc.START_AT] == starts["__pseudo"]], "left")
        versions = fixed.select(*[versions[c] for c in cols],
                                F.coalesce(F.col("__orig"), versions[cdc.START_AT]).alias(cdc.START_AT),
                                versions[cdc.END_AT])
        return untouched.unionByName(versions)

    # ---------------------------------------------------------------- whole runs
    def run(self, plan: list[tuple[Dataset, list[FlowSpec]]], views: dict | None = None,
            max_files_per_trigger: int | None = None, parallel: bool = True) -> list[RunStats]:
        """Run every flow, then refresh the materialized views in the order that their declarations give.

        Datasets write disjoint tables, so with ``parallel`` each dataset's flows run in their own driver
        thread (Spark schedules the jobs of all threads together); the flows of one dataset stay sequential
        because their CDC merges touch the same buckets.  The shared metrics table is append-only and its
        commit retries on a concurrent version.
        """
        state = self._state()
        refresh, work, epoch = state["refresh"], self, state["epoch"]
        if refresh:  # a full refresh was begun: it is this run's matter
            epoch, work = refresh["epoch"], self._shadow(state, plan, views)

        def one(item):
            ds, flows = item
            return [work.run_flow(ds, flow, epoch, max_files_per_trigger) for flow in flows]

        if parallel and len(plan) > 1:
            from concurrent.futures import ThreadPoolExecutor
            with ThreadPoolExecutor(max_workers=len(plan)) as pool:
                results = list(pool.map(one, plan))
        else:
            results = [one(item) for item in plan]
        out = [s for r in results for s in r]
        for name in refresh_order(views or {}):
            work.catalog.refresh(name, views[name](work))
        if refresh:
            self._store({"epoch": epoch, "at": work.catalog.places(), "refresh": None})
        return out

    # The state is the last of a row of small files, each created by one rename.  ``epoch`` names the checkpoints in use, so
    # that runs after a full refresh go on from its file log; ``at`` the folders of tables that a refresh has filled;
    # ``refresh`` a refresh that is under way.
    def _states(self) -> list[str]:
        return sorted(n for n in self.fs.ls(f"{self.root}/_checkpoints/_state") if n.endswith(".json"))

    def _state(self) -> dict:
        names = self._states()
        return json.loads(self.fs.read_text(f"{self.root}/_checkpoints/_state/{names[-1]}")) if names \
            else {"epoch": "0", "at": {}, "refresh": None}

    def _store(self, state: dict) -> None:
        if not self.fs.write_text(f"{self.root}/_checkpoints/_state/{len(self._states()):010d}.json", json.dumps(state)):
            raise RuntimeError(f"{self.root}: another run changes the pipeline's state")

    def _shadow(self, state: dict, plan, views: dict | None) -> Pipeline:
        """This pipeline with the tables of the refresh in folders of their own."""
        names, epoch = state["refresh"]["names"], state["refresh"]["epoch"]
        if sorted(names) != sorted(self._derived(plan, views)):
            raise ValueError(f"a full refresh of {sorted(names)} was begun: run its datasets and views first")
        places = {**state["at"], **{name: f"{name.replace('.', '/')}@{epoch}" for name in names}}
        shadow = copy.copy(self)
        shadow.catalog = Catalog(self.spark, self.catalog.root, lambda: places)
        old, new = self.catalog.table(METRICS_TABLE), shadow.catalog.table(METRICS_TABLE)
        if METRICS_TABLE in names and old.exists() and not new.exists():  # the metrics of other datasets stay
            new.overwrite(old.read().where(~F.col("dataset").isin([ds.silver for ds, _ in plan])))
        return shadow

    @staticmethod
    def _derived(plan, views: dict | None) -> list[str]:
        """The tables that a run of ``plan`` fills."""
        names = {n for ds, _ in plan
                 for n in (ds.bronze, ds.silver, ds.silver and f"{ds.silver}_quarantine", *(c.target for c in ds.cdc)) if n}
        return sorted(names | set(views or {}) | ({METRICS_TABLE} if any(ds.silver for ds, _ in plan) else set()))

    def optimize(self, names: list[str], target_bytes: int = 128 * 1024 ** 2, min_segments: int = 4) -> dict:
        """Compact the small segments of the given tables (run between updates, like an OPTIMIZE job)."""
        return {n: self.catalog.table(n).optimize(target_bytes, min_segments) for n in names
                if self.catalog.table(n).exists()}

    def full_refresh(self, plan, views=None, **kw) -> list[RunStats]:
        """Recompute everything from the landing files (T3): bronze, silver, quarantine, metrics, CDC targets and views are
        filled anew aside, under a new epoch, and then switched together.  The intent is stored first: until the switch
        every reader sees the old tables, and a refresh that is interrupted anywhere is completed by the next run."""
        state = self._state()
        self._store({**state, "refresh": {"epoch": uuid.uuid4().hex[:12], "names": self._derived(plan, views)}})
        return self.run(plan, views, **kw)


def _cdc_schema(batch: DataFrame, spec: CdcSpec):
    if spec.scd_type == 1:
        return batch.schema
    return cdc.scd2(batch.limit(0), spec.keys, spec.sequence, spec.track_history or []).schema


def batch_cdc(silver: DataFrame, spec: CdcSpec) -> DataFrame:
    """Batch twin of the streaming CDC targets (used by full refresh checks and tests)."""
    if spec.scd_type == 1:
        return cdc.scd1(silver, spec.keys, spec.sequence)
    tracked = spec.track_history or [c for c in silver.columns if c not in spec.keys + spec.sequence]
    return cdc.scd2(silver, spec.keys, spec.sequence, tracked)


def quality_summary(pipeline: Pipeline, dataset: str) -> DataFrame:
    """Failed / passed per rule over all batches of a dataset (Q5)."""
    m = pipeline.catalog.read(METRICS_TABLE).where(F.col("dataset") == dataset)
    return m.groupBy("dataset", "rule", "action").agg(F.sum("failed").cast("long").alias("failed"),
                                                      F.sum("passed").cast("long").alias("passed"))
