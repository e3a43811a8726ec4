"""Versioned Parquet tables: overwrite, append by name, merge on keys, refresh, history, detail.

A table is a folder holding immutable Parquet *segments* written by ordinary Spark jobs, plus one small JSON
manifest per version (``_manifest/<version>.json``) that lists the segments making up that version.  A new
version becomes visible only when its manifest is created; creation is exclusive, so readers always see a
whole version and two writers cannot both commit the same version number.  Old segments are never modified,
which gives snapshot reads of any past version.

Bucketed tables (``bucket_by`` + ``buckets``) write each segment partitioned by ``pmod(xxhash64(keys), n)``;
merges and CDC rewrites then touch only the buckets whose keys appear in the incoming batch, so the rewrite
cost follows the batch, not the table.  ``txn=(writer, batch_id)`` makes a write idempotent: a batch that was
already committed by that writer is skipped, which is what a restarted stream needs.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.sinks.fs import FS
from medallion.sources.files import file_listing

BUCKET_COL = "_bucket"


def bucket_expr(keys: list[str], buckets: int) -> Column:
    """The bucket of a row: a stable hash of the key columns, modulo the bucket count."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def align_by_name(df: DataFrame, schema: T.StructType, allow_missing: bool = True) -> DataFrame:
    """Project ``df`` onto ``schema`` by (case-insensitive) column name; missing columns become NULL."""
    by_lower = {c.lower(): c for c in df.columns}
    extra = set(by_lower) - {f.name.lower() for f in schema.fields}
    if extra:
        raise ValueError(f"columns not in the target table: {sorted(extra)}")
    cols = []
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        if src is None:
            if not allow_missing:
                raise ValueError(f"column {f.name!r} missing from the input")
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f"`{src}`").cast(f.dataType).alias(f.name))
    return df.select(*cols)


def validate_table_name(name: str) -> str:
    """Accept ``t``, ``schema.t`` or ``catalog.schema.t``; reject empty parts (e.g. a catalog with no schema)."""
    if not name or not isinstance(name, str):
        raise ValueError("a table or view name is required")
    parts = name.split(".")
    if len(parts) > 3 or any(not p.strip() for p in parts):
        raise ValueError(f"invalid table name {name!r}: use table, schema.table or catalog.schema.table")
    return name


@dataclass
class Manifest:
    version: int
    schema: str
    entries: list = field(default_factory=list)  # [{"path": str, "bucket": int | None}]
    txns: dict = field(default_factory=dict)  # writer -> last committed batch id
    txn_entries: dict = field(default_factory=dict)  # writer -> entries written by its last batch
    operation: str = "CREATE"
    properties: dict = field(default_factory=dict)
    comment: str | None = None
    bucket_by: list | None = None
    buckets: int | None = None
    cluster_by: list | None = None
    ts: float = 0.0

    def to_json(self) -> str:
        return json.dumps(self.__dict__, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> "Manifest":
        return Manifest(**json.loads(text))


class Table:
    """One versioned table at ``path``."""

    def __init__(self, spark: SparkSession, path: str, bucket_by: list[str] | None = None,
                 buckets: int | None = None, cluster_by: list[str] | None = None, cluster_files: int | None = None):
        self.spark = spark
        self.cluster_files = cluster_files  # a fixed number of key ranges; by size (adaptive execution) if None
        self.path = path.rstrip("/")
        self.fs = FS(spark)
        self._bucket_by = bucket_by
        self._buckets = buckets
        self._cluster_by = cluster_by
        self._stored_layout = False
        self.last_entries: list = []
        self._manifests: dict[int, Manifest] = {}  # manifests are immutable once written

    # ------------------------------------------------------------------ metadata
    @property
    def _mdir(self) -> str:
        return f"{self.path}/_manifest"

    def versions(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in self.fs.ls(self._mdir) if n.endswith(".json"))

    def version(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def exists(self) -> bool:
        return self.version() is not None

    def manifest(self, version: int | None = None) -> Manifest:
        v = self.version() if version is None else version
        if v is None:
            raise FileNotFoundError(f"table {self.path} does not exist")
        if v not in self._manifests:
            self._manifests[v] = Manifest.from_json(self.fs.read_text(f"{self._mdir}/{v:020d}.json"))
        return self._manifests[v]

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.manifest().schema))

    def _layout(self):
        """The stored layout; what the constructor asks for counts only for a table that is still to be made."""
        if not self._stored_layout and self.exists():
            m = self.manifest()
            if self._buckets is not None and m.buckets is not None and self._buckets != m.buckets:
                raise ValueError(f"table {self.path} has {m.buckets} buckets, not {self._buckets}; "
                                 "write a new table to change the number")
            self._bucket_by, self._buckets, self._cluster_by = m.bucket_by, m.buckets, self._cluster_by or m.cluster_by
            self._stored_layout = True
        return self._bucket_by or None, self._buckets, self._cluster_by

    @property
    def bucket_by(self):
        return self._layout()[0]

    @property
    def buckets(self):
        return self._layout()[1]

    def committed(self, txn: tuple[str, int] | None) -> bool:
        """True when the writer's batch ``txn`` is already part of the latest version."""
        if txn is None or not self.exists():
            return False
        writer, batch = txn
        last = self.manifest().txns.get(writer)
        return last is not None and int(last) >= int(batch)

    def _commit(self, build, txn=None, retries: int = 20) -> bool:
        """Create the next manifest from ``build(previous) -> Manifest``; retried when a writer raced us."""
        for _ in range(retries):
            prev_v = self.version()
            prev = self.manifest(prev_v) if prev_v is not None else None
            if txn is not None and prev is not None and self.committed(txn):
                return False
            m = build(prev)
            m.version = 0 if prev_v is None else prev_v + 1
            m.ts = time.time()
            m.txn_entries = dict(prev.txn_entries) if prev else {}
            if txn is not None:
                m.txns = dict(prev.txns if prev else {})
                m.txns[txn[0]] = int(txn[1])
                m.txn_entries[txn[0]] = list(self.last_entries)
            elif prev is not None:
                m.txns = dict(prev.txns)
            if self.fs.write_text(f"{self._mdir}/{m.version:020d}.json", m.to_json()):
                return True
        raise RuntimeError(f"could not commit to {self.path}: too many concurrent writers")

    # ------------------------------------------------------------------ reads
    def read(self, version: int | None = None, buckets: list[int] | None = None,
             kinds: set | None = None) -> DataFrame:
        """A snapshot; optionally only some buckets and segment kinds (e.g. the open SCD 2 versions)."""
        m = self.manifest(version)
        schema = T.StructType.fromJson(json.loads(m.schema))
        entries = m.entries
        if buckets is not None:
            wanted = set(int(b) for b in buckets)
            entries = [e for e in entries if e.get("bucket") in wanted]
        if kinds is not None:
            entries = [e for e in entries if e.get("kind") in kinds]
        paths = [e["path"] for e in entries]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read_entries(self, entries: list[dict]) -> DataFrame:
        """Rows of specific segments (e.g. the ones one micro-batch appended)."""
        schema = self.schema()
        paths = [e["path"] for e in entries]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def batch_entries(self, writer: str) -> list[dict]:
        """Segments appended by ``writer``'s last committed batch."""
        return list(self.manifest().txn_entries.get(writer, [])) if self.exists() else []

    def history(self) -> DataFrame:
        rows = []
        for v in self.versions():
            m = self.manifest(v)
            rows.append((v, m.operation, len(m.entries), float(m.ts), json.dumps(m.txns, sort_keys=True)))
        return self.spark.createDataFrame(
            rows, "version long, operation string, segments long, committed_at double, txns string")

    def detail(self) -> DataFrame:
        """Files, rows-free size and layout of the current version (K16), computed from file metadata."""
        return file_listing(self.read()).agg(F.count("*").alias("num_files"), F.sum("file_size").alias("size_in_bytes"))

    # ------------------------------------------------------------------ writes
    def _write_segment(self, df: DataFrame, kind_col: str | None = None) -> list[dict]:
        self.last_entries = self._write(df, kind_col)
        return self.last_entries

    def _write(self, df: DataFrame, kind_col: str | None = None) -> list[dict]:
        """Write one segment.  ``kind_col`` (bucketed tables): a string column whose value tags each
        sub-folder in the manifest (``kind``), e.g. open / closed SCD 2 versions; it is not stored."""
        seg = f"{self.path}/data/{uuid.uuid4().hex}"
        keys, n, cluster = self._layout()
        if keys and n:
            # rows of a bucket go to the same writer (few files per bucket), but as a *rebalance*: AQE splits a
            # bucket that a hot key made too large over several tasks instead of one task writing it all
            out = df.withColumn(BUCKET_COL, bucket_expr(keys, n)).hint("rebalance", BUCKET_COL)
            out = out.sortWithinPartitions(BUCKET_COL, *cluster) if cluster else out
            parts = [BUCKET_COL] + ([kind_col] if kind_col else [])
            out.write.partitionBy(*parts).parquet(seg)
            found = []
            for name in self.fs.ls(seg):
                if not name.startswith(BUCKET_COL + "="):
                    continue
                b = int(name.split("=", 1)[1])
                if not kind_col:
                    found.append({"path": f"{seg}/{name}", "bucket": b})
                    continue
                for sub in self.fs.ls(f"{seg}/{name}"):
                    if sub.startswith(kind_col + "="):
                        found.append({"path": f"{seg}/{name}/{sub}", "bucket": b, "kind": sub.split("=", 1)[1]})
            return found
        if cluster:
            number = [self.cluster_files] if self.cluster_files else []
            df = df.repartitionByRange(*number, *cluster).sortWithinPartitions(*cluster)
        df.write.parquet(seg)
        return [{"path": seg, "bucket": None}]

    def _meta(self, prev: Manifest | None, schema: T.StructType, op: str, entries: list) -> Manifest:
        return Manifest(
            version=0, schema=schema.json(), entries=entries, operation=op,
            properties=dict(prev.properties) if prev else {},
            comment=prev.comment if prev else None,
            bucket_by=self.bucket_by, buckets=self.buckets,
            cluster_by=self._layout()[2] or (prev.cluster_by if prev else None))

    def overwrite(self, df: DataFrame, txn=None, comment: str | None = None,
                  properties: dict | None = None) -> "Table":
        """Create or replace the table content with ``df`` (K1); also the refresh of a materialized view."""
        if self.committed(txn):
            return self
        entries = self._write_segment(df)
        schema = df.schema

        def build(prev):
            m = self._meta(prev, schema, "OVERWRITE" if prev else "CREATE", entries)
            if comment is not None:
                m.comment = comment
            if properties:
                m.properties.update(properties)
            return m

        self._commit(build, txn)
        return self

    def create_if_absent(self, schema: T.StructType) -> "Table":
        if not self.exists():
            self._commit(lambda prev: self._meta(prev, schema, "CREATE", []))
        return self

    def append(self, df: DataFrame, txn=None, by_name: bool = True) -> "Table":
        """Insert rows; the table is created empty if absent (K2).  Columns are matched by name."""
        if self.committed(txn):
            return self
        if not self.exists():
            self.create_if_absent(df.schema)
        schema = self.schema()
        data = align_by_name(df, schema) if by_name else df
        entries = self._write_segment(data)

        def build(prev):
            return self._meta(prev, schema, "APPEND", list(prev.entries if prev else []) + entries)

        self._commit(build, txn)
        return self

    def replace_buckets(self, df: DataFrame, buckets: list[int], txn=None, op: str = "MERGE",
                        drop_kinds: set | None = None, kind_col: str | None = None,
                        base_version: int | None = None, whole: list[int] = ()) -> "Table":
        """Replace the given buckets with ``df`` in one commit (rows of other buckets in ``df`` are an error).

        ``drop_kinds`` limits what is removed from those buckets to segments of these kinds (others stay), except
        in the buckets of ``whole``;
        ``kind_col`` tags the new segments (see ``_write``).  ``base_version`` is the version ``df`` was
        computed from: if another writer changed any of these buckets since, the commit is refused instead
        of losing that writer's update (optimistic concurrency).
        """
        if self.committed(txn):
            return self
        if base_version is None:
            base_version = self.version()
        touched = set(int(b) for b in buckets)
        entries = self._write_segment(df, kind_col)
        bad = [e for e in entries if e["bucket"] not in touched]
        if bad:
            raise ValueError(f"rows outside the replaced buckets: {bad[:3]}")
        schema = df.drop(kind_col).schema if kind_col else df.schema

        def gone(e):
            return e.get("bucket") in touched and (drop_kinds is None or e.get("kind") in drop_kinds
                                                   or e["bucket"] in whole)

        def in_touched(m):
            return sorted(e["path"] for e in (m.entries if m else []) if e.get("bucket") in touched)

        base = self.manifest(base_version) if base_version is not None else None

        def build(prev):
            if prev is not None and base is not None and prev.version != base.version \
                    and in_touched(prev) != in_touched(base):
                raise RuntimeError(f"{self.path}: buckets changed by another writer since version "
                                   f"{base.version}; recompute and retry")
            keep = [e for e in (prev.entries if prev else []) if not gone(e)]
            return self._meta(prev, schema, op, keep + entries)

        self._commit(build, txn)
        return self

    def merge(self, source: DataFrame, keys: list[str], txn=None, check_unique: bool = True) -> "Table":
        """Upsert on ``keys`` (K3): matched rows are replaced by the source row, others inserted.

        Duplicate source keys are rejected, as a MERGE would; without ``check_unique`` every source row is kept.  On
        a bucketed table only the buckets that the source touches are read and rewritten.
        """
        if not keys:
            raise ValueError("merge: at least one key column is required")
        if self.committed(txn):
            return self
        if not self.exists():
            self.create_if_absent(source.schema)
        schema = self.schema()
        src = align_by_name(source, schema)
        if check_unique:
            refuse_duplicates(src, keys)
        key_cond = [src[k].isNotNull() for k in keys]
        base_version = self.version()
        if self.bucket_by and self.buckets:
            touched = [r[0] for r in src.select(bucket_expr(self.bucket_by, self.buckets).alias("b"))
                       .distinct().collect()]  # at most `buckets` values
            old = self.read(version=base_version, buckets=touched)
            kept = old.join(src.where(_all(key_cond)).select(*keys), keys, "left_anti")
            self.replace_buckets(kept.unionByName(src), touched, txn=txn, op="MERGE", base_version=base_version)
            return self
        old = self.read()
        kept = old.join(src.where(_all(key_cond)).select(*keys), keys, "left_anti")
        merged = kept.unionByName(src)
        entries = self._write_segment(merged)

        def build(prev):
            return self._meta(prev, schema, "MERGE", entries)

        self._commit(build, txn)
        return self

    def set_comment(self, comment: str | None = None, properties: dict | None = None) -> "Table":
        """Table comment and properties (K5), stored in the manifest."""
        def build(prev):
            m = self._meta(prev, T.StructType.fromJson(json.loads(prev.schema)), "SET PROPERTIES",
                           list(prev.entries))
            if comment is not None:
                m.comment = comment
            m.properties.update(properties or {})
            return m

        self._commit(build)
        return self

    def optimize(self, target_bytes: int = 128 * 1024 ** 2, min_segments: int = 4) -> int:
        """Rewrite small segments together (per bucket and kind), so streaming tables do not accumulate
        thousands of tiny files.  Content and old versions are unchanged; returns segments compacted.

        Open SCD 2 segments are left alone (each batch rewrites them anyway).  The commit checks that every
        compacted segment is still live, so a concurrent merge that removed one wins and this is skipped.
        """
        if not self.exists():
            return 0
        m = self.manifest()
        sizes = {e["path"]: self.fs.du(e["path"]) for e in m.entries if e.get("kind") != "open"}
        small = [e for e in m.entries if e["path"] in sizes and sizes[e["path"]] < target_bytes]
        if len(small) < min_segments:
            return 0
        df = self.read_entries(small)
        kinds = {e.get("kind") for e in small}
        if kinds - {None}:
            df = df.withColumn("_kind", F.lit("closed"))
            entries = self._write_segment(df, "_kind")
        elif self.bucket_by and self.buckets:
            entries = self._write_segment(df)  # one file per bucket
        else:
            total = sum(sizes[e["path"]] for e in small)
            entries = self._write_segment(df.coalesce(max(1, -(-total // target_bytes))))  # ~target-sized files
        paths = {e["path"] for e in small}
        schema = self.schema()

        def build(prev):
            live = {e["path"] for e in prev.entries}
            if not paths <= live:
                raise RuntimeError("optimize: a compacted segment was removed concurrently; retry later")
            return self._meta(prev, schema, "OPTIMIZE", [e for e in prev.entries if e["path"] not in paths] + entries)

        self._commit(build)
        return len(small)


def refuse_duplicates(source: DataFrame, keys: list[str]) -> None:
    """Raises if a key comes more than once in ``source``."""
    dup = source.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if dup:
        raise ValueError(f"merge: duplicate keys in the source, e.g. {dup[0].asDict()}")


def _all(conds: list[Column]) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


class Catalog:
    """Named tables under one root folder; registers snapshots as temp views for SQL access.

    ``places`` gives the folder of tables that don't lie under their own name; it is asked each time a table is
    named, so that a switch of folders reaches every reader."""

    def __init__(self, spark: SparkSession, root: str, places: Callable[[], dict] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.places = places or dict

    def table(self, name: str, **kw) -> Table:
        validate_table_name(name)
        place = self.places().get(name, name.replace(".", "/"))
        return Table(self.spark, f"{self.root}/{place}", **kw)

    def read(self, name: str) -> DataFrame:
        return self.table(name).read()

    def view(self, name: str) -> DataFrame:
        df = self.read(name)
        df.createOrReplaceTempView(name.split(".")[-1])
        return df

    def refresh(self, name: str, df: DataFrame, **kw) -> Table:
        """Create or refresh a materialized view: recompute, write a new snapshot, swap (K4)."""
        return self.table(name).overwrite(df, **kw)
