"""File exports (K7–K15): CSV / JSON with fixed text rendering, formula guard, split by column, guards.

Exports are distributed Spark writes (one file per task), not a driver-side single file.  The reference's
single-file limits (rows, cells, estimated bytes) apply only when ``single_file=True`` asks for one file,
because that is the case where one task must hold everything; they are checked with bounded jobs
(``limit(cap + 1).count()`` and one ``sum(length)``) before writing.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.columns import quote_ident
from medallion.sinks.fs import FS

# Fixed values (export behaviour): formula-injection lead characters, and single-file limits.
FORMULA_LEADS = ["=", "+", "-", "@", "\t", "\r"]
MAX_ROWS = 1_000_000
MAX_CELLS = 50_000_000
MAX_BYTES = 2 * 1024 ** 3
BYTES_PER_CELL = 16
MAX_GROUPS = 50
GROUP_COL = "file_group"
NULL_GROUP = "none"
_UNSAFE = r'[/\\:*?"<>|\x00-\x1f]'

SCALAR = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
          T.DecimalType, T.StringType, T.CharType, T.VarcharType, T.DateType, T.TimestampType,
          T.TimestampNTZType, T.NullType)


def validate_name(name: str) -> str:
    """An output file or folder name must be relative and stay inside its base folder."""
    if not name or name.startswith("/") or "/" in name or "\\" in name or ".." in name:
        raise ValueError(f"invalid output name {name!r}: no '/', no '..', no absolute path")
    return name


def render(c: Column, dt: T.DataType) -> Column:
    """Text form of one value: True/False, 'nan', timestamps without zero microseconds, others as text."""
    if isinstance(dt, T.BooleanType):
        return F.when(c.isNull(), F.lit(None)).when(c, F.lit("True")).otherwise(F.lit("False"))
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.when(F.isnan(c), F.lit("nan")).otherwise(c.cast("string"))
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        return F.when(F.date_format(c, "SSSSSS") == "000000", whole).otherwise(
            F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    if isinstance(dt, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dt, T.BinaryType):
        return F.base64(c)
    if isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    return c.cast("string")


def guard(c: Column) -> Column:
    """Prefix ``'`` to text starting with a formula lead character (K9)."""
    return F.when(F.substring(c, 1, 1).isin(*FORMULA_LEADS), F.concat(F.lit("'"), c)).otherwise(c)


def rendered(df: DataFrame, formula_guard: bool = True, keep: tuple = ()) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name in keep:
            cols.append(F.col(quote_ident(f.name)))
            continue
        c = render(F.col(quote_ident(f.name)), f.dataType)
        if formula_guard and isinstance(f.dataType, (T.StringType, T.CharType, T.VarcharType)):
            c = guard(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def check_single_file_limits(df: DataFrame, max_rows: int | None = None) -> None:
    """Row, cell and byte limits of a one-file export (K12), from one pass that stops beyond the row limit."""
    max_rows = MAX_ROWS if max_rows is None else max_rows
    size = sum((F.coalesce(F.length(F.col(quote_ident(c)).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    n, size = df.select(size.cast("long").alias("n")).limit(max_rows + 1).agg(F.count("*"), F.sum("n")).first()
    if n > max_rows:
        raise ValueError(f"export exceeds {max_rows:,} rows in one file; write to a table instead")
    cells = n * len(df.columns)
    if cells > MAX_CELLS:
        raise ValueError(f"export exceeds {MAX_CELLS:,} cells in one file; write to a table instead")
    if (size or 0) + BYTES_PER_CELL * cells > MAX_BYTES:
        raise ValueError("export is estimated above 2 GiB for one file; write to a table instead")


def _columns_file(path: str) -> str:
    return f"{path.rstrip('/')}/_columns.json"


def _order_for_append(df: DataFrame, path: str) -> list[str]:
    """The columns of ``df`` in the order of the existing export, which must have the same ones."""
    fs = FS(df.sparkSession)
    if not fs.exists(_columns_file(path)):
        if any(not n.startswith(("_", ".")) for n in fs.ls(path)):
            raise ValueError(f"append: {path} holds files whose columns are not known")
        return df.columns
    existing = json.loads(fs.read_text(_columns_file(path)))
    if sorted(existing) != sorted(df.columns):
        raise ValueError(f"append: columns {sorted(df.columns)} differ from the existing export {sorted(existing)}")
    return existing


def _remember_columns(df: DataFrame, path: str) -> None:
    FS(df.sparkSession).write_text(_columns_file(path), json.dumps(df.columns), overwrite=True)


def _write(df: DataFrame, path: str, fmt: str, mode: str, single_file: bool, partition_by=None, **opts):
    if mode not in ("overwrite", "append"):
        raise ValueError("export mode must be 'overwrite' or 'append'")
    own = df.drop(partition_by) if partition_by else df
    if mode == "append":
        order = _order_for_append(own, path)
        df = df.select(*map(quote_ident, order), *([partition_by] if partition_by else []))
    if single_file:
        check_single_file_limits(df)
        df = df.coalesce(1)
    w = df.write.mode(mode).option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.format(fmt).options(**opts).save(path)
    if mode == "overwrite" or not FS(df.sparkSession).exists(_columns_file(path)):
        _remember_columns(own, path)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False,
               formula_guard: bool = True) -> str:
    """CSV with header and the fixed rendering (K8); strings guarded against formula injection (K9)."""
    _write(rendered(df, formula_guard), path, "csv", mode, single_file, header="true", escape='"')
    return path


def export_json(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> str:
    """JSON lines (K7); an append must bring the same column set."""
    _write(df, path, "json", mode, single_file)
    return path


def group_names(df: DataFrame, column: str, max_groups: int = MAX_GROUPS, known: dict | None = None) -> dict:
    """``value -> name`` for split exports: NULL → 'none', unsafe path characters removed, names that are taken
    continued with ``_2``, ``_3``…  ``known`` are the names already given, which stay; ``max_groups`` counts both."""
    if column not in df.columns:
        raise ValueError(f"split export: column {column!r} not found")
    dt = df.schema[column].dataType
    if not isinstance(dt, SCALAR):
        raise ValueError(f"split export: column {column!r} has type {dt.simpleString()}; only scalar types")
    names = dict(known or {})
    found = df.select(F.col(quote_ident(column)).cast("string")).distinct().limit(len(names) + max_groups + 1).collect()
    taken = {n.lower() for n in names.values()}
    for value in sorted((r[0] for r in found if r[0] not in names), key=lambda v: (v is None, v or "")):
        base = NULL_GROUP if value is None else re.sub(_UNSAFE, "", value).replace("..", "").strip() or NULL_GROUP
        name, n = base, 1
        while name.lower() in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name.lower())
        names[value] = name
    if len(names) > max_groups:
        raise ValueError(f"split export: more than {max_groups} groups in {column!r}")
    return names


def export_split(df: DataFrame, path: str, column: str, fmt: str = "csv", mode: str = "overwrite",
                 max_groups: int = MAX_GROUPS) -> str:
    """One sub-folder ``file_group=<name>`` for each value of ``column`` (K10).  Overwrite replaces every group; append
    adds files, a value of the earlier export under its stored name and a new one under a free name (K11)."""
    fs, stored = FS(df.sparkSession), f"{path.rstrip('/')}/_groups.json"
    known = dict(map(tuple, json.loads(fs.read_text(stored)))) if mode == "append" and fs.exists(stored) else {}
    names = group_names(df, column, max_groups, known)
    table = df.sparkSession.createDataFrame(list(names.items()), "value string, name string")
    keyed = df.withColumn("__v", F.col(quote_ident(column)).cast("string"))
    out = keyed.join(F.broadcast(table), keyed["__v"].eqNullSafe(table["value"]), "left") \
        .drop("__v", "value").withColumnRenamed("name", GROUP_COL)  # at most max_groups rows are broadcast
    data = rendered(out, True, keep=(GROUP_COL,)) if fmt == "csv" else out
    opts = {"header": "true", "escape": '"'} if fmt == "csv" else {}
    _write(data, path, fmt, mode, False, partition_by=GROUP_COL, **opts)
    fs.write_text(stored, json.dumps(sorted(names.items(), key=lambda x: x[1])), overwrite=True)
    return path
