"""File sources (S1–S3, S6): incremental JSON-lines stream with persisted schema, rescue and lineage.

Open-source Spark's file stream source needs a schema and silently drops unknown JSON fields.  So:

1. the schema is inferred once (batch ``read.json`` over the files present, optionally sampled) and
   persisted next to the checkpoint; later runs and restarts reuse it, so types never drift between runs;
2. files are streamed as *text* lines and parsed with ``from_json`` against that schema; the same line is
   also parsed as ``map<string,string>``, and ``_rescued_data`` keeps, as JSON, every key the schema does
   not know plus every value that failed to convert (the rest of the row survives); a line that is not
   JSON at all is rescued whole;
3. lineage columns come from the hidden ``_metadata`` column of the file source.

The stream's checkpoint is the file log: each run (``trigger(availableNow=True)``) reads only unseen files.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.sinks.fs import FS

RESCUED = "_rescued_data"
LINEAGE = ["source_entity", "_source_file", "_source_file_ts", "_ingested_at"]


def infer_json_schema(spark: SparkSession, path: str, glob: str = "*.json",
                      sampling_ratio: float = 1.0) -> T.StructType:
    reader = spark.read.option("pathGlobFilter", glob).option("samplingRatio", sampling_ratio)
    schema = reader.json(path).schema
    return T.StructType([f for f in schema.fields if f.name != "_corrupt_record"])


def persisted_schema(spark: SparkSession, path: str, schema_location: str, glob: str = "*.json",
                     sampling_ratio: float = 1.0) -> T.StructType:
    """The schema stored at ``schema_location``; inferred from the files and stored on first use."""
    fs = FS(spark)
    f = f"{schema_location.rstrip('/')}/schema.json"
    if fs.exists(f):
        return T.StructType.fromJson(json.loads(fs.read_text(f)))
    schema = infer_json_schema(spark, path, glob, sampling_ratio)
    fs.write_text(f, schema.json())
    # another run may have won the race: read back whatever was stored
    return T.StructType.fromJson(json.loads(fs.read_text(f)))


def parse_json_lines(df: DataFrame, line: str, schema: T.StructType, keep: list[Column] | None = None) -> DataFrame:
    """Typed columns of ``schema`` plus ``_rescued_data`` from the JSON text column ``line``.

    The line is parsed once into a struct and once into a ``map<string,string>``; both are materialised as
    columns first, so the per-key test inside ``map_filter`` reads them instead of re-parsing the line; that test is a
    look into one list, so a line's cost does not grow with the square of its number of keys.
    """
    names = [f.name for f in schema.fields]
    text = F.col(line)
    step = df.select(*(keep or []), text.alias("__text"),
                     F.from_json(text, schema, {"mode": "PERMISSIVE"}).alias("__parsed"),
                     F.from_json(text, T.MapType(T.StringType(), T.StringType()), {"mode": "PERMISSIVE"}).alias("__raw"))
    parsed, raw = F.col("__parsed"), F.col("__raw")

    # known keys whose values converted; an array of one, so that it is made once for each line and not for each key
    read = F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(parsed[n].isNotNull(), F.lit(n)) for n in names]))
    leftovers = F.get(F.transform(F.array(read), lambda known: F.map_filter(
        raw, lambda k, v: v.isNotNull() & ~F.array_contains(known, k))), F.lit(0))
    rescued = (F.when(raw.isNull(), F.to_json(F.create_map(F.lit("_line"), F.col("__text"))))
               .when(F.size(leftovers) > 0, F.to_json(leftovers)))
    kept_names = [c for c in step.columns if c not in ("__text", "__parsed", "__raw")]
    return step.select(*kept_names, *[parsed[n].alias(n) for n in names], rescued.alias(RESCUED))


def lineage(entity: str, meta: str = "__meta") -> list[Column]:
    return [F.lit(entity).alias("source_entity"),
            F.col(f"{meta}.file_path").alias("_source_file"),
            F.col(f"{meta}.file_modification_time").alias("_source_file_ts"),
            F.current_timestamp().alias("_ingested_at")]


def _lines(df: DataFrame) -> DataFrame:
    """Raw text lines with the file metadata, renamed so a JSON field called ``value`` cannot clash."""
    return (df.select(F.col("value").alias("__line"), F.col("_metadata").alias("__meta"))
            .where(F.trim(F.col("__line")) != ""))


def read_json_stream(spark: SparkSession, path: str, entity: str, schema_location: str,
                     glob: str = "*.json", max_files_per_trigger: int | None = None,
                     schema: T.StructType | None = None) -> DataFrame:
    """Incremental JSON-lines source of one entity (S1) with rescue (S3) and lineage columns."""
    schema = schema or persisted_schema(spark, path, schema_location, glob)
    reader = spark.readStream.format("text").option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    lines = _lines(reader.load(path)).select("__line", *lineage(entity))
    return _reorder(parse_json_lines(lines, "__line", schema, [F.col(c) for c in LINEAGE]), schema)


def read_json_batch(spark: SparkSession, path: str, entity: str, schema: T.StructType,
                    glob: str = "*.json") -> DataFrame:
    """Batch twin of ``read_json_stream`` (full refresh, tests)."""
    lines = _lines(spark.read.format("text").option("pathGlobFilter", glob).load(path)).select(
        "__line", *lineage(entity))
    return _reorder(parse_json_lines(lines, "__line", schema, [F.col(c) for c in LINEAGE]), schema)


def _reorder(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Data columns, then ``_rescued_data``, then the lineage columns."""
    return df.select(*[f.name for f in schema.fields], RESCUED, *LINEAGE)


def _clean_option(key: str, value):
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return str(value)
    s = str(value)
    if len(s) >= 2 and s[0] == s[-1] and s[0] in "'\"":
        s = s[1:-1]
    return s


def read_files(spark: SparkSession, path: str, format: str = "parquet", **options) -> DataFrame:
    """File source with options (S6): ``format`` csv / json / parquet / text / orc.

    Booleans become ``true``/``false``, surrounding quotes are stripped, ``headerRows`` maps to ``header``.
    Spreadsheet formats are not supported (no Spark source for them).
    """
    if not path:
        raise ValueError("file source: 'path' is required")
    fmt = (format or "parquet").lower()
    if fmt in ("excel", "xlsx", "xls"):
        raise ValueError("file source: spreadsheet files are not supported; convert to CSV or Parquet")
    opts = {}
    for k, v in options.items():
        if k == "headerRows":
            opts["header"] = "true" if (v is True or (not isinstance(v, bool) and int(v) > 0)) else "false"
        elif k != "dataAddress":
            opts[k] = _clean_option(k, v)
    return spark.read.format(fmt).options(**opts).load(path)


def file_listing(df: DataFrame, *measures: Column) -> DataFrame:
    """The files behind ``df``, a frame read from files: path, size and rows of each, and further ``measures``."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")) \
        .agg(F.count(F.lit(1)).alias("rows"), *measures)
