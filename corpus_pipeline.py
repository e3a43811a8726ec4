"""The corpus pipeline: ``documents`` through the operators of ``medallion.llm``, stage by stage.

Each stage takes what its predecessor kept, and its decisions take effect; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm import decontaminate as decon
from medallion.llm import jaccard_join, language_id, line_dedup, packing
from medallion.llm.common import cut, table
from medallion.session import work_dir

MIN_LANGUAGE_SCORE = 0.5


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a recognised language go.  Learned from the given documents themselves."""
    found = language_id.annotate(docs, language_id.training_rows(docs))
    return found.where((F.col("__lang") != "und") & (F.col("__score") >= MIN_LANGUAGE_SCORE)).select(docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: cross-site boilerplate lines removed; a document of nothing else goes."""
    out = line_dedup.line_dedup(docs).where((F.col("lines_removed") == 0) | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        size = F.when(F.col("lines_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of linked documents the one with the smallest id stays (null ids come last).

    A document is an id with a text: documents that share an id are told apart by a key of both, rows that repeat one
    are one document, of which the row with the least hash stays.  So what stays depends on the rows alone.  Should two
    documents ever share a key, both stay."""
    other, row = F.xxhash64(F.lit(1), F.reverse("text"), "doc_id"), F.xxhash64(*docs.columns)
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    groups = jaccard_join.jaccard_groups(keyed, id_col="__key").select(F.col("doc_id").alias("__key"), "component_id").distinct()
    known = keyed.groupBy("__key").agg(F.min("doc_id").alias("id"), F.min(row).alias("__row"),
                                       (F.min(other) != F.max(other)).alias("__two"))
    known = cut(known.join(groups, "__key"))
    best = known.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "__key"))["__key"].alias("best"))
    kept = known.join(best, "component_id").where("__key = best or __two").select("__key", "__row", "__two")
    return keyed.withColumn("__hash", row).join(kept, "__key").where("__two or __hash = __row") \
        .dropDuplicates(["__key", "__hash"]).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark window go."""
    return decon.annotate(docs, table(spark, sf_dir, "benchmark")).where("__n_hit = 0").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of what is left into sequences of 1024 tokens."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", keep_languages), ("line_dedup", drop_boilerplate), ("jaccard_join", drop_near_copies),
          ("decontaminate", drop_contaminated), ("pack", pack)]
ORACLE_SQL = None  # language ID and packing are no SQL; tests compare the stages with brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs, root = table(spark, sf_dir, "documents"), work_dir(spark, "corpus_pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{root}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
