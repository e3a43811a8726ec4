"""Line dedup by distinct-site spread: cross-site boilerplate lines are removed, all but their first copy.

A line (between line feeds, outer blanks trimmed, not empty) is boilerplate when it stands on at least
``min_sites`` different sites.  The sites of each line hash go into a HyperLogLog sketch, merged by aggregation.
Lines whose estimate is within ``band`` times of the threshold get an exact distinct count; estimates beyond it
decide themselves (the sketch's error is about 2 %).  Boilerplate lines are removed from every document except
the one with the smallest id among those that hold the line (there all its copies stay), so that content which
was only copied between sites is never lost altogether.

Defined results: null text stays null with no lines; a null site counts as one site of its own; rows with the
same id share the decision; rows with a null id never lose a line and don't hold a line's first copy.  An empty text
is one blank line, and blank lines are never removed; texts of any length are read whole.  Ties: repeated rows of a
line's smallest id all keep it.  An empty table gives no rows.  Other columns travel along unread, whatever their names;
``lines_seen`` and ``lines_removed`` replace columns of those names.

Native DataFrame plan.  Text is shuffled once, for the documents with something to remove to meet their lines;
before that only 64-bit line hashes move.  A line on a third of all documents is pre-combined in every task, and
its occurrences join the small boilerplate table in a join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\r\x0b\x0c"


def _line_hash(line):
    line = F.btrim(line, F.lit(BLANKS))
    return F.when(line != "", F.xxhash64(line))


def _occurrences(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    lines = F.split(F.col(text_col), "\n", -1)
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(site_col).cast("string"), F.lit("\0")).alias("site"),
        F.explode(F.array_distinct(F.transform(lines, _line_hash))).alias("line")).where("line is not null")


def boilerplate_lines(docs: DataFrame, min_sites: int = 10, band: float = 2.0, id_col: str = "doc_id",
                      text_col: str = "text", site_col: str = "source") -> DataFrame:
    """(line, first_doc): hashes of the lines on at least ``min_sites`` sites, and the id that keeps each."""
    seen = _occurrences(docs, id_col, text_col, site_col)
    spread = seen.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(12))).alias("sites"), F.min("doc_id").alias("first_doc"))
    near = spread.where(F.col("sites").between(min_sites / band, min_sites * band))
    exact = seen.join(near.select("line"), "line", "left_semi").groupBy("line", "site") \
        .agg(F.min("doc_id").alias("first_doc")).groupBy("line") \
        .agg(F.count("*").alias("sites"), F.min("first_doc").alias("first_doc")).where(F.col("sites") >= min_sites)
    sure = spread.where(F.col("sites") > min_sites * band)
    return sure.select("line", "first_doc").unionByName(exact.select("line", "first_doc"))


def line_dedup(docs: DataFrame, min_sites: int = 10, band: float = 2.0, id_col: str = "doc_id",
               text_col: str = "text", site_col: str = "source") -> DataFrame:
    """The input's columns with the boilerplate lines taken out of ``text_col``, plus ``lines_seen`` and
    ``lines_removed`` (replacing columns of those names)."""
    boiler = boilerplate_lines(docs, min_sites, band, id_col, text_col, site_col)
    gone = _occurrences(docs, id_col, text_col, site_col).select("doc_id", "line").join(boiler, "line") \
        .where("doc_id > first_doc").groupBy("doc_id").agg(F.collect_set("line").alias("gone")) \
        .select(F.col("doc_id").alias("__id"), F.col("gone").alias("__gone"))
    lines = F.split(F.col(text_col), "\n", -1)
    kept = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col("__gone"), _line_hash(x)), F.lit(False)))
    n_lines, n_kept = F.coalesce(F.size(lines), F.lit(0)), F.coalesce(F.size("__kept"), F.lit(0))
    others = [F.col(c) for c in docs.columns if c not in (text_col, "lines_seen", "lines_removed")]
    return docs.join(gone, docs[id_col] == gone["__id"], "left") \
        .withColumn("__kept", F.when(F.col("__gone").isNull(), lines).otherwise(kept)) \
        .select(*others, F.array_join("__kept", "\n").alias(text_col),
                F.when(F.col(text_col).isNull(), 0).otherwise(n_lines).cast("long").alias("lines_seen"),
                F.when(F.col(text_col).isNull(), 0).otherwise(n_lines - n_kept).cast("long").alias("lines_removed"))
