"""Classify free text into given labels (X1) and classify-distinct-then-join.

The hosted language model of the reference is not available; the scorer is pluggable.  The default one is
pure Column expressions: each label has regular expressions, a label's score is the number of its patterns
found in the *whole* text (case-insensitive, ``rlike`` in the JVM), the best score wins (ties by label
order) and a text matching nothing gets ``default``.  The output has the reference's shape, a JSON string
``{"response":["<label>"]}``, so ``get_json_object(col, '$.response[0]')`` extracts the label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions.columns import as_column, quote_ident

# The reason labels of the HR application, in the order given to the classifier.
HR_REASON_LABELS = ["santé", "famille", "formation", "lié au travail", "personnel"]

# Keyword patterns of our keyword scorer for those labels (our own configuration, not the reference's).
HR_REASON_PATTERNS = {
    "santé": ["m[ée]dec", "malad", "h[ôo]pital", "op[ée]ration", "soins", "sant[ée]", "grippe", "bless"],
    "famille": ["enfant", "famil", "mariage", "naissance", "d[ée]c[èe]s", "parent", "cr[èe]che"],
    "formation": ["formation", "cours", "certifi", "s[ée]minaire", "examen", "dipl[ôo]me", "atelier"],
    "lié au travail": ["accident du travail", "stress", "burn", "surcharge", "[ée]puisement", "conflit"],
    "personnel": ["d[ée]m[ée]nag", "personnel", "administrati", "d[ée]marche"],
}


def label_expr(text, patterns: dict[str, list[str]], default: str | None = None) -> Column:
    """The winning label as a Column (NULL text stays NULL).  Each pattern is tried once: the greatest of
    (hits, earlier label) carries its label along."""
    t = as_column(text)
    ranked = [F.struct(sum((F.when(t.rlike("(?i)" + p), 1).otherwise(0) for p in ps), F.lit(0)).alias("hits"),
                       F.lit(-i).alias("place"), F.lit(label).alias("label"))
              for i, (label, ps) in enumerate(patterns.items())]
    best = F.array_max(F.array(*ranked))
    fallback = F.lit(default if default is not None else list(patterns)[-1])
    # one pass over a one-element array names the winner, so that it isn't computed again for the test
    named = F.transform(F.array(best), lambda w: F.when(w["hits"] > 0, w["label"]).otherwise(fallback))[0]
    return F.when(t.isNotNull(), named)


def classify(df: DataFrame, text_col: str, patterns: dict[str, list[str]], out_col: str = "category_json",
             default: str | None = None, as_json: bool = True) -> DataFrame:
    """Add ``out_col``: the label as ``{"response":["label"]}`` JSON (or plain text when ``as_json=False``)."""
    lab = label_expr(F.col(quote_ident(text_col)), patterns, default)
    if as_json:
        lab = F.when(lab.isNull(), F.lit(None).cast("string")).otherwise(
            F.to_json(F.struct(F.array(lab).alias("response"))))
    return df.withColumn(out_col, lab)


def classify_distinct(df: DataFrame, text_col: str, patterns: dict[str, list[str]],
                      out_col: str = "category_json", default: str | None = None,
                      as_json: bool = True) -> DataFrame:
    """Classify each distinct text once, then join the label back (X2 + J11); rows without a text keep a NULL label.

    For scorers that cost more than a shuffle of the texts.  Texts are told apart by a 128-bit hash, so only the
    distinct ones travel as text, and equal texts of many rows are pre-combined in every task.
    """
    text = F.col(quote_ident(text_col))
    rows = df.withColumn("__h1", F.xxhash64(text)).withColumn("__h2", F.xxhash64(F.reverse(text), F.lit(1)))
    texts = rows.where(text.isNotNull()).groupBy("__h1", "__h2").agg(F.first(text).alias("__text"))
    labelled = classify(texts, "__text", patterns, out_col, default, as_json).drop("__text")
    known = labelled.select(F.col("__h1").alias("__k1"), F.col("__h2").alias("__k2"), out_col)
    return rows.join(known, text.isNotNull() & (F.col("__h1") == F.col("__k1")) & (F.col("__h2") == F.col("__k2")),
                     "left").drop("__h1", "__h2", "__k1", "__k2")
