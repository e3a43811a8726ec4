"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items.

Texts are compared as words: A-Z lower-cased, a word is a run of ASCII digits, letters and any character from
U+0080 on.  A window is ``window`` consecutive item words (a shorter, non-empty item is one window).  Every
document is normalised once to " w1 w2 ... wn " and scanned once; a hit's offsets in the normalised text are
mapped to word numbers and from there to character offsets of the original text.

Defined results: null or word-less text has no words and is not contaminated; null or word-less items have no
window; repeated items and windows count once per item id; items with a null id are left out; repeated
documents give one row each; other columns of the inputs are not read, whatever their names.

Scale: one pass over the documents without any shuffle of text, and no limit on a text's length.  The benchmark is the
stated query set: its windows are cut and told apart in Spark, and go to the driver and the executors in blocks, by hash,
of about ``block_bytes`` of window text (the bound on what is broadcast), one scan per block, so a benchmark of any size
is matched whole.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medallion.llm.common import cut, give_back

WORD_BYTES = bytes(
    (c + 32 if 65 <= c <= 90 else c) if (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128) else 32
    for c in range(256))


def normalise(text: bytes) -> bytes:
    return b" " + b" ".join(text.translate(WORD_BYTES).split()) + b" "


def windows_of(text: str | None, window: int) -> set[bytes]:
    words = (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()
    last = max(len(words) - window, 0)
    return {b" " + b" ".join(words[i:i + window]) + b" " for i in range(last + 1)} if words else set()


def _item_windows(window: int):
    def run(batches):
        for batch in batches:
            found = [windows_of(text, window) for text in batch.column(1).to_pylist()]
            at = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array([w for f in found for w in f], pa.binary())],
                                             names=["item", "win"])
    return run


def _blocks(bench: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int):
    """Pattern → item ids, in blocks of bounded size.  Windows are cut and told apart in Spark; the driver holds one block
    at a time, the windows whose hash gives its number."""
    rows = bench.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("item"),
                                                         F.col(text_col).cast("string").alias("text"))
    found = cut(rows.mapInArrow(_item_windows(window), "item long, win binary").distinct())
    size = found.agg(F.sum(F.length("win") + 72)).first()[0] or 0
    blocks = max(-(-size // block_bytes), 1)
    for number in range(blocks):
        block: dict[str, set] = {}
        for item, win in found.where(F.pmod(F.xxhash64("win"), F.lit(blocks)) == number).collect():
            block.setdefault(bytes(win).decode("latin-1"), set()).add(item)
        yield block


SCAN_COLUMNS = ("__n_words long, __n_hit long, __items array<long>, __spans array<struct<start: long, end: long>>")
PART_COLUMNS = "__items array<long>, __first array<long>, __last array<long>"
_AUTOMATA: dict = {}
CHAINED = 4


def _automaton(shared):
    """The automaton of a broadcast block, built once in each Python worker."""
    import ahocorasick

    if shared.id not in _AUTOMATA:
        if len(_AUTOMATA) > 2:
            _AUTOMATA.clear()
        auto = ahocorasick.Automaton()
        for pattern, ids in shared.value.items():
            auto.add_word(pattern, (pattern.count(" ") - 1, len(pattern), sorted(ids)))
        if len(auto):
            auto.make_automaton()
        _AUTOMATA[shared.id] = auto
    return _AUTOMATA[shared.id]


class _Key:
    """A broadcast with a key for the worker's cache."""

    def __init__(self, spark, value):
        self._b = spark.sparkContext.broadcast(value)
        self.id = (spark.sparkContext.applicationId, self._b._jbroadcast.id())

    def __getstate__(self):
        return {"_b": self._b, "id": self.id}

    @property
    def value(self):
        return self._b.value


def _original_offsets(text: str, first: np.ndarray, last: np.ndarray) -> list[dict]:
    """Character offsets in ``text`` of the word ranges first..last (both inclusive)."""
    raw = text.encode("utf-8", "surrogatepass")
    flags = np.frombuffer(raw.translate(WORD_BYTES), np.uint8) != 32
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    at = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    return [{"start": int(at[starts[a]]), "end": int(at[ends[b]])} for a, b in zip(first, last)]


def _hits(auto, text: str | None):
    """Item ids and word ranges [first, last] of every window that occurs in ``text``."""
    norm = normalise((text or "").encode("utf-8", "surrogatepass"))
    found = list(auto.iter(norm.decode("latin-1"))) if len(auto) and len(norm) > 2 else []
    if not found:
        return [], [], []
    gaps = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)
    last = np.searchsorted(gaps, [end for end, _ in found]) - 1
    first = last - np.array([v[0] for _, v in found]) + 1
    ranges = np.unique(np.stack([first, last], 1), axis=0)
    return sorted({i for _, v in found for i in v[2]}), ranges[:, 0].tolist(), ranges[:, 1].tolist()


def _finish(text: str | None, first: list, last: list):
    """(n_words, n_hit, spans) of a text whose hit word ranges are known."""
    norm = normalise((text or "").encode("utf-8", "surrogatepass"))
    n_words = norm.count(b" ") - 1 if len(norm) > 2 else 0
    if not first:
        return n_words, 0, []
    cover = np.zeros(n_words + 1, np.int64)
    np.add.at(cover, first, 1)
    np.add.at(cover, np.array(last) + 1, -1)
    hit = np.cumsum(cover)[:-1] > 0
    edge = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
    return n_words, int(hit.sum()), _original_offsets(
        text, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1)


def _scanner(shared, own: int, begin: bool, end: bool):
    """Add one block's hits to each row (``own`` columns of the input, then the text); the first block starts the
    lists of hits, the last one turns them into the result."""
    longs = pa.list_(pa.int64())
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches):
        auto = _automaton(shared)
        for batch in batches:
            rows = []
            for text, *before in zip(*(c.to_pylist() for c in batch.columns[own:])):
                items, first, last = _hits(auto, text)
                if not begin:
                    items, first, last = sorted({*items, *before[0]}), first + before[1], last + before[2]
                rows.append((items, *_finish(text, first, last)) if end else (items, first, last))
            cols = [[r[i] for r in rows] for i in range(4 if end else 3)]
            kept, names = batch.columns[:own + (not end)], batch.schema.names[:own + (not end)]
            if end:
                new = [pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[0], longs),
                       pa.array(cols[3], span)]
                yield pa.RecordBatch.from_arrays(kept + new, names=names + ["__n_words", "__n_hit", "__items", "__spans"])
            else:
                yield pa.RecordBatch.from_arrays(kept + [pa.array(c, longs) for c in cols],
                                                 names=names + ["__items", "__first", "__last"])
        give_back()
    return scan


def annotate(docs: DataFrame, bench: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id",
             item_text_col: str = "text", block_bytes: int = 32 << 20) -> DataFrame:
    """``docs`` with the columns ``__n_words``, ``__n_hit``, ``__items`` and ``__spans``."""
    fields, own = docs.schema.fields, len(docs.columns)
    out = docs.select("*", F.col(text_col).cast("string").alias("__text"))
    part = StructType([*out.schema.fields, *_parse(PART_COLUMNS)])
    full = StructType([*fields, *_parse(SCAN_COLUMNS)])
    blocks, number = _blocks(bench, item_col, item_text_col, window, block_bytes), 0
    block, following = _Key(docs.sparkSession, next(blocks)), next(blocks, None)
    while following is not None:
        out = out.mapInArrow(_scanner(block, own, number == 0, False), part)
        block, following, number = _Key(docs.sparkSession, following), next(blocks, None), number + 1
        if number % CHAINED == 0:
            out = cut(out)  # a task holds the automata of at most so many blocks
    return out.mapInArrow(_scanner(block, own, number == 0, True), full)


def _parse(columns: str):
    return StructType.fromDDL(columns).fields


def decontaminate(docs: DataFrame, bench: DataFrame, window: int = 10, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  block_bytes: int = 32 << 20) -> DataFrame:
    """(doc_id, n_words, n_hit, item_ids, spans) for every document; ``spans`` are [start, end) character
    offsets of the hit words in the original text.  See the module's text for the defined cases."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return annotate(rows, bench, window, "text", item_col, item_text_col, block_bytes).select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__n_hit").alias("n_hit"),
        F.col("__items").alias("item_ids"), F.col("__spans").alias("spans"))


def report(scanned: DataFrame) -> DataFrame:
    """The contract's columns from ``decontaminate``'s rows."""
    return scanned.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ","), 256)
         .alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))
