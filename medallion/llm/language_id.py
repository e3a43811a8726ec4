"""Language identification by prediction by partial matching (PPM) over bytes.

Each language has a variable-order context tree: counts of the byte that follows the last three, two, one and no
bytes.  The code length of a text under a language is exact under the frozen counts: a byte seen in the longest
known context costs -log2(n / (N + D)) (N: occurrences of the context, D: different bytes after it); an unseen
one costs the escape -log2(D / (N + D)) and is tried in the next shorter context, at last at 1/256.  The language
with the shortest code wins; ``score`` is its share 2^-bits among all languages, from the code lengths.

Counts come from all labelled training texts, whole: each task counts four-byte strings with numpy and the sums
are aggregated by Spark.  All of them make the trees, however many there are.  The bytes before a coded byte choose its
place in a tree, so a tree is cut between pairs of preceding bytes into pieces that code their strings alone (at most
65,536 strings have the same pair).  Pieces go to the executors in blocks of about ``block_strings`` strings; a worker
holds one block at a time and adds the code lengths of a batch of texts block by block.

Defined results: null texts, and texts without any letter, are `und` with score 0; so is everything when there is
nothing to learn from; equal code lengths go to the alphabetically first language; rows with a null id are
predicted but not learned from; a null ``lang`` is not learned; repeated rows count as often as they stand.
Before counting and coding, ASCII letters are lower-cased, ASCII digits become 0 and white space a blank.
Texts of any length are coded whole.  An empty table gives no rows.  Other columns travel along unread, whatever their
names (but ``__lang``, ``__score``, ``__text`` and ``__letters``).
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from medallion.llm.common import cut, fold, give_back

BLOCK_STRINGS, BLOCK_BYTES = 500_000, 1 << 20
FOLD_BYTES = bytes(c + 32 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else 32 if 9 <= c <= 13 else c
                   for c in range(256))
START = b"   "  # the context of a text's first bytes


def _strings(texts: list[bytes]):
    """The four-byte string that ends at each byte of the texts (uint32), and where each text begins."""
    flat = np.frombuffer(b"".join(START + t.translate(FOLD_BYTES) for t in texts), np.uint8).astype(np.uint32)
    s = np.zeros(len(flat), np.uint32)
    for back in range(4):
        s[back:] |= flat[:len(flat) - back] << np.uint32(8 * back)
    lengths = np.array([len(t) for t in texts], np.int64)
    keep = np.ones(len(flat), bool)
    begins = np.cumsum(lengths + 3) - lengths - 3
    for i in range(3):
        keep[begins + i] = False
    return s[keep], np.cumsum(lengths) - lengths


def _blocks(texts: list[bytes]):
    """Index ranges of texts with about BLOCK_BYTES together (at least one text each)."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK_BYTES:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _count(batches):
    """Counts of each language's strings in a task's rows, by block."""
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        for a, b in _blocks(texts):
            by_lang: dict = {}
            for lang, text in zip(batch.column(0).slice(a, b - a).to_pylist(), texts[a:b]):
                by_lang.setdefault(lang, []).append(text)
            for lang, own in by_lang.items():
                strings, n = np.unique(_strings(own)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n), pa.string()), pa.array(strings.astype(np.int64)),
                     pa.array(n.astype(np.int64))], names=["lang", "string", "n"])
    give_back()


def count_strings(labelled: DataFrame) -> DataFrame:
    """(lang, string, n) over all rows of ``labelled`` (lang, text)."""
    return cut(labelled.select("lang", "text").mapInArrow(_count, "lang string, string long, n long")
               .groupBy("lang", "string").agg(F.sum("n").alias("n")))


class Piece(NamedTuple):
    """Counts of a language's strings whose pair of preceding bytes (nearest first) is in [lo, hi), and the counts of
    all its shorter strings that they may fall back on."""

    lang: str
    lo: int
    hi: int
    strings: np.ndarray  # of four bytes
    n: np.ndarray
    pairs: np.ndarray  # of two bytes
    n_pairs: np.ndarray
    n_bytes: np.ndarray  # of each byte


ALL_PAIRS = 1 << 16


def _pair(strings):
    """The two bytes before the coded one, nearest first."""
    return (strings >> 8 & 0xFF) << 8 | strings >> 16 & 0xFF


def _order(strings, n):
    """Known strings, bits, contexts, escape bits."""
    strings, where = np.unique(strings, return_inverse=True)
    n = np.bincount(where, n).astype(np.int64)
    contexts, where = np.unique(strings >> 8, return_inverse=True)
    total, kinds = np.bincount(where, n), np.bincount(where)
    return strings, -np.log2(n / (total + kinds)[where]), contexts, -np.log2(kinds / (total + kinds))


class ContextTrees:
    """Code lengths in bits of strings (context of three bytes and the next) for each language, as far as the pieces
    go."""

    def __init__(self, pieces: list[Piece]):
        self.langs = sorted({p.lang for p in pieces})
        self.pieces = []  # place of the language, first and last pair, tables from order 3 to 0
        for p in pieces:
            known = np.flatnonzero(p.n_bytes)
            self.pieces.append((self.langs.index(p.lang), p.lo, p.hi, [
                _order(p.strings, p.n), _order(p.strings & 0xFFFFFF, p.n), _order(p.pairs, p.n_pairs),
                _order(known, p.n_bytes[known])]))

    @staticmethod
    def _bits(orders, strings: np.ndarray) -> np.ndarray:
        open_, cost = np.arange(len(strings)), np.zeros(len(strings))
        for order, (known, bits, contexts, escape) in zip((3, 2, 1, 0), orders):
            if not len(known):
                continue
            s = strings[open_] & ((1 << 8 * (order + 1)) - 1)
            at = np.minimum(np.searchsorted(known, s), len(known) - 1)
            found = known[at] == s
            cost[open_[found]] += bits[at[found]]
            open_, c = open_[~found], s[~found] >> 8
            at = np.minimum(np.searchsorted(contexts, c), len(contexts) - 1)
            cost[open_] += np.where(contexts[at] == c, escape[at], 0.0)
        cost[open_] += 8.0
        return cost

    def add_bits(self, texts: list[bytes], out: np.ndarray, columns) -> None:
        """Add each text's code lengths to ``out``, whose ``columns`` are the languages; piece by piece, so that
        languages with equal counts have equal sums wherever their pieces stand."""
        full = np.array([len(t) > 0 for t in texts], bool)
        if not full.any():
            return
        strings, begins = _strings(texts)
        distinct, where = np.unique(strings, return_inverse=True)
        distinct, rows = distinct.astype(np.int64), np.flatnonzero(full)
        pairs = _pair(distinct)
        for k, lo, hi, orders in self.pieces:
            own = np.flatnonzero((pairs >= lo) & (pairs < hi))
            cost = np.zeros(len(distinct))
            cost[own] = self._bits(orders, distinct[own])
            out[rows, columns[k]] += np.add.reduceat(cost[where], begins[rows])

    def text_bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text under each language."""
        out = np.zeros((len(texts), len(self.langs)))
        self.add_bits(texts, out, range(len(self.langs)))
        return out


_TREES: dict = {}


def _packed(batches):
    """Sorted rows (lang, kind, key, n) as one row for each run of a language and kind in a batch."""
    for batch in batches:
        langs, kinds = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        keys, n = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        ends = [i for i in range(1, len(langs)) if langs[i] != langs[i - 1] or kinds[i] != kinds[i - 1]] + [len(langs)]
        begins = [0, *ends[:-1]]
        if langs:
            yield pa.RecordBatch.from_arrays(
                [pa.array([langs[a] for a in begins], pa.string()), pa.array([kinds[a] for a in begins], pa.int32()),
                 *(pa.array([c[a:b].astype(np.int64).tobytes() for a, b in zip(begins, ends)], pa.binary())
                   for c in (keys, n))], names=["lang", "kind", "keys", "n"])


def _pieces(counts: DataFrame, block_strings: int):
    """The pieces of all languages, one after the other; holds one piece and one language's counts of two bytes.
    Where a language is cut depends on its own counts only."""
    def byte(i):
        return F.shiftright("string", 8 * i).bitwiseAND(0xFF)

    key = F.shiftleft(byte(1), 24) + F.shiftleft(byte(2), 16) + F.shiftleft(byte(3), 8) + byte(0)
    pairs = counts.groupBy("lang", F.col("string").bitwiseAND(0xFFFF).alias("key")).agg(F.sum("n").alias("n"))
    rows = pairs.select("lang", F.lit(0).alias("kind"), "key", "n") \
        .unionByName(counts.select("lang", F.lit(1).alias("kind"), key.alias("key"), "n")).orderBy("lang", "kind", "key") \
        .mapInArrow(_packed, "lang string, kind int, keys binary, n binary")

    lang, pairs, n_pairs, n_bytes, held, size, lo = None, None, None, None, [], 0, 0

    def piece(hi):
        key, n = (np.concatenate(c) for c in zip(*held))
        strings = key >> 24 << 8 | (key >> 16 & 0xFF) << 16 | (key >> 8 & 0xFF) << 24 | key & 0xFF
        own = (pairs >> 8 >= lo >> 8) & (pairs >> 8 <= (hi - 1) >> 8)
        return Piece(lang, lo, hi, strings, n, pairs[own], n_pairs[own], n_bytes)

    for row in rows.toLocalIterator():
        keys, n = np.frombuffer(row.keys, np.int64), np.frombuffer(row.n, np.int64)
        if row.kind == 0:
            if row.lang != lang:
                if held:
                    yield piece(ALL_PAIRS)
                lang, held, size, lo = row.lang, [], 0, 0
                pairs, n_pairs = keys, n
            else:
                pairs, n_pairs = np.concatenate([pairs, keys]), np.concatenate([n_pairs, n])
            n_bytes = np.bincount(pairs & 0xFF, n_pairs, 256).astype(np.int64)
            continue
        units = keys >> 16
        ends = [*(np.flatnonzero(np.diff(units)) + 1).tolist(), len(keys)]
        at, begin = 0, 0
        for end in ends:  # strings at..end are of one pair
            last = int(held[-1][0][-1]) >> 16 if held else -1
            now = int(units[at])
            if size + at - begin >= block_strings and now != (int(units[at - 1]) if at > begin else last):
                if at > begin:
                    held.append((keys[begin:at], n[begin:at]))
                yield piece(now)
                held, size, lo, begin = [], 0, now, at
            at = end
        held.append((keys[begin:], n[begin:]))
        size += len(keys) - begin
    if held:
        yield piece(ALL_PAIRS)


def model_blocks(counts: DataFrame, block_strings: int = BLOCK_STRINGS):
    """The pieces of all languages in blocks of about ``block_strings`` strings."""
    block, size = [], 0
    for piece in _pieces(counts, block_strings):
        own = len(piece.strings) + len(piece.pairs) + len(piece.n_bytes)
        if block and size + own > block_strings:
            yield block
            block, size = [], 0
        block.append(piece)
        size += own
    if block:
        yield block


def collect_counts(counts: DataFrame) -> list[Piece]:
    """The whole model in one list."""
    return [piece for block in model_blocks(counts) for piece in block]


def _trees(shared, key) -> ContextTrees:
    """The trees of a broadcast block; a worker keeps the last block only."""
    if key not in _TREES:
        _TREES.clear()
        _TREES[key] = ContextTrees(shared.value)
        shared.__dict__.pop("_value", None)  # what a Broadcast has read it keeps; it can be read again
    return _TREES[key]


def _predictor(blocks, langs):
    """The input's columns but the last two, which are the text and whether it has letters; then the result."""
    place = {lang: i for i, lang in enumerate(langs)}

    def run(batches):
        for batch in batches:
            own = batch.num_columns - 2
            letters = np.array(batch.column(own + 1).to_pylist(), bool)
            texts = [t if ok else b"" for t, ok in zip(batch.column(own).cast(pa.binary()).to_pylist(), letters)]
            lang, score = ["und"] * len(texts), [0.0] * len(texts)
            bits = np.zeros((len(texts), len(langs)))
            for block in blocks:
                trees = _trees(*block)
                columns = [place[k] for k in trees.langs]
                for a, b in _blocks(texts):
                    trees.add_bits(texts[a:b], bits[a:b], columns)
            if langs:
                for i in np.flatnonzero(letters):
                    best = int(bits[i].argmin())
                    lang[i], score[i] = langs[best], float(1 / np.exp2(bits[i, best] - bits[i]).sum())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:own], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names[:own], "__lang", "__score"])
        give_back()
    return run


def annotate(docs: DataFrame, labelled: DataFrame, block_strings: int = BLOCK_STRINGS, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns ``__lang`` and ``__score``, learned from ``labelled`` (lang, text)."""
    context = docs.sparkSession.sparkContext
    usable = labelled.where("lang is not null and text is not null")
    blocks, langs = [], set()
    for block in model_blocks(count_strings(usable), block_strings):
        shared = context.broadcast(block)
        blocks.append((shared, (context.applicationId, shared._jbroadcast.id())))
        langs.update(p.lang for p in block)
    text = F.col(text_col).cast("string")
    rows = docs.select("*", F.coalesce(text, F.lit("")).alias("__text"),
                       F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("__letters"))
    schema = StructType([*docs.schema.fields, StructField("__lang", StringType()), StructField("__score", DoubleType())])
    return rows.mapInArrow(_predictor(blocks, sorted(langs)), schema)


def predict(docs: DataFrame, labelled: DataFrame, block_strings: int = BLOCK_STRINGS, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs``, learned from ``labelled`` (lang, text)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return annotate(rows, labelled, block_strings).select(
        "doc_id", F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))


def training_rows(docs: DataFrame, folds: int = 5) -> DataFrame:
    """The rows that may be learned from: those whose crc32(doc_id) is not 0 modulo ``folds``."""
    return docs.where(fold("doc_id", folds) != 0)
