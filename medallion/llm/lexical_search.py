"""Ranked lexical search: item bundles pass the owners of their terms one after the other (pipelined term partitioning).

A term is a run of ASCII digits, letters (A-Z lower-cased) and characters from U+0080 on.  With N documents that hold a
term, L terms in all, n terms in a document, df documents with the term and tf its occurrences in the document, a term
weighs w = floor(1000 ln((2N + 2) / (2 df + 1))), a document has m = 100 - 50 + (50 n N) div L, and scores the sum of
w ((10^9 tf) div (1000 tf + 20 m)) over the item's terms, in 64-bit integers.

Method.  Terms are dealt to ``stages`` owners by hash.  One scan of the documents turns each run of ``docs`` documents
into a block: their ids and lengths, and for each owner a posting list of its terms.  A bundle is a block's documents
with up to ``items`` items: for each item a sparse accumulator of scores (which documents, which sums).  Stage after
stage, a cogroup brings each bundle to the next owner's postings of that block, the owner adds its terms'
contributions, and the bundle goes on.  The last owner selects the ``top`` documents of each item in its block; a
ranked window, cut to ``top`` rows in every task before its shuffle, selects among the blocks.

Scale: no text is shuffled, and a frequent term is spread over all blocks.  A task holds single bundles, at most
``items`` x ``docs`` sums.  The items are the stated query set: they are taken in passes of at most ``PAIRS`` (item,
term) pairs and ``PAIR_BYTES`` bytes of terms (one item's terms stay together), which bounds what is broadcast and what
the driver holds; each pass is a scan of its own, and no document or item is dropped or sampled.

Defined results: a null, empty or term-less document has no term, counts in neither N nor L and is never found; a
term-less item finds nothing; item rows with one id are one item with all their terms, once each; a null item id is an
id as well.  Repeated documents are ranked row by row.  Equal scores go by ascending document id, nulls last.  Whole texts of any
length are read.  Empty tables give no rows.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import cut, give_back
from medallion.llm.word_hash import LOWER, pack, unpack

STAGES, DOCS, ITEMS, TOP = 4, 4096, 256, 50
POSTINGS = 1 << 22  # a block ends early beyond so many (document, term) pairs
PAIRS, PAIR_BYTES = 1 << 20, 1 << 26
TEXT_BYTES = 1 << 20
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")  # of lower-cased bytes
_NO_TERM = re.compile(rb"[^0-9a-z\x80-\xff]")


def terms(text: bytes):
    """The terms of a text, in lists of bounded size."""
    text, at = text.translate(LOWER), 0
    while len(text) - at > TEXT_BYTES:
        end = _NO_TERM.search(text, at + TEXT_BYTES)
        end = end.start() if end else len(text)
        yield TERM.findall(text, at, end)
        at = end
    yield TERM.findall(text, at)


def _item_terms(batches):
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        found = [sorted({t for part in terms(text or b"") for t in part}) for text in texts]
        at = np.repeat(np.arange(len(found)), [len(f) for f in found])
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)),
                                          pa.array([t for f in found for t in f], pa.binary())], names=["item_id", "term"])


def _squeeze(*parts) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(parts, 5))


def _open(blob: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


# ---------------------------------------------------------------------------------------------- blocks of documents
BLOCK_COLUMNS = "block long, owner int, blob binary, n_docs long, n_terms long, terms array<int>, dfs array<long>"
DOCUMENTS = -1  # the owner of a block's ids and lengths


class _Block:
    """Documents of one block as they come."""

    def __init__(self):
        self.ids, self.lengths, self.doc, self.term, self.tf = [], [], [], [], []

    def add(self, doc_id, text: bytes | None, number_of: dict) -> None:
        length, found = 0, Counter()
        for part in terms(text or b""):
            length += len(part)
            found.update(n for n in map(number_of.get, part) if n is not None)
        self.doc += [len(self.ids)] * len(found)
        self.term += found.keys()
        self.tf += found.values()
        self.ids.append(doc_id)
        self.lengths.append(length)

    def full(self, docs: int) -> bool:
        return len(self.ids) >= docs or len(self.doc) >= POSTINGS

    def rows(self, block: int, owner_of: np.ndarray):
        """The block's documents, and the postings of each owner: terms, where each begins, documents, occurrences."""
        lengths = np.array(self.lengths, np.int64)
        missing = np.array([i is None for i in self.ids])
        ids = np.array([i or 0 for i in self.ids], np.int64)
        yield (block, DOCUMENTS, _squeeze(ids, missing, lengths, b"", b""), int((lengths > 0).sum()), int(lengths.sum()),
               None, None)
        term, doc, tf = np.array(self.term, np.int32), np.array(self.doc, np.int32), np.array(self.tf, np.int64)
        order = np.lexsort((doc, term))
        term, doc, tf = term[order], doc[order], tf[order]
        for owner in np.unique(owner_of[term]):
            mine = owner_of[term] == owner
            used, begins, dfs = np.unique(term[mine], return_index=True, return_counts=True)
            yield block, int(owner), _squeeze(used, begins, doc[mine], tf[mine]), None, None, used, dfs


def _blocks(vocabulary, docs: int):
    """Rows of BLOCK_COLUMNS; a block's number is its task's and its place in it, the same whenever it is made."""
    def run(batches):
        number_of, owner_of = vocabulary.value
        block, number, first = _Block(), 0, TaskContext.get().partitionId() << 32

        def done():
            rows = list(zip(*block.rows(first + number, owner_of)))
            types = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(rows, types)],
                                              names=[c.split()[0] for c in BLOCK_COLUMNS.split(", ")])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                block.add(doc_id, text, number_of)
                if block.full(docs):
                    yield done()
                    block, number = _Block(), number + 1
        if block.ids:
            yield done()
        give_back()
    return run


# ---------------------------------------------------------------------------------------------- the pipeline's stages
def _accumulators(sets: bytes, sums: bytes, shape: tuple[int, int]) -> np.ndarray:
    out = np.zeros(shape, np.int64)
    if sets:
        mask = np.unpackbits(np.frombuffer(sets, np.uint8), count=out.size).astype(bool)
        out.ravel()[mask] = unpack(sums, 8).astype(np.int64)
    return out


def document_parts(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents with so many terms."""
    if len(lengths) and 50 * int(lengths.max()) * n_docs >= 1 << 63:
        return np.array([50 + 50 * int(n) * n_docs // n_terms for n in lengths], np.int64)
    return 50 + 50 * lengths * n_docs // n_terms


def _best(sums: np.ndarray, ids: np.ndarray, missing: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` greatest sums above 0, ties by ascending id, ids that are missing last."""
    some = np.flatnonzero(sums > 0)
    if len(some) > top:
        some = some[sums[some] >= np.partition(sums[some], -top)[-top]]
    return some[np.lexsort((ids[some], missing[some], -sums[some]))][:top]


def _stage(queries, n_docs: int, n_terms: int, items: int, top: int):
    """A bundle meets an owner's postings of its block; ``top`` is 0 before the last owner."""
    def run(key, bundle: pa.Table, postings: pa.Table) -> pa.Table:
        number = key[1].as_py()
        item_ids, weights, items_of = queries.value
        mine = item_ids[number * items:(number + 1) * items]
        ids, missing, lengths, sets, sums = _open(bundle.column("blob")[0].as_py())
        acc = _accumulators(sets, sums, (len(mine), len(ids)))
        m = document_parts(lengths, n_docs, n_terms)
        for blob in postings.column("blob").to_pylist():
            used, begins, doc, tf = _open(blob)
            n = np.diff(begins, append=len(doc))
            share = np.repeat(weights[used], n) * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
            for t, begin, end in zip(used.tolist(), begins.tolist(), (begins + n).tolist()):
                holders = items_of[t]
                holders = holders[(holders >= number * items) & (holders < (number + 1) * items)] - number * items
                if len(holders):
                    acc[holders[:, None], doc[begin:end]] += share[begin:end]
        if not top:
            blob = _squeeze(ids, missing, lengths, np.packbits(acc > 0).tobytes(), pack(acc[acc > 0], 8))
            return pa.table([pa.array([key[0].as_py()]), pa.array([number], pa.int32()), pa.array([blob], pa.binary())],
                            names=["block", "bundle", "blob"])
        found = [(item, place) for i, item in enumerate(mine) for place in _best(acc[i], ids, missing, top)]
        places = np.array([p for _, p in found], np.int64)
        at = {item: i for i, item in enumerate(mine)}
        rows = np.array([at[item] for item, _ in found], np.int64)
        return pa.table([pa.array([item for item, _ in found], pa.int64()), pa.array(ids[places], mask=missing[places]),
                         pa.array(acc[rows, places])], names=["item_id", "doc_id", "score"])
    return run


def _pass(docs: DataFrame, pairs: DataFrame, stages: int, block_docs: int, items: int, top: int) -> DataFrame | None:
    """(item_id, doc_id, score): each block's best documents of the items in ``pairs``."""
    context = docs.sparkSession.sparkContext
    rows = pairs.collect()  # at most PAIRS of them, see ``search``
    words = sorted({bytes(r.term) for r in rows})
    number_of = {w: i for i, w in enumerate(words)}
    item_ids = sorted({r.item_id for r in rows}, key=lambda i: (i is None, i))
    item_of = {item: i for i, item in enumerate(item_ids)}
    items_of = [[] for _ in words]
    for r in rows:
        items_of[number_of[bytes(r.term)]].append(item_of[r.item_id])
    owner_of = np.array([zlib.crc32(w) % stages for w in words], np.int32)

    vocabulary = context.broadcast((number_of, owner_of))
    blocks = cut(docs.mapInArrow(_blocks(vocabulary, block_docs), BLOCK_COLUMNS))
    n_blocks, n_docs, n_terms = blocks.where(F.col("owner") == DOCUMENTS) \
        .agg(F.count("*"), F.sum("n_docs"), F.sum("n_terms")).first()
    if not n_terms:
        return None
    dfs = dict(blocks.where(F.col("owner") != DOCUMENTS).select(F.explode(F.arrays_zip("terms", "dfs")).alias("t"))
               .groupBy("t.terms").agg(F.sum("t.dfs")).collect())
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * dfs.get(i, 0) + 1)))
                        for i in range(len(words))], np.int64)
    queries = context.broadcast((item_ids, weights, [np.array(i, np.int64) for i in items_of]))

    n_bundles = -(-len(item_ids) // items)
    tasks = max(-(-n_blocks * n_bundles // 16), min(n_blocks * n_bundles, 2 * context.defaultParallelism))
    each = F.explode(F.sequence(F.lit(0), F.lit(n_bundles - 1))).alias("bundle")

    def dealt(rows: DataFrame):
        return rows.repartition(tasks, "block", "bundle").groupBy("block", "bundle")

    bundles = blocks.where(F.col("owner") == DOCUMENTS).select("block", each, "blob")
    for owner in range(stages):
        last = owner == stages - 1
        postings = blocks.where(F.col("owner") == owner).select("block", each, "blob")
        bundles = dealt(bundles).cogroup(dealt(postings)).applyInArrow(
            _stage(queries, n_docs, n_terms, items, top if last else 0),
            "item_id long, doc_id long, score long" if last else "block long, bundle int, blob binary")
    return bundles


def search(documents: DataFrame, items: DataFrame, top: int = TOP, stages: int = STAGES, docs: int = DOCS,
           items_each: int = ITEMS, pairs_each: int = PAIRS, doc_id: str = "doc_id", item_id: str = "item_id",
           text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` best documents with a score above 0."""
    documents = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pairs = cut(items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
                .mapInArrow(_item_terms, "item_id long, term binary").distinct())
    n, size = pairs.agg(F.count("*"), F.sum(F.length("term"))).first()
    passes = max(-(-n // pairs_each), -(-(size or 0) // PAIR_BYTES))
    found = [_pass(documents, pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == i), stages, docs, items_each, top)
             for i in range(passes)]
    found = [f for f in found if f is not None]
    if not found:
        return documents.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)) \
        .where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
