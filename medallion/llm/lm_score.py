"""Language-model scores by deleted interpolation of n-grams.

Tokens are the words of a text (A-Z lower-cased) and one end.  Maximum-likelihood estimates of orders 1 to
``ORDER`` are interpolated order by order: P_k = w * ML_k + (1 - w) * P_(k-1), where P_1 is the add-half unigram
probability and the weight w depends on order and on how often the context was seen (buckets of powers of two).
The weights are learned by expectation-maximisation on held-out counts: every training token is scored with its
own occurrence deleted from the counts.

All training texts are counted, with no cut-off.  Documents are dealt into groups of about ``GROUP_BYTES`` of
text.  A group asks for each of its distinct n-grams once: the request (hashes, 48 bits besides the bucket for
words, 36 for longer n-grams, with the group's own training counts) goes to the n-gram's hash bucket, where all
groups' counts are summed, and the sums come back in the order of the request.  A frequent n-gram is thus one
entry for each group, never a row for each occurrence.  Text is shuffled once (the grouping is reused for the
answers); what remains of a group is each token's counts, compressed, and checkpointed.  The weights come from
those by two small aggregations of fixed size, the scores by one more pass without text.

A bucket holds about half a million n-grams, so one of several words shares its hash with another one with a chance
below 1e-5 (a word: below 1e-8).

Defined results: null or empty text is the end alone; rows with a null id are scored but not learned from;
repeated rows count as often as they stand; with nothing to learn from, every probability is the base one.  Texts
of any length are scored whole.  Ties don't arise: equal texts get equal scores.  A text to learn from is scored with its
own counts in, so its score is higher than that of the same text held out.  An empty table gives no rows.  Other
columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import cut
from medallion.llm.word_hash import deal, deltas, in_order, mix, pack, texts_of, unpack, word_hashes

ORDER, GROUP_BYTES, MIN_GROUPS, BUCKET_NGRAMS, MIN_BUCKETS = 3, 8 << 20, 64, 1 << 19, 256
END, BEGIN = np.uint64(0x0E0D), np.uint64(0x0B0E)  # hashes of no word but for chance
CONTEXT_BUCKETS, RATIO_BINS, EM_STEPS, DOCS_A_ROW = 40, 241, 60, 512
WORD_BITS, NGRAM_BITS = 48, 36  # of a hash, besides those that its bucket stands for


def _tokens(texts: list[bytes]):
    """Hashes of all tokens (each text's words, then the end) and the number of tokens of each text."""
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    return np.insert(words, ends, END), counts + 1


def _ngrams(tokens: np.ndarray, counts: np.ndarray, order: int) -> np.ndarray:
    """Hash of the n-gram that ends at each token; before a text stands BEGIN."""
    out, begins = tokens.copy(), np.cumsum(counts) - counts
    for back in range(1, order):
        before = np.full(len(tokens), BEGIN, np.uint64)
        before[back:] = tokens[:-back] if back < len(tokens) else before[back:]
        for i in range(back):  # positions whose context begins before the text
            at = begins + i
            before[at[i < counts]] = BEGIN
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + before + np.uint64(order))
    return out


def _requests(tokens, counts, order: int, bucket_bits: int):
    """The distinct n-grams in the order in which they are asked for, each token's place among them, and the
    limits of each bucket's entries.  The upper bits of a hash are its bucket."""
    own = min(WORD_BITS if order == 1 else NGRAM_BITS, 64 - bucket_bits)
    grams = _ngrams(tokens, counts, order) >> np.uint64(64 - bucket_bits - own)
    grams, where = np.unique(grams, return_inverse=True)
    limits = np.searchsorted(grams >> np.uint64(own), np.arange((1 << bucket_bits) + 1, dtype=np.uint64))
    return grams, where, limits


def _ask(order_max: int, bucket_bits: int):
    def run(docs: pa.Table) -> pa.Table:
        docs = in_order(docs)
        tokens, counts = _tokens(texts_of(docs))
        train = np.repeat(docs.column("train").to_numpy(), counts)
        group = docs.column("g")[0].as_py()
        rows: dict[int, dict] = {}
        for order in range(1, order_max + 1):
            grams, where, limits = _requests(tokens, counts, order, bucket_bits)
            own = np.bincount(where, train, len(grams)).astype(np.uint64)
            for b in np.flatnonzero(np.diff(limits)):
                part = slice(limits[b], limits[b + 1])
                row = rows.setdefault(int(b), {"bucket": int(b), "g": group})
                row[f"grams{order}"] = pack(deltas(grams[part]), 8)
                row[f"own{order}"] = pack(own[part], 4)
        schema = pa.schema([("bucket", pa.int64()), ("g", pa.int64())] + [
            (f"{c}{k}", pa.binary()) for k in range(1, order_max + 1) for c in ("grams", "own")])
        return pa.Table.from_pylist(list(rows.values()), schema)
    return run


def _answer(order_max: int):
    """Sums over all groups of one bucket's counts, in the order of each group's request; and how many words of
    the bucket are in the training texts (on one of its rows)."""
    def run(asked: pa.Table) -> pa.Table:
        n, out, known_words = asked.num_rows, {"g": asked.column("g"), "bucket": asked.column("bucket")}, 0
        for order in range(1, order_max + 1):
            grams = [np.cumsum(unpack(x, 8), dtype=np.uint64) if x else np.zeros(0, np.uint64)
                     for x in asked.column(f"grams{order}").to_pylist()]
            own = [unpack(x, 4) if x else np.zeros(0, np.uint64) for x in asked.column(f"own{order}").to_pylist()]
            _, where = np.unique(np.concatenate(grams), return_inverse=True)
            total = np.bincount(where, np.concatenate(own))
            if order == 1:
                known_words = int((total > 0).sum())
            answers = np.split(total[where].astype(np.uint64), np.cumsum([len(x) for x in grams])[:-1])
            out[f"n{order}"] = pa.array([pack(a, 5) if len(a) else None for a in answers], pa.binary())
        out["words"] = pa.array([known_words] + [0] * (n - 1), pa.int64())
        return pa.table(out)
    return run


def _collect_counts(order_max: int, bucket_bits: int):
    """Each token's counts of all orders, a row for some hundred documents."""
    schema = pa.schema([("docs", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())),
                        ("tokens", pa.list_(pa.int64())), ("words", pa.int64()), ("train_tokens", pa.int64()),
                        ("train_docs", pa.int64())] + [(f"n{k}", pa.binary()) for k in range(1, order_max + 1)])

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        docs, answers = in_order(docs), answers.sort_by("bucket")
        tokens, counts = _tokens(texts_of(docs))
        per_order = []
        for order in range(1, order_max + 1):
            _, where, _ = _requests(tokens, counts, order, bucket_bits)
            per_order.append(np.concatenate(
                [unpack(x, 5) for x in answers.column(f"n{order}").to_pylist() if x is not None])[where])
        ends, train, ids = np.cumsum(counts), docs.column("train").to_numpy(), docs.column("doc_id").to_pylist()
        rows = []
        for a in range(0, len(ids), DOCS_A_ROW):
            b = min(a + DOCS_A_ROW, len(ids))
            part = slice(ends[a] - counts[a], ends[b - 1])
            rows.append({"docs": ids[a:b], "train": train[a:b].tolist(), "tokens": counts[a:b].tolist(),
                         "words": sum(answers.column("words").to_pylist()) if a == 0 else 0,
                         "train_tokens": int(counts[a:b][train[a:b]].sum()), "train_docs": int(train[a:b].sum())}
                        | {f"n{k + 1}": pack(n[part], 5) for k, n in enumerate(per_order)})
        return pa.Table.from_pylist(rows, schema)
    return run


class Corpus:
    """Totals of the training texts: tokens, distinct tokens, documents."""

    def __init__(self, tokens: int, words: int, docs: int):
        self.tokens, self.words, self.docs = tokens, words, docs

    def base(self, n, deleted=0):
        return (n - deleted + 0.5) / (self.tokens - deleted + 0.5 * (self.words + 1))


class Interpolation:
    """weights[k][bucket]: the share of the order-k estimate after a context of that frequency."""

    def __init__(self, corpus: Corpus, weights: dict[int, np.ndarray]):
        self.corpus, self.weights = corpus, weights

    def estimate(self, n: list[np.ndarray], counts: np.ndarray, order: int, deleted=0):
        """(context frequency bucket, ML estimate) of ``order`` for each token; ``deleted`` is 1 where the
        token's own occurrence is taken out of the counts."""
        begins = np.cumsum(counts) - counts
        context = np.zeros(len(n[0]))
        context[1:] = n[order - 2][:-1]
        # The context of a text's first token occurs once for each training document, and so does the end.
        context[begins] = self.corpus.docs
        context = np.maximum(context - deleted, 0)
        hits = np.maximum(n[order - 1] - deleted, 0)
        ml = np.divide(hits, context, out=np.zeros(len(context)), where=context > 0)
        bucket = np.minimum(np.log2(context + 1).astype(np.int64), CONTEXT_BUCKETS - 1)
        return bucket, np.minimum(ml, 1.0)

    def probability(self, n: list[np.ndarray], counts: np.ndarray, upto: int, deleted=0):
        p = self.corpus.base(n[0], deleted)
        for order in range(2, upto + 1):
            bucket, ml = self.estimate(n, counts, order, deleted)
            w = self.weights[order][bucket]
            p = w * ml + (1 - w) * p
        return p


def _counts_of(row: dict, order_max: int):
    counts = np.array(row["tokens"], np.int64)
    return counts, [unpack(row[f"n{k}"], 5).astype(np.float64) for k in range(1, order_max + 1)]


def _histogram(model: Interpolation, order: int, order_max: int):
    """Training tokens by context bucket and by the ratio of the order's deleted estimate to the lower orders'."""
    def run(batches):
        total = np.zeros(CONTEXT_BUCKETS * RATIO_BINS)
        for batch in batches:
            for row in batch.to_pylist():
                counts, n = _counts_of(row, order_max)
                learned = np.repeat(np.array(row["train"], bool), counts)
                lower = model.probability(n, counts, order - 1, 1 * learned)
                bucket, ml = model.estimate(n, counts, order, 1 * learned)
                with np.errstate(divide="ignore"):
                    ratio = np.where(ml > 0, np.log2(ml / lower), -np.inf)
                place = np.where(ml > 0, np.clip(np.round(ratio * 4) + RATIO_BINS // 2, 1, RATIO_BINS - 1), 0)
                total += np.bincount((bucket * RATIO_BINS + place.astype(np.int64))[learned], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])
    return run


def expectation_maximisation(histogram: np.ndarray) -> np.ndarray:
    """The weight of the higher order for each context bucket that maximises the deleted likelihood."""
    ratio = np.exp2((np.arange(RATIO_BINS) - RATIO_BINS // 2) / 4)
    ratio[0] = 0
    seen = histogram.sum(1)
    w = np.full(len(histogram), 0.5)
    for _ in range(EM_STEPS):
        share = w[:, None] * ratio / (w[:, None] * ratio + (1 - w[:, None]))
        w = np.where(seen > 0, (histogram * share).sum(1) / np.maximum(seen, 1), 0.0)
        w = np.clip(w, 0.0, 0.9999)
    w[0] = 0.0  # an unseen context has no estimate
    return w


def _score(model: Interpolation, order_max: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                counts, n = _counts_of(row, order_max)
                begins = np.cumsum(counts) - counts
                add = lambda x: np.add.reduceat(x, begins)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["docs"], pa.int64()), pa.array(row["train"], pa.bool_()), pa.array(counts),
                    pa.array(add((n[0] > 0).astype(np.int64))),
                    pa.array(np.full(len(counts), model.corpus.tokens, np.int64)),
                    pa.array(add(np.log10(model.corpus.base(n[0])))),
                    pa.array(add(np.log10(model.probability(n, counts, order_max))))],
                    names=["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def token_counts(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text",
                 order: int = ORDER) -> DataFrame:
    """The counts in the training texts of every n-gram of all documents: a row for some hundred documents."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.coalesce(learn, F.lit(False)).alias("train"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    groups = max(MIN_GROUPS, -(-size // GROUP_BYTES))
    buckets = max(MIN_BUCKETS, size // 3 // BUCKET_NGRAMS)  # about a word in six bytes, two new n-grams a word
    bits = int(buckets - 1).bit_length()
    rows = deal(rows, groups)
    orders = range(1, order + 1)
    asked = rows.groupBy("g").applyInArrow(_ask(order, bits), "bucket long, g long, " + ", ".join(
        f"grams{k} binary, own{k} binary" for k in orders))
    answers = asked.groupBy("bucket").applyInArrow(_answer(order), "g long, bucket long, " + ", ".join(
        f"n{k} binary" for k in orders) + ", words long")
    return cut(rows.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(
        _collect_counts(order, bits),
        "docs array<long>, train array<boolean>, tokens array<long>, words long, train_tokens long, "
        "train_docs long, " + ", ".join(f"n{k} binary" for k in orders)))


def fit(known: DataFrame, order: int = ORDER) -> Interpolation:
    """The interpolation weights from ``token_counts``' rows."""
    total = known.agg(F.sum("train_tokens"), F.sum("words"), F.sum("train_docs")).first()
    model = Interpolation(Corpus(*(int(x or 0) for x in total)), {})
    for k in range(2, order + 1):
        cells = known.mapInArrow(_histogram(model, k, order), "cell long, n double") \
            .groupBy("cell").agg(F.sum("n")).collect()  # at most CONTEXT_BUCKETS * RATIO_BINS rows
        histogram = np.zeros(CONTEXT_BUCKETS * RATIO_BINS)
        for cell, n in cells:
            histogram[cell] = n
        model.weights[k] = expectation_maximisation(histogram.reshape(CONTEXT_BUCKETS, RATIO_BINS))
    return model


def score_documents(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text",
                    order: int = ORDER) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score), one row for each document; ``learn`` is
    a boolean column expression for the rows to learn from."""
    known = token_counts(docs, learn, id_col, text_col, order)
    return known.mapInArrow(_score(fit(known, order), order), "doc_id long, train boolean, n_tokens long, "
                            "n_known long, train_tokens long, base_score double, score double")
