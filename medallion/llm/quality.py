"""Quality classifier: random Fourier features over document statistics, ridge regression, isotonic calibration.

Every whole text becomes a fixed list of statistics (lengths, character classes, repetition, line shape).  They
are standardised, mapped by random Fourier features that approximate a Gaussian kernel, and a ridge regression
of the label is fitted from normal equations: each task sums its rows' products, Spark sums the tasks' cells, and
the driver solves one system of fixed size.  Isotonic regression (pool adjacent violators over a fixed number of
score bins) turns scores into probabilities; it learns from rows that the ridge fit did not see.

Only the texts are inputs of a score.  All labelled rows given are used; nothing is sampled.

Defined results: null text is an empty text and gets a score like any other; rows with a null id are scored but
not learned from; null labels and labels of unknown documents are not learned; repeated rows count as often as
they stand; without any learnable row, or with labels of one kind only, the score is their mean (0.5 if none).
Texts of any length are read whole.  Ties: equal statistics get equal scores; scores of one calibration bin are equal.
An empty table gives no rows.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import cut

FOURIER, WIDTH, RIDGE, BINS, SEED = 256, 5.0, 1e-3, 2048, 17
_CLASS = np.zeros((256, 9))  # byte value → lower, upper, digit, blank, feed, sentence end, soft, symbol, other
for _c in range(256):
    _ch = chr(_c)
    _CLASS[_c, 0 if "a" <= _ch <= "z" else 1 if "A" <= _ch <= "Z" else 2 if "0" <= _ch <= "9" else 3 if _ch in " \t"
           else 4 if _ch in "\n\r" else 5 if _ch in ".!?" else 6 if _ch in ",;:'\"()-" else 7 if _c < 128 else 8] = 1
N_FEATURES = 25


def statistics(text: str) -> list[float]:
    raw = text.encode("utf-8", "surrogatepass")
    n = max(len(raw), 1)
    histogram = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = (histogram @ _CLASS) / n
    p = histogram[histogram > 0] / n
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    nw, nl = max(len(words), 1), max(len(lines), 1)
    seen = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    return [
        np.log1p(len(raw)), np.log1p(len(words)), np.log1p(len(lines)), *shares.tolist(),
        shares[1] / max(shares[0] + shares[1], 1e-9), histogram[33] / n, histogram[124] / n,
        sum(map(len, words)) / nw, len(seen) / nw, len(seen) / nw ** 0.5,
        max(seen.values(), default=0) / nw, sum(map(str.__eq__, words, words[1:])) / nw, pairs / nw,
        len(set(lines)) / nl, len(lines) and sum(x.rstrip()[-1] in ".!?" for x in lines) / nl,
        float(-(p * np.log2(p)).sum()) if len(raw) else 0.0,
        max(seen.values(), default=0) / nw ** 0.5,
    ]


def _featurise(batches):
    for batch in batches:
        rows = [statistics(t or "") for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))],
                                         names=["doc_id", "features"])


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_featurise, f"doc_id {kind}, features array<double>")


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)


class FourierMap:
    """Standardised statistics → random Fourier features and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.w = rng.standard_normal((N_FEATURES, FOURIER)) / WIDTH
        self.phase = rng.uniform(0, 2 * np.pi, FOURIER)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.spread, -6, 6)
        z = np.sqrt(2 / FOURIER) * np.cos(x @ self.w + self.phase)
        return np.hstack([z, np.ones((len(z), 1))])


def _sum_products(fourier: FourierMap):
    """A task's sums of z z' (upper triangle) and z y, as (cell, value) rows."""
    size = FOURIER + 1
    upper = np.triu_indices(size)

    def run(batches):
        total, moment, any_row = np.zeros((size, size)), np.zeros(size), False
        for batch in batches:
            if batch.num_rows:
                z = fourier(_matrix(batch.column(0)))
                total += z.T @ z
                moment += z.T @ batch.column(1).to_numpy()
                any_row = True
        if any_row:
            values = np.concatenate([total[upper], moment])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)],
                                             names=["cell", "value"])
    return run


def _solve(cells: dict[int, float]) -> np.ndarray:
    size = FOURIER + 1
    upper = np.triu_indices(size)
    flat = np.array([cells.get(i, 0.0) for i in range(len(upper[0]) + size)])
    a = np.zeros((size, size))
    a[upper] = flat[:-size]
    a = a + np.triu(a, 1).T
    n = max(a[-1, -1], 1.0)
    return np.linalg.solve(a + RIDGE * n / size * np.eye(size), flat[-size:])


def isotonic(at: np.ndarray, weight: np.ndarray, total: np.ndarray):
    """Pool adjacent violators: knots (position, non-decreasing value) of the calibration line."""
    blocks = []
    for x, w, t in zip(at, weight, total):
        blocks.append([x * w, w, t])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


class Model:
    """What a score needs; a few hundred kilobytes whatever the corpus."""

    def __init__(self, fourier=None, weights=None, knots=None, constant: float = 0.5):
        self.fourier, self.weights, self.knots, self.constant = fourier, weights, knots, constant

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.fourier(x) @ self.weights, -1, 2)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.fourier is None:
            return np.full(len(x), self.constant)
        return np.clip(np.interp(self.raw(x), *self.knots), 0, 1)


def fit(known: DataFrame, calibrate) -> Model:
    """``known``: (features, label double, and what the boolean column expression ``calibrate`` needs)."""
    known = cut(known.select("features", "label", calibrate.alias("calibrate")))
    ridge = known.where("not calibrate")
    one = F.col("features")
    stats = ridge.agg(F.count("*").alias("n"), F.avg("label").alias("p"),
                      *(F.avg(one[i]).alias(f"m{i}") for i in range(N_FEATURES)),
                      *(F.stddev_pop(one[i]).alias(f"s{i}") for i in range(N_FEATURES))).first()
    if not stats["n"] or stats["p"] in (0.0, 1.0):
        return Model(constant=0.5 if not stats["n"] else stats["p"])
    fourier = FourierMap(np.array([stats[f"m{i}"] for i in range(N_FEATURES)]),
                         np.array([stats[f"s{i}"] for i in range(N_FEATURES)]))
    cells = ridge.select("features", "label").mapInArrow(_sum_products(fourier), "cell int, value double") \
        .groupBy("cell").agg(F.sum("value")).collect()  # one row for each cell of the system, whatever the input
    model = Model(fourier, _solve(dict(map(tuple, cells))))

    def bins(batches):
        for batch in batches:
            raw = model.raw(_matrix(batch.column(0))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(((raw + 1) / 3 * (BINS - 1)).round().astype(np.int32)),
                                              batch.column(1)], names=["bin", "label"])

    held = known.where("calibrate")
    curve = (held if not held.isEmpty() else ridge).select("features", "label") \
        .mapInArrow(bins, "bin int, label double").groupBy("bin") \
        .agg(F.count("*").alias("n"), F.sum("label").alias("y")).collect()
    at, n, y = (np.array(c, float) for c in zip(*sorted(map(tuple, curve))))
    model.knots = isotonic(at / (BINS - 1) * 3 - 1, n, y)
    return model


def score(rows: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``rows`` (doc_id, features) → (doc_id, score, predicted)."""
    def run(batches):
        for batch in batches:
            s = model.score(_matrix(batch.column(1))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()),
                                              pa.array((s >= threshold).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "features").mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, learn, calibrate, label_col: str = "quality",
             id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """Scores of all ``docs``.  ``learn`` and ``calibrate`` are boolean column expressions over doc_id: the rows
    whose labels may be used at all, and those among them that only the calibration sees."""
    rows = cut(features(docs, id_col, text_col))
    marked = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("label")) \
        .where(F.col("label").isNotNull() & F.coalesce(learn, F.lit(False)))
    return score(rows, fit(rows.join(marked, "doc_id"), calibrate), threshold)
