"""Vector codes against a plain version in Python integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.llm import vector_codes
from medallion.llm.common import sums_beside

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts, entries, rounds):
    """Codes, errors and codebooks by comparing every part with every entry."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    whole = []
    for _, v, _ in kept:
        ints = [math.floor(256 * float(np.float32(c))) for c in v]
        ints += [0] * (parts * width - len(ints))
        whole.append([ints[p * width:(p + 1) * width] for p in range(parts)])
    books = [[list(w[p]) for w in whole[:entries]] for p in range(parts)]

    def assign():
        out = []
        for w in whole:
            out.append([min((sum((a - b) ** 2 for a, b in zip(w[p], e)), i) for i, e in enumerate(books[p]))
                        for p in range(parts)])
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [w[p] for w, f in zip(whole, found) if f[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    found = assign()
    return [(i, lab, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f)) for (i, _, lab), f in zip(kept, found)], books


def compare(spark, rows, parts=4, entries=5, rounds=2):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("code", F.lit("x")).withColumn("error", F.lit(1))
    got, books = vector_codes.compress(df, parts, entries, rounds)
    want, want_books = plain(rows, parts, entries, rounds)
    by_label = {}
    for _, lab, _, e in want:
        by_label[lab] = by_label.get(lab, 0) + e
    key = str
    assert sorted(map(tuple, got.select("vec_id", "label", "code", "error", "label_error").collect()), key=key) \
        == sorted([(*w, by_label[w[1]]) for w in want], key=key)
    assert books.tolist() == want_books
    return got, books


def test_walsh_scales_squared_distances_by_the_size():
    rng = np.random.default_rng(1)
    for size in (1, 2, 8, 64):
        x = rng.integers(-500, 500, (7, size))
        assert ((vector_codes.walsh(x) ** 2).sum(1) == size * (x ** 2).sum(1)).all()
    changes = [np.count_nonzero(np.diff(row)) for row in vector_codes.walsh(np.eye(16, dtype=np.int64)).T]
    assert changes == list(range(16))  # sequency order


@pytest.mark.parametrize("width", [1, 3, 4, 48])
def test_nearest_is_exact_with_ties_to_the_lower_index(width):
    rng = np.random.default_rng(width)
    x, book = rng.integers(-3, 4, (500, width)), rng.integers(-3, 4, (64, width))
    entry, d = vector_codes.nearest(x, book)
    every = ((x[:, None] - book[None]) ** 2).sum(2)
    assert (entry == every.argmin(1)).all() and (d == every.min(1)).all()


def test_codes_equal_the_plain_version(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(0, 0.3, 12).astype(np.float32)], int(i % 3) if i % 7 else None)
            for i in range(90)]
    compare(spark, rows)
    compare(spark, rows[:3])  # fewer vectors than entries


def test_ties_repeats_nulls_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [0.0] * 8, 1), (5, [0.0] * 8, 1), (5, [0.5] * 8, None), (None, [0.25] * 8, None), (2, None, 1),
            (3, [nan] * 8, 1), (4, [inf] * 8, 2), (6, [0.1, None] * 4, 2), (7, [], 2), (8, [1.0, -1.0, 0.1], 2),
            (9, [-0.001] * 8, None), (10, [1e-9] * 8, 3)] + [(20 + i, [0.5] * 8, 9) for i in range(40)]
    _, books = compare(spark, rows)
    assert vector_codes.decode("00000000", books).shape == (8,)


def test_no_vectors(spark):
    got, books = vector_codes.compress(spark.createDataFrame([(1, None, 1)], SCHEMA))
    assert got.columns == ["vec_id", "label", "code", "error", "label_error"] and got.count() == 0
    assert vector_codes.books_digest(books) == vector_codes.hashlib.sha256(b"").hexdigest()


def test_components_beyond_64_bits_stop_the_job(spark):
    rows = spark.createDataFrame([(1, [1e30] * 16, 1), (2, [0.0] * 16, 1)], SCHEMA)
    with pytest.raises(Exception, match="64-bit"):
        vector_codes.compress(rows)


def test_sums_beside_with_a_heavy_and_a_null_key(spark):
    rows = [(0, i) for i in range(4000)] + [(None, i) for i in range(3000)] + [(k, k) for k in range(1, 2000)]
    got = sums_beside(spark.createDataFrame(rows, "k int, v long"), "k", "v", "s").collect()
    want = {}
    for k, v in rows:
        want[k] = want.get(k, 0) + v
    assert len(got) == len(rows) and all(r.s == want[r.k] for r in got)
