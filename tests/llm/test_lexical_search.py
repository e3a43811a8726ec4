"""Ranked lexical search against a plain version."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from medallion.llm import lexical_search

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return PATTERN.findall((text or "").translate(LOWER))


def plain(docs, items, top):
    texts = [(i, words(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in texts), sum(len(w) for _, w in texts)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(words(t))
    df = {}
    for _, ws in texts:
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, ts in wanted.items():
        scored = []
        for i, ws in texts:
            s = 0
            for t in ts & set(ws):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                tf, m = ws.count(t), 100 - 50 + 50 * len(ws) * n_docs // n_terms
                s += w * (10 ** 9 * tf // (1000 * tf + 20 * m))
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("form", [{}, {"docs": 7, "items_each": 3, "stages": 3}, {"pairs_each": 40, "stages": 1}])
def test_equals_the_plain_version(spark, form):
    rng = random.Random(5)
    vocabulary = [f"t{i}" for i in range(80)]
    text = lambda n: " ".join(vocabulary[int(80 * rng.random() ** 2)] for _ in range(n))
    docs = [(i, text(rng.randint(1, 60))) for i in range(150)] + [(1000 + i, "T1 t1, t2!") for i in range(30)]
    items = [(i, text(rng.randint(1, 12))) for i in range(10)]
    got = lexical_search.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                                spark.createDataFrame(items, "item_id long, text string"), top=8, **form)
    assert found(got) == plain(docs, items, 8)


def test_odd_documents_and_items(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(lexical_search, "TEXT_BYTES", 1000)
    items = [(1, "Quick brown FOX"), (1, "brown Fox, lazy"), (1, "brown Fox, lazy"), (None, "lorem ipsum"), (3, None),
             (4, " %% "), (5, "Ünï 你好 \U0001f600"), (6, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as score", "2 as rank")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert found(lexical_search.search(odd_docs, bench, docs=4)) == plain(docs, items, 50)


def test_long_texts_are_read_in_parts():
    text = ("word " * 300_000 + "x" * 3_000_000 + " end").encode()
    parts = list(lexical_search.terms(text))
    assert len(parts) > 2 and [t for p in parts for t in p] == text.split()


def test_empty_tables(spark, no_docs, odd_docs):
    items = spark.createDataFrame([(1, "fox")], "item_id long, text string")
    for docs, bench in ((no_docs, items), (odd_docs, items.where("false")), (odd_docs.where("text = ''"), items)):
        got = lexical_search.search(docs, bench)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0


def test_ranks_are_cut_in_every_task_before_the_shuffle(spark, odd_docs):
    items = spark.createDataFrame([(1, "the fox")], "item_id long, text string")
    plan = lexical_search.search(odd_docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_document_parts_beyond_64_bits():
    lengths = lexical_search.np.array([10 ** 7, 1])
    assert lexical_search.document_parts(lengths, 10 ** 12, 10 ** 14).tolist() == [50 + 5 * 10 ** 6, 50]
