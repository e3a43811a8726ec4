"""Decontamination, line dedup, language ID, LM scores and quality against brute-force versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.llm import decontaminate as decon
from medallion.llm import language_id, line_dedup, lm_score, quality
from medallion.llm.common import fold, table
from medallion.llm.word_hash import deltas, pack, unpack, word_hashes

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text, pattern):
    return re.findall(pattern, (text or "").translate(LOWER))


# ------------------------------------------------------------------------------------------ word hashes
def test_word_hashes_follow_words():
    texts = ["The cat  sat\ton", "", " the CAT sat on the\x0bmat ", "\n", "été É x" * 3000]
    expected = [words(t, r"[^\x20\x09-\x0D]+") for t in texts]
    hashes, counts = word_hashes([t.encode() for t in texts])
    assert counts.tolist() == [len(w) for w in expected]
    flat = [w for ws in expected for w in ws]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


def test_pack_round_trip():
    x = np.sort(np.random.default_rng(1).integers(0, 1 << 48, 1000, dtype=np.uint64))
    assert (np.cumsum(unpack(pack(deltas(x), 6), 6)) == x).all()
    assert len(unpack(pack(x[:0], 5), 5)) == 0


# ------------------------------------------------------------------------------------------ decontamination
def brute_decontaminate(docs, bench, window=10):
    out = {}
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    for doc, text in docs:
        ws, hit, items = words(text, pattern), set(), set()
        for item, t in bench:
            iw = words(t, pattern)
            k = min(len(iw), window)
            wins = {tuple(iw[i:i + k]) for i in range(len(iw) - k + 1)} if iw else set()
            for i in range(len(ws) - k + 1 if k else 0):
                if tuple(ws[i:i + k]) in wins:
                    hit.update(range(i, i + k))
                    items.add(item)
        out[doc] = (len(ws), len(hit), sorted(items))
    return out


@pytest.fixture(scope="module")
def leaks(spark):
    rng = random.Random(3)
    vocabulary = "alpha beta gamma delta Épsilon zeta eta theta iota kappa".split()
    bench = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 9, 10, 11, 30])))) for i in range(25)]
    bench += [(90, None), (91, ""), (92, "--"), (93, bench[0][1])]
    docs = []
    for i in range(60):
        ws = rng.choices(vocabulary, k=rng.randrange(0, 60))
        if i % 3 == 0:
            at = rng.randrange(len(ws) + 1)
            ws[at:at] = rng.choice(bench[:25])[1].upper().split()
        docs.append((i, rng.choice([" ", ", ", "\n-- "]).join(ws)))
    docs += [(100, None), (101, "")]
    return (docs, bench, spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(bench, "item_id long, text string"))


@pytest.mark.parametrize("block_bytes", [32 << 20, 400])
def test_decontaminate_equals_brute_force(leaks, block_bytes):
    docs, bench, d, b = leaks
    got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in decon.decontaminate(d, b, block_bytes=block_bytes).collect()}
    assert got == brute_decontaminate(docs, bench)


def test_decontaminate_spans_point_into_the_text(spark):
    bench = spark.createDataFrame([(1, "Ünder the Old bridge")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Ça va: ünder -- the OLD\nbridge!")], "doc_id long, text string")
    row = decon.decontaminate(docs, bench).first()
    # only A-Z are lower-cased: Ü and ü differ, so nothing is found; the same letter is
    assert row.n_hit == 0
    row = decon.decontaminate(docs, bench.selectExpr("item_id", "replace(text, 'Ü', 'ü') as text")).first()
    assert [docs.first().text[s.start:s.end] for s in row.spans] == ["ünder -- the OLD\nbridge"]


def test_decontaminate_odd_rows(odd_docs, no_docs, spark):
    bench = spark.createDataFrame([(1, "quick brown fox"), (None, "one two"), (2, None)], "item_id long, text string")
    rows = decon.report(decon.decontaminate(odd_docs, bench)).collect()
    assert len(rows) == odd_docs.count()
    assert sorted(r.doc_id for r in rows if r.contaminated) == [1, 1, 2]
    assert decon.decontaminate(no_docs, bench).count() == 0
    assert decon.decontaminate(odd_docs, bench.where("false")).where("n_hit > 0").count() == 0


# ------------------------------------------------------------------------------------------ line dedup
def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(5)
    pool = [f"line number {i}" for i in range(40)]
    docs = [(i, "\n".join(rng.choices(pool, k=rng.randrange(0, 9), weights=[1 / (j + 1) for j in range(40)])),
             rng.choice(["a", "b", "c", "d", "e", "f", "g", None])) for i in range(80)]
    got = {r.doc_id: (r.text, r.lines_removed) for r in line_dedup.line_dedup(
        spark.createDataFrame(docs, "doc_id long, text string, source string"), min_sites=4).collect()}
    sites, first = {}, {}
    for i, t, s in docs:
        for x in t.split("\n"):
            if x:
                sites.setdefault(x, set()).add(s)
                first.setdefault(x, i)
    for i, t, _ in docs:
        kept = [x for x in t.split("\n") if not (len(sites.get(x, ())) >= 4 and first[x] < i)]
        assert got[i] == ("\n".join(kept), len(t.split("\n")) - len(kept))


def test_line_dedup_odd_rows(odd_docs, no_docs):
    out = line_dedup.line_dedup(odd_docs, min_sites=2)
    assert out.columns[:len(odd_docs.columns)] != [] and set(odd_docs.columns) < set(out.columns)
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    gone = {r.doc_id for r in rows if r.lines_removed}
    assert gone == {2, 10}  # both rows of document 1 keep the line, a null site counts as one
    assert all(r.text is None and r.lines_seen == 0 for r in rows if r.doc_id == 3)
    assert line_dedup.line_dedup(no_docs).count() == 0


# ------------------------------------------------------------------------------------------ language ID
def slow_bits(text: bytes, counts: Counter) -> float:
    """PPM code length, context by context."""
    total = 0.0
    padded = language_id.START + text.translate(language_id.FOLD_BYTES)
    for i in range(3, len(padded)):
        for order in (3, 2, 1, 0):
            context, nxt = padded[i - order:i], padded[i:i + 1]
            after = Counter()
            for s, n in counts.items():
                if s[3 - order:3] == context:
                    after[s[3:]] += n
            if not after:
                continue
            if after[nxt]:
                total -= math.log2(after[nxt] / (sum(after.values()) + len(after)))
                break
            total -= math.log2(len(after) / (sum(after.values()) + len(after)))
        else:
            total += 8
    return total


def test_code_lengths_equal_slow_version(spark):
    texts = {"x": ["banana bandana", "an Apple 42"], "y": ["ñandú ñoño", "banjo"]}
    labelled = spark.createDataFrame([(k, t) for k, ts in texts.items() for t in ts], "lang string, text string")
    trees = language_id.ContextTrees(language_id.collect_counts(language_id.count_strings(labelled)))
    probes = [b"banana", "ñandu".encode(), b"zzz", b"", b"apple 17 ban"]
    got = trees.text_bits(probes)
    for k, lang in enumerate(trees.langs):
        counts = Counter()
        for t in texts[lang]:
            p = language_id.START + t.encode().translate(language_id.FOLD_BYTES)
            counts.update(p[i - 3:i + 1] for i in range(3, len(p)))
        for j, probe in enumerate(probes):
            assert got[j, k] == pytest.approx(slow_bits(probe, counts))


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    out = language_id.predict(docs, language_id.training_rows(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    held = out.where(fold("doc_id", 5) == 0)
    assert held.where("lang = lang_pred").count() / held.count() > 0.95


def test_language_odd_rows(odd_docs, no_docs):
    rows = language_id.predict(odd_docs, odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {None, 3, 4, 5, 6}
    assert all(r.lang_pred == "und" and r.score == 0 for r in language_id.predict(odd_docs, no_docs).collect())
    assert language_id.predict(no_docs, odd_docs).count() == 0


def test_language_keeps_every_count_beside_a_large_language(spark):
    rng = np.random.default_rng(8)
    noise = ["".join(chr(c) for c in rng.integers(91, 127, 20_000)) for _ in range(60)]
    rows = [("big", t) for t in noise] * 2 + [("rare", "zażółć gęślą jaźń")]
    labelled = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert language_id.count_strings(labelled).count() > 500_000  # beyond one block
    docs = spark.createDataFrame([(1, "gęślą jaźń"), (2, noise[0][:200])], "doc_id long, text string")
    assert dict((r.doc_id, r.lang_pred) for r in language_id.predict(docs, labelled).collect()) == {1: "rare", 2: "big"}


@pytest.mark.parametrize("block_strings", [1500])
def test_language_blocks_make_no_difference(spark, odd_docs, block_strings):
    labelled = table(spark, SF, "documents").select("lang", "text").limit(60).unionByName(odd_docs.select("lang", "text"))
    twin = labelled.where("lang = 'en'").selectExpr("'zz' as lang", "text")  # equal counts: the first language wins
    labelled = labelled.unionByName(twin).localCheckpoint()
    counts = language_id.count_strings(labelled.where("lang is not null and text is not null"))
    pieces = [p for b in language_id.model_blocks(counts, block_strings) for p in b]
    assert len(pieces) > 4 and sum(len(p.strings) for p in pieces) == counts.count()
    docs = table(spark, SF, "documents").select("doc_id", "text").limit(60).unionByName(odd_docs.select("doc_id", "text"))
    want = sorted(map(tuple, language_id.predict(docs, labelled).collect()), key=str)
    got = sorted(map(tuple, language_id.predict(docs, labelled, block_strings).collect()), key=str)
    assert [r[:2] for r in got] == [r[:2] for r in want] and "zz" not in {r[1] for r in got}
    assert [r[2] for r in got] == pytest.approx([r[2] for r in want])


# ------------------------------------------------------------------------------------------ LM scores
def test_lm_scores_equal_brute_force(spark):
    docs = table(spark, SF, "documents")
    learn = fold("doc_id", 5) != 1
    known = lm_score.token_counts(docs, learn)
    model = lm_score.fit(known)
    got = {r.doc_id: r for r in lm_score.score_documents(docs, learn).collect()}
    texts = {r.doc_id: words(r.text, r"[^\x20\x09-\x0D]+") + ["\0end"] for r in docs.collect()}
    train = {i for i in texts if zlib.crc32(str(i).encode()) % 5 != 1}
    grams = {k: Counter(g for i in train for g in zip(*((["\0b"] * (k - 1) + texts[i])[j:] for j in range(k))))
             for k in (1, 2, 3)}
    n, v = sum(grams[1].values()), len(grams[1])
    assert (model.corpus.tokens, model.corpus.words, model.corpus.docs) == (n, v, len(train))
    for i, tokens in texts.items():
        base = score = 0.0
        padded = ["\0b"] * 2 + tokens
        for j, w in enumerate(tokens):
            p = (grams[1][w,] + 0.5) / (n + 0.5 * (v + 1))
            base += math.log10(p)
            for k in (2, 3):
                gram = tuple(padded[j + 3 - k:j + 3])
                context = gram[:-1]
                c = len(train) if context in ((("\0b",)), ("\0b", "\0b")) else grams[k - 1][context]
                weight = model.weights[k][min(int(math.log2(c + 1)), lm_score.CONTEXT_BUCKETS - 1)]
                p = weight * (grams[k][gram] / c if c else 0.0) + (1 - weight) * p
            score += math.log10(p)
        assert got[i].n_tokens == len(tokens) and got[i].train_tokens == n and got[i].train == (i in train)
        assert got[i].n_known == sum(grams[1][w,] > 0 for w in tokens)
        assert got[i].base_score == pytest.approx(base) and got[i].score == pytest.approx(score)
    held = [got[i] for i in texts if i not in train]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_hashes_of_two_ngrams_differ_in_36_bits(monkeypatch):
    bits = 8
    near = np.array([5 << 40, (5 << 40) + (1 << 64 - bits - 36)], np.uint64)
    monkeypatch.setattr(lm_score, "_ngrams", lambda tokens, counts, order: near)
    assert len(lm_score._requests(None, None, 2, bits)[0]) == 2


def test_em_maximises_the_deleted_likelihood():
    rng = np.random.default_rng(4)
    histogram = np.zeros((lm_score.CONTEXT_BUCKETS, lm_score.RATIO_BINS))
    histogram[3] = rng.integers(0, 50, lm_score.RATIO_BINS)
    histogram[3, 0] = 900
    w = lm_score.expectation_maximisation(histogram)
    ratio = np.exp2((np.arange(lm_score.RATIO_BINS) - lm_score.RATIO_BINS // 2) / 4)
    ratio[0] = 0
    grid = np.linspace(0.001, 0.999, 999)
    best = grid[np.argmax([(histogram[3] * np.log(g * ratio + 1 - g)).sum() for g in grid])]
    assert w[3] == pytest.approx(best, abs=0.01) and w[0] == 0 and w[5] == 0


def test_lm_odd_rows(odd_docs, no_docs):
    rows = lm_score.score_documents(odd_docs, F.col("doc_id") != 9).collect()
    assert len(rows) == odd_docs.count()
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert all(r.n_tokens == 1 for r in rows if r.doc_id in (3, 4, 5))
    nothing = lm_score.score_documents(odd_docs, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.score == pytest.approx(r.base_score) for r in nothing)
    assert lm_score.score_documents(no_docs, F.lit(True)).count() == 0


# ------------------------------------------------------------------------------------------ quality
def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    side = fold("doc_id", 4)
    labels = table(spark, sf, "labels")
    out = quality.classify(table(spark, sf, "documents"), labels, side != 2, side == 3).join(labels, "doc_id")
    held = out.where(side == 2)
    assert held.where("predicted = quality").count() / held.count() > 0.95


def test_normal_equations_equal_numpy(spark):
    rng = np.random.default_rng(2)
    x, y = rng.standard_normal((200, quality.N_FEATURES)), rng.integers(0, 2, 200).astype(float)
    rows = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "features array<double>, label double")
    fourier = quality.FourierMap(x.mean(0), x.std(0))
    cells = rows.repartition(5).mapInArrow(quality._sum_products(fourier), "cell int, value double") \
        .groupBy("cell").agg(F.sum("value")).collect()
    z = fourier(x)
    a = z.T @ z
    want = np.linalg.solve(a + quality.RIDGE * len(x) / len(a) * np.eye(len(a)), z.T @ y)
    assert np.allclose(z @ quality._solve(dict(map(tuple, cells))), z @ want)


def test_isotonic_is_monotone_and_keeps_means():
    at, value = quality.isotonic(np.arange(6.0), np.ones(6), np.array([0, 1, 0, 1, 1, 0.0]))
    assert (np.diff(value) > 0).all() and value[0] == 0 and value[-1] == pytest.approx(2 / 3)


def test_quality_odd_rows(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (6, 0), (None, 1), (77, 0), (1, 1)], "doc_id long, quality int")
    rows = quality.classify(odd_docs, labels, F.lit(True), F.col("doc_id") == 6).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    flat = quality.classify(odd_docs, labels.where("false"), F.lit(True), F.lit(False)).collect()
    assert {r.score for r in flat} == {0.5}
    assert quality.classify(no_docs, labels, F.lit(True), F.lit(False)).count() == 0
