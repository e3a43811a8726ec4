"""The pipeline's stages against brute-force versions, each on its own input."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from medallion.llm.common import table

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module")
def planted(spark):
    """Documents with exact and near copies, boilerplate, benchmark passages and texts without a language."""
    rng = random.Random(12)
    rows = table(spark, SF, "documents").orderBy("doc_id").collect()
    passage = table(spark, SF, "benchmark").first().text
    docs = [tuple(r[c] for c in COLUMNS) for r in rows]
    base = [d for d in docs if len(d[1].split()) > 60][:12]
    for i, (_, text, lang, source, n) in enumerate(base):
        ws = text.split(" ")
        ws[rng.randrange(len(ws))] = "changed"
        docs.append((5000 + i, " ".join(ws), lang, source, n))
        docs.append((6000 + i, text, lang, f"src{i}", n))
        docs.append((7000 + i, f"{text} {passage}\nShared by all sites.", lang, f"src{i}", n))
    docs += [(8000, None, None, None, None), (8001, "", "en", "src1", 0), (8002, "123 %%%", "en", "src1", 7),
             (8003, "Shared by all sites.", "en", "src3", 20), (1, docs[1][1], "en", "src1", 5)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_are_the_five_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontaminate",
                                                           "pack"]


def test_language_stage_keeps_all_that_has_a_language(spark, planted):
    out = stage("language_id")(spark, planted, SF)
    assert out.columns == COLUMNS
    assert ids(out) == ids(planted.where("doc_id not in (8000, 8001, 8002)"))


def test_line_stage_equals_brute_force(spark, planted):
    rows = planted.collect()
    sites, first = {}, {}
    for r in rows:
        for line in (r.text or "").split("\n"):
            line = line.strip(" \t\r\x0b\x0c")
            if line:
                sites.setdefault(line, set()).add(r.source)
                first[line] = min(first.get(line, r.doc_id), r.doc_id)
    want = []
    for r in rows:
        lines = None if r.text is None else r.text.split("\n")
        kept = lines and [x for x in lines if not (len(sites.get(x.strip(" \t\r\x0b\x0c"), ())) >= 10
                                                   and first[x.strip(" \t\r\x0b\x0c")] < r.doc_id)]
        if kept == lines or re.search(r"\S", "\n".join(kept)):
            text = r.text if kept == lines else "\n".join(kept)
            want.append((r.doc_id, text, r.n_chars if kept == lines else len(text)))
    out = stage("line_dedup")(spark, planted, SF)
    assert out.columns == COLUMNS
    assert sorted(map(str, ((r.doc_id, r.text, r.n_chars) for r in out.collect()))) == sorted(map(str, want))
    assert 8003 not in ids(out)


def shingles(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(ws[i:i + 5]) for i in range(max(len(ws) - 5, 0) + 1)} if ws else set()


def test_near_copy_stage_keeps_one_of_each_group(spark, planted):
    rows = planted.collect()
    sets = [(r.doc_id, shingles(r.text)) for r in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, s) in enumerate(sets):
        for b, t in sets[:k]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    out = stage("jaccard_join")(spark, planted, SF)
    assert out.columns == COLUMNS and ids(out) == sorted({find(i) for i in root})


def test_repeated_and_null_ids_lose_no_text(spark, odd_docs):
    """Unrelated texts under one id both stay; of near copies the smallest id stays, of repeated rows one."""
    rows = [(1, "one two three four five six seven", "en"), (1, "an unrelated text of quite other words here", "de"),
            (2, "one two three four five six seven", "en"), (2, "one two three four five six seven", "fr"),
            (None, "one two three four five six seven", "en"), (None, "alone without an id in this table", "en"),
            (3, None, "en"), (3, None, "en"), (3, "", "en"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in stage("jaccard_join")(spark, docs, SF).collect()), key=str)
    assert got == sorted([(1, rows[0][1]), (1, rows[1][1]), (None, rows[5][1]), (3, None), (3, ""), (None, None)], key=str)
    again = [sorted(map(str, stage("jaccard_join")(spark, odd_docs.repartition(n), SF).collect())) for n in (1, 4)]
    assert again[0] == again[1]


def test_contaminated_documents_go(spark, planted):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = set()
    for r in table(spark, SF, "benchmark").collect():
        ws = re.findall(pattern, (r.text or "").translate(LOWER))
        windows |= {" ".join(ws[i:i + 10]) for i in range(max(len(ws) - 10, 0) + 1)} if ws else set()
    clean = [r.doc_id for r in planted.collect()
             if not any(f" {w} " in f" {' '.join(re.findall(pattern, (r.text or '').translate(LOWER)))} " for w in windows)]
    out = stage("decontaminate")(spark, planted, SF)
    assert out.columns == COLUMNS and ids(out) == sorted(clean)
    assert not set(ids(out)) & set(range(7000, 7012))


def test_last_stage_packs_every_document(spark, planted):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = stage("pack")(spark, planted, SF)
    want = sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in planted.collect())
    assert out.agg(F.sum("length")).first()[0] == want
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 1024


def test_run_equals_the_stages_one_by_one(spark):
    docs = table(spark, SF, "documents")
    for _, f in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(f(spark, docs, SF).collect(), docs.schema)
    out = corpus_pipeline.run(spark, SF)
    assert sorted({r.doc_id for r in out.collect()}) == ids(docs)


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs):
    for name, f in corpus_pipeline.STAGES:
        assert f(spark, no_docs, SF).count() == 0
        out = f(spark, odd_docs, SF)
        if name != "pack":
            assert out.columns == odd_docs.columns
        out.collect()
