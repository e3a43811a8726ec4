"""WARC archives: records, the loser tree, revisits against a plain version, and global order."""

import glob
import gzip
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from medallion.llm import warc
from medallion.llm.common import table

SCHEMA = "page_id long, url string, html string, seconds long"


def plain(pages):
    heads = {}
    for page, _, html, _ in pages:
        raw = (html or "").encode()
        if len(raw) >= 100 and page is not None:
            heads[raw] = min(page, heads.get(raw, page))
    out = []
    for page, _, html, _ in pages:
        raw = (html or "").encode()
        head = heads.get(raw)
        revisit = head is not None and page != head
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response",
                    head if revisit else None))
    return sorted(out, key=str)


def archived(spark, pages, path, block=3000, **ways):
    df = spark.createDataFrame(pages, SCHEMA).repartition(4).withColumn("digest", F.lit(1)).withColumn("size", F.lit("x"))
    warc.write_archives(df, path, seconds=F.col("seconds"), block=block, file_blocks=2)
    return warc.read_histories(spark, path, **ways)


def contract(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_loser_tree_merges_any_number_of_runs():
    rng = random.Random(3)
    for k in (0, 1, 2, 3, 5, 8, 33):
        sorted_runs = [sorted(rng.randrange(50) for _ in range(rng.choice([0, 1, 20]))) for _ in range(k)]
        order = warc.merge_runs(sorted_runs)
        assert [(sorted_runs[r][i], r) for r, i in order] == sorted((x, r) for r, run in enumerate(sorted_runs) for x in run)
        assert sorted(order) == [(r, i) for r, run in enumerate(sorted_runs) for i in range(len(run))]


def test_records_come_back(monkeypatch):
    monkeypatch.setattr(warc, "MEMBER", 300)  # long records span members
    payloads = [b"", b"\r\n\r\nWARC/1.1\r\n\0", os.urandom(5000), "ü€".encode() * 400]
    data, want = b"", []
    for i, payload in enumerate(payloads):
        digest = hashlib.sha256(payload).hexdigest()
        for revisit in (False, True):
            one = warc.record(i, f"http://a.b/{i}", 60 * i, payload, digest, len(payload), 77 if revisit else None, revisit)
            assert one[-1] == 0 and gzip.decompress(one).startswith(b"WARC/1.1\r\n")
            want.append((len(data), len(one), f"b,a)/{i}", 60 * i, i, len(payload), digest, 77 if revisit else None))
            data += one
    got = []
    for offset, length, headers, block in warc.read_records(data):
        key, seconds, page, _, size, digest, _, refers = warc.capture(headers, block)
        got.append((offset, length, key, seconds, page, size, digest, refers))
    assert got == want
    with pytest.raises(ValueError):
        list(warc.read_records(data[:-5]))


def test_damaged_payloads_are_found():
    payload = b"x" * 200
    digest = hashlib.sha256(payload).hexdigest()
    _, _, headers, block = next(warc.read_records(warc.record(1, "u", 0, payload, digest, 200)))
    with pytest.raises(ValueError, match="digest"):
        warc.capture(headers, block[:-1] + b"y")


def test_url_keys():
    assert warc.url_key("http://www.A.example.com:80/x?Y=1#z") == "com,example,a,www)/x?Y=1"
    assert warc.url_key("https://u@h.org:8080?q") == "org,h:8080)/?q"
    assert warc.url_key("no url") == "no url" and warc.safe_url(b"a b\n\xff") == "a%20b%0A�"


def test_revisits_and_global_order(spark, tmp):
    rng = random.Random(9)
    bodies = [f"body {i} " * rng.choice([2, 40]) for i in range(60)]
    pages = [(i, f"http://h{rng.randrange(5)}.org/{rng.randrange(4)}", rng.choice(bodies), rng.randrange(1000)) for i in range(900)]
    pages += [(2000 + i, "http://hot.org/", "copy " * 50, 5) for i in range(600)]
    pages += [(5000, "http://long.org/", "long " * 60_000, 1)]
    got = archived(spark, pages, tmp + "/w", range_size=100)
    assert contract(got) == plain(pages)
    rows = sorted(got.collect(), key=lambda r: r.capture_rank)
    assert [r.capture_rank for r in rows] == list(range(len(pages)))
    order = [(r.key, r.seconds, r.page_id) for r in rows]
    assert order == sorted(order)
    assert got.rdd.getNumPartitions() > 5  # the hot URL is cut into ranges
    assert len(glob.glob(tmp + "/w/*.txt")) > 4
    for r in rows[::97]:  # the index finds its record
        data = open(r.file.removeprefix("file:"), "rb").read()[r.offset:r.offset + r.length]
        assert f"WARC-Type: {r.record_type}\r\n".encode() in gzip.decompress(data)


def test_every_file_is_a_plain_gzip_of_records(spark, tmp):
    archived(spark, [(i, f"http://a.org/{i}", "text " * i, 0) for i in range(50)], tmp + "/w")
    found = 0
    for path in glob.glob(tmp + "/w/*.txt"):
        found += gzip.decompress(open(path, "rb").read()).count(b"WARC/1.1\r\nWARC-Type: response")
    assert found == 50


def test_odd_pages(spark, tmp):
    same = "the same text " * 20
    pages = [(1, None, None, None), (1, None, None, None), (2, "http://x.org/ a\r\nb", "", -5), (None, "u", same, 1), (7, "v", same, 2),
             (7, "v", same, 2), (9, "w", same, 10 ** 15), (None, "n", "only nulls " * 20, 1), (None, "n", "only nulls " * 20, 1),
             (3, "http://x.org/", "WARC/1.1\r\n\r\n\0" * 20, 0), (4, "ü://ü", "x" * 99, 0), (5, "ü", "x" * 99, 0)]
    assert contract(archived(spark, pages, tmp + "/w")) == plain(pages)


def test_no_pages(spark, tmp):
    none = spark.createDataFrame([], SCHEMA)
    assert warc.archive_pages(none).count() == 0


def test_pages_without_a_given_folder_or_time(spark):
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    got = warc.archive_pages(pages)
    rows = [(r.page_id, r.url, r.html, 0) for r in pages.collect()]
    assert contract(got) == plain(rows)
