"""The operators' registered queries over the driver's tables, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from medallion.llm import decontaminate as decon
from medallion.llm import embedding_dedup, html_extract, jaccard_join, language_id, line_dedup, lm_score, packing, quality, sharding
from medallion.llm import lexical_search, vector_codes, warc
from medallion.llm.common import fold, table

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return wrap


@register("op1_jaccard_join", r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(len(ws), 5) - 1], ' ') AS s
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id),
l AS (SELECT o.a, o.b FROM o JOIN n x ON x.doc_id = o.a JOIN n y ON y.doc_id = o.b
      WHERE 100 * o.o >= 75 * (x.n + y.n - o.o)),
r AS (SELECT doc_id AS node, doc_id AS low FROM w UNION SELECT l.b, r.low FROM r JOIN l ON l.a = r.node),
c AS (SELECT node, min(low) AS low FROM r GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.low AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.node = w.doc_id
""")
def op1_jaccard_join(spark, sf):
    """Documents grouped by links of Jaccard similarity 0.75 between their five-word shingles."""
    return jaccard_join.jaccard_groups(table(spark, sf, "documents"))


@register("op2_quality")
def op2_quality(spark, sf):
    """Quality scores of all documents, learned from three of four folds."""
    side = fold("doc_id", 4)
    return quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels"), side != 2, side == 3) \
        .select("doc_id", (side == 2).alias("held_out"), "score", "predicted")


@register("op3_line_dedup", """
WITH d AS (SELECT doc_id, coalesce(source, chr(0)) AS site, string_split(text, chr(10)) AS ls FROM documents),
o AS (SELECT doc_id, site, i AS pos, ls[i] AS raw, trim(ls[i], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line
      FROM (SELECT doc_id, site, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
b AS (SELECT line, min(doc_id) AS first_doc FROM o WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= 10),
k AS (SELECT o.doc_id, string_agg(o.raw, chr(10) ORDER BY o.pos) FILTER (b.line IS NULL OR o.doc_id <= b.first_doc) AS t,
             count(*) AS n, count(*) FILTER (b.line IS NOT NULL AND o.doc_id > b.first_doc) AS r
      FROM o LEFT JOIN b ON o.line = b.line GROUP BY o.doc_id)
SELECT d.doc_id, coalesce(k.n, 0) AS n_lines, coalesce(k.r, 0) AS n_removed, md5(coalesce(k.t, '')) AS kept_md5,
       length(coalesce(k.t, '')) AS kept_chars
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
""")
def op3_line_dedup(spark, sf):
    """Lines on ten or more sites removed from all documents but the first that holds them."""
    text = F.coalesce("text", F.lit(""))
    return line_dedup.line_dedup(table(spark, sf, "documents")).select(
        "doc_id", F.col("lines_seen").alias("n_lines"), F.col("lines_removed").alias("n_removed"),
        F.md5(text.cast("binary")).alias("kept_md5"), F.length(text).cast("long").alias("kept_chars"))


@register("op4_pack")
def op4_pack(spark, sf):
    """All documents as token pieces in sequences of 1024."""
    import public_tokenizers

    return packing.pack_documents(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register("op5_html_extract")
def op5_html_extract(spark, sf):
    """The main text of every page."""
    return html_extract.extract(table(spark, sf, "pages"))


@register("op6_embedding_dedup", """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e, list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) AS q
      FROM embeddings),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_inner_product(a.e, b.e) / sqrt(a.q * b.q) >= 0.9),
r AS (SELECT vec_id AS node, vec_id AS low FROM v UNION SELECT p.b, r.low FROM r JOIN p ON p.a = r.node),
c AS (SELECT node, min(low) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON c.node = v.vec_id LEFT JOIN n ON n.a = v.vec_id
""")
def op6_embedding_dedup(spark, sf):
    """All embeddings linked at cosine 0.9."""
    return embedding_dedup.link_embeddings(table(spark, sf, "embeddings"))


@register("op7_sharding")
def op7_sharding(spark, sf):
    """All documents into 40 shards of near equal bytes, equal texts together."""
    return sharding.shard_by_bytes(table(spark, sf, "documents"), shards=40)


@register("op8_lm_score")
def op8_lm_score(spark, sf):
    """Trigram scores of all documents, learned from four of five folds."""
    held_out = fold("doc_id", 5) == 1
    return lm_score.score_documents(table(spark, sf, "documents"), ~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register("op9_language_id")
def op9_language_id(spark, sf):
    """Every document's language, learned from four of five folds."""
    docs = table(spark, sf, "documents")
    return language_id.predict(docs, language_id.training_rows(docs, 5)).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


@register("op10_decontaminate", f"""
WITH lowered AS (SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
w AS (SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS ws FROM lowered),
items AS (SELECT id AS item_id, ws, least(len(ws), 10) AS k FROM w WHERE kind = 1 AND len(ws) > 0),
iw AS (SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS win
       FROM (SELECT *, unnest(range(1, len(ws) - k + 2)) AS i FROM items)),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT id AS doc_id, k, i AS pos, array_to_string(ws[i:i + k - 1], ' ') AS win
       FROM (SELECT w.id, w.ws, ks.k, unnest(range(1, len(w.ws) - ks.k + 2)) AS i FROM w, ks WHERE w.kind = 0)),
h AS (SELECT dw.doc_id, dw.pos, dw.k, iw.item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.win = iw.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(pos, pos + k)) AS p FROM h) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
               string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
        FROM h GROUP BY doc_id)
SELECT w.id AS doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit ON hit.doc_id = w.id LEFT JOIN its ON its.doc_id = w.id WHERE w.kind = 0
""")
def op10_decontaminate(spark, sf):
    """Documents against the benchmark's ten-word windows."""
    return decon.report(decon.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark")))


TERMS = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


@register("op11_lexical_search", f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERMS}') AS ts FROM documents),
s AS (SELECT count(*) FILTER (len(ts) > 0) AS nn, sum(len(ts)) AS ll FROM d),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERMS}')) AS t FROM benchmark),
p AS (SELECT row, t, count(*) AS tf FROM (SELECT row, unnest(ts) AS t FROM d) GROUP BY row, t),
f AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM p, s WHERE t IN (SELECT t FROM i) GROUP BY t, nn),
m AS (SELECT row, doc_id, CAST(50 + (50 * len(ts) * nn) // ll AS BIGINT) AS m FROM d, s),
c AS (SELECT i.item_id, m.row, m.doc_id, CAST(sum(f.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * m.m))) AS BIGINT) AS score
      FROM i JOIN f ON f.t = i.t JOIN p ON p.t = i.t JOIN m ON m.row = p.row GROUP BY i.item_id, m.row, m.doc_id)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM c WHERE score > 0)
WHERE r <= 50
""")
def op11_lexical_search(spark, sf):
    """The fifty best documents of each benchmark item."""
    return lexical_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@register("op12_warc", """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
r AS (SELECT d, min(page_id) AS head FROM p WHERE n >= 100 GROUP BY d)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN r.head <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN r.head <> p.page_id THEN r.head END AS refers_to
FROM p LEFT JOIN r ON r.d = p.d
""")
def op12_warc(spark, sf):
    """All pages as WARC records, read back as capture histories; a page's time is its number in seconds."""
    seconds = F.lit(1_700_000_000) + F.pmod(F.col("page_id"), F.lit(1_000_000_000))
    return warc.archive_pages(table(spark, sf, "pages"), seconds=seconds) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _code_round(book: str, name: str) -> str:
    """SQL of one assignment (``d``istances, ``a``ssigned) by the codebook ``book``."""
    return f"""
d{name} AS (SELECT x.row, x.part, b.entry, sum((x.x - b.x) * (x.x - b.x)) AS d
        FROM x JOIN {book} b ON x.part = b.part AND x.pos = b.pos GROUP BY x.row, x.part, b.entry),
a{name} AS (SELECT row, part, min(d) AS d, arg_min(entry, d * 64 + entry) AS entry FROM d{name} GROUP BY row, part)"""


def _next_book(book: str, assigned: str, name: str) -> str:
    return f"""
{name} AS (SELECT b.part, b.entry, b.pos, coalesce(m.x, b.x) AS x FROM {book} b LEFT JOIN
       (SELECT a.part, a.entry, x.pos, CAST(floor(sum(x.x) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS x
        FROM {assigned} a JOIN x ON a.row = x.row AND a.part = x.part GROUP BY a.part, a.entry, x.pos) m
       ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos)"""


@register("op13_vector_codes", f"""
WITH k AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS row, vec_id, label,
       [CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS v FROM embeddings
       WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS (SELECT row, i // (len(v) // 16) AS part, i % (len(v) // 16) AS pos, v[i + 1] AS x
      FROM (SELECT row, v, unnest(range(0, len(v))) AS i FROM k)),
b0 AS (SELECT part, row AS entry, pos, x FROM x WHERE row < 64),
{_code_round("b0", "0")},{_next_book("b0", "a0", "b1")},
{_code_round("b1", "1")},{_next_book("b1", "a1", "b2")},
{_code_round("b2", "2")},
h AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) AS sha FROM b2),
c AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
      FROM a2 GROUP BY row)
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       h.sha AS codebooks_sha256
FROM k JOIN c ON k.row = c.row CROSS JOIN h
""")
def op13_vector_codes(spark, sf):
    """All embeddings as sixteen-byte codes."""
    coded, books = vector_codes.compress(table(spark, sf, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error",
                        F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256"))
