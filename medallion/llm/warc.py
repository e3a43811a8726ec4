"""WARC archives of page captures, read back into globally ordered capture histories by an external index merge.

Writing.  Each page becomes one WARC/1.1 record, a gzip member of its own: a ``response`` with the HTTP head and the
whole payload, or, where an equal payload of at least ``MIN_REVISIT`` bytes is kept under a smaller page id, a
``revisit`` with the HTTP head only, which refers to that response.  Spark's text writer puts the members into files of
bounded size, so files are committed by Spark's own protocol and may lie in any store that Spark writes to: a member's
last byte is always zero (the high byte of a size below 16 MB; longer records are several members), and the writer's
line separator is that byte.

Reading.  An archive file is read whole (its size is bounded), every payload is checked against its digests, and the
file's captures, sorted by (URL key, time, page id), form one *run*.  The run's captures go to key ranges, whose
bounds come from a sample of the runs; a task takes one range, holds its piece of every run, and merges the pieces
with a loser tree.  Ranges follow one another, so (range, place) orders all captures; the ranges' sizes, one number
for each, make it a rank.

Scale: a range holds about ``RANGE`` captures whatever the keys, for its bounds are whole (key, time, page id) triples:
a URL with a third of all captures is cut into many ranges, and ranks go on across them.  Payloads move once, gzipped, to meet the
smallest page id of their digest; digests with more than a 1024th of all pages (fewer than 1024) are broadcast instead
and their repeats move without payload.  A broadcast or joined table never holds payloads.

Defined results: a null payload is empty.  Pages with a null id come last: they refer to the smallest id of their
payload, and where all ids are null each is a response.  Repeated rows of the smallest id are all responses, of any
other id revisits; captures with one URL, time and id (ties) keep an order of their own.  A null URL is empty and sorts
first; blanks and control characters of a URL are percent-encoded in the file and in the result.  Times are whole
seconds of the years 1970 to 9999; earlier and null ones are 1970's first second.  Payloads of any length are written
whole.  An empty table gives no rows.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import cut, give_back, heavy_keys, runs
from medallion.session import work_dir

MIN_REVISIT = 100        # bytes of the smallest payload that is not written again
BLOCK = 1 << 20          # bytes of consecutive records in one row of the text writer
FILE_BLOCKS = 32         # blocks in a file
MEMBER = 1 << 23         # bytes of a record in one gzip member: below 16 MB
RANGE = 1 << 18          # captures of a merge range
SAMPLES = 32             # sampled keys for each range
LEVEL = 6
CHUNK = 1 << 14       # bytes given to the decompressor at once
LAST = 253402300799  # the last second of the year 9999


# ---------------------------------------------------------------------------------------------- records
def safe_url(url: bytes | None) -> str:
    """The URL without blanks and control characters, which would break a header line."""
    text = (url or b"").decode("utf-8", "replace")
    return re.sub(r"[\x00-\x20\x7f-\xa0\u2028\u2029]", lambda c: "".join(f"%{b:02X}" for b in c[0].encode()), text)


def url_key(url: str) -> str:
    """Sort-friendly form: host labels reversed, then port, path and query: com,example)/a?b."""
    found = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::(\d+))?([^#]*)", url, re.I)
    if not found:
        return url.lower()
    host, port, rest = found.groups()
    port = "" if port in (None, "80", "443") else ":" + port
    return ",".join(reversed(host.lower().split("."))) + port + ")" + (rest if rest.startswith("/") else "/" + rest)


def _date(seconds: int | None) -> str:
    return datetime.fromtimestamp(min(max(seconds or 0, 0), LAST), timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def _record_id(page_id, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest[:32]}>"


def record(page_id, url: str, seconds: int, payload: bytes, digest: str, size: int, refers_to=None,
           revisit: bool = False) -> bytes:
    """A WARC record as gzip members; ``size`` and ``digest`` are the payload's, also where a revisit leaves it out."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if not revisit:
        block += payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id, digest)),
            ("WARC-Date", _date(seconds)), ("WARC-Target-URI", url),
            ("WARC-Payload-Digest", "sha256:" + digest), ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest())]
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", _record_id(refers_to, digest))]
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "surrogatepass") \
        + b"\r\n" + block + b"\r\n\r\n"
    return b"".join(_member(raw[at:at + MEMBER]) for at in range(0, len(raw), MEMBER))


def _member(raw: bytes) -> bytes:
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return squeeze.compress(raw) + squeeze.flush()


def read_records(data: bytes):
    """(offset, length, headers, block) of each record of an archive; members that continue a record are joined."""
    at, begin, raw = 0, 0, b""
    while at < len(data):
        open_ = zlib.decompressobj(31)
        while not open_.eof and at < len(data):
            raw += open_.decompress(data[at:at + CHUNK])
            at += CHUNK
        at = min(at, len(data)) - len(open_.unused_data)
        if not open_.eof:
            raise ValueError(f"archive ends within the record at {begin}")
        head, blank, rest = raw.partition(b"\r\n\r\n")
        if not blank:
            continue
        lines = head.decode("utf-8", "surrogatepass").split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        if len(rest) < size + 4:
            continue
        if lines[0] != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
            raise ValueError(f"no WARC record at {begin}")
        yield begin, at - begin, headers, rest[:size]
        begin, raw = at, b""
    if raw:
        raise ValueError(f"archive ends within the record at {begin}")


def _page_of(record_id: str):
    page = record_id.split(":")[2]
    return int(page) if page else None


def capture(headers: dict, block: bytes) -> tuple:
    """(key, seconds, page_id, url, payload_bytes, payload_digest, record_type, refers_to), digests checked."""
    if "sha256:" + hashlib.sha256(block).hexdigest() != headers["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {headers['WARC-Record-ID']}")
    head, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(head.rsplit(b" ", 1)[1]), headers["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload digest of {headers['WARC-Record-ID']}")
    seconds = int(datetime.strptime(headers["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc).timestamp())
    refers = headers.get("WARC-Refers-To")
    url = headers["WARC-Target-URI"]
    return (url_key(url), seconds, _page_of(headers["WARC-Record-ID"]), url, size, digest, kind,
            _page_of(refers) if refers else None)


def _rows(batch, *names):
    return zip(*(batch.column(n).to_pylist() for n in names))


# ---------------------------------------------------------------------------------------------- writing
def _squeeze(batches):
    """Response records; a page that is known to repeat another one moves without payload."""
    for batch in batches:
        out = [None if known else record(page, safe_url(url), seconds, payload, digest, size) for page, url, seconds, payload,
               digest, size, known in _rows(batch, "page_id", "url", "seconds", "payload", "digest", "size", "known")]
        names = [n for n in batch.schema.names if n not in ("payload", "known")]
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(out, pa.binary())],
                                         names=[*names, "record"])


def _revisits(block: int):
    """Blocks of consecutive final records: pages with ``head`` become revisits.  Each lacks its last byte."""
    def run(batches):
        held, size = [], 0
        for batch in batches:
            for page, url, seconds, digest, n, head, squeezed in _rows(batch, "page_id", "url", "seconds", "digest", "size",
                                                                       "head", "record"):
                if head is not None:
                    squeezed = record(page, safe_url(url), seconds, b"", digest, n, head, True)
                held.append(squeezed)
                size += len(squeezed)
                if size >= block:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], names=["block"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], names=["block"])
        give_back()
    return run


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   seconds=None, block: int = BLOCK, file_blocks: int = FILE_BLOCKS) -> None:
    """``pages`` as WARC files under ``path``; ``seconds`` is the capture time (a column, seconds since 1970).  A file has
    at most ``file_blocks`` blocks of ``block`` bytes, each longer by its last record at most."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").cast("binary").alias("url"),
                        F.coalesce(seconds if seconds is not None else F.lit(0), F.lit(0)).cast("long").alias("seconds"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("digest"),
                        F.length(payload).cast("long").alias("size"))
    heads = cut(rows.where(F.col("size") >= MIN_REVISIT).groupBy("digest")
                .agg(F.min("page_id").alias("head"), F.count("*").alias("n")).where("n > 1 and head is not null"))
    heavy = heavy_keys(heads, "digest", "n")
    # a digest alone says nothing of its size: two payloads with one SHA-256 are taken as equal
    known = F.broadcast(heavy.select("digest", F.col("head").alias("heavy_head")))
    repeats = F.col("heavy_head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("heavy_head"))
    squeezed = rows.join(known, "digest", "left").withColumn("known", repeats).mapInArrow(
        _squeeze, "digest string, page_id long, url binary, seconds long, size long, heavy_head long, record binary")
    # rows of a heavy digest join on a key of their own, which finds nothing
    key = F.when(F.col("heavy_head").isNull(), F.col("digest")).otherwise(
        F.concat(F.lit("-"), F.xxhash64("page_id", "url", "digest").cast("string")))
    light = heads.join(heavy.select("digest"), "digest", "left_anti").select(F.col("digest").alias("key"), "head")
    typed = squeezed.withColumn("key", key).join(light, "key", "left").withColumn("head", F.coalesce("heavy_head", "head"))
    final = typed.withColumn("head", F.when(~F.col("page_id").eqNullSafe(F.col("head")), F.col("head"))) \
        .select("page_id", "url", "seconds", "digest", "size", "head", "record")
    final.mapInArrow(_revisits(block), "block binary").select(F.col("block").cast("string").alias("value")) \
        .write.option("lineSep", "\0").option("maxRecordsPerFile", file_blocks).text(path)


# ---------------------------------------------------------------------------------------------- reading
CAPTURE = ("key string, seconds long, page_id long, url string, payload_bytes long, payload_digest string, "
           "record_type string, refers_to long, file string, offset long, length long")
_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(),
          pa.int64(), pa.int64()]
_NAMES = [c.split()[0] for c in CAPTURE.split(", ")]


def _order(key: str, seconds: int, page_id) -> tuple:
    return key, seconds, page_id is None, page_id or 0


def _runs(batches):
    """Each archive file's captures as one sorted run."""
    for batch in batches:
        for file, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            found = [(*capture(headers, block), file, offset, length)
                     for offset, length, headers, block in read_records(content.as_buffer().to_pybytes())]
            found.sort(key=lambda c: _order(*c[:3]))
            for at in range(0, len(found), 4096):
                columns = list(zip(*found[at:at + 4096]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, _TYPES)]
                    + [pa.array(np.arange(at, at + len(columns[0])))], names=[*_NAMES, "seq"])
    give_back()


def _deal(bounds: list[tuple]):
    """The range of each capture; a run stays sorted within a range."""
    def run(batches):
        for batch in batches:
            place = [bisect_right(bounds, _order(*t)) for t in _rows(batch, "key", "seconds", "page_id")]
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), *batch.columns],
                                             names=["range", *batch.schema.names])
    return run


def merge_runs(sorted_runs: list[list]) -> list[tuple[int, int]]:
    """Loser tree over sorted runs: (run, place) of all entries in ascending order, equal ones by run."""
    k = len(sorted_runs)
    if k < 2:
        return [(0, i) for r in sorted_runs for i in range(len(r))]
    at = [0] * k
    ahead: list = [(r[0], i) if r else None for i, r in enumerate(sorted_runs)]  # each run's next entry

    def beats(a: int, b: int) -> bool:
        x, y = ahead[a], ahead[b]
        return y is None or (x is not None and x < y)

    losers, winners = [0] * k, [0] * k + list(range(k))  # a complete tree: node n plays 2n against 2n + 1
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    top, out = winners[1], []
    while ahead[top] is not None:
        place = at[top]
        out.append((top, place))
        at[top] = place = place + 1
        ahead[top] = (sorted_runs[top][place], top) if place < len(sorted_runs[top]) else None
        node = (top + k) // 2
        while node:  # the new entry plays the losers on its way up
            if beats(losers[node], top):
                losers[node], top = top, losers[node]
            node //= 2
    return out


def _merge(first_rank: dict[int, int]):
    """The captures of each range in order; a partition is sorted by range, run and place in the run."""
    def run(batches):
        held, number = [], None
        for (place, _), rows in runs(batches, 2):
            if place != number and held:
                yield from merged(number, held)
                held = []
            number = place
            held.append(rows)
        if held:
            yield from merged(number, held)
        give_back()

    def merged(number: int, held: list[pa.Table]):
        keys = [[_order(*t) for t in _rows(rows, "key", "seconds", "page_id")] for rows in held]
        starts = np.cumsum([0] + [len(k) for k in keys])
        order = np.array([starts[r] + i for r, i in merge_runs(keys)], np.int64)
        rows = pa.concat_tables(held).select(_NAMES).take(pa.array(order)).combine_chunks()
        rank = pa.array(first_rank[number] + np.arange(len(order)))
        yield from rows.append_column("capture_rank", rank).to_batches()
    return run


def read_histories(spark: SparkSession, path: str, range_size: int = RANGE) -> DataFrame:
    """All captures of the archives under ``path`` in global order: CAPTURE and ``capture_rank`` (from 0, by URL key, time
    and page id)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path", "content")
    captures = cut(files.mapInArrow(_runs, CAPTURE + ", seq long"))
    total = captures.count()
    n_ranges = max(-(-total // range_size), 1)
    share = min(SAMPLES * n_ranges / max(total, 1), 1.0)  # of all captures: bounds are balanced, not exact
    sample = sorted(_order(*r) for r in captures.select("key", "seconds", "page_id").sample(share, seed=1).collect()) \
        if n_ranges > 1 else []
    bounds = [sample[len(sample) * i // n_ranges] for i in range(1, n_ranges)] if sample else []
    dealt = captures.mapInArrow(_deal(bounds), "range int, " + CAPTURE + ", seq long") if bounds \
        else captures.select(F.lit(0).alias("range"), "*")
    sizes = dict(dealt.groupBy("range").agg(F.count("*")).collect())  # one number for each range
    first, rank = 0, {}
    for number in sorted(sizes):
        rank[number] = first
        first += sizes[number]
    return dealt.select("range", F.col("file").alias("run"), *_NAMES, "seq") \
        .repartitionById(len(bounds) + 1, F.col("range")).sortWithinPartitions("range", "run", "seq").drop("seq") \
        .mapInArrow(_merge(rank), CAPTURE + ", capture_rank long")


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", seconds=None,
                  path: str | None = None) -> DataFrame:
    """Write ``pages`` as WARC files (under ``path``, or a new folder of the shared checkpoint folder) and read them back."""
    path = path or work_dir(pages.sparkSession, "warc")
    write_archives(pages, path, id_col, url_col, payload_col, seconds)
    return read_histories(pages.sparkSession, path)
