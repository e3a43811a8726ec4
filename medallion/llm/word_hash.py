"""Words of whole texts as 64-bit hashes, computed with numpy over many texts at once; packed integers; and texts
dealt into groups that travel compressed.

A word is a run of bytes other than blank and 0x09-0x0D; A-Z are lower-cased.  A word's hash is a polynomial in
its bytes (each mapped to a random odd number) followed by a 64-bit mix; equal words have equal hashes, different
ones differ but for a chance of about 2^-60.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from medallion.llm.common import give_back

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BLOCK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_POWERS = np.ones(1, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit integers that spreads every bit."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.full(2 * n, _BASE, np.uint64)
        _POWERS[0] = 1
        _POWERS = np.cumprod(_POWERS, dtype=np.uint64)
    return _POWERS


def _hash_block(raw: bytes):
    """Hashes of the words in ``raw`` and where each word begins."""
    b = np.frombuffer(raw.translate(LOWER), np.uint8)
    edge = np.diff(np.concatenate(([0], (~_BLANK[b]).view(np.int8), [0])))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(begins):
        return np.zeros(0, np.uint64), begins
    lengths = ends - begins
    skipped = begins[0]
    b, begins = b[skipped:], begins - skipped
    inside = np.arange(len(b)) - np.repeat(begins, np.diff(begins, append=len(b)))
    value = _BYTE[b] * _powers(int(inside.max()) + 1)[inside]
    value[_BLANK[b]] = 0
    return mix(np.add.reduceat(value, begins) + lengths.astype(np.uint64)), skipped + begins


def _chunks(raw: bytes):
    """A long text in blocks that end between words."""
    at = 0
    while len(raw) - at > BLOCK_BYTES:
        end = at + BLOCK_BYTES
        while end < len(raw) and not _BLANK[raw[end]]:
            end += 1
        yield raw[at:end]
        at = end
    yield raw[at:]


def word_hashes(texts: list[bytes]):
    """All texts' word hashes in one array, and the number of words of each text."""
    counts, out, held, size = np.zeros(len(texts), np.int64), [], [], 0

    def flush():
        nonlocal held, size
        if not held:
            return
        ends = np.cumsum([len(t) + 1 for _, t in held])
        hashes, begins = _hash_block(b"\n".join(t for _, t in held) + b"\n")
        np.add.at(counts, np.array([i for i, _ in held])[np.searchsorted(ends, begins, side="right")], 1)
        out.append(hashes)
        held, size = [], 0

    for i, text in enumerate(texts):
        for part in _chunks(text):
            held.append((i, part))
            size += len(part)
            if size >= BLOCK_BYTES:
                flush()
    flush()
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), counts


def pack(values: np.ndarray, width: int) -> bytes:
    """Unsigned integers of at most ``width`` bytes, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").reshape(-1).astype(np.uint64)


def deltas(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=np.uint64(0))


# ---------------------------------------------------------------------------------------------- groups of texts
def _squeeze(batches):
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts = batch.column(at).cast(pa.binary()).to_pylist()
        squeeze = zstandard.ZstdCompressor(level=1).compress
        columns = list(batch.columns)
        columns[at] = pa.array([squeeze(t) for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
    give_back()


def deal(rows: DataFrame, groups: int) -> DataFrame:
    """``rows`` (doc_id, text and other columns) with the group ``g`` and ``text_hash``, the text compressed for the
    shuffle that follows."""
    marked = rows.withColumn("text_hash", F.xxhash64("text")) \
        .withColumn("g", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(groups)))
    schema = StructType([StructField("text", BinaryType()) if f.name == "text" else f for f in marked.schema.fields])
    return marked.mapInArrow(_squeeze, schema)


def in_order(docs: pa.Table) -> pa.Table:
    """A group's documents in the same order whenever they are read."""
    return docs.sort_by([("doc_id", "ascending"), ("text_hash", "ascending")])


def texts_of(docs: pa.Table) -> list[bytes]:
    expand = zstandard.ZstdDecompressor().decompress
    return [expand(t) for t in docs.column("text").to_pylist()]
