"""Vector code compression: product codes over integers, the nearest entries found by Walsh-Hadamard transforms.

A component x becomes the integer floor(256 x).  A vector is cut into ``parts`` equal consecutive parts; each part
position has a codebook of at most ``entries`` entries, at first those of the vectors with the smallest ids.  Each of
``rounds`` rounds gives every part to its nearest entry (squared Euclidean distance, ties to the lower index) and
replaces each entry by floor(sum / count) of its parts; an entry without parts stays.  A last assignment gives the codes.

Nearest entries: parts and entries are zero-padded to a power of two P and go through an integer Walsh-Hadamard
transform (additions only), whose rows stand in sequency order (ascending number of sign changes).  The transform
multiplies squared distances by exactly P, so squared differences of coefficients, added up coefficient by
coefficient, are P times a lower bound of the distance.  An entry goes as soon as its sum is above the whole distance
of the entry that is nearest by the first coefficient.  Everything is 64-bit integer: no rounding, ties are exact.

Plan: each round is one scan of the vectors; a task emits one row of sums for each used entry, Spark adds them up, and
the driver sees ``parts * entries`` rows, a bound that doesn't grow with the data.  No vector is shuffled.  The last
assignment is written to the shared checkpoint folder; sums by label are added before the shuffle, and labels with
more than a ``HEAVY``-th of the rows (fewer than ``HEAVY`` by counting) meet their rows by broadcast, so no label
gathers its rows in a task.

Defined results: vectors that are null or hold null or non-finite components go.  Equal ids: the order is by id, nulls
last, then by components.  Vectors shorter than the longest, and a length that ``parts`` doesn't divide, count as
filled up with zeros at the end.  Fewer vectors than ``entries`` give smaller codebooks.  Repeated rows are coded one
by one.  Components so large that sums could pass 64 bits stop the job with an error instead of a wrong result.  An
empty table gives no rows.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import cut, sums_beside

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
ROWS = 4096  # vectors that a task holds in one numpy block


def walsh(x: np.ndarray) -> np.ndarray:
    """Integer Walsh-Hadamard transform of the last axis (a power of two), coefficients in sequency order."""
    size, shape, h = x.shape[-1], x.shape, 1
    while h < size:
        halves = x.reshape(*shape[:-1], size // (2 * h), 2, h)
        a, b = halves[..., 0, :], halves[..., 1, :]
        x = np.stack([a + b, a - b], -2).reshape(shape)
        h *= 2
    return x[..., sequency(size)]


def sequency(size: int) -> np.ndarray:
    """Rows of the Hadamard matrix of ``size`` by ascending number of sign changes."""
    i = np.arange(size)
    signs = np.array([[bin(a & b).count("1") & 1 for b in i] for a in i])
    return np.argsort((np.diff(signs, axis=1) != 0).sum(1), kind="stable")


def nearest(x: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` the index of the nearest row of ``codebook`` and the squared distance, in integers."""
    size = 1 << max(x.shape[1] - 1, 0).bit_length()
    room = [(0, 0), (0, size - x.shape[1])]
    tx, tc = walsh(np.pad(x, room)), walsh(np.pad(codebook, room))
    first = tx[:, :1] - tc[None, :, 0]
    first *= first
    guess = first.argmin(1)
    limit = ((tx - tc[guess]) ** 2).sum(1)  # the whole distance of the entry nearest by the first coefficient
    row, entry = np.nonzero(first <= limit[:, None])
    total = first[row, entry]
    for k in range(1, size):
        total = total + (tx[row, k] - tc[entry, k]) ** 2
        stay = total <= limit[row]
        if not stay.all():
            row, entry, total = row[stay], entry[stay], total[stay]
    begins = np.flatnonzero(np.diff(row, prepend=-1))  # at least the guess stays for each row
    least = np.minimum.reduceat(total, begins) if len(begins) else total
    best = np.flatnonzero(total == np.repeat(least, np.diff(begins, append=len(row))))
    pick = best[np.flatnonzero(np.diff(row[best], prepend=-1))]  # entries ascend within a row: the lowest index
    return entry[pick], least // size


def _whole(vectors: pa.Array, width: int, limit: int) -> np.ndarray:
    """Rows as integers, filled up with zeros to ``width``."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if len(flat) and np.abs(flat).max() > limit:
        raise ValueError(f"vector components beyond {limit // SCALE} don't fit exact 64-bit distances")
    out = np.zeros((len(lengths), width), np.int64)
    if len(lengths) and (lengths == lengths[0]).all():
        out[:, :lengths[0]] = flat.reshape(len(lengths), -1)
        return out
    at = np.repeat(np.arange(len(lengths)), lengths)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


class _Coder:
    """What tasks need: codebooks (parts x entries x part width) and the form of the vectors."""

    def __init__(self, books: np.ndarray):
        self.books, self.width = books, books.shape[0] * books.shape[2]
        size = 1 << max(books.shape[2] - 1, 0).bit_length()
        # size * (sum over a vector of squared differences of at most 2 * limit) stays below 2^62
        self.limit = int(np.sqrt((1 << 60) // (size * max(self.width, 1))))

    def blocks(self, batch: pa.RecordBatch):
        for at in range(0, batch.num_rows, ROWS):
            rows = batch.slice(at, ROWS)
            vectors = _whole(rows.column("v"), self.width, self.limit).reshape(rows.num_rows, *self.books.shape[::2])
            yield rows, vectors, [nearest(vectors[:, p], self.books[p]) for p in range(len(self.books))]

    def sums(self, batches):
        """A task's sums and counts of the parts of each entry."""
        total, count = np.zeros(self.books.shape, np.int64), np.zeros(self.books.shape[:2], np.int64)
        for batch in batches:
            for _, vectors, found in self.blocks(batch):
                for p, (entry, _) in enumerate(found):
                    order = np.argsort(entry, kind="stable")
                    used, begins, n = np.unique(entry[order], return_index=True, return_counts=True)
                    total[p, used] += np.add.reduceat(vectors[order, p], begins)
                    count[p, used] += n
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]),
             pa.array(list(total[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "total"])

    def codes(self, batches):
        for batch in batches:
            for rows, _, found in self.blocks(batch):
                code = np.stack([e for e, _ in found], 1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("vec_id"), rows.column("label"), pa.array([c.tobytes().hex() for c in code], pa.string()),
                     pa.array(sum(d for _, d in found))], names=["vec_id", "label", "code", "error"])


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v) of the vectors that can be coded."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return vectors.where(F.coalesce(fine, F.lit(False))) \
        .select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), v.alias("v"))


def first_books(rows: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """The parts of the vectors with the smallest ids; None for an empty table."""
    longest = rows.agg(F.max(F.size("v")).alias("n")).first().n
    if longest is None:
        return None
    width = max(-(-longest // parts), 1)
    first = rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    whole = _whole(pa.array([r.v for r in first], pa.list_(pa.float64())), parts * width, (1 << 53) - 1)
    return np.ascontiguousarray(whole.reshape(len(first), parts, width).transpose(1, 0, 2))


def next_books(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every part to its nearest entry, every used entry to floor(sum / count) of its parts."""
    width = books.shape[2]
    sums = rows.mapInArrow(_Coder(books).sums, "part int, entry int, n long, total array<long>") \
        .groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(width)])
                                      .alias("total"))
    books = books.copy()
    for r in sums.collect():  # at most parts * entries rows
        books[r.part, r.entry] = [t // r.n for t in r.total]
    return books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error, label_error), one row for each vector that can be coded, and the codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte for each part: 1 to 256 entries")
    rows = kept_vectors(vectors, id_col, vector_col, label_col)
    books = first_books(rows, parts, entries)
    if books is None:
        empty = rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                            F.lit(0).cast("long").alias("label_error")).where("false")
        return empty, np.zeros((parts, 0, 0), np.int64)
    for _ in range(rounds):
        books = next_books(rows, books)
    label = rows.schema["label"].dataType.simpleString()
    coded = cut(rows.mapInArrow(_Coder(books).codes, f"vec_id long, label {label}, code string, error long"))
    return sums_beside(coded, "label", "error", "label_error"), books


def decode(code: str, books: np.ndarray) -> np.ndarray:
    """The integers that a code stands for."""
    return np.concatenate([books[p, e] for p, e in enumerate(bytes.fromhex(code))])
