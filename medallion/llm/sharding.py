"""Balanced sharding: minimax contiguous partition of ordered atomic groups.

Rows with equal text form one atomic group (never split over shards).  Groups are ordered by a 64-bit hash of
their text; shards are contiguous runs of groups.  The smallest feasible capacity (largest shard's bytes) is
found by binary search, each candidate checked greedily, and the order is cut there.

The driver never sees the groups.  It sees sums over hash intervals - ``2 ** FIRST_BITS`` at first - and searches
twice: with every interval unsplittable (an upper bound) and with intervals of several groups freely divisible
(a lower bound).  Where the two differ, only the intervals that a cut can fall in are summed again, ``2 ** STEP``
times finer, until both agree: then the cuts are exact at group level.  Each step is one pre-combined aggregation
and at most a few tens of thousands of rows on the driver, at any size of input.

A group larger than an even share is a shard's floor: it stays whole, as equal texts must stay together.  Slots
inside a shard come from counts per (shard, hash of doc_id) cell, so the shard with a giant group is numbered by
many tasks.  Null text counts as empty.  Null ids, repeated ids and repeated rows are kept, a slot each.  Texts of any
length count whole.  Ties: groups are ordered by a hash of their text, and of several smallest capacities' partitions the
greedy one is taken.  An empty table gives no rows.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import cut

KEY_BITS, FIRST_BITS, STEP, CELLS = 63, 14, 6, 512


def greedy_cuts(ends: list[int], shards: int, capacity: int) -> list[int] | None:
    """Index after each shard's last atom when filled greedily up to ``capacity``; None if they don't fit.
    ``ends`` are running totals of the atoms' sizes."""
    cuts, at, base = [], 0, 0
    for _ in range(shards):
        at = bisect_right(ends, base + capacity, at)
        cuts.append(at)
        base = ends[at - 1] if at else 0
    return cuts if at == len(ends) else None


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """The least capacity for which ``greedy_cuts`` fits all atoms into ``shards`` runs."""
    ends = list(accumulate(sizes))
    if not ends:
        return 0
    low, high = max(max(sizes), -(-ends[-1] // shards)), ends[-1]
    while low < high:
        mid = (low + high) // 2
        if greedy_cuts(ends, shards, mid) is None:
            low = mid + 1
        else:
            high = mid
    return low


def _fluid_cuts(atoms: list[tuple], shards: int, capacity: int) -> list[float] | None:
    """Like greedy_cuts where an atom of several groups may be divided anywhere: positions as atom index, with a
    fraction inside a divided atom; None if the atoms don't fit."""
    cuts, i, rest = [], 0, atoms[0][2] if atoms else 0
    for _ in range(shards):
        room = capacity
        while i < len(atoms) and rest <= room:
            room -= rest
            i += 1
            rest = atoms[i][2] if i < len(atoms) else 0
        if i < len(atoms) and atoms[i][3] > 1 and room:
            rest -= room
            cuts.append(i + 0.5)
        else:
            cuts.append(i)
    return cuts if i >= len(atoms) else None


def _fluid_capacity(atoms: list[tuple], shards: int, high: int) -> int:
    low = max([-(-sum(a[2] for a in atoms) // shards)] + [a[2] for a in atoms if a[3] == 1])
    while low < high:
        mid = (low + high) // 2
        if _fluid_cuts(atoms, shards, mid) is None:
            low = mid + 1
        else:
            high = mid
    return low


def _interval_sums(groups: DataFrame, bits: int, within: list[tuple] | None) -> list[tuple]:
    """(start, bits, bytes, number of groups) of the key intervals of 2**(KEY_BITS - bits) keys, in order."""
    start = F.shiftleft(F.shiftright("key", KEY_BITS - bits), KEY_BITS - bits)
    rows = groups
    if within is not None:
        wide = [a[0] for a in within]
        shift = KEY_BITS - within[0][1]
        rows = rows.where(F.shiftleft(F.shiftright("key", shift), shift).isin(wide))
    out = rows.groupBy(start.alias("start")).agg(F.sum("bytes"), F.count("*")).collect()
    return sorted((r[0], bits, int(r[1]), int(r[2])) for r in out)


def boundaries(groups: DataFrame, shards: int) -> list[int]:
    """Keys at which the shards 1 .. shards-1 begin, for ``groups`` (key long >= 0, bytes long)."""
    atoms = _interval_sums(groups, FIRST_BITS, None)
    while True:
        upper = smallest_capacity([a[2] for a in atoms], shards)
        lower = _fluid_capacity(atoms, shards, upper)
        ends = list(accumulate(a[2] for a in atoms))
        best = greedy_cuts(ends, shards, upper) or []
        # a cut for any capacity between the bounds lies between the two bounds' own cuts
        split = set()
        if lower < upper:
            for x, y in zip(_fluid_cuts(atoms, shards, lower), best):
                split.update(i for i in range(int(x), min(int(y), len(atoms) - 1) + 1) if atoms[i][3] > 1)
        if not split:
            return [atoms[i][0] if i < len(atoms) else (1 << KEY_BITS) - 1 for i in best[:shards - 1]]
        # one job for each width among the intervals to split (the widths are few: one for each step so far)
        finer = {}
        for bits in {atoms[i][1] for i in split}:
            to = min(bits + STEP, KEY_BITS)
            mask = ~((1 << (KEY_BITS - bits)) - 1)
            for s in _interval_sums(groups, to, [atoms[i] for i in split if atoms[i][1] == bits]):
                finer.setdefault((s[0] & mask, bits), []).append(s)
        atoms = [x for i, a in enumerate(atoms) for x in (finer[(a[0], a[1])] if i in split else [a])]


def shard_by_bytes(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                   overhead: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row for each input row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = cut(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + overhead).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 64 - KEY_BITS).alias("key")))
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    starts = boundaries(groups, shards)
    # the number of starts at or below the key: a binary search written as one expression
    def place(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col("key") < F.lit(starts[mid]), place(lo, mid)).otherwise(place(mid + 1, hi))

    placed = rows.withColumn("shard", place(0, len(starts)).cast("int")) \
        .withColumn("cell", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(CELLS)).cast("int"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    # at most shards * CELLS rows, whatever the input
    offsets = placed.groupBy("shard", "cell").agg(F.count("*").alias("n")) \
        .select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "cell").orderBy("doc_id", "key")
    return placed.withColumn("nr", F.row_number().over(inside)) \
        .join(F.broadcast(offsets), ["shard", "cell"]) \
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                (F.col("base") + F.col("nr") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
