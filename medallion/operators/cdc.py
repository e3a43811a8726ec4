"""Change data capture: SCD type 1 and 2, change feed, snapshot diff, consistency check.

Sequences are structs compared field by field (file order, then order inside the file).  Equal sequences
are broken by a stable row hash; a NULL sequence field raises inside the job.

SCD 1 is one declarative aggregate (``max_by(row, sequence)``) — partial-aggregated map-side, so a hot key
costs nothing extra.  SCD 2 needs the previous and the next row of a key; rather than a window over the whole key
(one task per key), it is a segmented scan: windows by (key, segment of the sorted whole, see ``segments.py``), then
the versions at the ends of a key's pieces, two for each piece, are put together across the bounds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.functions.columns import distinct_from, quote_ident
from medallion.operators.segments import Segments

START_AT = "__START_AT"
END_AT = "__END_AT"


def _q(c: str) -> Column:
    return F.col(quote_ident(c))


def _checked_sequence(sequence: list[str]) -> Column:
    """The sequence struct; a NULL field fails the job (a NULL sequence cannot be ordered)."""
    seq = F.struct(*[_q(s).alias(s) for s in sequence])
    null = reduce(lambda a, b: a | b, [_q(s).isNull() for s in sequence])
    return F.when(null, F.raise_error(F.lit("CDC: NULL value in the sequence columns " + ", ".join(sequence))))\
        .otherwise(seq)


def _order(df: DataFrame, sequence: list[str]) -> Column:
    return F.struct(_checked_sequence(sequence).alias("s"),
                    F.xxhash64(*[_q(c) for c in df.columns]).alias("h"))


def scd1(df: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """Current state: per key the row with the greatest sequence (C1, C3, T7 — arrival order is irrelevant)."""
    row = F.struct(*[_q(c) for c in df.columns])
    return (df.groupBy(*[_q(k) for k in keys])
            .agg(F.max_by(row, _order(df, sequence)).alias("__r"))
            .select("__r.*"))


def scd2(df: DataFrame, keys: list[str], sequence: list[str], tracked: list[str],
         start_col: str = START_AT, end_col: str = END_AT, strategy: str = "segments",
         segments: int | None = None, near: DataFrame | None = None) -> DataFrame:
    """History (C2): a new version starts where a tracked column IS DISTINCT FROM the previous row's.

    Each version carries the values of its last row (untracked changes update the version in place),
    ``__START_AT`` = sequence of its first row, ``__END_AT`` = the next version's start (NULL if open).
    A→B→A gives three versions; in-day corrections give short versions that are kept.  A NULL key is a key.

    ``strategy`` is the caller's choice and never changes a row: ``segments`` (default) spreads a hot key over all
    tasks whatever the type of its sequence, ``window`` saves the sample and sorts a key's rows in one task - for inputs
    whose keys are known to have few rows, such as a micro-batch with one open version for each key.  ``near``: a frame
    with the keys and the sequence whose rows lie like those of ``df``, such as the stored table that ``df`` is a part of;
    segments are then cut by it, which spares two evaluations of ``df``.
    """
    if strategy not in ("segments", "window"):
        raise ValueError(f"scd2: strategy {strategy!r}; choose 'segments' or 'window'")
    if strategy == "window":
        return scd2_window(df, keys, sequence, tracked, start_col, end_col)
    return scd2_segments(df, keys, sequence, tracked, start_col, end_col, segments, near)


def scd2_segments(df: DataFrame, keys: list[str], sequence: list[str], tracked: list[str], start_col: str = START_AT,
                  end_col: str = END_AT, segments: int | None = None, near: DataFrame | None = None) -> DataFrame:
    """A segmented scan: one shuffle of the rows by (key, segment), one of the versions.

    The keys travel as one struct: structs compare with NULL fields equal.  Identical rows differ in their row id alone,
    so even they are cut into segments; which of them comes first changes no version."""
    x = df.select("*", F.struct(*[_q(k) for k in keys]).alias("__k"),
                  F.struct(_order(df, sequence).alias("o"), F.monotonically_increasing_id().alias("i")).alias("__o"))
    if near is not None:
        first = F.struct(F.struct(*[_q(s).alias(s) for s in sequence]).alias("s"), F.lit(0).cast("long").alias("h"))
        near = near.select(F.struct(*[_q(k) for k in keys]).alias("__k"),
                           F.struct(first.alias("o"), F.lit(0).cast("long").alias("i")).alias("__o"))
    x = Segments(x, "__k", "__o", segments, near).place(x, "__p", "__x")

    # versions within a piece (key, segment): the row before decides where one starts, the row after where it ends
    piece = Window.partitionBy("__k", "__p").orderBy("__o")
    so_far = piece.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seq = F.col("__o.o.s")
    changed = F.lag("__o").over(piece).isNull()
    for t in tracked:
        changed = changed | distinct_from(_q(t), F.lag(_q(t)).over(piece))
    x = x.withColumn("__new", changed)
    start = F.last(F.when(F.col("__new"), seq), ignorenulls=True)
    x = x.select("*", start.over(so_far).alias("__start"), F.lead(seq).over(piece).alias("__end"),
                 F.lead("__new").over(piece).alias("__next"), F.sum(F.col("__new").cast("long")).over(so_far).alias("__n"))
    versions = x.where(F.coalesce("__next", F.lit(True)))

    # a key's pieces meet: their first and last versions, in order, are one window of two rows for each bound
    at_end = F.col("__x") & ((F.col("__n") == 1) | F.col("__end").isNull())
    versions = versions.withColumn("__q", F.when(at_end, -1).otherwise(F.col("__p")))
    ends = Window.partitionBy("__k", "__q").orderBy("__p", "__n")
    same = (F.col("__q") == -1) & (F.lag("__p").over(ends) < F.col("__p"))
    for t in tracked:
        same = same & ~distinct_from(_q(t), F.lag(_q(t)).over(ends))
    versions = versions.withColumn("__new", ~F.coalesce(same, F.lit(False)))
    whole = F.last(F.when(F.col("__new"), F.col("__start")), ignorenulls=True) \
        .over(ends.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.when(F.col("__q") == -1, F.lead("__start").over(ends))
    versions = versions.select("*", whole.alias("__first"), F.coalesce("__end", after).alias("__last"),
                               F.lead("__new").over(ends).alias("__follows"))
    return versions.where(F.coalesce("__follows", F.lit(True))) \
        .select(*[_q(c) for c in df.columns], F.col("__first").alias(start_col), F.col("__last").alias(end_col))


def scd2_window(df: DataFrame, keys: list[str], sequence: list[str], tracked: list[str],
                start_col: str = START_AT, end_col: str = END_AT) -> DataFrame:
    """One shuffle on the key; lag, running sum and lead inside each key."""
    orig = list(df.columns)
    kq = [_q(k) for k in keys]
    w = Window.partitionBy(*kq).orderBy("__o")
    x = df.withColumn("__o", _order(df, sequence))
    changed = F.lag("__o").over(w).isNull()
    for t in tracked:
        changed = changed | distinct_from(_q(t), F.lag(_q(t)).over(w))
    x = x.withColumn("__chg", changed.cast("long"))
    x = x.withColumn("__isl", F.sum("__chg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    isl = (x.groupBy(*kq, "__isl")
           .agg(F.min("__o").getField("s").alias("__start"),
                F.max_by(F.struct(*[_q(c) for c in orig]), F.col("__o")).alias("__row")))
    wi = Window.partitionBy(*kq).orderBy("__isl")
    isl = isl.withColumn("__end", F.lead("__start").over(wi))
    return isl.select(*[F.col("__row." + quote_ident(c)).alias(c) for c in orig],
                      F.col("__start").alias(start_col), F.col("__end").alias(end_col))


def current_versions(history: DataFrame, end_col: str = END_AT) -> DataFrame:
    """Open versions of an SCD 2 table."""
    return history.where(F.col(end_col).isNull())


def multi_version_keys(history: DataFrame, keys: list[str], min_versions: int = 2) -> DataFrame:
    """Keys with at least ``min_versions`` versions (C6, HAVING)."""
    return (history.groupBy(*[_q(k) for k in keys]).agg(F.count(F.lit(1)).alias("versions"))
            .where(F.col("versions") >= min_versions))


def change_feed(before: DataFrame, after: DataFrame, keys: list[str],
                change_col: str = "_change_type") -> DataFrame:
    """Row-level changes between two snapshots of a keyed table.

    One full outer join; each joined pair is exploded into at most two rows: ``insert``, ``delete``,
    or ``update_preimage`` + ``update_postimage`` when any non-key column IS DISTINCT FROM.
    """
    cols = list(after.columns)
    non_key = [c for c in cols if c not in keys]
    b = before.select(*[_q(c).alias(f"b_{i}") for i, c in enumerate(cols)], F.lit(True).alias("__inb"))
    a = after.select(*[_q(c).alias(f"a_{i}") for i, c in enumerate(cols)], F.lit(True).alias("__ina"))
    cond = [F.col(f"b_{cols.index(k)}").eqNullSafe(F.col(f"a_{cols.index(k)}")) for k in keys]
    j = b.join(a, cond, "full_outer")
    differs = F.lit(False)
    for c in non_key:
        i = cols.index(c)
        differs = differs | distinct_from(F.col(f"b_{i}"), F.col(f"a_{i}"))
    inb, ina = F.col("__inb").isNotNull(), F.col("__ina").isNotNull()
    pre = F.struct(*[F.col(f"b_{i}").alias(c) for i, c in enumerate(cols)],
                   F.when(ina, F.lit("update_preimage")).otherwise(F.lit("delete")).alias(change_col))
    post = F.struct(*[F.col(f"a_{i}").alias(c) for i, c in enumerate(cols)],
                    F.when(inb, F.lit("update_postimage")).otherwise(F.lit("insert")).alias(change_col))
    changes = F.array(
        F.when(inb & (~ina | differs), pre),
        F.when(ina & (~inb | differs), post),
    )
    return (j.where(~(inb & ina) | differs)
            .select(F.explode(changes).alias("__c"))
            .where(F.col("__c").isNotNull())
            .select("__c.*"))


def count_differences(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str],
                      null_safe: bool = False) -> DataFrame:
    """Number of keys present in both whose values differ (``<>``, or IS DISTINCT FROM)."""
    l = left.select(*[_q(k) for k in keys], *[_q(c).alias(f"l_{c}") for c in columns])
    r = right.select(*[_q(k) for k in keys], *[_q(c).alias(f"r_{c}") for c in columns])
    j = l.join(r, keys)
    diff = F.lit(False)
    for c in columns:
        d = distinct_from(F.col(f"l_{c}"), F.col(f"r_{c}")) if null_safe else (F.col(f"l_{c}") != F.col(f"r_{c}"))
        diff = diff | F.coalesce(d, F.lit(False))
    return j.agg(F.count_if(diff).alias("differences"))


def changes_from_snapshots(snapshots: list[tuple[int, DataFrame]], keys: list[str],
                           version_col: str = "_snapshot_version") -> DataFrame:
    """CDC from snapshots (C7): the change feed between each pair of consecutive snapshots, tagged with the
    later snapshot's version — input for ``scd1``/``scd2`` with ``version_col`` as the sequence."""
    ordered = sorted(snapshots, key=lambda s: s[0])
    parts = [change_feed(before, after, keys).withColumn(version_col, F.lit(v))
             for (_, before), (v, after) in zip(ordered, ordered[1:])]
    first_v, first = ordered[0]
    parts.insert(0, first.withColumn("_change_type", F.lit("insert")).withColumn(version_col, F.lit(first_v)))
    return reduce(lambda a, b: a.unionByName(b), parts)
