"""Best-fit packing of tokenised documents by a grouping genetic algorithm on migrating islands.

Every document becomes its token ids plus an end id.  Only documents longer than ``capacity`` are cut, into
pieces of ``capacity`` ids of which the first may be shorter.  Whole pieces are a sequence each; the others are
packed.  They are dealt by hash into shards of about ``shard_items`` pieces, so a task's work is bounded at any
size of input; each shard is evolved on several islands:

* an individual is a set of bins; the first ones come from best-fit with a decreasing and shuffled orders;
* crossover injects whole well-filled bins of one parent into another, drops the other's bins that share an item
  with them, and best-fits the displaced pieces, largest first;
* before displaced pieces are best-fitted, they change places with pieces of bins that have room, so that those bins get
  fuller and what is loose gets smaller; mutation empties the least filled bins and a few others with room;
* after an epoch each island's elite migrates to the next island of its shard (a shuffle), until every shard has
  reached its lower bound or the epochs are over; a shard that gained nothing on best-fit in an epoch is left as it is.

The least filled eighth of every shard's bins is then packed again together with that of the other shards, level
by level, so that what is left over is one bin in all and not some for each shard.

Tokenising is the bulk of the work: the distinct words of each block of texts are encoded together.  Its result (a row for each piece, no text) is checkpointed, so a lost executor never costs it twice.

Defined results: null or empty text is the end id alone; repeated documents are packed once for each row; null
ids are kept; an empty table gives no rows.  Texts of any length are encoded whole and cut into pieces only.  Ties: pieces
of one length go in the order of their rows, and of individuals with equally many bins that of the first island is
taken; any of them is as short.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right, insort
from itertools import chain
from random import Random

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import cut, give_back, vocabulary_copy

CAPACITY, END_ID, SHARD_ITEMS = 1024, 2, 2048
ISLANDS, POPULATION, GENERATIONS, MUTATIONS, EPOCHS, LEFT_SHARE = 3, 6, 12, 24, 3, 8
TRIED = 60  # bins with room that a mutation looks at
MOST = 1 << 62
BLOCK_BYTES = 1 << 23  # text whose distinct words are encoded together

# The word pattern of the byte-level tokenizer (README of the public tokenizers, PATTERN).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# ---------------------------------------------------------------------------------------------- tokens
def byte_ranks(tokenizer_json: str) -> dict[bytes, int]:
    """The vocabulary of a byte-level BPE file as bytes → id.  Printable bytes stand for themselves there, the
    others for the characters from 256 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    chars = {chr(b): b for b in shown}
    chars |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    model = json.loads(tokenizer_json)
    special = {t["content"] for t in model.get("added_tokens", [])}
    return {bytes(chars[c] for c in word): i for word, i in model["model"]["vocab"].items() if word not in special}


def in_blocks(rows: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """``rows`` in consecutive blocks of about ``BLOCK_BYTES`` by their ``sizes``."""
    return np.split(rows, np.flatnonzero(np.diff(np.cumsum(sizes) // BLOCK_BYTES)) + 1)


class WordEncoder:
    """Token ids of many texts at once, as unsigned 32-bit integers.

    Words (with the blank before them) are told apart by Arrow, each distinct word of a block of texts is encoded once,
    all of them in one call, and the texts' ids are gathered from the words': the tokenizer's own pattern never lets a
    token cross from a visible character to a blank or line feed.  Texts with other than single blanks and line feeds
    between visible characters are encoded whole.
    """

    # White space besides blank and line feed, control characters, and two of them in a row.
    unusual = ("[ \\n][ \\n]|[\\x00-\\x09\\x0b-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}"
               "\\x{205f}\\x{3000}]")

    def __init__(self, tokenizer_json: str):
        import tiktoken

        self.bpe = tiktoken.Encoding("words", pat_str=WORD_PATTERN, mergeable_ranks=byte_ranks(tokenizer_json),
                                     special_tokens={})
        self.line_feed = self.bpe.encode_ordinary("\n")[0]

    def _words(self, words: pa.Array) -> pa.ListArray:
        """The ids of each of ``words``, which differ.  A line feed between two words is one token of its own, so that all
        words are encoded in one call and parted again there."""
        alone = pc.is_in(words, pa.array(["", " ", "\n"]))  # three words at most that don't part so
        plain = words.filter(pc.invert(alone))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(plain)], pa.int32()), plain), "\n")[0].as_py()
        ids = np.array(self.bpe.encode_ordinary(joined), np.uint32)
        feeds = np.flatnonzero(ids == self.line_feed)
        own = [self.bpe.encode_ordinary(w) for w in words.filter(alone).to_pylist()]
        counts = np.diff(feeds, prepend=-1, append=len(ids)) - 1 if len(plain) else np.zeros(0, np.int64)
        counts = np.concatenate([counts, [len(o) for o in own]])
        values = np.concatenate([np.delete(ids, feeds), *[np.array(o, np.uint32) for o in own]])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values))
        if not own:
            return lists
        alone = alone.to_numpy(zero_copy_only=False)
        return lists.take(pa.array(np.argsort(np.concatenate([np.flatnonzero(~alone), np.flatnonzero(alone)]))))

    def _usual(self, texts: pa.Array) -> list[np.ndarray]:
        # each copy of the block goes as soon as the next one is there
        split = pc.split_pattern(pc.replace_substring(pc.replace_substring(texts, "\n", "\0\n\0"), " ", "\0 "), "\0")
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        words = split.flatten()
        del split
        words = words.dictionary_encode()
        found = self._words(words.dictionary).take(words.indices)
        del words
        at = found.offsets.to_numpy()[bounds]
        return np.split(found.flatten().to_numpy(), at[1:-1])

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text (none for null)."""
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, self.unusual)
        out: list = [None] * len(texts)
        for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)):
            out[i] = np.array(self.bpe.encode_ordinary(texts[int(i)].as_py()), np.uint32)
        usual = np.flatnonzero(~whole.to_numpy(zero_copy_only=False))
        sizes = pc.binary_length(texts).to_numpy()[usual]
        for part in in_blocks(usual, sizes):
            if len(part):
                for i, ids in zip(part, self._usual(texts if len(part) == len(texts) else texts.take(pa.array(part)))):
                    out[i] = ids
        return out

    def __call__(self, text: str) -> list[int]:
        return self.encode(pa.array([text]))[0].tolist()


_ENCODERS: dict = {}


def pieces_of(ids: bytes, capacity: int):
    """(piece, start, length, crc32) of a document's ids; only the first piece may be shorter than capacity."""
    n = len(ids) // 4
    first = n % capacity
    starts = ([0] if first else []) + list(range(first, n, capacity))
    for i, (a, b) in enumerate(zip(starts, starts[1:] + [n])):
        yield i, a, b - a, zlib.crc32(ids[4 * a:4 * b])


def _tokenise(vocabulary, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        if "words" not in _ENCODERS:
            _ENCODERS["words"] = WordEncoder(bytes(vocabulary.value).decode())
        encoder = _ENCODERS["words"]
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            for block in in_blocks(np.arange(len(sizes)), sizes):  # no more ids are held than those of a block
                docs, texts = (c.slice(block[0] if len(block) else 0, len(block)) for c in batch.columns)
                rows = [(doc, *piece) for doc, ids in zip(docs.to_pylist(), encoder.encode(texts))
                        for piece in pieces_of(ids.astype("<u4").tobytes() + end, capacity)]
                cols = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                     *(pa.array(c, pa.int64()) for c in cols[2:])],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
        give_back()
    return run


def token_pieces(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    vocabulary = vocabulary_copy(docs.sparkSession, vocabulary_path)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(_tokenise(vocabulary, capacity, end_id),
                    "doc_id long, piece int, start long, length long, ids_crc32 long")


# ---------------------------------------------------------------------------------------------- bins
class Bins:
    """Bins with a best-fit index: for each free space the bins that have it, and a bit set of free spaces."""

    def __init__(self, capacity: int):
        self.capacity, self.items, self.free = capacity, [], []
        self.by_free: dict[int, list[int]] = {}
        self.mask, self._score = 0, None

    def _index(self, b: int):
        f = self.free[b]
        self.by_free.setdefault(f, []).append(b)
        self.mask |= 1 << f

    def add(self, items: list[int], used: int):
        self.items.append(items)
        self.free.append(self.capacity - used)
        self._index(len(self.items) - 1)

    def take_over(self, items: list[int], free: int, smallest: int):
        """A bin of another individual; only one that has room for ``smallest`` is copied and offered to ``fit``."""
        if free >= smallest:
            self.add(list(items), self.capacity - free)
        else:
            self.items.append(items)
            self.free.append(free)

    def fit(self, item: int, size: int):
        """Into the bin that it fills best; a new bin if it fits into none."""
        room = self.mask >> size
        if not room:
            self.add([item], size)
            return
        f = size + (room & -room).bit_length() - 1
        b = self.by_free[f].pop()
        if not self.by_free[f]:
            self.mask &= ~(1 << f)
        self.items[b].append(item)
        self.free[b] = f - size
        self._index(b)

    def score(self) -> tuple:
        """Fewer bins are better; among equals, fuller full bins.  To be asked when the bins are complete."""
        if self._score is None:
            self._score = -len(self.items), sum((self.capacity - f) ** 2 for f in self.free)
        return self._score


def best_fit(order, sizes, capacity: int) -> Bins:
    bins = Bins(capacity)
    for i in order:
        bins.fit(i, sizes[i])
    return bins


def crossover(a: Bins, b: Bins, sizes, rng: Random) -> Bins:
    """Inject whole well-filled bins of ``b`` into ``a``."""
    ranked = sorted(range(len(b.items)), key=b.free.__getitem__)
    take = ranked[:max(1, rng.randrange(len(ranked) // 4, len(ranked) // 2 + 1))]
    injected = set(chain.from_iterable(b.items[i] for i in take))
    whole = [injected.isdisjoint(items) for items in a.items]
    loose = [x for items, kept in zip(a.items, whole) if not kept for x in items if x not in injected]
    parts = [(b.items[i], b.free[i]) for i in take]
    parts += [(items, free) for items, free, kept in zip(a.items, a.free, whole) if kept]
    return _refit(a.capacity, parts, loose, sizes)


def mutate(a: Bins, sizes, rng: Random, steps: int = 1) -> Bins:
    """``steps`` times the least filled bin and a few others with room are emptied, their items change places with those of
    other bins with room, and what is loose is best-fitted again; a step that makes it worse is taken back."""
    capacity, items, free = a.capacity, list(a.items), list(a.free)
    for _ in range(steps):
        roomy = [b for b, f in enumerate(free) if f]
        if not roomy:
            break
        emptied = {max(roomy, key=free.__getitem__), *rng.sample(roomy, min(len(roomy), rng.randrange(1, 6)))}
        some = [b for b in rng.sample(roomy, min(len(roomy), TRIED)) if b not in emptied]
        parts, loose = replace([(items[b], free[b]) for b in some], [x for b in sorted(emptied) for x in items[b]], sizes)
        now = {b: part for b, part in zip(some, parts)}
        room = {b: free[b] for b in roomy if b not in emptied} | {b: f for b, (_, f) in now.items()}
        added = []
        for x in sorted(loose, key=lambda x: (-sizes[x], x)):
            fits = [(f, b) for b, f in room.items() if f >= sizes[x]]
            if fits:
                f, b = min(fits)
                now[b] = [*(now[b][0] if b in now else items[b]), x], f - sizes[x]
            else:
                b = -1 - len(added)
                added.append(b)
                now[b] = [x], capacity - sizes[x]
            room[b] = now[b][1]
        old = sum((capacity - free[b]) ** 2 for b in emptied | {b for b in now if b >= 0})
        new = sum((capacity - f) ** 2 for _, f in now.values())
        if (-len(added), new) < (-len(emptied), old):
            continue
        places = sorted(emptied)
        for b, (content, f) in now.items():
            if b < 0 and places:
                b = places.pop()
            if b < 0:
                items.append(content)
                free.append(f)
            else:
                items[b], free[b] = content, f
        for b in reversed(places):  # bins that are gone, the last ones first
            del items[b], free[b]
    child = Bins(capacity)
    for content, f in zip(items, free):
        child.add(content, capacity - f)
    return child


def replace(parts, loose: list[int], sizes) -> tuple[list, list[int]]:
    """Bins made fuller by loose items: in each bin with room one item, or two, give way to one loose item, or one to two
    loose ones, that leave the least room.  What is loose gets smaller with every exchange, so it fits in more easily."""
    known = sorted((sizes[x], x) for x in loose)
    out = []
    for items, free in parts:
        while free and known:
            best = None
            leaving = [(sizes[x], (x,)) for x in items]
            leaving += [(sizes[x] + sizes[y], (x, y)) for i, x in enumerate(items) for y in items[:i]]
            for size, gone in leaving:
                i = bisect_right(known, (size + free, MOST)) - 1
                if i >= 0 and known[i][0] > size and (best is None or known[i][0] - size > best[0]):
                    best = known[i][0] - size, gone, (i,)
                    if best[0] == free:
                        break
            if best is None or best[0] < free:
                for x in items:
                    limit, low, high = sizes[x] + free, 0, len(known) - 1
                    floor = sizes[x] + (best[0] if best else 0)
                    while low < high:
                        both = known[low][0] + known[high][0]
                        if both > limit:
                            high -= 1
                        else:
                            if both > floor:
                                floor, best = both, (both - sizes[x], (x,), (low, high))
                            low += 1
            if best is None:
                break
            gain, gone, come = best
            entering = [known[i][1] for i in come]
            for i in sorted(come, reverse=True):
                del known[i]
            for x in gone:
                insort(known, (sizes[x], x))
            items, free = [x for x in items if x not in gone] + entering, free - gain
        out.append((items, free))
    return out, [x for _, x in known]


def _refit(capacity: int, parts, loose: list[int], sizes) -> Bins:
    """The bins of ``parts`` (items, free space) and the loose items, best-fitted largest first."""
    child, smallest = Bins(capacity), min((sizes[i] for i in loose), default=capacity + 1)
    for items, free in parts:
        child.take_over(items, free, smallest)
    for i in sorted(loose, key=lambda x: (-sizes[x], x)):
        child.fit(i, sizes[i])
    return child


def fewest_bins(sizes: list[int], capacity: int) -> int:
    """A lower bound (Martello and Toth's second): for each limit, items too large to share a bin with an item of
    that size, items over half, and what of the others exceeds the room beside those."""
    number = np.bincount(np.array(sizes, np.int64), minlength=capacity + 1)
    count, volume = np.cumsum(number), np.cumsum(number * np.arange(capacity + 1))
    half, best = capacity // 2, -(-int(volume[-1]) // capacity)
    for limit in range(1, half + 1):
        above = int(count[-1] - count[capacity - limit])
        middle = int(count[capacity - limit] - count[half])
        room = middle * capacity - int(volume[capacity - limit] - volume[half])
        small = int(volume[half] - volume[limit - 1])
        best = max(best, above + middle + max(0, -(-(small - room) // capacity)))
    return best


def falling_order(sizes) -> list[int]:
    return sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))


def evolve(sizes: list[int], capacity: int, seed: int, immigrants: list[list[int]] = ()) -> list[int]:
    """The bin number of each item in the best individual found; ``immigrants`` are such lists."""
    n, rng = len(sizes), Random(seed)
    least, falling, people = fewest_bins(sizes, capacity), falling_order(sizes), []
    for bin_of in immigrants:
        groups: dict[int, list[int]] = {}
        for i, b in enumerate(bin_of):
            groups.setdefault(b, []).append(i)
        one = Bins(capacity)
        for items in groups.values():
            one.add(items, sum(sizes[i] for i in items))
        people.append(one)
    people.append(best_fit(falling, sizes, capacity))
    if min(len(p.items) for p in people) > least:
        while len(people) < POPULATION:  # the large ones first still, the rest in any order
            large = [i for i in falling if 2 * sizes[i] > capacity]
            small = [i for i in falling if 2 * sizes[i] <= capacity]
            rng.shuffle(small)
            people.append(best_fit(large + small, sizes, capacity))
        people.sort(key=Bins.score, reverse=True)
        for _ in range(GENERATIONS):
            if len(people[0].items) <= least:
                break
            a, b = rng.sample(people, 2)
            people += [crossover(a, b, sizes, rng), mutate(people[0], sizes, rng, MUTATIONS)]
            people = sorted(people, key=Bins.score, reverse=True)[:POPULATION]
    out = [0] * n
    for b, items in enumerate(people[0].items):
        for i in items:
            out[i] = b
    return out


# ---------------------------------------------------------------------------------------------- islands
ELITE = "shard long, island int, elite binary, bins int, least int"


def _epoch(capacity: int, epoch: int):
    def run(key, items, elites):
        shard, island = (int(k) for k in key)
        items = items.sort_values("row")
        sizes = items["length"].tolist()
        least = fewest_bins(sizes, capacity)
        elites = elites.sort_values(["bins", "island"])
        known = [np.frombuffer(e, "<i4").tolist() for e in elites["elite"]]
        if known and elites["bins"].iloc[0] >= len(best_fit(falling_order(sizes), sizes, capacity).items):
            bin_of = known[0]  # an epoch without gain is the shard's last one
        else:
            bin_of = evolve(sizes, capacity, hash((shard, island, epoch)), known)
        return pd.DataFrame({"shard": [shard], "island": [island],
                             "elite": [np.array(bin_of, "<i4").tobytes()],
                             "bins": [len(set(bin_of))], "least": [least]})
    return run


def _place(capacity: int):
    def run(key, items, elites):
        items = items.sort_values("row").reset_index(drop=True)
        best = elites.sort_values(["bins", "island"]).iloc[0]
        items["bin"] = np.frombuffer(best["elite"], "<i4").astype("int64")
        filled = items.groupby("bin")["length"].sum()
        least_filled = filled.sort_values(kind="stable").index[:max(1, len(filled) // LEFT_SHARE)]
        items["last"] = items["bin"].isin(least_filled)
        return items[["row", "shard", "length", "bin", "last"]]
    return run


def pack_shards(items: DataFrame, shards: int, capacity: int) -> DataFrame:
    """(row, shard, length, bin, last): the items (row long, length long) packed within ``shards`` shards;
    ``last`` marks the items of a shard's least filled bins."""
    spark = items.sparkSession
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    on_islands = dealt.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    elites = spark.createDataFrame([], ELITE)
    for epoch in range(EPOCHS):
        # an island meets its own elite and that of the island before it
        arrivals = elites.unionByName(elites.withColumn("island", (F.col("island") + 1) % ISLANDS))
        elites = cut(on_islands.groupBy("shard", "island").cogroup(arrivals.groupBy("shard", "island"))
                     .applyInPandas(_epoch(capacity, epoch), ELITE))
        best = elites.groupBy("shard").agg(F.min("bins").alias("bins"), F.max("least").alias("least"))
        if best.where("bins > least").isEmpty():
            break
    return cut(dealt.groupBy("shard").cogroup(elites.groupBy("shard")).applyInPandas(
        _place(capacity), "row long, shard long, length long, bin long, last boolean"))


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """``pieces`` (with a column ``length``, at most ``capacity``) plus sequence_id and offset."""
    pieces = cut(pieces.withColumn("row", F.monotonically_increasing_id()))
    rest = pieces.where(F.col("length") < capacity).select("row", "length")
    count, level, done = rest.count(), 0, []
    while count:
        shards = -(-count // shard_items)
        placed = pack_shards(rest, shards, capacity)
        final = placed if shards == 1 else placed.where(~F.col("last"))
        done.append(final.select("row", (F.lit(level << 54) + F.col("shard") * (1 << 16) + F.col("bin"))
                                 .alias("sequence_id")))
        if shards == 1:
            break
        rest, level = placed.where("last").select("row", "length"), level + 1
        count = rest.count()
    whole = pieces.where(F.col("length") >= capacity).select("row", (-1 - F.col("row")).alias("sequence_id"))
    for d in done:
        whole = whole.unionByName(d)
    before = Window.partitionBy("sequence_id").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.join(whole, "row") \
        .withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("row")


def pack_documents(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), a row for each piece."""
    return pack(token_pieces(docs, vocabulary_path, capacity, end_id, id_col, text_col), capacity)
