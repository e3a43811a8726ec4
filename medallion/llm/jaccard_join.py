"""N-gram Jaccard join with prefix trees: documents whose sets of word n-grams are similar, and their groups.

A document's set is its distinct ``size``-word shingles (the whole sequence if it has fewer words).  Two documents
link when 100 * |intersection| >= percent * |union|.  The result is exact but for hash collisions (below 1e-8 for
a pair): no sampling, no candidate cap.

1. Document frequencies.  Documents are dealt into groups of about 8 MB of text.  A group asks once for each of
   its distinct shingles; the request goes to the shingle's hash bucket, where the groups' counts are summed, and
   the sums come back in the order of the request.  A shingle of a third of all documents is one entry for each
   group.  A shingle of one document can never be shared: it is dropped, but counts in the set's size.  A set with
   fewer shared shingles than any link needs is done.
2. Equal sets become one class.
3. Sets are sequences in one global order, rare shingles first.  Two sets that link share a shingle in their
   prefixes (the first |shared| - ceil(percent * size) + 1 shingles).  Sets are joined to the least set of each of
   their prefix shingles; the components of these stars are clusters, and every link lies within a cluster.
4. Each cluster's sequences make a trie.  A set traverses it with the overlap so far, shared by all sets below a
   node, and leaves a subtree when even the remaining lengths cannot reach the overlap that a link needs, when
   the sizes below cannot link, or when all sets below are in its component already - so that a group of
   thousands of copies costs one comparison each and not one for each pair.
5. A cluster of more than ``block_tokens`` is cut into blocks (tasks), each with the cluster's first set as a
   pivot, which joins the blocks' copies into one component.  The sets that are not in a cluster's largest
   component are then compared with all blocks of it, block by block.

Defined results: null, empty or blank text has no shingles and links with nothing; rows with a null id link with
nothing and have a null component; rows with one id are one document for reachability; repeated rows give a row each.
Texts of any length are shingled whole.  Ties: a component's id is its smallest id, and equally rare shingles are ordered
by their hash.  An empty table gives no rows.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import components, cut, give_back, runs
from medallion.llm.word_hash import deal, deltas, in_order, mix, pack, texts_of, unpack, word_hashes

GROUP_BYTES, MIN_GROUPS, MIN_BUCKETS, BUCKET_TOKENS = 8 << 20, 64, 256, 1 << 19
BLOCK_TOKENS, HASH_BITS, DF_CAP = 500_000, 44, (1 << 19) - 1


# ---------------------------------------------------------------------------------------------- shingles
def shingle_sets(texts: list[bytes], size: int):
    """Distinct shingle hashes of every text: all in one array (ascending for each text), and their numbers."""
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    factors = np.random.default_rng(11).integers(1, 1 << 63, size, dtype=np.uint64) | np.uint64(1)
    rolled = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for k in range(size):
        rolled += mix(words[k:k + len(rolled)]) * factors[k]
    rolled = mix(rolled)
    sets = []
    for n, end in zip(counts.tolist(), ends.tolist()):
        if n >= size:
            sets.append(np.unique(rolled[end - n:end - size + 1]))
        elif n:  # fewer words: the whole sequence and its length, not to be mistaken for a longer one
            whole = mix(words[end - n:end]) * factors[:n]
            sets.append(mix(np.add.reduce(whole, keepdims=True) + np.uint64(n)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.array([len(s) for s in sets], np.int64)


def _group_sets(docs: pa.Table, size: int, bits: int):
    """A group's sets, its distinct shingles as asked for, and each shingle's place among them."""
    docs = in_order(docs)
    hashes, sizes = shingle_sets(texts_of(docs), size)
    own = min(40, 64 - bits)  # of a hash, besides those that its bucket stands for
    keys, where = np.unique(hashes >> np.uint64(64 - bits - own), return_inverse=True)
    limits = np.searchsorted(keys >> np.uint64(own), np.arange((1 << bits) + 1, dtype=np.uint64))
    return docs, hashes, sizes, keys, where, limits


def _ask(size: int, bits: int):
    def run(docs: pa.Table) -> pa.Table:
        docs, _, _, keys, where, limits = _group_sets(docs, size, bits)
        own = np.bincount(where, minlength=len(keys)).astype(np.uint64)
        some = np.flatnonzero(np.diff(limits))
        return pa.table({
            "bucket": pa.array(some, pa.int64()),
            "g": pa.array([docs.column("g")[0].as_py()] * len(some), pa.int64()),
            "keys": pa.array([pack(deltas(keys[limits[b]:limits[b + 1]]), 8) for b in some], pa.binary()),
            "own": pa.array([pack(own[limits[b]:limits[b + 1]], 4) for b in some], pa.binary())})
    return run


def _answer(asked: pa.Table) -> pa.Table:
    keys = [np.cumsum(unpack(k, 8), dtype=np.uint64) for k in asked.column("keys").to_pylist()]
    _, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(where, np.concatenate([unpack(o, 4) for o in asked.column("own").to_pylist()]))
    parts = np.split(total[where].astype(np.uint64), np.cumsum([len(k) for k in keys])[:-1])
    return pa.table({"g": asked.column("g"), "bucket": asked.column("bucket"),
                     "n": pa.array([pack(p, 5) for p in parts], pa.binary())})


def _ordered_sets(size: int, bits: int, percent: int):
    """Each document's size and, where enough of its shingles are shared, those in the global order."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("tokens", pa.list_(pa.int64()))])

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        docs, hashes, sizes, _, where, _ = _group_sets(docs, size, bits)
        frequency = np.concatenate([unpack(a, 5) for a in answers.sort_by("bucket").column("n").to_pylist()]
                                   or [np.zeros(0, np.uint64)])[where]
        order = (np.minimum(frequency, np.uint64(DF_CAP)) << np.uint64(HASH_BITS)) \
            | (hashes >> np.uint64(64 - HASH_BITS))
        tokens, end = [], 0
        for n in sizes.tolist():
            part = slice(end, end + n)
            end += n
            shared = order[part][frequency[part] > 1]
            enough = n and len(shared) >= -(-n * percent // 100)
            tokens.append(np.sort(shared).astype(np.int64) if enough else None)
        out = pa.table({"doc_id": docs.column("doc_id"), "n": pa.array(sizes),
                        "tokens": pa.array(tokens, pa.list_(pa.int64()))}, schema)
        del hashes, where, frequency, order, tokens
        give_back()
        return out
    return run


# ---------------------------------------------------------------------------------------------- the trie
class Trie:
    """Prefix tree over ascending sequences, with one edge for each run of tokens without a branch.

    Nodes are flat lists; a node covers the leaves lo..hi-1 of the sequences in lexicographic order.
    """

    def __init__(self, sequences: list[np.ndarray], sizes: np.ndarray):
        self.order = sorted(range(len(sequences)), key=lambda i: sequences[i].astype(">u4").tobytes())
        self.seq = [sequences[i] for i in self.order]
        self.size = sizes[self.order]
        self.length = np.array([len(s) for s in self.seq], np.int64)
        self.common = np.zeros(len(self.seq) + 1, np.int64)  # shared beginning with the sequence before
        for i in range(1, len(self.seq)):
            a, b = self.seq[i - 1], self.seq[i]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            self.common[i] = differ[0] if len(differ) else m
        # node: lo, hi, edge tokens, last token or -1, least and greatest size, most tokens left below, children
        self.nodes: list[tuple] = []
        self.root = self._build(0, len(self.seq), 0)

    def _build(self, lo: int, hi: int, depth: int) -> int:
        made, todo = {}, [(lo, hi, depth, None)]
        root = None
        while todo:
            lo, hi, depth, parent = todo.pop()
            end = int(self.common[lo + 1:hi].min()) if hi - lo > 1 else len(self.seq[lo])
            edge = self.seq[lo][depth:end]
            last = int(self.seq[lo][end - 1]) if end else -1
            sizes = self.size[lo:hi]
            number = len(self.nodes)
            self.nodes.append((lo, hi, edge, last, int(sizes.min()), int(sizes.max()),
                               int(self.length[lo:hi].max()) - end, made.setdefault(number, [])))
            if parent is None:
                root = number
            else:
                made[parent].append(number)
            if hi - lo > 1:
                cuts = [lo, *(lo + 1 + np.flatnonzero(self.common[lo + 1:hi] == end)).tolist(), hi]
                todo += [(a, b, end, number) for a, b in zip(cuts, cuts[1:])]
        return root

    def links(self, query: np.ndarray, size: int, mask: np.ndarray, percent: int, skip, after: int = -1):
        """Leaves beyond ``after`` that link with ``query`` (whose tokens are set in ``mask``); ``skip(lo, hi)``
        says whether none of these leaves is of interest any more."""
        low, high = -(-size * percent // 100), size * 100 // percent
        todo, nodes = [(self.root, 0)], self.nodes
        while todo:
            number, overlap = todo.pop()
            lo, hi, edge, last, least, most, left, children = nodes[number]
            if hi <= after + 1 or most < low or least > high or skip(lo, hi):
                continue
            if len(edge):
                overlap += int(np.count_nonzero(mask[edge]))
            other = max(least, low)
            rest = min(left, len(query) - int(np.searchsorted(query, last, "right")))
            if (100 + percent) * (overlap + rest) < percent * (size + other):
                continue
            if hi - lo == 1:
                if 100 * overlap >= percent * (size + int(self.size[lo]) - overlap):
                    yield lo
            else:
                todo += [(c, overlap) for c in children]


def spanning_links(sequences: list[np.ndarray], sizes: np.ndarray, label: np.ndarray, percent: int,
                   queries: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (i, j) that join different components of ``label``, enough to join all that link.  With ``queries``
    (a boolean for each sequence) only links with one of these are looked for."""
    ranks, flat = np.unique(np.concatenate(sequences), return_inverse=True)
    sequences = np.split(flat, np.cumsum([len(s) for s in sequences])[:-1])
    trie = Trie(sequences, sizes)
    component = label[trie.order].copy()
    mask, out = np.zeros(len(ranks), bool), []
    ask = np.ones(len(sequences), bool) if queries is None else queries[trie.order]
    for q in np.flatnonzero(ask):
        query = trie.seq[q]
        mask[query] = True
        skip = lambda lo, hi: (component[lo:hi] == component[q]).all()
        for leaf in trie.links(query, int(trie.size[q]), mask, percent, skip, int(q) if queries is None else -1):
            if component[leaf] != component[q]:
                out.append((trie.order[q], trie.order[leaf]))
                component[component == component[leaf]] = component[q]
        mask[query] = False
    return out


def _link_runs(percent: int):
    """Links within each (cluster, block, against) run, as pairs of representatives."""
    def run(batches):
        for _, rows in runs(batches, 3):
            rows = rows.combine_chunks()
            if rows.num_rows < 2:
                continue
            tokens = rows.column("tokens").combine_chunks()
            sequences = np.split(tokens.flatten().to_numpy(), tokens.offsets.to_numpy()[1:-1] - tokens.offsets[0].as_py())
            queries = rows.column("ask").to_numpy()
            found = spanning_links(sequences, rows.column("n").to_numpy(), rows.column("label").to_numpy(), percent,
                                   None if queries.all() else queries)
            if found:
                rep, sid = rows.column("rep").to_numpy(), rows.column("sid").to_numpy()
                a, b = np.array(found).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rep[a]), pa.array(rep[b]), pa.array(sid[a]), pa.array(sid[b])],
                    names=["a", "b", "sid_a", "sid_b"])
        give_back()
    return run


TASK = ["cluster", "block", "against", "sid", "rep", "n", "tokens", "label", "ask"]


def _run_tasks(tasks: DataFrame, percent: int) -> DataFrame:
    return tasks.select(*TASK).repartition("cluster", "block", "against") \
        .sortWithinPartitions("cluster", "block", "against", "sid") \
        .mapInArrow(_link_runs(percent), "a long, b long, sid_a long, sid_b long")


def _class_links(classes: DataFrame, percent: int, block_tokens: int) -> DataFrame:
    """(a, b): links between representatives of ``classes`` (sid, rep, n, tokens) that span all components."""
    need = F.ceil(F.col("n") * percent / 100)
    postings = classes.select("sid", F.explode(F.slice(
        "tokens", F.lit(1), (F.size("tokens") - need + 1).cast("int"))).alias("token"))
    least = postings.groupBy("token").agg(F.min("sid").alias("first"), F.count("*").alias("df")).where("df > 1")
    stars = postings.join(least, "token").where("sid <> first").select(F.col("sid").alias("a"), F.col("first").alias("b"))
    clusters = components(stars).withColumnRenamed("node", "sid").withColumnRenamed("component", "cluster")
    sets = cut(classes.join(clusters, "sid"))
    weights = sets.groupBy("cluster").agg(F.ceil(F.sum(F.size("tokens")) / block_tokens).alias("blocks"))
    placed = sets.join(weights, "cluster").withColumn("block", F.pmod(F.xxhash64("sid"), "blocks"))
    first = placed.where("blocks > 1 and sid = cluster")
    pivots = first.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))) \
        .where(F.col("block") != F.pmod(F.xxhash64("sid"), "blocks"))
    own = dict(against=F.lit(-1).cast("long"), label=F.col("sid"), ask=F.lit(True))
    links = cut(_run_tasks(placed.unionByName(pivots).withColumns(own), percent))

    # clusters of several blocks: what is outside the largest component meets every block
    wide = placed.where("blocks > 1")
    if wide.isEmpty():
        return links.select("a", "b")
    so_far = components(links.select(F.col("sid_a").alias("a"), F.col("sid_b").alias("b")))
    labelled = wide.join(so_far, wide["sid"] == so_far["node"], "left") \
        .withColumn("label", F.coalesce("component", "sid")).drop("node", "component")
    parts = labelled.groupBy("cluster", "label").agg(F.sum(F.size("tokens")).alias("w"))
    main = parts.groupBy("cluster").agg(F.max_by("label", F.struct("w", "label")).alias("main"),
                                        (F.sum("w") - F.max("w")).alias("rest")).where("rest > 0") \
        .select("cluster", "main", F.ceil(F.col("rest") / block_tokens).alias("rest_blocks"))
    labelled = labelled.join(main, "cluster")
    all_rest = F.sequence(F.lit(0).cast("long"), F.col("rest_blocks") - 1)
    all_blocks = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    stragglers = labelled.where("label <> main").withColumn("against", F.pmod(F.xxhash64("sid", F.lit(1)), "rest_blocks"))
    members = labelled.withColumn("against", F.explode(all_rest)).withColumn("ask", F.lit(False))
    asking = stragglers.withColumn("block", F.explode(all_blocks)).withColumn("ask", F.lit(True))
    more = _run_tasks(members.unionByName(asking), percent)
    return links.select("a", "b").unionByName(more.select("a", "b"))


def jaccard_groups(docs: DataFrame, size: int = 5, percent: int = 75, id_col: str = "doc_id",
                   text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    groups = max(MIN_GROUPS, -(-total // GROUP_BYTES))
    bits = int(max(MIN_BUCKETS, total // 6 // BUCKET_TOKENS) - 1).bit_length()
    rows = deal(rows, groups)
    answers = rows.groupBy("g").applyInArrow(_ask(size, bits), "bucket long, g long, keys binary, own binary") \
        .groupBy("bucket").applyInArrow(_answer, "g long, bucket long, n binary")
    sets = cut(rows.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(
        _ordered_sets(size, bits, percent), "doc_id long, n long, tokens array<long>"))

    # Equal sets are one class; a set with a shingle of its own equals no other.
    own = F.when(F.size("tokens") < F.col("n"), F.col("doc_id"))
    shared = sets.where("tokens is not null and doc_id is not null") \
        .withColumn("sid", F.xxhash64("tokens", "n", own)).withColumn("check", F.xxhash64(F.reverse("tokens"), own))
    classes = cut(shared.groupBy("sid", "check", "n").agg(F.min("doc_id").alias("rep"), F.first("tokens").alias("tokens"))
                  .select("sid", "rep", "n", "tokens"))
    links = _class_links(classes, percent, block_tokens)
    copies = shared.select("sid", "doc_id").join(classes.select("sid", "rep"), "sid") \
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    group = components(links.unionByName(copies))
    return sets.join(group, sets["doc_id"] == group["node"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
