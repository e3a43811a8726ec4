"""Main text of web pages by wrapper induction over the pages of a host.

Every page is parsed into blocks of text and a compressed DOM tree: inline elements are left out, and equal
siblings (paragraphs, list items) are one node; what is nested deeper than MAX_DEPTH counts for the node there.  A host's
most frequent tree is its reference; each page's tree is aligned with it by simple tree matching, and all texts of
aligned nodes, wherever they stand, are counted over the host's pages of distinct main content (pages that differ only in
menus, adverts or script are one).  The wrapper follows from these counts alone, whatever elements are called:

* a node most of whose characters are links, or are texts that several pages share, is template (menus, adverts and
  footers come from small stocks); the others are varying slots;
* the content region is found from the root down: as long as one child holds most of the varying text and nothing beside
  it is a paragraph or heading, the region is that child;
* varying slots of the region are content, and a text that stands at one node on MIN_SHARE of the pages is template.

Element names, roles and class words (lists below) decide alone only for hosts of fewer than MIN_PAGES distinct pages, and
for pages of which the wrapper leaves less than half of what they mark: these are copies of other pages, or built unlike
their host.  Besides, what a page itself marks as outside (a form, an advert, reader comments) never is content, and
template texts inside an article that it marks stay.

Scale: counts are aggregated by Spark, so a host with a third of all pages is no task of its own.  Pages meet their host's
wrapper (one row for each host, its tree of any size) in a join by host; hosts with more than a 1024th of all pages (fewer
than 1024) are broadcast instead if their tree has at most TREE_BYTES, and their pages stay where they are in that join.
Wrappers of such hosts with larger trees are copied once for each 1024th of all pages, and their pages are dealt to the
copies by hash.

Character references are decoded, white space inside a block becomes one blank, blocks are trimmed and joined by
two line feeds.  Whole pages are read; nothing is cut.

Defined results: null html is an empty page with empty text; a null or unparsable url belongs to the host ''; broken
markup is closed as browsers do, and inline elements nested deeper than MAX_INLINE are transparent, so that parsing
takes time in proportion to the page; repeated pages give a row each and count once for the wrapper (of pages with the
same main content the one with the smallest hash); of equally frequent trees the one with the greatest hash is the
reference.  An empty table gives no rows.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import HEAVY, cut, give_back, heavy_keys

MIN_PAGES, MIN_SHARE, MAX_DEPTH, MAX_INLINE, TREE_BYTES = 3, 0.6, 100, 64, 1 << 16
REGION_SHARE, TEMPLATE_SHARE = 0.6, 0.5

# HTML element names, and words in class or id that name a region.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img picture nobr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp svg math object canvas select "
                "audio video".split())
OUTSIDE = frozenset("nav footer aside form button dialog menu head fieldset".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
                          "toolbar".split())
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner sponsor sponsored sponsors promo promos "
    "promotion cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup "
    "login sidebar sidenav widget widgets nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager "
    "footer header masthead topbar toolbar comment comments commentlist respond reply replies discussion disqus social "
    "share sharing related recommended recommendations".split())
MAIN_NAMES = frozenset("article-body article-content main-content entry-content post-content story-body post-body "
                       "articlebody maincontent content main article post entry story".split())
CLOSED_BY = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
             "th": ("tr", "table"), "option": ("select",)}
SAME_KIND = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)
                    |<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>
                    |<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@lru_cache(maxsize=4096)
def _attributes(source: str):
    """(label for the tree, stands outside, marks the main text, is hidden) from a start tag's attributes."""
    values = {k.lower(): html_lib.unescape((v or "").strip("\"'")) for k, v in _ATTRIBUTE.findall(source)}
    names = (values.get("class", "") + " " + values.get("id", "")).split()
    words = {w.lower() for n in names for w in _WORD.findall(n)}
    role = values.get("role", "").lower()
    style = values.get("style", "").replace(" ", "").lower()
    hidden = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in style \
        or "visibility:hidden" in style
    main = role in ("main", "article") or any(n.lower() in MAIN_NAMES for n in names)
    outside = role in OUTSIDE_ROLES or (bool(words & OUTSIDE_WORDS) and not main)
    return re.sub(r"\d+", "", ".".join(sorted(names)))[:80], outside, main, hidden


class Page:
    """Blocks and compressed tree of a page.

    ``nodes``: (depth, label) in page order; ``blocks``: (node, text, outside, inside the marked main text, characters
    of links).
    """

    def __init__(self, source: str):
        self.nodes: list[tuple[int, str]] = [(0, "page")]
        self.blocks: list[tuple[int, str, bool, bool, int]] = []
        self._children: list[dict[str, int]] = [{}]  # for each node: label → child
        # open elements: name, node, outside, main, is a block
        self._open = [("", 0, False, False, True)]
        self._number = Counter()  # open elements by name: a name that isn't open costs nothing
        self._inline = 0
        self._text: list[str] = []
        self._linked = 0
        self._read(source)
        self._flush()
        self._put_in_order()

    def _put_in_order(self):
        """Number the nodes in page order: a node, then all that stands below it."""
        order, open_ = [], [0]
        while open_:
            node = open_.pop()
            order.append(node)
            open_ += reversed(self._children[node].values())
        place = {node: i for i, node in enumerate(order)}
        self.nodes = [self.nodes[n] for n in order]
        self.blocks = [(place[n], *rest) for n, *rest in self.blocks]

    def _flush(self):
        if self._text:
            text = " ".join(html_lib.unescape("".join(self._text)).split())
            linked, self._text, self._linked = self._linked, [], 0
            if text:
                _, node, outside, main, _ = self._open[-1]
                self.blocks.append((node, text, outside, main, min(linked, len(text))))

    def _add(self, text: str):
        self._text.append(text)
        if self._number["a"]:
            self._linked += len(text)

    def _pop_to(self, depth: int):
        if any(e[4] for e in self._open[depth:]):
            self._flush()
        for name, *_, block in self._open[depth:]:
            self._number[name] -= 1
            self._inline -= not block
        del self._open[depth:]

    def _find(self, names, until=()) -> int:
        """Depth of the nearest open element with one of these names that no element of ``until`` hides; or 0."""
        if not any(self._number[n] for n in names):
            return 0
        for depth in range(len(self._open) - 1, 0, -1):
            name = self._open[depth][0]
            if name in names:
                return depth
            if name in until:
                return 0
        return 0

    def _start(self, name: str, source: str):
        inline = name in INLINE
        label, outside, main, hidden = _attributes(source)
        if name == "header" or name == "hgroup":  # a heading inside the article belongs to it
            outside = outside or not self._open[-1][3]
            if self._open[-1][3] and not hidden:
                outside = False
        elif len(name) == 2 and name[0] == "h" and name[1] in "123456":
            outside = False
        outside = outside or hidden or name in OUTSIDE
        main = (main or name in ("article", "main")) and not outside
        if not inline:
            self._flush()
            if main and name in ("article", "main"):  # an article never stands inside an unclosed menu
                depth = self._find(("nav", "header", "p"), ("article", "main", "section"))
                if depth:
                    self._pop_to(depth)
            depth = self._find(("p",), ("article", "main", "section", "div", "li", "td", "th", "blockquote", "body"))
            if depth:
                self._pop_to(depth)
            if name in CLOSED_BY:
                depth = self._find(SAME_KIND.get(name, (name,)), CLOSED_BY[name])
                if depth:
                    self._pop_to(depth)
        _, node, was_outside, was_main, _ = self._open[-1]
        if inline and self._inline >= MAX_INLINE:
            return
        if not inline:
            node = self._child(node, f"{name}.{label}" if label else name)
        self._number[name] += 1
        self._inline += inline
        self._open.append((name, node, was_outside or outside, was_main or main, not inline))

    def _child(self, parent: int, label: str) -> int:
        depth, known = self.nodes[parent][0] + 1, self._children[parent]
        if depth > MAX_DEPTH:
            return parent
        if label not in known:
            known[label] = len(self.nodes)
            self.nodes.append((depth, label))
            self._children.append({})
        return known[label]

    def _end(self, name: str):
        if not self._number[name]:
            return
        if name in INLINE:
            depth = next((d for d in range(len(self._open) - 1, 0, -1) if self._open[d][0] == name or self._open[d][4]), 0)
            if depth and self._open[depth][0] == name:
                self._pop_to(depth)
            return
        depth = self._find((name,))
        if depth:
            self._pop_to(depth)

    def _read(self, source: str):
        at, lower = 0, None
        while True:
            tag = _TAG.search(source, at)
            if not tag:
                self._add(source[at:])
                return
            self._add(source[at:tag.start()])
            at = tag.end()
            closing, name, rest = tag.group(1, 2, 3) if tag.group(2) else tag.group(4, 5, 6)
            if not name:
                continue
            if not source.endswith(">", 0, at):
                return  # the page ends inside a tag
            name = name.lower()
            if closing:
                self._end(name)
            elif name == "br":
                self._text.append(" ")
            elif name in RAW:
                if not rest.rstrip().endswith("/"):
                    lower = lower or source.lower()
                    end = lower.find(f"</{name}", at)
                    if end < 0 and name in ("script", "style", "title", "textarea", "iframe", "xmp", "noembed"):
                        return
                    at = end if end >= 0 else at
            elif name in VOID:
                if name == "hr":
                    self._flush()
            else:
                self._start(name, rest)

    def tree(self) -> str:
        """The nodes in page order, as text from which ``align`` rebuilds the tree."""
        return "\n".join(f"{depth} {label}" for depth, label in self.nodes)


def _children(tree: str):
    """Labels and children lists of a tree's nodes."""
    labels, children, path = [], [], []
    for line in tree.split("\n"):
        depth, _, label = line.partition(" ")
        del path[int(depth):]
        if path:
            children[path[-1]].append(len(labels))
        path.append(len(labels))
        labels.append(label)
        children.append([])
    return labels, children


@lru_cache(maxsize=2_000)
def align(tree: str, reference: str) -> dict[int, int]:
    """Simple tree matching: node of ``tree`` → node of ``reference``; equal labels, order and ancestry kept, as
    many nodes as possible."""
    if tree == reference:
        return {i: i for i in range(tree.count("\n") + 1)}
    la, ca = _children(tree)
    lb, cb = _children(reference)
    table: dict[tuple[int, int], list] = {}

    def size(a: int, b: int) -> int:
        """Nodes in the best matching of the subtrees; keeps the table of their children."""
        if la[a] != lb[b]:
            return 0
        xs, ys = ca[a], cb[b]
        best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, x in enumerate(xs, 1):
            for j, y in enumerate(ys, 1):
                best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + size(x, y))
        table[a, b] = best
        return best[-1][-1] + 1

    matched, open_ = {}, [(0, 0)] if size(0, 0) else []
    while open_:
        a, b = open_.pop()
        matched[a] = b
        best, i, j = table[a, b], len(ca[a]), len(cb[b])
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                open_.append((ca[a][i], cb[b][j]))
    return matched


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _taken(page: Page) -> list[tuple[int, str, bool, bool, int]]:
    """The blocks of the main text by what the page marks."""
    usable = [b for b in page.blocks if not b[2]]
    return [b for b in usable if b[3]] or usable


def content_nodes(reference: str, slots: dict[int, tuple[int, int, int]]) -> set[int]:
    """The nodes of the reference that hold content; ``slots``: characters, those of links, and those of texts that
    several pages share, at each node.  Empty if no text varies."""
    labels, children = _children(reference)
    template = {n for n, (chars, links, shared) in slots.items() if max(links, shared) > TEMPLATE_SHARE * chars}
    own = [0] * len(labels)
    for n, (chars, links, shared) in slots.items():
        own[n] = 0 if n in template else max(chars - links - shared, 0)
    below = list(own)
    for n in reversed(range(len(labels))):  # children follow their parents
        below[n] += sum(below[c] for c in children[n])
    region = 0
    while below[region] and children[region]:
        best = max(children[region], key=below.__getitem__)
        beside = [c for c in children[region] if c != best and own[c] and re.match(r"(p|h[1-6])(\.|$)", labels[c])]
        if beside or not children[best] or below[best] < REGION_SHARE * below[region]:
            break
        region = best
    if not below[region]:
        return set()
    inside, open_ = set(), [region]
    while open_:
        n = open_.pop()
        inside.add(n)
        open_ += children[n]
    return inside - template


def chosen(page: Page, matched: dict[int, int], content: set[int]) -> list[tuple[int, str, bool, bool, int]]:
    """The page's blocks at content nodes; a node that the reference lacks counts as the next one above that it has."""
    path, place = [], []
    for node, (depth, _) in enumerate(page.nodes):
        del path[depth:]
        path.append(matched.get(node, path[-1] if path else -1))
        place.append(path[-1])
    return [b for b in page.blocks if not b[2] and place[b[0]] in content]


def main_text(page: Page, matched: dict[int, int], template: set[tuple[int, int]], content: set[int] = frozenset()) -> str:
    """The main text: by the wrapper, if there is one and it leaves half of what the page marks, else by the marks."""
    marked = _taken(page)
    taken = chosen(page, matched, content) if content else marked
    taken = [b for b in taken if b[3] or (matched.get(b[0]), _digest(b[1])) not in template]
    if 2 * sum(len(b[1]) for b in taken) < sum(len(b[1]) for b in marked):
        taken = marked
    return "\n\n".join(b[1] for b in taken)


# ---------------------------------------------------------------------------------------------- Spark side
_TEXTS = pa.list_(pa.struct([("node", pa.int32()), ("digest", pa.int64()), ("chars", pa.int64()), ("links", pa.int64())]))


def _shapes(batches):
    """Digest of the main content, tree, and all texts of each page."""
    for batch in batches:
        contents, trees, texts = [], [], []
        for source in batch.column(2).to_pylist():
            page = Page(source or "")
            contents.append(_digest("\n\n".join(b[1] for b in _taken(page))))
            trees.append(page.tree())
            found = {(b[0], _digest(b[1])): (len(b[1]), b[4]) for b in page.blocks}
            texts.append([{"node": n, "digest": d, "chars": c, "links": k} for (n, d), (c, k) in found.items()])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(contents, pa.int64()), pa.array(trees, pa.string()),
             pa.array(texts, _TEXTS)], names=["host", "page", "content", "tree", "texts"])
    give_back()


def _aligned(batches):
    """The texts at nodes that the reference has, by the reference's nodes."""
    for batch in batches:
        found = []
        for h, tree, texts, reference, pages in zip(*(batch.column(i).to_pylist() for i in range(5))):
            matched = align(tree, reference)
            here = {(matched[t["node"]], t["digest"]): (t["chars"], t["links"]) for t in texts if t["node"] in matched}
            found += [(h, pages, n, d, c, k) for (n, d), (c, k) in here.items()]
        columns = list(zip(*found)) or [[]] * 6
        types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)],
                                         names=["host", "pages", "node", "digest", "chars", "links"])
    align.cache_clear()
    give_back()


def _content(batches):
    """The content nodes of each host's reference."""
    for batch in batches:
        found = [sorted(content_nodes(reference, {s["node"]: (s["chars"], s["links"], s["shared"]) for s in slots}))
                 for reference, slots in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(found, pa.list_(pa.int32()))],
                                         names=["host", "reference", "template", "content"])


def _extract(batches):
    for batch in batches:
        texts = []
        for source, reference, template, content in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
            page = Page(source or "")
            known = {(t["node"], t["digest"]) for t in template or ()}
            texts.append(main_text(page, align(page.tree(), reference) if reference else {}, known, set(content or ())))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    align.cache_clear()
    give_back()


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def induce(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, reference, template, content) for each host of ``pages`` (host, html) with ``min_pages`` distinct ones."""
    text = "struct<node: int, digest: long, chars: long, links: long>"
    shapes = pages.select("host", F.xxhash64("html").alias("page"), "html") \
        .mapInArrow(_shapes, f"host string, page long, content long, tree string, texts array<{text}>")
    # one row for each distinct main content of a host: copies of a page, and near copies that differ outside of it,
    # say nothing about its template
    shapes = shapes.groupBy("host", "content").agg(F.min_by(F.struct("tree", "texts"), "page").alias("shape")) \
        .select("host", "shape.tree", "shape.texts")
    shapes = cut(shapes)  # parsed once; trees and digests are small
    trees = shapes.groupBy("host", F.xxhash64("tree").alias("t")).agg(F.count("*").alias("n"), F.min("tree").alias("tree"))
    references = trees.groupBy("host").agg(F.max_by("tree", F.struct("n", "t")).alias("reference"), F.sum("n").alias("pages")) \
        .where(F.col("pages") >= min_pages)
    texts = shapes.join(references, "host").select("host", "tree", "texts", "reference", "pages") \
        .mapInArrow(_aligned, "host string, pages long, node int, digest long, chars long, links long")
    counted = texts.groupBy("host", "node", "digest", "pages").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"),
                                                                   F.sum("links").alias("links"))
    # sums by node, and its constant texts: at most a page's blocks for each host
    constant = F.when((F.col("n") >= min_pages) & (F.col("n") >= min_share * F.col("pages")), F.struct("node", "digest"))
    nodes = counted.groupBy("host", "node") \
        .agg(F.sum("chars").alias("chars"), F.sum("links").alias("links"),
             F.sum(F.when(F.col("n") > 1, F.col("chars")).otherwise(0)).alias("shared"), F.collect_list(constant).alias("template"))
    slots = nodes.groupBy("host").agg(F.collect_list(F.struct("node", "chars", "links", "shared")).alias("slots"),
                                      F.flatten(F.collect_list("template")).alias("template"))
    return references.join(slots, "host").select("host", "reference", "template", "slots").mapInArrow(
        _content, "host string, reference string, template array<struct<node: int, digest: long>>, content array<int>")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row for each page."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
                        host_of(F.col(url_col)).alias("host"))
    wrappers = induce(rows)
    counts = cut(rows.groupBy("host").agg(F.count("*").alias("n")))
    share = max(counts.agg(F.sum("n")).first()[0] or 0, HEAVY) // HEAVY
    heavy = heavy_keys(counts, "host", "n").select("host", F.ceil(F.col("n") / share).cast("int").alias("copies"))
    known = cut(wrappers.join(F.broadcast(heavy), "host", "left")
                .select("host", "copies", F.struct("reference", "template", "content").alias("wrapper"),
                        (F.octet_length("reference") <= TREE_BYTES).alias("small")))
    some = known.where(F.col("copies").isNotNull()) \
        .select(F.col("host").alias("heavy"), F.when(F.col("small"), F.col("wrapper")).alias("own"), "copies")
    # a page of a heavy host with a small tree has its wrapper by broadcast; in the join by host it stands under a key that
    # finds nothing.  Pages of one with a larger tree are dealt to the copies of its wrapper
    hashed = F.xxhash64("html", "url")
    key = F.when(F.col("own").isNull(), F.col("host")).otherwise(F.concat(F.lit(" "), hashed.cast("string")))
    part = F.when(F.col("copies").isNull() | F.col("own").isNotNull(), 0).otherwise(F.pmod(hashed, "copies")).cast("int")
    light = known.where(F.col("copies").isNull() | ~F.col("small")) \
        .select(F.col("host").alias("key"), F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)).alias("part"),
                "wrapper")
    met = rows.join(F.broadcast(some), F.col("host") == F.col("heavy"), "left")
    if light.isEmpty():  # every wrapper is broadcast: the pages stay where they are
        met = met.withColumnRenamed("own", "wrapper")
    else:
        met = met.withColumns({"key": key, "part": part}).join(light, ["key", "part"], "left") \
            .withColumn("wrapper", F.coalesce("own", "wrapper"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return met.select("page_id", "url", "html", "wrapper.reference", "wrapper.template", "wrapper.content") \
        .mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long")
