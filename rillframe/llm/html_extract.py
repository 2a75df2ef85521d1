"""Main text of web pages by wrapper induction.

Pages of a host come from a few templates. A page is read as its text blocks (text between the edges of block elements)
and the folded tree of its containers (div, section, article and the like): siblings of one name are one node. Elements
that are never an article's text by element, role or class (menus, headers, footers, forms and so on) are left out first.

1. Alignment: the trees of a host's pages are aligned by simple tree matching (``matched``). A host's most frequent trees
   lead: a tree joins the first leader that it matches in ``alike`` percent of the nodes of both, and a leader an earlier
   one. Of the trees that join none, the most frequent lead in the next round, in which there are more leaders, until no
   tree is left. So a tree is a cluster of its own, with the pages that have exactly this tree, only if it has led itself,
   after it was held against the leaders of every round before. Matched nodes are those of equal paths.
2. Template: a block that 90 % of a cluster's pages, two at least, hold at the same path with the same text. An odd page
   cancels nothing.
3. Region: the smallest container that holds four fifths of the text that varies over the cluster; an article or main
   element on the way ends the descent. So menus, adverts and notices that change from page to page go too, whatever
   they are called. A page's text is its blocks in the region without those of the template, and its h1 headings.

Where alignment finds no content (a cluster's only page, copies of one page), an explicit article or main element is
taken, else the body.

Every page counts: (tree, container, block) is summed within batches and then over all pages before anything is gathered
by cluster, and blocks that only one page of a host holds go before that, so a host with a third of all pages costs no
task more than the others. What is gathered by cluster is a template and the containers that half of its pages have.
Wrappers are joined to the pages' blocks by tree; the join can be split where it is skewed, and is a broadcast where
Spark finds the table of wrappers small enough.

Defined cases: null or empty html gives an empty text; a null url, or one without a host, shares the wrappers of the
empty host; equal pages of a host give equal texts; broken markup is mended; an empty table gives an empty result; other
columns pass through, and made ones that clash get leading underscores.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillframe.llm.common import staged, unused
from rillframe.llm.dom import BLOCKS, SPACED, Node, parse, plain
from rillframe.llm.url_filter import host_of

# Block elements that lay out a page; the others are text.
CONTAINERS = frozenset("article aside body center div fieldset footer form header html main nav section".split())

# Fixed values. Percent of a cluster's pages that hold a template block; percent of the nodes of two trees that match in
# a cluster; percent of the varying text that the region holds; how many trees of a host lead in the first round, how many
# times as many in each next round, and in any round at most; how many are aligned in one go, at least.
CONSTANT, ALIKE, HELD, LEADERS, MORE, MOST, TREES = 90, 80, 80, 32, 4, 8192, 200

Tree = list  # [parent, name, ...] of each node, parents first; the root's parent is -1


def flat(shape: tuple) -> Tree:
    """The tree of nested (name, (children)) pairs."""
    out, todo = [], [(-1, shape)]
    while todo:
        parent, (name, children) = todo.pop()
        todo += [(len(out), c) for c in reversed(children)]
        out.append([parent, name])
    return out


def _heaviest(pairs: list[tuple[int, int, int]], chosen_of: dict) -> int:
    """The largest weight of (i, j, weight) pairs that increase in both places; ``chosen_of`` gets those pairs."""
    places = sorted({j for _, j, _ in pairs})
    best = [(0, None)] * (len(places) + 1)  # a Fenwick tree of maxima over the second places
    for i, j, weight in sorted(pairs, key=lambda p: (p[0], -p[1])):
        at = k = bisect_left(places, j)
        found = (0, None)
        while k:
            found = max(found, best[k], key=lambda e: e[0])
            k &= k - 1
        entry, k = (found[0] + weight, (i, j, found[1])), at + 1
        while k < len(best):
            best[k] = max(best[k], entry, key=lambda e: e[0])
            k += k & -k
    total, k = (0, None), len(places)
    while k:
        total = max(total, best[k], key=lambda e: e[0])
        k &= k - 1
    link = total[1]
    while link:
        chosen_of[link[0]] = link[1]
        link = link[2]
    return total[0]


def matched(a: Tree | tuple, b: Tree | tuple) -> tuple[int, dict[int, int]]:
    """Simple tree matching: how many nodes of two trees match at most, and the node of b for each matched node of a.

    Roots match if their names are equal, children only under matched parents and in order. No recursion: pairs of
    nodes of equal names under paired parents are listed from the root, and weighed from the leaves.
    """
    a, b = (flat(t) if isinstance(t, tuple) else t for t in (a, b))
    if not a or not b or a[0][1] != b[0][1]:
        return 0, {}
    below: list[list[dict[str, list[int]]]] = [[{} for _ in t] for t in (a, b)]
    for t, own in zip((a, b), below, strict=True):
        for k, (parent, name, *_) in enumerate(t[1:], 1):
            own[parent].setdefault(name, []).append(k)
    listed, children = [(0, 0)], []
    for i, j in listed:
        its = [(x, y) for name, xs in below[0][i].items() for x in xs for y in below[1][j].get(name, ())]
        children.append(its)
        listed += its
    weight: dict[tuple[int, int], int] = {}
    chosen: dict[tuple[int, int], dict[int, int]] = {}
    for pair, its in zip(reversed(listed), reversed(children), strict=True):
        chosen[pair] = {}
        weight[pair] = 1 + (_heaviest([(x, y, weight[x, y]) for x, y in its], chosen[pair]) if its else 0)
    pairs, todo = {}, [(0, 0)]
    while todo:
        i, j = todo.pop()
        pairs[i] = j
        todo += chosen[i, j].items()
    return weight[0, 0], pairs


def digest(*parts: object) -> int:
    """64 bits, the same in every process."""
    return int.from_bytes(blake2b("\0".join(map(str, parts)).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


@lru_cache(maxsize=1 << 16)
def label(name: str) -> str:
    """Numbers in a class name, as of an article, are all the same."""
    return re.sub(r"\d+", "0", name)


@lru_cache(maxsize=1 << 16)
def step(path: int, name: str) -> int:
    """The path of a child."""
    return digest(path, label(name))


class Block(NamedTuple):
    id: int  # of path and text
    text: str
    inside: bool  # an article or main element
    heading: bool


class Page(NamedTuple):
    tree: Tree  # [parent, name, is an article or main element] of its folded containers
    paths: list[int]  # of the tree's nodes
    blocks: list[Block]
    owners: list[int]  # the node of each block's container
    places: list[tuple[int, int, int]]  # (node, first, last block) of each container there is

    @property
    def shape(self) -> int:
        return digest(*sorted(self.paths))


def outline(root: Node) -> Page:
    page = Page([], [], [], [], [])
    node_of: dict[int, int] = {}
    run: list[str] = []
    path, inside, heading, above = 0, False, False, -1

    def end() -> None:
        text = plain("".join(run))
        if text:
            page.blocks.append(Block(digest(path, text), text, inside, heading))
            page.owners.append(above)
        run.clear()

    todo: list = [root]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            run.append(node)
        elif isinstance(node, tuple):  # a block ends: the one around it goes on
            end()
            path, inside, heading, above, place = node
            if place is not None:
                page.places[place] = (*page.places[place][:2], len(page.blocks))
        elif node.boiler:
            if node.tag in BLOCKS:
                end()
            elif node.tag not in ("script", "style", "template"):
                run.append(" ")
        else:
            block = node.tag in BLOCKS
            if block or node.main:
                end()
                place, before = None, (path, inside, heading, above)
                inside, heading = inside or node.main, heading or node.tag == "h1"
                if block:
                    path = step(path, node.name)
                    if node.tag in CONTAINERS:
                        if path not in node_of:
                            node_of[path] = len(page.tree)
                            page.tree.append([above, label(node.name), int(node.main)])
                            page.paths.append(path)
                        above, place = node_of[path], len(page.places)
                        page.places.append((above, len(page.blocks), 0))
                todo.append((*before, place))
            elif node.tag in SPACED:
                run.append(" ")
            todo.extend(reversed(node.children))
    end()
    return page


PAGE, VOLUME = 0, 1  # stand for the page itself, and for a container's text, among the blocks that are counted


def counts(pages: Iterator[tuple[int, str | None]]) -> tuple[dict[tuple, list[int]], dict[int, str]]:
    """Of (home, html): pages and characters of each (home, shape, container, block), and the trees by shape."""
    found: dict[tuple, list[int]] = {}
    trees: dict[int, str] = {}

    def add(key: tuple, chars: int) -> None:
        entry = found.setdefault(key, [0, 0])
        entry[0] += 1
        entry[1] += chars

    for home, html in pages:
        if not html:
            continue
        page = outline(parse(html))
        shape = digest(home, page.shape)
        if shape not in trees:
            trees[shape] = json.dumps(page.tree)
        add((home, shape, 0, PAGE), 0)
        upto = [0, *accumulate(len(b.text) for b in page.blocks)]
        held: Counter = Counter()
        for node, first, last in page.places:
            held[node] += upto[last] - upto[first]
        for node, chars in held.items():
            add((home, shape, page.paths[node], VOLUME), chars)
        own: Counter = Counter()
        for b, node in zip(page.blocks, page.owners, strict=True):
            own[page.paths[node], b.id] += len(b.text)
        for (path, block), chars in own.items():
            add((home, shape, path, block), chars)
    return found, trees


def similar(a: Tree, b: Tree) -> bool:
    return 200 * matched(a, b)[0] >= ALIKE * (len(a) + len(b))


def leader_of(shape: int, tree: Tree, leaders: list[tuple[int, Tree]]) -> int:
    """The plain rule of a round: the first leader that a tree aligns with; leaders align with earlier ones only."""
    for other, its in leaders:
        if other == shape:
            break
        if similar(tree, its):
            return leader_of(other, its, leaders)
    return shape


def needed(a: int, b: int) -> int:
    """How many nodes trees of a and b nodes have in common at least if they are similar."""
    return -(-ALIKE * (a + b) // 200)


class Leaders:
    """The leaders of a round, frequent trees first: (shape, tree).

    Matched nodes have equal paths of names, so similar trees share enough of those, and then one of the rarest of each
    (prefix filter): only such leaders are aligned. None that is similar is passed over.
    """

    def __init__(self, leaders: list[tuple[int, Tree]]) -> None:
        self.leaders, self.place = leaders, {shape: k for k, (shape, _) in enumerate(leaders)}
        self.known: dict[tuple, int] = {}  # numbers of paths, by (number of the path above, name); a repeated path has further ones
        self.clusters: dict[int, int] = {}
        nodes = [self.numbers(tree, new=True) for _, tree in leaders]
        self.often = Counter(k for own in nodes for k in own)
        self.nodes = [frozenset(own) for own in nodes]
        self.rare: dict[int, list[int]] = {}  # leaders by the nodes that they share with a similar tree of their size or more
        self.rarer: dict[int, list[int]] = {}  # of any size
        for place, own in enumerate(nodes):
            own.sort(key=self.rank)
            for index, few in zip((self.rare, self.rarer), self.prefixes(len(own)), strict=True):
                for k in own[:few]:
                    index.setdefault(k, []).append(place)

    def numbers(self, tree: Tree, new: bool = False) -> list[int]:
        """Of the nodes that leaders have, each once."""
        find = (lambda key: self.known.setdefault(key, len(self.known))) if new else self.known.get
        paths: list[int | None] = []
        seen: Counter = Counter()
        out = []
        for parent, name, *_ in tree:
            above = paths[parent] if parent >= 0 else -1
            path = None if above is None else find((above, name))
            paths.append(path)
            if path is not None:
                seen[path] += 1
                k = path if seen[path] == 1 else find((path, seen[path]))
                if k is not None:
                    out.append(k)
        return out

    def rank(self, k: int) -> tuple[int, int]:
        return self.often[k], k

    @staticmethod
    def prefixes(size: int) -> tuple[int, int]:
        """How many of its rarest nodes a tree shares one of with a similar tree of its size or more, and of any size."""
        return size - needed(size, size) + 1, size - needed(size, -(-ALIKE * size // (200 - ALIKE))) + 1

    def first(self, tree: Tree, before: int) -> int | None:
        """The place of the first leader, before this place, that a tree is similar to."""
        size, own = len(tree), sorted(self.numbers(tree), key=self.rank)
        none = size - len(own)  # nodes that no leader has are the rarest
        few, more = self.prefixes(size)
        found = {p for k in own[: max(0, more - none)] for p in self.rare.get(k, ()) if p < before}
        found |= {p for k in own[: max(0, few - none)] for p in self.rarer.get(k, ()) if p < before}
        nodes = frozenset(own)
        for p in sorted(found):
            its = self.leaders[p][1]
            if len(nodes & self.nodes[p]) >= needed(size, len(its)) and similar(tree, its):
                return p
        return None

    def led(self, place: int) -> int:
        """The cluster of a leader."""
        way = []
        at: int | None = place
        while at is not None and at not in self.clusters:
            way.append(at)
            at = self.first(self.leaders[at][1], at)
        cluster = self.leaders[way[-1]][0] if at is None else self.clusters[at]
        self.clusters |= dict.fromkeys(way, cluster)
        return cluster

    def cluster_of(self, shape: int, tree: Tree) -> int | None:
        """The cluster that a tree of the host joins or leads; None if it is left to the next round."""
        place = self.place.get(shape)
        if place is None:
            place = self.first(tree, len(self.leaders))
        return None if place is None else self.led(place)


def wrapper_of(tree: Tree, pages: int, rows: list[tuple[int, int, int, int]]) -> tuple[list[int], int | None]:
    """(template blocks, path of the region or None for the whole page), from a cluster's (container, block, pages, characters)."""
    paths: list[int] = []
    at: dict[int, int] = {}
    for k, (parent, name, _) in enumerate(tree):
        paths.append(step(paths[parent] if parent >= 0 else 0, name))
        at[paths[k]] = k
    template = [(c, b, chars) for c, b, n, chars in rows if b != VOLUME and n > 1 and 100 * n >= CONSTANT * pages]
    volume = [0] * len(tree)
    for container, block, _, chars in rows:
        if block == VOLUME and container in at:
            volume[at[container]] += chars
    for container, _, chars in template:
        k = at.get(container, -1)
        while k >= 0:
            volume[k] -= chars
            k = tree[k][0]
    children: list[list[int]] = [[] for _ in tree]
    for k, (parent, *_) in enumerate(tree):
        if parent >= 0:
            children[parent].append(k)
    node = 0
    while tree and not tree[node][2] and children[node]:
        largest = max(children[node], key=lambda k: volume[k])
        if volume[largest] <= 0 or 100 * volume[largest] < HELD * volume[0]:
            break
        node = largest
    return sorted(b for _, b, _ in template), paths[node] if node else None


def content(blocks: list[Block], places: list[tuple[int, int, int]], template: set[int] | None, region: int | None) -> str:
    """places: (path, first, last). The text of a page of a cluster; template None: it has no cluster."""
    chosen: list[Block] = []
    if template is not None:
        chosen = own = [b for b in blocks if b.id not in template]
        if region is not None:
            edges = [0] * (len(blocks) + 1)
            for path, first, last in places:
                if path == region:
                    edges[first] += 1
                    edges[last] -= 1
            within = accumulate(edges[:-1])
            chosen = [b for b, depth in zip(blocks, within, strict=True) if (depth or b.heading) and b.id not in template]
            if all(b.heading for b in chosen):
                chosen = own
    return "\n\n".join(b.text for b in chosen or [b for b in blocks if b.inside] or blocks)


def induce(pages: list[str], host: str = "") -> str:
    """The wrappers of pages of one host, as JSON: [template blocks, region] of each tree of a cluster of two pages or more."""
    found, trees = counts((digest(host), p) for p in pages)
    trees = {shape: json.loads(t) for shape, t in trees.items()}
    often = Counter({shape: n for (_, shape, _, block), (n, _) in found.items() if block == PAGE})
    rest, size = sorted(often, key=lambda s: (-often[s], s)), LEADERS
    cluster: dict[int, int] = {}
    while rest:
        leaders = Leaders([(s, trees[s]) for s in rest[:size]])
        cluster |= {s: c for s in rest if (c := leaders.cluster_of(s, trees[s])) is not None}
        rest, size = [s for s in rest if s not in cluster], min(MORE * size, MOST)
    sums: dict[int, dict[tuple, list[int]]] = {}
    for (_, shape, container, block), (n, chars) in found.items():
        entry = sums.setdefault(cluster[shape], {}).setdefault((container, block), [0, 0])
        entry[0] += n
        entry[1] += chars
    made = {c: wrapper_of(trees[c], rows[0, PAGE][0], [(*k, *v) for k, v in rows.items() if k[1] != PAGE]) for c, rows in sums.items() if rows[0, PAGE][0] > 1}
    return json.dumps({s: made[c] for s, c in cluster.items() if c in made})


@lru_cache(maxsize=512)
def load(wrappers: str) -> dict[int, tuple[frozenset[int], int | None]]:
    return {int(shape): (frozenset(blocks), region) for shape, (blocks, region) in json.loads(wrappers).items()}


def extract(html: str | None, wrappers: str | None = None, host: str = "") -> str:
    """The main text of a page: blocks joined by blank lines."""
    if not html:
        return ""
    page = outline(parse(html))
    template, region = (load(wrappers) if wrappers else {}).get(digest(digest(host), page.shape), (None, None))
    return content(page.blocks, [(page.paths[k], *span) for k, *span in page.places], template, region)


def induce_wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(shape, template, region), from all pages, for the trees of clusters of two pages or more."""
    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(html).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, trees = counts((digest(h.as_py()), p.as_py()) for h, p in zip(batch.column(0), batch.column(1), strict=True))
            keys = list(zip(*found, strict=True)) or [()] * 4
            columns = [*keys, [n for n, _ in found.values()], [c for _, c in found.values()]]
            tree = [trees[shape] if block == PAGE else None for _, shape, _, block in found]
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], pa.array(tree, pa.string())], names=["home", "shape", "container", "block", "n", "chars", "tree"])

    raw = staged(rows.mapInArrow(run, "home bigint, shape bigint, container bigint, block bigint, n bigint, chars bigint, tree string"), "raw")
    shapes = raw.where(F.col("block") == PAGE).groupBy("home", "shape").agg(F.sum("n").alias("n"), F.max("tree").alias("tree"))
    shapes = staged(shapes, "shapes")
    cluster = _clusters(shapes)
    seen = staged(raw.groupBy("home", "shape", "container", "block").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars")), "seen")
    text = ~F.col("block").isin(PAGE, VOLUME)
    shared = seen.where(text).groupBy("home", "block").agg(F.sum("n").alias("n")).where(F.col("n") > 1).select("home", "block")
    kept = seen.where(text).join(shared, ["home", "block"], "left_semi").unionByName(seen.where(~text))
    sums = staged(kept.join(cluster, "shape").groupBy("cluster", "container", "block").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars")), "blocks")
    sizes = sums.where((F.col("block") == PAGE) & (F.col("n") > 1)).select("cluster", F.col("n").alias("pages"))
    sizes = sizes.join(shapes.select(F.col("shape").alias("cluster"), F.col("tree").alias("leader")), "cluster")
    often = F.when(F.col("block") == VOLUME, 2 * F.col("n") >= F.col("pages")).otherwise((F.col("n") > 1) & (100 * F.col("n") >= CONSTANT * F.col("pages")))
    gathered = sums.where(F.col("block") != PAGE).join(sizes, "cluster").where(often).groupBy("cluster").agg(F.collect_list(F.struct("container", "block", "n", "chars")).alias("rows"))
    gathered = sizes.join(gathered, "cluster", "left").select("cluster", "pages", "leader", "rows")

    def wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [wrapper_of(json.loads(r["leader"]), r["pages"], [tuple(e.values()) for e in r["rows"] or ()]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m[0] for m in made], pa.list_(pa.int64())), pa.array([m[1] for m in made], pa.int64())], names=["cluster", "template", "region"])

    return cluster.join(gathered.mapInArrow(wrap, "cluster bigint, template array<bigint>, region bigint"), "cluster").select("shape", "template", "region")


def _clusters(shapes: DataFrame) -> DataFrame:
    """(shape, cluster) of (home, shape, n, tree), in rounds until every tree has its cluster."""
    found, size = None, LEADERS
    while True:
        joined = staged(_round(shapes, size), "clusters")
        own = joined.where(F.col("cluster").isNotNull()).select("shape", "cluster")
        found = own if found is None else found.unionByName(own)
        shapes = joined.where(F.col("cluster").isNull()).select("home", "shape", "n", "tree")
        if shapes.isEmpty():
            return found
        size = min(MORE * size, MOST)


def _round(shapes: DataFrame, size: int) -> DataFrame:
    """(home, shape, n, tree, cluster): each tree against as many leaders of its home, in lists of about ``TREES`` trees or as many as leaders."""
    order = Window.partitionBy("home").orderBy(F.desc("n"), "shape")
    first = shapes.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    leaders = first.groupBy("home").agg(F.array_sort(F.collect_list(F.struct("place", "shape", "tree"))).alias("leaders"))
    lists = shapes.groupBy("home").agg(F.ceil(F.count("*") / max(TREES, size)).alias("lists"))
    dealt = shapes.join(lists, "home").groupBy("home", F.pmod("shape", "lists").alias("list")).agg(F.collect_list(F.struct("shape", "n", "tree")).alias("trees"))
    leaders = leaders.join(lists, "home").select("home", "leaders", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("lists") - 1)).alias("list"))  # so lists of a home are dealt over tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                (r,) = batch.slice(at, 1).to_pylist()
                known, trees = Leaders([(e["shape"], json.loads(e["tree"])) for e in r["leaders"]]), r["trees"]
                found = [known.cluster_of(e["shape"], json.loads(e["tree"])) for e in trees]
                left = [e["tree"] if c is None else None for e, c in zip(trees, found, strict=True)]
                columns = [[r["home"]] * len(trees), [e["shape"] for e in trees], [e["n"] for e in trees], left, found]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string(), pa.int64()], strict=True)], names=["home", "shape", "n", "tree", "cluster"])

    return dealt.join(leaders, ["home", "list"]).select("home", "trees", "leaders").mapInArrow(run, "home bigint, shape bigint, n bigint, tree string, cluster bigint")


BLOCK = [("id", pa.int64(), T.LongType()), ("text", pa.string(), T.StringType()), ("inside", pa.bool_(), T.BooleanType()), ("heading", pa.bool_(), T.BooleanType())]
PLACE = [("path", pa.int64(), T.LongType()), ("first", pa.int32(), T.IntegerType()), ("last", pa.int32(), T.IntegerType())]


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` without html, with text and n_chars."""
    wrappers = staged(induce_wrappers(pages, url, html), "wrappers")
    host, shape, known, template, region, blocks, places, text, n_chars = unused(pages, "_host", "_shape", "_known", "_template", "_region", "_blocks", "_places", "text", "n_chars")
    kept = [c for c in pages.columns if c != html]
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], host_of(F.col(url)).alias(host), F.col(html).cast("string").alias(html))
    arrow = [pa.list_(pa.struct([(n, t) for n, t, _ in made])) for made in (BLOCK, PLACE)]
    spark = [T.ArrayType(T.StructType([T.StructField(n, t) for n, _, t in made])) for made in (BLOCK, PLACE)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                shapes, found, spans = [], [], []
                for h, p in zip(part.column(host), part.column(html), strict=True):
                    page = outline(parse(p.as_py() or ""))
                    shapes.append(digest(digest(h.as_py()), page.shape))
                    found.append([b._asdict() for b in page.blocks])
                    spans.append([{"path": page.paths[k], "first": a, "last": z} for k, a, z in page.places])
                own = part.select(kept)
                columns = [*own.columns, pa.array(shapes, pa.int64()), pa.array(found, arrow[0]), pa.array(spans, arrow[1])]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([*own.schema, pa.field(shape, pa.int64()), pa.field(blocks, arrow[0]), pa.field(places, arrow[1])]))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = []
                for b, p, t, r in zip(*[part.column(c).to_pylist() for c in (blocks, places, template, region)], strict=True):
                    texts.append(content([Block(**x) for x in b], [tuple(x.values()) for x in p], None if t is None else set(t), r))
                own = part.select(kept)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(texts, pa.string())], schema=pa.schema([*own.schema, pa.field(text, pa.string())]))

    made = [T.StructField(shape, T.LongType()), T.StructField(blocks, spark[0]), T.StructField(places, spark[1])]
    wrappers = wrappers.select(F.col("shape").alias(known), F.col("template").alias(template), F.col("region").alias(region))
    rows = rows.mapInArrow(read, T.StructType([*[pages.schema[c] for c in kept], *made])).join(wrappers, F.col(shape) == F.col(known), "left")
    rows = rows.select(*[F.col(f"`{c}`") for c in kept], blocks, places, template, region)
    rows = rows.mapInArrow(choose, T.StructType([*[pages.schema[c] for c in kept], T.StructField(text, T.StringType())]))
    return rows.withColumn(n_chars, F.length(text).cast("long"))
