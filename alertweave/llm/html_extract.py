"""Main text of web pages by a wrapper of the host, induced from all of its pages.

Every page is parsed to a tree of its block elements. Its shape is that tree without texts, where
neighbouring siblings of one structure, as paragraphs or list items, are one node. The shapes of
a host are merged to one reference tree: two trees are aligned by simple tree matching, which
finds the largest set of node pairs that keeps parents and the order of siblings, and what has
no partner is inserted beside its neighbours. Spark merges distinct shapes in groups of bounded
size, then what came of the groups, until a host has one tree; nodes on few pages are left
out on the way, as they cannot be template.

Each shape is aligned with the tree of its host, so that nodes of all pages count together. A node
that has one text wherever it occurs, on more than half of the host's pages, is constant: it is
template. All others are slots, and the content of a page is the text of its slots.

Elements that are no content by their kind (menus, headers, footers, forms and the like) are left
out first. Where a page has article or main elements that hold at least as much text as the slots
outside, these are the content; template inside goes unless it is most of the element, as where
pages repeat one article, and headings stay. On a page without them template goes unless it is
nearly all of the page. Names break the tie for what constancy cannot tell: an element named like
a menu or notice is left out, unless it holds the page's only article or, on a page without
one, most of the text. Inline elements never cut a text.

Trees of any size are aligned by the same matching. Elements below ``DEPTH`` others are aligned as
that ancestor; their texts count with its.

Defined results: null or empty html gives an empty text; a null url or one without a host
belongs to the host "", which has a wrapper like any other; cut off or unclosed markup is read
as far as it goes, a quote that never closes as a character; pages of any length are read whole,
in time that grows with their length; repeated rows repeat their result; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertweave.llm.common import append_columns
from alertweave.operators.lineage import cut

# no part can be read in two ways, so that nothing is read twice
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt "
    "s samp small span strike strong sub sup time tt u var wbr img".split()
)
# an opening tag ends an open element of these kinds that it cannot be inside of
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
BARRIERS = frozenset("ul ol dl table article section div main body html td th".split())
# elements that are not part of an article, and names of those that are left out on a tie
LEFT_OUT_TAGS = frozenset(
    "nav header footer aside form script style noscript template button select textarea iframe "
    "svg title head dialog menu object".split()
)
LEFT_OUT_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer header masthead menu nav navbar navigation newsletter notice popup "
    "promo promoted related replies share sharing sidebar social sponsor sponsored subscribe toolbar "
    "widget".split()
)
# a name that begins so tells about its element, not what it is
NOT_NAMED = frozenset("no has have with without hide is in on off".split())
CONTENT_TAGS = ("article", "main")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# elements that are aligned on their own are inside of fewer others
DEPTH = 64
# sums of pairs of lists that are kept while two trees are matched; more are computed again
KNOWN_SUMS = 500_000
# shapes of a host that one task merges at once, about
MERGED = 32
# on a page without article or main, constant text goes if slots hold one part in so many
PAGE_SHARE = 4
# a node of a merged tree is on more than this part of the pages
SUPPORT = 1 / 16


@dataclass
class Node:
    """An element: parts of its names, its whole names, and its children in order."""

    tag: str
    names: tuple[str, ...] = ()
    whole: tuple[str, ...] = ()
    hidden: bool = False
    children: list[Node | str] = field(default_factory=list)

    @property
    def key(self) -> str:
        return ".".join((self.tag, *self.names))

    def named(self) -> bool:
        """A whole name, or what a compound one ends with, is like that of a menu or notice."""
        parts = [n.split("-") if "-" in n else n.split("_") for n in self.whole]
        return any(
            not LEFT_OUT_NAMES.isdisjoint(("-".join(p), p[-1]))
            for p in parts
            if p[0] not in NOT_NAMED and not (len(p) > 1 and p[-1] == "header")
        )


class Open:
    """The open elements, and where each kind of them is."""

    def __init__(self, root: Node) -> None:
        self.nodes = [root]
        self.places: dict[str, list[int]] = defaultdict(list)

    def push(self, node: Node) -> None:
        self.places[node.tag].append(len(self.nodes))
        self.nodes.append(node)

    def innermost(self, tags: frozenset[str] | set[str]) -> int:
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)

    def close(self, tags: set[str], barriers: frozenset[str] = frozenset()) -> None:
        """End the innermost open element of one of the kinds, and what is open inside it."""
        at = self.innermost(tags)
        if at and at >= self.innermost(barriers):
            for node in self.nodes[at:]:
                self.places[node.tag].pop()
            del self.nodes[at:]


def parse(page: str) -> Node:
    """The tree of a page; unclosed elements end where their parent ends."""
    root = Node("")
    inside = Open(root)
    at = 0
    while at < len(page):
        found = MARKUP.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text:
            inside.nodes[-1].children.append(entities.unescape(text))
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            inside.close({tag})
            continue
        if tag not in INLINE:
            inside.close({"p"}, BARRIERS)
        if tag in ENDS:
            inside.close(ENDS[tag], BARRIERS - ENDS[tag])
        node = Node(tag, *_names(found[3]))
        inside.nodes[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            if tag not in LEFT_OUT_TAGS:
                node.children.append(entities.unescape(page[at : end.start() if end else len(page)]))
            at = end.end() if end else len(page)
        elif tag not in VOID:
            inside.push(node)
    return root


def _names(attributes: str) -> tuple[tuple[str, ...], tuple[str, ...], bool]:
    whole: list[str] = []
    hidden = False
    for name, value in ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        if name.lower() in ("class", "id"):
            whole += entities.unescape(value.strip("\"'")).lower().split()
        hidden = hidden or name.lower() == "hidden"
    parts = {n for name in whole for n in re.split("[_-]+", name) if n and not n.isdigit()}
    return tuple(sorted(parts)), tuple(whole), hidden


@dataclass
class Flat:
    """Elements of a page in page order, inline ones apart, and the blocks of text they own."""

    nodes: list[Node]
    parents: list[int]
    # texts with white space made single, and their elements
    blocks: list[tuple[int, str]]

    def below(self, at: dict[int, int]) -> list[int]:
        """Sums over what is below each element; ``at`` has what each owns itself."""
        out = [at.get(i, 0) for i in range(len(self.nodes))]
        for i in range(len(out) - 1, 0, -1):
            out[self.parents[i]] += out[i]
        return out

    def inherited(self, own: list[bool]) -> list[bool]:
        """Whether an element, or one that it is in, is marked."""
        out = list(own)
        for i in range(1, len(out)):
            out[i] = out[i] or out[self.parents[i]]
        return out


def flatten(root: Node) -> Flat:
    """The elements and blocks of a tree, without elements that are left out by their kind."""
    flat = Flat([root], [0], [])
    parts: list[str] = []

    def flush(owner: int) -> None:
        if text := " ".join("".join(parts).split()):
            flat.blocks.append((owner, text))
        parts.clear()

    # an explicit stack, as pages nest as deep as they like; an item has its block element
    todo: list[tuple[Node | str | None, int]] = [(c, 0) for c in reversed(root.children)]
    while todo:
        item, owner = todo.pop()
        if item is None:
            flush(owner)
        elif isinstance(item, str):
            parts.append(item)
        elif not (item.hidden or item.tag in LEFT_OUT_TAGS):
            if item.tag not in INLINE:
                flush(owner)
                flat.nodes.append(item)
                flat.parents.append(owner)
                todo.append((None, len(flat.nodes) - 1))
                owner = len(flat.nodes) - 1
            todo += [(c, owner) for c in reversed(item.children)]
    flush(0)
    return flat


def chosen(flat: Flat, varies: list[bool]) -> list[int]:
    """Numbers of the blocks of the content; ``varies`` tells slots from template, block by block."""
    varying: dict[int, int] = {}
    for (owner, text), slot in zip(flat.blocks, varies, strict=True):
        varying[owner] = varying.get(owner, 0) + len(text) * slot
    named = [n.named() for n in flat.nodes]
    content = [i for i, n in enumerate(flat.nodes) if n.tag in CONTENT_TAGS]
    if any(named):
        out = flat.inherited(named)
        if not content:
            every: dict[int, int] = {}
            for owner, text in flat.blocks:
                every[owner] = every.get(owner, 0) + len(text)
            weight = flat.below(every)
            named = [x and 2 * w <= weight[0] for x, w in zip(named, weight, strict=True)]
        elif all(out[i] for i in content if flat.nodes[i].tag == "article"):
            held = flat.inherited([n.tag in CONTENT_TAGS for n in flat.nodes])
            lost = sum(w for i, w in varying.items() if held[i] and out[i])
            kept = sum(w for i, w in varying.items() if not out[i])
            if lost > kept or all(out[i] for i in content):
                for i in content:
                    while i:
                        named[i] = False
                        i = flat.parents[i]
    out = flat.inherited(named)
    left = [i for i, (owner, _) in enumerate(flat.blocks) if not out[owner]]
    for tag in CONTENT_TAGS:
        inside = flat.inherited([n.tag == tag for n in flat.nodes])
        held = [i for i in left if inside[flat.blocks[i][0]]]
        size = sum(len(flat.blocks[i][1]) for i in held)
        outside = sum(len(flat.blocks[i][1]) for i in left if varies[i] and not inside[flat.blocks[i][0]])
        if held and size >= outside:
            return held
    return left


# A tree of shapes is [tag, names, pages, children].
Tree = list


def shape_of(flat: Flat) -> tuple[Tree, list[int]]:
    """The shape of a page, and for each of its elements the number of its node, in preorder."""
    n = len(flat.nodes)
    depth = [0] * n
    kids: list[list[int]] = [[] for _ in range(n)]
    stands: list[int] = list(range(n))
    for i in range(1, n):
        parent = stands[flat.parents[i]]
        depth[i] = depth[parent] + 1
        if depth[i] > DEPTH:
            stands[i] = parent
        else:
            kids[parent].append(i)
    structure = [0] * n
    groups: list[list[list[int]]] = [[] for _ in range(n)]
    for i in range(n - 1, -1, -1):
        for k in kids[i]:
            if groups[i] and structure[groups[i][-1][0]] == structure[k]:
                groups[i][-1].append(k)
            else:
                groups[i].append([k])
        below = ",".join(str(structure[g[0]]) for g in groups[i])
        structure[i] = xxhash.xxh64_intdigest(f"{flat.nodes[i].key} {below}")
    number = [0] * n
    root: Tree = []
    todo: list[tuple[list[int], Tree | None]] = [([0], None)]
    made = 0
    while todo:
        members, parent = todo.pop()
        first = flat.nodes[members[0]]
        node: Tree = [first.tag, ".".join(first.names), 1, []]
        for m in members:
            number[m] = made
        made += 1
        if parent is None:
            root = node
        else:
            parent[3].append(node)
        # members have one structure, so their groups of children correspond
        together = [[k for m in members for k in groups[m][j]] for j in range(len(groups[members[0]]))]
        todo += [(g, node) for g in reversed(together)]
    return root, [number[i] for i in stands]


def listed(tree: Tree) -> list[Tree]:
    """The nodes in preorder."""
    out, todo = [], [tree]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += reversed(node[3])
    return out


class Kinds:
    """Numbers for nodes of two trees: equal ones have equal nodes below and names that match alike."""

    def __init__(self, *trees: Tree) -> None:
        self.nodes = [listed(t) for t in trees]
        named = [{(n[0], n[1]) for n in nodes} for nodes in self.nodes]
        self.kinds: dict[int, tuple[int, int, int]] = {}
        self.below: list[list[Tree]] = [[]]
        known: dict[object, int] = {}
        lists: dict[tuple[int, ...], int] = {(): 0}
        for side, nodes in enumerate(self.nodes):
            for node in reversed(nodes):
                own = node[0], node[1]
                # a name that the other tree does not have matches none of its names, whichever it is
                label = known.setdefault(own if own in named[1 - side] else (side, node[0]), len(known))
                kids = tuple(self.kinds[id(k)][2] for k in node[3])
                at = lists.setdefault(kids, len(lists))
                if at == len(self.below):
                    self.below.append(node[3])
                self.kinds[id(node)] = label, at, known.setdefault((label, at, None), len(known))

    def arrays(self, nodes: list[Tree], tags: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of tags, names and lists of children."""
        kinds = [self.kinds[id(n)] for n in nodes]
        rows = [(tags.setdefault(n[0], len(tags)), k[0], k[1]) for n, k in zip(nodes, kinds, strict=True)]
        return tuple(np.array(rows, np.int64).reshape(-1, 3).T)


def aligned(tree: Tree, reference: Tree) -> dict[int, Tree]:
    """By ``id`` of the nodes of ``tree``, their partners in ``reference``.

    Simple tree matching: partners have partners as parents, siblings keep their order, tags
    agree, and the sum over the pairs, two where names agree too, is the largest. Trees of any size
    are matched so. The sums of two lists of children are kept once in so many rows and computed
    again between, so memory grows with the lists, and time with their product.
    """
    kinds = Kinds(tree, reference)
    tags: dict[str, int] = {}
    known: dict[tuple[int, int], int] = {}

    def rows_of(xs: list[Tree], ys: list[Tree]) -> Callable[[int, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """From a row number and the row of sums before it, its weights and the sums with it."""
        x_tags, x_names, x_below = kinds.arrays(xs, tags)
        y_tags, y_names, y_below = kinds.arrays(ys, tags)

        def row(i: int, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            same = y_tags == x_tags[i]
            weights = np.where(same, 1 + (y_names == x_names[i]), 0)
            if x_below[i]:
                places = np.flatnonzero(same & (y_below > 0))
                lists, which = np.unique(y_below[places], return_inverse=True)
                weights[places] += np.array([below(int(x_below[i]), int(b)) for b in lists], np.int64)[which]
            sums = before.copy()
            np.maximum(sums[1:], before[:-1] + weights, out=sums[1:])
            return weights, np.maximum.accumulate(sums, out=sums)

        return row

    def below(a: int, b: int) -> int:
        """The largest sum of two lists of children."""
        if not (a and b):
            return 0
        xs, ys = kinds.below[a], kinds.below[b]
        if len(xs) == len(ys) == 1:
            (label, kids, _), (other, others, _) = kinds.kinds[id(xs[0])], kinds.kinds[id(ys[0])]
            return 1 + (label == other) + below(kids, others) if xs[0][0] == ys[0][0] else 0
        if (a, b) not in known:
            xs, ys, pairs = without_equal_ends(xs, ys)
            total = sum(2 * sizes[id(x)] for x, _ in pairs)
            if xs and ys:
                row, sums = rows_of(xs, ys), np.zeros(len(ys) + 1, np.int64)
                for i in range(len(xs)):
                    sums = row(i, sums)[1]
                total += int(sums[-1])
            # each pair of lists is met again once a level at most
            if len(known) >= KNOWN_SUMS:
                known.clear()
            known[a, b] = total
        return known[a, b]

    def without_equal_ends(xs: list[Tree], ys: list[Tree]) -> tuple[list[Tree], list[Tree], list[tuple[Tree, Tree]]]:
        """Equal last children are partners: no other pair of either weighs more."""
        n = 0
        while n < min(len(xs), len(ys)) and kinds.kinds[id(xs[-1 - n])] == kinds.kinds[id(ys[-1 - n])]:
            n += 1
        ends = list(zip(xs[len(xs) - n :], ys[len(ys) - n :], strict=True))
        return xs[: len(xs) - n], ys[: len(ys) - n], ends

    def best_pairs(xs: list[Tree], ys: list[Tree]) -> list[tuple[Tree, Tree]]:
        xs, ys, out = without_equal_ends(xs, ys)
        if not (xs and ys):
            return out
        row, step = rows_of(xs, ys), math.isqrt(len(xs)) + 1
        sums = np.zeros(len(ys) + 1, np.int64)
        kept = []
        for i in range(len(xs)):
            if i % step == 0:
                kept.append(sums)
            sums = row(i, sums)[1]
        j = len(ys)
        while kept and j:
            first = step * (len(kept) - 1)
            rows = [(None, kept.pop())]
            for i in range(first, min(first + step, len(xs))):
                rows.append(row(i, rows[-1][1]))
            i = len(rows) - 1
            while i and j:
                weights, sums = rows[i]
                before = rows[i - 1][1]
                if weights[j - 1] and sums[j] == before[j - 1] + weights[j - 1]:
                    i, j = i - 1, j - 1
                    out.append((xs[first + i], ys[j]))
                elif sums[j] == before[j]:
                    i -= 1
                else:
                    j -= 1
        return out

    sizes: dict[int, int] = {}
    for node in reversed(kinds.nodes[0]):
        sizes[id(node)] = 1 + sum(sizes[id(k)] for k in node[3])
    out: dict[int, Tree] = {}
    todo = [(tree, reference)]
    while todo:
        a, b = todo.pop()
        out[id(a)] = b
        todo += best_pairs(a[3], b[3])
    return out


def merge_into(reference: Tree, tree: Tree) -> None:
    """Add a tree's pages and the nodes without a partner to ``reference``."""
    partner = aligned(tree, reference)
    todo = [tree]
    while todo:
        a = todo.pop()
        b = partner[id(a)]
        b[2] += a[2]
        rest = iter(b[3])
        kids: list[Tree] = []
        for kid in a[3]:
            mine = partner.get(id(kid))
            if mine is None:
                kids.append(kid)
                continue
            todo.append(kid)
            for other in rest:
                kids.append(other)
                if other is mine:
                    break
        b[3] = [*kids, *rest]


def merged(trees: list[Tree]) -> Tree:
    """One tree of several; nodes on few of the pages are left out."""
    out = trees[0]
    for tree in trees[1:]:
        merge_into(out, tree)
    least = SUPPORT * out[2]
    for node in listed(out):
        node[3] = [k for k in node[3] if k[2] > least]
    return out


def merged_shapes(shapes: DataFrame) -> DataFrame:
    """``host`` and ``tree``, the reference tree of its shapes."""

    def merge(part: pa.Table) -> pa.Table:
        rows = zip(part.column("pages").to_pylist(), part.column("tree").to_pylist(), strict=True)
        trees = []
        for pages, text in sorted(rows, key=lambda r: (-r[0], r[1])):
            tree = json.loads(text)
            for node in listed(tree):
                node[2] = node[2] * pages if node[2] == 1 else node[2]
            trees.append(tree)
        tree = merged(trees)
        one = {"host": [part.column("host")[0].as_py()], "tree": [json.dumps(tree)], "pages": [1]}
        return pa.table(one, pa.schema([("host", pa.string()), ("tree", pa.string()), ("pages", pa.int64())]))

    while True:
        sizes = shapes.groupBy("host").agg(F.ceil(F.count("*") / MERGED).alias("groups"))
        most = sizes.agg(F.max("groups")).first()[0] or 0
        group = F.pmod(F.xxhash64("tree"), F.col("groups")).alias("group")
        dealt = shapes.join(sizes, "host").select("host", "tree", "pages", group)
        shapes = cut(dealt.groupBy("host", "group").applyInArrow(merge, "host string, tree string, pages long"))
        if most <= 1:
            return shapes.select("host", "tree")


@lru_cache(maxsize=256)
def _reference(text: str) -> tuple[Tree, dict[int, int]]:
    tree = json.loads(text)
    return tree, {id(node): i for i, node in enumerate(listed(tree))}


@lru_cache(maxsize=4096)
def places(shape: str, reference: str) -> list[int]:
    """For each node of a shape the number of its partner in the reference tree, or -1."""
    tree, numbers = _reference(reference)
    own = json.loads(shape)
    partner = aligned(own, tree)
    return [numbers[id(partner[id(node)])] if id(node) in partner else -1 for node in listed(own)]


def node_texts(page: str) -> tuple[str, dict[int, int]]:
    """The shape of a page, and a hash of the text that each node of it owns."""
    flat = flatten(parse(page))
    tree, number = shape_of(flat)
    texts: dict[int, list[str]] = {}
    for owner, text in flat.blocks:
        texts.setdefault(number[owner], []).append(text)
    digests = {i: xxhash.xxh64_intdigest("\n".join(t).encode("utf-8", "surrogatepass")) for i, t in texts.items()}
    return json.dumps(tree), {i: _signed(d) for i, d in digests.items()}


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def extract(page: str, reference: str | None, template: frozenset[int]) -> str:
    """The content of one page, read with its host's tree and the numbers of template nodes."""
    flat = flatten(parse(page))
    varies = [True] * len(flat.blocks)
    if reference and template:
        tree, number = shape_of(flat)
        place = places(json.dumps(tree), reference)
        varies = [place[number[owner]] not in template for owner, _ in flat.blocks]
    content = chosen(flat, varies)
    if not all(varies):
        inside = flat.inherited([n.tag in CONTENT_TAGS for n in flat.nodes])
        owners = {i: flat.blocks[i][0] for i in content}
        kept = [i for i in content if varies[i] or inside[owners[i]] and flat.nodes[owners[i]].tag in HEADINGS]
        slots = sum(len(flat.blocks[i][1]) for i in content if varies[i])
        fixed = sum(len(flat.blocks[i][1]) for i in content if not varies[i])
        whole = all(inside[owners[i]] for i in content)
        if fixed <= slots * (1 if whole else PAGE_SHARE):
            content = kept
    return " ".join(flat.blocks[i][1] for i in content)


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


def wrappers(pages: DataFrame) -> DataFrame:
    """``host``, its reference ``tree``, and ``template``, the numbers of its constant nodes.

    Texts are counted per host, node and text first, so no task holds a host.
    """

    def start():
        def work(texts):
            rows = [node_texts(t or "") for t in texts]
            nodes = [[{"node": i, "text": d} for i, d in found.items()] for _, found in rows]
            return [[shape for shape, _ in rows], nodes]

        return work

    fields = "tree string, nodes array<struct<node: int, text: long>>"
    placed = pages.select("html", host_of(F.col("url")).alias("host"))
    read = cut(append_columns(placed, "html", ["host"], fields, start))
    shapes = cut(read.groupBy("host", "tree").agg(F.count("*").alias("pages")))
    # the tree of a host's only page tells nothing
    several = shapes.groupBy("host").agg(F.sum("pages").alias("of")).filter("of > 1")
    trees = merged_shapes(shapes.join(several.select("host"), "host", "left_semi"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("tree").to_pylist(), batch.column("reference").to_pylist(), strict=True)
            found = pa.array([places(*pair) for pair in both], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("tree"), found], ["host", "tree", "place"])

    references = trees.withColumnRenamed("tree", "reference")
    mapped = shapes.join(references, "host").select("host", "tree", "reference")
    mapped = cut(mapped.mapInArrow(align, "host string, tree string, place array<int>"))
    each = read.select("host", "tree", F.explode("nodes").alias("n"))
    each = each.groupBy("host", "tree", "n").agg(F.count("*").alias("pages"))
    at = each.join(mapped, ["host", "tree"]).select("host", F.expr("place[n.node]").alias("node"), "n.text", "pages")
    texts = at.filter("node >= 0").groupBy("host", "node", "text").agg(F.sum("pages").alias("pages"))
    nodes = texts.groupBy("host", "node").agg(F.count("*").alias("texts"), F.sum("pages").alias("pages"))
    constant = nodes.join(several, "host").filter("texts = 1 and pages > 1 and 2 * pages > of")
    # more than half of the pages have each, so they are no more than twice a page's nodes
    held = constant.groupBy("host").agg(F.collect_list("node").alias("template"))
    return trees.join(held, "host")


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``host`` and ``text`` of every page."""
    pages = pages.select("page_id", "url", "html")
    learned = cut(wrappers(pages))
    placed = pages.withColumn("host", host_of(F.col("url"))).join(learned, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("html", "tree", "template")]
            texts = [extract(h or "", r, frozenset(t or ())) for h, r, t in zip(*columns, strict=True)]
            kept = [batch.column(c) for c in ("page_id", "url", "host")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], ["page_id", "url", "host", "text"])

    page_id = pages.schema["page_id"].dataType.simpleString()
    return placed.mapInArrow(run, f"page_id {page_id}, url string, host string, text string")
