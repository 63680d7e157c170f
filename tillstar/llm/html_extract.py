"""Main text of web pages by wrappers induced per host.

A page becomes a tree of its block elements. The trees of a host are aligned by simple tree matching with a reference
page of the host, one for each frequent shape: nodes that keep their text on nearly all pages are template, the others are
slots. The text of every page is its slots that are not mostly links. Elements that are furniture by nature (menus, forms,
adverts, comments and the like) never count.

Article and main elements are a feature of that choice: their content is a single slot, so copies of an article can't turn it
into template, and beside them only nodes count that the host's pages show to be slots.

Every page votes on its host's template; the votes are added up before they meet.

A null or empty page has empty text, like one without content. A page without a host is its own host's reference
together with all such pages. Repeated rows are extracted alike; extra columns are ignored.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Callable, Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.textops import slices
from tillstar.sources.workspace import persisted

#: A node is template when its text is the reference's on so many of the pages that have it, and on so many pages at least.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.9, 3
#: Share of a block's characters in links above which it is a menu.
LINK_SHARE = 0.5
#: Children whose rows of an alignment's table are held at once; others are made anew from every so many. It bounds memory and changes no result.
MOST_NODES = 400
#: Open elements above which a further one becomes a sibling of the last, as in browsers.
MOST_OPEN = 512

RAW = frozenset("script style noscript template textarea title svg iframe select object canvas math xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rt rp s samp small span strike strong sub sup time tt u var wbr img br".split()
)
FURNITURE = frozenset("nav header footer aside form button menu dialog head fieldset".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement adverting sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert popup modal overlay "
    "sidebar widget menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments reply replies respond discussion disqus "
    "share sharing social related recommended newsletter subscribe signup login search toolbar pagination pager copyright disclaimer hidden".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIERS = frozenset("html body table td th ul ol dl div section article main aside nav header footer form blockquote".split())

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")


class Node:
    __slots__ = ("tag", "key", "furniture", "main", "items")

    def __init__(self, tag: str, attributes: str = "", inside: Node | None = None) -> None:
        self.tag, self.items = tag, []
        named = {(m[1] or m[5]).lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes else {}
        self.key = f"{tag}.{named.get('class', '')}"
        self.main = tag in ("article", "main") or named.get("role") == "main" or named.get("itemprop") == "articleBody"
        names = re.split(r"[^a-z0-9]+", f"{named.get('class', '')} {named.get('id', '')}".lower())
        hidden = "hidden" in named or named.get("aria-hidden") == "true" or "display:none" in named.get("style", "").replace(" ", "").lower()
        marked = tag not in ("html", "body") and (not NAMES.isdisjoint(names) or named.get("role") in ROLES or hidden)
        self.furniture = tag in FURNITURE or marked
        if self.furniture:
            self.main = False


def parse(page: str) -> Node:
    """Tree of block elements; inline text is (text, of which in links). Unclosed and misplaced tags are mended as browsers do, roughly."""
    root = Node("#page")
    stack, links, at, n = [root], 0, 0, len(page)

    def say(text: str) -> None:
        if text:
            stack[-1].items.append((html.unescape(text), links > 0))

    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag not in INLINE and any(x.tag == tag for x in stack[1:]):
                links = 0
                while stack.pop().tag != tag:
                    pass
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in INLINE:
            if tag == "a":
                links = 1
            elif tag == "br":
                say(" ")
            continue
        closes = {"p"} if tag in CLOSES_P else set()
        closes |= SAME_CLOSES.get(tag, set())
        if closes:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closes:
                    del stack[i:]
                    links = 0
                    break
                if stack[i].tag in BARRIERS and not (tag == "tr" and stack[i].tag in ("td", "th")):
                    break
        if tag in VOID:
            stack[-1].items.append(Node(tag))
            continue
        node = Node(tag, m[3])
        if len(stack) >= MOST_OPEN:
            stack.pop()
        stack[-1].items.append(node)
        if not m[3].endswith("/"):
            stack.append(node)
    return root


def blocks(node: Node, inside_main: bool = False, silent: frozenset[int] = frozenset()) -> list[tuple[str, int]]:
    """Texts of the blocks below a node in page order, with their characters in links; furniture and the own text of silent nodes are left out."""
    out: list[tuple[str, int]] = []
    text, linked = [], 0

    def close() -> None:
        nonlocal text, linked
        joined = " ".join("".join(text).split())
        if joined:
            out.append((joined, linked))
        text, linked = [], 0

    for item in node.items:
        if isinstance(item, tuple):
            if id(node) in silent:
                continue
            text.append(item[0])
            linked += len(item[0]) * item[1]
        elif item.tag in ("td", "th"):
            text.append(" " + " ".join(b[0] for b in blocks(item, inside_main, silent)) + " ")
        else:
            close()
            if item.furniture:
                if item.tag == "header" and inside_main:
                    out.extend(b for x in item.items if isinstance(x, Node) and x.tag in ("h1", "h2") for b in blocks(x, True))
            else:
                out.extend(blocks(item, inside_main or item.main, silent))
    close()
    return out


def article(node: Node) -> list[str] | None:
    """Blocks of the innermost main element with most text; one inside a wrapper named like furniture only if there is no other."""
    return _article(node, False) or _article(node, True)


def _article(node: Node, anywhere: bool) -> list[str] | None:
    best: list[str] | None = None
    for item in node.items:
        if isinstance(item, Node) and (not item.furniture or anywhere and item.tag in ("div", "section")):
            found = _article(item, anywhere)
            if found is None and item.main:
                found = [b for b, _ in blocks(item, True)]
            if found is not None and (best is None or sum(map(len, found)) > sum(map(len, best))):
                best = found
    return best


def page_tree(page: str) -> Node:
    """Tree of a page; wrappers named like furniture are opened where an article is in no other place, for the article only."""
    root = parse(page)
    if not _article(root, False) and _article(root, True):
        _open_wrappers(root)
    return root


def _open_wrappers(node: Node) -> bool:
    """True if a main element is below."""
    leading = [x for x in node.items if isinstance(x, Node) and (not x.furniture or x.tag in ("div", "section")) and (_open_wrappers(x) or x.main)]
    if leading and node.furniture:
        node.furniture, node.items = False, leading
    return bool(leading)


def walk(root: Node) -> Iterator[tuple[int, Node]]:
    """Nodes that are aligned, with their depth, in page order: all but those in furniture and main elements."""
    waiting = [(0, root)]
    while waiting:
        depth, node = waiting.pop()
        yield depth, node
        if not node.main and not node.furniture:
            waiting.extend((depth + 1, x) for x in reversed(node.items) if isinstance(x, Node))


def skeleton(root: Node) -> list[list]:
    """All block elements in page order as [depth, key, own text, characters in links]; a main element is one node without text."""
    out: list[list] = []
    for depth, node in walk(root):
        own = [x for x in node.items if isinstance(x, tuple)]
        text = " ".join("".join(x[0] for x in own).split())
        linked = sum(len(x[0]) for x in own if x[1])
        out.append([depth, "#main" if node.main else "#furniture" if node.furniture else node.key, "" if node.main else text, linked])
    return out


def shape_of(tree: list[list]) -> str:
    """The same for trees of the same elements at the same depths, however often they occur."""
    return blake2b(json.dumps(sorted({(depth, key) for depth, key, *_ in tree})).encode(), digest_size=12).hexdigest()


def _children(nodes: list[list]) -> list[list[int]]:
    below: list[list[int]] = [[] for _ in nodes]
    path: list[int] = []
    for i, (depth, *_) in enumerate(nodes):
        del path[depth:]
        if path:
            below[path[-1]].append(i)
        path.append(i)
    return below


def _shapes(nodes: list[list], below: list[list[int]], numbers: dict[tuple, int]) -> list[int]:
    """Number of each node's subtree by its keys; equal subtrees of all trees that share ``numbers`` have one number."""
    shapes = [0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        shapes[i] = numbers.setdefault((nodes[i][1], *(shapes[x] for x in below[i])), len(numbers))
    return shapes


def _ends(xs: Sequence, ys: Sequence, equal: Callable, head: int = 0, tail: int = 0) -> tuple[int, int]:
    """How many pairs from the left and from the right are equal, beyond those already counted."""
    most = min(len(xs), len(ys))
    while head + tail < most and equal(xs[head], ys[head]):
        head += 1
    while head + tail < most and equal(xs[-1 - tail], ys[-1 - tail]):
        tail += 1
    return head, tail


class _Alignment:
    """Weights of the best order-keeping match of two lists of shapes, row by row; rows in between are made anew when they are needed."""

    def __init__(self, xs: Sequence[int], ys: Sequence[int], weigh: Callable[[int, int], int]) -> None:
        self.xs, self.weigh = xs, weigh
        self.kinds, self.places = np.unique(np.asarray(ys, np.int64), return_inverse=True)
        self.known: dict[int, np.ndarray] = {}
        row, self.kept = np.zeros(len(ys) + 1, np.int32), []
        for p in range(len(xs)):
            if p % MOST_NODES == 0:
                self.kept.append(row)
            row = self._next(row, p)
        self.total = int(row[-1])

    def _next(self, over: np.ndarray, p: int) -> np.ndarray:
        x = self.xs[p]
        if x not in self.known:
            self.known[x] = np.array([self.weigh(x, y) for y in self.kinds.tolist()], np.int32)
        row = over.copy()
        np.maximum(over[1:], over[:-1] + self.known[x][self.places], out=row[1:])
        return np.maximum.accumulate(row, out=row)

    def pairs(self) -> list[tuple[int, int]]:
        found = []
        p, q = len(self.xs), len(self.places)
        while p and q:
            first = (p - 1) // MOST_NODES * MOST_NODES
            rows = [self.kept[first // MOST_NODES]]
            for i in range(first, p):
                rows.append(self._next(rows[-1], i))
            while p > first and q:
                here, over = rows[p - first], rows[p - first - 1]
                if here[q] == over[q]:
                    p -= 1
                elif here[q] == here[q - 1]:
                    q -= 1
                else:
                    p, q = p - 1, q - 1
                    found.append((p, q))
        return found


def match_trees(a: list[list], b: list[list]) -> list[tuple[int, int]]:
    """Pairs of nodes in a largest order-keeping match of two trees whose matched parents have matched keys, for trees of any size.

    Children of equal shape at either end of their lists pair up, those of equal text first: a match without that pair is never larger,
    as neither of the two can find a better partner. What is left between them is aligned by weight. Weights belong to pairs of shapes,
    so a page that repeats its shapes needs few of them.
    """
    if not a or not b or a[0][1] != b[0][1]:
        return []
    below_a, below_b = _children(a), _children(b)
    numbers: dict[tuple, int] = {}
    shapes_a, shapes_b = _shapes(a, below_a, numbers), _shapes(b, below_b, numbers)
    # A shape's number is above those of its children, in either tree.
    keys, inner = [x[0] for x in numbers], [x[1:] for x in numbers]
    sizes: list[int] = []
    for x in inner:
        sizes.append(1 + sum(sizes[y] for y in x))
    weights: dict[tuple[int, int], int] = {}

    def weigh(s: int, t: int) -> int:
        if keys[s] != keys[t]:
            return 0
        return sizes[s] if s == t else weights[s, t] if inner[s] and inner[t] else 1

    def between(s: int, t: int) -> tuple[int, tuple[int, ...], tuple[int, ...]]:
        """Nodes of the children that pair up at the ends, and the children in the middle."""
        xs, ys = inner[s], inner[t]
        head, tail = _ends(xs, ys, int.__eq__)
        ends = sum(sizes[x] for x in xs[:head]) + sum(sizes[x] for x in xs[len(xs) - tail :])
        return ends, xs[head : len(xs) - tail], ys[head : len(ys) - tail]

    # Pairs of shapes that can meet, without recursion as trees are deep; then their weights, from the smallest on.
    waiting, wanted = [(shapes_a[0], shapes_b[0])], set()
    while waiting:
        s, t = waiting.pop()
        if s != t and keys[s] == keys[t] and inner[s] and inner[t] and (s, t) not in wanted:
            wanted.add((s, t))
            _, xs, ys = between(s, t)
            waiting.extend((x, y) for x in set(xs) for y in set(ys))
    for s, t in sorted(wanted):
        ends, xs, ys = between(s, t)
        weights[s, t] = 1 + ends + (_Alignment(xs, ys, weigh).total if xs and ys else 0)

    pairs, meeting = [], [(0, 0)]
    while meeting:
        i, j = meeting.pop()
        pairs.append((i, j))
        xs, ys = below_a[i], below_b[j]
        alike = lambda x, y: shapes_a[x] == shapes_b[y]
        head, tail = _ends(xs, ys, alike, *_ends(xs, ys, lambda x, y: alike(x, y) and a[x][2] == b[y][2]))
        meeting.extend(zip(xs[:head], ys[:head], strict=True))
        meeting.extend(zip(xs[len(xs) - tail :], ys[len(ys) - tail :], strict=True))
        xs, ys = xs[head : len(xs) - tail], ys[head : len(ys) - tail]
        if xs and ys:
            aligned = _Alignment([shapes_a[x] for x in xs], [shapes_b[y] for y in ys], weigh)
            meeting.extend((xs[p], ys[q]) for p, q in aligned.pairs())
    return pairs


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html", 4 << 20):
            found = [skeleton(page_tree(page or "")) for page in part.column("html").to_pylist()]
            trees = pa.array([json.dumps(x, ensure_ascii=False) for x in found], pa.string())
            shapes = pa.array([shape_of(x) if len(x) > 1 else None for x in found], pa.string())
            yield pa.RecordBatch.from_arrays([part.column("page"), part.column("host"), trees, shapes], ["page", "host", "tree", "shape"])


def _shaped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pages with the shapes of their trees."""
    for batch in batches:
        for part in slices(batch, "html", 4 << 20):
            found = [skeleton(page_tree(page or "")) for page in part.column("html").to_pylist()]
            shapes = pa.array([shape_of(x) if len(x) > 1 else None for x in found], pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns, shapes], [*part.schema.names, "shape"])


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and node of its reference, on how many pages of the batch it occurs, and with the reference's text."""
    read: dict[str, list] = {}
    for batch in batches:
        tally: dict[tuple[str, str, int], list[int]] = {}
        for host, target, tree, reference in zip(*(batch.column(c).to_pylist() for c in ("host", "target", "tree", "reference")), strict=True):
            if len(read) > 1000:
                read.clear()
            against = read.setdefault(reference, None) or read.__setitem__(reference, json.loads(reference)) or read[reference]
            own = json.loads(tree)
            for i, j in match_trees(against, own):
                count = tally.setdefault((host, target, i), [0, 0])
                count[0] += 1
                count[1] += against[i][2] == own[j][2]
        keys = list(tally)
        yield pa.RecordBatch.from_pydict(
            {"host": pa.array([k[0] for k in keys], pa.string()), "target": pa.array([k[1] for k in keys], pa.string()), "node": pa.array([k[2] for k in keys], pa.int64()), "n": pa.array([tally[k][0] for k in keys], pa.int64()), "same": pa.array([tally[k][1] for k in keys], pa.int64())}
        )


def slots_of(root: Node, reference: list[list], template: list[int], slots: list[int]) -> list[str]:
    """Blocks of the slots: text of nodes that are neither template nor furniture nor mostly links, and beside a main element known slots only."""
    tree, nodes = skeleton(root), [node for _, node in walk(root)]
    pairs = match_trees(reference, tree)
    fixed, known = set(template), set(slots)
    constant = {j for i, j in pairs if i in fixed and reference[i][2] == tree[j][2]}
    shown = {j for i, j in pairs if i in known or i in fixed}
    beside = bool(article(root))
    silent = frozenset(
        id(nodes[j]) for j, (_, key, text, linked) in enumerate(tree) if key != "#main" and (j in constant or linked > LINK_SHARE * len(text) or beside and j not in shown)
    )
    return [text for text, _ in blocks(root, False, silent)]


def _slot_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    read: dict[str, list] = {}
    for batch in batches:
        for part in slices(batch, "html", 4 << 20):
            texts = []
            for page, reference, template, known in zip(*(part.column(c).to_pylist() for c in ("html", "reference", "template", "slots")), strict=True):
                if len(read) > 1000:
                    read.clear()
                if reference and reference not in read:
                    read[reference] = json.loads(reference)
                texts.append("\n\n".join(slots_of(page_tree(page or ""), read[reference] if reference else [], template or [], known or [])))
            yield pa.RecordBatch.from_arrays([part.column("page"), part.column("url"), pa.array(texts, pa.string())], ["page", "url", "text"])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of pages: id, url, text and n_chars."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"://([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), host.alias("host"), F.col(html_col).cast("string").alias("html"))
    trees = persisted(rows.mapInArrow(_skeletons, "page long, host string, tree string, shape string"), "page_trees", shuffle=False)
    shapes = trees.where("shape is not null").groupBy("host", "shape").agg(F.count("*").alias("n"), F.min(F.struct("page", "tree")).alias("least"))
    shapes = persisted(shapes.select("host", "shape", "n", F.col("least.tree").alias("reference")), "page_shapes", shuffle=False)
    # A reference for each frequent shape of a host, and its most frequent one for its other pages.
    usual = shapes.groupBy("host").agg(F.max(F.struct("n", "shape")).alias("most")).select("host", F.col("most.shape").alias("usual"))
    frequent = (F.col("n") >= TEMPLATE_PAGES) | (F.col("shape") == F.col("usual"))
    references = persisted(shapes.join(usual, "host").where(frequent).select("host", F.col("shape").alias("target"), "reference"), "references", shuffle=False)
    targets = shapes.join(usual, "host").select("host", "shape", F.when(frequent, F.col("shape")).otherwise(F.col("usual")).alias("target"))
    aimed = trees.join(targets, ["host", "shape"]).select("host", "target", "tree")
    counted = "host string, target string, node long, n long, same long"
    votes = aimed.join(references, ["host", "target"]).mapInArrow(_votes, counted).groupBy("host", "target", "node").agg(F.sum("n").alias("n"), F.sum("same").alias("same"))
    fixed = F.col("same") >= TEMPLATE_SHARE * F.col("n")
    learned = votes.where(F.col("n") >= TEMPLATE_PAGES).groupBy("host", "target").agg(F.collect_list(F.when(fixed, F.col("node"))).alias("template"), F.collect_list(F.when(~fixed, F.col("node"))).alias("slots"))
    wrappers = persisted(references.join(learned, ["host", "target"], "left"), "wrappers", shuffle=False)
    wrappers = persisted(targets.join(wrappers, ["host", "target"]).drop("target"), "wrappers_by_shape", shuffle=False)
    shaped = rows.mapInArrow(_shaped, "page long, url string, host string, html string, shape string")
    texts = shaped.join(wrappers, ["host", "shape"], "left").select("page", "url", "html", "reference", "template", "slots").mapInArrow(_slot_texts, "page long, url string, text string")
    text = F.coalesce("text", F.lit(""))
    return texts.select(F.col("page").alias(id_col), F.col("url").alias(url_col), text.alias("text"), F.length(text).cast("long").alias("n_chars"))
