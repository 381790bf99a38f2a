"""Main text of web pages: wrappers induced from pages of one host by simple tree matching."""

from __future__ import annotations

import json
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlake.llm.common import small_batches
from creditlake.settings import stage

#: Pages of a layout that its other pages are aligned with, pages that must agree, and the part of the compared that must.
REFERENCES = 3
LEAST_PAGES = 2
CONSTANT = 0.5
#: Two pages that share more of their text than this are copies and tell nothing about the template.
COPY = 0.5
#: Cells of a table of matches that are held at once; longer lists are halved, with an equally good match.
CELLS = 1_000_000

# Element names of HTML.
RAW = frozenset("script style textarea title noscript template svg iframe object xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
CHROME = frozenset("nav aside footer form button select dialog menu input label head audio video canvas map".split())
CONTENT = frozenset(("article", "main"))
CLOSED_BY = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
             "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
             "option": ("option", ("select",))}
# Words in class, id and role that mark what is no article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar rail widget widgets footer cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments "
    "reply replies respond disqus pagination pager toolbar skip complementary contentinfo search masthead topbar".split()
)
HEADERS = frozenset(("header", "masthead"))
# Words that name a box and may stand beside those in a name inside an article.
BOXES = frozenset("area bar block box button buttons container form item items links list posts section thread wrapper".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_DIGITS = re.compile(r"\d+")


class Node:
    """An element, or a leaf with text."""

    __slots__ = ("tag", "symbol", "children", "text", "drop", "full", "key", "block", "flat")

    def __init__(self, tag: str, symbol: str | None = None, text: str | None = None):
        self.tag, self.symbol, self.text = tag, symbol or tag, text
        self.children: list[Node] = []
        self.drop = False


def _names_chrome(value: str, in_article: bool) -> bool:
    """Whether a class, id or role says that an element is no article.

    Outside an article any word of it may; inside, a name must consist of such words, alone or with the word for a box.
    """
    if not in_article:
        words = {w.lower() for w in _WORD.findall(value)}
        return bool(words & MARKS or words & HEADERS)
    for name in value.split():
        words = {w.lower() for w in _WORD.findall(name)}
        if words & MARKS and words <= MARKS | BOXES:
            return True
    return False


def _marked(tag: str, attributes: str, in_article: bool) -> tuple[str, bool]:
    """The symbol of an element, its name and class without digits, and whether its attributes mark it as no article."""
    symbol, drop = tag, False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value == "true":
            drop = True
        elif name == "style":
            drop |= "display:none" in value.replace(" ", "").lower()
        elif name in ("class", "id", "role"):
            drop |= _names_chrome(value, in_article)
            if name == "class":
                symbol = sys.intern(f"{tag}.{_DIGITS.sub('#', value)}")
    return symbol, drop and tag not in ("html", "body", "article", "main")


def parse(html: str) -> Node:
    """The tree of a page, without raw elements and comments; omitted end tags are supplied."""
    root = Node("html")
    stack, at, size = [root], 0, len(html)
    opened: Counter[str] = Counter()

    def words(raw: str) -> None:
        if raw and (text := unescape(raw) if "&" in raw else raw):
            stack[-1].children.append(Node("#", "#", text))

    def close(i: int) -> None:
        for n in stack[i:]:
            opened[n.tag] -= 1
        del stack[i:]

    while at < size:
        m = _TOKEN.search(html, at)
        if not m:
            words(html[at:])
            break
        words(html[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in CONTENT and tag not in ("body", "html"):
                    break  # a stray end tag does not end the article
            continue
        attributes = m[3] or m[6] or ""
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else size
            continue
        if tag in ("html", "body"):
            continue
        if tag in CONTENT:  # what was left open before an article does not hold it
            while len(stack) > 1 and (stack[-1].tag not in BLOCK or stack[-1].tag in CHROME or stack[-1].tag == "p"):
                close(len(stack) - 1)
        elif tag in BLOCK and opened["p"]:
            i = len(stack) - 1
            while stack[i].tag != "p":
                i -= 1
            close(i)
        if tag in CLOSED_BY:
            ends, within = CLOSED_BY[tag]
            for i in range(len(stack) - 1, 0, -1) if any(opened[e] for e in ends.split()) else ():
                if stack[i].tag in within:
                    break
                if stack[i].tag in ends.split():
                    close(i)
                    break
        in_article = opened["article"] + opened["main"] > 0
        symbol, drop = _marked(tag, attributes, in_article) if attributes else (tag, False)
        node = Node(tag, symbol)
        node.drop = drop or tag in CHROME or tag == "header" and not in_article
        stack[-1].children.append(node)
        if tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
            opened[tag] += 1
    return root


def nodes(root: Node) -> list[Node]:
    """A node and all below it, in page order. Trees of any depth are walked with lists, not by recursion."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo.extend(reversed(n.children))
    return out


def leaves(root: Node) -> list[Node]:
    return [n for n in nodes(root) if n.text is not None]


def _prune(root: Node) -> None:
    """Take out what tags and marks name; a form or box around the article itself stays."""
    order = nodes(root)
    holds: set[int] = set()
    for n in reversed(order):
        for c in n.children:
            if c.tag in CONTENT or id(c) in holds:
                holds.add(id(n))
                break
    for n in order:
        n.children = [c for c in n.children if not c.drop or c.tag in ("form", "header", "div", "section") and id(c) in holds]


def _content(root: Node) -> list[Node]:
    found, todo = [], [root]
    while todo:
        n = todo.pop()
        if n.tag in CONTENT:
            found.append(n)
        else:
            todo.extend(reversed(n.children))
    return found


def _menus(root: Node) -> set[int]:
    """Lists of links: elements whose whole text is in three or more links."""
    links: dict[int, list[int]] = {}
    for n in reversed(nodes(root)):
        own = [0, 0]  # links, and letters outside them
        for c in n.children:
            if c.text is not None:
                own[1] += any(map(str.isalnum, c.text))
            elif c.tag == "a":
                own[0] += 1
            else:
                inner = links[id(c)]
                own[0], own[1] = own[0] + inner[0], own[1] + inner[1]
        links[id(n)] = own
    return {n for n, (inside, outside) in links.items() if inside >= 3 and not outside}


def blocks(html: str) -> Node:
    """The tree of the blocks that may be the article: elements over leaves of clean text, one leaf for each block.

    If the page has main or article elements, only these. Elsewhere, lists of nothing but links are left out.
    """
    root = parse(html)
    _prune(root)
    found = _content(root)
    menus = set() if found else _menus(root)
    out = Node("html")
    for top in found or [root]:
        opened, held = [Node(top.tag, top.symbol)], []

        def close() -> None:
            if text := " ".join("".join(held).split()):
                opened[-1].children.append(Node("#", "#", text))
            held.clear()

        todo: list[Node | None] = top.children[::-1] if id(top) not in menus else []
        while todo:
            n = todo.pop()
            if n is None:  # the end of a block
                close()
                own = opened.pop()
                if own.children:
                    opened[-1].children.append(own)
            elif n.text is not None:
                held.append(n.text)
            elif id(n) in menus:
                close()
            elif n.tag in BLOCK:
                close()
                opened.append(Node(n.tag, n.symbol))
                todo.append(None)
                todo.extend(reversed(n.children))
            else:
                if n.tag in ("br", "td", "th"):
                    held.append(" ")
                todo.extend(reversed(n.children))
        close()
        out.children.append(opened[0])
    return out


def _fill(order: list[Node]) -> None:
    """Fill in the digest of each leaf's text and each element's content, and the weight of a match with an equal one.

    The nodes are in page order; leaves without text have their digest already.
    """
    for n in reversed(order):
        if n.text is not None:
            n.full, n.flat = 2, False
            if n.text:
                n.key, n.block = xxhash.xxh32_intdigest(n.text.encode("utf-8", "surrogatepass")), len(n.text)
        elif len(n.children) == 1:
            c = n.children[0]
            n.full, n.flat, n.key = c.full + 1, c.text is not None, hash((n.symbol, c.key))
        else:
            n.full, n.flat = 1 + sum([c.full for c in n.children]), False
            n.key = hash((n.symbol, *[c.key for c in n.children]))


def layout(tree: Node) -> int:
    """A digest of the classes that a page uses."""
    used = sorted({n.symbol for n in nodes(tree) if "." in n.symbol})
    return xxhash.xxh64_intdigest("\n".join(used).encode("utf-8", "surrogatepass")) >> 1


def pack(tree: Node) -> bytes:
    """The tree of blocks with digests and lengths instead of texts: leaves as two numbers, elements as symbol and children."""
    order = nodes(tree)
    _fill(order)
    flat = [x for n in order for x in ((n.key, n.block) if n.text is not None else (n.symbol, len(n.children)))]
    return zlib.compress(json.dumps(flat, separators=(",", ":")).encode("utf-8", "surrogatepass"), 1)


def skeleton(html: str) -> bytes:
    return pack(blocks(html))


def from_skeleton(packed: bytes) -> Node:
    flat = json.loads(zlib.decompress(packed))
    order: list[Node] = []
    todo: list[list] = []  # open elements and how many children they lack
    for name, number in zip(flat[::2], flat[1::2]):
        if name.__class__ is int:
            n = Node("#", "#", "")
            n.key, n.block = name, number
        else:
            n = Node("", name)
        order.append(n)
        if todo:
            last = todo[-1]
            last[0].append(n)
            last[1] -= 1
            while todo and not todo[-1][1]:
                todo.pop()
        if number and n.text is None:
            todo.append([n.children, number])
    _fill(order)
    return order[0]


def _trim(xs: list[Node], ys: list[Node]) -> tuple[int, int]:
    """How many children at the start, and then at the end, are equal in both lists."""
    most, start, end = min(len(xs), len(ys)), 0, 0
    while start < most and xs[start].key == ys[start].key:
        start += 1
    while end < most - start and xs[-1 - end].key == ys[-1 - end].key:
        end += 1
    return start, end


class _Matching:
    """Weights of the best matches of nodes, each pair of contents once."""

    def __init__(self):
        self.memo: dict[tuple[int, int], int] = {}

    def weight(self, x: Node, y: Node) -> int:
        if x.symbol != y.symbol:
            return 0
        if x.key == y.key:
            return x.full
        if x.text is not None:
            return 1
        if x.flat and y.flat:
            return 2
        at = (x.key, y.key)
        if at not in self.memo:
            xs, ys = x.children, y.children
            start, end = _trim(xs, ys)
            equal = sum([c.full for c in xs[:start]]) + sum([c.full for c in xs[len(xs) - end :]])
            self.memo[at] = 1 + equal + self.rows(xs[start : len(xs) - end], ys[start : len(ys) - end])[-1][-1]
        return self.memo[at]

    def rows(self, xs: list[Node], ys: list[Node], keep: bool = False) -> list[list[int]]:
        """Weights of the best matches of the first children: the last row, or all of them."""
        above = [0] * (len(ys) + 1)
        kept = [above]
        weight = self.weight
        ys = [(y, y.symbol, y.key, y.flat) for y in ys]
        for x in xs:
            symbol, key, flat, left, row, before = x.symbol, x.key, x.flat, 0, [0], 0
            for (y, s, k, f), over in zip(ys, above[1:]):
                if s == symbol:
                    w = before + (x.full if k == key else 2 if flat and f else weight(x, y))
                    if w > left:
                        left = w
                if over > left:
                    left = over
                before = over
                row.append(left)
            above = row
            if keep:
                kept.append(row)
        return kept if keep else [above]


def match(a: Node, b: Node, cells: int = CELLS) -> list[tuple[Node, Node]]:
    """Nodes of two trees that simple tree matching pairs.

    Nodes match if their symbols are equal, children keep their order, and the weight of a match is the number of
    nodes matched below; leaves of equal text weigh two. Equal children at both ends are paired first, which no best
    match forbids, and the table is filled for the rest. A table of more than `cells` is not held: the first list is halved
    where both halves' weights add up to the best, so memory stays linear in the page.
    """
    m, pairs = _Matching(), []
    if a.symbol != b.symbol:
        return pairs
    deepest, depths = 0, [(a, 1)]
    while depths:
        n, d = depths.pop()
        deepest = max(deepest, d)
        depths.extend([(c, d + 1) for c in n.children])
    before = sys.getrecursionlimit()
    sys.setrecursionlimit(max(before, 2 * deepest + 1000))  # weights are found by recursion
    try:
        todo: list[tuple] = [([a], [b])]
        while todo:
            xs, ys = todo.pop()
            start, end = _trim(xs, ys)
            for x, y in [*zip(xs[:start], ys[:start]), *zip(xs[len(xs) - end :], ys[len(ys) - end :])]:
                pairs.extend(zip(nodes(x), nodes(y)))
            xs, ys = xs[start : len(xs) - end], ys[start : len(ys) - end]
            if not xs or not ys:
                continue
            if len(xs) > 1 and len(xs) * len(ys) > cells:
                half = len(xs) // 2
                first, last = m.rows(xs[:half], ys)[0], m.rows(xs[:half - 1 : -1], ys[::-1])[0][::-1]
                j = max(range(len(ys) + 1), key=lambda k: first[k] + last[k])
                todo += [(xs[:half], ys[:j]), (xs[half:], ys[j:])]
                continue
            rows = m.rows(xs, ys, keep=True)
            i, j = len(xs), len(ys)
            while i and j:
                w = m.weight(xs[i - 1], ys[j - 1])
                if w and rows[i][j] == rows[i - 1][j - 1] + w:
                    x, y = xs[i - 1], ys[j - 1]
                    if x.key == y.key:
                        pairs.extend(zip(nodes(x), nodes(y)))
                    else:
                        pairs.append((x, y))
                        if x.children and y.children:
                            todo.append((x.children, y.children))
                    i, j = i - 1, j - 1
                elif rows[i][j] == rows[i - 1][j]:
                    i -= 1
                else:
                    j -= 1
    finally:
        sys.setrecursionlimit(before)
    return pairs


def align(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Leaves of two trees that simple tree matching pairs."""
    return [(x, y) for x, y in match(a, b) if x.text is not None]


def host(url: Column) -> Column:
    """The host of a URL in lower case; null and odd ones share the empty host."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def read_blocks(pages: DataFrame) -> DataFrame:
    """Each page once read: (page_id, url, host, layout, digest, tree, texts), the tree packed without the texts of its leaves."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            found = [blocks(t) for t in b.column(3).to_pylist()]
            packed = [pack(t) for t in found]
            columns = [
                *b.columns[:3],
                pa.array([layout(t) for t in found], pa.int64()),
                pa.array([xxhash.xxh64_intdigest(p) >> 1 for p in packed], pa.int64()),
                pa.array(packed, pa.binary()),
                pa.array([[x.text for x in leaves(t)] for t in found], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "host", "layout", "digest", "tree", "texts"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInArrow(read, "page_id long, url string, host string, layout long, digest long, tree binary, texts array<string>")


def learn_templates(read: DataFrame, references: int = REFERENCES) -> DataFrame:
    """Constant nodes of each layout: (host, layout, templates), with the packed trees of reference pages and their constant leaves.

    `read` is what `read_blocks` gives. A layout is the set of classes that a page uses; pages of a host whose set is shared
    by no more than `LEAST_PAGES` different trees form one more layout together. Each tree is aligned with up to
    `references` other trees of its layout, those with the least digests. A leaf of a reference is constant if at least two and
    half of the trees compared have the same text where it is aligned. Equal trees count once, and pages that share most of
    their text with the reference, being copies of it, are not compared. All pages are counted; only sums for each leaf are
    shuffled after the alignment. Layouts without constant leaves have no row.
    """
    rows = read.where("host != ''").select("host", "layout", "digest", "tree")
    rows = stage(rows.dropDuplicates(["host", "layout", "digest"]), "trees")
    used = F.when(F.count("*") > LEAST_PAGES, F.col("layout")).otherwise(F.lit(-1))
    layouts = rows.groupBy("host", "layout").agg(used.alias("used")).select(F.col("host").alias("h"), F.col("layout").alias("l"), "used")
    layouts = stage(layouts, "layouts")
    rows = rows.join(layouts, (F.col("host") == F.col("h")) & (F.col("layout") == F.col("l"))).select("host", "used", "digest", "tree")
    first = Window.partitionBy("host", "used").orderBy("digest")
    chosen = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= references)
    chosen = chosen.groupBy(F.col("host").alias("h"), F.col("used").alias("u")).agg(F.collect_list(F.struct("digest", "tree")).alias("refs"))
    chosen = stage(chosen.where(F.size("refs") > 1), "references")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int, int], list] = {}
        built: dict[int, tuple[Node, int, dict[int, int]]] = {}

        def flush() -> pa.RecordBatch:
            out = [(*at, n, pages, c) for at, (pages, counts) in sums.items() for n, c in counts.items()]
            types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            columns = [pa.array([x[i] for x in out], t) for i, t in enumerate(types)]
            sums.clear()
            return pa.RecordBatch.from_arrays(columns, names=["host", "used", "ref", "leaf", "pages", "same"])

        for b in small_batches(batches):
            for of, kind, digest, packed, refs in zip(*(b.column(i).to_pylist() for i in range(5))):
                tree = from_skeleton(packed)
                length = sum([x.block for x in leaves(tree)])
                for ref in refs:
                    if ref["digest"] == digest:
                        continue
                    if ref["digest"] not in built:
                        if len(built) > 1000:
                            built.clear()
                        other = from_skeleton(ref["tree"])
                        own = leaves(other)
                        built[ref["digest"]] = other, sum([x.block for x in own]), {id(x): i for i, x in enumerate(own)}
                    other, other_length, numbers = built[ref["digest"]]
                    equal = [(x, y) for x, y in align(tree, other) if x.key == y.key]
                    if sum([x.block for x, _ in equal]) > COPY * min(length, other_length):
                        continue
                    own = sums.setdefault((of, kind, ref["digest"]), [0, {-1: 0}])
                    own[0] += 1
                    for _, y in equal:
                        n = numbers[id(y)]
                        own[1][n] = own[1].get(n, 0) + 1
            if len(sums) > 5000:
                yield flush()
        yield flush()

    met = rows.join(chosen, (F.col("host") == F.col("h")) & (F.col("used") == F.col("u"))).select("host", "used", "digest", "tree", "refs")
    counts = met.mapInArrow(compare, "host string, used long, ref long, leaf int, pages long, same long")
    # Leaf -1 carries the number of pages compared with the reference.
    by = ("host", "used", "ref")
    counts = stage(counts.groupBy(*by, "leaf").agg(F.sum("pages").alias("pages"), F.sum("same").alias("same")), "counts")
    compared = counts.where("leaf < 0").select(*by, F.col("pages").alias("compared"))
    constant = counts.where("leaf >= 0 AND same >= 1").join(compared, list(by))
    constant = constant.where((F.col("same") >= LEAST_PAGES) & (F.col("same") >= CONSTANT * F.col("compared")))
    constant = constant.groupBy(*by).agg(F.collect_list("leaf").alias("leaves"))
    listed = chosen.select(F.col("h").alias("host"), F.col("u").alias("used"), F.explode("refs").alias("x"))
    listed = listed.select("host", "used", F.col("x.digest").alias("ref"), F.col("x.tree").alias("tree"))
    found = constant.join(listed, list(by)).groupBy("host", "used").agg(F.collect_list(F.struct("tree", "leaves")).alias("templates"))
    return found.join(layouts.withColumnRenamed("h", "host"), ["host", "used"]).select("host", F.col("l").alias("layout"), "templates")


def constant_leaves(tree: Node, templates: list[tuple[Node, set[int]]]) -> set[int]:
    """Ids of the leaves that are aligned with constant leaves of a template, given by their ids, and have their text."""
    return {id(x) for other, fixed in templates for x, y in align(tree, other) if x.key == y.key and id(y) in fixed}


def main_text(html: str) -> str:
    """The blocks of a page without a template, joined by two line ends."""
    return "\n\n".join([x.text for x in leaves(blocks(html))])


def extract(pages: DataFrame, references: int = REFERENCES) -> DataFrame:
    """Main text of each page: (page_id, url, text, n_chars).

    Menus, page headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles go by element name and
    by the words of class, id and role; inside an article only by names that say nothing else. What is left is aligned with other
    pages of the host that have the same layout: nodes that stay the same are its template and go too, slots that vary are the
    content. A host with one page, or copies of one, has no template. Pages are read once; trees and texts are written to the
    shared folder. Templates are few and small beside the pages; they meet them by host and layout, and Spark may broadcast
    them by the size of their files.

    A null html is empty and gives an empty text; a null url belongs to no host. Repeated rows stay; an empty table gives an
    empty result. Other columns are not read.
    """
    read = stage(read_blocks(pages), "blocks")
    templates = stage(learn_templates(read, references), "templates").select(F.col("host").alias("h"), F.col("layout").alias("l"), "templates")
    rows = read.join(templates, (F.col("host") == F.col("h")) & (F.col("layout") == F.col("l")), "left")
    # Pages without a template need no tree.
    rows = rows.select("page_id", "url", F.when(F.col("templates").isNotNull(), F.col("tree")).alias("tree"), "texts", "templates")

    def varying(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built: dict[tuple, tuple[Node, set[int]]] = {}

        def template(t: dict) -> tuple[Node, set[int]]:
            at = (t["tree"], tuple(t["leaves"]))
            if at not in built:
                if len(built) > 1000:
                    built.clear()
                root, numbers = from_skeleton(t["tree"]), set(t["leaves"])
                built[at] = root, {id(x) for i, x in enumerate(leaves(root)) if i in numbers}
            return built[at]

        for b in small_batches(batches):
            found = []
            for packed, texts, known in zip(*(b.column(i).to_pylist() for i in (2, 3, 4))):
                if known:
                    tree = from_skeleton(packed)
                    fixed = constant_leaves(tree, [template(t) for t in known])
                    texts = [t for t, x in zip(texts, leaves(tree)) if id(x) not in fixed]
                found.append("\n\n".join(texts))
            columns = [b.column(0), b.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(varying, "page_id long, url string, text string, n_chars long")
