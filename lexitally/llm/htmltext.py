"""Main text of web pages by wrapper induction.

A page becomes a tree of blocks, without what its markup declares to be no article: menus, forms,
scripts and the like. Every page of a host is aligned with a typical page of the host, and with one
of those of the host that are laid out like it, by simple tree matching. Blocks of such a page which
the others repeat word for word are template, blocks whose text varies are slots for content; the
templates are taken out of every page.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, OrderedDict
from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

VOTES = 5        # aligned pages that make a template, at least
CONSTANT = 0.5   # share of them that repeat a block
LEVELS = 2       # levels of blocks that make a layout
LINKS = 0.7      # share of link text from which a block of a page without article is a menu
KNOWN = 1 << 20  # weights of pairs of blocks that are remembered while two pages are matched
FEW = 1 << 14    # cells of an alignment that are quicker one by one
COPY = 0.8       # share of length and pairs of words in its own blocks from which a page is a near copy, no evidence

# Elements by their part in a page.
RAW = "script style textarea title noscript template svg math"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup
    option p pre search section select summary table tbody td tfoot th thead tr ul""".split())
DROPPED = set("""nav footer aside form button select option iframe object embed canvas audio video dialog menu
    search fieldset label input""".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
PARTS = set("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav
    navbar navigation menu breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent gdpr notice
    alert popup modal overlay newsletter subscribe subscription signup login search share sharing social related
    recommended recommendations pagination pager toolbar widget copyright disclaimer comment comments commentlist
    disqus reply replies respond skip trending popular topbar logo tagline""".split())
COMMENTS = set("comment comments commentlist disqus reply replies".split())
# A start tag that closes an open element: the first ones close those behind them.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tr", "td", "th"}}

_ATTRIBUTES = r"""(?=[\s/>])(?:[^>"']|"[^"]*"|'[^']*')*"""
# Foreign elements may end in their own tag, the others never do.
_HIDDEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:svg|math){_ATTRIBUTES}/>|<({'|'.join(RAW.split())}){_ATTRIBUTES}>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^"'>])*+|[^>]*)>|<[!?][^>]*>""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
# Words; in scripts without blanks between them every character is one.
_UNSPACED = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{_UNSPACED}]|[^\s{_UNSPACED}]+")
_NAMED = re.compile(r"\b(?:class|id|role|hidden|style|aria-hidden)\b", re.I)


class Node:
    __slots__ = ("tag", "parent", "children", "dropped")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False):
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.children: list[Node | str] = []


def _boilerplate(tag: str, attributes: str, inside: Node) -> bool:
    """Whether the markup says that an element is no part of the article."""
    if tag in DROPPED:
        return True
    if tag == "header" and not _within(inside, ("article", "main")):
        return True
    if not attributes or not _NAMED.search(attributes):
        return False
    found = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)}
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(
            r"display\s*:\s*none", found.get("style", "")):
        return True
    parts = set(re.split(r"[^a-z0-9]+", f"{found.get('class', '')} {found.get('id', '')}"))
    if tag in ("html", "body", "main", "article"):
        return tag == "article" and bool(parts & COMMENTS)
    if "header" in parts and tag not in ("h1", "h2", "h3", "h4", "h5", "h6") and not _within(inside, ("article", "main")):
        return True
    return bool(parts & PARTS) or found.get("role", "") in ROLES


def _within(node: Node | None, tags: tuple[str, ...]) -> bool:
    while node is not None:
        if node.tag in tags:
            return True
        node = node.parent
    return False


def parse(page: str) -> Node:
    """Tree of a page, end tags supplied where they are left out."""
    root = at = Node("html", None)
    end = 0
    page = _HIDDEN.sub("", page)
    for m in _TAG.finditer(page):
        if m.start() > end:
            at.children.append(page[end:m.start()])
        end = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            up = at
            while up is not root and up.tag != tag and not (tag not in BLOCKS and up.tag in BLOCKS):
                up = up.parent
            if up is not root and up.tag == tag:
                at = up.parent
            continue
        if tag in ("html", "head", "body"):
            continue
        if tag in BLOCKS:
            up = at
            while up is not root and up.tag != "p" and up.tag not in BLOCKS:
                up = up.parent
            if up.tag == "p":
                at = up.parent
        if tag in CLOSES:
            up = at
            while up is not root and (up.tag in CLOSES[tag] or up.tag not in BLOCKS):
                if up.tag in CLOSES[tag]:
                    at = up.parent
                up = up.parent
        node = Node(tag, at, _boilerplate(tag, m[3], at))
        at.children.append(node)
        if tag not in VOID and not m[3].endswith("/"):
            at = node
    at.children.append(page[end:])
    return root


class Block:
    """A block of the article: its tag, its own text and the blocks in it."""

    __slots__ = ("tag", "text", "children", "number")

    def __init__(self, tag: str):
        self.tag, self.text = tag, ""
        self.children: list[Block] = []
        self.number = -1

    def all(self):
        stack = [self]
        while stack:
            block = stack.pop()
            yield block
            stack += reversed(block.children)


def _blocks(root: Node) -> Block:
    """Blocks below a node. Text between the blocks in a block is a block of its own, `#`."""
    top = Block(root.tag)
    stack: list[tuple[Block, list, int, list[str]]] = []
    own, children, at, line = top, root.children, 0, []

    def end_line() -> None:
        if line and (text := " ".join(html.unescape("".join(line)).split())):
            part = Block("#")
            part.text = text
            own.children.append(part)
        line.clear()

    while True:
        if at == len(children):
            if not stack:
                break
            if own is not stack[-1][0]:
                end_line()
                _simplify(own)
            own, children, at, line = stack.pop()
            continue
        child = children[at]
        at += 1
        if isinstance(child, str):
            line.append(child)
        elif child.dropped:
            if child.tag in BLOCKS:
                end_line()
        elif child.tag in BLOCKS:
            end_line()
            block = Block(child.tag)
            own.children.append(block)
            stack.append((own, children, at, line))
            own, children, at, line = block, child.children, 0, []
        else:
            if child.tag == "br":
                line.append(" ")
            # Inline elements go on with the line of their block.
            stack.append((own, children, at, line))
            children, at = child.children, 0
    end_line()
    _simplify(top)
    return top


def _simplify(block: Block) -> None:
    """A block of nothing but text holds it itself."""
    if len(block.children) == 1 and block.children[0].tag == "#":
        block.text, block.children = block.children[0].text, []


def _size(node: Node) -> int:
    """Characters of an element without what is dropped."""
    total, stack = 0, [node]
    while stack:
        for child in stack.pop().children:
            if isinstance(child, str):
                total += len(child)
            elif not child.dropped:
                stack.append(child)
    return total


def _find(root: Node, tag: str) -> list[Node]:
    """Outermost elements of a tag that are not dropped."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.tag == tag:
            found.append(node)
            continue
        stack += [c for c in node.children if not isinstance(c, str) and not c.dropped]
    return found


def _mostly_links(root: Node) -> bool:
    """Whether an element's text is mostly that of links."""
    total, links, stack = 0, 0, [(root, False)]
    while stack:
        node, linked = stack.pop()
        linked = linked or node.tag == "a"
        text = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        total, links = total + text, links + linked * text
        stack += [(c, linked) for c in node.children if not isinstance(c, str) and not c.dropped]
    return total > 0 and links >= LINKS * total


def _drop_links(root: Node, whole: Sequence[Node] = ()) -> None:
    """Drop the blocks whose text is mostly that of links: menus and lists of other pages. The
    elements in `whole` stay as they are."""
    inside, holding = {id(n) for n in whole}, set()
    for up in whole:
        while up is not None:
            holding.add(id(up))
            up = up.parent
    order, stack = [], [(root, False)]
    while stack:
        node, linked = stack.pop()
        linked = linked or node.tag == "a"
        order.append((node, linked))
        if id(node) not in inside:
            stack += [(c, linked) for c in node.children if not isinstance(c, str) and not c.dropped]
    size: dict[int, tuple[int, int]] = {}
    for node, linked in reversed(order):
        if id(node) in inside:
            size[id(node)] = 0, 0
            continue
        text = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        inner = [size[id(c)] for c in node.children if not isinstance(c, str) and not c.dropped]
        total = text + sum(t for t, _ in inner)
        links = (text if linked else 0) + sum(k for _, k in inner)
        size[id(node)] = total, links
        if node is not root and id(node) not in holding and node.tag in BLOCKS and total and links >= LINKS * total:
            node.dropped = True
            size[id(node)] = 0, 0


def _marked(found: list[Node], best: Node) -> Node:
    """The main element around the longest article, else that article and those beside it, without
    what is mostly links: teasers and lists."""
    for node in found:
        if node is not best and _mostly_links(node):
            node.dropped = True
    up = best.parent
    while up is not None and up.tag != "main":
        up = up.parent
    if up is not None:
        _drop_links(up, [n for n in found if not n.dropped])
        return up
    beside = [n for n in best.parent.children if not isinstance(n, str) and n.tag == "article" and not n.dropped]
    if len(beside) == 1:
        return best
    several = Node("article", None)
    several.children += beside
    return several


def article(page: str) -> Block:
    """Blocks of the page's article: its longest article element with those beside it, or the main
    element around them, else its main element, else all but what is mostly links."""
    root = parse(page)
    for tag in ("article", "main"):
        if found := _find(root, tag):
            best = max(found, key=_size)
            if _size(best) > 0:
                return _numbered(_blocks(_marked(found, best) if tag == "article" else best))
    _drop_links(root)
    return _numbered(_blocks(root))


def _numbered(top: Block) -> Block:
    for i, block in enumerate(top.all()):
        block.number = i
    return top


def match(a: Block, b: Block) -> list[tuple[Block, Block]]:
    """Pairs of simple tree matching: equal tags, order and ancestry kept, as many as can be; a pair
    with the same text counts twice. Trees of any depth and breadth: nothing recurses, and of a table
    of n by m children no more than about sqrt(n) rows are held."""
    if a.tag != b.tag:
        return []
    known: dict[tuple[int, int], int] = {}
    pairs, waiting = [], [(a, b)]
    if not a.children or not b.children:
        return waiting
    while waiting:
        x, y = waiting.pop()
        pairs.append((x, y))
        if x.children and y.children:
            inner = {(i, j): _weight(c, d, known) for i, j, c, d in _inner(x, y)}
            for i, j in _aligned(x.children, y.children, inner):
                pair = x.children[i], y.children[j]
                (waiting if pair[0].children and pair[1].children else pairs).append(pair)
    return pairs


def _own(x: Block, y: Block) -> int:
    return 1 + (x.text != "" and x.text == y.text)


def _inner(x: Block, y: Block) -> Iterator[tuple[int, int, Block, Block]]:
    """Pairs of children that both have children, with their places."""
    others = [(j, d) for j, d in enumerate(y.children) if d.children]
    for i, c in enumerate(x.children if others else ()):
        if c.children:
            for j, d in others:
                if c.tag == d.tag:
                    yield i, j, c, d


def _weight(a: Block, b: Block, known: dict[tuple[int, int], int]) -> int:
    """Weight of the best matching of two trees with the same tag. `known` keeps those met on the
    way, up to KNOWN of them; others are worked out again when they are asked for."""
    if (found := known.get((id(a), id(b)))) is not None:
        return found
    frames = [(a, b, _inner(a, b), {})]
    place: list[tuple[int, int]] = []
    while True:
        x, y, rest, inner = frames[-1]
        for i, j, c, d in rest:
            if (found := known.get((id(c), id(d)))) is None:
                place.append((i, j))
                frames.append((c, d, _inner(c, d), {}))
                break
            inner[i, j] = found
        else:
            frames.pop()
            total = _own(x, y) + (_heaviest(x.children, y.children, inner) if x.children and y.children else 0)
            if len(known) < KNOWN:
                known[id(x), id(y)] = total
            if not frames:
                return total
            frames[-1][3][place.pop()] = total


def _row(above: list[int], i: int, x: Block, ys: list[Block], inner: dict[tuple[int, int], int]) -> list[int]:
    """Weights of the best alignments with the first 0, 1, ... of `ys` when child `x` comes in too."""
    row, left, tag, text = [0], 0, x.tag, x.text
    for j, y in enumerate(ys):
        if above[j + 1] > left:
            left = above[j + 1]
        if tag == y.tag:
            weight = above[j] + (inner[i, j] if (i, j) in inner else 2 if text == y.text != "" else 1)
            if weight > left:
                left = weight
        row.append(left)
    return row


class _Rows:
    """The same rows by whole arrays."""

    def __init__(self, xs: list[Block], ys: list[Block], inner: dict[tuple[int, int], int]):
        self.inner: dict[int, list[tuple[int, int]]] = {}
        for (i, j), weight in inner.items():
            self.inner.setdefault(i, []).append((j, weight))
        codes: dict[tuple[str, str], int] = {}
        code = lambda kind, side: np.array([codes.setdefault((kind, getattr(b, kind)), len(codes)) for b in side])
        self.tags, self.texts = ([code(kind, side) for side in (xs, ys)] for kind in ("tag", "text"))
        self.told = np.array([b.text != "" for b in ys])

    def __call__(self, above: np.ndarray, i: int) -> np.ndarray:
        weight = (self.tags[1] == self.tags[0][i]) * (1 + ((self.texts[1] == self.texts[0][i]) & self.told))
        for j, inner in self.inner.get(i, ()):
            weight[j] = inner
        row = np.zeros(len(above), np.int64)
        # What a pair adds is never lost further right, so the best so far runs along the row.
        np.maximum.accumulate(np.maximum(above[1:], np.where(weight > 0, above[:-1] + weight, 0)), out=row[1:])
        return row


def _heaviest(xs: list[Block], ys: list[Block], inner: dict[tuple[int, int], int]) -> int:
    """Weight of the best alignment of two lists of children, given those of inner pairs."""
    if len(xs) * len(ys) <= FEW:
        row = [0] * (len(ys) + 1)
        for i, x in enumerate(xs):
            row = _row(row, i, x, ys, inner)
        return row[-1]
    rows, row = _Rows(xs, ys, inner), np.zeros(len(ys) + 1, np.int64)
    for i in range(len(xs)):
        row = rows(row, i)
    return int(row[-1])


def _back(rows: Sequence, i: int, j: int, found: list[tuple[int, int]], base: int) -> tuple[int, int]:
    """The way back through rows `base` and after, from (i, j) until the first of them or the edge."""
    while i > base and j:
        here, above = rows[i - base], rows[i - base - 1]
        if here[j] == above[j]:
            i -= 1
        elif here[j] == here[j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            found.append((i, j))
    return i, j


def _aligned(xs: list[Block], ys: list[Block], inner: dict[tuple[int, int], int]) -> list[tuple[int, int]]:
    """Places of the children that the best alignment pairs. Of long lists rows are kept at intervals,
    and those between worked out again on the way back."""
    n, m, found = len(xs), len(ys), []
    if n * m <= FEW:
        table = [[0] * (m + 1)]
        for i, x in enumerate(xs):
            table.append(_row(table[i], i, x, ys, inner))
        _back(table, n, m, found, 0)
        return found
    step, rows = math.isqrt(n) + 1, _Rows(xs, ys, inner)
    kept, row = [], np.zeros(m + 1, np.int64)
    for i in range(n):
        if i % step == 0:
            kept.append(row)
        row = rows(row, i)
    i, j = n, m
    while i and j:
        base = (i - 1) // step * step
        some = [kept[base // step]]
        for k in range(base, i):
            some.append(rows(some[-1], k))
        i, j = _back(some, i, j, found, base)
    return found


def _near_copy(own: list[str], others: list[str]) -> bool:
    """Whether two pages' own texts are about as long and the same but for a few words."""
    if not own or not others:
        return not own and not others
    n, m = sum(map(len, own)), sum(map(len, others))
    if min(n, m) < COPY * max(n, m):
        return False
    x, y = _WORD.findall("\n".join(own)), _WORD.findall("\n".join(others))
    least = COPY * max(1, len(x) - 1, len(y) - 1)
    return min(len(x), len(y)) - 1 >= least and (
        Counter(zip(x, x[1:])) & Counter(zip(y, y[1:]))).total() >= least


def votes(page: Block, typical: Block) -> tuple[list[int], list[int], list[str]]:
    """Numbers of the typical page's texts that the page has a place for and of those that it
    repeats, and the page's own texts, all others. No numbers from a near copy: it is told by the
    texts of both that differ, however much of the page is boilerplate."""
    pairs = [(p, t) for p, t in match(page, typical) if t.text]
    same = [(p, t) for p, t in pairs if p.text == t.text]
    here, there = {id(p) for p, _ in same}, {id(t) for _, t in same}
    own = [b.text for b in page.all() if b.text and id(b) not in here]
    if _near_copy(own, [b.text for b in typical.all() if b.text and id(b) not in there]):
        return [], [], own
    return [t.number for _, t in pairs], [t.number for _, t in same], own


def content(page: Block, typical: Block | None, template: set[int], *more: tuple[Block | None, set[int]]) -> str:
    """Texts of the blocks that are no template, of none of the typical pages, in page order."""
    constant = set()
    for other, numbers in ((typical, template), *more):
        if other is not None and numbers:
            constant |= {id(p) for p, t in match(page, other) if t.number in numbers and p.text == t.text}
    return "\n\n".join(b.text for b in page.all() if b.text and id(b) not in constant)


def _number(text: str) -> int:
    """64-bit hash."""
    return int.from_bytes(blake2b(text.encode(errors="surrogatepass"), digest_size=8).digest(), "little", signed=True)


def layout(page: Block) -> int:
    """Hash of the tags of the upper LEVELS of blocks; neighbours that are alike count as one."""
    def tags(block: Block, levels: int) -> str:
        found = [""]
        for child in block.children if levels else ():
            if (own := f"{child.tag}({tags(child, levels - 1)})") != found[-1]:
                found.append(own)
        return " ".join(found)

    return _number(f"{page.tag}({tags(page, LEVELS)})")


# --- tables -----------------------------------------------------------------------------------

def host_of(url: Column) -> Column:
    """Host of an address in lower case, '' without one."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)), F.lit(""))


class _Typical:
    """The blocks of typical pages, of the hosts and layouts met last."""

    def __init__(self):
        self.known: OrderedDict[tuple[str, int | None], Block] = OrderedDict()

    def __call__(self, host: str, kind: int | None, page: str | None) -> Block | None:
        if page is None:
            return None
        if (host, kind) not in self.known:
            if len(self.known) == 64:
                self.known.popitem(last=False)
            self.known[host, kind] = article(page)
        return self.known[host, kind]


def _slices(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield batch.slice(at, 256)


def _laid_out(pages: DataFrame) -> DataFrame:
    """`pages` with the layout of each page that has a host."""
    names = pages.columns
    host, page = names.index("host"), names.index("page")

    def step(batches):
        for some in _slices(batches):
            found = [layout(article(p)) if h and p else None
                     for h, p in zip(some.column(host).to_pylist(), some.column(page).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(found, pa.int64())], [*names, "layout"])

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pages.schema)
    return shared.arrow(pages, step, f"{shape}, layout bigint")


def _typical(pages: DataFrame) -> DataFrame:
    """host, kind, typical: a typical page of each host (no kind) and of each layout that not all
    pages of its host have. There is none where fewer than VOTES others could vote."""
    named = pages.where("host <> '' and page <> ''")
    sizes = shared.settle(_laid_out(named.select("host", "page", F.xxhash64("page").alias("h"))).groupBy(
        "host", "h", "layout", F.length("page").alias("size")).agg(F.count(F.lit(1)).alias("rows")), "sizes")
    ways = lambda df: df.withColumn("kind", F.explode(F.array(F.lit(None).cast("bigint"), "layout")))
    means = shared.settle(ways(sizes).groupBy("host", "kind").agg(
        F.count(F.lit(1)).alias("pages"), (F.sum(F.col("size") * F.col("rows")) / F.sum("rows")).alias("mean")), "means")
    whole = means.where("kind IS NULL").select(F.col("host").alias("all_host"), F.col("pages").alias("all_pages"))
    able = shared.settle(means.where(F.col("pages") > VOTES).join(whole, F.col("host") == F.col("all_host")).where(
        F.col("kind").isNull() | (F.col("pages") < F.col("all_pages"))).select("host", "kind", "mean"), "able").alias("m")
    same = (F.col("s.host") == F.col("m.host")) & F.col("s.kind").eqNullSafe(F.col("m.kind"))
    near = F.struct(F.abs(F.col("size") - F.col("mean")), F.col("h"))
    chosen = shared.settle(ways(sizes).alias("s").join(able, same).groupBy("m.host", "m.kind").agg(
        F.min(near)["h"].alias("h")), "chosen")
    return shared.settle(named.withColumn("h", F.xxhash64("page")).join(chosen, ["host", "h"]).groupBy("host", "kind").agg(
        F.min("page").alias("typical")), "typical")


def _beside(pages: DataFrame, typical: DataFrame, how: str = "left") -> DataFrame:
    """Pages with their layout and the other columns of `typical`: those of the host, and, with
    `own_` before the name, those of the layout."""
    rest = [c for c in typical.columns if c not in ("host", "kind")]
    by_host = typical.where("kind IS NULL").drop("kind")
    by_layout = typical.where("kind IS NOT NULL").select("host", F.col("kind").alias("layout"), *[F.col(c).alias(f"own_{c}") for c in rest])
    return _laid_out(pages).join(by_host, "host", how).join(by_layout, ["host", "layout"], "left")


def _templates(pages: DataFrame, typical: DataFrame) -> DataFrame:
    """host, kind, template: numbers of the constant blocks of the typical pages."""
    def step(batches):
        blocks = _Typical()
        for some in _slices(batches):
            found = []
            for host, kind, page, *others in zip(*(some.column(i).to_pylist() for i in range(5)), strict=True):
                own = article(page)
                for k, other in zip((None, kind), others, strict=True):
                    if other is not None:
                        places, same, texts = votes(own, blocks(host, k, other))
                        if places:
                            found.append((host, k, _number("\n".join(texts)), places, same))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            columns = zip(*found, strict=True) if found else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["host", "kind", "own", "places", "same"])

    # A layout has a typical page only where its host has one.
    rows = _beside(pages.where("host <> '' and page <> ''").select("host", "page"), typical, "inner").select(
        "host", "layout", "page", "typical", "own_typical")
    each = shared.arrow(rows, step, "host string, kind bigint, own bigint, places array<int>, same array<int>")
    # Pages with the same own texts have one vote.
    once = each.groupBy("host", "kind", "own").agg(F.max(F.struct("places", "same")).alias("v")).select("host", "kind", "v.*")
    counted = once.select("host", "kind", F.explode("places").alias("block"), "same").groupBy("host", "kind", "block").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.array_contains("same", F.col("block"))).alias("k"))
    return counted.where((F.col("n") >= VOTES) & (F.col("k") >= CONSTANT * F.col("n"))).groupBy("host", "kind").agg(
        F.sort_array(F.collect_list("block")).alias("template"))


def main_text(df: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """key, url, text, n_chars of every row.

    Blocks are joined by an empty line; white space in a block, a line break included, is one
    space. A null or empty page has an empty text. Pages without a host, and hosts of fewer than
    VOTES different pages, have no template. Rows that repeat are extracted each, and vote once; near
    copies of the typical page, whose own texts have COPY of its length and pairs of words, do not vote.
    A host has a typical page, and one for each layout of more than VOTES of its pages if there are
    several; a page loses the templates of both. Typical is the page nearest to the mean length,
    ties to the smaller hash. No rows, no result. A page is held as a whole with its tree, of any depth
    and breadth. Other columns are not read.
    """
    pages = df.select(F.col(key).alias("key"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"),
                      F.coalesce(F.col(page), F.lit("")).alias("page"))
    typical = _typical(pages.select("host", "page"))
    templates = shared.settle(_templates(pages, typical), "templates").alias("v")
    same = (F.col("t.host") == F.col("v.host")) & F.col("t.kind").eqNullSafe(F.col("v.kind"))
    wrappers = shared.settle(typical.alias("t").join(templates, same).select("t.*", "v.template"), "wrappers")

    def step(batches):
        blocks = _Typical()
        for some in _slices(batches):
            texts = [content(article(own), blocks(host, None, other), set(template or ()),
                             (blocks(host, kind, own_other), set(own_template or ())))
                     for host, kind, own, other, template, own_other, own_template in zip(
                         *(some.column(i).to_pylist() for i in range(2, 9)), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(1), pa.array(texts, pa.string())], ["key", "url", "text"])

    rows = _beside(pages, wrappers).select(
        "key", "url", "host", "layout", "page", "typical", "template", "own_typical", "own_template")
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    found = shared.arrow(rows, step, f"key {kinds['key']}, url {kinds['url']}, text string")
    return found.select(F.col("key").alias(key), F.col("url").alias(url), "text",
                        F.length("text").cast("bigint").alias("n_chars"))
