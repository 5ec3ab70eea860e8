"""Main text of web pages by wrapper induction.

Pages of a host are aligned, by simple tree matching, with one page of the host, the pivot. The
pivot's text nodes are the wrapper's slots: a slot whose text is the same on nearly all different
pages is template, a slot that varies is content. Each page is then read through its host's
wrapper: nodes that are aligned with template slots and say the same go, and so do texts the pivot
lacks that nearly all pages with a text at that place have; what varies stays.

What pages mark themselves is known before: menus, headers, footers, sidebars, notices, adverts,
forms and comments (by element, role, class or id) are never content, and where a page has an
``article`` or ``main`` element, the content is inside it. A passage many articles share is text; of
the template only what an element of its own sets apart goes there.
"""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import as_batch, settled, ship

# Fixed values of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
# A start tag closes these open elements, up to the element that bounds the search.
CLOSES = {
    "li": ("li", {"ul", "ol", "menu"}), "dd": ("dd dt", {"dl"}), "dt": ("dd dt", {"dl"}),
    "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}),
    "option": ("option", {"select"}), "tbody": ("tr td th thead", {"table"}), "tfoot": ("tr td th tbody", {"table"})}
# What is never main text.
LEFT_OUT = frozenset(
    "head nav header footer aside form button select dialog menu object svg canvas audio video math".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NAMES = re.compile(
    r"(?:^|(?<=[-_ ]))(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alerts?|popup|"
    r"modal|overlay|newsletter|subscribe|subscription|paywall|signup|login|sidebars?|side|widgets?|related|recommended|"
    r"recommendations|share|sharing|social|breadcrumbs?|menus?|nav|navbar|navigation|header|masthead|footer|copyright|"
    r"comments?|commentlist|disqus|repl(?:y|ies)|respond|discussion|pagination|pager|toolbar|skip|search)(?=$|[-_ ])", re.I)
ARTICLE = ("article", "main")
# Elements that are part of the running text, so that they set nothing apart.
FLOW = frozenset("article main p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption blockquote pre figcaption summary legend".split())

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/><]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/><]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|[^<]+|<", re.S)
MAIN_ROLE = re.compile(r"""\brole\s*=\s*["']?main\b""", re.I)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")

TEMPLATE_SHARE = 0.9
LEAST_PAGES = 5
BROADCAST_HOSTS = 20_000
BROADCAST_BYTES = 64 << 20
#: Pivots a task keeps as trees.
KNOWN_PIVOTS = 256
#: Cells of an alignment held at once.
ALIGN_CELLS = 4_000_000


@dataclass
class Node:
    """An element, or a run of text between block boundaries (label ``#``)."""

    label: str
    left_out: bool = False
    article: bool = False
    text: str = ""
    children: list["Node"] = field(default_factory=list)


def _marked(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in LEFT_OUT and not (tag == "header" and in_article):
        return True
    if not attributes or "=" not in attributes:
        return False
    found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
    if found.get("role", "").lower() in ROLES or found.get("aria-hidden") == "true":
        return True
    if tag in ("html", "body", *ARTICLE):
        return False
    names = [m[0].strip("-_ ").lower() for k in ("class", "id") for m in NAMES.finditer(found.get(k, ""))]
    return any(not (in_article and name == "header") for name in names)


def parse(page: str) -> Node:
    """The page's tree of block elements and text runs; inline elements are part of the runs."""
    root = Node("html")
    stack: list[tuple[str, Node, bool]] = [("html", root, False)]  # tag, block around, inline
    run: list[str] = []
    at, size = 0, len(page)

    def flush() -> None:
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if text:
                stack[-1][1].children.append(Node("#", stack[-1][1].left_out, text=text))

    def pop_to(depth: int) -> None:
        if any(not inline for _, _, inline in stack[depth:]):
            flush()
        del stack[depth:]

    while at < size:
        token = TOKEN.match(page, at)
        at = token.end()
        tag = token[2] or token[5]
        if tag is None:
            text = token[0]
            if text[0] != "<":
                run.append(text)
            elif text == "<" and at < size:
                run.append("&lt;")
            continue
        tag = tag.lower()
        if token[1] or token[4]:
            for depth in range(len(stack) - 1, 0, -1):
                name, _, inline = stack[depth]
                if name == tag:
                    pop_to(depth)
                    break
                if not inline and tag not in BLOCKS:
                    break
            continue
        attributes = token[3] or token[6] or ""
        around = stack[-1][1]
        left_out = around.left_out or _marked(tag, attributes, around.article)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = close.start() if close else size
            continue
        if tag in BLOCKS:
            flush()
            for depth in range(len(stack) - 1, 0, -1):
                name, _, inline = stack[depth]
                if name == "p":
                    del stack[depth:]
                    break
                if not inline:
                    break
            if tag in CLOSES:
                names, bounds = CLOSES[tag]
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] in bounds:
                        break
                    if stack[depth][0] in names.split():
                        del stack[depth:]
                        break
            if tag in ("html", "body"):
                around = stack[-1][1]
                if left_out and not around.left_out:
                    around.left_out = True
                continue
            around = stack[-1][1]
            if tag not in VOID:
                label = "main" if MAIN_ROLE.search(attributes) else tag
                node = Node(label, around.left_out or left_out, around.article or label in ARTICLE)
                around.children.append(node)
                stack.append((tag, node, False))
        elif tag == "br":
            run.append(" ")
        elif tag not in VOID and not attributes.endswith("/"):
            if left_out and not around.left_out:
                flush()
                node = Node(tag, True)
                around.children.append(node)
                stack.append((tag, node, False))
            else:
                stack.append((tag, around, True))
    flush()
    return root


def texts(root: Node) -> list[Node]:
    """Text runs in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.label == "#":
            out.append(node)
        todo.extend(reversed(node.children))
    return out


def _in_articles(root: Node) -> set[int]:
    """Numbers of the text runs inside the page's own article (or else main) elements."""
    found: dict[str, list[int]] = {name: [] for name in ARTICLE}
    number = 0
    todo: list[tuple[Node, frozenset[str]]] = [(root, frozenset())]
    while todo:
        node, inside = todo.pop()
        if node.label == "#":
            for name in inside:
                found[name].append(number)
            number += 1
        elif node.label in ARTICLE and not node.left_out:
            inside = inside | {node.label}
        todo.extend((c, inside) for c in reversed(node.children))
    return set(next((found[name] for name in ARTICLE if found[name]), []))


def skeleton(root: Node) -> str:
    """The tree as lines of depth, label and a short hash of the text, without what is left out."""
    lines, todo = [], [(root, 0)]
    while todo:
        node, depth = todo.pop()
        if node.label == "#":
            shown = "" if node.left_out else blake2b(node.text.encode(), digest_size=6).hexdigest()
            lines.append(f"{depth} # {shown}")
        else:
            lines.append(f"{depth} {node.label}")
        todo.extend((c, depth + 1) for c in reversed(node.children))
    return "\n".join(lines)


class Tree:
    """A skeleton read back: children, text hashes, and the number and the place of each text run.

    A place is a hash of the labels from the root. Trees that share ``shapes`` have equal numbers
    for equal labels (``kind``), for subtrees of equal labels (``shape``) and of equal labels and
    texts (``full``).
    """

    def __init__(self, lines: str, shapes: dict):
        self.labels, self.hashes, self.kids, self.number = [], [], [], {}
        self.place: list[int] = []
        path: list[int] = []
        places: dict[tuple[int, str], int] = {}
        deepest = 0
        for i, line in enumerate(lines.split("\n")):
            depth, label, *shown = line.split(" ")
            del path[int(depth):]
            if path:
                self.kids[path[-1]].append(i)
            key = self.place[path[-1]] if path else 0, label
            if key not in places:
                places[key] = int.from_bytes(blake2b(f"{key[0]} {label}".encode(), digest_size=8).digest(), signed=True)
            self.place.append(places[key])
            path.append(i)
            deepest = max(deepest, len(path))
            self.labels.append(label)
            self.hashes.append(shown[0] if shown else "")
            self.kids.append([])
            if label == "#":
                self.number[i] = len(self.number)
        self.deepest = deepest
        self.kind = [shapes.setdefault(label, len(shapes)) for label in self.labels]
        n = len(self.labels)
        self.shape, self.full, self.size, self.runs = [0] * n, [0] * n, [1] * n, [0] * n
        for i in range(n - 1, -1, -1):
            kids = self.kids[i]
            self.size[i] += sum(self.size[k] for k in kids)
            self.runs[i] = (self.labels[i] == "#") + sum(self.runs[k] for k in kids)
            self.shape[i] = shapes.setdefault((self.labels[i], tuple(self.shape[k] for k in kids)), len(shapes))
            self.full[i] = shapes.setdefault((self.labels[i], self.hashes[i], tuple(self.full[k] for k in kids)), len(shapes))
        self.columns = np.array([self.kind, self.shape, self.full], np.int64)

    def shown(self) -> list[str]:
        """The hash of each text run."""
        return [h for h, label in zip(self.hashes, self.labels, strict=True) if label == "#"]

    def keys(self) -> list[tuple[int, int] | None]:
        """Place and text hash of each text run; none of what is left out."""
        return [(self.place[i], int(self.hashes[i], 16)) if self.hashes[i] else None for i in self.number]


#: What a pair of nodes weighs against a pair of equal text runs.
PAIR = 1 << 31


class Matching:
    """Simple tree matching of two trees: the largest number of node pairs that keep order and nesting,
    and among those with so many pairs one with the most pairs of equal text runs."""

    def __init__(self, a: Tree, b: Tree):
        self.a, self.b, self.known = a, b, {}
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 1000 + 4 * min(a.deepest, b.deepest)))

    def _split(self, x: list[int], y: list[int]) -> tuple[int, int]:
        """Lengths of the common start and end: subtrees of equal labels and texts match as a whole."""
        fa, fb, most = self.a.full, self.b.full, min(len(x), len(y))
        start = 0
        while start < most and fa[x[start]] == fb[y[start]]:
            start += 1
        end = 0
        while end < most - start and fa[x[-1 - end]] == fb[y[-1 - end]]:
            end += 1
        return start, end

    def _whole(self, i: int, j: int) -> int:
        """Weight of subtrees of equal shape: all nodes match, each with its counterpart."""
        size = self.a.size[i]
        equal = sum(map(str.__eq__, self.a.hashes[i:i + size], self.b.hashes[j:j + size]))
        return size * PAIR + equal - (size - self.a.runs[i])

    def _alike(self, x: list[int], y: list[int]) -> bool:
        """True if the children match one by one."""
        return [self.a.shape[i] for i in x] == [self.b.shape[j] for j in y]

    def weight(self, i: int, j: int) -> int:
        a, b = self.a, self.b
        if a.kind[i] != b.kind[j]:
            return 0
        if a.shape[i] == b.shape[j]:
            return self._whole(i, j)
        key = a.full[i], b.full[j]
        if key not in self.known:
            x, y = a.kids[i], b.kids[j]
            start, end = self._split(x, y)
            same = sum(a.size[k] * PAIR + a.runs[k] for k in x[:start] + x[len(x) - end:])
            x, y = x[start:len(x) - end], y[start:len(y) - end]
            if self._alike(x, y):
                same += sum(map(self._whole, x, y))
            elif x and y:
                same += int(self._best(x, y)[-1])
            self.known[key] = PAIR + same
        return self.known[key]

    def score(self, i: int, j: int) -> int:
        """The number of node pairs."""
        return self.weight(i, j) // PAIR

    def _row(self, i: int, y: np.ndarray) -> np.ndarray:
        """Weights of one child against others."""
        a = self.a
        kind, shape, full = self.b.columns[:, y]
        alike, equal = shape == a.shape[i], full == a.full[i]
        row = np.where(alike, a.size[i] * PAIR, 0) + np.where(equal, a.runs[i], 0)
        single = a.runs[i] <= 1
        for k in np.flatnonzero((kind == a.kind[i]) & ~equal & ~(alike & single)).tolist():
            row[k] = self.weight(i, int(y[k]))
        return row

    def _best(self, x: list[int], y: list[int]) -> np.ndarray:
        """Weight of the best matching of two lists of children, for each start of ``y``."""
        best, other = np.zeros(len(y) + 1, np.int64), np.array(y, np.int64)
        for i in x:
            best[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + self._row(i, other)))
        return best

    def _children(self, x: list[int], y: list[int]) -> list[tuple[int, int]]:
        """Matched pairs of two lists of children; a table too large is halved, so that memory is bounded."""
        if not x or not y:
            return []
        if self._alike(x, y):
            return list(zip(x, y, strict=True))
        other = np.array(y, np.int64)
        if len(x) == 1:
            row = self._row(x[0], other)
            return [(x[0], y[int(row.argmax())])] if row.any() else []
        if len(x) * len(y) > ALIGN_CELLS:
            half = len(x) // 2
            cut = int((self._best(x[:half], y) + self._best(x[half:][::-1], y[::-1])[::-1]).argmax())
            return self._children(x[:half], y[:cut]) + self._children(x[half:], y[cut:])
        table = np.zeros((len(x) + 1, len(y) + 1), np.int64)
        for r, i in enumerate(x):
            np.maximum.accumulate(np.maximum(table[r, 1:], table[r, :-1] + self._row(i, other)), out=table[r + 1, 1:])
        out, r, c = [], len(x), len(y)
        while r and c:
            if table[r, c] == table[r - 1, c]:
                r -= 1
            elif table[r, c] == table[r, c - 1]:
                c -= 1
            else:
                r, c = r - 1, c - 1
                out.append((x[r], y[c]))
        return out

    def pairs(self) -> list[tuple[int, int]]:
        """Matched text runs, as numbers in a and b."""
        a, b, out = self.a, self.b, []
        todo = [(0, 0)] if a.labels[0] == b.labels[0] else []
        while todo:
            i, j = todo.pop()
            if a.shape[i] == b.shape[j]:
                out += [(a.number[i + k], b.number[j + k]) for k in range(a.size[i]) if a.labels[i + k] == "#"]
                continue
            x, y = a.kids[i], b.kids[j]
            start, end = self._split(x, y)
            todo += zip(x[:start], y[:start], strict=True)
            if end:
                todo += zip(x[-end:], y[-end:], strict=True)
            todo += self._children(x[start:len(x) - end], y[start:len(y) - end])
        return out


def _boxes(root: Node) -> list[range]:
    """Numbers of the text runs of each element below an article (or main) that sets its content apart."""
    out: list[range] = []
    number = 0
    todo: list[tuple[Node, bool, int]] = [(root, False, -1)]
    while todo:
        node, inside, first = todo.pop()
        if first >= 0:
            out.append(range(first, number))
            continue
        if node.label == "#":
            number += 1
            continue
        if inside and node.label not in FLOW:
            todo.append((node, inside, number))
        todo.extend((c, inside or node.label in ARTICLE, -1) for c in reversed(node.children))
    return out


@dataclass
class Reading:
    """What the text of a page can be made of: the runs it may show, and which of them stand apart."""

    numbers: list[int]
    texts: list[str]
    inside: bool
    boxes: list[list[int]]


def read_page(root: Node) -> Reading:
    """Runs that are not left out, of the article where there is one; in it, the runs that each element of its own holds."""
    inside = _in_articles(root)
    runs = [(n, node.text) for n, node in enumerate(texts(root)) if not node.left_out and (not inside or n in inside)]
    numbers = {n for n, _ in runs}
    boxes = [sorted(numbers.intersection(box)) for box in _boxes(root)] if inside else []
    return Reading([n for n, _ in runs], [t for _, t in runs], bool(inside), [box for box in boxes if box])


def shown_text(page: Reading, constant: set[int]) -> str:
    """The page's content without the given constant runs.

    Inside an article a line that all pages have may be text. There only what is set apart by an
    element of its own, of nothing but template, goes, and never all of an article.
    """
    shown = set(page.numbers)
    constant = constant & shown
    if page.inside and constant:
        constant = {n for box in page.boxes if constant.issuperset(box) for n in box}
        constant = constant if constant < shown else set()
    return "\n".join(t for n, t in zip(page.numbers, page.texts, strict=True) if n not in constant)


def main_text(root: Node, aligned: dict[int, int], template: set[int]) -> str:
    """The page's content, given which pivot slot says the same as a text run aligned with it."""
    return shown_text(read_page(root), {n for n, slot in aligned.items() if slot in template})


HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
READ = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("page_key", pa.string()),
    ("numbers", pa.list_(pa.int32())), ("texts", pa.list_(pa.string())), ("inside", pa.bool_()),
    ("boxes", pa.list_(pa.list_(pa.int32()))), ("slots", pa.list_(pa.int32())), ("runs", pa.list_(pa.int32())),
    ("same", pa.list_(pa.bool_())), ("keyed", pa.list_(pa.int32())), ("places", pa.list_(pa.int64())),
    ("hashes", pa.list_(pa.int64()))])
READ_SQL = ("page_id bigint, url string, host string, page_key string, numbers array<int>, texts array<string>, inside boolean, "
            "boxes array<array<int>>, slots array<int>, runs array<int>, same array<boolean>, keyed array<int>, "
            "places array<bigint>, hashes array<bigint>")


def _by_host(rows: DataFrame, per_host: DataFrame, size: Column) -> DataFrame:
    """Rows with what is known of their host; sent to all tasks only if that is counted to be few hosts and bytes."""
    hosts, total = per_host.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    if hosts <= BROADCAST_HOSTS and total <= BROADCAST_BYTES:
        per_host = F.broadcast(per_host)
    return rows.join(per_host, "host", "left")


def choose_pivots(pages: DataFrame) -> DataFrame:
    """(host, pivot): the skeleton of each host's page that hashes lowest."""
    hashed = pages.select("host", "html", F.xxhash64("html").alias("h"))
    lowest = settled(hashed.groupBy("host").agg(F.min("h").alias("lowest")))
    one = _by_host(hashed, lowest, F.lit(8)).where("h = lowest").groupBy("host").agg(F.min("html").alias("html"))
    schema = pa.schema([("host", pa.string()), ("pivot", pa.string())])

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = batch.column(0).to_pylist()
            yield as_batch([(h, skeleton(parse(p.as_py()))) for h, p in zip(hosts, batch.column(1), strict=True)], schema)

    return settled(one.mapInArrow(outline, "host string, pivot string"))


def align_pages(pages: DataFrame, pivots: DataFrame) -> DataFrame:
    """Every page parsed and aligned with its host's pivot, once: what it may show, and which run stands in which slot.

    ``page_key`` is a hash of the skeleton, equal for pages that differ in nothing but markup.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[Tree, dict]] = {}
        for batch in batches:
            rows = []
            keys = [batch.column(i).to_pylist() for i in (0, 1, 2)]
            for key, address, host, body, pivot in zip(*keys, batch.column(3), batch.column(4), strict=True):
                root = parse(body.as_py())
                page, lines = read_page(root), skeleton(root)
                if host not in known:
                    if len(known) >= KNOWN_PIVOTS:
                        known.clear()
                    shapes: dict = {}
                    known[host] = Tree(pivot.as_py(), shapes), shapes
                a, shapes = known[host]
                b = Tree(lines, dict(shapes))
                slots, shown = a.shown(), b.shown()
                pairs = [(i, j, slots[i] == shown[j]) for i, j in Matching(a, b).pairs() if slots[i]]
                places = [(j, *k) for j, k in enumerate(b.keys()) if k]
                rows.append((
                    key, address, host, blake2b(lines.encode(), digest_size=16).hexdigest(), page.numbers, page.texts, page.inside,
                    page.boxes, *[[p[n] for p in pairs] for n in range(3)], *[[p[n] for p in places] for n in range(3)]))
            yield as_batch(rows, READ)

    return _by_host(pages, pivots, F.length("pivot")).select("page_id", "url", "host", "html", "pivot").mapInArrow(run, READ_SQL)


def induce_wrappers(read: DataFrame, template_share: float = TEMPLATE_SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """host, template (numbers of the pivot's constant text runs) and shared (place and text hash of runs
    that nearly all pages with a text at that place have, in the pivot or not), of aligned pages.

    Every different page of a host counts once. A host with fewer than ``least_pages`` of them has
    no template.
    """
    pages = settled(read.select("host", "page_key", "slots", "same", "places", "hashes").dropDuplicates(["host", "page_key"]))
    slot = pages.select("host", F.explode(F.arrays_zip("slots", "same")).alias("s")).groupBy("host", F.col("s.slots").alias("slot")).agg(
        F.count(F.lit(1)).alias("pages"), F.sum(F.col("s.same").cast("int")).alias("same"))
    template = slot.where((F.col("pages") >= least_pages) & (F.col("same") >= template_share * F.col("pages"))).groupBy("host").agg(
        F.sort_array(F.collect_list("slot")).alias("template"))
    texts_at = F.explode(F.array_distinct(F.arrays_zip("places", "hashes"))).alias("t")
    many = pages.select("host", texts_at).groupBy("host", F.col("t.places").alias("place"), F.col("t.hashes").alias("text_hash")).agg(
        F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= least_pages)
    whole = pages.select("host", F.explode(F.array_distinct("places")).alias("place")).groupBy("host", "place").agg(F.count(F.lit(1)).alias("all"))
    shared = many.join(whole, ["host", "place"]).where(F.col("pages") >= template_share * F.col("all")).groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct("place", "text_hash"))).alias("shared"))
    return settled(template.join(shared, "host", "full"))


EXTRACTED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", **options) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``.

    Character references are decoded, white space inside a block becomes one space, blocks are
    joined by a newline. A null or empty page gives an empty text; a null or odd url makes a host of
    its own (empty); null ids and repeated pages stay; an empty table gives no rows.
    """
    ship(pages.sparkSession)
    source = pages.select(
        pages[page_id].cast("bigint").alias("page_id"), pages[url].alias("url"), F.coalesce(pages[page], F.lit("")).alias("html"),
        F.lower(F.regexp_extract(F.coalesce(pages[url], F.lit("")), HOST, 1)).alias("host"))
    read = settled(align_pages(source, choose_pivots(source)))
    wrappers = induce_wrappers(read, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                template, common = set(r["template"] or ()), {(s["place"], s["text_hash"]) for s in r["shared"] or ()}
                constant = {j for i, j, same in zip(r["slots"], r["runs"], r["same"], strict=True) if same and i in template}
                constant.update(j for j, *k in zip(r["keyed"], r["places"], r["hashes"], strict=True) if tuple(k) in common)
                text = shown_text(Reading(r["numbers"], r["texts"], r["inside"], r["boxes"]), constant)
                rows.append((r["page_id"], r["url"], text, len(text)))
            yield as_batch(rows, EXTRACTED)

    size = 4 * F.coalesce(F.size("template"), F.lit(0)) + 16 * F.coalesce(F.size("shared"), F.lit(0))
    return _by_host(read, wrappers, size).mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
