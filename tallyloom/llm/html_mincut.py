"""Main text of web pages by minimum-cut labelling of their blocks.

A page is a list of text blocks. What its tags, attributes and text say about a block becomes the capacity of its edge
to the source (content) or the sink (boilerplate); neighbours in page order, and blocks with the same parent, are joined
by smoothness edges that weigh less the further they are apart in the document tree. The minimum cut, found by maximum
flow, is the labelling of least cost.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import common as C

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: No text of these is shown as text.
HIDDEN = {"script", "style", "noscript", "template", "head", "title", "iframe", "object", "svg", "canvas", "audio", "video", "select", "button", "textarea", "datalist", "dialog"}
#: What may stand in a head; any other tag, or text, ends one that was never closed.
HEAD = {"head", "title", "meta", "link", "base", "script", "style", "noscript", "template"}
#: Those that can hold no block, so a block ends them.
NO_BLOCKS = {"select", "datalist", "svg"}
#: Those that hide nothing on a page without any end tag of theirs.
CLOSED = {"noscript", "object", "button", "dialog", "canvas", "audio", "video", "template"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "html", "li", "main",
    "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: A new one of these ends an open one of the same set, up to the nearest of the second set.
CLOSES = {
    "p": (BLOCKS, {"p"}), "li": ({"li"}, {"li"}), "dt": ({"dt", "dd"}, {"dt", "dd"}), "dd": ({"dt", "dd"}, {"dt", "dd"}),
    "tr": ({"tr"}, {"tr", "td", "th"}), "td": ({"td", "th"}, {"td", "th"}), "th": ({"td", "th"}, {"td", "th"}),
}

ASIDE_TAGS = {"nav", "footer", "aside", "menu", "search"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
#: Words of class and id that name what is no main text; fixed values.
ASIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adslot adsense sponsor sponsored sponsors promo promos promotion promoted banner banners "
    "nav navbar navigation menu menus topbar toolbar breadcrumb breadcrumbs pagination pager sidebar sidebars aside widget widgets rail "
    "header masthead footer foot copyright colophon legal cookie cookies consent gdpr notice notices alert alerts popup modal overlay "
    "newsletter subscribe subscription signup login comment comments commentlist reply replies respond disqus discussion "
    "share sharing social related recommended recommendations teaser teasers outbrain taboola skip".split()
)
#: Those that make even an article element no main text; fixed values.
NO_ARTICLE = set("ad ads advert advertisement sponsored promo comment comments reply related teaser recommended".split())
MAIN_TAGS, MAIN_ROLES = {"article", "main"}, {"main", "article"}
MAIN_WORDS = set("article content post entry story main maintext bodytext".split())

_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
_END = re.compile(r"[.!?:;\"')\]’”…]$")
#: Capacity of one unit of evidence, and of the edge between two neighbours with one parent.
UNIT, SMOOTH = 100, 60


class Node:
    """An open or closed element: its cues and, for shares, the length of the text below it."""

    __slots__ = ("cues", "depth", "hard", "inside", "length", "main", "mains", "parent", "soft", "tag")

    def __init__(self, tag: str, parent: Node | None, attributes: dict[str, str | None]):
        self.tag, self.parent, self.depth = tag, parent, parent.depth + 1 if parent else 0
        self.length, self.mains, self.cues = 0, False, (False, 0)
        role = (attributes.get("role") or "").lower()
        words = {w.lower() for name in ("class", "id") for w in _WORD.findall(attributes.get(name) or "")}
        inside = parent is not None and parent.inside
        self.main = (tag in MAIN_TAGS or role in MAIN_ROLES) and not (tag == "article" and words & NO_ARTICLE)
        self.inside = self.main or inside
        self.hard = (
            tag in ASIDE_TAGS or role in ASIDE_ROLES or (tag == "header" and not inside) or "hidden" in attributes
            or (attributes.get("aria-hidden") or "").lower() == "true"
            or "display:none" in (attributes.get("style") or "").replace(" ", "").lower()
        )
        named = 0 if self.main or tag in ("html", "body") else -1 if words & ASIDE_WORDS else 1 if words & MAIN_WORDS else 0
        self.soft = -1 if tag == "form" else named


class Blocks(HTMLParser):
    """Text blocks in page order: ``(text, node, characters in links, tag)``."""

    def __init__(self, shown: set[str] = frozenset()):
        super().__init__(convert_charrefs=True)
        self.shown = shown
        self.node = Node("", None, {})
        self.hidden: list[str] = []
        self.parts: list[str] = []
        self.linked = 0
        self.in_link = False
        self.blocks: list[tuple[str, Node, int]] = []

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append((text, self.node, self.linked))
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if self.hidden:
            root = self.hidden[0]
            if tag == "body" or (self.hidden[-1] == "head" and tag not in HEAD):  # a head that was never closed
                self.hidden.clear()
            elif root in NO_BLOCKS and tag in BLOCKS and "foreignobject" not in self.hidden:
                self.hidden.clear()
            else:
                # With what is open in it, so that its end tags are told from those of blocks around it.
                if tag == root or tag in BLOCKS or tag == "foreignobject" or (root == "head" and tag in HIDDEN - self.shown):
                    self.hidden.append(tag)
                return
        if tag in HIDDEN - self.shown:
            self.hidden.append(tag)
            return
        if tag == "a":
            self.in_link = True
        elif tag == "br":
            self.parts.append("\n")
        elif tag == "hr":
            self.flush()
        elif tag in BLOCKS:
            self.flush()
            self.in_link = False
            for new in ((tag,) if tag in CLOSES else ()) + (("p",) if tag != "p" else ()):
                self.close_open(*CLOSES[new])
            self.node = Node(tag, self.node, dict(attrs))

    def close_open(self, stops: set[str], ended: set[str]) -> None:
        """End the innermost open element of ``ended`` unless one of ``stops`` that isn't ended itself is nearer."""
        node = self.node
        if node.parent is None or node.tag not in stops or node.tag not in ended:
            return
        self.node = node.parent
        if self.node.tag in ended:
            self.close_open(stops, ended)

    def handle_startendtag(self, tag, attrs):
        if tag in VOID or tag not in HIDDEN:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.hidden:
            if tag in self.hidden:
                while self.hidden.pop() != tag:
                    pass
                return
            if tag not in BLOCKS or not self.is_open(tag):
                return
            self.hidden.clear()  # never closed, but the block around it is
        if tag == "a":
            self.in_link = False
        elif tag in BLOCKS:
            node = self.node
            while node is not None and node.tag != tag:
                node = node.parent
            self.flush()
            if node is not None and node.parent is not None:
                self.node = node.parent

    def is_open(self, tag: str) -> bool:
        node = self.node
        while node is not None and node.tag != tag:
            node = node.parent
        return node is not None

    def handle_data(self, data):
        if self.hidden and self.hidden[-1] == "head" and data.strip():
            self.hidden.clear()
        if not self.hidden:
            self.parts.append(data)
            if self.in_link:
                self.linked += len(data)


def read_blocks(html: str) -> list[tuple[str, Node, int]]:
    lower = html.lower()
    parser = Blocks({tag for tag in CLOSED if f"</{tag}" not in lower})
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.blocks


# Costs --------------------------------------------------------------------------------------------------------------


def evidence(blocks: list[tuple[str, Node, int]]) -> list[float]:
    """How much speaks for content (above 0) or boilerplate, per block."""
    total = sum(len(text) for text, _, _ in blocks) or 1
    known: dict[int, Node] = {}
    for text, node, _ in blocks:
        node.length += len(text)
        while node is not None and id(node) not in known:
            known[id(node)] = node
            node = node.parent
    outer_first = sorted(known.values(), key=lambda node: node.depth)  # no calls per level: pages nest as deep as they like
    for node in reversed(outer_first):
        if node.parent is not None:
            node.parent.length += node.length
            node.parent.mains |= node.mains or node.main or node.tag == "h1"
    has_main = any(node.inside for _, node, _ in blocks)
    for node in outer_first:
        # Whether anything above says boilerplate, and how strongly content is said.
        aside, main = node.parent.cues if node.parent is not None else (False, 0)
        # A name on what holds the main element, or most of the page, says nothing about its blocks.
        named = node.soft < 0 and not node.mains and node.length <= 0.6 * total
        node.cues = aside or node.hard or named, max(main, 2 if node.main else 1 if node.soft > 0 else 0)

    scores = []
    for text, node, linked in blocks:
        aside, main = node.cues
        score = -0.5 + min(len(text) / 80, 2) - (2 if main == 2 else 6) * min(1, linked / len(text))
        score += (node.tag in ("p", "blockquote", "pre")) + (0.5 if node.tag in HEADINGS else 0) + (0.5 if _END.search(text) else 0)
        score -= 1 if len(text) < 25 and not _END.search(text) else 0
        score += (0, 2, 6)[main] - (4 if has_main and main < 2 else 0) - (14 if aside else 0)
        scores.append(score)
    return scores


def smoothness(blocks: list[tuple[str, Node, int]]) -> dict[tuple[int, int], int]:
    """Capacities between neighbours in page order and between following blocks with one parent."""
    edges: dict[tuple[int, int], int] = {}
    last: dict[int, int] = {}
    for i, (_, node, _) in enumerate(blocks):
        if i:
            edges[i - 1, i] = int(SMOOTH / (1 + distance(blocks[i - 1][1], node)))
        parent = id(node.parent)
        before = last.get(parent)
        if before is not None and before < i - 1:
            edges[before, i] = SMOOTH // 3
        last[parent] = i
    return edges


def distance(a: Node, b: Node) -> int:
    """Steps between the parents of two nodes in the tree, without the shared path."""
    a, b, steps = a.parent or a, b.parent or b, 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent or a
        else:
            b = b.parent or b
        steps += 1
        if a.parent is None and b.parent is None:
            break
    return steps


# Minimum cut --------------------------------------------------------------------------------------------------------


def minimum_cut(terminal: list[int], edges: dict[tuple[int, int], int]) -> list[bool]:
    """Which nodes stay with the source. ``terminal``: capacity to the source if positive, to the sink if negative.

    A node whose terminal capacity is at least that of all its edges is settled by it; its edges then count for its
    neighbours. Only what remains is solved by flow. On equal cost a node goes to the sink.
    """
    n = len(terminal)
    balance, side = list(terminal), [None] * n
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for (a, b), capacity in edges.items():
        if capacity:
            near[a][b] = near[a].get(b, 0) + capacity
            near[b][a] = near[b].get(a, 0) + capacity
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if side[i] is not None:
            continue
        free = sum(capacity for j, capacity in near[i].items() if side[j] is None)
        if balance[i] > free or balance[i] <= -free:
            side[i] = balance[i] > free
            for j, capacity in near[i].items():
                if side[j] is None:
                    balance[j] += capacity if side[i] else -capacity
                    queue.append(j)
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        for i in _source_side(rest, balance, near, side):
            side[i] = True
    return [bool(s) for s in side]


def _source_side(rest: list[int], balance: list[int], near: list[dict[int, int]], side: list) -> set[int]:
    """Nodes of ``rest`` that the source still reaches after a maximum flow along shortest paths."""
    source, sink = -1, -2
    left: dict[int, dict[int, int]] = {i: {j: c for j, c in near[i].items() if side[j] is None} for i in rest}
    left[source], left[sink] = {i: balance[i] for i in rest if balance[i] > 0}, {}
    for i in rest:
        if balance[i] < 0:
            left[i][sink] = -balance[i]
    while True:
        came, queue = {source: source}, deque([source])
        while queue and sink not in came:
            i = queue.popleft()
            for j, capacity in left[i].items():
                if capacity > 0 and j not in came:
                    came[j] = i
                    queue.append(j)
        if sink not in came:
            return set(came) - {source}
        path, j = [], sink
        while j != source:
            path.append((came[j], j))
            j = came[j]
        flow = min(left[i][j] for i, j in path)
        for i, j in path:
            left[i][j] -= flow
            left[j][i] = left[j].get(i, 0) + flow


def main_text(html: str | None) -> str:
    """The blocks labelled content, in page order, joined by an empty line."""
    blocks = read_blocks(html or "")
    if not blocks:
        return ""
    terminal = [round(UNIT * score) for score in evidence(blocks)]
    kept = minimum_cut(terminal, smoothness(blocks))
    return "\n\n".join(text for (text, _, _), keep in zip(blocks, kept, strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id, url, html``).

    ``text`` is empty for a null or empty page and where no block is main text. White space inside a block, line
    breaks included, is one space. Broken markup is read as far as it goes: open elements end with the page. Rows with
    equal ids are separate; more columns are ignored.
    """
    C.limit_batches(pages.sparkSession)
    schema = "page_id long, url string, text string, n_chars long"
    fields = C.pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html) for html in batch.column(2).to_pylist()]
            yield C.record_batch({"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}, fields)

    columns = F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    return pages.select(*columns).mapInArrow(run, schema)
