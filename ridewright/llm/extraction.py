"""Main text of web pages by minimum-cut labelling of their text blocks.

A page is cut into blocks of text at block-level tags. A fixed linear classifier prices each block as
content or boilerplate; the price is the capacity of an edge to one of two terminals. Neighbouring blocks and
blocks near one another in the tree are joined by smoothness edges. The minimum cut, found by maximum
flow, separates the content from the rest. Words in class, id and role count against what their element
holds, but not on html, body, main and article, not as part of state names, and not on page wrappers.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ridewright.llm.common import map_batches

# Element names by role.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody "
    "td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript template iframe svg math select option datalist object".split())
OUTSIDE = frozenset("nav footer aside form menu button label dialog fieldset legend".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCKS - frozenset("html head body caption td th tr tbody thead tfoot option title".split())
SAME_CLOSES = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table", "th": "tr table", "option": "select"}

# Words in class, id and role that speak for or against content.
AGAINST = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation "
    "sidebar aside footer foot cookie cookies notice consent gdpr popup modal overlay share sharing social comment comments "
    "reply replies disqus respond discussion related recommended recommendations breadcrumb breadcrumbs pagination pager "
    "subscribe subscription newsletter signup login search widget copyright legal toolbar masthead topbar alert tags "
    "complementary contentinfo".split()
)
WHOLE = frozenset("html body main article".split())  # their names describe the page, not what they hold
STATE_FIRST = frozenset("has no not with without tag category".split())
STATE_LAST = frozenset("open opened closed enabled disabled collapsed expanded on off".split())
FOR = frozenset("article content entry main post story body text prose".split())
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z", re.S
)
NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
RIGHTS = re.compile(r"^\s*(?:©|\(c\)|copyright\b)|all rights reserved", re.I)

ADJACENT, SIBLING = 0.6, 0.4
MOST, NEARLY_ALL, PARAGRAPH = 0.5, 0.9, 100  # shares of the text that a wrapper holds; letters of a paragraph


@dataclass
class Block:
    text: str
    path: tuple[int, ...]
    tag: str
    outside: bool
    against: tuple[int, ...]  # numbers of the elements around it with words against content
    inside: bool
    links: int


@dataclass
class Element:
    tag: str
    number: int
    outside: bool
    against: tuple[int, ...]
    inside: bool


@lru_cache(maxsize=4096)
def names_in(attributes: str) -> tuple[int, bool, bool]:
    """(words against, a word for, hidden) of an element's attributes."""
    words: set[str] = set()
    for m in NAMES.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            parts = [w for w in re.split(r"[^a-z0-9]+", name) if w]
            if len(parts) < 2 or not (parts[0] in STATE_FIRST or parts[-1] in STATE_LAST):
                words.update(parts)
    return len(words & AGAINST), bool(words & FOR), bool(HIDDEN.search(attributes))


@dataclass
class Page:
    """Open elements and finished blocks while the tags of a page go by."""

    stack: list[Element] = field(default_factory=lambda: [Element("", 0, False, (), False)])
    blocks: list[Block] = field(default_factory=list)
    landmarks: list[tuple[str, tuple[int, ...], tuple[int, ...]]] = field(default_factory=list)  # main, article, h1
    pieces: list[str] = field(default_factory=list)
    links: int = 0
    anchors: int = 0
    count: int = 0

    def text(self, raw: str) -> None:
        piece = unescape(raw) if "&" in raw else raw
        self.pieces.append(piece)
        if self.anchors:
            self.links += len(piece)

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            top = self.stack[-1]
            path = tuple(e.number for e in self.stack)
            self.blocks.append(Block(text, path, top.tag, top.outside, top.against, top.inside, self.links))
        self.pieces, self.links = [], 0

    def open(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.pieces.append(" ")
            return
        if tag == "a":
            self.anchors = 1
            return
        if tag not in BLOCKS:
            return
        self.flush()
        if tag in VOID:
            return
        if tag in CLOSES_P:
            self.close("p", BLOCKS - {"p"})
        if tag in SAME_CLOSES:
            self.close(tag, frozenset(SAME_CLOSES[tag].split()))
        if tag in HEADINGS and self.stack[-1].tag in HEADINGS:
            self.stack.pop()
        up = self.stack[-1]
        bad, good, hidden = names_in(attributes) if attributes else (0, False, False)
        named = bad > 0
        if tag in WHOLE:
            bad = 0
        inside = up.inside or tag in ("article", "main") or (good and not bad)
        outside = up.outside or hidden or tag in OUTSIDE or (tag == "header" and not inside)
        self.count += 1
        against = (*up.against, self.count) if bad else up.against
        self.stack.append(Element(tag, self.count, outside, against, inside))
        if not outside and (tag in ("main", "h1") or (tag == "article" and not named)):
            self.landmarks.append((tag, tuple(e.number for e in self.stack), against))

    def close(self, tag: str, until: frozenset[str] = frozenset()) -> None:
        """Close the nearest open element of this name, unless one of ``until`` stands before it."""
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self.flush()
                del self.stack[i:]
                return
            if self.stack[i].tag in until:
                return

    def end(self, tag: str) -> None:
        if tag == "a":
            self.anchors = 0
        elif tag in BLOCKS:
            self.flush()
            self.close(tag)


def blocks_of(html: str) -> list[Block]:
    """The text blocks of a whole page in page order; scripts, styles, titles and hidden data are left out."""
    page, at, n = Page(), 0, len(html)
    while at < n:
        found = TAG.search(html, at)
        if found is None:
            page.text(html[at:])
            break
        if found.start() > at:
            page.text(html[at : found.start()])
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            page.end(tag)
        elif tag in RAW and not found[3].endswith("/"):
            closing = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = closing.end() if closing else n
        else:
            page.open(tag, found[3])
    page.flush()
    wrappers = wrappers_of(page.blocks, page.landmarks)
    if wrappers:
        for block in page.blocks:
            block.against = tuple(e for e in block.against if e not in wrappers)
    return page.blocks


def wrappers_of(blocks: list[Block], landmarks: list[tuple[str, tuple[int, ...], tuple[int, ...]]]) -> set[int]:
    """Elements with words against content that wrap the page instead of describing a part of it.

    Such an element holds most of the text and all of main, article and h1 that nothing else speaks against,
    or nearly all of the text; without main and h1 there must be no paragraph of content beside it.
    """
    held: Counter[int] = Counter()
    whole = 0
    for block in blocks:
        if not block.outside:
            whole += len(block.text)
            for e in block.against:
                held[e] += len(block.text)
    big = {e for e, n in held.items() if n > MOST * whole}
    if not big:
        return big
    marks = [(tag, path) for tag, path, against in landmarks if big.issuperset(against)]
    beside = [b for b in blocks if len(b.text) >= PARAGRAPH and not b.outside and big.issuperset(b.against)]
    beside = [b for b in beside if price(replace(b, against=())) > 0]

    def wraps(e: int) -> bool:
        alone = all(e in b.path for b in beside)
        if marks and all(e in path for _, path in marks) and (alone or any(tag != "article" for tag, _ in marks)):
            return True
        return held[e] > NEARLY_ALL * whole and alone

    return {e for e in big if wraps(e)}


def price(block: Block) -> float:
    """Positive for content, negative for boilerplate."""
    letters = len(block.text)
    share = min(1.0, block.links / letters)
    value = 0.6 + 0.5 * math.log1p(letters / 40) - 4.0 * share
    if block.inside:
        value += 2.5
    if block.outside:
        value -= 8.0
    if block.against:
        value -= 8.0
    if block.tag in HEADINGS:
        value += 0.5
    if RIGHTS.search(block.text[:4000]) and letters < 300:
        value -= 3.0
    return value


def smoothness(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours, and from each block to the last one before it under the same parent."""
    edges, last = [], {}
    for i, block in enumerate(blocks):
        if i:
            one, two = blocks[i - 1].path, block.path
            common = 0
            for a, b in zip(one, two):
                if a != b:
                    break
                common += 1
            edges.append((i - 1, i, ADJACENT / (1 + len(one) + len(two) - 2 * common)))
        parent = block.path[:-1]
        before = last.get(parent)
        if before is not None and before < i - 1:
            edges.append((before, i, SIBLING))
        last[parent] = i
    return edges


def minimum_cut(prices: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Whether each node is on the content side; blocking flows along shortest paths."""
    n = len(prices)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, value in enumerate(prices):
        if value > 0:
            join(source, i, value, 0.0)
        elif value < 0:
            join(i, sink, -value, 0.0)
    for a, b, weight in edges:
        if weight > 0:
            join(a, b, weight, weight)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        at, path = [0] * (n + 2), []
        a = source
        while True:
            if a == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                cut = next(i for i, e in enumerate(path) if room[e] <= 1e-9)
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while at[a] < len(out[a]):
                e = out[a][at[a]]
                if room[e] > 1e-9 and level[to[e]] == level[a] + 1:
                    break
                at[a] += 1
            else:
                if not path:
                    break
                a = to[path.pop() ^ 1]
                at[a] += 1
                continue
            path.append(e)
            a = to[e]


def main_text(html: str | None) -> str:
    """The content blocks of a page, one per line; empty for null, empty and wholly boilerplate pages."""
    blocks = blocks_of(html) if html else []
    if not blocks:
        return ""
    prices = [price(b) for b in blocks]
    kept = minimum_cut(prices, smoothness(blocks))
    return "\n".join(b.text for b, keep in zip(blocks, kept, strict=True) if keep)


def extract(pages: DataFrame, *, html_col: str = "html", out: str = "text", size: str = "n_chars") -> DataFrame:
    """Every row of ``pages`` without its html, with the main text and its code points.

    Rows are answered one by one, so equal rows and equal ids stay; columns named like a result are
    replaced.
    """
    base = pages.drop(*(c for c in (out, size) if c != html_col))
    kept = [f for f in base.schema.fields if f.name != html_col]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(html_col).to_pylist()]
            columns = {f.name: batch.column(f.name) for f in kept}
            columns[out] = pa.array(texts, pa.string())
            columns[size] = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    schema = T.StructType([*kept, T.StructField(out, T.StringType()), T.StructField(size, T.LongType())])
    return map_batches(base, step, schema)
