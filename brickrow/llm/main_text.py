"""Main text of web pages by minimum cut.

A page becomes a row of text blocks in page order. A logistic classifier gives every block the
log-odds of being content, from what it stands in (article, navigation, footer, form ..., and words in
class and id attributes), how much of it is link, its length and punctuation. The log-odds are the
capacities of a block's edges to the two terminals. Neighbouring blocks, and neighbouring blocks of one
parent, are joined by edges whose capacity falls with their distance in the tree. The minimum cut
separates content from boilerplate: a block without a clear sign of its own goes with those near it.

The cut is exact. A block whose own lead exceeds all its edges keeps its side in every minimum cut, so
such blocks are settled first, and the flow is sought only among the others.

The classifier is learned here from at most ``SAMPLE`` pages, from blocks that the page's own markup
puts on one side, with a prior on each weight (``PRIOR``), so that markup which the sample does not
show is judged by the prior.

Only white space between words is lost: character references are decoded, white space in a block
becomes one space (also a line break element), blocks are joined by a line feed. Markup: comments, raw
text elements (script, style ...) and what is not shown are skipped; a new block element closes an open
paragraph; an end tag without its start is ignored; a tag or comment that never ends runs to the end.
Null and empty pages have no text; a null ``url`` or ``page_id`` and repeated rows are carried along.
An empty table gives no rows. Only ``page_id, url, html`` are read.
"""

from __future__ import annotations

import re
from collections import deque
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickrow.llm.common import exact, sample, steps, texts_of

#: Pages that the classifier is fitted on, and blocks taken from each, at most.
SAMPLE = 2000
BLOCKS = 60
#: Capacity of the edge between neighbours without any element between them.
SMOOTH = 0.8

_BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not text of the page.
_RAW = "script|style|noscript|template|iframe|textarea|svg|title|object|canvas"
_CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({_RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?<!/)>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
#: Attributes one after the other, so that what stands in a value is no attribute.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Features of what a block stands in: element names, and words of class, id and role.
PLACES: dict[str, tuple[str, str]] = {
    "article": ("article", "article story post"),
    "main": ("main", "main content entry body text"),
    "nav": ("nav menu", "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc"),
    "header": ("header", "header masthead topbar banner"),
    "footer": ("footer", "footer copyright colophon contentinfo"),
    "aside": ("aside", "aside sidebar complementary widget related recommended trending teaser"),
    "advert": ("", "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion"),
    "notice": ("dialog", "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe paywall"),
    "form": ("form fieldset select button option", "form search login signin signup register"),
    "comments": ("", "comment comments commentlist disqus respond reply replies discussion"),
    "social": ("", "share sharing social follow tags byline meta"),
}
_ELEMENT = {e: 1 << i for i, (elements, _) in enumerate(PLACES.values()) for e in elements.split()}
_NAME = {w: 1 << i for i, (_, words) in enumerate(PLACES.values()) for w in words.split()}
_ARTICLE, _MAIN, _HEADER = (1 << list(PLACES).index(x) for x in ("article", "main", "header"))
_GOOD = _ARTICLE | _MAIN  # places of content
_BAD = (1 << len(PLACES)) - 1 & ~_GOOD

#: Mean of each weight before any page is seen; then the features of the text itself.
PRIOR = {
    "article": 3.0, "main": 1.5, "nav": -6.0, "header": -4.0, "footer": -6.0, "aside": -6.0, "advert": -7.0, "notice": -6.0,
    "form": -6.0, "comments": -7.0, "social": -4.0, "length": 0.4, "links": -2.5, "sentences": 0.5, "heading": 0.5, "item": -0.3,
    "bias": 0.3,
}
#: How firmly a weight is held to its mean.
HOLD = 20.0
_HIDDEN = 1 << len(PLACES)


@dataclass
class Block:
    text: str
    places: int
    linked: int  # characters inside links
    heading: bool
    item: bool
    apart: int  # elements between this block and the one before
    parent: int


def _places(tag: str, attributes: str, above: int) -> int:
    own = _ELEMENT.get(tag, 0)
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none", value)):
                own |= _HIDDEN
            elif name in ("class", "id", "role"):
                for w in _WORD.findall(value):
                    own |= _NAME.get(w.lower(), 0)
    if own & _HEADER and above & _GOOD:
        own &= ~_HEADER  # the head of an article holds its title
    if tag in ("body", "html"):
        own &= _HIDDEN  # words there describe the page as a whole
    return above | own


def blocks(html: str) -> list[Block]:
    """The text blocks of a page in order."""
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = [("", 0, 0)]  # element, places, number
    parts: list[str] = []
    low = depth = number = 0  # shallowest element since the last block, depth of that block
    linked, in_link, at = 0, False, 0

    def close() -> None:
        nonlocal linked, low, depth
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            tag, places, own = stack[-1]
            here = len(stack)
            low = min(low, here)
            if not places & _HIDDEN:
                apart = (depth - low) + (here - low)
                out.append(Block(text, places, min(linked, len(text)), tag[:1] == "h" and tag[1:].isdigit(), tag == "li", apart, own))
                low = depth = here
        linked = 0

    for m in _MARKUP.finditer(html):
        start = m.start()
        if start > at:
            piece = html[at:start]
            if "&" in piece:
                piece = unescape(piece)
            parts.append(piece)
            if in_link:
                linked += len(piece)
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in _BLOCK:
            if tag == "a":
                in_link = not m[2]
            elif tag == "br":
                parts.append(" ")
            elif tag == "head":
                close()
            continue
        close()
        in_link = False
        if m[2]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    low = min(low, len(stack))
                    break
            continue
        closes = _CLOSES.get(tag)
        if stack[-1][0] == "p":
            stack.pop()
        while closes and stack[-1][0] in closes:
            stack.pop()
        low = min(low, len(stack))
        if tag not in _VOID:
            number += 1
            stack.append((tag, _places(tag, m[4], stack[-1][1]), number))
    tail = html[at:]
    if tail:
        parts.append(unescape(tail))
    close()
    return out


def features(row: list[Block]) -> np.ndarray:
    """One row for each block, in the order of ``PRIOR``."""
    n = len(PLACES)
    x = np.zeros((len(row), len(PRIOR)))
    for i, b in enumerate(row):
        size = len(b.text)
        ends = b.text.count(". ") + b.text.count("! ") + b.text.count("? ") + (b.text[-1] in ".!?")
        x[i, n:] = (min(np.log1p(size) - 3, 4), b.linked / size, min(ends, 4) / 2, b.heading, b.item, 1)
    places = np.array([b.places for b in row], np.int64)
    x[:, :n] = (places[:, None] >> np.arange(n)) & 1
    return x


def learn(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of greatest posterior probability, by Newton's steps."""
    mean = np.array(list(PRIOR.values()))
    w = mean.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - HOLD * (w - mean)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + HOLD * np.eye(len(w)), gradient)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def edges(row: list[Block]) -> dict[tuple[int, int], float]:
    """Smoothness between blocks: neighbours in the page, and neighbours among the blocks of one parent's kind."""
    out: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(row):
        if i:
            out[i - 1, i] = out.get((i - 1, i), 0.0) + SMOOTH / (1 + b.apart)
        j = last.get(b.parent)
        if j is not None:
            out[j, i] = out.get((j, i), 0.0) + SMOOTH / 2
        last[b.parent] = i
    return out


def cut(lead: np.ndarray, joined: dict[tuple[int, int], float]) -> np.ndarray:
    """Which blocks a minimum cut leaves with the source; of several cuts, the one with fewest such blocks.

    ``lead`` over 0 is the capacity from the source, under 0 that to the sink.
    """
    lead = np.array(lead, float)
    near: dict[int, dict[int, float]] = {}
    for (i, j), c in joined.items():
        near.setdefault(i, {})[j] = near.setdefault(j, {})[i] = near.get(i, {}).get(j, 0.0) + c
    side = np.zeros(len(lead), np.int8)
    todo = deque(range(len(lead)))
    while todo:
        i = todo.popleft()
        if side[i] or abs(lead[i]) <= sum(near.get(i, {}).values()) + 1e-12:
            continue
        side[i] = 1 if lead[i] > 0 else -1
        for j, c in near.pop(i, {}).items():
            # A settled neighbour pulls like a terminal.
            lead[j] += c * side[i]
            del near[j][i]
            if not side[j]:
                todo.append(j)
    rest = np.flatnonzero(side == 0)
    if len(rest):
        side[rest] = -1
        side[[i for i in _flow(lead, near, rest.tolist())]] = 1
    return side > 0


def _flow(lead: np.ndarray, near: dict[int, dict[int, float]], nodes: list[int]) -> set[int]:
    """Nodes on the source's side after a maximum flow along shortest paths."""
    spare: dict[int, dict[int, float]] = {i: dict(near.get(i, {})) for i in nodes}
    spare[-1], spare[-2] = {}, {}
    for i in nodes:
        if lead[i] > 0:
            spare[-1][i], spare[i][-1] = float(lead[i]), 0.0
        elif lead[i] < 0:
            spare[i][-2], spare[-2][i] = float(-lead[i]), 0.0
    while True:
        above, queue = {-1: -1}, deque([-1])
        while queue and -2 not in above:
            i = queue.popleft()
            for j, c in spare[i].items():
                if c > 1e-12 and j not in above:
                    above[j] = i
                    queue.append(j)
        if -2 not in above:
            return {i for i in above if i >= 0}
        path, j = [], -2
        while j != -1:
            path.append((above[j], j))
            j = above[j]
        push = min(spare[i][j] for i, j in path)
        for i, j in path:
            spare[i][j] -= push
            spare[j][i] = spare[j].get(i, 0.0) + push


def main_text(html: str, weights: np.ndarray) -> str:
    row = blocks(html)
    if not row:
        return ""
    kept = cut(features(row) @ weights, edges(row))
    return "\n".join(b.text for b, k in zip(row, kept) if k)


def fit(pages: DataFrame, sample_pages: int = SAMPLE) -> np.ndarray:
    """Weights from the blocks of a bounded sample that markup puts inside an article or outside of it."""

    def marked(batches):
        for batch in steps(batches, "html"):
            rows = []
            for html in texts_of(batch.column("html")):
                row = [b for b in blocks(html) if b.places & (_GOOD | _BAD)]
                row = row[:: max(1, -(-len(row) // BLOCKS))]
                if row:
                    y = [1.0 if not b.places & _BAD else 0.0 for b in row]
                    rows.append(np.column_stack([features(row), y]).astype("<f8").tobytes())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["x"])

    rows = sample(exact(pages, "page_id", "html"), sample_pages, "page_id").mapInArrow(marked, "x binary").collect()
    data = np.concatenate([np.zeros((0, len(PRIOR) + 1)), *(np.frombuffer(r.x, "<f8").reshape(-1, len(PRIOR) + 1) for r in sorted(rows))])
    return learn(data[:, :-1], data[:, -1])


def extract(pages: DataFrame, weights: np.ndarray) -> DataFrame:
    """``page_id, url, text`` of every page."""

    def run(batches):
        for batch in steps(batches, "html"):
            texts = [main_text(h, weights) for h in texts_of(batch.column("html"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    rows = exact(pages, "page_id", "url", "html").select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string")
