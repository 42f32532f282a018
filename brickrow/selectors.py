"""Selectors: what a page's elements must be to leave the Python worker, and what of them is wanted.

The tests for tag, class and text are made where the page is parsed, so that a page becomes its few
marked elements, with their texts and values, and not a tree that later steps search again.

The module is pickled by value, so executors do not need the package installed.
"""

from __future__ import annotations

import gc
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle

from brickrow.workers import PAGES_PER_BATCH, START, NodeColumns, PlainTrees, reader

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What a mark can carry. ``sel`` is the number of its selector; the rest is null unless wanted.
MARK = pa.struct(
    [
        ("sel", pa.int32()),
        ("idx", pa.int32()),
        ("text", pa.string()),
        ("near", pa.string()),
        ("href", pa.string()),
        ("link", pa.string()),
        ("parent", pa.int32()),
        ("parent_end", pa.int32()),
        ("parent_text", pa.string()),
    ]
)


@dataclass(frozen=True)
class Selector:
    """Elements that pass all tests that are set; ``wants`` names the fields of :data:`MARK` to fill.

    ``text``: text pieces below the element joined by one space, null when there are none. ``near``: the
    text that belongs to a heading, of the next sibling, of the parent's next sibling, or of the first of
    the four following elements that has any. ``link``: the target of the first ``a`` below.
    ``parent``: number of the parent, and the number after its last descendant.
    """

    name: str
    tags: tuple[str, ...] = ()  # one of these; none set: any
    cls: str | None = None  # one token of the class attribute, or the whole if this has several
    no_class: bool = False  # without a class attribute
    root: bool = False  # the document itself
    title: str | None = None  # text equal to this, apart from case
    href_with: str | None = None  # a target that contains this; "" for any target
    first: bool = False  # only the first such element of the page
    wants: tuple[str, ...] = ("text",)
    holding: str | None = None  # texts that lack this lower-case word stay behind

    def may_be(self, tag: str, cls: str | None) -> bool:
        if self.tags and tag not in self.tags or self.no_class and cls is not None:
            return False
        if self.cls is None:
            return True
        return cls is not None and (cls == self.cls if " " in self.cls else self.cls in cls.split())


class Marks:
    """The marks of pages as rows, with one entry for each field that any selector wants."""

    def __init__(self, selectors: Sequence[Selector], kinds: dict) -> None:
        self.selectors = selectors
        self.kinds = kinds  # (tag, class) -> numbers of the selectors that may take it
        self.fields = fields_of(selectors)
        self.roots = [n for n, s in enumerate(selectors) if s.root]
        # Beside number and place: what to fill, by selector.
        self.wanted = [[f if f in s.wants or f == "parent_end" and "parent" in s.wants else None for f in self.fields[2:]] for s in selectors]
        self.rows: list[tuple] = []

    def takers(self, kind: tuple) -> list[int]:
        """Numbers of the selectors that may take an element of a tag and class."""
        numbers = self.kinds.get(kind)
        if numbers is None:
            if len(self.kinds) > 50_000:
                self.kinds.clear()
            numbers = self.kinds[kind] = [k for k, s in enumerate(self.selectors) if not s.root and s.may_be(*kind)]
        return numbers

    def add_page(self, page: NodeColumns) -> None:
        taken = [(i, numbers) for i in range(1, len(page.tag)) if (numbers := self.takers((page.tag[i], page.cls[i])))]
        own = {i: aside for i, aside in enumerate(page.own) if aside is not None}
        nodes = [(START, tag, cls, href) for tag, cls, href in zip(page.tag, page.cls, page.href)]
        self.add_tree(nodes, page.parent, page.end, page.seg_from, page.seg_to, page.pieces, own, taken)

    def add_tree(self, nodes, parents, end, seg_from, seg_to, pieces, own, taken) -> None:
        """A page as :meth:`brickrow.workers.PlainTrees.read` gives it."""
        selectors, wanted, add, n = self.selectors, self.wanted, self.rows.append, len(nodes)

        def text(i: int) -> str | None:
            if i >= n:
                return None
            if i in own:
                return own[i] or None
            a, b = seg_from[i], seg_to[i]
            if b - a == 1:
                return pieces[a]
            return " ".join(pieces[a:b]) if a < b else None

        def text_after(i: int) -> str | None:
            """Text of the next sibling, which begins where the subtree ends."""
            k = end[i]
            return text(k) if k < n and parents[k] == parents[i] else None

        def near(i: int) -> str | None:
            above = parents[i]
            return (
                text_after(i)
                or (above >= 0 and text_after(above))
                or text(i + 1)
                or text(i + 2)
                or text(i + 3)
                or text(i + 4)
                or None
            )

        def held(found: str | None, word: str | None) -> str | None:
            return found if word is None or found is None or word in found.lower() else None

        def value(field: str, s: Selector, i: int):
            if field == "text":
                return held(text(i), s.holding)
            if field == "near":
                return near(i)
            if field == "href":
                return nodes[i][3]
            if field == "link":
                return next((nodes[k][3] for k in range(i + 1, end[i]) if nodes[k][1] == "a"), None)
            if field == "parent":
                return parents[i]
            if field == "parent_end":
                return end[parents[i]]
            return held(text(parents[i]), s.holding)

        for number in self.roots:
            s = selectors[number]
            add((number, 0, *[f and value(f, s, 0) for f in wanted[number]]))
        done: set[int] = set()
        for i, numbers in taken:
            for number in numbers:
                s = selectors[number]
                if s.first and number in done:
                    continue
                if s.title is not None and (text(i) or "").lower() != s.title:
                    continue
                if s.href_with is not None and (nodes[i][3] is None or s.href_with not in nodes[i][3]):
                    continue
                done.add(number)
                add((number, i, *[f and value(f, s, i) for f in wanted[number]]))


def fields_of(selectors: Sequence[Selector]) -> list[str]:
    """Fields of the marks, in the order of :data:`MARK`."""
    wanted = {"sel", "idx", *(name for s in selectors for name in s.wants)}
    if "parent" in wanted:
        wanted.add("parent_end")
    return [f.name for f in MARK if f.name in wanted]


def marker(selectors: Sequence[Selector]) -> Callable[[list], Iterator[list[tuple] | None]]:
    """A function from pages to the marks of each as rows of :func:`fields_of`; None for unreadable html."""
    read, kinds = reader(), {}
    plain = PlainTrees(Marks(selectors, kinds).takers)

    def mark(pages: list[str | None]) -> Iterator[list[tuple] | None]:
        marks, at = Marks(selectors, kinds), []
        collecting = gc.isenabled()
        gc.disable()  # pages have no cycles, and walking their lists takes time
        for html in pages:
            tree = None if html is None else plain.read(html)
            if tree is not None:
                at.append(len(marks.rows))
                marks.add_tree(*tree)
                continue
            events = read(html)
            at.append(None if events is None else len(marks.rows))
            if events is not None:
                page = NodeColumns()
                page.add_page(events)
                marks.add_page(page)
        if collecting:
            gc.enable()
        end = len(marks.rows)
        found: list[list[tuple] | None] = []
        for begin in reversed(at):
            found.append(None if begin is None else marks.rows[begin:end])
            end = end if begin is None else begin
        return reversed(found)

    return mark


def selecting(selectors: Sequence[Selector]):
    """A function over batches ``(..., html)`` to ``(..., marks)``; unreadable html gives null."""
    wanted = [MARK.field(name) for name in fields_of(selectors)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = marker(selectors)
        for batch in batches:
            for start in range(0, batch.num_rows, PAGES_PER_BATCH):
                part = batch.slice(start, PAGES_PER_BATCH)
                rows, at = [], []
                for marks in mark(part.column("html").to_pylist()):
                    at.append(None if marks is None else len(rows))
                    rows += marks or ()
                at.append(len(rows))
                columns = list(zip(*rows)) or [()] * len(wanted)
                values = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, wanted)], fields=wanted)
                kept = [i for i, name in enumerate(part.schema.names) if name != "html"]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in kept] + [pa.ListArray.from_arrays(pa.array(at, pa.int32()), values)],
                    names=[part.schema.names[i] for i in kept] + ["marks"],
                )

    return run
