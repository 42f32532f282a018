"""HTML as columns, in one pass of a Python worker.

:func:`select_nodes` gives the elements that some selectors take, with their texts and values.
:func:`parse_pages` gives whole pages as arrays, for steps that are expressions on those: ``nodes`` holds
the elements in document order and ``segs`` the text pieces; see :class:`brickrow.workers.NodeColumns`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from brickrow import lookups
from brickrow.readings import READ, reading
from brickrow.selectors import Selector, fields_of, selecting
from brickrow.workers import parser

NODE = T.StructType(
    [
        T.StructField("idx", T.IntegerType()),
        T.StructField("parent", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("next", T.IntegerType()),
        T.StructField("tag", T.StringType()),
        T.StructField("cls", T.StringType()),
        T.StructField("href", T.StringType()),
        T.StructField("seg_from", T.IntegerType()),
        T.StructField("seg_to", T.IntegerType()),
        T.StructField("own", T.StringType()),
    ]
)


#: Node fields that links are read from; no text is needed for them.
LINK_FIELDS = ["idx", "end", "tag", "cls", "href"]
#: Node fields that texts and values are read from.
TEXT_FIELDS = ["idx", "parent", "end", "next", "tag", "cls", "seg_from", "seg_to", "own"]


def parse_pages(pages: DataFrame, fields: list[str] = NODE.names, with_text: bool = True) -> DataFrame:
    """Replace ``html`` by ``nodes`` and ``segs``. Narrow: no shuffle, pages stay where they are.

    The worker hands over only the node ``fields`` asked for, and ``segs`` only ``with_text``.
    """
    kept = [f for f in pages.schema if f.name != "html"]
    out = T.StructType(kept).add("nodes", T.ArrayType(T.StructType([NODE[f] for f in fields])))
    if with_text:
        out = out.add("segs", T.ArrayType(T.StringType()))
    return pages.mapInArrow(parser(fields, with_text), out)


#: Types of what a mark carries; the rest is text.
_NUMBERS = ["sel", "idx", "parent", "parent_end"]


def select_nodes(pages: DataFrame, selectors: list[Selector]) -> DataFrame:
    """Replace ``html`` by ``marks``, the elements that the selectors take, in document order.

    Narrow like :func:`parse_pages`, but tests and texts are made in the worker, and only marked
    elements leave it. A mark names its selector by ``sel``, its place in ``selectors``.
    """
    kept = [f for f in pages.schema if f.name != "html"]
    mark = T.StructType([T.StructField(n, T.IntegerType() if n in _NUMBERS else T.StringType()) for n in fields_of(selectors)])
    return pages.mapInArrow(selecting(selectors), T.StructType(kept).add("marks", T.ArrayType(mark)))


def read_records(pages: DataFrame, selectors: list[Selector], values: T.StructType) -> DataFrame:
    """Replace ``html`` by :data:`brickrow.readings.READ` and the values of a record, ``_`` before their names.

    Narrow like :func:`select_nodes`; what the marks say is read in the worker too, so a page leaves it as one row.
    """
    kept = [f for f in pages.schema if f.name != "html"]
    found = [T.StructField(READ, T.BooleanType()), *[T.StructField(f"_{f.name}", f.dataType) for f in values]]
    return pages.mapInArrow(reading(selectors, list(to_arrow_schema(values))), T.StructType([*kept, *found]))


def marked(selectors: list[Selector], name: str, marks: Column | str = "marks") -> Column:
    """The marks of one selector."""
    number = next(i for i, s in enumerate(selectors) if s.name == name)
    return F.filter(marks, lambda m: m.sel == number)


def first_marked(selectors: list[Selector], name: str) -> Column:
    return first(marked(selectors, name))


def node_text(node: Column, segs: Column) -> Column:
    """Text pieces below a node joined by one space; null when there are none."""
    inside = F.slice(segs, node.seg_from + 1, node.seg_to - node.seg_from)
    return F.nullif(F.coalesce(node.own, F.array_join(inside, " ")), F.lit(""))


def node_at(nodes: Column, idx: Column) -> Column:
    return F.get(nodes, idx)


def first(nodes: Column) -> Column:
    return F.get(nodes, F.lit(0))


def has_class(node: Column, name: str) -> Column:
    """One token of the class attribute, or the whole attribute if ``name`` has several."""
    if " " in name:
        return F.coalesce(node.cls == name, F.lit(False))
    token = F.concat(F.lit(" "), node.cls, F.lit(" ")).contains(f" {name} ")
    # Most elements fail the plain search, which needs no new text.
    return F.coalesce(node.cls.contains(name) & token, F.lit(False))


def below(nodes: Column, outer: Column) -> Column:
    """All elements inside ``outer``, in document order."""
    return F.slice(nodes, outer.idx + 2, outer.end - outer.idx - 1)
