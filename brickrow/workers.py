"""The helpers that run inside Python workers: HTML tokens to arrays, and NFKC.

The module is pickled by value, so executors do not need the package installed.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Iterator
from html import unescape
from html.entities import html5
from html.parser import HTMLParser
from unicodedata import normalize

import pyarrow as pa
from pyspark import cloudpickle

from brickrow.lookups import ASIDE_TAGS, VOID_TAGS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAGES_PER_BATCH = 256

NODE = pa.struct(
    [
        ("idx", pa.int32()),
        ("parent", pa.int32()),
        ("end", pa.int32()),
        ("next", pa.int32()),
        ("tag", pa.string()),
        ("cls", pa.string()),
        ("href", pa.string()),
        ("seg_from", pa.int32()),
        ("seg_to", pa.int32()),
        ("own", pa.string()),
    ]
)

# Events of a page: (TEXT, text), (START, tag, class attribute, href, empty), (END, tag), and CUT
# for comments and the like, which only separate text.
TEXT, START, END, CUT = range(4)
#: The document as the first node of a page.
ROOT = (START, "[document]", None, None, "")

# Markup that every tokenizer reads the same way. Anything else goes to the standard parser.
ATTRIBUTE = r"""[ \t\r\n\f]+[a-zA-Z_][a-zA-Z0-9_:-]*(?:=(?:"[^"]*"|'[^']*'|[^ \t\r\n\f"'=<>`&/]+))?"""
#: Scripts and styles whole; comments and the like.
RAW_MARKUP = rf"((?:script|style)(?:{ATTRIBUTE})*[ \t\r\n\f]*)>(.*?)</(?:script|style)[ \t\r\n\f]*"
MARK = r"""(!--(?!-?>)[^-]*(?:-[^-]+)*--|![a-zA-Z][^<>"'\[\]]*)"""
#: One piece of markup and the text after it. Tags other than scripts and styles may hold ``>`` in quotes.
MARKUP = re.compile(
    rf"""<(?:((?:/|(?!(?:script|style)\b))[a-zA-Z][^<>"']*(?:(?:"[^"<]*"|'[^'<]*')[^<>"']*)*)
    |{RAW_MARKUP}
    |{MARK})>([^<]*)""",
    re.VERBOSE | re.DOTALL,
)
#: The pieces of markup that may hold ``<``.
WHOLE_MARKUP = re.compile(rf"<(?:{RAW_MARKUP}|{MARK})>", re.DOTALL)
PLAIN_TAG = re.compile(rf"(/?)([a-zA-Z][a-zA-Z0-9]*)((?:{ATTRIBUTE})*)[ \t\r\n\f]*(/?)")
PLAIN_DOCTYPE = re.compile(r"!(?:DOCTYPE|doctype)[ ][^<>\[\]\"']*")
PLAIN_ATTRIBUTE = re.compile(
    r"""[ \t\r\n\f]([a-zA-Z_][a-zA-Z0-9_:-]*)(?:=(?:"([^"]*)"|'([^']*)'|([^ \t\r\n\f"'=<>`&/]+)))?"""
)
REFERENCE = r"(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);"
PLAIN_REFERENCE = re.compile(f"&{REFERENCE}")
OTHER_REFERENCE = re.compile(rf"&(?!{REFERENCE}|[ \t\r\n])")
RAW_TEXT_TAGS = ("script", "style")
RAW_TEXT_END = re.compile(r"</\s*(?:script|style)", re.IGNORECASE)
#: Distinct tags whose reading a worker remembers at once.
KEPT_TAGS = 20_000


def _character(match: re.Match) -> str:
    name = match.group(1)
    return unescape(match.group()) if name[0] == "#" else _named(name)


def _named(name: str) -> str:
    return html5.get(f"{name};") or f"&{name}"


def _read_tag(tag: str, raw: bool = False) -> tuple | None:
    """The event of a tag, or None when it is not plain; ``raw``: its text has been read with it."""
    found = PLAIN_TAG.fullmatch(tag)
    if not found:
        return None
    closing, name, attributes, slash = found.groups()
    name = name.lower()
    if closing:
        return None if attributes or slash else (END, name)
    cls = href = None
    if attributes:
        for key, double, single, bare in PLAIN_ATTRIBUTE.findall(attributes):
            key = key.lower()
            if key == "class" or key == "href":
                value = double or single or bare
                if "&" in value:
                    if OTHER_REFERENCE.search(value):
                        return None
                    value = unescape(value)
                if key == "class":
                    cls = " ".join(value.split())
                else:
                    href = value
    # Scripts and styles are read with their text, or not here.
    return None if name in RAW_TEXT_TAGS and not slash and not raw else (START, name, cls, href, slash)


class PlainEvents:
    """Events of pages of plain markup. The tags of listings repeat, so each is read once."""

    def __init__(self) -> None:
        self.tags: dict[str, tuple | None] = {}

    def read(self, html: str) -> list[tuple] | None:
        """Events of a page, or None when something else than plain markup turns up."""
        found = MARKUP.findall(html)
        begin = html.find("<")
        events = []
        add, known = events.append, self.tags
        if begin:
            text = html if begin < 0 else html[:begin]
            if "&" in text and (text := _unescaped(text)) is None:
                return None
            if text:
                add((TEXT, text))
        n_open = len(found)  # how many "<" the pieces account for
        for tag, raw, raw_text, mark, text in found:
            if tag:
                try:
                    event = known[tag]
                except KeyError:
                    if len(known) >= KEPT_TAGS:
                        known.clear()
                    event = known[tag] = _read_tag(tag)
                if event is None:
                    return None
                add(event)
            elif raw:
                event = _read_tag(raw, True)
                if event is None or RAW_TEXT_END.search(raw_text):
                    return None
                add(event)
                if raw_text:
                    add((TEXT, raw_text))
                add((END, event[1]))
                n_open += raw.count("<") + raw_text.count("<") + 1
            else:
                if mark[1] != "-" and not PLAIN_DOCTYPE.fullmatch(mark):
                    return None
                add((CUT,))
                n_open += mark.count("<")
            if text:
                if "&" in text and (text := _unescaped(text)) is None:
                    return None
                add((TEXT, text))
        return events if n_open == html.count("<") else None


def _unescaped(text: str) -> str | None:
    return None if OTHER_REFERENCE.search(text) else PLAIN_REFERENCE.sub(_character, text)


class StandardEvents(HTMLParser):
    """Events of any page, from the standard library's tokenizer."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)

    def read(self, html: str) -> list[tuple]:
        self.events: list[tuple] = []
        self.reset()
        self.feed(html)
        self.close()
        return self.events

    def handle_starttag(self, tag, attrs, empty=False):
        named = {name: value or "" for name, value in attrs}
        cls = named.get("class")
        self.events.append((START, tag, cls and " ".join(cls.split()), named.get("href"), empty))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs, empty=True)

    def handle_endtag(self, tag):
        self.events.append((END, tag))

    def handle_data(self, data):
        self.events.append((TEXT, data))

    def handle_charref(self, name):
        self.events.append((TEXT, unescape(f"&#{name};")))

    def handle_entityref(self, name):
        self.events.append((TEXT, _named(name)))

    def handle_comment(self, data):
        self.events.append((CUT,))

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self.events.append((CUT,))
        if data[:6].upper() == "CDATA[":
            self.events += [(TEXT, data[6:]), (CUT,)]


class NodeColumns:
    """Pages as flat columns: a node per element in document order, and the text pieces.

    Node 0 of a page is the document. ``end`` is the first node after the subtree, ``next`` the
    next sibling, and ``pieces[seg_from:seg_to]`` the subtree's text, so nothing is stored twice.
    All numbers count from the start of the page. ``own`` is the text of elements such as scripts,
    which is not text of the elements around them. ``cls`` is the class attribute with single
    spaces, null without one.
    """

    def __init__(self) -> None:
        for name in NODE.names:
            setattr(self, name, [])
        self.pieces: list[str] = []

    def add_page(self, events: Iterable[tuple]) -> None:
        """Void elements close at once, an end tag closes up to the nearest open element of its
        name, a stray end tag is ignored, and nothing is closed implicitly."""
        tags, parent, after, end = ["[document]"], [-1], [None], [0]
        cls, href, own, seg_from, seg_to = [None], [None], [None], [0], [0]
        pieces: list[str] = []
        text: list[str] = []
        stack, last = [0], [-1]  # the open elements, and the last child of each
        n_open: dict[str, int] = {}  # open elements per name
        asides: list[int] = []
        aside_pieces: dict[int, list[str]] = {}

        def cut() -> None:
            piece = " ".join((text[0] if len(text) == 1 else "".join(text)).split())
            text.clear()
            if piece and asides:
                name = tags[asides[-1]]
                for i in asides:  # the open elements of the innermost one's name
                    if tags[i] == name:
                        aside_pieces[i].append(piece)
            elif piece:
                pieces.append(piece)

        def close() -> None:
            i = stack.pop()
            last.pop()
            if i:
                n_open[tags[i]] -= 1
            end[i] = len(tags)
            seg_to[i] = len(pieces)
            if asides and asides[-1] == i:
                asides.pop()

        for event in events:
            kind = event[0]
            if kind == TEXT:
                text.append(event[1])
            elif kind == START:
                if text:
                    cut()
                _, tag, class_names, link, empty = event
                i = len(tags)
                if last[-1] >= 0:
                    after[last[-1]] = i
                last[-1] = i
                tags.append(tag)
                parent.append(stack[-1])
                after.append(None)
                cls.append(class_names)
                href.append(link)
                seg_from.append(len(pieces))
                if empty or tag in VOID_TAGS:
                    end.append(i + 1)
                    seg_to.append(len(pieces))
                    own.append("" if tag in ASIDE_TAGS else None)
                    continue
                end.append(0)
                seg_to.append(0)
                own.append(None)
                stack.append(i)
                last.append(-1)
                n_open[tag] = n_open.get(tag, 0) + 1
                if tag in ASIDE_TAGS:
                    asides.append(i)
                    aside_pieces[i] = []
            elif kind == END:
                tag = event[1]
                if tag in VOID_TAGS:
                    continue
                if text:
                    cut()
                if n_open.get(tag):
                    left = n_open[tag]
                    while n_open[tag] == left:
                        close()
            elif text:
                cut()
        if text:
            cut()
        while stack:
            close()
        for i, found in aside_pieces.items():
            own[i] = " ".join(found)
        self.idx.extend(range(len(tags)))
        self.tag += tags
        self.parent += parent
        self.next += after
        self.end += end
        self.cls += cls
        self.href += href
        self.own += own
        self.seg_from += seg_from
        self.seg_to += seg_to
        self.pieces += pieces


#: Kinds of tags that :class:`PlainTrees` tells apart.
CLOSES, OPENS, STANDS = range(3)
#: Open elements among which an end tag is looked for.
DEEP = 256


class PlainTrees:
    """Pages of plain markup as the lists that marks are made from, in one pass and without events.

    What :class:`PlainEvents` and :class:`NodeColumns` find, for pages whose markup is plainer still: None
    for others, such as those with ``>`` in a quoted value, with ``template`` or ``rt`` elements, or end
    tags of void elements. ``takers`` gives the selectors that may take an element of a tag and class.
    """

    def __init__(self, takers: Callable[[tuple], list[int]]) -> None:
        self.takers = takers
        self.tags: dict[str, tuple | None] = {}

    def _tag(self, tag: str) -> tuple | None:
        event = _read_tag(tag)
        if event is None or event[1] in ASIDE_TAGS and event[0] == START:
            return None
        if event[0] == END:
            return None if event[1] in VOID_TAGS else (CLOSES, event[1], None, None)
        _, name, cls, _, empty = event
        return STANDS if empty or name in VOID_TAGS else OPENS, name, event, self.takers((name, cls))

    def read(self, html: str) -> tuple | None:
        """``nodes, parent, end, seg_from, seg_to, pieces, own, taken``: as in :class:`NodeColumns`, but
        ``nodes`` are start events, ``own`` is by node, and ``taken`` are nodes with their selectors."""
        known = self.tags
        nodes, parent, end, seg_from, seg_to = [ROOT], [-1], [0], [0], [0]
        pieces: list[str] = []
        own: dict[int, str] = {}
        taken: list[tuple[int, list[int]]] = []
        stack, names = [0], [None]  # the open elements and their names
        whole = "<!" in html or "<script" in html or "<style" in html
        chunks = WHOLE_MARKUP.split(html) if whole else [html]
        for at in range(0, len(chunks), 4):
            if at:
                raw, raw_text, mark = chunks[at - 3 : at]
                if raw is None:
                    if mark[1] != "-" and not PLAIN_DOCTYPE.fullmatch(mark):
                        return None
                else:
                    event = _read_tag(raw, True)
                    if event is None or RAW_TEXT_END.search(raw_text):
                        return None
                    i = len(nodes)
                    if numbers := self.takers(event[1:3]):
                        taken.append((i, numbers))
                    nodes.append(event)
                    parent.append(stack[-1])
                    end.append(i + 1)
                    seg_from.append(len(pieces))
                    seg_to.append(len(pieces))
                    own[i] = " ".join(raw_text.split())
            parts = iter(chunks[at].split("<"))
            text = next(parts)
            if text:
                if "&" in text and (text := _unescaped(text)) is None:
                    return None
                if text := " ".join(text.split()):
                    pieces.append(text)
            for part in parts:
                tag, closed, text = part.partition(">")
                try:
                    entry = known[tag]
                except KeyError:
                    if not closed:
                        return None
                    if len(known) >= KEPT_TAGS:
                        known.clear()
                    entry = known[tag] = self._tag(tag)
                if entry is None or not closed:
                    return None
                kind, name, event, numbers = entry
                if kind == CLOSES:
                    if names[-1] == name:
                        names.pop()
                        i = stack.pop()
                        end[i] = len(nodes)
                        seg_to[i] = len(pieces)
                    elif len(names) > DEEP:
                        return None
                    elif name in names:
                        left = None
                        while left != name:
                            left = names.pop()
                            i = stack.pop()
                            end[i] = len(nodes)
                            seg_to[i] = len(pieces)
                else:
                    i = len(nodes)
                    if numbers:
                        taken.append((i, numbers))
                    nodes.append(event)
                    parent.append(stack[-1])
                    seg_from.append(len(pieces))
                    if kind == OPENS:
                        end.append(0)
                        seg_to.append(0)
                        stack.append(i)
                        names.append(name)
                    else:
                        end.append(i + 1)
                        seg_to.append(len(pieces))
                if text:
                    if "&" in text and (text := _unescaped(text)) is None:
                        return None
                    if text := " ".join(text.split()):
                        pieces.append(text)
        for i in stack:
            end[i] = len(nodes)
            seg_to[i] = len(pieces)
        return nodes, parent, end, seg_from, seg_to, pieces, own, taken


def nfkc_batch(values: pa.Array) -> pa.Array:
    """Each distinct value is normalised once. (Arrow's own NFKC does not compose, so it is not used.)"""
    if values.null_count == len(values):
        return values
    coded = values.dictionary_encode()
    plain = pa.array([normalize("NFKC", v) for v in coded.dictionary.to_pylist()], pa.string())
    return plain.take(coded.indices)


def reader():
    """A function from html to events; None for null and for what the tokenizer rejects."""
    plain, standard = PlainEvents(), StandardEvents()

    def read(html: str | None) -> list[tuple] | None:
        if html is None:
            return None
        events = plain.read(html)
        if events is not None:
            return events
        try:
            return standard.read(html)
        except AssertionError:  # the tokenizer's answer to markup it rejects
            return None

    return read


def parser(fields: list[str], with_text: bool):
    """A function over batches ``(..., html)`` to ``(..., nodes[, segs])``; unreadable html gives null.

    Nodes have the named fields only, and ``segs`` is left out without ``with_text``.
    """

    def parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = reader()
        for batch in batches:
            for start in range(0, batch.num_rows, PAGES_PER_BATCH):
                yield _parse_slice(read, batch.slice(start, PAGES_PER_BATCH), fields, with_text)

    return parse_batches


def _list_array(offsets: list, values: pa.Array) -> pa.Array:
    # A null offset marks a null list.
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _parse_slice(read, batch: pa.RecordBatch, fields: list[str], with_text: bool) -> pa.RecordBatch:
    columns = NodeColumns()
    node_at, piece_at = [], []
    for html in batch.column("html").to_pylist():
        events = read(html)
        node_at.append(None if events is None else len(columns.tag))
        piece_at.append(None if events is None else len(columns.pieces))
        if events is not None:
            columns.add_page(events)
    node_at.append(len(columns.tag))
    piece_at.append(len(columns.pieces))
    wanted = [NODE.field(name) for name in fields]
    nodes = pa.StructArray.from_arrays([pa.array(getattr(columns, f.name), f.type) for f in wanted], fields=wanted)
    added = {"nodes": _list_array(node_at, nodes)}
    if with_text:
        added["segs"] = _list_array(piece_at, pa.array(columns.pieces, pa.string()))
    kept = [i for i, name in enumerate(batch.schema.names) if name != "html"]
    return pa.RecordBatch.from_arrays(
        [batch.column(i) for i in kept] + list(added.values()),
        names=[batch.schema.names[i] for i in kept] + list(added),
    )
