"""Pages as node columns."""

import time

from hypothesis import given, settings
from hypothesis import strategies as st

from brickrow.selectors import Marks, Selector
from brickrow.workers import NodeColumns, PlainEvents, StandardEvents, reader


def columns(html, plain=None):
    page = NodeColumns()
    events = PlainEvents().read(html)
    assert plain is None or (events is not None) == plain
    page.add_page(events if events is not None else StandardEvents().read(html))
    return page


def tree(html):
    page = columns(html)
    return list(zip(page.tag, page.parent))


def texts(html):
    page = columns(html)
    out = {}
    for i, tag in enumerate(page.tag):
        own = page.own[i]
        out.setdefault(tag, " ".join(page.pieces[page.seg_from[i] : page.seg_to[i]]) if own is None else own)
    return out


def test_unclosed_elements_nest_and_stray_end_tags_are_ignored():
    assert tree("<p><b>x<br><p>y</i></p></div>z</b>") == [("[document]", -1), ("p", 0), ("b", 1), ("br", 2), ("p", 2)]
    page = columns("<div><p>a</div><i>b</i>")
    assert page.tag == ["[document]", "div", "p", "i"]
    assert page.parent == [-1, 0, 1, 0]
    assert page.next == [None, 3, None, None]
    assert page.end == [4, 3, 3, 4]


def test_void_elements_close_at_once():
    assert tree("<br>a</br><br/><img src=x><i>b</i>") == [("[document]", -1), ("br", 0), ("br", 0), ("img", 0), ("i", 0)]
    assert tree("<div/><i>b</i>") == [("[document]", -1), ("div", 0), ("i", 0)]


def test_text_is_cut_by_tags_and_comments_only():
    assert columns("a &amp; b&eacute;<!-- x --> c<i>d</i>e").pieces == ["a & bé", "c", "d", "e"]
    assert columns("1&nbsp;000 &euro; &#8364; &#x20AC; &nosuch; x").pieces == ["1 000 € € € &nosuch x"]
    assert columns("  \n ").pieces == []


def test_scripts_and_the_like_are_no_text_of_their_parents():
    found = texts('<div>a<script>var t="</p>";</script><style>p{}</style><template><b>t</b></template>b</div>')
    assert found["div"] == "a b"
    assert found["script"] == 'var t="</p>";'
    assert found["style"] == "p{}"
    assert found["template"] == "t"
    assert found["b"] == ""
    assert texts("<ruby>x<rt>y</rt></ruby>")["ruby"] == "x"


def test_attributes():
    page = columns('<a class=" x  y " HREF="/q?a=1&amp;b=2">t</a><h4 class>u</h4><h4>v</h4><a href=\'z\' href=w>')
    assert page.cls == [None, "x y", "", None, None]
    assert page.href == [None, "/q?a=1&b=2", None, None, "w"]


def test_odd_markup_goes_to_the_standard_parser():
    for html in ["a < b", "<p", "<a href='x>y", "x &amp y", "<![CDATA[c]]>", "<script>x", "<!doctype html [x]>", "<p =x>"]:
        columns(html, plain=False)
    assert columns("a < b").pieces == ["a < b"]
    assert columns("<![CDATA[c]]>d").pieces in (["c", "d"], ["d"])


def test_odd_pages_take_linear_time():
    n = 40_000
    for html in ["<p>" * n + "</div>" * n, "<template>" + "<b>x</b>" * n, "<p><i>" * n + "</p>" * n]:
        start = time.perf_counter()
        columns(html)
        assert time.perf_counter() - start < 10


PIECES = st.sampled_from(
    ["<p>", "</p>", "<b class='x y'>", "</b>", "<br>", "<br/>", "</br>", "<div id=1 class=\"c\">", "</div>", "<a href=/x/y>", "<a href='q'/>", "</a>", "text ", " &amp; ", "&eacute;", "&nosuch;", "&#65;", "&#x41;", "&", "&am", "<", ">", "\n", "<!-- c -->", "<!---->", "<!-- a -- b -->", "<script>if (a<b) '</p>'</script>", "<script src=x></script>", "<STYLE>p</STYLE>", "<style>q</style >", "<!DOCTYPE html>", "<li>", "</li >", "<H4>", "</h4>", "é", "<template>", "</template>", "<a class=x href=\"a&amp;b\" disabled>", "<i\n>", "</i>", "<p/ >", "<x-y>", "<?pi?>"]
)


@settings(max_examples=1500, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_plain_reading_agrees_with_the_standard_parser(html):
    events = PlainEvents().read(html)
    if events is not None:
        ours, theirs = NodeColumns(), NodeColumns()
        ours.add_page(events)
        theirs.add_page(StandardEvents().read(html))
        assert vars(ours) == vars(theirs)


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_node_columns_are_a_tree(html):
    page = columns(html)
    for i in range(1, len(page.tag)):
        parent = page.parent[i]
        assert parent < i < page.end[i] <= page.end[parent]
        assert page.seg_from[parent] <= page.seg_from[i] <= page.seg_to[i] <= page.seg_to[parent]
        if page.next[i] is not None:
            assert page.next[i] == page.end[i] and page.parent[page.next[i]] == parent


def marks(html, *selectors):
    page, found = NodeColumns(), Marks(selectors, {})
    page.add_page(reader()(html))
    found.add_page(page)
    return [dict(zip(found.fields, row)) for row in found.rows]


def test_selectors_test_tag_class_text_and_target():
    html = '<h4>A</h4><p>1</p><h4 class="x">B</h4><h4 class>C</h4><b class="k x"> More  <i>Info</i></b><a href="/s/1">s</a><a>n</a>'
    assert [m["text"] for m in marks(html, Selector("h", tags=("h4",)))] == ["A", "B", "C"]
    assert [m["text"] for m in marks(html, Selector("h", tags=("h4",), no_class=True))] == ["A"]
    assert [m["idx"] for m in marks(html, Selector("x", cls="x"))] == [3, 5]
    assert [m["idx"] for m in marks(html, Selector("x", cls="k x"))] == [5]
    assert marks(html, Selector("x", cls="x k")) == []
    assert [m["idx"] for m in marks(html, Selector("x", cls="x", first=True))] == [3]
    assert [m["idx"] for m in marks(html, Selector("t", title="more info"))] == [5]
    assert [m["href"] for m in marks(html, Selector("a", tags=("a",), href_with="", wants=("href",)))] == ["/s/1"]
    assert marks(html, Selector("a", tags=("a",), href_with="/t/", wants=("href",))) == []


def test_marks_carry_what_is_wanted():
    html = "<div><h4>A</h4></div><section>cadastral <b>5</b></section><h2><i>x</i><a>y</a><a href=z>q</a></h2><script>s</script>"
    (head,) = marks(html, Selector("h", tags=("h4",), wants=("near", "parent", "parent_text")))
    assert head == {"sel": 0, "idx": 2, "near": "cadastral 5", "parent": 1, "parent_end": 3, "parent_text": "A"}
    (card,) = marks(html, Selector("c", tags=("h2",), wants=("link",)))
    assert card["link"] is None
    both = marks(html, Selector("p", root=True, holding="cadastral"), Selector("s", tags=("script", "h2"), holding="cadastral"))
    assert [(m["sel"], m["text"]) for m in both] == [(0, "A cadastral 5 x y q"), (1, None), (1, None)]
    assert [m["text"] for m in marks(html, Selector("s", tags=("script",)))] == ["s"]
    assert marks("", Selector("p", root=True)) == [{"sel": 0, "idx": 0, "text": None}]


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_marks_agree_with_the_whole_tree(html):
    events = reader()(html)
    if events is None:
        return
    page = NodeColumns()
    page.add_page(events)

    def text(i):
        if i is None or not 0 <= i < len(page.tag):
            return None
        own = page.own[i]
        return (" ".join(page.pieces[page.seg_from[i] : page.seg_to[i]]) if own is None else own) or None

    def near(i):
        parent = page.parent[i]
        places = [page.next[i], page.next[parent] if parent >= 0 else None, i + 1, i + 2, i + 3, i + 4]
        return next((text(p) for p in places if text(p)), None)

    expected = [(i, text(i), near(i)) for i in range(1, len(page.tag)) if page.tag[i] in ("p", "h4", "div")]
    found = marks(html, Selector("all", tags=("p", "h4", "div"), wants=("text", "near")))
    assert [(m["idx"], m["text"], m["near"]) for m in found] == expected
