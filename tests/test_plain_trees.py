"""Plain pages read in one pass give the marks of the whole tree."""

import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brickrow.selectors import Marks, Selector
from brickrow.workers import NodeColumns, PlainTrees, reader
from tests.test_workers import PIECES

SELECTORS = [
    Selector("block", tags=("p", "h4", "div", "b", "i"), wants=("text", "near", "parent", "parent_text")),
    Selector("link", tags=("a", "div"), wants=("href", "link", "text")),
    Selector("script", tags=("script", "style"), wants=("text",)),
    Selector("cls", cls="x", first=True, wants=("text",)),
    Selector("page", root=True, wants=("text",)),
]


def both(html):
    plain, whole = Marks(SELECTORS, {}), Marks(SELECTORS, {})
    tree = PlainTrees(plain.takers).read(html)
    if tree is None:
        return None
    plain.add_tree(*tree)
    page = NodeColumns()
    page.add_page(reader()(html))
    whole.add_page(page)
    return plain.rows, whole.rows


@settings(max_examples=3000, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_one_pass_agrees_with_the_whole_tree(html):
    found = both(html)
    if found is not None:
        assert found[0] == found[1]


@pytest.mark.parametrize(
    "html",
    [
        "", "a &amp; b", "<p>a<p>b</div>c</p>d", "<div><p>a</div><i>b</i></p>", "<br>a<br/>b<i/>c", "<b class=' x  y'>t</b>",
        "<div>a<script>var t='</p><p>';</script>b<style>q</style></div>", "<!DOCTYPE html><!-- <p> --><p>x<!-- - -->y</p>",
    ],
)
def test_plain_pages_are_read_in_one_pass(html):
    found = both(html)
    assert found is not None and found[0] == found[1]


@pytest.mark.parametrize(
    "html", ["a < b", "<p", "<a href='x>y'>z</a>", "x &amp y", "a</br>b", "<template>t</template>", "<script>x", "<script/>", "<p =x>", "<![CDATA[c]]>"]
)
def test_other_pages_are_left_to_the_whole_reading(html):
    assert both(html) is None


def test_odd_pages_take_linear_time():
    n = 40_000
    for html in ["<p>" * n + "</div>" * n, "<p><i>" * n + "</p>" * n, "<p>x" * n]:
        start = time.perf_counter()
        PlainTrees(Marks(SELECTORS, {}).takers).read(html)
        assert time.perf_counter() - start < 5
