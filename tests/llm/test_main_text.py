import itertools
import re
from html import unescape

import numpy as np
import pytest

from brickrow.llm import main_text as main
from brickrow.llm.queries import op10_main_text

SF = "/root/testdata/sf0.01"
PRIOR = np.array(list(main.PRIOR.values()))


def cost(side, lead, edges):
    own = sum(max(v, 0) if not s else max(-v, 0) for s, v in zip(side, lead))
    return own + sum(c for (i, j), c in edges.items() if side[i] != side[j])


def test_cut_equals_trying_all_sides():
    r = np.random.default_rng(2)
    for _ in range(150):
        n = int(r.integers(1, 9))
        lead = r.normal(0, 1, n).round(2)
        edges = {(i, j): round(float(r.random()), 2) for i in range(n) for j in range(i + 1, n) if r.random() < 0.5}
        got = main.cut(lead, edges)
        best = min(cost(s, lead, edges) for s in itertools.product([False, True], repeat=n))
        assert cost(got, lead, edges) == pytest.approx(best)


PAGE = """<html><head><title>T &am</title><style>p{}</style></head><body class="home has-sidebar">
<header><h1>Site</h1><ul class="menu"><li><a href="/">Home</a></li></ul></header>
<div id="cookie-notice">We use cookies.</div><!-- <p>no</p> -->
<div id="content"><header><h1>Real &amp; title</h1></header><p>Hello &lt;b&gt; this   is<br>text. It has sentences.
<div class="ad">Buy now</div><p>More&nbsp;text <b>here</b><script>var t = "</p><p>no";</script> ok.</p>
<ul><li>point one<li>point two</ul><table><tr><td>cell a<td>cell b</table></div>
<div class="sidebar"><p>Related story</p></div><section id="comments"><p>Great post! I liked it.</p></section>
<form><label>Name</label><button>Send</button></form><footer>&copy; 2020</footer></body></html>"""


def test_a_page_with_everything_around_its_text():
    want = "Real & title\nHello <b> this is text. It has sentences.\nMore text here ok.\npoint one\npoint two\ncell a\ncell b"
    assert main.main_text(PAGE, PRIOR) == want


def test_words_in_values_of_other_attributes_are_no_attributes():
    prose = "A long paragraph of plain text that says a lot. It goes on, and on."
    for tag in ['p title="the hidden gem"', 'div data-note="a hidden thing"', "p title='class=ad'", 'p data-x=" style=display:none"']:
        assert main.main_text(f"<article><{tag}>{prose}</{tag.split()[0]}></article>", PRIOR) == prose
    for tag in ["p hidden", 'p hidden="until-found"', 'p data-a="x" hidden', 'p style="display: none"', "p STYLE='display:none'"]:
        assert main.main_text(f"<article><p>{prose}</p><{tag}>{prose} Twice.</p></article>", PRIOR) == prose


def test_a_page_without_any_markup_for_its_parts():
    page = """<div><a href=x>Home</a> <a href=y>About</a></div><div><p>A long paragraph of plain text that
    says a lot. It goes on, and on, and on.</p><p>Short.</p><p>Another paragraph which also has sentences. Yes.</p></div>
    <div><a href=z>Privacy</a> | <a href=q>Terms</a></div>"""
    kept = main.main_text(page, PRIOR)
    assert "goes on" in kept and "Short." in kept and "Another" in kept and "Privacy" not in kept and "Home" not in kept


@pytest.mark.parametrize("html", ["", " ", "<p", "<!-- never ends <p>x</p>", "</p></div>", "<script>var a", "<p>a</p", "<a href='>'>x</a>", "&am", "<p hidden>x</p>", "<" * 50])
def test_broken_pages(html):
    assert isinstance(main.main_text(html, PRIOR), str)
    assert main.main_text("<article><p>kept text.</p>" + html, PRIOR).startswith("kept text.")


def test_blocks_are_whole_and_in_order():
    assert [b.text for b in main.blocks("x<p>a<b>b</b>\n c<br>d<p>e<div>f</div>g")] == ["x", "ab c d", "e", "f", "g"]


def test_query_keeps_the_articles_of_the_test_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op10_main_text(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        html = pages[r.page_id].html
        inside = re.search(r"(?s)<article>(.*?)(</article>|$)", html)
        parts = re.split(r"</?(?:p|h1)>", inside[1]) if inside else []
        texts = [" ".join(unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split()) for p in parts]
        assert r.text == "\n".join(t for t in texts if t)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_odd_and_no_pages(spark):
    long = "<article>" + "<p>some words in a row. </p>" * 20000 + "</article>"
    rows = [(1, "u", None), (None, None, "<p>" + PAGE), (2, None, ""), (2, None, ""), (3, "v", long)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars")
    weights = main.fit(pages)
    found = main.extract(pages, weights).collect()
    assert sorted(len(r.text) for r in found)[:3] == [0, 0, 0] and len(found) == 5
    assert max(len(r.text) for r in found) == 20000 * 21 - 1
    assert main.extract(pages.limit(0), main.fit(pages.limit(0))).collect() == []
