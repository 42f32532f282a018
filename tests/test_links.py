import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from brickrow.functions import links

BASE = "https://site.example"
KNOWN = {
    "/en/detail/a/b": "/en/detail/a/b",
    "en/detail/a": "/en/detail/a",
    "./x": "/x",
    "../en/detail/q": "/en/detail/q",
    "?page=2": "?page=2",
    "#top": "#top",
    "/a/./b/../c": "/a/c",
    " /a": "/a",
    "/a ": "/a ",
}


def test_known_links(evaluate):
    resolve = lambda c: links.resolve_link(c, BASE)
    assert evaluate(resolve, list(KNOWN)) == [BASE + path for path in KNOWN.values()]
    same = ["https://x.y/z", "mailto:a@b", "HTTP://X.Y/Z"]
    assert evaluate(resolve, same) == same
    assert evaluate(resolve, ["//cdn.x/y", "", None]) == ["https://cdn.x/y", None, None]


def test_links_resolve_as_in_the_standard_library(evaluate):
    rng = random.Random(7)
    parts = ["/", "/", "a", "b.html", "..", ".", "?", "#", "x=1", ";", "https:", "http:", "//", "h.st", " ", "\t", "1:2", "é", "&", "%20", "\n"]
    hrefs = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(6000)]
    hrefs = [h for h in dict.fromkeys(hrefs) if h]
    got = evaluate(lambda c: links.resolve_link(c, BASE), hrefs)
    wrong = [(h, g, urljoin(BASE, h)) for h, g in zip(hrefs, got) if g != urljoin(BASE, h)]
    assert wrong == [], wrong[:20]


def test_base_must_be_an_origin():
    with pytest.raises(ValueError):
        links.resolve_link(F.lit("x"), "https://site.example/path")


def test_url_tests(evaluate):
    urls = [f"{BASE}/en/detail/sale/house/1", f"{BASE}/en/projectdetail/2", f"{BASE}/EN/DETAIL/SALE/3", f"{BASE}/en/detail/rent/house/3", None]
    assert evaluate(links.is_detail, urls) == [True, False, False, True, None]
    assert evaluate(links.is_staged, urls) == [True, True, True, False, False]
    assert evaluate(lambda c: links.root_relative(c, BASE), ["/a", "a", None]) == [f"{BASE}/a", "a", None]
