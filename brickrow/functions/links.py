"""Link resolution and URL tests as column expressions."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from brickrow import lookups

SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"
DOT_SEGMENT = r"(^|/)\.\.?(/|$)"

# The usual links, which need no taking apart: a path from the root without dot segments, and an
# absolute URL, both without query, fragment and parameters.
PLAIN_PATH = r"^(?:/[^/.?#;\x00-\x20][^/?#;\x00-\x20]*+)++/?\z"
PLAIN_REST = r"://[^/?#;\x00-\x20]++(?:/[^?#;\x00-\x20]*+)?\z"


def _resolved_path(path: Column) -> Column:
    """``.`` and ``..`` segments worked off; a relative path also loses its empty segments."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    inner = F.filter(F.slice(parts, 1, F.size(parts) - 1), lambda s: s != "")
    relative = F.concat(F.array(F.lit("")), inner, F.array(last))
    segments = F.when(path.startswith("/"), parts).otherwise(relative)
    stack = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done)
        .otherwise(F.concat(done, F.array(s))),
    )
    closed = F.when(last.isin(".", ".."), F.concat(stack, F.array(F.lit("")))).otherwise(stack)
    return F.array_join(closed, "/")


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _resolve_parts(parts: Column, href: Column, origin: str, scheme: str) -> Column:
    clean = F.when(parts.crooked, F.concat(_resolved_path(parts.bare), parts.params)).otherwise(parts.path)
    rooted = F.when((parts.path == "") | clean.startswith("/"), clean).otherwise(F.concat(F.lit("/"), clean))
    return (
        F.when((parts.scheme != "") & (parts.scheme != scheme), href)
        .when(parts.host != "", F.concat(F.lit(f"{scheme}://"), parts.host, parts.path, parts.query, parts.fragment))
        .otherwise(F.concat(F.lit(origin), rooted, parts.query, parts.fragment))
    )


def _split(link: Column) -> Column:
    """Scheme, host, path, query and fragment of a link, as a struct."""

    def of_rest(rest: Column) -> Column:
        target = F.regexp_extract(rest, r"(?s)^(?://[^/?#]*)?([^?#]*)", 1)
        # A ';' that ends the last segment carries no parameters and is dropped.
        return _bind(
            F.regexp_replace(target, "(?s)^((?:.*/)?[^/;]*);$", "$1"),
            lambda path: _bind(
                F.regexp_extract(path, "(?s)^((?:.*/)?[^/;]*)", 1),
                lambda bare: F.struct(
                    F.lower(F.regexp_extract(link, f"^({SCHEME}):", 1)).alias("scheme"),
                    F.regexp_extract(rest, "^//([^/?#]*)", 1).alias("host"),
                    path.alias("path"),
                    bare.alias("bare"),
                    F.substr(path, F.char_length(bare) + 1).alias("params"),
                    (bare.rlike(DOT_SEGMENT) | (~bare.startswith("/") & bare.contains("//"))).alias("crooked"),
                    F.regexp_extract(rest, r"(?s)^[^?#]*(\?[^#]+)", 1).alias("query"),
                    F.regexp_extract(rest, "(?s)^[^#]*(#.+)", 1).alias("fragment"),
                ),
            ),
        )

    return _bind(F.regexp_replace(link, f"^{SCHEME}:", ""), of_rest)


def resolve_link(href: Column, base_url: str) -> Column:
    """Absolute URL of ``href`` on the site ``base_url`` (scheme and host); empty is null.

    Gives what Python's ``urljoin`` gives. Another scheme leaves the link as it is.
    """
    base = urlsplit(base_url)
    if base.scheme not in ("http", "https") or not base.netloc or base.path.strip("/"):
        raise ValueError(f"base_url must be scheme and host only: {base_url!r}")
    origin = f"{base.scheme}://{base.netloc}"
    link = F.regexp_replace(F.regexp_replace(href, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    any_link = _bind(
        link, lambda v: _bind(_split(v), lambda parts: _resolve_parts(parts, href, origin, base.scheme))
    )
    return (
        F.when(href == "", None)
        .when(href.rlike(PLAIN_PATH), F.concat(F.lit(origin), href))
        .when(href.rlike(f"^{base.scheme}{PLAIN_REST}"), href)
        .otherwise(any_link)
    )


def root_relative(href: Column, base_url: str) -> Column:
    """Only a leading ``/`` is made absolute; every other link stays."""
    return F.when(href.startswith("/"), F.concat(F.lit(base_url.rstrip("/")), href)).otherwise(href)


def is_detail(url: Column) -> Column:
    return url.contains(lookups.DETAIL_MARK)


def is_staged(url: Column) -> Column:
    """Sale and project pages, in any letter case; null is not staged."""
    return F.coalesce(url.rlike(lookups.STAGING_PATTERN), F.lit(False))
