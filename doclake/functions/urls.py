"""Links resolved against the page they stand on, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parts of a reference: scheme, authority, path, query, fragment. Each is found by itself.
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AFTER_SCHEME = r"(?s)^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(.*)$"
_AUTHORITY = r"^//([^/?#]*)"
_AFTER_AUTHORITY = r"(?s)^(?://[^/?#]*)?(.*)$"
_PATH = r"^([^?#]*)"
_QUERY = r"(?s)^[^?#]*\?([^#]*)"
_FRAGMENT = r"(?s)^[^#]*#(.*)$"
# Fixed value: schemes whose references are resolved; all others are complete as they are.
HIERARCHICAL = ("http", "https", "ftp", "file")


class _Parts:
    def __init__(self, text: Column) -> None:
        # Browsers and parsers drop leading blanks and all line breaks and tabs.
        clean = F.regexp_replace(F.regexp_replace(text, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
        self.scheme = F.lower(F.regexp_extract(clean, _SCHEME, 1))
        rest = F.regexp_extract(clean, _AFTER_SCHEME, 1)
        self.authority = F.regexp_extract(rest, _AUTHORITY, 1)
        local = F.regexp_extract(rest, _AFTER_AUTHORITY, 1)
        self.path = F.regexp_extract(local, _PATH, 1)
        self.query = F.regexp_extract(local, _QUERY, 1)
        self.fragment = F.regexp_extract(local, _FRAGMENT, 1)


def _without_dots(segments: Column) -> Column:
    """A path from its segments: ``.`` is dropped, ``..`` takes the segment before it along."""
    none = F.array().cast("array<string>")

    def step(done: Column, segment: Column) -> Column:
        shorter = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(segment == "..", shorter).when(segment == ".", done).otherwise(F.concat(done, F.array(segment)))

    folded = F.aggregate(segments, none, step)
    # A reference that ends in dots names a folder.
    ended = F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(folded, F.array(F.lit("")))).otherwise(folded)
    joined = F.array_join(ended, "/")
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def _merged(base: Column, path: Column) -> Column:
    """The path of a relative reference on a page with the path ``base``."""
    folder = F.split(base, "/", -1)
    # Without its last segment, unless that is empty.
    kept = F.when(F.element_at(folder, -1) == "", folder).otherwise(F.slice(folder, F.lit(1), F.size(folder) - 1))
    joined = F.concat(kept, F.split(path, "/", -1))
    last = F.size(joined) - 1
    full = F.filter(joined, lambda s, i: (s != "") | (i == 0) | (i == last))
    return _without_dots(F.when(path.startswith("/"), F.split(path, "/", -1)).otherwise(full))


def _unsplit(scheme: Column, authority: Column, path: Column, query: Column, fragment: Column) -> Column:
    tail = F.concat(
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""),
    )
    rooted = F.when((path == "") | path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    return F.concat(scheme, F.lit("://"), authority, rooted, tail)


def absolute_url(base: Column, href: Column) -> Column:
    """Resolve a link against the page it stands on, by RFC 3986 where the page's url is hierarchical.

    An empty link stays empty and null stays null; a null or empty base leaves the link as it is, and
    so does a link with another scheme than the page. Empty queries and fragments are dropped.
    """
    page, link = _Parts(F.coalesce(base, F.lit(""))), _Parts(href)
    foreign = (link.scheme != "") & (link.scheme != page.scheme)
    complete = F.coalesce(base, F.lit("")) == ""
    path = F.when(link.path == "", page.path).otherwise(_merged(page.path, link.path))
    query = F.when((link.path == "") & (link.query == ""), page.query).otherwise(link.query)
    resolved = F.when(
        link.authority != "", _unsplit(page.scheme, link.authority, link.path, link.query, link.fragment)
    ).otherwise(_unsplit(page.scheme, page.authority, path, query, link.fragment))
    kept = complete | foreign | ~page.scheme.isin(*HIERARCHICAL)
    return F.when(href.isNull() | (href == "") | kept, href).otherwise(resolved)
