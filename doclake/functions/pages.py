"""Page readers: the only Python in the data path, as Arrow batch functions.

Each returns plain values; clean-up, date parsing and failure handling stay native. A page that
cannot be read comes back as data (``error_code``), never as an exception that would end the job.
"""

from __future__ import annotations

from functools import cache
from html import escape
from urllib.parse import urljoin

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

import doclake
from doclake.functions.markup import OPEN, Page, any_matcher, decode
from doclake.profile import DEFAULT_PROFILE, SourceProfile
from doclake.schema import NO_CONTAINER

# The functions travel to the workers with their code: the package need not be installed there.
cloudpickle.register_pickle_by_value(doclake)


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


CARD = _strings("identifier", "link_text", "description", "date", "url", "document_url")
CLEANED = _strings("title", "container", "error_code", "reason").add("clean", T.BinaryType())
LISTING = _strings("head", "next_href", "next_url", "error_code", "reason").add("cards", T.ArrayType(CARD))
BODIES = T.ArrayType(_strings("body_id", "body"))
SEARCH = T.StructType().add("bodies", BODIES).add("error_code", "string").add("reason", "string")


# Fixed value: the page a cleaned container is put into.
_DOCUMENT = """<!DOCTYPE html>
<html lang="en">
<head><meta charset="utf-8"><title>{title}</title></head>
<body>
{body}
</body>
</html>
"""
# Fixed value: the title of a page that has none.
_UNTITLED = "decision"


def _clean(payload: bytes, profile: SourceProfile) -> dict:
    page = Page(decode(payload))
    for selector in profile.containers:
        container = next(page.select(selector), None)
        if container is not None and page.text(container):
            break
    else:
        return {
            "error_code": "ContentNotFound",
            "reason": f"{NO_CONTAINER}{profile.containers}",
        }
    is_interface = any_matcher(profile.ui)
    dropped, headings, index = set(), [], container.first + 1
    while index < container.last:
        kind, data = page.items[index]
        if kind == OPEN:
            if is_interface(data):
                dropped.add(index)
                index = data.last
            elif data.tag in ("h1", "h2"):
                headings.append(data)
        index += 1
    body = page.render(container, dropped, frozenset(profile.kept_attributes))
    title = _title(page, headings, dropped)
    document = _DOCUMENT.format(title=escape(title), body=body)
    return {"clean": document.encode("utf-8", "replace"), "title": title, "container": selector}


def _title(page: Page, headings: list, dropped: set[int]) -> str:
    """The page title, else the first heading of what was kept, else a fixed word."""
    for element in [*list(page.select("title"))[:1], *headings[:1]]:
        text = page.text(element, dropped)
        if text:
            return text
    return _UNTITLED


def _listing(payload: bytes, url: str, profile: SourceProfile) -> dict:
    page = Page(decode(payload))
    base = next((e.attrs["href"] for e in page.select("base") if e.attrs.get("href")), None)
    base_url = _join(url or "", base.strip(), url or "") if base else url or ""

    def texts(selector, scope=None):
        return [t for e in page.select(selector, scope) for t in page.own_texts(e)]

    def first(values):
        return next(iter(values), None)

    def hrefs(selector, scope=None):
        return (e.attrs["href"] for e in page.select(selector, scope) if "href" in e.attrs)

    cards = []
    for card in page.select(profile.card):
        href = (first(hrefs(profile.card_link, card)) or "").strip()
        cards.append(
            {
                "identifier": first(texts(profile.card_reference, card)),
                "link_text": first(texts(profile.card_link, card)),
                "description": " ".join(texts(profile.card_description, card)),
                "date": first(texts(profile.card_date, card)),
                "url": href,
                "document_url": _join(base_url, href) if href else "",
            }
        )
    next_href = first(hrefs(profile.next_link))
    return {
        "head": " ".join(texts(profile.result_head)),
        "next_href": next_href,
        "next_url": _join(base_url, next_href.strip()) if next_href else None,
        "cards": cards,
    }


def _join(base: str, href: str, otherwise: str | None = None) -> str:
    try:
        return urljoin(base, href)
    except ValueError:  # e.g. a malformed IPv6 host
        return href if otherwise is None else otherwise


def _bodies(payload: bytes, profile: SourceProfile) -> list[dict]:
    page = Page(decode(payload))
    labels: dict[str, str] = {}
    for label in page.select(f"{profile.body_group} label"):
        texts = page.own_texts(label)
        if texts:
            labels.setdefault(label.attrs.get("for", ""), texts[0].strip())
    found = []
    for box in page.select(f"{profile.body_group} {profile.body_checkbox}"):
        value = box.attrs.get("value", "").strip()
        name = labels.get(box.attrs.get("id", ""), "")
        if value and name:
            found.append({"body_id": value, "body": name})
    return found


@cache
def _cleaner(profile: SourceProfile):
    def one(payload):
        if payload is None:
            return None
        try:
            return _clean(payload, profile)
        except Exception as error:  # a bad page is a failed row, not a failed job
            return {"error_code": type(error).__name__, "reason": str(error)}

    @F.arrow_udf(CLEANED)
    def clean(payloads: pa.Array) -> pa.Array:
        return pa.array([one(p.as_py()) for p in payloads], type=to_arrow_type(CLEANED))

    # Nondeterministic in name only: it keeps the optimizer from evaluating a page twice when a
    # later filter looks at the outcome.
    return clean.asNondeterministic()


@cache
def _listing_reader(profile: SourceProfile):
    def one(payload, url):
        try:
            return _listing(payload or b"", url, profile)
        except Exception as error:  # a bad page is a failed row, not a failed job
            return {"error_code": type(error).__name__, "reason": str(error), "cards": []}

    @F.arrow_udf(LISTING)
    def read(payloads: pa.Array, urls: pa.Array) -> pa.Array:
        rows = zip(payloads, urls, strict=True)
        return pa.array([one(p.as_py(), u.as_py()) for p, u in rows], type=to_arrow_type(LISTING))

    return read.asNondeterministic()


@cache
def _body_reader(profile: SourceProfile):
    def one(payload):
        try:
            return {"bodies": _bodies(payload or b"", profile)}
        except Exception as error:  # a bad page is a failed row, not a failed job
            return {"error_code": type(error).__name__, "reason": str(error), "bodies": []}

    @F.arrow_udf(SEARCH)
    def read(payloads: pa.Array) -> pa.Array:
        return pa.array([one(p.as_py()) for p in payloads], type=to_arrow_type(SEARCH))

    return read.asNondeterministic()


def clean_page(payload: Column, profile: SourceProfile = DEFAULT_PROFILE) -> Column:
    """struct<clean, title, container, error_code, reason> of one html document; null stays null."""
    return _cleaner(profile)(payload)


def read_listing(payload: Column, url: Column, profile: SourceProfile = DEFAULT_PROFILE) -> Column:
    """struct<head, next_href, next_url, error_code, reason, cards> of one listing page."""
    return _listing_reader(profile)(payload, url)


def read_search(payload: Column, profile: SourceProfile = DEFAULT_PROFILE) -> Column:
    """struct<bodies, error_code, reason> of one search page."""
    return _body_reader(profile)(payload)


def read_bodies(payload: Column, profile: SourceProfile = DEFAULT_PROFILE) -> Column:
    """array<struct<body_id, body>> of one search page."""
    return read_search(payload, profile)["bodies"]
