"""Request-side expressions: listing URLs, conditional headers, failure codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from doclake.functions.text import blank
from doclake.schema import NO_ANSWER


def site_date(day: Column) -> Column:
    return F.date_format(day, "d/M/yyyy")


def partition_label(start: Column, end: Column) -> Column:
    return F.concat_ws("/", start.cast("string"), end.cast("string"))


def query_value(value: Column) -> Column:
    """Form-encode one query value; slashes stay readable."""
    encoded = F.url_encode(value.cast("string"))
    for found, wanted in (("%2F", "/"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return encoded


def listing_url(search_url: str, start: Column, end: Column, body_id: Column, page: Column) -> Column:
    """The site's date filter is inclusive, so ``to`` is the day before the window's end."""
    parameters = {
        "decisions": F.lit("1"),
        "from": site_date(start),
        "to": site_date(F.date_sub(end, 1)),
        "body": body_id,
        "pageNumber": page,
    }
    pairs = [F.concat(F.lit(f"{name}="), query_value(v)) for name, v in parameters.items()]
    return F.concat(F.lit(f"{search_url}?"), F.concat_ws("&", *pairs))


def conditional_headers(etag: Column, last_modified: Column) -> Column:
    """Headers for the stored validators that are not empty; an empty map when there are none."""
    offered = F.create_map(
        F.lit("If-None-Match"), etag, F.lit("If-Modified-Since"), last_modified
    )
    return F.map_filter(offered, lambda _, value: ~blank(value))


def failure_code(status: Column, error_class: Column) -> Column:
    return (
        F.when(status.isNotNull(), status.cast("string"))
        .when(error_class == "DNSLookupError", "dns_lookup_error")
        .when(error_class.isin("TimeoutError", "TCPTimedOutError"), "timeout")
        .otherwise(F.coalesce(error_class, F.lit(NO_ANSWER[0])))
    )


def failure_reason(status: Column, message: Column) -> Column:
    http = F.concat(F.lit("http error "), status.cast("string"))
    return F.when(status.isNotNull(), http).otherwise(F.coalesce(message, F.lit(NO_ANSWER[1])))


def on_domain(url: Column, domain: str) -> Column:
    """True when the URL's host is the domain or one of its sub-domains."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    return F.coalesce((host == domain) | F.endswith(host, F.lit(f".{domain}")), F.lit(False))
