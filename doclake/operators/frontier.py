"""What to fetch next: listing pages, documents, retries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.functions.pages import read_bodies, read_listing, read_search
from doclake.functions.requests import conditional_headers, listing_url, on_domain
from doclake.functions.text import blank, clean_text, iso_date, total_results
from doclake.functions.windows import scope_grid
from doclake.operators.identity import join_existing
from doclake.profile import DEFAULT_PROFILE, SourceProfile
from doclake.schema import (
    MISSING_METADATA,
    NO_BODIES,
    RATE_LIMIT_STATUS,
    RETRY_TIMES,
    RETRYABLE_STATUS,
)


def discover_bodies(pages: DataFrame, profile: SourceProfile = DEFAULT_PROFILE) -> DataFrame:
    """(body_id, body) offered by the filter boxes of search pages (column ``payload``)."""
    found = pages.select(F.explode(read_bodies(F.col("payload"), profile)).alias("found"))
    return found.select("found.*")


def filter_bodies(bodies: DataFrame, wanted: str | DataFrame | None = None) -> DataFrame:
    """Keep the wanted body ids: a comma-separated list, a table with ``body_id``, or all."""
    if isinstance(wanted, DataFrame):
        return bodies.join(wanted.select("body_id"), "body_id", "left_semi")
    if not wanted:
        return bodies
    return bodies.where(F.col("body_id").isin([part.strip() for part in wanted.split(",")]))


def no_bodies(
    pages: DataFrame, wanted: str | None = None, profile: SourceProfile = DEFAULT_PROFILE
) -> DataFrame:
    """Failure rows of search pages (url, payload) that offer none of the wanted bodies.

    A page that cannot be read has the code and reason of its error.
    """
    ids = [part.strip() for part in wanted.split(",")] if wanted else []
    found = read_search(F.col("payload"), profile)
    hits = F.filter("found.bodies", lambda b: b["body_id"].isin(ids) if ids else F.lit(True))
    none = F.lit(None).cast("string")
    return (
        pages.withColumn("found", found)
        .where(F.size(hits) == 0)
        .select(
            "url",
            F.coalesce("found.error_code", F.lit("no_bodies")).alias("error_code"),
            F.coalesce("found.reason", F.lit(NO_BODIES)).alias("reason"),
            *[none.alias(name) for name in ("body", "partition", "identifier")],
        )
    )


def bodies_list(bodies: DataFrame) -> DataFrame:
    return bodies.select("body").distinct()


def listing_plan(
    bodies: DataFrame,
    start: date | str,
    end: date | str,
    size: str = "monthly",
    profile: SourceProfile = DEFAULT_PROFILE,
) -> DataFrame:
    """First listing page of every body and window."""
    grid = scope_grid(bodies, start, end, size)
    first_page = F.lit(1)
    url = listing_url(
        profile.search_url, F.col("window_start"), F.col("window_end"), F.col("body_id"), first_page
    )
    return grid.select(
        "body_id", "body", "partition", "partition_date", first_page.alias("page"), url.alias("url")
    )


def read_listings(pages: DataFrame, profile: SourceProfile = DEFAULT_PROFILE) -> DataFrame:
    """Listing pages (url, payload, ...) with ``listing`` read from them; the payload is dropped."""
    listing = read_listing(F.col("payload"), F.col("url"), profile)
    text = F.decode(F.col("payload"), "ISO-8859-1")
    rows = pages.withColumn("listing", listing)
    return rows.withColumn("total_results", total_results(F.col("listing.head"), text)).drop("payload")


def listing_cards(listings: DataFrame) -> DataFrame:
    """One row per card with its position on the page, cleaned and dated."""
    carried = [c for c in listings.columns if c not in ("listing", "total_results")]
    exploded = listings.select(*carried, F.posexplode("listing.cards").alias("position", "card"))
    link_text = clean_text(F.col("card.link_text"))
    reference = clean_text(F.col("card.identifier"))
    return exploded.select(
        *[F.col(c).alias("listing_url" if c == "url" else c) for c in carried],
        "position",
        F.when(reference != "", reference).otherwise(link_text).alias("identifier"),
        link_text.alias("title"),
        clean_text(F.col("card.description")).alias("description"),
        iso_date(clean_text(F.col("card.date"))).alias("date"),
        F.col("card.url").alias("url"),
        F.col("card.document_url").alias("document_url"),
    )


def split_cards(cards: DataFrame) -> DataFrame:
    """Add error_code and reason: a card needs an identifier and a link."""
    bad = blank(F.col("identifier")) | blank(F.col("document_url"))
    return cards.withColumns(
        {
            "error_code": F.when(bad, F.lit("missing_metadata")),
            "reason": F.when(bad, F.lit(MISSING_METADATA)),
        }
    )


def rejected_cards(cards: DataFrame) -> DataFrame:
    """Failure rows of the cards that cannot be fetched."""
    url = F.coalesce(F.nullif("document_url", F.lit("")), F.col("listing_url"))
    return (
        split_cards(cards)
        .where("error_code is not null")
        .select(url.alias("url"), "error_code", "reason", "body", "partition", F.lit(None).cast("string").alias("identifier"))
    )


def unreadable_listings(listings: DataFrame) -> DataFrame:
    """Failure rows of the listing pages that could not be read."""
    return listings.where("listing.error_code is not null").select(
        "url", "listing.error_code", "listing.reason", "body", "partition", F.lit(None).cast("string").alias("identifier")
    )


def document_plan(cards: DataFrame, stored: DataFrame) -> DataFrame:
    """Record, URL and conditional headers of every fetchable card."""
    good = split_cards(cards).where("error_code is null").drop("error_code", "reason", "url")
    known = join_existing(good, stored, "http_etag", "http_last_modified")
    title = F.coalesce(F.nullif("title", F.lit("")), F.col("identifier"))
    headers = conditional_headers(
        F.col("existing.http_etag"), F.col("existing.http_last_modified")
    )
    return known.withColumns(
        {"title": title, "source_url": F.col("document_url"), "headers": headers}
    ).drop("existing")


def suppress_requests(
    requests: DataFrame, order: str, profile: SourceProfile = DEFAULT_PROFILE
) -> DataFrame:
    """Add ``suppressed``: 'offsite', 'duplicate' (not the first request for its URL) or null.

    The first request per URL is an aggregate that combines before the shuffle, and joins back on
    the unique (URL, order) pair, so a URL asked for a billion times is no heavier than any other.
    """
    first = (
        requests.groupBy("document_url")
        .agg(F.min(order).alias(order))
        .select("document_url", order, F.lit(True).alias("first"))
    )
    joined = requests.join(first, ["document_url", order], "left")
    reason = F.when(~on_domain(F.col("document_url"), profile.allowed_domain), "offsite").when(
        F.col("first").isNull(), "duplicate"
    )
    return joined.withColumn("suppressed", reason).drop("first")


def next_pages(listings: DataFrame) -> DataFrame:
    """Follow-up page of every listing page that has cards and a next link."""
    more = (F.size("listing.cards") > 0) & ~blank(F.col("listing.next_href"))
    return listings.where(more).select(
        "body", "partition", "partition_date", (F.col("page") + 1).alias("page"), F.col("listing.next_url").alias("url")
    )


def missing_pages(listings: DataFrame) -> DataFrame:
    """Follow-up pages nobody has captured yet."""
    return next_pages(listings).join(listings.select("url"), "url", "left_anti")


def rate_limited(attempts: DataFrame) -> DataFrame:
    """Throttled attempts; ``is_final`` marks those that no later attempt followed.

    As in ``suppress_requests``, the last attempt per URL is an aggregate that joins back on a
    unique pair, so one URL with most of the attempts is no heavier than the others.
    """
    last = (
        attempts.groupBy("document_url")
        .agg(F.max("fetch_seq").alias("fetch_seq"))
        .select("document_url", "fetch_seq", F.lit(True).alias("last"))
    )
    throttled = attempts.where(F.col("status").isin(*RATE_LIMIT_STATUS))
    return throttled.join(last, ["document_url", "fetch_seq"], "left").select(
        "fetch_seq",
        F.col("document_url").alias("url"),
        F.col("status").cast("string").alias("error_code"),
        F.nullif("retry_after", F.lit("")).alias("retry_after"),
        F.col("last").isNotNull().alias("is_final"),
    )


def retry_worklist(attempts: DataFrame, retries: int = RETRY_TIMES) -> DataFrame:
    """URLs whose last attempt may be retried and that have attempts left.

    An attempt without status had no answer: a timeout, a refused connection, a name not found.
    """
    last = F.max_by("status", "fetch_seq")
    per_url = attempts.groupBy("document_url").agg(
        F.count("*").alias("attempts"), last.alias("last_status")
    )
    lost = F.col("last_status").isNull()
    due = (lost | F.col("last_status").isin(*RETRYABLE_STATUS)) & (F.col("attempts") <= retries)
    return per_url.where(due)
