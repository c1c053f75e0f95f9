"""Search and listing pages: bodies, cards, next pages, document requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.operators import frontier
from doclake.sources.workspace import materialize
from workload.inputs import CARDS, DECIDED, FETCHES, fetches, listing_pages
from workload.landing import landing_table
from workload.registry import query, table


def _search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search pages whose filter boxes are the suppliers, one page per supplier.

    A supplier with a small balance shows no label, so it is not a body.
    """
    key, name = F.col("s_suppkey"), F.col("s_name")
    label = F.when(F.col("s_acctbal") < 3000, " ").otherwise(F.concat(F.lit(" "), name, F.lit(" &amp; Co ")))
    html = F.concat(
        F.lit('<form id="CB2"><input type="checkbox" id="b'), key, F.lit('" value=" '), key,
        F.lit(' "><label for="b'), key, F.lit('">'), label,
        F.lit('</label><input type="checkbox" id="x"><label for="x">None</label></form>'
              '<input type="checkbox" id="y" value="7"><label for="y">Elsewhere</label>'),
    )
    url = F.concat(F.lit("https://decisions.example.test/en/search/"), key)
    return table(spark, sf_dir, "supplier").select(url.alias("url"), F.encode(html, "UTF-8").alias("payload"))


_BODIES = "SELECT CAST(s_suppkey AS VARCHAR) AS body_id, s_name || ' & Co' AS body FROM supplier WHERE s_acctbal >= 3000"


@query("discover_bodies", _BODIES)
def discover_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.discover_bodies(_search_pages(spark, sf_dir))


@query("filter_bodies", f"{_BODIES} AND s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def filter_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies wanted by id, the ids coming from another table."""
    nations = table(spark, sf_dir, "nation").where("n_regionkey = 1")
    wanted = table(spark, sf_dir, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi"
    )
    ids = wanted.select(F.col("s_suppkey").cast("string").alias("body_id"))
    return frontier.filter_bodies(frontier.discover_bodies(_search_pages(spark, sf_dir)), ids)


@query(
    "no_bodies",
    """
SELECT 'https://decisions.example.test/en/search/' || s_suppkey AS url, 'no_bodies' AS error_code,
  'body discovery returned no bodies' AS reason FROM supplier WHERE s_acctbal < 3000""",
)
def no_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.no_bodies(_search_pages(spark, sf_dir)).select("url", "error_code", "reason")


@query("bodies_list", f"SELECT DISTINCT body FROM ({_BODIES})")
def bodies_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.bodies_list(frontier.discover_bodies(_search_pages(spark, sf_dir)))


def _cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings = frontier.read_listings(listing_pages(spark, sf_dir))
    return frontier.listing_cards(listings)


# What the parser makes of a card: the link text stands in for a missing reference.
_READ = f"""{CARDS},
read AS (
  SELECT o_orderkey, listing_url, body, page, position, title, description, date, url, document_url,
    CASE WHEN identifier = '' THEN title ELSE identifier END AS identifier FROM cards)
"""


@query(
    "listing_cards",
    f"""WITH {_READ}
SELECT listing_url, body, page, CAST(position AS INTEGER) AS position, identifier, title, description, date, url, document_url
FROM read""",
)
def listing_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cards(spark, sf_dir).drop("partition", "partition_date")


@query(
    "reject_cards",
    f"""WITH {_READ}
SELECT CASE WHEN document_url = '' THEN listing_url ELSE document_url END AS url, 'missing_metadata' AS error_code,
  'listing card without identifier or link' AS reason, body, '2024-01-01/2024-02-01' AS partition
FROM read WHERE identifier = '' OR document_url = ''""",
)
def reject_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.rejected_cards(_cards(spark, sf_dir)).drop("identifier")


@query(
    "partition_started",
    """
WITH firsts AS (SELECT DISTINCT o_orderkey // 10 AS page_no FROM orders WHERE (o_orderkey // 10) % 5 = 0)
SELECT '{"ts":"2024-06-01","level":"INFO","logger":"frontier","event":"partition_started","body":"Panel ' || ((page_no // 5) % 7) ||
  '","partition":"2024-01-01/2024-02-01","total_results":' || CASE WHEN page_no % 2 = 0 THEN 1000 + page_no % 1000 ELSE page_no END || '}' AS value
FROM firsts""",
)
def partition_started(spark: SparkSession, sf_dir: str) -> DataFrame:
    from doclake.operators.events import listing_log

    listings = frontier.read_listings(listing_pages(spark, sf_dir))
    return listing_log(listings, F.lit("2024-06-01"))


_NEXT = """
pages_seen AS (SELECT DISTINCT o_orderkey // 10 AS page_no FROM orders),
following AS (
  SELECT 'Panel ' || ((page_no // 5) % 7) AS body, CAST(page_no % 5 + 2 AS INTEGER) AS page, page_no,
    'https://decisions.example.test/en/search/?body=' || (page_no // 5) || '&pageNumber=' || (page_no % 5 + 2) AS url
  FROM pages_seen WHERE page_no % 5 < 4)
"""


@query("next_links", f"WITH {_NEXT} SELECT body, page, url FROM following")
def next_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings = frontier.read_listings(listing_pages(spark, sf_dir))
    return frontier.next_pages(listings).select("body", "page", "url")


@query(
    "missing_listing_pages",
    f"""WITH {_NEXT},
captured AS (
  SELECT o_orderkey // 10 AS page_no FROM orders GROUP BY 1 HAVING max(o_totalprice) > 400000)
SELECT body, page, url FROM following
WHERE page_no IN (SELECT page_no FROM captured) AND page_no + 1 NOT IN (SELECT page_no FROM captured)""",
)
def missing_listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured are the pages that list an expensive order; the frontier is what follows them."""
    expensive = (
        table(spark, sf_dir, "orders")
        .groupBy(F.floor(F.col("o_orderkey") / 10).alias("page_no"))
        .agg(F.max("o_totalprice").alias("top"))
        .where("top > 400000")
    )
    page_no = F.regexp_extract("url", r"body=(\d+)", 1).cast("bigint") * 5 + F.col("page") - 1
    captured = listing_pages(spark, sf_dir).withColumn("page_no", page_no)
    captured = captured.join(expensive, "page_no", "left_semi").drop("page_no")
    return frontier.missing_pages(frontier.read_listings(captured)).select("body", "page", "url")


def _fetch_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing cards for the fetched documents: one per attempt, so identities repeat."""
    return fetches(spark, sf_dir).select(
        "fetch_seq", "body", "identifier", "title", "description", "date", "partition",
        "partition_date", "document_url", F.lit("").alias("url"),
    )


@query(
    "document_plan",
    f"""WITH {DECIDED}
SELECT f.fetch_seq, f.body, f.identifier, f.identifier AS title, f.document_url, f.document_url AS source_url,
  nullif(l.http_etag, '') AS if_none_match, nullif(l.http_last_modified, '') AS if_modified_since
FROM fetches f LEFT JOIN landing l ON f.body = l.body AND f.identifier = l.identifier""",
)
def document_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = landing_table(spark, sf_dir)
    plan = frontier.document_plan(_fetch_cards(spark, sf_dir), stored)
    return plan.select(
        "fetch_seq", "body", "identifier", "title", "document_url", "source_url",
        F.try_element_at("headers", F.lit("If-None-Match")).alias("if_none_match"),
        F.try_element_at("headers", F.lit("If-Modified-Since")).alias("if_modified_since"),
    )


@query(
    "hostile_listings",
    f"""WITH {CARDS}
SELECT listing_url AS url, count(*) AS cards,
  count(*) FILTER (WHERE document_url LIKE 'https://decisions.example.test/en/cases/%') AS own_links, CAST(0 AS BIGINT) AS failures
FROM cards GROUP BY listing_url""",
)
def hostile_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages of which a third declares a charset that cannot decode, another a base that is no URL."""
    number = F.crc32("url") % 3
    head = F.when(number == 0, "<meta charset=undefined>").when(number == 1, '<base href="http://[x">').otherwise("")
    pages = listing_pages(spark, sf_dir).withColumn("payload", F.concat(F.encode(head, "UTF-8"), "payload"))
    listings = frontier.read_listings(pages)
    own = F.filter("listing.cards", lambda c: c["document_url"].startswith("https://decisions.example.test/en/cases/"))
    counts = {"cards": F.size("listing.cards").cast("bigint"), "own_links": F.size(own).cast("bigint")}
    # Written once without the cards, so that no page is read twice.
    read = materialize(listings.withColumns(counts).withColumn("listing", F.col("listing").dropFields("cards")), "hostile-listings")
    failed = frontier.unreadable_listings(read).groupBy("url").agg(F.count("*").alias("failures"))
    counted = read.select("url", "cards", "own_links")
    return counted.join(failed, "url", "left").na.fill(0, ["failures"])


@query(
    "suppress_requests",
    """
WITH links AS (
  SELECT page_id, generate_subscripts(hrefs, 1) AS pos, unnest(hrefs) AS href, url
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages)),
requests AS (
  SELECT page_id, pos, regexp_extract(url, '^https?://[^/]+') || href AS document_url FROM links)
SELECT page_id, pos, document_url,
  CASE WHEN NOT regexp_matches(document_url, '^https?://([^/]*\\.)?example\\.com/') THEN 'offsite'
       WHEN row_number() OVER (PARTITION BY document_url ORDER BY page_id, pos) > 1 THEN 'duplicate' END AS suppressed
FROM requests""",
)
def suppress_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all pages as document requests, in page and link order."""
    from doclake.functions.urls import absolute_url
    from doclake.profile import SourceProfile

    hrefs = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    links = table(spark, sf_dir, "pages").select("page_id", "url", F.posexplode(hrefs).alias("pos", "href"))
    requests = links.select(
        F.struct("page_id", (F.col("pos") + 1).cast("bigint").alias("pos")).alias("request"),
        absolute_url(F.col("url"), F.col("href")).alias("document_url"),
    )
    rows = frontier.suppress_requests(requests, "request", SourceProfile(allowed_domain="example.com"))
    return rows.select("request.*", "document_url", "suppressed")


@query(
    "rate_limited",
    f"""WITH {FETCHES}
SELECT fetch_seq, document_url AS url, CAST(status AS VARCHAR) AS error_code, nullif(retry_after, '') AS retry_after,
  fetch_seq = (SELECT max(g.fetch_seq) FROM fetches g WHERE g.document_url = f.document_url) AS is_final
FROM fetches f WHERE status IN (429, 503)""",
)
def rate_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.rate_limited(fetches(spark, sf_dir))


@query(
    "retry_worklist",
    f"""WITH {FETCHES},
visits AS (SELECT document_url || '?day=' || date AS document_url, fetch_seq, status FROM fetches)
SELECT document_url, count(*) AS attempts, nullif(arg_max(coalesce(status, -1), fetch_seq), -1) AS last_status
FROM visits GROUP BY document_url
HAVING count(*) <= 3 AND arg_max(coalesce(status, -1), fetch_seq) IN (-1, 500, 502, 503, 504, 522, 524, 408, 429)""",
)
def retry_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's visits to one document are the attempts of one request."""
    url = F.concat("document_url", F.lit("?day="), "date")
    return frontier.retry_worklist(fetches(spark, sf_dir).withColumn("document_url", url))
