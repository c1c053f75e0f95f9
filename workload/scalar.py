"""Scalar expressions: keys, types, hashes, text, dates, URLs, headers, failures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.functions import content, requests, text
from doclake.functions.urls import absolute_url
from doclake.operators.frontier import read_listings
from workload.inputs import CAPTURES, FETCHES, captures, document_captures, fetches, listing_pages, page_captures
from workload.registry import query, table

_RAW_PART = "'  ' || p_name || ' / ' || p_type || chr(9) || p_brand || ' .'"
_RAW_CUSTOMER = "c_name || chr(10) || '//' || c_mktsegment || '_'"


@query(
    "sanitize_keys",
    rf"""
WITH raw AS (
  SELECT 'part' AS origin, p_partkey AS id, {_RAW_PART} AS label FROM part
  UNION ALL SELECT 'customer', c_custkey, {_RAW_CUSTOMER} FROM customer)
SELECT origin, id, label,
  trim(regexp_replace(regexp_replace(regexp_replace(label, '^\s+|\s+$', '', 'g'), '[/\x00-\x1f]+', '-', 'g'), '\s+', '_', 'g'), '-_.') AS key
FROM raw""",
)
def sanitize_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(
        F.lit("part").alias("origin"),
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("  "), "p_name", F.lit(" / "), "p_type", F.lit("\t"), "p_brand", F.lit(" .")).alias("label"),
    )
    customers = table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("origin"),
        F.col("c_custkey").alias("id"),
        F.concat("c_name", F.lit("\n//"), "c_mktsegment", F.lit("_")).alias("label"),
    )
    raw = parts.unionByName(customers)
    return raw.withColumn("key", text.sanitize_identifier(F.col("label")))


_TYPED_DOCUMENTS = f"WITH {CAPTURES} SELECT fetch_seq, document_type FROM captures"


@query("detect_types", _TYPED_DOCUMENTS)
def detect_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = content.detect_document_type(F.col("content_type"), F.col("payload"))
    return captures(spark, sf_dir).select("fetch_seq", found.alias("document_type"))


@query(
    "effective_types",
    f"""WITH {CAPTURES}
SELECT fetch_seq, CASE WHEN description = 'es' THEN document_type ELSE coalesce(magic, 'html') END AS document_type
FROM captures""",
)
def effective_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored type where it is a known one, else the signature alone."""
    rows = captures(spark, sf_dir)
    stored = F.when(
        F.col("description") == "es",
        content.detect_document_type(F.col("content_type"), F.col("payload")),
    ).otherwise("unknown")
    kind = content.effective_document_type(stored, F.col("payload"))
    return rows.select("fetch_seq", kind.alias("document_type"))


@query("landing_keys", f"WITH {CAPTURES} SELECT fetch_seq, file_path FROM landed")
def landing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = content.detect_document_type(F.col("content_type"), F.col("payload"))
    key = text.landing_key(F.col("body"), F.col("identifier"), kind)
    return captures(spark, sf_dir).select("fetch_seq", key.alias("file_path"))


@query(
    "transformed_keys",
    f"WITH {CAPTURES} SELECT fetch_seq, replace(identifier, '/', '-') || '.' || document_type AS file_path FROM landed",
)
def transformed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = content.detect_document_type(F.col("content_type"), F.col("payload"))
    key = text.transformed_key(F.col("identifier"), kind)
    return captures(spark, sf_dir).select("fetch_seq", key.alias("file_path"))


@query(
    "content_types",
    f"""WITH {CAPTURES}
SELECT fetch_seq, CASE document_type WHEN 'pdf' THEN 'application/pdf' WHEN 'doc' THEN 'application/msword'
  WHEN 'docx' THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document'
  ELSE 'text/html; charset=utf-8' END AS content_type, '.' || document_type AS extension
FROM captures""",
)
def content_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = content.detect_document_type(F.col("content_type"), F.col("payload"))
    rows = captures(spark, sf_dir).select("fetch_seq", kind.alias("kind"))
    return rows.select(
        "fetch_seq",
        content.content_type_of(F.col("kind")).alias("content_type"),
        text.extension_for(F.col("kind")).alias("extension"),
    )


@query("hash_documents", "SELECT doc_id, sha256(text) AS file_hash FROM documents")
def hash_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = content.file_hash(F.encode("text", "UTF-8"))
    return table(spark, sf_dir, "documents").select("doc_id", digest.alias("file_hash"))


@query(
    "normalize_pages",
    r"""
SELECT page_id * 2 AS fetch_seq, sha256(regexp_replace(regexp_replace(
    html || '<!-- cached or not being index.aspx page --><!-- Elapsed time: 0.' || page_id || ' -->',
    '<!--\s*Elapsed time:[^>]*-->', '<!-- Elapsed time -->', 'g'),
    '<!--\s*cached or not being index\.aspx page\s*-->', '', 'g')) AS file_hash
FROM pages""",
)
def normalize_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    normal = content.normalize_payload(F.col("payload"), F.lit("html"))
    rows = page_captures(spark, sf_dir)
    return rows.select("fetch_seq", content.file_hash(normal).alias("file_hash"))


_PYTHON_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query(
    "clean_text",
    f"SELECT doc_id, trim(regexp_replace(text, '{_PYTHON_SPACE}', ' ', 'g')) AS cleaned FROM documents",
)
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = text.clean_text(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", cleaned.alias("cleaned"))


@query(
    "iso_dates",
    """
WITH shown AS (
  SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y')
    WHEN 1 THEN day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate)
    WHEN 2 THEN strftime(o_orderdate, '%d/%m/%y') WHEN 3 THEN '31/02/' || year(o_orderdate)
    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS shown, o_orderdate FROM orders)
SELECT o_orderkey, shown, CASE WHEN o_orderkey % 5 < 2 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE shown END AS date
FROM shown""",
)
def iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, form = F.col("o_orderdate"), F.col("o_orderkey") % 5
    shown = (
        F.when(form == 0, F.date_format(day, "dd/MM/yyyy"))
        .when(form == 1, F.date_format(day, "d/M/yyyy"))
        .when(form == 2, F.date_format(day, "dd/MM/yy"))
        .when(form == 3, F.concat(F.lit("31/02/"), F.year(day)))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", shown.alias("shown"))
    return rows.withColumn("date", text.iso_date(F.col("shown")))


@query(
    "total_results",
    """
SELECT DISTINCT 'https://decisions.example.test/en/search/?body=' || (o_orderkey // 50) || '&pageNumber=' || ((o_orderkey // 10) % 5 + 1) AS url,
  CASE WHEN (o_orderkey // 10) % 2 = 0 THEN 1000 + (o_orderkey // 10) % 1000 ELSE o_orderkey // 10 END AS total_results
FROM orders""",
)
def total_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_listings(listing_pages(spark, sf_dir)).select("url", "total_results")


@query(
    "resolve_urls",
    """
WITH links AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)
SELECT page_id, href, regexp_extract(url, '^https?://[^/]+') || href AS absolute_url FROM links""",
)
def resolve_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1)))
    rows = table(spark, sf_dir, "pages").select("page_id", "url", links.alias("href"))
    absolute = absolute_url(F.col("url"), F.col("href"))
    return rows.select("page_id", "href", absolute.alias("absolute_url"))


@query(
    "conditional_headers",
    f"""WITH {FETCHES}
SELECT fetch_seq, nullif(http_etag, '') AS if_none_match, nullif(http_last_modified, '') AS if_modified_since,
  CAST((coalesce(http_etag, '') <> '')::INT + (coalesce(http_last_modified, '') <> '')::INT AS BIGINT) AS headers
FROM fetches""",
)
def conditional_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = requests.conditional_headers(F.col("http_etag"), F.col("http_last_modified"))
    rows = fetches(spark, sf_dir).withColumn("map", headers)
    return rows.select(
        "fetch_seq",
        F.try_element_at("map", F.lit("If-None-Match")).alias("if_none_match"),
        F.try_element_at("map", F.lit("If-Modified-Since")).alias("if_modified_since"),
        F.size("map").cast("bigint").alias("headers"),
    )


@query(
    "classify_failures",
    f"""WITH {FETCHES}
SELECT fetch_seq, triage_code AS error_code, triage_reason AS reason FROM triaged WHERE triage_outcome = 'failed'""",
)
def classify_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("status")
    bad = fetches(spark, sf_dir).where("status is null or status >= 400")
    return bad.select(
        "fetch_seq",
        requests.failure_code(status, F.col("error_code")).alias("error_code"),
        requests.failure_reason(status, F.col("reason")).alias("reason"),
    )


@query(
    "passthrough",
    f"WITH {CAPTURES} SELECT fetch_seq, file_hash FROM landed WHERE document_type <> 'html'",
)
def passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binaries come out of the transform byte for byte."""
    from workload.zones import landed, transformed

    landing, objects = landed(document_captures(spark, sf_dir))
    return transformed(landing, objects).where("unchanged_content").select(
        ((F.regexp_extract("document_url", r"(\d+)$", 1).cast("bigint") * 2) + 1).alias("fetch_seq"),
        "file_hash",
    )
