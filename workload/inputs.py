"""Captures, fetch attempts and listing pages derived from the benchmark tables.

Every derivation exists twice: as a DataFrame and as the SQL common table expressions the oracles
start from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.functions.windows import with_window
from workload.registry import table

# --- fetch attempts, from events -------------------------------------------------------------
# Five bodies, each with a fifth of all attempts, and users as documents that are fetched again
# and again: a heavy identity history.

FETCH_RANGE = ("2024-01-01", "2024-02-05")
AS_OF = "2024-06-01T00:00:00+00:00"
MIDDLE = "2024-01-16"  # attempts before it are the first batch, the others the second


def fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetches_of(table(spark, sf_dir, "events"))


def fetches_of(events: DataFrame) -> DataFrame:
    """Attempts of a batch or a stream of events."""
    n, ts = F.col("event_id"), F.col("ts")
    band = F.floor(F.col("value") / 25).cast("string")
    code = n % 20
    status = (
        F.when(code == 0, 304).when(code == 1, 404).when(code == 2, 503).when(code == 3, 429)
        .when(code == 4, F.lit(None)).otherwise(200)
    )
    transport = F.when(
        code == 4,
        F.when(n % 3 == 0, "DNSLookupError").when(n % 3 == 1, "TimeoutError")
        .otherwise("ConnectionRefusedError"),
    )
    url = F.concat(F.lit("https://"), "event_type", F.lit(".example.test/u/"), "user_id")
    content_type = (
        F.when(F.col("user_id") % 5 == 0, "application/pdf; charset=binary")
        .when(F.col("user_id") % 5 == 1, " Application/MSWORD ")
        .when(F.col("user_id") % 5 == 2, F.lit(None))
        .otherwise("text/html")
    )
    page = F.concat(
        F.lit("<html>"), band, F.lit("</html><!-- Elapsed time: "), n.cast("string"), F.lit(" -->")
    )
    rows = events.select(
        n.alias("fetch_seq"),
        F.col("event_type").alias("body"),
        F.when(n % 50 == 11, "///").otherwise(F.concat(F.lit("U "), "user_id")).alias("identifier"),
        F.lit("").alias("title"),
        F.when(n % 50 != 7, F.col("props")).alias("description"),
        F.date_format(ts, "yyyy-MM-dd").alias("date"),
        url.alias("document_url"),
        url.alias("source_url"),
        status.alias("status"),
        content_type.alias("content_type"),
        F.when(n % 3 == 0, F.concat(F.lit('W/"'), band, F.lit('"'))).when(n % 3 == 1, "").alias("http_etag"),
        F.when(n % 4 == 0, F.date_format(ts, "yyyy-MM-dd")).alias("http_last_modified"),
        F.when(code.isin(2, 3), F.when(n % 4 == 2, "30").otherwise("")).alias("retry_after"),
        F.encode(page, "UTF-8").alias("payload"),
        transport.alias("error_code"),
        F.concat(F.lit("transport "), transport).alias("reason"),
        ts,
    )
    return with_window(rows, F.to_date("ts"), *FETCH_RANGE, "weekly")


def fetch_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = fetches(spark, sf_dir)
    first = F.col("ts") < F.lit(MIDDLE).cast("timestamp")
    return rows.where(first).drop("ts"), rows.where(~first).drop("ts")


FETCHES = """
weeks AS (
  SELECT *, DATE '2024-01-01' + 7 * CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS INTEGER) AS w
  FROM events),
fetches AS (
  SELECT event_id AS fetch_seq, event_type AS body,
    CASE WHEN event_id % 50 = 11 THEN '///' ELSE 'U ' || user_id END AS identifier,
    '' AS title,
    CASE WHEN event_id % 50 <> 7 THEN props END AS description,
    strftime(ts, '%Y-%m-%d') AS date,
    'https://' || event_type || '.example.test/u/' || user_id AS document_url,
    'https://' || event_type || '.example.test/u/' || user_id AS source_url,
    CASE event_id % 20 WHEN 0 THEN 304 WHEN 1 THEN 404 WHEN 2 THEN 503 WHEN 3 THEN 429 WHEN 4 THEN NULL ELSE 200 END AS status,
    CASE user_id % 5 WHEN 0 THEN 'application/pdf; charset=binary' WHEN 1 THEN ' Application/MSWORD ' WHEN 2 THEN NULL ELSE 'text/html' END AS content_type,
    CASE event_id % 3 WHEN 0 THEN 'W/"' || CAST(floor(value / 25) AS BIGINT) || '"' WHEN 1 THEN '' END AS http_etag,
    CASE WHEN event_id % 4 = 0 THEN strftime(ts, '%Y-%m-%d') END AS http_last_modified,
    CASE WHEN event_id % 20 IN (2, 3) THEN CASE WHEN event_id % 4 = 2 THEN '30' ELSE '' END END AS retry_after,
    '<html>' || CAST(floor(value / 25) AS BIGINT) || '</html><!-- Elapsed time: ' || event_id || ' -->' AS payload,
    CASE WHEN event_id % 20 = 4 THEN CASE event_id % 3 WHEN 0 THEN 'DNSLookupError' WHEN 1 THEN 'TimeoutError' ELSE 'ConnectionRefusedError' END END AS error_class,
    strftime(w, '%Y-%m-%d') AS partition_date,
    strftime(w, '%Y-%m-%d') || '/' || strftime(least(w + 7, DATE '2024-02-05'), '%Y-%m-%d') AS partition,
    ts
  FROM weeks WHERE w >= DATE '2024-01-01' AND w < DATE '2024-02-05'),
triaged AS (
  SELECT *,
    CASE WHEN status = 304 THEN 'unchanged' WHEN status BETWEEN 200 AND 299 THEN 'fetched' ELSE 'failed' END AS triage_outcome,
    CASE WHEN status = 304 OR status BETWEEN 200 AND 299 THEN NULL
         WHEN status IS NOT NULL THEN CAST(status AS VARCHAR)
         WHEN error_class = 'DNSLookupError' THEN 'dns_lookup_error'
         WHEN error_class = 'TimeoutError' THEN 'timeout' ELSE error_class END AS triage_code,
    CASE WHEN status = 304 OR status BETWEEN 200 AND 299 THEN NULL
         WHEN status IS NOT NULL THEN 'http error ' || status
         ELSE 'transport ' || error_class END AS triage_reason
  FROM fetches),
checked AS (
  SELECT *,
    CASE WHEN triage_outcome <> 'fetched' THEN triage_outcome
         WHEN description IS NULL OR identifier = '///' THEN 'failed' ELSE 'stored' END AS outcome,
    CASE WHEN triage_outcome <> 'fetched' THEN triage_code
         WHEN description IS NULL THEN 'ValidationError' WHEN identifier = '///' THEN 'ValueError' END AS error_code,
    CASE WHEN triage_outcome <> 'fetched' THEN triage_reason
         WHEN description IS NULL THEN 'landing write failed: missing description'
         WHEN identifier = '///' THEN 'landing write failed: identifier is empty after sanitization: ''///''' END AS reason
  FROM triaged),
typed AS (
  SELECT *,
    CASE lower(trim(split_part(coalesce(content_type, ''), ';', 1)))
      WHEN 'application/pdf' THEN 'pdf' WHEN 'application/msword' THEN 'doc' ELSE 'html' END AS document_type
  FROM checked WHERE outcome = 'stored'),
hashed AS (
  SELECT *,
    sha256(CASE WHEN document_type = 'html' THEN regexp_replace(payload, '<!--\\s*Elapsed time:[^>]*-->', '<!-- Elapsed time -->', 'g') ELSE payload END) AS file_hash,
    body || '/' || replace(identifier, ' ', '_') || '.' || document_type AS file_path
  FROM typed)
"""

# Write decisions over the whole history of an identity, as if both batches were one.
DECIDED = (
    FETCHES
    + """,
ordered AS (
  SELECT *,
    lag(file_hash) OVER identity AS previous_hash, lag(file_path) OVER identity AS previous_path,
    row_number() OVER identity AS write_number
  FROM hashed WINDOW identity AS (PARTITION BY body, identifier ORDER BY fetch_seq)),
decided AS (
  SELECT *,
    write_number = 1 AS inserted,
    file_hash IS DISTINCT FROM previous_hash OR file_path IS DISTINCT FROM previous_path AS object_written
  FROM ordered),
landing AS (
  SELECT * FROM decided
  QUALIFY row_number() OVER (PARTITION BY body, identifier ORDER BY fetch_seq DESC) = 1),
outcomes AS (
  SELECT c.fetch_seq, c.body, c.partition, c.identifier, c.document_url, c.outcome, c.error_code, c.reason,
    d.object_written, d.inserted, d.file_path, d.file_hash, d.document_type
  FROM checked c LEFT JOIN decided d ON c.fetch_seq = d.fetch_seq)
"""
)

# --- document captures, from pages and documents ----------------------------------------------

CAPTURE_RANGE = ("2024-01-01", "2024-04-01")


def _capture(rows: DataFrame, number: Column, **columns: Column) -> DataFrame:
    day = F.date_add(F.lit("2024-01-01").cast("date"), (number % 90).cast("int"))
    null = F.lit(None).cast("string")
    filled = {
        "date": day.cast("string"),
        "source_url": columns["document_url"],
        "status": F.lit(200),
        "http_etag": null,
        "http_last_modified": null,
        "retry_after": null,
        "error_code": null,
        "reason": null,
        **columns,
    }
    named = rows.select(*[c.alias(name) for name, c in filled.items()], day.alias("_day"))
    return with_window(named, F.col("_day"), *CAPTURE_RANGE, "monthly").drop("_day")


def page_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as an html capture, with the comments a server adds on each render."""
    n = F.col("page_id")
    stamped = F.concat(
        "html",
        F.lit("<!-- cached or not being index.aspx page --><!-- Elapsed time: 0."),
        n.cast("string"),
        F.lit(" -->"),
    )
    return _capture(
        table(spark, sf_dir, "pages"),
        n,
        fetch_seq=n * 2,
        body=F.concat(F.lit("Panel "), n % 4),
        identifier=F.concat(F.lit("PG-"), n),
        title=F.col("url"),
        description=F.split_part("url", F.lit(":"), F.lit(1)),
        document_url=F.col("url"),
        content_type=F.lit("text/html; charset=utf-8"),
        payload=F.encode(stamped, "UTF-8"),
    )


def document_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a pdf, docx or doc by its signature, or by its header, or as plain html."""
    n, text = F.col("doc_id"), F.encode("text", "UTF-8")
    payload = (
        F.when(n % 4 == 0, F.concat(F.lit(b"%PDF-1.7\n"), text))
        .when(n % 4 == 1, F.concat(F.lit(b"PK\x03\x04"), text))
        .when(n % 4 == 2, F.concat(F.lit(b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"), text))
        .otherwise(text)
    )
    return _capture(
        table(spark, sf_dir, "documents"),
        n,
        fetch_seq=n * 2 + 1,
        body=F.col("source"),
        identifier=F.concat(F.lit("D/"), F.floor(n / 8)),
        title=F.col("source"),
        description=F.col("lang"),
        document_url=F.concat(F.lit("https://files.example.test/"), n),
        content_type=F.when(n % 8 == 7, "application/pdf; charset=binary").otherwise("text/plain"),
        payload=payload,
    )


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_captures(spark, sf_dir).unionByName(document_captures(spark, sf_dir))


CAPTURES = """
captures AS (
  SELECT page_id * 2 AS fetch_seq, 'Panel ' || (page_id % 4) AS body, 'PG-' || page_id AS identifier,
    url AS title, split_part(url, ':', 1) AS description, url AS document_url,
    DATE '2024-01-01' + CAST(page_id % 90 AS INTEGER) AS day,
    'html' AS document_type, NULL AS magic,
    encode(html || '<!-- Elapsed time -->') AS normal, html
  FROM pages
  UNION ALL
  SELECT doc_id * 2 + 1, source, 'D/' || (doc_id // 8), source, lang,
    'https://files.example.test/' || doc_id,
    DATE '2024-01-01' + CAST(doc_id % 90 AS INTEGER),
    CASE WHEN doc_id % 4 = 0 OR doc_id % 8 = 7 THEN 'pdf' WHEN doc_id % 4 = 1 THEN 'docx' WHEN doc_id % 4 = 2 THEN 'doc' ELSE 'html' END,
    CASE doc_id % 4 WHEN 0 THEN 'pdf' WHEN 1 THEN 'docx' WHEN 2 THEN 'doc' END,
    CASE doc_id % 4 WHEN 0 THEN encode('%PDF-1.7' || chr(10)) WHEN 1 THEN '\\x50\\x4B\\x03\\x04'::BLOB
      WHEN 2 THEN '\\xD0\\xCF\\x11\\xE0\\xA1\\xB1\\x1A\\xE1'::BLOB ELSE ''::BLOB END || encode(text),
    NULL
  FROM documents),
landed AS (
  SELECT *, strftime(day, '%Y-%m-%d') AS date, strftime(date_trunc('month', day), '%Y-%m-%d') AS partition_date,
    replace(body, ' ', '_') || '/' || replace(identifier, '/', '-') || '.' || document_type AS file_path,
    sha256(normal) AS file_hash
  FROM captures)
"""

# --- listing pages, from orders ---------------------------------------------------------------

LISTING_URL = "https://decisions.example.test/en/search/?body="


def order_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as listing cards: ten consecutive order keys share a page."""
    key = F.col("o_orderkey")
    page_no = F.floor(key / 10)
    return table(spark, sf_dir, "orders").select(
        key.alias("o_orderkey"),
        page_no.alias("page_no"),
        F.when(key % 40 == 3, "").otherwise(F.concat(F.lit("ORD-"), key)).alias("reference"),
        F.when(key % 20 == 3, "").otherwise(F.col("o_orderpriority")).alias("link_text"),
        F.concat(F.lit("Customer "), "o_custkey").alias("first_text"),
        F.concat(F.lit("State\n "), "o_orderstatus", F.lit(" &amp; paid ")).alias("second_text"),
        F.when(key % 17 == 0, "undated").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("shown_date"),
        F.when(key % 31 == 0, "")
        .when(key % 3 == 0, F.concat(F.lit("../cases/ord-"), key, F.lit(".html")))
        .when(key % 3 == 1, F.concat(F.lit("/en/cases/ord-"), key, F.lit(".html")))
        .otherwise(F.concat(F.lit("https://archive.other.test/"), key))
        .alias("href"),
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages as captured: url, body, partition, page and payload."""
    card = F.concat(
        F.lit('<li class="each-item row"><span class="refNO">'), "reference",
        F.lit('</span><h2 class="title"><a href="'), "href", F.lit('">'), "link_text",
        F.lit('</a></h2><p class="description">'), "first_text",
        F.lit('</p><p class="description">'), "second_text",
        F.lit('</p><span class="date"> '), "shown_date", F.lit(" </span>"),
    )
    cards = order_cards(spark, sf_dir)
    pages = cards.groupBy("page_no").agg(
        # At most ten cards a page: order keys are unique.
        F.array_sort(F.collect_list(F.struct("o_orderkey", card.alias("card")))).alias("cards"),
        F.count("*").alias("n"),
    )
    number = F.col("page_no") % 5 + 1
    head = F.when(
        F.col("page_no") % 2 == 0,
        F.concat(F.lit('<div class="searchhead">Shows 1 to 10 of <b>many</b> of 1,'), F.lpad((F.col("page_no") % 1000).cast("string"), 3, "0"), F.lit(" Results</div>")),
    ).otherwise(F.concat(F.lit("<div>1 of "), F.col("page_no"), F.lit(" results</div>")))
    pager = F.when(
        number < 5,
        F.concat(F.lit('<ul class="pager"><li><a class="next" href="?body='), F.floor(F.col("page_no") / 5), F.lit("&amp;pageNumber="), number + 1, F.lit('">next</a></li></ul>')),
    ).otherwise(F.lit('<ul class="pager"></ul>'))
    html = F.concat(
        F.lit("<html><body>"), head, F.lit('<ul class="item-list">'),
        F.array_join(F.transform("cards", lambda c: c["card"]), "\n"),
        F.lit("</ul>"), pager,
    )
    return pages.select(
        F.concat(F.lit(LISTING_URL), F.floor(F.col("page_no") / 5), F.lit("&pageNumber="), number).alias("url"),
        F.concat(F.lit("Panel "), F.floor(F.col("page_no") / 5) % 7).alias("body"),
        F.lit("2024-01-01/2024-02-01").alias("partition"),
        F.lit("2024-01-01").alias("partition_date"),
        number.cast("int").alias("page"),
        F.encode(html, "UTF-8").alias("payload"),
    )


CARDS = """
cards AS (
  SELECT o_orderkey, o_orderkey // 10 AS page_no, o_orderkey % 10 AS position,
    'https://decisions.example.test/en/search/?body=' || (o_orderkey // 50) || '&pageNumber=' || ((o_orderkey // 10) % 5 + 1) AS listing_url,
    'Panel ' || ((o_orderkey // 50) % 7) AS body,
    CAST((o_orderkey // 10) % 5 + 1 AS INTEGER) AS page,
    CASE WHEN o_orderkey % 20 = 3 THEN '' ELSE o_orderpriority END AS title,
    CASE WHEN o_orderkey % 40 = 3 THEN '' ELSE 'ORD-' || o_orderkey END AS identifier,
    'Customer ' || o_custkey || ' State ' || o_orderstatus || ' & paid' AS description,
    CASE WHEN o_orderkey % 17 = 0 THEN 'undated' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date,
    CASE WHEN o_orderkey % 31 = 0 THEN '' WHEN o_orderkey % 3 = 0 THEN '../cases/ord-' || o_orderkey || '.html'
      WHEN o_orderkey % 3 = 1 THEN '/en/cases/ord-' || o_orderkey || '.html'
      ELSE 'https://archive.other.test/' || o_orderkey END AS url,
    CASE WHEN o_orderkey % 31 = 0 THEN ''
      WHEN o_orderkey % 3 < 2 THEN 'https://decisions.example.test/en/cases/ord-' || o_orderkey || '.html'
      ELSE 'https://archive.other.test/' || o_orderkey END AS document_url
  FROM orders)
"""
