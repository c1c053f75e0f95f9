"""The transformed zone, the object tables and the audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.functions.pages import clean_page
from doclake.operators.events import transform_log as transform_lines
from doclake.operators.stats import scope_stats
from doclake.plans import audit
from doclake.plans import transform as plans
from doclake.plans.ingest import classify, run_ingest
from doclake.plans.window import run_logged, run_window
from doclake.schema import CAPTURE_SCHEMA, LANDING_SCHEMA, TRANSFORMED_SCHEMA
from doclake.session import bound_batches
from doclake.sources import objects as object_table
from doclake.sources.landing import scan_range
from doclake.sources.store import Store
from doclake.sources.workspace import materialize, workspace
from workload.inputs import AS_OF, CAPTURE_RANGE, CAPTURES, _capture, captures
from workload.registry import query, table
from workload.stats import _fields, _sql_line, _summary_lines, _text

RANGE = ("2024-01-01", "2024-03-01")


def landed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Landing metadata and object versions of captures that are all new, as written tables."""
    classified = materialize(classify(rows).withColumn("scraped_at", F.lit(AS_OF)), "landed")
    landing = classified.select(*LANDING_SCHEMA.names)
    objects = classified.select(
        "file_path",
        F.col("payload").alias("content"),
        F.struct("fetch_seq").alias(object_table.ORDER),
        "description",
    )
    return landing, objects


def transformed(landing: DataFrame, objects: DataFrame) -> DataFrame:
    return plans.transform(landing, objects, AS_OF)


def _zones(spark: SparkSession, sf_dir: str, *dates: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    landing, objects = landed(captures(spark, sf_dir))
    if dates:
        landing = scan_range(landing, *dates)
    return landing, objects, transformed(landing, objects)


# --- pages ------------------------------------------------------------------------------------

# HTML decodes these references in text with or without their semicolon; a cut-off title has some.
_ENTITIES = (
    "regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '&quot;?', '\"', 'g'), "
    "'&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g')"
)
_TITLE = _ENTITIES.format("trim(regexp_extract(html, '<title>([^<]*)</title>', 1))")
_BARE = _ENTITIES.format(
    "regexp_replace(regexp_extract(html, '<article>(.*)</article>', 1, 's'), '<[^>]*>', '', 'g')"
)
_ESCAPED = f"replace(replace(replace({_BARE}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    page = clean_page(F.encode("html", "UTF-8")).alias("page")
    return table(spark, sf_dir, "pages").select("page_id", page).select("page_id", "page.*")


@query("container_choice", "SELECT page_id, 'article' AS container FROM pages WHERE html LIKE '%<article>%'")
def container_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).select("page_id", "container")


@query("page_titles", f"SELECT page_id, {_TITLE} AS title FROM pages")
def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).select("page_id", "title")


@query(
    "clean_pages",
    f"""
SELECT page_id, 'article' AS container, {_TITLE} AS title,
  sha256({_ESCAPED}) AS text_hash
FROM pages""",
)
def clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned pages; the hash is that of the body's markup with all tags taken out."""
    html = F.decode("clean", "UTF-8")
    body = F.regexp_extract(html, r"(?s)<body>\n(.*)\n</body>", 1)
    bare = F.regexp_replace(body, "<[^>]*>", "")
    return _cleaned(spark, sf_dir).select(
        "page_id", "container", "title", F.sha2(F.encode(bare, "UTF-8"), 256).alias("text_hash")
    )


# --- transform --------------------------------------------------------------------------------

_DONE = f"""{CAPTURES},
done AS (
  SELECT *, CASE WHEN document_type = 'html' AND html IS NULL THEN 'ContentNotFound' END AS error_code,
    replace(identifier, '/', '-') || '.' || document_type AS key
  FROM landed)
"""
_IN_RANGE = "partition_date >= '2024-01-01' AND partition_date < '2024-03-01'"


@query(
    "transform_range",
    f"""WITH {_DONE}
SELECT body, identifier, partition_date, document_type, error_code,
  CASE WHEN error_code IS NULL THEN key ELSE key END AS file_path, file_path AS source_file_path,
  document_type <> 'html' AS unchanged_content, CASE WHEN document_type <> 'html' THEN file_hash END AS binary_hash
FROM done WHERE {_IN_RANGE}""",
)
def transform_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, rows = _zones(spark, sf_dir, *RANGE)
    return rows.select(
        "body", "identifier", "partition_date", "document_type", "error_code", "file_path",
        "source_file_path", "unchanged_content",
        F.when(F.col("unchanged_content"), F.col("file_hash")).alias("binary_hash"),
    )


@query(
    "transformed_metadata",
    f"""WITH {_DONE}
SELECT identifier, title, description, date, document_url, partition_date, body, key AS file_path, document_url AS source_url,
  document_type, '{AS_OF}' AS scraped_at, file_path AS source_file_path, '{AS_OF}' AS transformed_at
FROM done WHERE error_code IS NULL""",
)
def transformed_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, _, rows = _zones(spark, sf_dir)
    empty = spark.createDataFrame([], TRANSFORMED_SCHEMA)
    after = plans.transformed_after(empty, rows)
    return after.drop("action", "file_hash", "http_etag", "http_last_modified")


@query(
    "transform_failures",
    f"""WITH {_DONE}
SELECT body, identifier, partition_date,
  CASE WHEN description = 'http' THEN 'NoSuchKey' WHEN description = 'fr' THEN 'ValueError' ELSE error_code END AS error_code
FROM done WHERE description IN ('http', 'fr') OR error_code IS NOT NULL""",
)
def transform_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lost objects, records without a path and pages without content, all as rows."""
    landing, objects = landed(captures(spark, sf_dir))
    pathless = F.when(F.col("description") != "fr", F.col("file_path"))
    rows = transformed(
        landing.withColumn("file_path", pathless), objects.where("description <> 'http'")
    )
    return rows.where("error_code is not null").select("body", "identifier", "partition_date", "error_code")


@query(
    "transform_stats",
    f"""WITH {_DONE}
SELECT body, partition_date AS partition, count(*) AS records_found, count(*) FILTER (WHERE error_code IS NULL) AS records_scraped,
  count(*) FILTER (WHERE error_code IS NOT NULL) AS failed, CAST(0 AS BIGINT) AS skipped
FROM done GROUP BY body, partition_date""",
)
def transform_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, rows = _zones(spark, sf_dir)
    return scope_stats(plans.transform_events(rows))


@query(
    "transform_log",
    f"""WITH {_DONE},
scopes AS (
  SELECT body, partition_date AS partition, count(*) AS records_found, count(*) FILTER (WHERE error_code IS NULL) AS records_scraped,
    count(*) FILTER (WHERE error_code IS NOT NULL) AS failed FROM done GROUP BY body, partition_date)
SELECT {_sql_line("INFO", "transformation", "document_transformed", _fields(_text("identifier"), _text("body"), _text("partition", "partition_date"), _text("document_type"), _text("file_path", "key"), _text("file_hash", "CASE WHEN document_type = 'html' THEN '-' ELSE file_hash END"), _text("unchanged_content", "CAST(document_type <> 'html' AS VARCHAR)")))} AS value
FROM done WHERE error_code IS NULL
UNION ALL SELECT {_sql_line("ERROR", "transformation", "record_failed", _fields(_text("url", "document_url"), _text("error_code"), _text("reason", "'-'"), _text("body"), _text("partition", "partition_date"), _text("identifier")))} FROM done WHERE error_code IS NOT NULL
{_summary_lines("transformation")}""",
)
def transform_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of a transform run; cleaned pages' hashes and reasons are masked for comparison."""
    _, _, rows = _zones(spark, sf_dir)
    masked = rows.drop("content").withColumns(
        {
            "file_hash": F.when(F.col("document_type") == "html", "-").otherwise(F.col("file_hash")),
            "reason": F.when(F.col("reason").isNotNull(), "-"),
            "unchanged_content": F.col("unchanged_content").cast("string"),
        }
    )
    return transform_lines(materialize(masked, "outcomes"), F.lit("2024-06-01"))


@query(
    "upsert_transformed",
    f"""WITH {_DONE}
SELECT body, identifier, key AS file_path, partition_date,
  CASE WHEN partition_date < '2024-03-01' THEN 'first' ELSE 'second' END AS transformed_at,
  CASE WHEN partition_date < '2024-03-01' THEN 'kept' ELSE 'inserted' END AS action
FROM done WHERE error_code IS NULL AND partition_date < '2024-02-01' OR error_code IS NULL AND partition_date >= '2024-03-01'
UNION ALL
SELECT body, identifier, key, partition_date, 'second', 'updated'
FROM done WHERE error_code IS NULL AND partition_date = '2024-02-01'""",
)
def upsert_transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """January and February transformed, then February and March."""
    landing, objects = landed(captures(spark, sf_dir))
    first = plans.transform(scan_range(landing, "2024-01-01", "2024-03-01"), objects, "first")
    second = plans.transform(scan_range(landing, "2024-02-01", "2024-04-01"), objects, "second")
    empty = spark.createDataFrame([], TRANSFORMED_SCHEMA)
    stored = plans.transformed_after(empty, first).drop("action")
    after = plans.transformed_after(stored, second)
    return after.select("body", "identifier", "file_path", "partition_date", "transformed_at", "action")


_WINNERS = f"""{_DONE},
good AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY partition_date DESC, identifier DESC, body DESC) AS place,
    count(*) OVER (PARTITION BY key) AS bodies FROM done WHERE error_code IS NULL)
"""


@query(
    "key_collisions",
    f"""WITH {_WINNERS}
SELECT key AS file_path, bodies, body AS winner_body, identifier AS winner_identifier, file_hash AS winner_hash
FROM good WHERE place = 1 AND bodies > 1""",
)
def key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, rows = _zones(spark, sf_dir)
    return plans.key_collisions(rows.where("error_code is null"))


@query(
    "transformed_objects",
    f"""WITH {_WINNERS}
SELECT key AS file_path, body, document_type, CASE WHEN document_type <> 'html' THEN file_hash END AS binary_hash
FROM good WHERE place = 1""",
)
def transformed_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lies under each transformed key after the last write."""
    _, _, rows = _zones(spark, sf_dir)
    order = F.struct("partition_date", "identifier", "body").alias(object_table.ORDER)
    versions = rows.where("error_code is null").withColumn(object_table.ORDER, order)
    current = object_table.current_objects(versions)
    digest = F.when(F.col("document_type") != "html", F.sha2("content", 256))
    return current.select("file_path", "body", "document_type", digest.alias("binary_hash"))


# --- objects ----------------------------------------------------------------------------------


@query(
    "read_objects",
    """
SELECT source || '/' || doc_id || '.txt' AS file_path, sha256(text) AS file_hash, octet_length(encode(text)) AS bytes FROM documents""",
)
def read_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents exported as one file per key and read back."""
    root = workspace(spark, "export")
    key = F.concat("source", F.lit("/"), "doc_id", F.lit(".txt"))
    rows = table(spark, sf_dir, "documents")
    content = F.encode("text", "UTF-8").alias("content")
    object_table.export_objects(rows.select(key.alias("file_path"), content), root)
    return object_table.read_exported(spark, root).select(
        "file_path", F.sha2("content", 256).alias("file_hash"), F.octet_length("content").cast("bigint").alias("bytes")
    )


@query(
    "object_presence",
    f"""WITH {CAPTURES}
SELECT file_path, description <> 'http' AS present FROM landed""",
)
def object_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with and without an object."""
    landing, objects = landed(captures(spark, sf_dir))
    kept, keys = objects.where("description <> 'http'"), landing.select("file_path")
    there = object_table.existing(keys, kept).withColumn("present", F.lit(True))
    return there.unionByName(object_table.missing(keys, kept).withColumn("present", F.lit(False)))


@query("landing_snapshot", f"WITH {CAPTURES} SELECT file_path, file_hash FROM landed")
def landing_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot is written and read back, as an audit before a transform would."""
    _, objects = landed(captures(spark, sf_dir))
    path = workspace(spark, "snapshot")
    object_table.snapshot(objects).write.parquet(path)
    return spark.read.parquet(path)


# --- audits -----------------------------------------------------------------------------------
# Damage: French records occur twice, German ones lack their description, Spanish ones lie under
# a key without a slash, https pages carry a stale hash, http pages have lost their object.

_DAMAGED = f"""{CAPTURES},
damaged AS (
  SELECT body, identifier, CASE WHEN description = 'es' THEN replace(file_path, '/', '|') ELSE file_path END AS file_path,
    description = 'http' AS missing_object, description = 'https' AS hash_mismatch,
    description = 'es' AS bad_key, description = 'de' AS metadata_gap
  FROM landed UNION ALL
  SELECT body, identifier, file_path, false, false, false, false FROM landed WHERE description = 'fr')
"""


def _damaged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    landing, objects = landed(captures(spark, sf_dir))
    kind = F.col("description")
    key = F.when(kind == "es", F.replace("file_path", F.lit("/"), F.lit("|"))).otherwise(F.col("file_path"))
    records = landing.unionByName(landing.where(kind == "fr")).withColumns(
        {
            "file_path": key,
            "file_hash": F.when(kind == "https", "stale").otherwise(F.col("file_hash")),
            "description": F.when(kind != "de", kind).otherwise(""),
        }
    )
    return records, objects.where(kind != "http").withColumn("file_path", key)


@query(
    "audit_duplicates",
    f"WITH {_DAMAGED} SELECT body, identifier, count(*) AS records FROM damaged GROUP BY body, identifier HAVING count(*) > 1",
)
def audit_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.duplicate_identities(_damaged(spark, sf_dir)[0])


def _flag(name: str, flag: str):
    @query(name, f"WITH {_DAMAGED} SELECT body, identifier, file_path, {flag} FROM damaged")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        checked = audit.landing_checks(*_damaged(spark, sf_dir))
        return checked.select("body", "identifier", "file_path", flag)

    return run


audit_missing_objects = _flag("audit_missing_objects", "missing_object")
audit_hash_mismatch = _flag("audit_hash_mismatch", "hash_mismatch")
audit_key_format = _flag("audit_key_format", "bad_key")
audit_metadata_gaps = _flag("audit_metadata_gaps", "metadata_gap")


@query(
    "audit_report_landing",
    f"""WITH {_DAMAGED}
SELECT count(*) AS landing_documents,
  (SELECT count(*) FROM (SELECT 1 FROM damaged GROUP BY body, identifier HAVING count(*) > 1)) AS duplicate_identities,
  count(*) FILTER (WHERE missing_object) AS missing_objects, count(*) FILTER (WHERE hash_mismatch) AS hash_mismatches,
  count(*) FILTER (WHERE bad_key) AS landing_key_format_mismatches, count(*) FILTER (WHERE metadata_gap) AS metadata_gaps,
  true AS bad
FROM damaged""",
)
def audit_report_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_landing(*_damaged(spark, sf_dir))


def _changed(objects: DataFrame) -> DataFrame:
    """English objects grew by a byte, http objects are gone."""
    grown = F.when(F.col("description") == "en", F.concat("content", F.lit(b"!"))).otherwise(F.col("content"))
    return objects.withColumn("content", grown).where("description <> 'http'")


_CHANGED = f"""WITH {CAPTURES}
SELECT body, identifier, description = 'en' AS changed_since_snapshot, description = 'en' AS differs_from_hash,
  description = 'http' AS object_gone FROM landed"""


@query("audit_landing_changed", _CHANGED)
def audit_landing_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, objects = landed(captures(spark, sf_dir))
    rows = audit.landing_changes(landing, _changed(objects), object_table.snapshot(objects))
    return rows.select("body", "identifier", "changed_since_snapshot", "differs_from_hash", "object_gone")


@query(
    "snapshot_diff",
    f"""WITH {CAPTURES}
SELECT file_path, CASE WHEN description = 'en' THEN 'changed' ELSE 'removed' END AS change FROM landed
WHERE description IN ('en', 'http')""",
)
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, objects = landed(captures(spark, sf_dir))
    diff = audit.snapshot_diff(object_table.snapshot(objects), object_table.snapshot(_changed(objects)))
    return diff.select("file_path", "change")


# Damage in the transformed zone: French records are filed under another name, where there is no
# object; https pages carry a stale hash.

_DAMAGED_OUT = f"""{_WINNERS},
out AS (
  SELECT body, identifier, partition_date, CASE WHEN description = 'fr' THEN key || '.bak' ELSE key END AS file_path,
    description = 'fr' AS missing_object, description = 'fr' AS name_mismatch,
    description <> 'fr' AND (description = 'https' OR place > 1 AND file_hash <> first_value(file_hash) OVER (PARTITION BY key ORDER BY place)) AS hash_mismatch
  FROM good)
"""


def _damaged_out(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    landing, objects, rows = _zones(spark, sf_dir)
    good = materialize(rows.where("error_code is null"), "transformed")
    order = F.struct("partition_date", "identifier", "body").alias(object_table.ORDER)
    versions = good.select("file_path", "content", order)
    kind = F.col("description")
    records = good.drop("content").withColumns(
        {
            "file_path": F.when(kind == "fr", F.concat("file_path", F.lit(".bak"))).otherwise(F.col("file_path")),
            "file_hash": F.when(kind == "https", "stale").otherwise(F.col("file_hash")),
        }
    )
    return records, versions, landing, objects


def _out_flag(name: str, flag: str):
    @query(name, f"WITH {_DAMAGED_OUT} SELECT body, identifier, file_path, {flag} FROM out")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        records, versions, _, _ = _damaged_out(spark, sf_dir)
        checked = audit.transformed_checks(records, versions)
        return checked.select("body", "identifier", "file_path", flag)

    return run


audit_missing_transformed = _out_flag("audit_missing_transformed", "missing_object")
audit_name_mismatch = _out_flag("audit_name_mismatch", "name_mismatch")
audit_transformed_hash = _out_flag("audit_transformed_hash", "hash_mismatch")


@query(
    "audit_report_transformed",
    f"""WITH {_DAMAGED_OUT}
SELECT (SELECT count(*) FROM out) AS transformed_documents, count(*) AS landing_documents,
  (SELECT count(*) FROM out WHERE missing_object) AS missing_transformed_objects,
  (SELECT count(*) FROM out WHERE name_mismatch) AS identifier_ext_mismatches,
  (SELECT count(*) FROM out WHERE hash_mismatch) AS transformed_hash_mismatches,
  count(*) FILTER (WHERE description = 'en') AS landing_changed_since_snapshot,
  count(*) FILTER (WHERE description = 'en') AS landing_differs_from_hash,
  count(*) FILTER (WHERE description = 'http') AS landing_objects_gone,
  2 * count(*) FILTER (WHERE description = 'en') AS landing_bytes_changed, true AS bad
FROM landed""",
)
def audit_report_transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, versions, landing, objects = _damaged_out(spark, sf_dir)
    before = object_table.snapshot(objects)
    return audit.audit_transformed(records, versions, landing, _changed(objects), before)


# --- end to end -------------------------------------------------------------------------------


@query(
    "window_end_to_end",
    f"""WITH {_DONE}
SELECT body, partition_date AS partition, count(*) AS records_found, count(*) FILTER (WHERE error_code IS NULL) AS records_scraped,
  count(*) FILTER (WHERE error_code IS NOT NULL) AS failed, CAST(0 AS BIGINT) AS skipped
FROM done GROUP BY body, partition_date""",
)
def window_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest and transform through the store; the counts come from the written outcomes."""
    store = Store(spark, workspace(spark, "store"))
    result = run_window(store, captures(spark, sf_dir), *CAPTURE_RANGE, AS_OF)
    return scope_stats(plans.transform_events(result.outcomes))


@query(
    "transform_narrow_range",
    """
WITH numbered AS (SELECT doc_id // 2 AS pair, doc_id % 2 AS turn, coalesce(text, '') AS text FROM documents)
SELECT 'D/' || pair AS identifier, 'Archive/D-' || pair || '.pdf' AS source_file_path, 'D-' || pair || '.pdf' AS file_path,
  sha256('%PDF-' || arg_max(text, turn)) AS file_hash, CAST(NULL AS VARCHAR) AS error_code
FROM numbered GROUP BY pair HAVING min(turn) = 0""",
)
def transform_narrow_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """January alone, though most of its keys were last written by records of March.

    Documents come in pairs whose identifiers, with a slash and with a dash, share an object key.
    """
    pair, turn = F.floor(F.col("doc_id") / 2).cast("string"), F.col("doc_id") % 2
    identifier = F.concat(F.when(turn == 0, "D/").otherwise("D-"), pair)
    day = F.when(turn == 0, "2024-01-01").otherwise("2024-03-01")
    given = {
        "fetch_seq": F.col("doc_id"), "body": F.lit("Archive"), "identifier": identifier, "title": identifier,
        "description": F.lit("text"), "date": day, "document_url": F.concat(F.lit("https://example.test/"), identifier),
        "partition_date": day, "status": F.lit(200), "content_type": F.lit("application/pdf"),
        "payload": F.encode(F.concat(F.lit("%PDF-"), F.coalesce("text", F.lit(""))), "UTF-8"),
    }
    empty = {f.name: F.lit(None).cast(f.dataType) for f in CAPTURE_SCHEMA if f.name not in given}
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    store = Store(spark, workspace(spark, "narrow"))
    run_ingest(store, documents.withColumns({**given, **empty}).select(*CAPTURE_SCHEMA.names), AS_OF)
    outcomes = plans.run_transform(store, "2024-01-01", "2024-02-01", AS_OF)
    return outcomes.select("identifier", "source_file_path", "file_path", "file_hash", "error_code")


def _sql_run(logger: str, event: str, *fields: str) -> str:
    return _sql_line("INFO", logger, event, _fields(*fields))


_SPAN = """',"start_date":"2024-01-01","end_date":"2024-04-01","partition_size":"monthly"'"""
_COUNTED = "count(*) AS records_found, count(*) FILTER (WHERE status <> 404) AS records_scraped, count(*) FILTER (WHERE status = 404) AS failed"
_NUMBERS = _fields(*[f"""',"{name}":' || {name}""" for name in ("records_found", "records_scraped", "failed")])


@query(
    "run_log",
    f"""
WITH given AS (
  SELECT source AS body, 'L/' || doc_id AS identifier, 'L-' || doc_id AS name, 'https://files.example.test/' || doc_id AS url,
    CASE doc_id % 10 WHEN 3 THEN 404 WHEN 7 THEN 304 ELSE 200 END AS status, sha256('%PDF-' || text) AS file_hash,
    date_trunc('month', DATE '2024-01-01' + CAST(doc_id % 90 AS INTEGER)) AS month,
    strftime(month, '%Y-%m-%d') AS partition_date,
    strftime(month, '%Y-%m-%d') || '/' || strftime(month + INTERVAL 1 MONTH, '%Y-%m-%d') AS partition, 'pdf' AS document_type
  FROM documents),
stored AS (SELECT *, body || '/' || name || '.pdf' AS file_path, name || '.pdf' AS key FROM given WHERE status = 200),
landed AS (SELECT body, partition, {_COUNTED} FROM given GROUP BY ALL),
made AS (SELECT body, partition_date AS partition, {_COUNTED} FROM stored GROUP BY ALL),
total AS (SELECT {_COUNTED} FROM given), whole AS (SELECT {_COUNTED} FROM stored)
SELECT {_sql_run("landing", "run_started", _SPAN, "',"+'"partitions":3'+"'")} AS value
UNION ALL SELECT {_sql_run("landing", "bodies_discovered", """',"bodies":["' || string_agg(DISTINCT body, '","' ORDER BY body) || '"]'""")} FROM given
UNION ALL SELECT {_sql_run("landing", "record_stored", *map(_text, ("body", "identifier", "partition", "file_path", "file_hash", "document_type")), """',"object_written":true,"inserted":true'""")} FROM stored
UNION ALL SELECT {_sql_run("landing", "document_unchanged", *map(_text, ("url", "identifier", "body")), _text("reason", "'http_validator'"))} FROM given WHERE status = 304
UNION ALL SELECT {_sql_line("ERROR", "landing", "record_failed", _fields(_text("url"), _text("error_code", "'404'"), _text("reason", "'http error 404'"), *map(_text, ("body", "partition", "identifier"))))} FROM given WHERE status = 404
UNION ALL SELECT {_sql_run("landing", "partition_summary", *map(_text, ("body", "partition")), _NUMBERS)} FROM landed
UNION ALL SELECT {_sql_run("landing", "run_summary", _NUMBERS, _SPAN, """',"reason":"finished"'""")} FROM total
UNION ALL SELECT {_sql_run("transformation", "transform_started", """',"partition":"2024-01-01/2024-04-01"'""")}
UNION ALL SELECT {_sql_run("transformation", "document_transformed", *map(_text, ("identifier", "body")), _text("partition", "partition_date"), _text("document_type"), _text("file_path", "key"), _text("file_hash"), """',"unchanged_content":true'""")} FROM stored
UNION ALL SELECT {_sql_run("transformation", "partition_summary", *map(_text, ("body", "partition")), _NUMBERS)} FROM made
UNION ALL SELECT {_sql_run("transformation", "run_summary", _NUMBERS, """',"partition":"2024-01-01/2024-04-01"'""")} FROM whole""",
)
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of a run over the documents, one in ten gone and one in ten unchanged."""
    n = F.col("doc_id")
    rows = _capture(
        table(spark, sf_dir, "documents"),
        n,
        fetch_seq=n,
        body=F.col("source"),
        identifier=F.concat(F.lit("L/"), n),
        title=F.col("source"),
        description=F.col("lang"),
        document_url=F.concat(F.lit("https://files.example.test/"), n),
        content_type=F.lit("application/pdf"),
        status=F.when(n % 10 == 3, 404).when(n % 10 == 7, 304).otherwise(200),
        payload=F.encode(F.concat(F.lit("%PDF-"), "text"), "UTF-8"),
    )
    bodies = table(spark, sf_dir, "documents").select(F.col("source").alias("body_id"), F.col("source").alias("body"))
    store = Store(spark, workspace(spark, "logged"))
    return run_logged(store, rows, bodies, *CAPTURE_RANGE, "2024-06-01")
