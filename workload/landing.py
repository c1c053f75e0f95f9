"""Landing: triage, validation, write decisions, upserts, scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.operators import identity, outcomes
from doclake.plans.ingest import decide, landing_after, last_writes, objects_to_write, run_ingest
from doclake.schema import CAPTURE_SCHEMA
from doclake.sources import captures as files
from doclake.sources import landing as scans
from doclake.sources.objects import export_objects
from doclake.sources.store import METADATA, Store
from doclake.sources.workspace import materialize, workspace
from workload.inputs import AS_OF, DECIDED, FETCHES, fetch_batches, fetches, page_captures
from workload.registry import query, table


def no_landing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], METADATA["landing"])


def all_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide(fetches(spark, sf_dir).drop("ts"), no_landing(spark))


def landing_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing after all attempts."""
    after = landing_after(no_landing(spark), all_decisions(spark, sf_dir), AS_OF)
    return after.drop("action")


def first_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing after the first batch."""
    first, _ = fetch_batches(spark, sf_dir)
    return landing_after(no_landing(spark), decide(first, no_landing(spark)), AS_OF).drop("action")


@query(
    "captures_from_pages",
    """
SELECT page_id * 2 AS fetch_seq, 'Panel ' || (page_id % 4) AS body, 'PG-' || page_id AS identifier, url AS document_url,
  strftime(DATE '2024-01-01' + CAST(page_id % 90 AS INTEGER), '%Y-%m-%d') AS date,
  strftime(date_trunc('month', DATE '2024-01-01' + CAST(page_id % 90 AS INTEGER)), '%Y-%m-%d') AS partition_date,
  200 AS status, sha256(html || '<!-- cached or not being index.aspx page --><!-- Elapsed time: 0.' || page_id || ' -->') AS raw_hash
FROM pages""",
)
def captures_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures written as files and read back through the capture source."""
    path = workspace(spark, "captures")
    page_captures(spark, sf_dir).select(*CAPTURE_SCHEMA.names).write.parquet(path)
    return files.read_captures(spark, path).select(
        "fetch_seq", "body", "identifier", "document_url", "date", "partition_date", "status",
        F.sha2("payload", 256).alias("raw_hash"),
    )


@query(
    "captures_from_files",
    """
SELECT doc_id AS fetch_seq, source AS body, CAST(doc_id AS VARCHAR) AS identifier, CASE WHEN lang = 'fr' THEN 304 ELSE 200 END AS status,
  CASE WHEN lang <> 'fr' THEN sha256(text) END AS raw_hash FROM documents""",
)
def captures_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads as single files, joined to their metadata; French documents were not modified."""
    root = workspace(spark, "capture-files")
    rows = table(spark, sf_dir, "documents").withColumn(
        "file_path", F.concat("source", F.lit("/"), "doc_id")
    )
    fetched = rows.where("lang <> 'fr'")
    export_objects(fetched.select("file_path", F.encode("text", "UTF-8").alias("content")), root)
    given = {
        "fetch_seq": F.col("doc_id"),
        "body": F.col("source"),
        "identifier": F.col("doc_id").cast("string"),
        "status": F.when(F.col("lang") == "fr", 304).otherwise(200),
    }
    blank = F.lit(None).cast("string")
    others = [c for c in CAPTURE_SCHEMA.names if c not in (*given, "payload")]
    metadata = rows.select(
        "file_path", *[c.alias(n) for n, c in given.items()], *[blank.alias(c) for c in others]
    )
    return files.captures_from_files(spark, metadata, root).select(
        *given, F.sha2("payload", 256).alias("raw_hash")
    )


@query(
    "request_failures",
    f"""WITH {FETCHES}
SELECT document_url AS url, coalesce(triage_code, CAST(status AS VARCHAR)) AS error_code,
  coalesce(triage_reason, 'http error ' || status) AS reason FROM triaged WHERE status IS NULL OR status NOT BETWEEN 200 AND 299""",
)
def request_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attempts taken as listing requests: a 304 is a failure there."""
    return outcomes.request_failures(fetches(spark, sf_dir)).select("url", "error_code", "reason")


@query(
    "triage",
    f"""WITH {FETCHES}
SELECT fetch_seq, triage_outcome AS outcome, triage_code AS error_code, triage_reason AS reason FROM triaged""",
)
def triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outcomes.triage(fetches(spark, sf_dir))
    return rows.select("fetch_seq", "outcome", "error_code", "reason")


@query(
    "validate_records",
    f"""WITH {FETCHES}
SELECT fetch_seq, outcome = 'stored' AS valid, error_code, reason FROM checked WHERE triage_outcome = 'fetched'""",
)
def validate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    fetched = outcomes.triage(fetches(spark, sf_dir)).where("outcome = 'fetched'")
    return outcomes.with_validation(fetched).select(
        "fetch_seq", F.col("error_code").isNull().alias("valid"), "error_code", "reason"
    )


@query(
    "join_existing",
    f"""WITH {DECIDED},
early AS (
  SELECT * FROM hashed WHERE ts < TIMESTAMP '2024-01-16'
  QUALIFY row_number() OVER (PARTITION BY body, identifier ORDER BY fetch_seq DESC) = 1)
SELECT f.fetch_seq, f.body, f.identifier, e.file_hash, e.http_etag
FROM fetches f LEFT JOIN early e ON f.body = e.body AND f.identifier = e.identifier
WHERE f.ts >= TIMESTAMP '2024-01-16'""",
)
def join_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, second = fetch_batches(spark, sf_dir)
    joined = identity.join_existing(second, first_landing(spark, sf_dir), "file_hash", "http_etag")
    return joined.select("fetch_seq", "body", "identifier", "existing.file_hash", "existing.http_etag")


@query(
    "latest_per_identity",
    f"WITH {DECIDED} SELECT body, identifier, fetch_seq, file_path, file_hash, partition_date FROM landing",
)
def latest_per_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = all_decisions(spark, sf_dir).where("outcome = 'stored'")
    rows = stored.select("body", "identifier", "fetch_seq", "file_path", "file_hash", "partition_date")
    return identity.latest_per_identity(rows)


_DECISIONS = f"WITH {DECIDED} SELECT fetch_seq, body, identifier, file_path, file_hash, inserted, object_written FROM decided"


@query("write_decisions", _DECISIONS)
def write_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions over the whole fetch history, nothing stored before."""
    stored = all_decisions(spark, sf_dir).where("outcome = 'stored'")
    return stored.select(
        "fetch_seq", "body", "identifier", "file_path", "file_hash", "inserted", "object_written"
    )


@query("write_decisions_resumed", f"{_DECISIONS} WHERE ts >= TIMESTAMP '2024-01-16'")
def write_decisions_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of the second batch against what the first one stored."""
    _, second = fetch_batches(spark, sf_dir)
    stored = decide(second, first_landing(spark, sf_dir)).where("outcome = 'stored'")
    return stored.select(
        "fetch_seq", "body", "identifier", "file_path", "file_hash", "inserted", "object_written"
    )


@query("ingest_indexed", f"{_DECISIONS} WHERE ts >= TIMESTAMP '2024-01-16'")
def ingest_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch ingested into a store that holds the first, which is known by its index only."""
    store = Store(spark, workspace(spark, "indexed"))
    for batch in fetch_batches(spark, sf_dir):
        decisions = run_ingest(store, batch, AS_OF)
    return decisions.where("outcome = 'stored'").select(
        "fetch_seq", "body", "identifier", "file_path", "file_hash", "inserted", "object_written"
    )


@query(
    "objects_to_write",
    f"""WITH {DECIDED},
last_write AS (
  SELECT file_path, max(fetch_seq) AS fetch_seq FROM decided WHERE object_written GROUP BY file_path)
SELECT d.file_path, d.fetch_seq, d.file_hash, d.partition_date,
  CASE d.document_type WHEN 'pdf' THEN 'application/pdf' WHEN 'doc' THEN 'application/msword' ELSE 'text/html; charset=utf-8' END AS content_type
FROM decided d JOIN last_write w ON d.file_path = w.file_path AND d.fetch_seq = w.fetch_seq""",
)
def written_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash is taken from the content again, so it proves what is written."""
    rows = objects_to_write(fetches(spark, sf_dir), last_writes(all_decisions(spark, sf_dir)))
    return rows.select(
        "file_path", "fetch_seq", F.sha2("content", 256).alias("file_hash"), "partition_date", "content_type"
    )


@query(
    "ingest_batch",
    f"""WITH {DECIDED}
SELECT fetch_seq, body, partition, identifier, document_url, outcome, error_code, reason, object_written, inserted,
  file_path, file_hash, document_type FROM outcomes""",
)
def ingest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every attempt with its outcome, failure or write decision."""
    return all_decisions(spark, sf_dir).select(
        "fetch_seq", "body", "partition", "identifier", "document_url", "outcome", "error_code",
        "reason", "object_written", "inserted", "file_path", "file_hash", "document_type",
    )


@query(
    "capture_contract",
    f"""WITH {FETCHES},
bent AS (
  SELECT fetch_seq AS n, partition, 'Contract' AS body,
    CASE WHEN fetch_seq % 23 IN (3, 4) THEN 'twin ' || (fetch_seq // 23) WHEN identifier = '///' THEN identifier ELSE identifier || ' ' || fetch_seq END AS identifier,
    CASE WHEN fetch_seq % 23 = 1 THEN NULL WHEN fetch_seq % 23 = 2 THEN -fetch_seq WHEN fetch_seq % 23 IN (3, 4) THEN fetch_seq // 23 ELSE fetch_seq END AS number,
    fetch_seq % 23 = 5 AS bare, triage_outcome, triage_code, description, identifier = '///' AND fetch_seq % 23 NOT IN (3, 4) AS empty
  FROM triaged),
judged AS (
  SELECT *,
    CASE WHEN triage_outcome <> 'fetched' THEN triage_code
         WHEN description IS NULL THEN 'ValidationError' WHEN empty THEN 'ValueError'
         WHEN bare OR number IS NULL OR number < 0 THEN 'ValidationError' END AS code
  FROM bent),
counted AS (
  SELECT *, triage_outcome = 'fetched' AND code IS NULL
    AND count(*) FILTER (WHERE triage_outcome = 'fetched' AND code IS NULL) OVER (PARTITION BY identifier, number) > 1 AS twice
  FROM judged)
SELECT CASE WHEN triage_outcome = 'unchanged' THEN 'unchanged' WHEN triage_outcome = 'failed' OR code IS NOT NULL OR twice THEN 'failed' ELSE 'stored' END AS outcome,
  CASE WHEN twice THEN 'ValidationError' ELSE code END AS error_code, count(*) AS captures
FROM counted GROUP BY ALL""",
)
def capture_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts of which some lack number or payload, or share identity and number: each has its row."""
    n = F.col("fetch_seq")
    kind, group = n % 23, F.floor(n / 23)
    identifier = F.when(kind.isin(3, 4), F.concat(F.lit("twin "), group)).when(F.col("identifier") == "///", "///")
    bent = fetches(spark, sf_dir).drop("ts").withColumns(
        {
            "body": F.lit("Contract"),
            "identifier": identifier.otherwise(F.concat("identifier", F.lit(" "), n)),
            "payload": F.when(kind != 5, F.col("payload")),
            "fetch_seq": F.when(kind == 1, None).when(kind == 2, -n).when(kind.isin(3, 4), group).otherwise(n),
        }
    )
    decided = decide(bent, no_landing(spark))
    return decided.groupBy("outcome", "error_code").agg(F.count("*").alias("captures"))


_SPLIT = f"""{DECIDED},
seen AS (SELECT body, identifier, min(ts) AS first_ts, max(ts) AS last_ts FROM decided GROUP BY body, identifier)
"""


@query(
    "upsert_landing",
    f"""WITH {_SPLIT}
SELECT l.body, l.identifier, l.description, l.date, l.partition_date, l.file_path, l.file_hash, l.http_etag,
  CASE WHEN last_ts < TIMESTAMP '2024-01-16' THEN 'kept' WHEN first_ts < TIMESTAMP '2024-01-16' THEN 'updated' ELSE 'inserted' END AS action,
  (SELECT arg_max(d.partition_date, d.fetch_seq) FROM decided d
   WHERE d.body = l.body AND d.identifier = l.identifier AND d.object_written) AS object_partition
FROM landing l JOIN seen s ON l.body = s.body AND l.identifier = s.identifier""",
)
def upsert_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch upserted onto the first."""
    stored = materialize(first_landing(spark, sf_dir), "landing")
    _, second = fetch_batches(spark, sf_dir)
    decisions = materialize(decide(second, stored), "decisions")
    after = landing_after(stored, decisions, AS_OF)
    return after.select(
        "body", "identifier", "description", "date", "partition_date", "file_path", "file_hash",
        "http_etag", "action", "object_partition",
    )


@query(
    "upsert_partial",
    """
WITH stored AS (
  SELECT c_custkey % 1000 AS id, max(c_name) AS name, max(c_mktsegment) AS segment, max(c_acctbal) AS balance
  FROM customer GROUP BY 1),
batch AS (
  SELECT o_custkey AS id, arg_max(CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END IS NULL, o_orderkey) AS is_null,
    arg_max(coalesce(CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END, ''), o_orderkey) AS segment,
    max(o_orderkey) AS last_order
  FROM orders GROUP BY 1)
SELECT coalesce(s.id, b.id) AS id, s.name,
  CASE WHEN b.id IS NOT NULL THEN CASE WHEN b.is_null THEN NULL ELSE b.segment END ELSE s.segment END AS segment,
  s.balance, b.last_order,
  CASE WHEN s.id IS NULL THEN 'inserted' WHEN b.id IS NULL THEN 'kept' ELSE 'updated' END AS action
FROM stored s FULL OUTER JOIN batch b ON s.id = b.id""",
)
def upsert_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absent fields keep stored values, present nulls overwrite, new fields are added."""
    stored = (
        table(spark, sf_dir, "customer")
        .groupBy((F.col("c_custkey") % 1000).alias("id"))
        .agg(F.max("c_name").alias("name"), F.max("c_mktsegment").alias("segment"), F.max("c_acctbal").alias("balance"))
    )
    batch = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("segment"),
        F.col("o_orderkey").alias("last_order"),
        F.col("o_orderkey").alias("position"),
    )
    return identity.upsert(stored, batch, order="position", keys=["id"])


_DATED = "SELECT o_orderkey, 'C-' || o_custkey AS identifier, o_orderpriority AS body, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS partition_date FROM orders"


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("C-"), "o_custkey").alias("identifier"),
        F.col("o_orderpriority").alias("body"),
        F.trunc(F.to_date("o_orderdate"), "MM").cast("string").alias("partition_date"),
    )


@query(
    "landing_range_scan",
    f"SELECT * FROM ({_DATED}) WHERE partition_date >= '1996-03-01' AND partition_date < '1998-11-01'",
)
def landing_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.scan_range(_dated(spark, sf_dir), "1996-03-01", "1998-11-01")


@query(
    "landing_ordered",
    f"SELECT * FROM ({_DATED}) WHERE partition_date >= '1996-03-01' AND partition_date < '1998-11-01' ORDER BY partition_date, identifier, body",
)
def landing_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.ordered(scans.scan_range(_dated(spark, sf_dir), "1996-03-01", "1998-11-01"))


@query("find_by_identity", f"WITH {DECIDED} SELECT body, identifier, file_path, file_hash FROM landing WHERE body = 'purchase' AND identifier = 'U 7'")
def find_by_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scans.find(landing_table(spark, sf_dir), "purchase", "U 7")
    return found.select("body", "identifier", "file_path", "file_hash")


@query(
    "find_many",
    f"""WITH {DECIDED} SELECT body, identifier, file_path, file_hash FROM landing l
WHERE EXISTS (SELECT 1 FROM fetches f WHERE f.body = l.body AND f.identifier = l.identifier AND f.status = 304)""",
)
def find_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored records of the identities a server called unchanged."""
    wanted = fetches(spark, sf_dir).where("status = 304")
    found = scans.find_many(landing_table(spark, sf_dir), wanted)
    return found.select("body", "identifier", "file_path", "file_hash")


