"""Counters, summaries, events and log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.functions.windows import scope_grid
from doclake.operators import events, outcomes, stats
from doclake.sources import logs
from doclake.sources.workspace import materialize, workspace
from workload.inputs import DECIDED, FETCH_RANGE, FETCHES, fetches
from workload.landing import all_decisions
from workload.registry import query, table

_COUNTS = """
  count(*) AS records_found,
  count(*) FILTER (WHERE outcome IN ('stored', 'unchanged')) AS records_scraped,
  count(*) FILTER (WHERE outcome = 'failed') AS failed,
  CAST(0 AS BIGINT) AS skipped"""


@query("scope_stats", f"WITH {FETCHES} SELECT body, partition, {_COUNTS} FROM checked GROUP BY body, partition")
def scope_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.scope_stats(all_decisions(spark, sf_dir))


@query(
    "scope_stats_skipped",
    """
WITH links AS (
  SELECT page_id, generate_subscripts(hrefs, 1) AS pos, unnest(hrefs) AS href, url
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages)),
requests AS (SELECT page_id, pos, regexp_extract(url, '^https?://[^/]+') || href AS document_url FROM links),
marked AS (
  SELECT split_part(document_url, ':', 1) AS body, 'all' AS partition,
    CASE WHEN NOT regexp_matches(document_url, '^https?://([^/]*\\.)?example\\.com/') OR row_number() OVER (PARTITION BY document_url ORDER BY page_id, pos) > 1
      THEN 'skipped' ELSE 'stored' END AS outcome FROM requests)
SELECT body, partition, count(*) AS records_found, count(*) FILTER (WHERE outcome = 'stored') AS records_scraped,
  CAST(0 AS BIGINT) AS failed, count(*) FILTER (WHERE outcome = 'skipped') AS skipped
FROM marked GROUP BY body, partition""",
)
def scope_stats_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppressed requests count as skipped, so that found still adds up."""
    from workload.listings import suppress_requests

    rows = suppress_requests(spark, sf_dir)
    outcome = F.when(F.col("suppressed").isNotNull(), "skipped").otherwise("stored")
    return stats.scope_stats(
        rows.select(
            F.split_part("document_url", F.lit(":"), F.lit(1)).alias("body"),
            F.lit("all").alias("partition"),
            outcome.alias("outcome"),
        )
    )


_DENSE = f"""
grid AS (
  SELECT b.body, strftime(w, '%Y-%m-%d') || '/' || strftime(least(w + 7, DATE '2024-02-05'), '%Y-%m-%d') AS partition
  FROM (SELECT DISTINCT event_type AS body FROM events UNION ALL SELECT n_name FROM nation) b,
    (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-04', INTERVAL 7 DAY)) AS DATE) AS w)),
counted AS (SELECT body, partition, {_COUNTS} FROM checked GROUP BY body, partition),
dense AS (
  SELECT g.body, g.partition, coalesce(records_found, 0) AS records_found, coalesce(records_scraped, 0) AS records_scraped,
    coalesce(failed, 0) AS failed, coalesce(skipped, 0) AS skipped
  FROM grid g LEFT JOIN counted c ON g.body = c.body AND g.partition = c.partition)
"""


def _dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event type and every nation with every week; nations have no documents."""
    bodies = table(spark, sf_dir, "events").select(F.col("event_type").alias("body")).distinct()
    bodies = bodies.unionByName(table(spark, sf_dir, "nation").select(F.col("n_name").alias("body")))
    grid = scope_grid(bodies, *FETCH_RANGE, "weekly")
    return stats.scope_stats_dense(all_decisions(spark, sf_dir), grid)


@query("scope_stats_dense", f"WITH {FETCHES}, {_DENSE} SELECT * FROM dense")
def scope_stats_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dense(spark, sf_dir)


@query(
    "scope_balance",
    f"WITH {FETCHES}, {_DENSE} SELECT *, records_found = records_scraped + failed + skipped AS balanced FROM dense",
)
def scope_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.scope_balance(_dense(spark, sf_dir))


@query("run_summary", f"WITH {FETCHES} SELECT {_COUNTS} FROM checked")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.run_summary(stats.scope_stats(all_decisions(spark, sf_dir)))


@query(
    "scope_rollup",
    f"""WITH {FETCHES}
SELECT body, partition, {_COUNTS}, CAST(grouping(body, partition) AS BIGINT) AS level
FROM checked GROUP BY ROLLUP (body, partition)""",
)
def scope_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.scope_rollup(all_decisions(spark, sf_dir))


@query(
    "run_gate",
    f"""WITH {FETCHES}, counted AS (SELECT {_COUNTS} FROM checked)
SELECT *, records_scraped = 0 AND failed > 0 AS run_failed FROM counted""",
)
def run_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.run_gate(run_summary(spark, sf_dir))


@query(
    "ingest_counters",
    f"""WITH {DECIDED}
SELECT 'landing/objects_written' AS name, count(*) FILTER (WHERE object_written) AS value FROM decided
UNION ALL SELECT 'landing/unchanged_hash', count(*) FILTER (WHERE NOT object_written) FROM decided
UNION ALL SELECT 'landing/unchanged_validator', count(*) FILTER (WHERE outcome = 'unchanged') FROM checked
UNION ALL SELECT 'landing/records_inserted', count(*) FILTER (WHERE inserted) FROM decided
UNION ALL SELECT 'landing/records_updated', count(*) FILTER (WHERE NOT inserted) FROM decided""",
)
def ingest_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.ingest_counters(all_decisions(spark, sf_dir))


@query(
    "failure_breakdown",
    f"""WITH {FETCHES}
SELECT error_code, body, partition, count(*) AS failures FROM checked WHERE error_code IS NOT NULL
GROUP BY error_code, body, partition""",
)
def failure_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = outcomes.failures(all_decisions(spark, sf_dir))
    return stats.failure_breakdown(failed, "body", "partition")


@query(
    "event_union",
    f"""WITH {DECIDED}
SELECT fetch_seq, CASE outcome WHEN 'stored' THEN 'record_stored' WHEN 'unchanged' THEN 'document_unchanged' ELSE 'record_failed' END AS event,
  outcome, body, identifier, partition, file_path, error_code FROM outcomes""",
)
def event_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_decisions(spark, sf_dir).select(
        "fetch_seq", "event", "outcome", "body", "identifier", "partition", "file_path", "error_code"
    )


_FAILED_LINES = f"""
failed_lines AS (
  SELECT '{{"ts":"' || date || '","level":"ERROR","logger":"landing","event":"record_failed","url":"' || document_url ||
    '","error_code":"' || error_code || '","reason":"' || reason || '","body":"' || body || '","partition":"' || partition ||
    '","identifier":"' || identifier || '"}}' AS value
  FROM checked WHERE error_code IS NOT NULL)
"""


def _failed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = all_decisions(spark, sf_dir).where("error_code is not null")
    rows = rows.withColumn("url", F.col("document_url"))
    return events.event_lines(rows, "record_failed", F.col("date"), "landing")


@query("event_lines", f"WITH {FETCHES}, {_FAILED_LINES} SELECT value FROM failed_lines")
def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failure events written as log lines and read back as text."""
    path = workspace(spark, "events")
    logs.write_event_lines(_failed_lines(spark, sf_dir), path)
    return logs.read_log_lines(spark, path).select("value")


def _raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log with summaries, other events, arrays and noise between them."""
    n = F.col("event_id")
    summary = F.concat(
        F.lit('{"ts": "'), F.date_format("ts", "yyyy-MM-dd"), F.lit('", "level": "INFO", "logger": "'),
        "event_type", F.lit('", "event": "run_summary", "records_found": '), n,
        F.lit(', "records_scraped": '), "user_id", F.lit("}"),
    )
    other = F.concat(F.lit('{"event": "partition_summary", "records_found": '), n, F.lit(', "failed": "3"}'))
    line = (
        F.when(n % 4 == 0, summary).when(n % 4 == 1, other)
        .when(n % 4 == 2, F.concat(F.lit('["run_summary", '), n, F.lit("]")))
        .otherwise(F.concat(F.lit("not json "), n))
    )
    return table(spark, sf_dir, "events").select(n.alias("line_no"), line.alias("value"))


@query(
    "parse_log_events",
    """
SELECT event_id AS line_no, CASE WHEN event_id % 4 = 0 THEN strftime(ts, '%Y-%m-%d') END AS ts,
  CASE WHEN event_id % 4 = 0 THEN 'INFO' END AS level, CASE WHEN event_id % 4 = 0 THEN event_type END AS logger,
  CASE WHEN event_id % 4 = 0 THEN 'run_summary' ELSE 'partition_summary' END AS event, event_id AS records_found,
  CASE WHEN event_id % 4 = 0 THEN user_id END AS records_scraped,
  CASE WHEN event_id % 4 = 1 THEN CAST(3 AS BIGINT) END AS failed
FROM events WHERE event_id % 4 < 2""",
)
def parse_log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.parse_log_events(_raw_lines(spark, sf_dir)).drop("fields")


@query(
    "log_run_summary",
    """
SELECT event_id AS records_found, user_id AS records_scraped, CAST(0 AS BIGINT) AS failed FROM events
WHERE event_id = (SELECT max(event_id) FROM events WHERE event_id % 4 = 0)""",
)
def log_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.log_run_summary(logs.parse_log_events(_raw_lines(spark, sf_dir)))


@query(
    "run_events",
    f"""WITH {FETCHES},
scopes AS (SELECT body, partition, {_COUNTS} FROM checked GROUP BY body, partition)
SELECT '{{"ts":"2024-06-01","level":"INFO","logger":"landing","event":"partition_summary","body":"' || body || '","partition":"' ||
  partition || '","records_found":' || records_found || ',"records_scraped":' || records_scraped || ',"failed":' || failed || '}}' AS value
FROM scopes
UNION ALL
SELECT '{{"ts":"2024-06-01","level":"WARNING","logger":"throttle","event":"rate_limited","url":"' || document_url || '","error_code":"' || status ||
  '","retry_after":' || coalesce('"' || nullif(retry_after, '') || '"', 'null') || '}}'
FROM fetches WHERE status IN (429, 503)""",
)
def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scope summaries and throttling as log lines."""
    from doclake.operators.frontier import rate_limited

    day = F.lit("2024-06-01")
    scopes = stats.scope_stats(all_decisions(spark, sf_dir))
    throttled = rate_limited(fetches(spark, sf_dir))
    return events.event_lines(scopes, "partition_summary", day, "landing").unionByName(
        events.event_lines(throttled, "rate_limited", day, "throttle")
    )


def _sql_line(level: str, logger: str, event: str, fields: str) -> str:
    head = f'{{"ts":"2024-06-01","level":"{level}","logger":"{logger}","event":"{event}"'
    return f"'{head}' || {fields} || '}}'"


def _text(name: str, column: str | None = None) -> str:
    return f"""',"{name}":' || coalesce('"' || replace({column or name}, '"', '\"') || '"', 'null')"""


def _plain(name: str) -> str:
    return f"""',"{name}":' || {name}"""


def _fields(*parts: str) -> str:
    return " || ".join(parts)


_SUMMARY_LINES = f"""
UNION ALL SELECT {{scope}} FROM scopes
UNION ALL SELECT {{run}} FROM (SELECT CAST(sum(records_found) AS BIGINT) AS records_found,
  CAST(sum(records_scraped) AS BIGINT) AS records_scraped, CAST(sum(failed) AS BIGINT) AS failed FROM scopes)"""
_NUMBERS = (_plain("records_found"), _plain("records_scraped"), _plain("failed"))


def _summary_lines(logger: str) -> str:
    return _SUMMARY_LINES.format(
        scope=_sql_line("INFO", logger, "partition_summary", _fields(_text("body"), _text("partition"), *_NUMBERS)),
        run=_sql_line("INFO", logger, "run_summary", _fields(*_NUMBERS)),
    )


@query(
    "ingest_log",
    f"""WITH {DECIDED}, scopes AS (SELECT body, partition, {_COUNTS} FROM checked GROUP BY body, partition)
SELECT {_sql_line("INFO", "landing", "record_stored", _fields(_text("body"), _text("identifier"), _text("partition"), _text("file_path"), _text("file_hash"), _text("document_type"), _plain("object_written"), _plain("inserted")))} AS value FROM decided
UNION ALL SELECT {_sql_line("INFO", "landing", "document_unchanged", _fields(_text("url", "document_url"), _text("identifier"), _text("body"), _text("reason", "'http_validator'")))} FROM checked WHERE outcome = 'unchanged'
UNION ALL SELECT {_sql_line("ERROR", "landing", "record_failed", _fields(_text("url", "document_url"), _text("error_code"), _text("reason"), _text("body"), _text("partition"), _text("identifier")))} FROM checked WHERE outcome = 'failed'
{_summary_lines("landing")}""",
)
def ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of an ingest run."""
    decisions = materialize(all_decisions(spark, sf_dir), "decisions")
    return events.ingest_log(decisions, F.lit("2024-06-01"))
