"""Structured log lines: one JSON object per line, out and in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COUNTERS = ("records_found", "records_scraped", "failed")


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with an order column ``line_no`` that grows along each file."""
    return spark.read.text(path).select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("line_no"),
    )


def parse_log_events(lines: DataFrame) -> DataFrame:
    """Log lines as events: the fixed fields as columns, every field in a map.

    Lines that are not exactly one JSON object are skipped. A line is parsed as the only element
    of an array, since the parser would otherwise overlook what follows an object.
    """
    boxed = F.concat(F.lit("["), "value", F.lit("]"))
    parsed = F.from_json(boxed, "array<map<string,string>>")
    one = F.when(F.size(parsed) == 1, parsed[0])
    rows = lines.withColumn("fields", one).where("fields is not null")
    carried = [c for c in lines.columns if c != "value"]

    def field(name: str) -> Column:
        return F.try_element_at("fields", F.lit(name))

    return rows.select(
        *carried,
        *[field(name).alias(name) for name in ("ts", "level", "logger", "event")],
        *[field(name).try_cast("bigint").alias(name) for name in COUNTERS],
        "fields",
    )


def event_line(ts: Column, level: Column, logger: Column, event: Column, **fields: Column) -> Column:
    """One JSON line; fields that are null are written as null, like any other value."""
    members = [ts.alias("ts"), level.alias("level"), logger.alias("logger"), event.alias("event")]
    members += [column.alias(name) for name, column in fields.items()]
    return F.to_json(F.struct(*members), {"ignoreNullFields": "false"})


def write_event_lines(lines: DataFrame, path: str) -> None:
    lines.select("value").write.mode("overwrite").text(path)
