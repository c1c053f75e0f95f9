"""Audits of both zones. Each returns one row of counts, also when all is well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.functions.text import blank, transformed_key
from doclake.schema import HTML, IDENTITY, REQUIRED_FIELDS
from doclake.sources.objects import ORDER, digests


def duplicate_identities(records: DataFrame) -> DataFrame:
    """Identities that occur more than once, with their count."""
    counted = records.groupBy(*IDENTITY).agg(F.count("*").alias("records"))
    return counted.where("records > 1")


def metadata_gap() -> Column:
    """Any required field null or empty."""
    gap = blank(F.col(REQUIRED_FIELDS[0]))
    for name in REQUIRED_FIELDS[1:]:
        gap = gap | blank(F.col(name))
    return gap


def with_digest(records: DataFrame, objects: DataFrame) -> DataFrame:
    """Records with the digest of the bytes now under their key, and whether there is an object.

    Presence comes from the key's last write, so a check of presence alone hashes nothing.
    """
    found = digests(objects).select("file_path", F.col(ORDER).isNotNull().alias("there"), "digest")
    joined = records.join(found, "file_path", "left")
    return joined.withColumn("there", F.coalesce("there", F.lit(False)))


def landing_checks(records: DataFrame, objects: DataFrame) -> DataFrame:
    """Records with one flag per check."""
    there = F.col("there")
    return with_digest(records, objects).withColumns(
        {
            "missing_object": ~there,
            "hash_mismatch": there & ~F.col("digest").eqNullSafe(F.col("file_hash")),
            "bad_key": there & ~F.contains("file_path", F.lit("/")),
            "metadata_gap": metadata_gap(),
        }
    )


def _report(checked: DataFrame, total: str, duplicates: str | None, flags: dict[str, str]) -> DataFrame:
    """Counts of all flags in one pass: per identity first, which also shows the duplicates."""
    per_identity = checked.groupBy(*IDENTITY).agg(
        F.count("*").alias("records"),
        *[F.count_if(F.col(flag)).alias(flag) for flag in flags],
    )
    counts = [_sum(F.col("records")).alias(total)]
    if duplicates:
        counts.append(F.count_if(F.col("records") > 1).alias(duplicates))
    return per_identity.agg(*counts, *[_sum(F.col(f)).alias(name) for f, name in flags.items()])


def _sum(column: Column) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")


def audit_landing(records: DataFrame, objects: DataFrame) -> DataFrame:
    """Landing report and its verdict: ``bad`` when any check found something."""
    flags = {
        "missing_object": "missing_objects",
        "hash_mismatch": "hash_mismatches",
        "bad_key": "landing_key_format_mismatches",
        "metadata_gap": "metadata_gaps",
    }
    checked = landing_checks(records, objects)
    report = _report(checked, "landing_documents", "duplicate_identities", flags)
    problems = [F.col(c) for c in report.columns if c != "landing_documents"]
    return report.withColumn("bad", F.greatest(*problems) > 0)


def landing_changes(records: DataFrame, objects: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Records whose bytes differ from the snapshot, from their own hash, or are gone."""
    before = snapshot.select("file_path", F.col("file_hash").alias("before"))
    joined = with_digest(records, objects).join(before, "file_path", "left")
    there = F.col("there")
    return joined.withColumns(
        {
            "changed_since_snapshot": there & ~F.col("digest").eqNullSafe(F.col("before")),
            "differs_from_hash": there & ~F.col("digest").eqNullSafe(F.col("file_hash")),
            "object_gone": ~there,
        }
    )


def snapshot_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Keys added, removed or changed between two snapshots."""
    old = before.select("file_path", F.col("file_hash").alias("before"))
    new = after.select("file_path", F.col("file_hash").alias("after"))
    change = (
        F.when(F.col("before").isNull(), "added")
        .when(F.col("after").isNull(), "removed")
        .otherwise("changed")
    )
    both = old.join(new, "file_path", "full_outer")
    return both.where(~F.col("before").eqNullSafe(F.col("after"))).withColumn("change", change)


def transformed_checks(transformed: DataFrame, objects: DataFrame) -> DataFrame:
    """Transformed records with one flag per check."""
    document_type = F.coalesce(F.nullif("document_type", F.lit("")), F.lit(HTML))
    expected = transformed_key(F.col("identifier"), document_type)
    there = F.col("there")
    return with_digest(transformed, objects).withColumns(
        {
            "missing_object": ~there,
            "name_mismatch": ~F.col("file_path").eqNullSafe(expected),
            "hash_mismatch": there & ~F.col("digest").eqNullSafe(F.col("file_hash")),
        }
    )


def audit_transformed(
    transformed: DataFrame,
    transformed_objects: DataFrame,
    landing: DataFrame,
    landing_objects: DataFrame,
    snapshot: DataFrame,
) -> DataFrame:
    """Transformed report and its verdict; landing is checked for having stayed as it was.

    The two zones' counts are added up as rows of one table, so no one-row join is needed.
    """
    zone = _report(
        transformed_checks(transformed, transformed_objects),
        "transformed_documents",
        None,
        {
            "missing_object": "missing_transformed_objects",
            "name_mismatch": "identifier_ext_mismatches",
            "hash_mismatch": "transformed_hash_mismatches",
        },
    )
    source = _report(
        landing_changes(landing, landing_objects, snapshot),
        "landing_documents",
        None,
        {
            "changed_since_snapshot": "landing_changed_since_snapshot",
            "differs_from_hash": "landing_differs_from_hash",
            "object_gone": "landing_objects_gone",
        },
    )
    both = zone.unionByName(source, allowMissingColumns=True)
    report = both.agg(*[_sum(F.col(c)).alias(c) for c in both.columns])
    changed = F.col("landing_changed_since_snapshot") + F.col("landing_differs_from_hash")
    report = report.withColumn("landing_bytes_changed", changed)
    clean = ("transformed_documents", "landing_documents")
    problems = [F.col(c) for c in report.columns if c not in clean]
    uneven = F.col("transformed_documents") != F.col("landing_documents")
    return report.withColumn("bad", (F.greatest(*problems) > 0) | uneven)
