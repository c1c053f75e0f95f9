"""Landing to the transformed zone: clean html, pass binaries through, rename, rehash."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.functions.content import content_type_of, effective_document_type, file_hash
from doclake.functions.pages import clean_page
from doclake.functions.text import blank, transformed_key
from doclake.functions.windows import check_range
from doclake.operators.identity import merge
from doclake.profile import DEFAULT_PROFILE, SourceProfile
from doclake.schema import EMPTY_IDENTIFIER, HTML, INCOMPLETE_RECORD, NO_CONTENT, TRANSFORMED_SCHEMA
from doclake.session import bound_batches
from doclake.sources.index import LANDING_OBJECT, TRANSFORMED_IDENTITY
from doclake.sources.landing import scan_range
from doclake.sources.objects import ORDER, current_versions
from doclake.sources.store import Run, Store


def locate(landing: DataFrame, objects: DataFrame) -> DataFrame:
    """Landing rows with the order value of their current object, and a failure when there is none."""
    return _with_failures(landing.join(current_versions(objects), "file_path", "left"))


def locate_indexed(landing: DataFrame, pointers: DataFrame) -> DataFrame:
    """The same from the index of keys: the current object, whichever record or partition wrote it."""
    order = F.struct(F.col("object_run").alias("run"), "fetch_seq")
    known = pointers.select("file_path", order.alias(ORDER), "object_folder", "object_partition")
    return _with_failures(landing.join(known, "file_path", "left"))


def _with_failures(located: DataFrame) -> DataFrame:
    incomplete = blank(F.col("identifier")) | blank(F.col("body")) | blank(F.col("file_path"))
    gone = F.col(ORDER).isNull()
    return located.withColumns(
        {
            "error_code": F.when(incomplete, "ValueError").when(gone, "NoSuchKey"),
            "reason": F.when(incomplete, INCOMPLETE_RECORD).when(
                gone, F.concat(F.lit("no object under "), F.col("file_path"))
            ),
        }
    )


def convert(rows: DataFrame, as_of: str, profile: SourceProfile = DEFAULT_PROFILE) -> DataFrame:
    """Rows with ``content`` to transformed rows; only html content is handed to Python."""
    bound_batches(rows.sparkSession)
    is_html = F.col("document_type") == HTML
    typed = rows.withColumn(
        "document_type", effective_document_type(F.col("document_type"), F.col("content"))
    )
    paged = typed.withColumn("page", clean_page(F.when(is_html, F.col("content")), profile))
    key = transformed_key(F.col("identifier"), F.col("document_type"))
    output = F.when(is_html, F.col("page.clean")).otherwise(F.col("content"))
    made = paged.withColumn("_key", key).withColumns(
        {
            "content": output,
            "error_code": F.coalesce(
                F.when(F.col("content").isNull(), "NoContent"),
                F.col("page.error_code"),
                F.when(F.col("_key").isNull(), "ValueError"),
            ),
            "reason": F.coalesce(
                F.when(F.col("content").isNull(), NO_CONTENT),
                F.col("page.reason"),
                F.when(
                    F.col("_key").isNull(),
                    F.concat(F.lit(f"{EMPTY_IDENTIFIER}'"), "identifier", F.lit("'")),
                ),
            ),
            "source_file_path": F.col("file_path"),
        }
    )
    return made.withColumns(
        {
            "file_path": F.col("_key"),
            "file_hash": file_hash(F.col("content")),
            "content_type": content_type_of(F.col("document_type")),
            "unchanged_content": ~is_html,
            "transformed_at": F.lit(as_of),
        }
    ).drop("page", "_key")


def transform(
    landing: DataFrame,
    objects: DataFrame,
    as_of: str,
    profile: SourceProfile = DEFAULT_PROFILE,
) -> DataFrame:
    """One row per landing row: the transformed record with its ``content``, or a failure.

    ``objects`` is a version table (file_path, content, write_order).
    """
    return transform_located(locate(landing, objects), objects, as_of, profile)


def transform_located(
    located: DataFrame,
    objects: DataFrame,
    as_of: str,
    profile: SourceProfile = DEFAULT_PROFILE,
) -> DataFrame:
    """The part that touches content: one inner join on a unique key, then the conversion.

    ``located`` has no content, so for a range of ordinary size it is the side to broadcast; beyond,
    it is moved to the buckets of the content. The content is not shuffled either way. The version is
    compared by order, not equality: the join's only key is the one the content is bucketed by.
    """
    found = located.where("error_code is null").drop("error_code", "reason")
    found = found.withColumnsRenamed({"file_path": "_path", ORDER: "_order"})
    content = objects.select("file_path", ORDER, "content")
    same = (F.col(ORDER) <= F.col("_order")) & (F.col(ORDER) >= F.col("_order"))
    rows = content.join(found, (F.col("file_path") == F.col("_path")) & same).drop(ORDER, "_order", "_path")
    lost = located.where("error_code is not null").drop(ORDER)
    return convert(rows, as_of, profile).unionByName(lost, allowMissingColumns=True)


def transformed_after(stored: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The transformed table after a run, plus ``action``; failed rows leave it untouched."""
    names = [f.name for f in TRANSFORMED_SCHEMA.fields]
    good = outcomes.where("error_code is null").select(*names)
    return merge(stored, good)


def key_collisions(transformed: DataFrame) -> DataFrame:
    """Object keys that records of several bodies share, and whose object is the one that stays."""
    order = F.struct("partition_date", "identifier", "body")
    per_key = transformed.groupBy("file_path").agg(
        F.countDistinct("body").alias("bodies"),
        F.max_by(F.struct("body", "identifier", "file_hash"), order).alias("winner"),
    )
    return per_key.where("bodies > 1").select(
        "file_path",
        "bodies",
        F.col("winner.body").alias("winner_body"),
        F.col("winner.identifier").alias("winner_identifier"),
        F.col("winner.file_hash").alias("winner_hash"),
    )


def transform_events(outcomes: DataFrame) -> DataFrame:
    """Outcome per record for the scope counters; a record's scope is its partition date."""
    outcome = F.when(F.col("error_code").isNull(), "stored").otherwise("failed")
    return outcomes.select(
        "body", F.col("partition_date").alias("partition"), outcome.alias("outcome")
    )


def run_transform(
    store: Store,
    start: date | str,
    end: date | str,
    as_of: str,
    profile: SourceProfile = DEFAULT_PROFILE,
) -> DataFrame:
    """Transform a range and commit it; returns the outcomes (no content) as a written table.

    What is to be read is settled on slim rows and written first, so that its size is known when
    the content is joined. Everything made, content and failures, is written once; what follows
    reads slim columns of that.
    """
    check_range(start, end)

    def convert_range(run: Run) -> DataFrame:
        landing = scan_range(store.read("landing", start, end), start, end).drop("object_partition")
        located = run.stage("located", locate_indexed(landing, run.find(LANDING_OBJECT, landing)))
        # One row per run and date window that wrote an object of the range.
        places = located.where("error_code is null").select("object_folder", "object_partition").distinct().collect()
        objects = store.objects_at([tuple(p) for p in places], run.buckets)
        rows = transform_located(located.drop("object_folder", "object_partition"), objects, as_of, profile)
        outcomes = run.write_objects("transformed", rows).drop("content")
        good = outcomes.where("error_code is null")
        held = run.stage("held", run.find(TRANSFORMED_IDENTITY, good))
        run.merge("transformed", good, held, lambda stored: transformed_after(stored, outcomes).drop("action"))
        run.post(TRANSFORMED_IDENTITY, good)
        return outcomes

    return store.attempt(convert_range)
