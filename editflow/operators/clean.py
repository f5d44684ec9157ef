"""Landing rows -> the flat, typed ``edits_clean`` table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.functions.time import epoch_to_text

# Output columns of edits_clean, in table order.
CLEAN_COLUMNS = (
    "id", "type", "namespace", "page_title", "editor", "edit_comment",
    "event_timestamp", "is_bot_edit", "is_minor_edit", "old_length",
    "new_length", "length_change", "old_revision", "new_revision",
    "wiki_domain", "wiki_language", "parsed_comment", "meta_uri",
    "meta_request_id", "meta_domain", "meta_stream", "meta_topic",
    "meta_partition", "meta_offset",
)


def clean_edits(raw: DataFrame, time_unit: str = "ms", keep: Sequence[str] = ()) -> DataFrame:
    """Flatten, rename and type one landed event per row.

    One projection: Catalyst prunes every landed field (and nested field)
    that is not used, down to the scan.  ``length_change`` uses
    ``try_subtract`` so an int overflow gives NULL instead of failing the job.
    ``keep`` names input columns passed through after the table columns
    (e.g. the landing ``batch_id``).
    """
    return raw.select(
        F.col("id"),
        F.col("type"),
        F.col("namespace"),
        F.col("title").alias("page_title"),
        F.col("user").alias("editor"),
        F.col("comment").alias("edit_comment"),
        epoch_to_text("timestamp", time_unit).alias("event_timestamp"),
        F.col("bot").alias("is_bot_edit"),
        F.col("minor").alias("is_minor_edit"),
        F.col("length.old").alias("old_length"),
        F.col("length.new").alias("new_length"),
        F.try_subtract(F.col("length.new"), F.col("length.old")).alias("length_change"),
        F.col("revision.old").alias("old_revision"),
        F.col("revision.new").alias("new_revision"),
        F.col("server_name").alias("wiki_domain"),
        F.col("wiki").alias("wiki_language"),
        F.col("parsedcomment").alias("parsed_comment"),
        F.col("meta.uri").alias("meta_uri"),
        F.col("meta.request_id").alias("meta_request_id"),
        F.col("meta.domain").alias("meta_domain"),
        F.col("meta.stream").alias("meta_stream"),
        F.col("meta.topic").alias("meta_topic"),
        F.col("meta.partition").alias("meta_partition"),
        F.col("meta.offset").alias("meta_offset"),
        *[F.col(c) for c in keep],
    )


def clean_schema(spark, wide_ids: bool = False) -> "StructType":
    """Schema of ``edits_clean`` (derived from the landing schema, nothing hand-written)."""
    from editflow.sources.schema import edit_event_schema

    return clean_edits(spark.createDataFrame([], edit_event_schema(wide_ids))).schema
