"""Explicit landing schema of one edit event (never inferred).

An explicit schema lets an empty landing folder still yield a typed table
and keeps the JSON reader from sampling files.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


def edit_event_schema(wide_ids: bool = False) -> StructType:
    """Schema of a landed edit event; every field is nullable.

    ``wide_ids=True`` reads ``revision.old/new`` as bigint so revision ids
    beyond the int range survive instead of becoming NULL.
    """
    revision_type = LongType() if wide_ids else IntegerType()
    return _struct(
        ("id", StringType()),
        ("type", StringType()),
        ("namespace", IntegerType()),
        ("title", StringType()),
        ("title_url", StringType()),
        ("comment", StringType()),
        ("timestamp", LongType()),
        ("user", StringType()),
        ("bot", BooleanType()),
        ("minor", BooleanType()),
        ("patrolled", BooleanType()),
        ("length", _struct(("old", IntegerType()), ("new", IntegerType()))),
        ("revision", _struct(("old", revision_type), ("new", revision_type))),
        ("server_url", StringType()),
        ("server_name", StringType()),
        ("server_script_path", StringType()),
        ("wiki", StringType()),
        ("parsedcomment", StringType()),
        (
            "meta",
            _struct(
                ("uri", StringType()),
                ("request_id", StringType()),
                ("id", StringType()),
                ("dt", StringType()),
                ("domain", StringType()),
                ("stream", StringType()),
                ("topic", StringType()),
                ("partition", IntegerType()),
                ("offset", LongType()),
            ),
        ),
    )


# Flat view of a landed event: every scalar leaf as a top-level column.
FLAT_EVENT_COLUMNS = (
    ("id", "id"),
    ("type", "type"),
    ("namespace", "namespace"),
    ("title", "title"),
    ("title_url", "title_url"),
    ("comment", "comment"),
    ("timestamp", "timestamp"),
    ("user", "user"),
    ("bot", "bot"),
    ("minor", "minor"),
    ("patrolled", "patrolled"),
    ("length_old", "length.old"),
    ("length_new", "length.new"),
    ("revision_old", "revision.old"),
    ("revision_new", "revision.new"),
    ("server_url", "server_url"),
    ("server_name", "server_name"),
    ("server_script_path", "server_script_path"),
    ("wiki", "wiki"),
    ("parsedcomment", "parsedcomment"),
    ("meta_uri", "meta.uri"),
    ("meta_request_id", "meta.request_id"),
    ("meta_id", "meta.id"),
    ("meta_dt", "meta.dt"),
    ("meta_domain", "meta.domain"),
    ("meta_stream", "meta.stream"),
    ("meta_topic", "meta.topic"),
    ("meta_partition", "meta.partition"),
    ("meta_offset", "meta.offset"),
)


def flatten_events(df):
    """Project a landed-event DataFrame onto its scalar leaves."""
    from pyspark.sql import functions as F

    return df.select([F.col(path).alias(name) for name, path in FLAT_EVENT_COLUMNS])
