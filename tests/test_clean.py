"""Cleaning projection: names, order, time text, size delta."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from editflow.functions.time import epoch_to_text, earliest_text, latest_text
from editflow.operators.clean import CLEAN_COLUMNS, clean_edits
from editflow.sources.json_lines import read_edit_files
from tests.conftest import edit, write_lines


def test_columns_and_types(spark, workdir):
    write_lines(workdir, "wiki_edits_1.json", [edit("a")])
    clean = clean_edits(read_edit_files(spark, workdir))
    assert tuple(clean.columns) == CLEAN_COLUMNS
    types = dict((f.name, f.dataType.simpleString()) for f in clean.schema)
    assert types["event_timestamp"] == "string" and types["length_change"] == "int"
    assert types["meta_offset"] == "bigint" and types["is_bot_edit"] == "boolean"
    row = clean.collect()[0]
    assert row["event_timestamp"] == "2024-01-01 00:00:07"  # sub-second part truncated
    assert row["length_change"] == 10 and row["wiki_language"] == "enwiki" and row["wiki_domain"] == "enwiki.example.org"


def test_epoch_text_truncates_toward_zero(spark):
    df = spark.createDataFrame([(1704067207999,), (-1500,), (None,)], "t long")
    out = [r[0] for r in df.select(epoch_to_text("t")).collect()]
    assert out == ["2024-01-01 00:00:07", "1969-12-31 23:59:59", None]


def test_seconds_unit(spark, workdir):
    write_lines(workdir, "wiki_edits_1.json", [edit("a", ts=1704067207)])
    raw = read_edit_files(spark, workdir)
    assert clean_edits(raw, time_unit="s").collect()[0]["event_timestamp"] == "2024-01-01 00:00:07"  # 5.13
    assert clean_edits(raw).collect()[0]["event_timestamp"].startswith("1970-01-20")
    with pytest.raises(ValueError):
        clean_edits(raw, time_unit="us")


def test_length_overflow_and_missing(spark, workdir):
    write_lines(
        workdir,
        "wiki_edits_1.json",
        [edit("a", old=-2147483648, new=2147483647), edit("b", old=None, new=None)],
    )
    rows = {r["id"]: r["length_change"] for r in clean_edits(read_edit_files(spark, workdir)).collect()}
    assert rows == {"a": None, "b": None}


def test_time_bounds_equal_text_order(spark):
    texts = ["2024-01-02 00:00:00", "2023-12-31 23:59:59", None, "2024-01-01 12:00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    row = df.agg(latest_text("t").alias("hi"), earliest_text("t").alias("lo"), F.max("t"), F.min("t")).collect()[0]
    assert row["hi"] == row["max(t)"] and row["lo"] == row["min(t)"]
