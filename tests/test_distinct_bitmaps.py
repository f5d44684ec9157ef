"""Bitmaps of hours give the exact distinct counts of hours and of days."""

from pyspark.sql import functions as F

from editflow.operators.activity import hourly_activity
from editflow.operators.distinct_bitmaps import hourly_bitmaps, merged_counts, value_ids

SCHEMA = "editor string, wiki_language string, page_title string, length_change int, event_timestamp string, is_bot_edit boolean"


def _clean(spark):
    # a hot hour, values that come back in other hours, null values and null groups
    rows = [(f"U{i % 97}", "enwiki", f"P{i % 41}", 1, f"2024-01-01 {10 if i % 3 else i % 24:02d}:05:00", False) for i in range(3000)]
    rows += [("U1", None, "P1", 1, "2024-01-01 23:59:59", None), ("U1", None, "P2", 1, "2024-01-02 00:00:00", None)]
    rows += [(None, "dewiki", None, 1, "2024-01-02 01:00:00", True), (None, "enwiki", "P1", 1, "2024-01-01 10:00:00", False)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def _stored(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_merged_counts_are_exact(spark, tmp_path):
    clean = _clean(spark)
    for column, name in (("editor", "unique_editors"), ("page_title", "unique_pages")):
        ids = _stored(spark, value_ids(clean, column), tmp_path / f"ids_{column}")
        assert ids.select("value_id").distinct().count() == ids.count() == clean.select(column).where(f"{column} is not null").distinct().count()
        bitmaps = _stored(spark, hourly_bitmaps(clean, column, ids), tmp_path / f"bitmaps_{column}")
        hours = {(r["hour"], r["wiki_language"], r["is_bot_edit"]): r[name] for r in merged_counts(bitmaps, name, "hour").collect()}
        wanted = hourly_activity(clean).where(F.col(name) > 0).collect()
        assert hours == {(r["hour"], r["wiki_language"], r["is_bot_edit"]): r[name] for r in wanted}
        day = F.date_trunc("day", F.col("event_timestamp").cast("timestamp")).alias("day")
        direct = clean.groupBy(day, "wiki_language", "is_bot_edit").agg(F.count_distinct(column).alias(name)).where(F.col(name) > 0)
        got = merged_counts(bitmaps, name)
        assert sorted(map(str, got.collect())) == sorted(map(str, direct.collect()))


def test_an_empty_table_has_no_bitmaps(spark, tmp_path):
    none = _clean(spark).limit(0)
    ids = _stored(spark, value_ids(none, "editor"), tmp_path / "ids")
    assert merged_counts(hourly_bitmaps(none, "editor", ids), "unique_editors").count() == 0
