"""Gold profiles: thresholds are strict, NULL falls to the last class."""

from __future__ import annotations

from editflow.operators.activity import hourly_activity
from editflow.operators.profiles import class_mix, editor_profile, page_profile

EDITORS = (
    "editor string, wiki_language string, total_edits bigint, pages_edited bigint, avg_length_change double, "
    "last_edit_time string, first_edit_time string, edit_frequency double"
)
PAGES = "page_title string, edit_count bigint, unique_editors bigint"


def test_editor_profile_edges(spark):
    data = [
        ("one", "w", 1, 1, 100.0, "2024-01-01 10:00:00", "2024-01-01 10:00:00", 1.0),  # 5.8 span 0
        ("none", "w", 3, 1, None, "2024-01-02 00:00:01", "2024-01-01 23:59:59", 3.0),  # 5.9 / 5.10
        ("heavy", "w", 10, 2, 100.5, "2024-01-06 00:00:00", "2024-01-01 00:00:00", 5.0),
        ("zero", "w", 4, 2, 0.0, "2024-01-03 00:00:00", "2024-01-01 00:00:00", 2.0),
        ("small", "w", 4, 2, 0.001, "2024-01-03 00:00:00", "2024-01-01 00:00:00", 2.0),
    ]
    rows = {r["editor"]: r for r in editor_profile(spark.createDataFrame(data, EDITORS)).collect()}
    assert rows["one"]["activity_span_days"] == 0 and rows["one"]["edits_per_day"] == 1.0
    assert rows["one"]["editor_type"] == "Regular Editor"  # 100 is not > 100
    assert rows["none"]["activity_span_days"] == 1 and rows["none"]["editor_type"] == "Minor Editor"
    assert rows["none"]["edits_per_day"] == 3.0
    assert rows["heavy"]["editor_type"] == "Heavy Editor" and rows["heavy"]["edits_per_day"] == 2.0
    assert rows["zero"]["editor_type"] == "Minor Editor" and rows["small"]["editor_type"] == "Regular Editor"
    schema = dict((f.name, f.dataType.simpleString()) for f in editor_profile(spark.createDataFrame(data, EDITORS)).schema)
    assert schema["activity_span_days"] == "int" and schema["edits_per_day"] == "double"


def test_page_profile_thresholds(spark):
    data = [("a", 100, 10), ("b", 101, 11), ("c", 1000, 50), ("d", 1001, 51)]  # 5.11
    rows = {r["page_title"]: (r["edit_intensity"], r["editor_diversity"])
            for r in page_profile(spark.createDataFrame(data, PAGES)).collect()}
    assert rows == {"a": ("Low", "Low"), "b": ("Medium", "Medium"), "c": ("Medium", "Medium"), "d": ("High", "High")}
    mix = {r["edit_intensity"]: r["n_rows"] for r in class_mix(page_profile(spark.createDataFrame(data, PAGES)), "edit_intensity").collect()}
    assert mix == {"Low": 1, "Medium": 2, "High": 1}


def test_hourly_activity_groups(spark):
    data = [
        ("U1", "enwiki", "P1", 5, "2024-01-01 10:15:00", False),
        ("U1", "enwiki", "P2", None, "2024-01-01 10:59:59", False),
        ("U2", "enwiki", "P1", 1, "2024-01-01 10:00:00", False),
        ("U2", None, "P1", 1, "2024-01-01 10:00:00", None),
        ("U3", "enwiki", "P1", 1, "2024-01-01 11:00:00", False),
    ]
    clean = spark.createDataFrame(data, "editor string, wiki_language string, page_title string, length_change int, event_timestamp string, is_bot_edit boolean")
    rows = {(str(r["hour"]), r["wiki_language"], r["is_bot_edit"]): r for r in hourly_activity(clean).collect()}
    first = rows[("2024-01-01 10:00:00", "enwiki", False)]
    assert (first["edit_count"], first["unique_editors"], first["unique_pages"], first["avg_length_change"]) == (3, 2, 2, 3.0)
    assert ("2024-01-01 10:00:00", None, None) in rows and len(rows) == 3


def test_hourly_activity_sorted_order(spark):
    from editflow.operators.activity import hourly_activity_sorted

    data = [
        ("U1", "enwiki", "P1", 1, "2024-01-01 11:00:00", True),
        ("U1", None, "P1", 1, "2024-01-01 10:30:00", False),
        ("U2", "dewiki", "P1", 1, "2024-01-01 10:00:00", None),
        ("U2", "dewiki", "P2", 1, "2024-01-01 10:10:00", True),
        ("U3", "enwiki", "P3", 1, "2024-01-01 10:20:00", False),
    ]
    clean = spark.createDataFrame(data, "editor string, wiki_language string, page_title string, length_change int, event_timestamp string, is_bot_edit boolean")
    keys = [(str(r["hour"]), r["wiki_language"], r["is_bot_edit"]) for r in hourly_activity_sorted(clean).collect()]
    assert keys == [
        ("2024-01-01 10:00:00", None, False),
        ("2024-01-01 10:00:00", "dewiki", None),
        ("2024-01-01 10:00:00", "dewiki", True),
        ("2024-01-01 10:00:00", "enwiki", False),
        ("2024-01-01 11:00:00", "enwiki", True),
    ]
