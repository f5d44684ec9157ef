"""Feed-capture text -> events, rejects and capture-order limit."""

from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from editflow.sources.feed_capture import capture_events, capture_rejects, data_payloads, land_capture, read_feed_capture
from editflow.sources.json_lines import read_edit_files
from tests.conftest import edit, write_lines


def _feed(events):
    lines = [":ok", ""]
    for e in events:
        lines += ["event: message", f'id: [{{"offset":{e["meta"]["offset"]}}}]', "data: " + json.dumps(e), ""]
    return lines


def test_data_lines_and_rejects(spark, workdir):
    lines = ["event: message", 'id: [{"topic":"x"}]', "data: " + json.dumps(edit("a")), "", "data: {bad"]  # 5.15
    write_lines(workdir, "capture.txt", lines)
    captured = read_feed_capture(spark, workdir)
    assert [r["id"] for r in capture_events(captured).collect()] == ["a"]
    assert [r["line"] for r in capture_rejects(captured).collect()] == ["data: {bad"]


def test_limit_follows_capture_order(spark, workdir):
    first = [edit(f"f{i}") for i in range(10)]
    second = [edit(f"s{i}") for i in range(10)]
    write_lines(workdir, "cap_1.txt", _feed(first[:3]) + ["data: not json"] + _feed(first[3:]))
    write_lines(workdir, "cap_2.txt", _feed(second))
    events = capture_events(read_feed_capture(spark, workdir), limit=15)
    assert sorted(r["id"] for r in events.collect()) == sorted([e["id"] for e in first] + [f"s{i}" for i in range(5)])


def test_land_capture_writes_landing_files(spark, workdir):
    write_lines(f"{workdir}/cap", "cap_1.txt", _feed([edit("a"), dict(edit("b"), extra_field=1)]) + ["data: {bad"])
    written = land_capture(spark, f"{workdir}/cap", f"{workdir}/landing", f"{workdir}/quarantine", stamp="20240101_000000")
    assert written and all("wiki_edits_20240101_000000_" in p for p in written)
    assert sorted(r["id"] for r in read_edit_files(spark, f"{workdir}/landing").collect()) == ["a", "b"]
    assert spark.read.parquet(f"{workdir}/quarantine").count() == 1


def test_capture_stamp_format():
    from datetime import datetime, timezone

    from editflow.sources.json_lines import LANDING_GLOB, capture_stamp

    stamp = capture_stamp(datetime(2024, 3, 5, 7, 8, 9, tzinfo=timezone.utc))
    assert stamp == "20240305_070809"
    import fnmatch

    assert fnmatch.fnmatch(f"wiki_edits_{stamp}.json", LANDING_GLOB)


def test_capture_command_line(spark, workdir, capsys):
    from editflow.__main__ import main

    write_lines(f"{workdir}/cap", "cap_1.txt", _feed([edit("a"), edit("b"), edit("c")]) + ["data: {bad"])
    args = ["capture", "--capture", f"{workdir}/cap", "--landing", f"{workdir}/landing",
            "--quarantine", f"{workdir}/q", "--limit", "2"]
    assert main(args) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["files"] >= 1
    assert sorted(r["id"] for r in read_edit_files(spark, f"{workdir}/landing").collect()) == ["a", "b"]
    assert spark.read.parquet(f"{workdir}/q").count() == 1


def test_capture_order_across_splits_of_one_file(spark, workdir):
    """One large capture file read as many splits: the first N events are still the first N lines."""
    events = [edit(f"e{i:04d}", ts=1704067200000 + i) for i in range(400)]
    write_lines(workdir, "cap_big.txt", _feed(events))
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = read_feed_capture(spark, workdir)
        assert lines.rdd.getNumPartitions() > 10  # the file really is split
        first = capture_events(lines, limit=37)
        assert sorted(r["id"] for r in first.collect()) == [f"e{i:04d}" for i in range(37)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)


def test_what_json_loads_accepts_is_valid(spark, workdir):
    lines = ['data: {"id":"a","id":"b"}', 'data: {"id": 7, "timestamp": "x"}', "data: {bad", 'data: {"id":"c"']
    write_lines(f"{workdir}/cap", "cap_1.txt", lines)
    capture = read_feed_capture(spark, f"{workdir}/cap")
    assert capture_events(capture).count() == 2
    assert sorted(r["line"] for r in capture_rejects(capture).collect()) == ['data: {"id":"c"', "data: {bad"]


_JSON = st.recursive(
    st.none() | st.booleans() | st.integers(-(10**12), 10**12) | st.floats() | st.text(max_size=6),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.sampled_from(["id", "user", "meta", "revision", "_end", "x"]), inner, max_size=3),
    max_leaves=6,
)
_EDITS = st.lists(
    st.tuples(st.integers(0, 40), st.sampled_from(list("[]{},:\"'\\ \t\x01+-.0eN") + ["INF", "NaN", "Infinity", "null", "],[", "},{", " //", '"id":'])), max_size=2
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_JSON, _EDITS), min_size=40, max_size=40))
def test_valid_is_what_a_strict_parser_says(spark, samples):
    """JSON values, and such values with characters put in, against the standard parser."""
    texts = []
    for value, edits in samples:
        text = json.dumps(value, ensure_ascii=len(edits) > 1)
        for at, piece in edits:
            text = text[:at] + piece + text[at:]
        if "\n" not in text and "\r" not in text and not any("\ud800" <= c <= "\udfff" for c in text):
            texts.append(text)
    expected = []
    for text in texts:
        try:
            json.loads(text)
            expected.append(True)
        except ValueError:
            expected.append(False)
    lines = spark.createDataFrame([(f"data: {t}",) for t in texts], "value string").coalesce(1)
    found = {r["payload"]: r["valid"] for r in data_payloads(lines).collect()}
    assert {t: found[t] for t in texts} == dict(zip(texts, expected))


def test_text_behind_or_around_a_value_is_set_aside(spark, workdir):
    bad = ['{"id":"a"} trailing', "{'id':'a'}", '{"id":"a"}{"id":"b"}', '{"id":"a\tb"}', '{"id":"a"}],[{"id":"b"}', '{"id":"a"},{"id":"b"}', "", "nul"]
    good = ['{"id":"a","id":"b"}', '{"x":NaN}', " 5 ", "null", '[{"id":"a"}]', '{"revision":5,"id":"c"}', '{"_end":"x","id":"d"}']
    write_lines(f"{workdir}/cap", "c.txt", [f"data: {p}" for p in bad + good])
    lines = read_feed_capture(spark, f"{workdir}/cap")
    assert sorted(r["line"] for r in capture_rejects(lines).collect()) == sorted(f"data: {p}" for p in bad)
    assert sorted(r["id"] for r in capture_events(lines).collect() if r["id"]) == ["b", "c", "d"]
