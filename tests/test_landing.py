"""Landing reader contract (batch and stream): schema, glob, malformed input, rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from editflow.operators.rules import LANDING_RULES, apply_rules
from editflow.sources.json_lines import read_edit_files, write_json_lines
from editflow.sources.schema import FLAT_EVENT_COLUMNS, edit_event_schema, flatten_events
from editflow.streaming.landing import land_edits, read_landed, read_landing_metrics
from tests.conftest import edit, write_lines


def _landed(spark, path, **kw):
    return apply_rules(read_edit_files(spark, path, **kw), LANDING_RULES)


def test_schema_is_explicit_and_nullable():
    schema = edit_event_schema()
    assert [f.name for f in schema.fields][:4] == ["id", "type", "namespace", "title"]
    assert all(f.nullable for f in schema.fields)
    assert schema["revision"].dataType["old"].dataType.simpleString() == "int"
    assert edit_event_schema(wide_ids=True)["revision"].dataType["old"].dataType.simpleString() == "bigint"
    assert len(FLAT_EVENT_COLUMNS) == 29


def test_malformed_and_partial_lines(spark, workdir):
    write_lines(
        workdir,
        "wiki_edits_20240101_000000.json",
        [
            edit("a"),
            "{bad json",  # 5.1 malformed -> all NULL -> dropped by valid_id
            edit("b", ts="not a number"),  # 5.2 string timestamp -> NULL -> dropped
            edit("c", ts=1.5),  # 5.2 fractional -> NULL -> dropped
            dict(edit("d"), id=42),  # 5.3 numeric id read as text
            {k: v for k, v in edit("e").items() if k != "id"},  # 5.4 no id -> dropped
            dict(edit("f"), unknown_field=1),  # 5.6 ignored
        ],
    )
    raw = read_edit_files(spark, workdir)
    assert raw.count() == 7
    rows = {r["id"] for r in _landed(spark, workdir).collect()}
    assert rows == {"a", "42", "f"}


def test_foreign_file_is_not_read(spark, workdir):
    write_lines(workdir, "wiki_edits_20240101_000000.json", [edit("a")])
    write_lines(workdir, "other.json", [edit("zzz")])  # 5.7
    assert [r["id"] for r in read_edit_files(spark, workdir).collect()] == ["a"]


def test_revision_overflow_and_wide_ids(spark, workdir):
    write_lines(workdir, "wiki_edits_1.json", [dict(edit("a"), revision={"old": 2300000000, "new": 2300000001})])
    narrow = read_edit_files(spark, workdir).select("id", "revision.old", "revision.new").collect()
    assert narrow[0]["id"] == "a" and narrow[0]["old"] is None and narrow[0]["new"] is None  # 5.5
    wide = read_edit_files(spark, workdir, wide_ids=True).select("revision.old").collect()
    assert wide[0]["old"] == 2300000000


def test_empty_directory_has_full_schema(spark, workdir):
    df = read_edit_files(spark, workdir)  # 5.12
    assert df.count() == 0 and df.schema == edit_event_schema()


def test_writer_roundtrip_and_naming(spark, workdir):
    rows = [edit(str(i), ts=1704067200000 + i) for i in range(20)]
    src = spark.read.schema(edit_event_schema()).json(
        spark.sparkContext.parallelize([__import__("json").dumps(r) for r in rows])
    )
    written = write_json_lines(src.repartition(3), workdir, stamp="20240101_120000")
    assert written and all("/wiki_edits_20240101_120000_" in p and p.endswith(".json") for p in written)
    back = flatten_events(read_edit_files(spark, workdir))
    assert sorted(back.collect()) == sorted(flatten_events(src).collect())


def test_stream_equals_batch_and_is_incremental(spark, workdir):
    source, target, ckpt = f"{workdir}/in", f"{workdir}/raw", f"{workdir}/ckpt"
    write_lines(source, "wiki_edits_1.json", [edit("a"), edit(None), edit("b", ts=None)])
    write_lines(source, "other.json", [edit("x")])
    run1 = land_edits(spark, source, target, ckpt)
    assert sorted(r["id"] for r in read_landed(spark, target).collect()) == ["a"]
    assert read_landed(spark, target).schema == edit_event_schema()
    # a second run with the same checkpoint adds nothing
    land_edits(spark, source, target, ckpt)
    assert read_landed(spark, target).count() == 1
    # a new file adds only its rows
    write_lines(source, "wiki_edits_2.json", [edit("c"), edit("d")])
    run3 = land_edits(spark, source, target, ckpt)
    assert sorted(r["id"] for r in read_landed(spark, target).collect()) == ["a", "c", "d"]
    metrics = read_landing_metrics(spark, run1.metrics_dir)
    per_rule = {r["rule"]: (r["n_rows"], r["n_failed"]) for r in metrics.groupBy("rule").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_failed").alias("n_failed")).collect()}
    assert per_rule == {"valid_id": (5, 1), "valid_timestamp": (5, 1)}
    assert run3.batches and run1.batches and run3.batches[0] > run1.batches[-1]


def test_stream_on_empty_directory(spark, workdir):
    import os

    os.makedirs(f"{workdir}/in")
    run = land_edits(spark, f"{workdir}/in", f"{workdir}/raw", f"{workdir}/ckpt")
    assert run.batches == [] or read_landed(spark, f"{workdir}/raw").count() == 0
    assert read_landed(spark, f"{workdir}/raw").count() == 0


def test_bounded_batches_and_archive(spark, workdir):
    import os

    source, target = f"{workdir}/in", f"{workdir}/raw"
    for i in range(3):
        write_lines(source, f"wiki_edits_{i}.json", [edit(f"{i}a"), edit(f"{i}b")])
    run = land_edits(
        spark, source, target, f"{workdir}/ckpt", max_files_per_trigger=1, archive_dir=f"{workdir}/archive"
    )
    assert len(run.batches) == 3
    assert read_landed(spark, target).count() == 6
    # files of committed batches are moved out of the source folder by Spark's
    # (asynchronous) source cleaner
    import time

    deadline = time.time() + 20
    while True:
        archived = [f for _, _, fs in os.walk(f"{workdir}/archive") for f in fs if f.endswith(".json")]
        if len(archived) >= 2 or time.time() > deadline:
            break
        time.sleep(0.5)
    assert len(archived) >= 2


def test_replayed_batch_leaves_no_duplicates(spark, workdir):
    """A batch written but not committed (driver lost) is replayed into the same folder."""
    import os

    source, target, ckpt = f"{workdir}/in", f"{workdir}/raw", f"{workdir}/ckpt"
    write_lines(source, "wiki_edits_1.json", [edit("a"), edit("b")])
    write_lines(source, "wiki_edits_2.json", [edit("c")])
    first = land_edits(spark, source, target, ckpt)
    assert read_landed(spark, target).count() == 3
    last = max(first.batches)
    # the commit of the last batch never happened (with its local checksum file)
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{ckpt}/commits/{name}"):
            os.remove(f"{ckpt}/commits/{name}")
    replay = land_edits(spark, source, target, ckpt)
    assert replay.batches == [last]
    assert sorted(r["id"] for r in read_landed(spark, target).collect()) == ["a", "b", "c"]


def test_old_files_that_arrive_late_are_landed(spark, workdir):
    import os
    import time

    source, target, ckpt = f"{workdir}/in", f"{workdir}/raw", f"{workdir}/ckpt"
    write_lines(source, "wiki_edits_1.json", [edit("new")])
    land_edits(spark, source, target, ckpt)
    for days in (3, 30, 700):
        path = write_lines(source, f"wiki_edits_late{days}.json", [edit(f"late{days}")])
        os.utime(path, (time.time() - days * 86400,) * 2)
    land_edits(spark, source, target, ckpt)
    assert {r["id"] for r in read_landed(spark, target).collect()} == {"new", "late3", "late30", "late700"}


def test_publishing_again_adds_no_rows(spark, workdir, monkeypatch):
    from editflow.sources import files

    source, target, ckpt = f"{workdir}/in", f"{workdir}/raw", f"{workdir}/ckpt"
    rows = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string").repartition(3)
    real = files.rename
    monkeypatch.setattr(files, "rename", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    try:
        write_json_lines(rows, source, stamp="20240101_000000", run_id="r1")
    except OSError:
        pass
    assert read_edit_files(spark, source).count() == 0  # nothing half-written is visible
    monkeypatch.setattr(files, "rename", real)
    for _ in range(2):
        write_json_lines(rows, source, stamp="20240101_000000", run_id="r1")
    assert read_edit_files(spark, source).count() == 4
    land_edits(spark, source, target, ckpt, rules=False)
    # another batch of the same second
    write_json_lines(rows, source, stamp="20240101_000000")
    land_edits(spark, source, target, ckpt, rules=False)
    assert read_landed(spark, target).count() == 8


def test_a_publication_cut_after_half_of_its_files(spark, workdir, monkeypatch):
    """The retry names the rest of the decided files: all rows once, whatever the retry would compute."""
    from editflow.sources import files

    source, target, ckpt = f"{workdir}/in", f"{workdir}/raw", f"{workdir}/ckpt"
    rows = spark.createDataFrame([(c,) for c in "abcdefgh"], "id string").repartition(4)
    real, done = files.replace, []

    def cut(spark, part, name):
        if len(done) == 2:
            raise OSError("lost")
        done.append(name)
        real(spark, part, name)

    monkeypatch.setattr(files, "replace", cut)
    with pytest.raises(OSError):
        write_json_lines(rows, source, stamp="20240101_000000", run_id="r1")
    land_edits(spark, source, target, ckpt, rules=False)
    early = {r["id"] for r in read_landed(spark, target).collect()}
    assert 0 < len(early) < 8
    monkeypatch.setattr(files, "replace", real)
    other = spark.createDataFrame([("never written",)], "id string")
    written = [write_json_lines(other, source, stamp="20240101_000000", run_id="r1") for _ in range(2)]
    assert written[0] == written[1] and len(written[0]) == 4
    land_edits(spark, source, target, ckpt, rules=False)
    assert sorted(r["id"] for r in read_landed(spark, target).collect()) == list("abcdefgh")
    assert not files.list_names(spark, source, "_staging")


def test_a_publication_copied_but_not_removed(spark, workdir, monkeypatch):
    """A store that renames by copying may leave the staged file beside its copy: it is copied again, not added."""
    from editflow.sources import files

    rows = spark.createDataFrame([("a",), ("b",)], "id string").repartition(2)
    real = files.rename

    def copies(spark, source, target):
        if target.endswith(".json"):
            files.write_text(spark, target, files.read_text(spark, source)[:5])  # cut within the copy
            raise OSError("lost")
        real(spark, source, target)

    monkeypatch.setattr(files, "rename", copies)
    with pytest.raises(OSError):
        write_json_lines(rows, workdir, stamp="20240101_000000", run_id="r1")
    monkeypatch.setattr(files, "rename", real)
    write_json_lines(rows, workdir, stamp="20240101_000000", run_id="r1")
    assert sorted(r["id"] for r in read_edit_files(spark, workdir).collect()) == ["a", "b"]
