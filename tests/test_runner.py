"""Layer runs: end to end, one layer at a time, suffix variant, catalog registration."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from editflow.plans.runner import read_stored, run_all_layers, run_layer, table_counts
from editflow.sources import builds, files
from editflow.sources import tables as T
from editflow.sources.events_adapter import raw_edits
from editflow.sources.json_lines import write_json_lines
from editflow.streaming.landing import read_landed
from tests.conftest import SF0001, edit, write_lines


def _contents(spark, base, name, suffix):
    df = T.read_table(spark, base, name, suffix)
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_end_to_end_and_layer_by_layer_agree(spark, workdir):
    source = f"{workdir}/incoming"
    write_json_lines(raw_edits(spark, SF0001), source)
    seq = run_all_layers(spark, source, f"{workdir}/seq", suffix="_seq")
    layered = None
    for layer in T.LAYERS:
        layered = run_layer(spark, layer, f"{workdir}/layered", source_dir=source, result=layered)
    assert set(seq.tables) == {spec.name for spec in T.TABLES}
    for spec in T.TABLES[1:]:
        assert _contents(spark, f"{workdir}/seq", spec.name, "_seq") == _contents(
            spark, f"{workdir}/layered", spec.name, ""
        ), spec.name
    counts = {r["table_name"]: r["n_rows"] for r in table_counts(spark, seq).collect()}
    assert counts["edits_raw"] == 981 and counts["edits_clean"] == 960 and counts["editor_ranking"] == 17
    report = {(r["table_name"], r["rule"]): (r["n_rows"], r["n_failed"]) for r in seq.rule_report(spark).collect()}
    assert report[("edits_raw", "valid_id")] == (1000, 10)
    assert report[("edits_raw", "valid_timestamp")] == (1000, 10)
    assert report[("editor_ranking", "valid_wiki_language")] == (19, 2)
    assert report[("editor_profile", "non_negative_activity_span")][1] == 0
    saved = spark.read.parquet(seq.save_rule_report(spark, run_id="r1"))
    assert saved.count() == 13 and "run_id" not in saved.columns


def test_rules_off_variant(spark, workdir):
    source = f"{workdir}/incoming"
    write_json_lines(raw_edits(spark, SF0001), source)
    result = run_all_layers(spark, source, f"{workdir}/t", rules=False)
    counts = {r["table_name"]: r["n_rows"] for r in table_counts(spark, result).collect()}
    assert counts["edits_raw"] == 1000 and counts["edits_clean"] == 1000 and counts["editor_ranking"] == 19
    assert result.rule_rows == []


def test_register_tables_with_comment(spark, workdir):
    df = spark.createDataFrame([(1,)], "x int")
    T.write_table(df, workdir, "page_profile", "_t", register=True)
    detail = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE TABLE EXTENDED gold.page_profile_t").collect()}
    assert detail.get("Comment") == T.TABLE_BY_NAME["page_profile"].comment


def test_command_line(spark, workdir, capsys):
    import json

    from editflow.__main__ import main

    source = f"{workdir}/incoming"
    write_json_lines(raw_edits(spark, SF0001), source)
    assert main(["run", "--source", source, "--base", f"{workdir}/t", "--suffix", "_cli"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(out["tables"]) == {spec.name for spec in T.TABLES} and len(out["rules"]) == 13
    assert main(["run", "--base", f"{workdir}/t", "--suffix", "_cli", "--layer", "gold", "--register", "--namespace", "one_cli"]) == 0
    assert spark.table("one_cli.page_profile_cli").count() == 100
    capsys.readouterr()
    assert main(["history", "--base", f"{workdir}/t", "--suffix", "_cli"]) == 0
    past = [json.loads(line) for line in capsys.readouterr().out.strip().splitlines()]
    assert len(past) == 15 and {(r["run"], r["n_failed"]) for r in past if r["table_name"] == "page_profile"} == {(1, 0), (2, 0)}


def test_layers_refuse_what_was_never_finished(spark, workdir):
    base = f"{workdir}/t"
    for layer in ("bronze", "silver", "gold"):
        with pytest.raises(builds.UnfinishedBuild):
            run_layer(spark, layer, base)
    # rows without a note, as a write that died leaves them, are no table either
    spark.createDataFrame([("a",)], "editor string").write.parquet(builds.folder(T.table_path(base, "edits_clean"), "x"))
    with pytest.raises(builds.UnfinishedBuild):
        run_layer(spark, "silver", base)


def test_an_empty_source_builds_empty_tables(spark, workdir):
    import os

    os.makedirs(f"{workdir}/in")
    result = run_all_layers(spark, f"{workdir}/in", f"{workdir}/t", register=True, suffix="_empty")
    assert {r["n_rows"] for r in table_counts(spark, result).collect()} == {0}


def test_gold_refuses_rankings_of_different_builds(spark, workdir, monkeypatch):
    source, base = f"{workdir}/in", f"{workdir}/t"
    write_lines(source, "wiki_edits_1.json", [edit("a"), edit("b", user="V")])
    run_all_layers(spark, source, base)
    write_lines(source, "wiki_edits_2.json", [edit("c")])
    for layer in ("landing", "bronze"):
        run_layer(spark, layer, base, source)
    real = T.write_table

    def dies(df, base_dir, name, *args, **kwargs):
        if name == "page_ranking":
            raise RuntimeError("driver lost")
        return real(df, base_dir, name, *args, **kwargs)

    monkeypatch.setattr(T, "write_table", dies)
    with pytest.raises(RuntimeError):
        run_layer(spark, "silver", base)
    monkeypatch.setattr(T, "write_table", real)
    with pytest.raises(builds.UnfinishedBuild, match="different builds"):
        run_layer(spark, "gold", base)
    for layer in ("silver", "gold"):
        run_layer(spark, layer, base)
    assert _contents(spark, base, "page_profile", "")[0][2] == 3


def _dying(monkeypatch, point, name):
    """Let the write of a table die: before its rows, in the middle of them, before its note or right after it."""
    from pyspark.sql import DataFrameWriter

    if point in ("before the rows", "inside the rows"):
        real = DataFrameWriter.save

        def save(self, path=None, *args, **kwargs):
            if f"/{name}" in path and "_builds" not in path:
                if point == "inside the rows":
                    self._df.limit(1).write.parquet(path)
                raise RuntimeError("driver lost")
            return real(self, path, *args, **kwargs)

        monkeypatch.setattr(DataFrameWriter, "save", save)
    else:
        real_publish = builds.publish

        def publish(spark, root, *args, **kwargs):
            if f"/{name}" in root:
                if point == "after the note":
                    real_publish(spark, root, *args, **kwargs)
                raise RuntimeError("driver lost")
            return real_publish(spark, root, *args, **kwargs)

        monkeypatch.setattr(builds, "publish", publish)


@pytest.mark.parametrize(
    ("table", "point"),
    [*((spec.name, "inside the rows") for spec in T.TABLES[1:]), *(("page_ranking", p) for p in ("before the rows", "before the note", "after the note"))],
)
def test_a_run_that_dies_at_a_table(spark, workdir, table, point):
    """Every table is as it was, or new and whole; the next run gives what a fresh one does."""
    source, base = f"{workdir}/incoming", f"{workdir}/t"
    write_lines(source, "wiki_edits_1.json", [edit(str(i), user=f"U{i % 3}", ts=1704067200000 + i * 7_000_000) for i in range(20)])
    run_all_layers(spark, source, base)
    before = {spec.name: _contents(spark, base, spec.name, "") for spec in T.TABLES[1:]}
    write_lines(source, "wiki_edits_2.json", [edit(f"n{i}", user=f"U{i % 2}") for i in range(10)])
    with pytest.MonkeyPatch.context() as patch:
        _dying(patch, point, table)
        with pytest.raises(RuntimeError):
            run_all_layers(spark, source, base)
    during = {spec.name: _contents(spark, base, spec.name, "") for spec in T.TABLES[1:]}
    run_all_layers(spark, source, base)
    fresh = f"{workdir}/fresh"
    run_all_layers(spark, source, fresh)
    for spec in T.TABLES[1:]:
        assert _contents(spark, base, spec.name, "") == _contents(spark, fresh, spec.name, ""), spec.name
        assert during[spec.name] in (before[spec.name], _contents(spark, fresh, spec.name, "")), spec.name
        # what the dead run left is gone, and one earlier build is kept
        root = T.table_path(base, spec.name)
        assert not builds.unfinished(spark, root) and len(files.list_names(spark, root, builds.FOLDER)) == 2
    assert during[table] == (_contents(spark, fresh, table, "") if point == "after the note" else before[table])
    # the counters of the dead run's finished tables are kept
    runs = {r["table_name"]: r["run"] for r in T.rule_history(spark, base).groupBy("table_name").agg(F.max("run").alias("run")).collect()}
    assert runs["edits_raw"] == 3 and runs[table] == (3 if point == "after the note" else 2)


@pytest.mark.parametrize("point", ["before landing", "inside landing", "before the note", "after the note"])
@pytest.mark.parametrize("again", ["ordinary run", "full refresh"])
def test_a_full_refresh_that_dies(spark, workdir, monkeypatch, point, again):
    from editflow.plans import runner

    source, base = f"{workdir}/in", f"{workdir}/t"
    write_lines(source, "wiki_edits_1.json", [edit(str(i)) for i in range(5)])
    run_layer(spark, "landing", base, source)
    write_lines(source, "wiki_edits_2.json", [edit(f"n{i}") for i in range(5)])
    run_layer(spark, "landing", base, source)
    real_land, real_publish = runner.land_edits, builds.publish
    if point == "before landing":
        monkeypatch.setattr(runner, "land_edits", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("driver lost")))
    elif point == "inside landing":
        def some(spark, source_dir, *args, **kwargs):
            real_land(spark, source_dir, *args, **{**kwargs, "glob": "wiki_edits_[1].json"})
            raise RuntimeError("driver lost")
        monkeypatch.setattr(runner, "land_edits", some)
    else:
        def publish(*args, **kwargs):
            if point == "after the note":
                real_publish(*args, **kwargs)
            raise RuntimeError("driver lost")
        monkeypatch.setattr(builds, "publish", publish)
    with pytest.raises(RuntimeError):
        run_layer(spark, "landing", base, source, full_refresh=True)
    monkeypatch.undo()
    root = runner.landed_path(base)
    seen = runner.landed(spark, root)
    assert read_landed(spark, seen.rows_dir, upto=seen.upto).count() == 10  # readers still have all rows, each once
    write_lines(source, "wiki_edits_3.json", [edit("late")])
    result = run_layer(spark, "landing", base, source, full_refresh=again == "full refresh")
    assert sorted(r["id"] for r in read_stored(spark, result, "edits_raw").collect()) == sorted([*map(str, range(5)), *(f"n{i}" for i in range(5)), "late"])
    assert not builds.unfinished(spark, root)


def test_a_first_landing_that_dies_goes_on(spark, workdir, monkeypatch):
    """Batches that the dead run committed are not landed again, and their counters are in the next run's."""
    from editflow.plans import runner

    source, base = f"{workdir}/in", f"{workdir}/t"
    write_lines(source, "wiki_edits_1.json", [edit("a"), edit(None)])
    monkeypatch.setattr(builds, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        run_layer(spark, "landing", base, source)
    monkeypatch.undo()
    with pytest.raises(builds.UnfinishedBuild):
        run_layer(spark, "bronze", base)
    write_lines(source, "wiki_edits_2.json", [edit("b")])
    result = run_layer(spark, "landing", base, source)
    assert sorted(r["id"] for r in read_stored(spark, result, "edits_raw").collect()) == ["a", "b"]
    assert {r["rule"]: (r["n_rows"], r["n_failed"]) for r in result.rule_rows} == {"valid_id": (3, 1), "valid_timestamp": (3, 0)}
    # a batch that is written but not part of a finished run is not read
    seen = runner.landed(spark, runner.landed_path(base))
    spark.createDataFrame([("ghost",)], "id string").write.parquet(f"{seen.rows_dir}/batch_id={seen.upto + 1}")
    assert read_landed(spark, seen.rows_dir, upto=seen.upto).count() == 2


def test_rule_history_over_runs(spark, workdir):
    source, base = f"{workdir}/in", f"{workdir}/t"
    for run in (1, 2, 3):
        write_lines(source, f"wiki_edits_{run}.json", [edit(f"{run}{i}") for i in range(run)] + [edit(None)])
        run_all_layers(spark, source, base)
    rows = T.rule_history(spark, base).where("rule in ('valid_id', 'valid_page_title', 'positive_edit_count')").collect()
    assert sorted((r["table_name"], r["run"], r["n_rows"], r["n_failed"]) for r in rows) == [
        ("edits_clean", 1, 1, 0), ("edits_clean", 2, 3, 0), ("edits_clean", 3, 6, 0),
        ("edits_raw", 1, 2, 1), ("edits_raw", 2, 3, 1), ("edits_raw", 3, 4, 1),
        ("hourly_activity", 1, 1, 0), ("hourly_activity", 2, 1, 0), ("hourly_activity", 3, 1, 0),
    ]
    assert T.rule_history(spark, f"{workdir}/nothing").collect() == []


def test_old_notes_move_and_stay_in_the_history(spark, workdir, monkeypatch):
    monkeypatch.setattr(builds, "RECENT_NOTES", 2)
    for i in range(5):
        rules = lambda i=i: [{"table_name": "page_profile", "rule": "r", "action": "warn", "n_rows": i, "n_failed": 0}]
        T.write_table(spark.createDataFrame([(i,)], "x int"), workdir, "page_profile", rules=rules)
    assert [b.number for b in builds.finished(spark, T.table_path(workdir, "page_profile"))] == [4, 5]
    assert T.read_table(spark, workdir, "page_profile").collect()[0][0] == 4
    assert sorted((r["run"], r["n_rows"]) for r in T.rule_history(spark, workdir).collect()) == [(i + 1, i) for i in range(5)]


def test_a_registered_table_is_always_there(spark, workdir):
    """A reader in a loop never fails and sees whole builds only, while the table is replaced and registered again."""
    import threading

    frame = lambda i: spark.createDataFrame([(i, k) for k in range(4)], "build int, k int").repartition(4)
    T.write_table(frame(0), workdir, "page_profile", "_loop", register=True)
    seen, failed, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(tuple(spark.sql("SELECT min(build), max(build), count(*) FROM gold.page_profile_loop").collect()[0]))
            except Exception as e:  # noqa: BLE001
                failed.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    import time

    for i in range(1, 9):
        time.sleep(0.5)
        T.write_table(frame(i), workdir, "page_profile", "_loop", register=True)
    stop.set()
    reader.join()
    assert not failed and len(seen) > 3 and all(low == high and n == 4 for low, high, n in seen)
    detail = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE TABLE EXTENDED gold.page_profile_loop").collect()}
    assert detail.get("Comment") == T.TABLE_BY_NAME["page_profile"].comment


def test_a_registered_table_of_another_schema(spark, workdir):
    T.write_table(spark.createDataFrame([(1,)], "x int"), workdir, "page_profile", "_new", register=True)
    T.write_table(spark.createDataFrame([("a", 2)], "y string, z int"), workdir, "page_profile", "_new", fmt="orc", register=True)
    assert spark.table("gold.page_profile_new").columns == ["y", "z"]


def test_wide_ids_through_the_layers(spark, workdir):
    write_lines(f"{workdir}/in", "wiki_edits_1.json", [dict(edit("a"), revision={"old": 2300000000, "new": 2300000001})])
    run_all_layers(spark, f"{workdir}/in", f"{workdir}/t", wide_ids=True)
    result = run_all_layers(spark, f"{workdir}/in", f"{workdir}/t", wide_ids=True)
    assert read_stored(spark, result, "edits_raw", wide_ids=True).collect()[0]["revision"]["old"] == 2300000000
    assert table_counts(spark, result, wide_ids=True).count() == 7
    row = read_stored(spark, result, "edits_clean", wide_ids=True).collect()[0]
    assert (row["old_revision"], row["new_revision"]) == (2300000000, 2300000001)


@pytest.mark.parametrize("first", [True, False])
def test_rules_switched_on_an_existing_base(spark, workdir, first):
    source, base = f"{workdir}/in", f"{workdir}/t"
    write_lines(source, "wiki_edits_1.json", [edit("a"), edit(None), edit("b", ts=None), edit("c", user=None), edit("d")])
    for rules in (first, not first, first):
        run_all_layers(spark, source, base, rules=rules)
        run_all_layers(spark, source, f"{workdir}/fresh_{rules}", rules=rules)
        for spec in T.TABLES[1:]:
            assert _contents(spark, base, spec.name, "") == _contents(spark, f"{workdir}/fresh_{rules}", spec.name, "")


def test_full_refresh_lands_anew_unless_archived(spark, workdir):
    source, base = f"{workdir}/in", f"{workdir}/t"
    write_lines(source, "wiki_edits_1.json", [edit("a"), edit("b")])
    run_all_layers(spark, source, base)
    result = run_all_layers(spark, source, base, full_refresh=True)
    assert read_stored(spark, result, "edits_raw").count() == 2
    with pytest.raises(ValueError):
        run_layer(spark, "landing", base, source, full_refresh=True, archive_dir=f"{workdir}/archive")
    with pytest.raises(ValueError):
        run_layer(spark, "landing", base, source, rules=False, archive_dir=f"{workdir}/archive")


def test_microsecond_timestamp_through_the_layers(spark, workdir):
    """Its text is of a year beyond 9999; later runs are not stopped by it."""
    source, base = f"{workdir}/in", f"{workdir}/t"
    write_lines(source, "wiki_edits_1.json", [edit("a"), edit("b", ts=1704067200999000)])
    run_all_layers(spark, source, base)
    write_lines(source, "wiki_edits_2.json", [edit("c")])
    result = run_all_layers(spark, source, base)
    assert {r["table_name"]: r["n_rows"] for r in table_counts(spark, result).collect()}["edits_clean"] == 3


def test_every_run_reports_every_rule(spark, workdir):
    source, base = f"{workdir}/in", f"{workdir}/t"
    write_lines(source, "wiki_edits_1.json", [edit("a"), edit("b")])
    for _ in range(2):
        assert len(run_all_layers(spark, source, base).rule_rows) == 13


def test_one_namespace(spark, workdir):
    source = f"{workdir}/in"
    write_lines(source, "wiki_edits_1.json", [edit("a"), edit("b")])
    for _ in range(2):  # unchanged tables as well
        run_all_layers(spark, source, f"{workdir}/t", suffix="_one", register=True, namespace="unified")
    names = {r["tableName"] for r in spark.sql("SHOW TABLES IN unified").collect()}
    assert {f"{spec.name}_one" for spec in T.TABLES} <= names
    for spec in T.TABLES:
        detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED unified.{spec.name}_one").collect()}
        assert detail["Comment"] == spec.comment


def test_registered_tables_read_through_the_catalog(spark, workdir):
    source = f"{workdir}/incoming"
    write_json_lines(raw_edits(spark, SF0001), source)
    result = run_all_layers(spark, source, f"{workdir}/t", suffix="_cat", register=True)
    counts = {r["table_name"]: r["n_rows"] for r in table_counts(spark, result).collect()}
    for spec in T.TABLES:
        assert spark.table(f"{spec.layer}.{spec.name}_cat").count() == counts[spec.name], spec.name


def test_other_table_format_and_format_switch(spark, workdir):
    source, base = f"{workdir}/incoming", f"{workdir}/t"
    write_json_lines(raw_edits(spark, SF0001), source)
    parquet_counts = {r["table_name"]: r["n_rows"] for r in table_counts(spark, run_all_layers(spark, source, base)).collect()}
    orc = run_all_layers(spark, source, base, fmt="orc")  # switching formats rebuilds every derived table
    assert {r["table_name"]: r["n_rows"] for r in table_counts(spark, orc, fmt="orc").collect()} == parquet_counts
    assert spark.read.orc(orc.tables["page_ranking"]).count() == 100


@pytest.mark.parametrize(
    "args", [["run", "--base", "/nowhere"], ["run", "--base", "/nowhere", "--layer", "landing"]]
)
def test_command_line_needs_a_source(args):
    from editflow.__main__ import main

    with pytest.raises(SystemExit) as stop:
        main(args)
    assert stop.value.code == 2  # argparse usage error, raised before any Spark work
