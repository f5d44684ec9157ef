"""The append sink: the rows and rule counters of the batch writer, taken from the stream's progress."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from editflow.streaming.append import append_edits, appended_rule_counts, uncounted_batches
from editflow.streaming.landing import land_edits, read_landed, read_landing_metrics
from tests.conftest import edit, write_lines


def _both(spark, workdir, **kw):
    land_edits(spark, f"{workdir}/in", f"{workdir}/a", f"{workdir}/a_ckpt", metrics_dir=f"{workdir}/a_counts", **kw)
    append_edits(spark, f"{workdir}/in", f"{workdir}/b", f"{workdir}/b_ckpt", metrics_dir=f"{workdir}/b_counts", **kw)


def _same(spark, workdir):
    ids = lambda df: sorted(r["id"] for r in df.select("id").collect())
    assert ids(read_landed(spark, f"{workdir}/a")) == ids(spark.read.parquet(f"{workdir}/b"))
    sums = read_landing_metrics(spark, f"{workdir}/a_counts").groupBy("rule").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_failed").alias("n_failed"))
    mine = appended_rule_counts(spark, f"{workdir}/b_counts").select("rule", "n_rows", "n_failed")
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, sums.collect()))
    assert uncounted_batches(spark, f"{workdir}/b_ckpt", f"{workdir}/b_counts") == []
    return {r["rule"]: (r["n_rows"], r["n_failed"]) for r in mine.collect()}


def test_counters_equal_the_batch_writer_also_over_stops(spark, workdir):
    for i in range(3):
        write_lines(f"{workdir}/in", f"wiki_edits_{i}.json", [edit(f"a{i}"), edit(None), edit(f"b{i}", ts=None)])
    _both(spark, workdir, max_files_per_trigger=1)
    assert _same(spark, workdir) == {"valid_id": (9, 3), "valid_timestamp": (9, 3)}
    _both(spark, workdir)  # nothing new: nothing is counted again
    write_lines(f"{workdir}/in", "wiki_edits_9.json", [edit("c"), edit(None)])
    _both(spark, workdir)
    assert _same(spark, workdir) == {"valid_id": (11, 4), "valid_timestamp": (11, 3)}


def test_a_batch_that_runs_again_counts_once(spark, workdir):
    """Written and counted, but not committed: the batch runs again."""
    for i in range(2):
        write_lines(f"{workdir}/in", f"wiki_edits_{i}.json", [edit(f"a{i}"), edit(None)])
    _both(spark, workdir, max_files_per_trigger=1)
    for name in ("1", ".1.crc"):
        if os.path.exists(f"{workdir}/b_ckpt/commits/{name}"):
            os.remove(f"{workdir}/b_ckpt/commits/{name}")
    _both(spark, workdir)
    assert _same(spark, workdir) == {"valid_id": (4, 2), "valid_timestamp": (4, 0)}


def test_batches_without_counters_are_named(spark, workdir):
    for i in range(2):
        write_lines(f"{workdir}/in", f"wiki_edits_{i}.json", [edit(f"a{i}")])
    append_edits(spark, f"{workdir}/in", f"{workdir}/b", f"{workdir}/ckpt", max_files_per_trigger=1, metrics_dir=f"{workdir}/counts")
    for name in os.listdir(f"{workdir}/counts"):
        if "batch-0000000001" in name:
            os.remove(f"{workdir}/counts/{name}")
    assert uncounted_batches(spark, f"{workdir}/ckpt", f"{workdir}/counts") == [1]
    assert appended_rule_counts(spark, f"{workdir}/nothing").collect() == []


def test_a_stream_that_goes_on(spark, workdir):
    import time

    write_lines(f"{workdir}/in", "wiki_edits_0.json", [edit("a"), edit(None)])
    query = append_edits(spark, f"{workdir}/in", f"{workdir}/b", f"{workdir}/ckpt", metrics_dir=f"{workdir}/counts", interval="1 second")
    write_lines(f"{workdir}/in", "wiki_edits_1.json", [edit("b")])
    deadline = time.time() + 60
    while time.time() < deadline and sum(r["n_rows"] for r in appended_rule_counts(spark, f"{workdir}/counts").collect()) < 6:
        time.sleep(0.5)
    query.stop()
    counts = {r["rule"]: (r["n_rows"], r["n_failed"]) for r in appended_rule_counts(spark, f"{workdir}/counts").collect()}
    assert counts == {"valid_id": (3, 1), "valid_timestamp": (3, 0)} and spark.read.parquet(f"{workdir}/b").count() == 2
