"""Landing through Spark's own append sink, with the rule counters taken from the stream's progress.

:func:`editflow.streaming.landing.land_edits` writes each batch itself, which
lets it store the batch's counters beside it. A plain file sink needs no such function: it
commits each batch to its log, readers see committed files only, and the
counters are observed metrics of the running query, which a listener receives
after each batch. They are stored under the number of the batch, so a batch
that runs again after a failure counts once.

A driver that dies between the commit of a batch and the listener's call leaves that
batch without counters; :func:`uncounted_batches` names such batches.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from editflow.operators.rules import LANDING_RULES, Rule, apply_rules
from editflow.sources import files
from editflow.sources.json_lines import LANDING_GLOB, stream_edit_files
from editflow.streaming.landing import LANDED_TABLE, METRICS_SCHEMA, committed_batch

_COUNTS = "batch-"


class RuleCountListener(StreamingQueryListener):
    """Stores the observed rule counters of each batch of one query as ``<metrics_dir>/batch-<n>.json``."""

    def __init__(self, spark: SparkSession, observed: str, metrics_dir: str, rules: Sequence[Rule], table: str) -> None:
        self.spark, self.observed, self.metrics_dir = spark, observed, metrics_dir.rstrip("/")
        self.rules, self.table = rules, table
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        counts = event.progress.observedMetrics.get(self.observed)
        if counts is None:
            return
        values = counts.asDict()
        rows = [
            {
                "table_name": self.table, "rule": rule.name, "action": rule.action,
                "n_rows": int(values["n_rows"]), "n_failed": int(values[rule.name]),
            }
            for rule in self.rules
        ]
        name = f"{self.metrics_dir}/{_COUNTS}{event.progress.batchId:010d}.json"
        if files.exists(self.spark, name):
            return  # the sink skips a batch that it wrote before, so only its first run has counted the rows
        staged = f"{self.metrics_dir}/_{uuid.uuid4().hex}"
        files.write_text(self.spark, staged, "".join(json.dumps(row) + "\n" for row in rows))
        files.rename(self.spark, staged, name)

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def wait_for_end(self, query: StreamingQuery, timeout: float = 120) -> None:
        """Until all of an ended query's progress was seen: its end is reported after it."""
        with self.changed:
            self.changed.wait_for(lambda: str(query.runId) in self.ended, timeout)


def append_edits(
    spark: SparkSession,
    source_dir: str,
    target_dir: str,
    checkpoint_dir: str,
    glob: str | None = LANDING_GLOB,
    wide_ids: bool = False,
    max_files_per_trigger: int | None = None,
    metrics_dir: str | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Land new files of ``source_dir`` through the Parquet append sink, rules applied.

    Without ``interval`` all files that are there are landed and the query has ended when this returns; with one
    (``"15 minutes"``) it goes on until it is stopped. Only one query may write to a target.
    """
    metrics_dir = metrics_dir or f"{target_dir.rstrip('/')}_rule_counts"
    observed = f"landing_rules_{uuid.uuid4().hex[:8]}"
    listener = RuleCountListener(spark, observed, metrics_dir, LANDING_RULES, LANDED_TABLE)
    stream = stream_edit_files(spark, source_dir, glob, wide_ids, max_files_per_trigger)
    checked = apply_rules(stream, LANDING_RULES, observation=observed)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    spark.streams.addListener(listener)
    try:
        query = (
            checked.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint_dir)
            .trigger(**trigger).start(target_dir)
        )
        if interval is None:
            query.awaitTermination()
            listener.wait_for_end(query)
    finally:
        if interval is None:
            spark.streams.removeListener(listener)
    return query


def appended_rule_counts(spark: SparkSession, metrics_dir: str) -> DataFrame:
    """Counters of all batches together, one row for each rule."""
    if not files.list_names(spark, metrics_dir, _COUNTS):
        return spark.createDataFrame([], METRICS_SCHEMA)
    rows = spark.read.schema(METRICS_SCHEMA).json(f"{metrics_dir.rstrip('/')}/{_COUNTS}*.json")
    return rows.groupBy("table_name", "rule", "action").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_failed").alias("n_failed"))


def uncounted_batches(spark: SparkSession, checkpoint_dir: str, metrics_dir: str) -> list[int]:
    """Committed batches whose counters were not stored."""
    counted = {int(n[len(_COUNTS):].split(".")[0]) for n in files.list_names(spark, metrics_dir, _COUNTS)}
    return [n for n in range(committed_batch(spark, checkpoint_dir) + 1) if n not in counted]
