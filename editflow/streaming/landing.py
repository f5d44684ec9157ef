"""Incremental landing of JSON-lines edit files with Structured Streaming.

Each run is ``trigger(availableNow=True)``: it processes every file that
arrived since the last run (exactly once, tracked by the checkpoint) and
stops, so an external scheduler decides the cadence.  Every micro-batch is
written with ``foreachBatch`` to ``<target>/batch_id=<n>`` in overwrite
mode: a batch replayed after a lost executor or driver rewrites the same
folder, so the table never holds duplicates.  Rule counters of the batch
are observed on the same write (no second pass) and stored next to it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from editflow.operators.rules import LANDING_RULES, apply_rules, observed_counts
from editflow.sources import files
from editflow.sources.json_lines import LANDING_GLOB, stream_edit_files
from editflow.sources.schema import edit_event_schema

LANDED_TABLE = "edits_raw"
METRICS_SCHEMA = "table_name string, rule string, action string, n_rows bigint, n_failed bigint"


@dataclass
class LandingRun:
    target_dir: str
    metrics_dir: str
    batches: list[int] = field(default_factory=list)
    # rule counters of the batches of this run (one row per batch and rule)
    rule_rows: list[dict] = field(default_factory=list)

    def rule_totals(self) -> list[dict]:
        """Counters summed over this run's batches, one row per rule."""
        totals: dict[tuple, dict] = {}
        for row in self.rule_rows:
            key = (row["table_name"], row["rule"], row["action"])
            acc = totals.setdefault(key, dict(row, n_rows=0, n_failed=0))
            acc["n_rows"] += row["n_rows"]
            acc["n_failed"] += row["n_failed"]
        return list(totals.values())


def land_edits(
    spark: SparkSession,
    source_dir: str,
    target_dir: str,
    checkpoint_dir: str,
    glob: str | None = LANDING_GLOB,
    rules: bool = True,
    wide_ids: bool = False,
    max_files_per_trigger: int | None = None,
    metrics_dir: str | None = None,
    archive_dir: str | None = None,
) -> LandingRun:
    """Land all new files of ``source_dir`` into ``target_dir`` and stop.

    ``max_files_per_trigger`` bounds one micro-batch while a backlog drains;
    ``archive_dir`` moves every landed file there once its batch is
    committed, so the source listing stays small however long the feed runs.
    """
    metrics_dir = metrics_dir or f"{target_dir.rstrip('/')}_rule_metrics"
    run = LandingRun(target_dir, metrics_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        observation = Observation(f"landing_rules_{batch_id}_{uuid.uuid4().hex[:8]}") if rules else None
        landed = apply_rules(batch, LANDING_RULES, enabled=rules, observation=observation)
        landed.write.mode("overwrite").parquet(f"{target_dir}/batch_id={batch_id}")
        if observation is not None:
            # one row per rule; the batch id is the folder name
            rows = observed_counts(observation, LANDING_RULES, LANDED_TABLE)
            batch.sparkSession.createDataFrame(rows, METRICS_SCHEMA).write.mode("overwrite").parquet(
                f"{metrics_dir}/batch_id={batch_id}"
            )
            run.rule_rows.extend(rows)
        run.batches.append(batch_id)

    stream = stream_edit_files(spark, source_dir, glob, wide_ids, max_files_per_trigger, archive_dir)
    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return run


def read_landed(spark: SparkSession, target_dir: str, wide_ids: bool = False, upto: int | None = None) -> DataFrame:
    """The landed table without the batch folder column; with ``upto`` only the batches up to that one."""
    if not files.exists(spark, target_dir):
        return spark.createDataFrame([], edit_event_schema(wide_ids))
    schema = edit_event_schema(wide_ids).add("batch_id", "long")
    rows = spark.read.schema(schema).parquet(target_dir)
    if upto is not None:
        rows = rows.where(F.col("batch_id") <= upto)
    return rows.drop("batch_id")


def read_landing_metrics(spark: SparkSession, metrics_dir: str) -> DataFrame:
    return spark.read.parquet(metrics_dir)


def committed_batch(spark: SparkSession, checkpoint_dir: str) -> int:
    """The last batch that the stream committed; -1 where there is none."""
    return max((int(n) for n in files.list_names(spark, f"{checkpoint_dir.rstrip('/')}/commits") if n.isdigit()), default=-1)


def landed_rule_counts(spark: SparkSession, metrics_dir: str, after: int, upto: int) -> list[dict]:
    """Counters of the batches beyond ``after``, as the batches stored them, one row per rule (0 where no batch came)."""
    seen = {}
    if upto > after and files.exists(spark, metrics_dir):
        rows = spark.read.schema(METRICS_SCHEMA + ", batch_id bigint").parquet(metrics_dir)
        rows = rows.where((F.col("batch_id") > after) & (F.col("batch_id") <= upto)).groupBy("rule")
        seen = {r["rule"]: r for r in rows.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_failed").alias("n_failed")).collect()}
    counts = [(rule, seen.get(rule.name)) for rule in LANDING_RULES]
    return [
        {
            "table_name": LANDED_TABLE,
            "rule": rule.name,
            "action": rule.action,
            "n_rows": row["n_rows"] if row else 0,
            "n_failed": row["n_failed"] if row else 0,
        }
        for rule, row in counts
    ]
