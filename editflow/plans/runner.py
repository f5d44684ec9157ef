"""Run one layer from the stored tables of the previous layer, or all layers.

Landing is incremental: a streaming query lands the new files (the engine's
own checkpoint says which). Every other table is recomputed from the stored
table before it and replaced, so there is no progress to keep: a run that
dies anywhere leaves every table as it was or finished, and the next run goes
on from there. Each build's note says which build it was made from; a layer
refuses an upstream table that was never finished, and the profiles refuse
rankings of two different builds.

The landed rows depend on whether the rules are on and on the width of the
ids, so each combination has a folder of its own: a run with other settings
lands all source files anew. Rows, checkpoint and counters of the batches are
in one folder (a generation), and a full refresh lands into a new one, which takes the
old one's place when all files are landed.

Writing each table is also what cuts the lineage between layers. Rule counters
are observed on the write actions, so they cost no extra pass.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from editflow.operators import rules as R
from editflow.operators.activity import hourly_activity
from editflow.operators.clean import clean_edits, clean_schema
from editflow.operators.profiles import editor_profile, page_profile
from editflow.operators.rankings import DEFAULT_TOP_N, rank_editors, rank_pages
from editflow.sources import builds, files
from editflow.sources import tables as T
from editflow.streaming.landing import committed_batch, land_edits, landed_rule_counts, read_landed


@dataclass
class RunResult:
    base_dir: str
    suffix: str
    tables: dict[str, str] = field(default_factory=dict)
    rule_rows: list[dict] = field(default_factory=list)

    def rule_report(self, spark: SparkSession) -> DataFrame:
        """Rule counters of this run as a DataFrame (one row per table and rule)."""
        schema = "table_name string, rule string, action string, n_rows bigint, n_failed bigint"
        return spark.createDataFrame(self.rule_rows, schema)

    def save_rule_report(self, spark: SparkSession, run_id: str | None = None) -> str:
        """Append this run's counters to ``<base>/_rule_reports/rule_report<suffix>/run_id=<id>``."""
        from datetime import datetime, timezone

        run_id = run_id or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S") + "_" + uuid.uuid4().hex[:6]
        path = f"{self.base_dir.rstrip('/')}/_rule_reports/rule_report{self.suffix}/run_id={run_id}"
        self.rule_report(spark).coalesce(1).write.mode("overwrite").parquet(path)
        return path


def landed_path(base_dir: str, suffix: str = "", rules: bool = True, wide_ids: bool = False) -> str:
    """Where the generations of the rows that were landed with these settings are."""
    settings = f"rules-{'on' if rules else 'off'}_ids-{'wide' if wide_ids else 'int'}"
    return f"{T.table_path(base_dir, 'edits_raw', suffix)}/{settings}"


@dataclass(frozen=True)
class Landed:
    """The landed rows of a finished run: a generation and its last batch."""

    rows_dir: str
    build: str
    upto: int

    @property
    def version(self) -> str:
        return f"{self.build}/{self.upto}"


def landed(spark: SparkSession, root: str) -> Landed:
    """What the last finished landing run left; an error where none finished."""
    build = builds.required(spark, root)
    return Landed(f"{build.path}/rows", build.build, build.note(spark)["upto"])


def _land(
    spark: SparkSession, result: RunResult, source_dir: str, rules: bool, wide_ids: bool, fresh: bool,
    max_files_per_trigger: int | None, archive_dir: str | None, register: bool, namespace: str | None,
) -> None:
    root = landed_path(result.base_dir, result.suffix, rules, wide_ids)
    before = builds.current(spark, root)
    any_before = files.matches(spark, f"{T.table_path(result.base_dir, 'edits_raw', result.suffix)}/*/{builds.FOLDER}*")
    begun = builds.unfinished(spark, root)
    if archive_dir and any_before and (fresh or not (before or begun)):
        raise ValueError("files that were landed before are archived; land them again from the archive with other settings")
    if fresh:
        build = builds.new_build()
    else:  # a first run that died goes on where it was
        build = before.build if before else begun[-1] if begun else builds.new_build()
    generation = builds.folder(root, build)
    rows_dir, checkpoint, metrics = f"{generation}/rows", f"{generation}/checkpoint", f"{generation}/rule_metrics"
    land_edits(
        spark, source_dir, rows_dir, checkpoint, rules=rules, metrics_dir=metrics,
        max_files_per_trigger=max_files_per_trigger, archive_dir=archive_dir, wide_ids=wide_ids,
    )
    upto = committed_batch(spark, checkpoint)
    after = before.note(spark)["upto"] if before and before.build == build else -1
    counts = landed_rule_counts(spark, metrics, after, upto) if rules else []
    noted = [{k: v for k, v in row.items() if k != "table_name"} for row in counts]
    builds.publish(spark, root, build, table_name="edits_raw", upstream={}, upto=upto, rules=noted)
    result.tables["edits_raw"] = rows_dir
    result.rule_rows.extend(counts)
    if register and files.exists(spark, rows_dir):
        T.register_table(
            spark, result.base_dir, "edits_raw", result.suffix, path=rows_dir, namespace=namespace, where=f"batch_id <= {upto}"
        )
    builds.clean(spark, root)


def run_layer(
    spark: SparkSession,
    layer: str,
    base_dir: str,
    source_dir: str | None = None,
    suffix: str = "",
    rules: bool = True,
    fmt: str = "parquet",
    top_n: int = DEFAULT_TOP_N,
    time_unit: str = "ms",
    register: bool = False,
    result: RunResult | None = None,
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
    full_refresh: bool = False,
    wide_ids: bool = False,
    namespace: str | None = None,
) -> RunResult:
    """Build the tables of one layer (``landing``, ``bronze``, ``silver``, ``gold``).

    ``max_files_per_trigger`` and ``archive_dir`` are passed to the landing
    stream (see :func:`editflow.streaming.landing.land_edits`);
    ``full_refresh`` lands all source files anew (an error where they were
    archived); ``wide_ids`` lands and reads revision ids as bigint;
    ``register`` records the tables in the catalog, in one ``namespace`` or
    in one for each layer.
    """
    if layer not in T.LAYERS:
        raise ValueError(f"layer must be one of {T.LAYERS}, got {layer!r}")
    result = result or RunResult(base_dir, suffix)

    def write(df: DataFrame, name: str, **upstream: str) -> None:
        spec = T.TABLE_BY_NAME[name]
        observation = Observation(f"rules_{name}{suffix}_{uuid.uuid4().hex[:8]}") if rules and spec.rules else None
        checked = R.apply_rules(df, spec.rules, enabled=rules, observation=observation)
        counts: list[dict] = []

        def observed() -> list[dict]:
            counts.extend(R.observed_counts(observation, spec.rules, name) if observation is not None else [])
            return counts

        result.tables[name] = T.write_table(checked, base_dir, name, suffix, fmt, register, namespace, upstream, observed)
        result.rule_rows.extend(counts)

    if layer == "landing":
        if source_dir is None:
            raise ValueError("the landing layer needs source_dir")
        _land(
            spark, result, source_dir, rules, wide_ids, full_refresh, max_files_per_trigger, archive_dir, register, namespace
        )
    elif layer == "bronze":
        source = landed(spark, landed_path(base_dir, suffix, rules, wide_ids))
        raw = read_landed(spark, source.rows_dir, wide_ids, source.upto)
        write(clean_edits(raw, time_unit), "edits_clean", edits_raw=source.version)
        clean, build = _clean(spark, base_dir, suffix, fmt, wide_ids)
        write(hourly_activity(clean), "hourly_activity", edits_clean=build)
    elif layer == "silver":
        clean, build = _clean(spark, base_dir, suffix, fmt, wide_ids)
        _side_by_side(
            lambda: write(rank_editors(clean, top_n), "editor_ranking", edits_clean=build),
            lambda: write(rank_pages(clean, top_n), "page_ranking", edits_clean=build),
        )
    else:
        editors, pages = (builds.required(spark, T.table_path(base_dir, name, suffix)) for name in ("editor_ranking", "page_ranking"))
        made_from = [build.note(spark)["upstream"] for build in (editors, pages)]
        if made_from[0] != made_from[1]:
            raise builds.UnfinishedBuild(f"the rankings are of different builds ({made_from[0]}, {made_from[1]}): run the silver layer again")
        _side_by_side(
            lambda: write(editor_profile(_load(spark, editors, fmt)), "editor_profile", editor_ranking=editors.build),
            lambda: write(page_profile(_load(spark, pages, fmt)), "page_profile", page_ranking=pages.build),
        )
    return result


def _load(spark: SparkSession, build: builds.Build, fmt: str) -> DataFrame:
    return spark.read.format(fmt).load(build.path)


def _clean(spark: SparkSession, base_dir: str, suffix: str, fmt: str, wide_ids: bool) -> tuple[DataFrame, str]:
    """The cleaned table and the id of the build that this is."""
    build = builds.required(spark, T.table_path(base_dir, "edits_clean", suffix))
    return spark.read.format(fmt).schema(clean_schema(spark, wide_ids)).load(build.path), build.build


def _side_by_side(*steps) -> None:
    """Submit independent table builds from parallel driver threads.

    Their Spark jobs then share the cluster instead of waiting for each
    other's driver-side work (planning, broadcasts, commits); the first
    failure is raised.
    """
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        for future in [pool.submit(step) for step in steps]:
            future.result()


def run_all_layers(spark: SparkSession, source_dir: str, base_dir: str, suffix: str = "", **options) -> RunResult:
    """Landing -> bronze -> silver -> gold, in that fixed order (options as of :func:`run_layer`)."""
    result = RunResult(base_dir, suffix)
    for layer in T.LAYERS:
        run_layer(spark, layer, base_dir, source_dir=source_dir, suffix=suffix, result=result, **options)
    return result


def read_stored(
    spark: SparkSession, result: RunResult, name: str, fmt: str = "parquet", wide_ids: bool = False
) -> DataFrame:
    """A table of a run, as later layers read it."""
    if name == "edits_raw":
        return read_landed(spark, result.tables[name], wide_ids)
    if name == "edits_clean":
        return _clean(spark, result.base_dir, result.suffix, fmt, wide_ids)[0]
    return T.read_table(spark, result.base_dir, name, result.suffix, fmt)


def table_counts(spark: SparkSession, result: RunResult, fmt: str = "parquet", wide_ids: bool = False) -> DataFrame:
    """Rows per stored table of a run, as one lazy union of counts."""
    out = None
    for spec in T.TABLES:
        if spec.name in result.tables:
            rows = read_stored(spark, result, spec.name, fmt, wide_ids).agg(F.count(F.lit(1)).alias("n_rows"))
            rows = rows.select(F.lit(spec.name).alias("table_name"), "n_rows")
            out = rows if out is None else out.unionByName(rows)
    return out
