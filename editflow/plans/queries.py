"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query derives landed edit events from ``<sf_dir>/events.parquet`` and
runs the library functions over the whole table.  File-based queries first
write their inputs (derived from the same table) to a fresh folder under
the session's shared checkpoint directory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.operators import rules as R
from editflow.operators.activity import hourly_activity, hourly_activity_sorted
from editflow.operators.distinct_bitmaps import hourly_bitmaps, merged_counts, value_ids
from editflow.operators.clean import clean_edits
from editflow.operators.profiles import class_mix, editor_profile, page_profile
from editflow.operators.rankings import editor_stats, page_stats, rank_editors, rank_pages
from editflow.plans import fixtures
from editflow.plans.runner import read_stored, run_all_layers, table_counts
from editflow.session import scratch_dir
from editflow.sources.events_adapter import raw_edits
from editflow.sources.feed_capture import EVENTS_PER_CAPTURE, capture_events, capture_rejects, read_feed_capture
from editflow.sources.json_lines import read_edit_files, write_json_lines
from editflow.sources.schema import flatten_events
from editflow.sources.tables import rule_history
from editflow.streaming.landing import land_edits, read_landed

Query = Callable[[SparkSession, str], DataFrame]


# -- shared chains -------------------------------------------------------------

def landed(spark: SparkSession, sf_dir: str, rules: bool = True) -> DataFrame:
    return R.apply_rules(raw_edits(spark, sf_dir), R.LANDING_RULES, enabled=rules)


def cleaned(spark: SparkSession, sf_dir: str, rules: bool = True) -> DataFrame:
    return R.apply_rules(clean_edits(landed(spark, sf_dir, rules)), R.CLEAN_RULES, enabled=rules)


def top_editors(spark: SparkSession, sf_dir: str, rules: bool = True) -> DataFrame:
    return R.apply_rules(rank_editors(cleaned(spark, sf_dir, rules)), R.EDITOR_RANKING_RULES, enabled=rules)


def top_pages(spark: SparkSession, sf_dir: str, rules: bool = True) -> DataFrame:
    return R.apply_rules(rank_pages(cleaned(spark, sf_dir, rules)), R.PAGE_RANKING_RULES, enabled=rules)


# -- landing / sources -------------------------------------------------------

def q_landed_edits(spark, sf_dir):
    return flatten_events(landed(spark, sf_dir))


def q_landed_stream(spark, sf_dir):
    """Events as JSON-lines files (+ a foreign file) -> streaming landing -> table."""
    work = scratch_dir(spark, "landed_stream")
    source = f"{work}/incoming"
    raw = raw_edits(spark, sf_dir)
    write_json_lines(raw, source)
    # A file outside the landing glob: must not be read.
    raw.limit(1).write.option("compression", "none").json(f"{source}/other_edits.json")
    run = land_edits(spark, source, f"{work}/edits_raw", f"{work}/checkpoint")
    return flatten_events(read_landed(spark, run.target_dir))


def q_json_lines_roundtrip(spark, sf_dir):
    work = scratch_dir(spark, "json_roundtrip")
    write_json_lines(landed(spark, sf_dir), work)
    return flatten_events(read_edit_files(spark, work))


def _capture(spark, sf_dir):
    work = scratch_dir(spark, "feed_capture")
    fixtures.write_feed_capture(fixtures.render_feed_capture(raw_edits(spark, sf_dir)), work)
    return read_feed_capture(spark, work)


def q_feed_capture_events(spark, sf_dir):
    return flatten_events(capture_events(_capture(spark, sf_dir)))


def q_feed_capture_limit(spark, sf_dir):
    return flatten_events(capture_events(_capture(spark, sf_dir), limit=EVENTS_PER_CAPTURE))


def q_feed_capture_rejects(spark, sf_dir):
    return capture_rejects(_capture(spark, sf_dir)).select("line")


# -- bronze --------------------------------------------------------------------

def q_edits_clean(spark, sf_dir):
    return cleaned(spark, sf_dir)


def q_edits_clean_unchecked(spark, sf_dir):
    return cleaned(spark, sf_dir, rules=False)


def q_edit_size_change(spark, sf_dir):
    return cleaned(spark, sf_dir).select("id", "old_length", "new_length", "length_change")


def q_edit_metadata(spark, sf_dir):
    return cleaned(spark, sf_dir).select(
        "id", "meta_uri", "meta_request_id", "meta_domain", "meta_stream", "meta_topic",
        "meta_partition", "meta_offset",
    )


def q_hourly_activity(spark, sf_dir):
    return R.apply_rules(hourly_activity(cleaned(spark, sf_dir)), R.HOURLY_RULES)


def q_daily_unique_editors(spark, sf_dir):
    """Exact distinct editors of whole days, put together from the bitmaps of their hours."""
    clean, path = cleaned(spark, sf_dir), scratch_dir(spark, "editor_ids")
    value_ids(clean, "editor").write.parquet(path)
    return merged_counts(hourly_bitmaps(clean, "editor", spark.read.parquet(path)), "unique_editors")


def q_hourly_activity_ordered(spark, sf_dir):
    """The summary in presentation order (a range-partitioned global sort)."""
    return R.apply_rules(hourly_activity_sorted(cleaned(spark, sf_dir)), R.HOURLY_RULES)


# -- silver --------------------------------------------------------------------

def q_editor_ranking(spark, sf_dir):
    return top_editors(spark, sf_dir)


def q_editor_ranking_unchecked(spark, sf_dir):
    return top_editors(spark, sf_dir, rules=False)


def q_page_ranking(spark, sf_dir):
    return top_pages(spark, sf_dir)


def q_agg_row_count(spark, sf_dir):
    return editor_stats(cleaned(spark, sf_dir)).select("editor", "wiki_language", "total_edits")


def q_agg_mean_change(spark, sf_dir):
    return editor_stats(cleaned(spark, sf_dir)).select("editor", "wiki_language", "avg_length_change")


def q_agg_distinct_pages(spark, sf_dir):
    return editor_stats(cleaned(spark, sf_dir)).select("editor", "wiki_language", "pages_edited")


def q_agg_time_bounds(spark, sf_dir):
    return page_stats(cleaned(spark, sf_dir)).select(
        "page_title", "wiki_language", "first_edit_time", "last_edit_time"
    )


def q_agg_conditional_counts(spark, sf_dir):
    return page_stats(cleaned(spark, sf_dir)).select("page_title", "wiki_language", "bot_edits", "minor_edits")


# -- gold ----------------------------------------------------------------------

def q_editor_profile(spark, sf_dir):
    return R.apply_rules(editor_profile(top_editors(spark, sf_dir)), R.EDITOR_PROFILE_RULES)


def q_page_profile(spark, sf_dir):
    return R.apply_rules(page_profile(top_pages(spark, sf_dir)), R.PAGE_PROFILE_RULES)


def q_editor_type_mix(spark, sf_dir):
    return class_mix(editor_profile(top_editors(spark, sf_dir)), "editor_type")


# -- rules ---------------------------------------------------------------------

def q_rule_drop_report(spark, sf_dir):
    clean = cleaned(spark, sf_dir)
    # landing and clean counters in one pass: the clean rules see the rows the landing rules keep
    raw_and_clean = clean_edits(raw_edits(spark, sf_dir), keep=("timestamp",))
    landing_ok = R.all_hold(R.LANDING_RULES)
    return R.union_reports(
        [
            R.rule_reports(
                raw_and_clean,
                [("edits_raw", R.LANDING_RULES, None), ("edits_clean", R.CLEAN_RULES, landing_ok)],
            ),
            R.rule_report(rank_editors(clean), R.EDITOR_RANKING_RULES, "editor_ranking"),
            R.rule_report(rank_pages(clean), R.PAGE_RANKING_RULES, "page_ranking"),
        ]
    )


def q_rule_warn_report(spark, sf_dir):
    return R.union_reports(
        [
            R.rule_report(hourly_activity(cleaned(spark, sf_dir)), R.HOURLY_RULES, "hourly_activity"),
            R.rule_report(editor_profile(top_editors(spark, sf_dir)), R.EDITOR_PROFILE_RULES, "editor_profile"),
            R.rule_report(page_profile(top_pages(spark, sf_dir)), R.PAGE_PROFILE_RULES, "page_profile"),
        ]
    )


def q_rule_config_report(spark, sf_dir):
    return R.rule_report(raw_edits(spark, sf_dir), R.CONFIG_RULES, "edits_raw")


# -- whole layered run -----------------------------------------------------------

def q_layer_table_counts(spark, sf_dir):
    """Events -> landing files -> landing stream -> bronze -> silver -> gold, then row counts."""
    work = scratch_dir(spark, "layered_run")
    write_json_lines(raw_edits(spark, sf_dir), f"{work}/incoming")
    result = run_all_layers(spark, f"{work}/incoming", f"{work}/tables", suffix="_seq")
    return table_counts(spark, result)


def _two_wave_build(spark, sf_dir):
    """Build all layers in two runs: half of the events' keys arrive, every
    layer runs, the rest arrive, every layer runs again. Landing adds the new
    files, and the other tables are recomputed: they must equal a single run
    over everything."""
    work = scratch_dir(spark, "layered_waves")
    raw = raw_edits(spark, sf_dir)
    early = F.col("meta.offset") % 2 == 0
    result = None
    for wave in (raw.where(early), raw.where(~early)):
        write_json_lines(wave, f"{work}/incoming")
        result = run_all_layers(spark, f"{work}/incoming", f"{work}/tables", suffix="_seq")
    return result


def q_layer_incremental_counts(spark, sf_dir):
    return table_counts(spark, _two_wave_build(spark, sf_dir))


def q_layer_incremental_hourly(spark, sf_dir):
    return read_stored(spark, _two_wave_build(spark, sf_dir), "hourly_activity")


def q_layer_incremental_editor_profile(spark, sf_dir):
    return read_stored(spark, _two_wave_build(spark, sf_dir), "editor_profile")


def q_layer_incremental_page_profile(spark, sf_dir):
    return read_stored(spark, _two_wave_build(spark, sf_dir), "page_profile")


def q_rule_history(spark, sf_dir):
    """Rule counters of both runs of the two-wave build, from the notes that the tables keep."""
    result = _two_wave_build(spark, sf_dir)
    return rule_history(spark, result.base_dir, result.suffix).drop("build", "finished_at")


QUERIES: dict[str, Query] = {
    "landed_edits": q_landed_edits,
    "landed_stream": q_landed_stream,
    "json_lines_roundtrip": q_json_lines_roundtrip,
    "feed_capture_events": q_feed_capture_events,
    "feed_capture_limit": q_feed_capture_limit,
    "feed_capture_rejects": q_feed_capture_rejects,
    "edits_clean": q_edits_clean,
    "edits_clean_unchecked": q_edits_clean_unchecked,
    "edit_size_change": q_edit_size_change,
    "edit_metadata": q_edit_metadata,
    "hourly_activity": q_hourly_activity,
    "daily_unique_editors": q_daily_unique_editors,
    "hourly_activity_ordered": q_hourly_activity_ordered,
    "editor_ranking": q_editor_ranking,
    "editor_ranking_unchecked": q_editor_ranking_unchecked,
    "page_ranking": q_page_ranking,
    "editor_profile": q_editor_profile,
    "page_profile": q_page_profile,
    "editor_type_mix": q_editor_type_mix,
    "agg_row_count": q_agg_row_count,
    "agg_mean_change": q_agg_mean_change,
    "agg_distinct_pages": q_agg_distinct_pages,
    "agg_time_bounds": q_agg_time_bounds,
    "agg_conditional_counts": q_agg_conditional_counts,
    "rule_drop_report": q_rule_drop_report,
    "rule_warn_report": q_rule_warn_report,
    "rule_config_report": q_rule_config_report,
    "layer_table_counts": q_layer_table_counts,
    "layer_incremental_counts": q_layer_incremental_counts,
    "layer_incremental_hourly": q_layer_incremental_hourly,
    "layer_incremental_editor_profile": q_layer_incremental_editor_profile,
    "layer_incremental_page_profile": q_layer_incremental_page_profile,
    "rule_history": q_rule_history,
}
