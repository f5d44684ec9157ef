"""Plan-shape guards for the scale properties (pruning, pushdown, aggregation kind).

They inspect physical plans over stored Parquet tables, as the layers run.
"""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from editflow.operators.activity import hourly_activity
from editflow.operators.clean import clean_schema
from editflow.operators.rankings import rank_editors
from editflow.plans.queries import QUERIES
from editflow.plans.runner import run_all_layers
from editflow.sources import tables as T
from editflow.sources.events_adapter import raw_edits
from editflow.sources.json_lines import write_json_lines
from tests.conftest import SF0001


def _plan(df) -> str:
    """The physical plan with scan metadata (locations, pushed filters) untruncated."""
    conf = df.sparkSession.conf
    previous = conf.get("spark.sql.maxMetadataStringLength")
    conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.set("spark.sql.maxMetadataStringLength", previous)


def _clean_scans(plan: str) -> list[set[str]]:
    """Column sets read by the scans of a plan."""
    return [
        {re.sub(r"#\d+L?$", "", c.strip()) for c in match.group(1).split(",")}
        for match in re.finditer(r"FileScan parquet \[([^\]]*)\]", plan)
    ]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    from editflow.session import scratch_dir

    base = scratch_dir(spark, "plans")
    write_json_lines(raw_edits(spark, SF0001), f"{base}/incoming")
    run_all_layers(spark, f"{base}/incoming", f"{base}/t")
    return T.read_table(spark, f"{base}/t", "edits_clean", schema=clean_schema(spark)), base


def test_first_ranking_pass_reads_two_columns(stored):
    clean, _ = stored
    scans = _clean_scans(_plan(rank_editors(clean)))
    assert {"editor", "wiki_language"} in scans


def test_day_ranges_reach_the_scan(stored):
    clean, _ = stored
    ts = F.col("event_timestamp")
    plan = _plan(hourly_activity(clean.where((ts >= "2024-01-05") & (ts < "2024-01-07"))))
    assert "GreaterThanOrEqual(event_timestamp,2024-01-05)" in plan and "LessThan(event_timestamp,2024-01-07)" in plan
    assert "SortAggregate" not in plan and "Expand" in plan


@pytest.mark.parametrize("name", ["editor_profile", "page_profile", "editor_ranking", "page_ranking"])
def test_top_n_queries_avoid_a_global_sort(spark, name):
    plan = _plan(QUERIES[name](spark, SF0001))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan and "SortAggregate" not in plan
