"""Print the physical plans of each layer step over stored tables.

Usage: python tools/explain_plans.py [sf_dir] [mode]   (mode: simple | formatted)

Builds the landing and bronze tables once (from ``events``) in a scratch
folder, then explains every downstream step as it runs in production:
reading the stored, columnar tables (the rankings from stored per-key
partials, as the runner builds them).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from editflow.operators import rules as R  # noqa: E402
from editflow.operators.activity import hourly_activity  # noqa: E402
from editflow.operators.clean import clean_edits  # noqa: E402
from editflow.operators.profiles import editor_profile, page_profile  # noqa: E402
from editflow.operators.rankings import rank_editors, rank_pages  # noqa: E402
from editflow.plans.runner import run_layer  # noqa: E402
from editflow.session import local_session, scratch_dir  # noqa: E402
from editflow.sources import tables as T  # noqa: E402
from editflow.sources.events_adapter import raw_edits  # noqa: E402
from editflow.sources.json_lines import write_json_lines  # noqa: E402
from editflow.streaming.landing import read_landed  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    mode = argv[2] if len(argv) > 2 else "simple"
    spark = local_session(8)
    work = scratch_dir(spark, "explain")
    write_json_lines(raw_edits(spark, sf_dir), f"{work}/incoming")
    result = run_layer(spark, "landing", f"{work}/t", source_dir=f"{work}/incoming")
    run_layer(spark, "bronze", f"{work}/t", result=result)
    clean = T.read_table(spark, f"{work}/t", "edits_clean")
    editors, pages = rank_editors(clean), rank_pages(clean)
    steps = {
        "edits_clean": R.apply_rules(clean_edits(read_landed(spark, result.tables["edits_raw"])), R.CLEAN_RULES),
        "hourly_activity": hourly_activity(clean),
        "editor_ranking": R.apply_rules(editors, R.EDITOR_RANKING_RULES),
        "page_ranking": R.apply_rules(pages, R.PAGE_RANKING_RULES),
        "editor_profile": editor_profile(editors),
        "page_profile": page_profile(pages),
    }
    for name, df in steps.items():
        print(f"\n===== {name} =====")
        df.explain(mode)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
