"""editflow: page-edit event analytics on Spark.

Layers (landing -> clean -> activity/rankings -> profiles) are plain
``DataFrame -> DataFrame`` functions so Catalyst can optimise a whole chain.
"""

from editflow.functions.classify import edit_intensity, editor_diversity, editor_type
from editflow.operators.activity import hourly_activity
from editflow.operators.clean import clean_edits
from editflow.operators.profiles import editor_profile, page_profile
from editflow.operators.rankings import rank_editors, rank_pages
from editflow.operators.rules import Rule, apply_rules, rule_report
from editflow.plans.runner import run_all_layers, run_layer
from editflow.sources.schema import edit_event_schema

__all__ = [
    "Rule",
    "apply_rules",
    "clean_edits",
    "edit_event_schema",
    "edit_intensity",
    "editor_diversity",
    "editor_profile",
    "editor_type",
    "hourly_activity",
    "page_profile",
    "rank_editors",
    "rank_pages",
    "rule_report",
    "run_all_layers",
    "run_layer",
]
