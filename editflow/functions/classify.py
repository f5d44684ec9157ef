"""Threshold classifiers of the profile tables.

All comparisons are strict ``>``; anything else, NULL included, falls to the
last label.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Thresholds and labels of the three classifiers.
# editor_type      : avg_length_change > 100 Heavy Editor, > 0 Regular Editor, else Minor Editor
# edit_intensity   : edit_count > 1000 High, > 100 Medium, else Low
# editor_diversity : unique_editors > 50 High, > 10 Medium, else Low
# ---------------------------------------------------------------------------
EDITOR_TYPE_STEPS = ((100, "Heavy Editor"), (0, "Regular Editor"))
EDITOR_TYPE_DEFAULT = "Minor Editor"
INTENSITY_STEPS = ((1000, "High"), (100, "Medium"))
DIVERSITY_STEPS = ((50, "High"), (10, "Medium"))
LEVEL_DEFAULT = "Low"


def step_label(value: Column | str, steps, default: str) -> Column:
    """First label whose threshold ``value`` strictly exceeds, else ``default``."""
    value = F.col(value) if isinstance(value, str) else value
    (first_limit, first_label), *rest = steps
    out = F.when(value > first_limit, first_label)
    for limit, label in rest:
        out = out.when(value > limit, label)
    return out.otherwise(default)


def editor_type(avg_length_change: Column | str = "avg_length_change") -> Column:
    return step_label(avg_length_change, EDITOR_TYPE_STEPS, EDITOR_TYPE_DEFAULT)


def edit_intensity(edit_count: Column | str = "edit_count") -> Column:
    return step_label(edit_count, INTENSITY_STEPS, LEVEL_DEFAULT)


def editor_diversity(unique_editors: Column | str = "unique_editors") -> Column:
    return step_label(unique_editors, DIVERSITY_STEPS, LEVEL_DEFAULT)
