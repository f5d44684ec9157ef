"""Gold profiles over the (at most n-row) rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.functions.classify import edit_intensity, editor_diversity, editor_type
from editflow.functions.time import calendar_day_span


def editor_profile(top_editors: DataFrame) -> DataFrame:
    """Activity span in calendar days, edits per day and an editor class.

    One projection whose expressions do not refer to each other, so it stays
    a single ``Project`` that folds into the ranking's top-n
    (``TakeOrderedAndProject``) instead of forcing a global sort.
    """
    span = calendar_day_span("last_edit_time", "first_edit_time")
    return top_editors.withColumns(
        {
            "activity_span_days": span,
            "edits_per_day": F.when(span > 0, F.col("total_edits") / span).otherwise(
                F.col("total_edits").cast("double")
            ),
            "editor_type": editor_type("avg_length_change"),
        }
    )


def page_profile(top_pages: DataFrame) -> DataFrame:
    """Edit intensity and editor diversity levels."""
    return top_pages.withColumns(
        {
            "edit_intensity": edit_intensity("edit_count"),
            "editor_diversity": editor_diversity("unique_editors"),
        }
    )


def class_mix(profile: DataFrame, column: str) -> DataFrame:
    """Row count per class label of a profile table."""
    return profile.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
