"""Row-level data-quality rules: drop rows or just count failures.

A rule is a named SQL predicate with an action.  ``drop`` removes rows whose
predicate is false or NULL; ``warn`` keeps every row.  Both kinds are counted:

* inside a job, with ``apply_rules(..., observation=...)`` - the counters ride
  along with whatever action writes the table, no extra pass over the data;
* as a DataFrame, with ``rule_report`` - one aggregate pass (map-side partial
  counts, one tiny final row) unpivoted to one row per rule.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

DROP = "drop"
WARN = "warn"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    action: str = DROP

    def __post_init__(self) -> None:
        if self.action not in (DROP, WARN):
            raise ValueError(f"rule action must be {DROP!r} or {WARN!r}, got {self.action!r}")

    def holds(self) -> Column:
        """True when the row passes; a NULL predicate counts as a failure."""
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def not_null(column: str, name: str | None = None, action: str = WARN) -> Rule:
    return Rule(name or f"{column}_not_null", f"{column} IS NOT NULL", action)


def between(column: str, low, high, name: str | None = None, action: str = WARN) -> Rule:
    return Rule(name or f"{column}_between", f"{column} BETWEEN {low!r} AND {high!r}", action)


# ---------------------------------------------------------------------------
# Rule names, predicates and actions of each layer table.  They
# are the data contract (the names appear in every rule report), so they must
# stay exactly as below.
# ---------------------------------------------------------------------------
LANDING_RULES = (
    Rule("valid_id", "id IS NOT NULL", DROP),
    Rule("valid_timestamp", "timestamp IS NOT NULL", DROP),
)
CLEAN_RULES = (
    Rule("valid_editor", "editor IS NOT NULL", DROP),
    Rule("valid_page_title", "page_title IS NOT NULL", DROP),
    Rule("valid_event_timestamp", "event_timestamp IS NOT NULL", DROP),
)
HOURLY_RULES = (Rule("positive_edit_count", "edit_count > 0", WARN),)
EDITOR_RANKING_RULES = (
    Rule("valid_total_edits", "total_edits > 0", DROP),
    Rule("valid_editor", "editor IS NOT NULL", DROP),
    Rule("valid_wiki_language", "wiki_language IS NOT NULL", DROP),
    Rule("valid_last_edit_time", "last_edit_time IS NOT NULL", DROP),
)
PAGE_RANKING_RULES = (Rule("valid_edit_count", "edit_count > 0", DROP),)
EDITOR_PROFILE_RULES = (Rule("non_negative_activity_span", "activity_span_days >= 0", WARN),)
PAGE_PROFILE_RULES = (Rule("positive_unique_editors", "unique_editors > 0", WARN),)
# Rules declared only in the deployment configuration (report-only).
CONFIG_RULES = (
    not_null("id", name="wikipedia_edits_not_null"),
    between("timestamp", 0, 9999999999999, name="wikipedia_edits_timestamp_valid"),
)


def all_hold(rules: Sequence[Rule]) -> Column:
    """True when a row passes every rule (NULL predicates fail)."""
    condition = F.lit(True)
    for rule in rules:
        condition = condition & rule.holds()
    return condition


def _failed_count(rule: Rule) -> Column:
    return F.count_if(~rule.holds())


def apply_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    enabled: bool = True,
    observation: Observation | str | None = None,
) -> DataFrame:
    """Apply ``rules`` to ``df``: drop rules filter, warn rules only count.

    With ``observation`` the input row count and one failure counter per rule
    are attached as observed metrics (``n_rows`` and the rule names).  The
    counters sit below the filter, so they see every input row.
    """
    if not enabled or not rules:
        return df
    if observation is not None:
        metrics = [F.count(F.lit(1)).alias("n_rows")]
        metrics += [_failed_count(rule).alias(rule.name) for rule in rules]
        df = df.observe(observation, *metrics)
    drops = [rule for rule in rules if rule.action == DROP]
    return df.where(all_hold(drops)) if drops else df


def rule_report(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """One row per rule: ``table_name, rule, action, n_rows, n_failed``.

    A single global aggregate over ``df`` (partial counts per task, one final
    row), then a ``stack`` to turn the counters into rows.
    """
    return rule_reports(df, [(table, rules, None)])


def rule_reports(df: DataFrame, sections: Sequence[tuple[str, Sequence[Rule], Column | None]]) -> DataFrame:
    """Several tables' rule reports from one aggregate pass over ``df``.

    Each section is ``(table, rules, scope)``; ``scope`` selects the rows that
    section covers (``None``: all rows), e.g. the clean rules only see rows
    that passed the landing rules.  Same output as :func:`rule_report`.
    """
    counters, rows = [], []
    for s_i, (table, rules, scope) in enumerate(sections):
        in_scope = F.lit(True) if scope is None else F.coalesce(scope, F.lit(False))
        counters.append(F.count_if(in_scope).alias(f"n{s_i}"))
        for r_i, rule in enumerate(rules):
            counters.append(F.count_if(in_scope & ~rule.holds()).alias(f"f{s_i}_{r_i}"))
            rows.append(f"'{table}', '{rule.name}', '{rule.action}', n{s_i}, f{s_i}_{r_i}")
    return df.agg(*counters).select(
        F.expr(f"stack({len(rows)}, {', '.join(rows)}) AS (table_name, rule, action, n_rows, n_failed)")
    )


def union_reports(reports: Iterable[DataFrame]) -> DataFrame:
    reports = list(reports)
    out = reports[0]
    for other in reports[1:]:
        out = out.unionByName(other)
    return out


def observed_counts(observation: Observation, rules: Sequence[Rule], table: str) -> list[dict]:
    """Turn a finished observation into report rows (driver-side, one row per rule)."""
    values = observation.get
    n_rows = int(values.get("n_rows", 0))
    return [
        {
            "table_name": table,
            "rule": rule.name,
            "action": rule.action,
            "n_rows": n_rows,
            "n_failed": int(values.get(rule.name, 0)),
        }
        for rule in rules
    ]
