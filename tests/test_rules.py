"""Drop / warn rules, observed counters and rule reports."""

from __future__ import annotations

import pytest
from pyspark.sql import Observation

from editflow.operators.rules import (
    CONFIG_RULES,
    DROP,
    WARN,
    Rule,
    apply_rules,
    between,
    not_null,
    rule_report,
)


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, "a"), (2, None), (None, "c"), (-1, "d")], "n int, s string")


def test_drop_and_warn(df):
    rules = [Rule("has_s", "s IS NOT NULL", DROP), Rule("positive", "n > 0", WARN)]
    assert apply_rules(df, rules).count() == 3
    assert apply_rules(df, rules, enabled=False).count() == 4
    assert apply_rules(df, [Rule("positive", "n > 0", WARN)]).count() == 4


def test_null_predicate_fails(df):
    # n IS NULL makes "n > 0" NULL: treated as a failure, so the row is dropped
    assert sorted(r["n"] for r in apply_rules(df, [Rule("positive", "n > 0")]).collect()) == [1, 2]


def test_observation_counts_input_rows(df):
    obs = Observation("t")
    rules = [Rule("has_s", "s IS NOT NULL"), Rule("positive", "n > 0", WARN)]
    out = apply_rules(df, rules, observation=obs)
    assert out.count() == 3
    assert obs.get == {"n_rows": 4, "has_s": 1, "positive": 2}


def test_rule_report(df):
    rules = [Rule("has_s", "s IS NOT NULL"), Rule("positive", "n > 0", WARN)]
    rows = {r["rule"]: r.asDict() for r in rule_report(df, rules, "t").collect()}
    assert rows["has_s"] == {"table_name": "t", "rule": "has_s", "action": "drop", "n_rows": 4, "n_failed": 1}
    assert rows["positive"]["n_failed"] == 2 and rows["positive"]["action"] == "warn"


def test_builders(spark):
    df = spark.createDataFrame([("x", 0), (None, 9999999999999), ("y", -1), ("z", None)], "id string, timestamp long")
    assert not_null("id").predicate == "id IS NOT NULL"
    assert between("timestamp", 0, 9999999999999).predicate == "timestamp BETWEEN 0 AND 9999999999999"
    rows = {r["rule"]: r["n_failed"] for r in rule_report(df, CONFIG_RULES, "raw").collect()}
    assert rows == {"wikipedia_edits_not_null": 1, "wikipedia_edits_timestamp_valid": 2}


def test_bad_action():
    with pytest.raises(ValueError):
        Rule("x", "true", "fail")


def test_several_reports_in_one_pass(df):
    from editflow.operators.rules import all_hold, rule_reports

    has_s = Rule("has_s", "s IS NOT NULL")
    positive = Rule("positive", "n > 0", WARN)
    combined = {(r["table_name"], r["rule"]): (r["n_rows"], r["n_failed"]) for r in rule_reports(
        df, [("first", [has_s], None), ("second", [positive], all_hold([has_s]))]
    ).collect()}
    # the second section only covers rows that pass the first section's rule
    assert combined == {("first", "has_s"): (4, 1), ("second", "positive"): (3, 2)}
    separate = {(r["table_name"], r["rule"]): (r["n_rows"], r["n_failed"]) for r in rule_report(
        apply_rules(df, [has_s]), [positive], "second").collect()}
    assert separate[("second", "positive")] == combined[("second", "positive")]
