"""Property-based checks (hypothesis) of the expressions and plans that carry
the equivalence claims: time text, time bounds, classifiers, day ranges and
the two ranking plans."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from editflow.functions.classify import edit_intensity, editor_diversity, editor_type
from editflow.functions.time import earliest_text, epoch_to_text, latest_text
from editflow.operators.rankings import rank_editors, rank_pages

SETTINGS = settings(max_examples=15, deadline=None)
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
# 0001-01-01 .. 9999-12-31 in milliseconds
MS_RANGE = st.integers(min_value=-62135596800000, max_value=253402300799999)


def _python_text(ms: int) -> str:
    seconds = abs(ms) // 1000 * (1 if ms >= 0 else -1)  # truncation toward zero
    moment = EPOCH + timedelta(seconds=seconds)
    return f"{moment.year:04d}-" + moment.strftime("%m-%d %H:%M:%S")  # strftime does not pad years < 1000


@SETTINGS
@given(st.lists(MS_RANGE, min_size=1, max_size=200))
def test_epoch_text_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t long")
    got = [r[0] for r in df.select(epoch_to_text("t")).collect()]
    assert got == [_python_text(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), MS_RANGE), min_size=1, max_size=200))
def test_time_bounds_equal_text_order(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t long").select(epoch_to_text("t").alias("x"))
    row = df.agg(latest_text("x").alias("hi"), earliest_text("x").alias("lo"),
                 F.max("x").alias("smax"), F.min("x").alias("smin")).collect()[0]
    assert (row["hi"], row["lo"]) == (row["smax"], row["smin"])


def _step(value, steps, default):
    for limit, label in steps:
        if value is not None and value > limit:
            return label
    return default


BOUNDARY_INTS = st.one_of(st.none(), st.sampled_from([0, 10, 11, 50, 51, 100, 101, 1000, 1001]), st.integers(-5, 5000))
BOUNDARY_DOUBLES = st.one_of(st.none(), st.sampled_from([0.0, 1e-9, 100.0, 100.000001, -1.0]),
                             st.floats(-1e6, 1e6, allow_nan=False))


@SETTINGS
@given(st.lists(st.tuples(BOUNDARY_INTS, BOUNDARY_INTS, BOUNDARY_DOUBLES), min_size=1, max_size=100))
def test_classifiers_match_python(spark, rows):
    df = spark.createDataFrame(rows, "edit_count bigint, unique_editors bigint, avg_length_change double")
    got = [tuple(r) for r in df.select(edit_intensity(), editor_diversity(), editor_type()).collect()]
    want = [
        (
            _step(c, ((1000, "High"), (100, "Medium")), "Low"),
            _step(u, ((50, "High"), (10, "Medium")), "Low"),
            _step(a, ((100, "Heavy Editor"), (0, "Regular Editor")), "Minor Editor"),
        )
        for c, u, a in rows
    ]
    assert got == want


ROW = st.tuples(
    st.one_of(st.none(), st.sampled_from(["A", "B", "C", "D", "E"])),
    st.one_of(st.none(), st.sampled_from(["enwiki", "dewiki"])),
    st.one_of(st.none(), st.sampled_from(["P1", "P2", "P3", "P4"])),
    st.one_of(st.none(), st.integers(-50, 50)),
    st.one_of(st.none(), st.integers(1704067200, 1706745600)),
    st.one_of(st.none(), st.booleans()),
    st.one_of(st.none(), st.booleans()),
)


@SETTINGS
@given(st.lists(ROW, min_size=0, max_size=60), st.integers(0, 6))
def test_top_first_equals_single_pass(spark, rows, n):
    df = spark.createDataFrame(
        rows,
        "editor string, wiki_language string, page_title string, length_change int, ts long, "
        "is_bot_edit boolean, is_minor_edit boolean",
    ).withColumn("event_timestamp", F.from_unixtime("ts")).drop("ts")
    for rank in (rank_editors, rank_pages):
        fast = [tuple(r) for r in rank(df, n).collect()]
        slow = [tuple(r) for r in rank(df, n, "single_pass").collect()]
        assert fast == slow  # same rows in the same order


_SECONDS = st.one_of(
    st.integers(-8_000_000_000_000, 8_000_000_000_000),
    *(st.integers(edge - 10**7, edge + 10**7) for edge in (-377705116800, -62167219200, -62135596800, 0, 253402300800, 3093527980800, -3217862419200)),
)


@SETTINGS
@given(st.lists(st.lists(_SECONDS, min_size=1, max_size=6), min_size=1, max_size=30))
def test_time_bounds_have_the_order_of_the_texts(spark, groups):
    """Years beyond 9999 and before 0 included, in one hash aggregate."""
    rows = [(g, s) for g, seconds in enumerate(groups) for s in seconds]
    df = spark.createDataFrame(rows, "g int, s long").select("g", F.from_unixtime("s", "yyyy-MM-dd HH:mm:ss").alias("t"))
    texts = df.groupBy("g").agg(F.max("t").alias("hi"), F.min("t").alias("lo"))
    bounds = df.groupBy("g").agg(latest_text("t").alias("hi"), earliest_text("t").alias("lo"))
    assert "SortAggregate" not in bounds._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, bounds.collect())) == sorted(map(tuple, texts.collect()))
