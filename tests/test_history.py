"""Feature history: the same matches as the plain join, from few blocks."""

import datetime as dt

import pytest
from conftest import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.asof import as_of_join
from tidemark.plans.retrieval import get_historical_features
from tidemark.sinks.history import ROWS, FeatureHistory
from tidemark.spec import FeatureTable, Field, FrameSource

KEY, VALUE = [Field("k", "int32")], [Field("v", "int32")]
FEATURES = "k int, event_timestamp timestamp, created_timestamp timestamp, v int"
START = dt.datetime(1969, 12, 28)


def at(hours):
    return str(START + dt.timedelta(hours=hours))


def features_at(frame, rows):
    """Rows of (key, hours, created hours, value)."""
    return frame(FEATURES, [(k, None if t is None else at(t), at(c), v) for k, t, c, v in rows])


def by_loops(spine, rows, max_hours):
    out = []
    for k, t in spine:
        best = [
            (ft, c, v is not None, v or 0)
            for fk, ft, c, v in rows
            if None not in (k, t, ft) and fk == k and ft <= t and (max_hours is None or ft >= t - max_hours)
        ]
        found = max(best, default=None)
        out.append((k, None if t is None else t, found[3] if found and found[2] else None))
    return sorted(out, key=repr)


KEYS = st.one_of(st.none(), st.integers(0, 2))
HOURS = st.one_of(st.none(), st.integers(0, 24 * 40))
ROW = st.tuples(KEYS, HOURS, st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    batches=st.lists(st.lists(ROW, max_size=25), min_size=1, max_size=4),
    rolled=st.sets(st.integers(0, 3)),
    spine=st.lists(st.tuples(KEYS, HOURS), max_size=8),
    max_hours=st.sampled_from([None, 30, 24 * 9]),
)
def test_same_rows_as_loops(spark, frame, tmp_path_factory, batches, rolled, spine, max_hours):
    table = FeatureTable("t", KEY, VALUE, max_hours and max_hours * 3600)
    history = FeatureHistory(spark, str(tmp_path_factory.mktemp("h")), table, fanout=2, levels=3)
    for i, rows in enumerate(batches):
        assert history.append(features_at(frame, rows), f"b{i}")
        if i in rolled:
            history.roll_up()
    points = frame("k int, at timestamp", [(k, None if t is None else at(t)) for k, t in spine])
    joined = as_of_join(points, "at", history.rows_for(points, "at"), table)
    hours = F.timestamp_diff("HOUR", F.lit(START), F.col("at")).cast("int")
    got = rows_of(joined.select("k", hours.alias("h"), "t__v"))
    assert got == by_loops(spine, [r for rows in batches for r in rows], max_hours)


@pytest.fixture
def days(spark, tmp_path):
    """Forty days, a row an hour, seven keys."""
    rows = spark.range(24 * 40).select(
        F.lit(1).cast("int").alias("one"),
        (F.col("id") % 7).cast("int").alias("k"),
        F.timestamp_seconds(F.col("id") * 3600).alias("event_timestamp"),
        F.timestamp_seconds(F.col("id") * 3600).alias("created_timestamp"),
        F.col("id").cast("int").alias("v"),
    )
    table = FeatureTable("t", KEY, VALUE)
    history = FeatureHistory(spark, str(tmp_path / "h"), table, fanout=4, levels=2)
    history.append(rows, "all")
    return rows, table, history


def test_only_own_days_and_few_blocks_are_read(spark, days):
    rows, table, history = days
    # Ten blocks of four days but the last, and two of sixteen days.
    assert history.roll_up() == 9 + 2 and history.roll_up() == 0
    spine = spark.sql("SELECT 3 k, timestamp'1970-02-07 12:00:00' at")
    day = 37
    found = {level: blocks for (_, level), blocks in history.places([day]).items()}
    assert found == {ROWS: {37}, 0: {36}, 1: {8}, 2: {0, 1}}
    kept = history.rows_for(spine, "at")
    assert kept.count() == 24 + 7 * 4
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((" in plan and "DataFilters: []" in plan
    same = rows_of(as_of_join(spine, "at", rows, table))
    assert rows_of(as_of_join(spine, "at", kept, table)) == same
    # A spine of all days reads all rows and no block; one after the end reads no row of a day.
    assert {n for _, n in history.places(range(40))} == {ROWS}
    after = spark.sql("SELECT 3 k, timestamp'1999-01-01' at")
    assert history.rows_for(after, "at").count() < 7 * 8
    assert rows_of(as_of_join(after, "at", history.rows_for(after, "at"), table)) == [
        (3, dt.datetime(1999, 1, 1), max(i for i in range(960) if i % 7 == 3))
    ]


def test_age_limit_cuts_what_is_read(spark, days):
    rows, table, history = days
    history.roll_up()
    limited = FeatureHistory(spark, history.path, FeatureTable("t", KEY, VALUE, 86_400), fanout=4, levels=2)
    assert {n: b for (_, n), b in limited.places([20]).items()} == {ROWS: {20}, 0: {19}}


def test_late_rows_count_before_and_after_the_roll_up(spark, frame, days):
    rows, table, history = days
    history.roll_up()
    late = frame(FEATURES, [(50, "1970-01-02 03:00:00", "1970-01-02 03:00:00", 77)])
    assert history.append(late, "late")
    spine = spark.sql("SELECT 50 k, timestamp'1970-02-07 12:00:00' at")
    for blocks in (1 + 1, 0):
        assert as_of_join(spine, "at", history.rows_for(spine, "at"), table).first()["t__v"] == 77
        assert history.roll_up() == blocks
    assert ("late", 0) not in history.places([37])


def test_a_tag_counts_once_and_half_a_batch_not_at_all(spark, frame, days):
    rows, table, history = days
    other = rows.withColumn("v", F.col("v") + 1)
    assert not history.append(other, "all")
    # A writer that died before its marker: neither read, nor in the way of its second run.
    history._write(spark.range(3).selectExpr("0 k", "0 _tm_level", "1L _tm_block"), "dead")
    assert history.places([1]) == {("all", ROWS): {1}, ("all", 0): {0}}
    assert history.append(other, "dead") and ("dead", ROWS) in history.places([1])
    with pytest.raises(ValueError):
        history.append(rows, "roll-1")


def test_roll_ups_side_by_side_and_sweep(spark, frame, days):
    rows, table, history = days
    twin = FeatureHistory(spark, history.path, table, fanout=4, levels=2)
    history.roll_up()
    late = frame(FEATURES, [(50, "1970-01-02 03:00:00", "1970-01-02 03:00:00", 77)])
    seen = twin._batches()
    history.append(late, "late")
    # The twin read the batches before the late one, and its manifest comes last.
    twin._batches, twin._manifest = lambda: seen, lambda name=None: (set(), {})
    assert twin.roll_up() == 11
    spine = spark.sql("SELECT 50 k, timestamp'1970-02-07 12:00:00' at")
    assert as_of_join(spine, "at", history.rows_for(spine, "at"), table).first()["t__v"] == 77
    history.roll_up()
    before = rows_of(history.rows_for(spine, "at"))
    assert history.sweep(keep=1) and not history.sweep(keep=1)
    assert rows_of(history.rows_for(spine, "at")) == before


def test_layout_is_fixed_and_nothing_is_no_match(spark, frame, tmp_path):
    table = FeatureTable("t", KEY, VALUE, tiebreak="n")
    history = FeatureHistory(spark, str(tmp_path / "h"), table)
    with pytest.raises(ValueError):
        FeatureHistory(spark, str(tmp_path / "h"), table, fanout=2)
    spine = frame("k int, at timestamp", [(1, "2021-03-01 01:00:00"), (None, None)])
    stamps = "2021-03-01 00:00:00"
    tied = frame(FEATURES + ", n int", [(1, stamps, stamps, v, n) for v, n in [(7, 1), (3, 2)]])
    for rows, value in ((None, None), (tied.limit(0), None), (tied, 3)):
        if rows is not None:
            history.append(rows, f"b{value}")
        source = history.source(spine, "at")
        declared = FeatureTable("t", KEY, VALUE, tiebreak="n", batch_source=source)
        joined = get_historical_features(spark, ["t:v"], FrameSource("at", df=spine), [declared])
        assert rows_of(joined, "k", "t__v") == sorted([(1, value), (None, None)], key=repr)
