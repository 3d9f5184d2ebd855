"""Point-in-time joins: golden rows, then random tables against a brute-force model."""

import dataclasses

import pytest
from conftest import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.asof import (
    SkewPolicy,
    as_of_join,
    join_feature_tables,
    nearest_feature_rows,
    prune_to_spine,
    spine_bounds,
    spine_stats,
)
from tidemark.spec import FeatureTable, Field, SchemaError

TRIPS = FeatureTable("trips", [Field("driver", "int32")], [Field("total", "int32")], 86_400)
FEATURES = "driver int, event_timestamp timestamp, created_timestamp timestamp, total int"
SPINE = "driver int, at timestamp"


@pytest.fixture
def trips(frame):
    return frame(
        FEATURES,
        [
            (1, "2021-03-01 00:00:00", "2021-03-01 00:00:00", 10),
            (1, "2021-03-02 00:00:00", "2021-03-02 00:00:00", 20),
            (1, "2021-03-02 00:00:00", "2021-03-03 00:00:00", 21),
            (2, "2021-03-01 12:00:00", "2021-03-01 12:00:00", 30),
            (2, "2021-03-01 18:00:00", "2021-03-01 18:00:00", None),
            (None, "2021-03-01 18:00:00", "2021-03-01 18:00:00", 99),
        ],
    )


STRATEGIES = ["auto", "window", "sliced", "broadcast"]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_rules_of_the_match(frame, trips, strategy):
    spine = frame(
        SPINE,
        [
            (1, "2021-02-28 23:59:59"),
            (1, "2021-03-01 00:00:00"),
            (1, "2021-03-01 23:59:59.999999"),
            (1, "2021-03-03 00:00:00"),
            (1, "2021-03-03 00:00:00.000001"),
            (2, "2021-03-01 17:00:00"),
            (2, "2021-03-01 18:30:00"),
            (3, "2021-03-01 18:30:00"),
            (None, "2021-03-01 18:30:00"),
            (2, None),
        ],
    )
    joined = as_of_join(spine, "at", trips, TRIPS, strategy)
    assert joined.columns == ["driver", "at", "trips__total"]
    got = {(r[0], str(r[1])): r[2] for r in joined.collect()}
    assert got == {
        (1, "2021-02-28 23:59:59"): None,
        (1, "2021-03-01 00:00:00"): 10,
        (1, "2021-03-01 23:59:59.999999"): 10,
        (1, "2021-03-03 00:00:00"): 21,  # the later created row, exactly max_age old
        (1, "2021-03-03 00:00:00.000001"): None,
        (2, "2021-03-01 17:00:00"): 30,
        (2, "2021-03-01 18:30:00"): None,  # the latest row counts, also with a NULL value
        (3, "2021-03-01 18:30:00"): None,
        (None, "2021-03-01 18:30:00"): None,
        (2, "None"): None,
    }


def test_no_age_limit_and_duplicate_spine_rows(frame, trips):
    spine = frame(SPINE, [(1, "2022-01-01 00:00:00")] * 3)
    table = dataclasses.replace(TRIPS, max_age=None)
    assert [r[2] for r in as_of_join(spine, "at", trips, table).collect()] == [21, 21, 21]


def test_created_after_the_spine_row_still_counts(frame):
    spine = frame(SPINE, [(1, "2021-03-01 01:00:00")])
    late = frame(FEATURES, [(1, "2021-03-01 00:30:00", "2021-03-09 00:00:00", 5)])
    assert as_of_join(spine, "at", late, TRIPS).first()[2] == 5


def test_ties_are_resolved_by_tiebreak_then_values(frame):
    spine = frame(SPINE, [(1, "2021-03-01 01:00:00")])
    tied = frame(
        FEATURES + ", version int",
        [(1, "2021-03-01 00:00:00", "2021-03-01 00:00:00", v, n) for v, n in [(7, 1), (3, 2)]],
    )
    assert as_of_join(spine, "at", tied, TRIPS).first()[2] == 7
    by_version = dataclasses.replace(TRIPS, tiebreak="version")
    assert as_of_join(spine, "at", tied, by_version).first()[2] == 3


def test_empty_spine_and_empty_features(frame, trips):
    empty = frame(SPINE, [])
    for strategy in STRATEGIES:
        assert as_of_join(empty, "at", trips, TRIPS, strategy).collect() == []
    spine = frame(SPINE, [(1, "2021-03-01 00:00:00")])
    for strategy in STRATEGIES:
        nothing = as_of_join(spine, "at", trips.limit(0), TRIPS, strategy)
        assert nothing.first()["trips__total"] is None


def test_several_tables_with_own_keys_and_ages(frame, trips):
    spine = frame("driver int, rider string, at timestamp", [(1, "a", "2021-03-02 12:00:00")])
    ratings = FeatureTable(
        "ratings",
        [Field("rider", "string"), Field("driver", "int32")],
        [Field("stars", "float")],
        None,
    )
    riders = FeatureTable("riders", [Field("rider", "string")], [Field("age", "int64")], 60)
    calls = dataclasses.replace(TRIPS, name="calls", max_age=3600)
    stamp = "event_timestamp timestamp, created_timestamp timestamp"
    at = ("2021-03-02 11:30:00", "2021-03-02 11:30:00")
    frames = [
        frame(f"rider string, driver int, stars float, {stamp}", [("a", 1, 4.5, *at), ("b", 1, 1.0, *at)]),
        frame(f"rider string, age bigint, {stamp}", [("a", 40, *at)]),
        trips,
        frame(f"driver int, total int, {stamp}", [(1, 3, *at)]),
    ]
    joined = join_feature_tables(spine, "at", frames, [ratings, riders, TRIPS, calls])
    assert joined.columns == [
        "driver",
        "rider",
        "at",
        "ratings__stars",
        "riders__age",
        "trips__total",
        "calls__total",
    ]
    assert tuple(joined.first())[3:] == (4.5, None, 21, 3)


def test_timestamps_of_another_kind_are_an_error(frame, trips):
    spine = frame("driver int, at timestamp_ntz", [(1, "2021-03-01 00:00:00")])
    with pytest.raises(SchemaError):
        as_of_join(spine, "at", trips, TRIPS)
    with pytest.raises(ValueError):
        as_of_join(spine.withColumn("at", F.col("at").cast("timestamp")), "at", trips, TRIPS, "fast")


def test_pruning_to_the_spine(frame, trips):
    spine = frame(SPINE, [(1, "2021-03-02 12:00:00"), (1, "2021-03-02 13:00:00"), (1, None)])
    low, high = spine_bounds(spine, "at")
    assert high - low == 3_600_000_000
    kept = prune_to_spine(trips, TRIPS, low, high)
    assert rows_of(kept, "total") == [(20,), (21,), (30,), (99,), (None,)]
    unlimited = dataclasses.replace(TRIPS, max_age=None)
    assert prune_to_spine(trips, unlimited, low, high).count() == 6
    assert prune_to_spine(trips, TRIPS, None, None).count() == 6


def test_nearest_rows_per_spine_point(frame, trips):
    spine = frame(SPINE, [(1, "2021-03-02 12:00:00"), (1, "2021-03-02 12:00:00"), (3, "2021-03-02 12:00:00")])
    near = nearest_feature_rows(trips, TRIPS, spine, "at")
    assert [(r["driver"], r["total"], r["event_timestamp_entity"].hour) for r in near.collect()] == [
        (1, 21, 12)
    ]


def test_too_large_spine_is_joined_without_a_broadcast(frame, trips):
    spine = frame(SPINE, [(1, "2021-03-01 00:00:00"), (2, "2020-09-02 00:00:00")])
    small = SkewPolicy(broadcast_bytes=1)
    joined = as_of_join(spine, "at", trips, TRIPS, "broadcast", small)
    assert rows_of(joined) == rows_of(as_of_join(spine, "at", trips, TRIPS, "window"))
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    near = nearest_feature_rows(trips, TRIPS, spine, "at", "broadcast", small)
    assert "Broadcast" not in near._jdf.queryExecution().executedPlan().toString()
    assert rows_of(near) == rows_of(nearest_feature_rows(trips, TRIPS, spine, "at", "window"))
    with pytest.raises(ValueError):
        nearest_feature_rows(trips, TRIPS, spine, "at", "brodcast")


def test_hot_keys_are_found(spark):
    spine = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int").alias("driver"),
        F.timestamp_seconds("id").alias("at"),
    )
    policy = SkewPolicy(hot_rows=500, sketch_share=1)
    hot = spine_stats(spine, "at", [("driver",)], policy).hot[("driver",)]
    zero = spine.select(F.xxhash64("driver")).first()[0]
    assert set(hot) == {zero} and 900 <= hot[zero] <= 1100


ROW = st.tuples(st.integers(0, 2) | st.none(), st.integers(0, 12) | st.none())
FEATURE = st.tuples(
    st.integers(0, 2) | st.none(),
    st.integers(0, 12) | st.none(),
    st.integers(0, 2) | st.none(),
    st.integers(0, 9) | st.none(),
)


def model(spine, features, max_age):
    out = []
    for key, at in spine:
        best = None
        for fkey, fat, created, value in features:
            if None in (key, at, fkey, fat) or fkey != key or fat > at:
                continue
            if max_age is not None and fat < at - max_age:
                continue
            rank = (fat, -1 if created is None else created, -1 if value is None else value)
            if best is None or rank > best[0]:
                best = (rank, value)
        out.append((key, at, best and best[1]))
    return sorted(out, key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(ROW, max_size=12),
    st.lists(FEATURE, max_size=14),
    st.sampled_from([None, 1, 4]),
    st.sampled_from(
        [
            ("window", SkewPolicy()),
            ("sliced", SkewPolicy(slices=4)),
            ("auto", SkewPolicy(hot_rows=3, max_hot_keys=8, tracked_keys=16, sketch_share=1)),
            ("auto", SkewPolicy(broadcast_ratio=0)),
        ]
    ),
)
def test_against_brute_force(spark, spine, features, max_age, plan):
    seconds = lambda c: F.timestamp_seconds(c)
    spine_df = spark.createDataFrame(spine, "driver int, at int")
    feature_df = spark.createDataFrame(features, "driver int, fat int, made int, total int")
    table = dataclasses.replace(TRIPS, max_age=max_age)
    joined = as_of_join(
        spine_df.withColumn("at", seconds("at")),
        "at",
        feature_df.select(
            "driver",
            "total",
            seconds("fat").alias("event_timestamp"),
            seconds("made").alias("created_timestamp"),
        ),
        table,
        *plan,
    )
    got = rows_of(joined.withColumn("at", F.unix_seconds("at")))
    assert got == model(spine, features, max_age)


@pytest.mark.parametrize("ties", [False, True])
def test_hot_key_gives_the_same_rows_as_one_window(spark, ties):
    """A third of all rows on one key; with ``ties`` most of them at a single time."""
    base = spark.range(4000)
    at = F.when((F.col("id") % 3 == 0) & (F.col("id") % 10 != 0), 100).otherwise(F.col("id"))
    at = at if ties else F.col("id")
    rows = base.select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("int").alias("driver"),
        F.timestamp_seconds(at).alias("at"),
    )
    spine = rows.filter("id % 2 = 0")
    features = rows.filter("id % 2 = 1").select(
        "driver",
        F.col("id").cast("int").alias("total"),
        F.col("at").alias("event_timestamp"),
        F.col("at").alias("created_timestamp"),
    )
    table = dataclasses.replace(TRIPS, max_age=500)
    plain = as_of_join(spine, "at", features, table, "window")
    policy = SkewPolicy(hot_rows=300, sketch_share=1)
    split = as_of_join(spine, "at", features, table, "auto", policy)
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


def test_key_sets_do_not_influence_each_other(spark):
    """Several key sets at once, with NULL keys and copies, against one join after the other."""
    rows = spark.range(600).select(
        F.when(F.col("id") % 11 != 0, F.col("id") % 5).cast("int").alias("driver"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 3).cast("string").alias("rider"),
        F.col("id").cast("int").alias("total"),
        F.timestamp_seconds(F.when(F.col("id") % 13 != 0, F.col("id") % 90)).alias("at"),
    )
    spine = rows.filter("total % 2 = 0")
    features = rows.filter("total % 2 = 1").select(
        "driver", "rider", "total", F.col("at").alias("event_timestamp"), F.col("at").alias("created_timestamp")
    )
    spine = spine.drop("total")
    by_driver = dataclasses.replace(TRIPS, max_age=20)
    by_rider = FeatureTable("riders", [Field("rider", "string")], by_driver.features, 5)
    by_both = FeatureTable("both", [Field("rider", "string"), Field("driver", "int32")], by_driver.features)
    tables = [by_both, by_driver, by_rider]
    step = spine
    for table in tables:
        step = as_of_join(step, "at", features, table, "window")
    for policy in (SkewPolicy(), SkewPolicy(hot_rows=40, sketch_share=1, tracked_keys=4096)):
        at_once = join_feature_tables(spine, "at", [features] * 3, tables, "auto", policy)
        assert at_once.columns == step.columns
        assert at_once.exceptAll(step).count() == 0 and step.exceptAll(at_once).count() == 0
