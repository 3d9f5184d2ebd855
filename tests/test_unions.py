"""Unions of inputs that are already placed by key."""

from conftest import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.asof import as_of_join
from tidemark.operators.unions import union_rows
from tidemark.spec import FeatureTable, Field


def placed(spark, rows, value):
    """One row per key out of an aggregate, joined by key: placed by ``k``."""
    some = spark.range(rows).select((F.col("id") % 40).cast("int").alias("k"))
    kept = spark.range(40).select(F.col("id").cast("int").alias("k")).distinct()
    return some.join(kept, "k", "left_semi").groupBy("k").agg(F.count("*").cast("int").alias(value))


def test_keys_of_placed_inputs_meet(spark):
    a, b = placed(spark, 80, "n"), placed(spark, 400_000, "n")
    once = F.row_number().over(Window.partitionBy("k").orderBy("n"))
    union = union_rows([a, b], ["k"]).withColumn("i", once)
    wanted = spark.range(100).select((F.col("id") % 50).cast("int").alias("k")).distinct()
    got = wanted.join(union.filter("i = 2"), "k", "left")
    assert rows_of(got.filter("n IS NOT NULL"), "k", "n") == [(k, 10_000) for k in sorted(range(40), key=lambda k: repr((k, 10_000)))]


def test_join_of_placed_spine_and_features(spark):
    spine = placed(spark, 80, "n").withColumn("at", F.timestamp_seconds(F.lit(100)))
    features = placed(spark, 400_000, "v").select(
        "k",
        "v",
        F.timestamp_seconds(F.lit(50)).alias("event_timestamp"),
        F.timestamp_seconds(F.lit(50)).alias("created_timestamp"),
    )
    table = FeatureTable("t", [Field("k", "int32")], [Field("v", "int32")], 60)
    for strategy in ("window", "auto", "sliced"):
        joined = as_of_join(spine, "at", features, table, strategy)
        assert [r[1] for r in rows_of(joined, "k", "t__v")] == [10_000] * 40
