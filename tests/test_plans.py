"""Shapes of physical plans that matter at scale."""

import dataclasses

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.operators import online
from tidemark.operators.asof import SkewPolicy, join_feature_tables
from tidemark.plans.retrieval import get_historical_features
from tidemark.spec import FeatureTable, Field, FileSource, FrameSource

KEY = [Field("k", "int64")]
VALUE = [Field("v", "int64")]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return physical(df).count("Exchange hashpartitioning")


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows = spark.range(200).select(
        (F.col("id") % 7).alias("k"),
        F.timestamp_seconds(F.col("id") * 3600).alias("ts"),
        F.col("id").alias("v"),
        F.lit("x").alias("unused"),
    )
    rows.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(path)
    return path


def canonical(df):
    return df.select(
        "k", "v", F.col("ts").alias("event_timestamp"), F.col("ts").alias("created_timestamp")
    )


def test_tables_with_the_same_keys_share_one_shuffle(spark, stored):
    rows = spark.read.parquet(stored)
    tables = [FeatureTable(n, KEY, VALUE, 60) for n in "abc"]
    spine = rows.select("k", "ts")
    joined = join_feature_tables(spine, "ts", [canonical(rows)] * 3, tables, "window")
    assert shuffles(joined) == 1 and physical(joined).count("Window") == 1
    other = FeatureTable("d", [Field("v", "int64")], [Field("k", "int64")], 60)
    spine = rows.select("k", "v", "ts")
    joined = join_feature_tables(
        spine, "ts", [canonical(rows)] * 4, [*tables, other], "window"
    )
    # One for the first key set; for the second its points, their window and the join.
    assert shuffles(joined) <= 4 and physical(joined).count("Window ") == 2
    assert "CartesianProduct" not in physical(joined) and "NestedLoop" not in physical(joined)


def test_retrieval_reads_only_partitions_in_reach(spark, stored):
    source = FileSource("ts", "ts", path=stored, date_partition_column="day")
    table = FeatureTable("t", KEY, VALUE, 3600, batch_source=source)
    spine = spark.sql("SELECT 4L k, timestamp'1970-01-04 13:30:00' event_timestamp")
    # As for inputs whose size alone does not tell that measuring is not worth it.
    policy = SkewPolicy(least_row_bytes=0)
    joined = get_historical_features(spark, ["t:v"], spine, [table], policy=policy)
    assert any("day#" in x.split("]")[0] for x in physical(joined).split("PartitionFilters: [")[1:])
    assert "1970-01-03" in physical(joined) and "1970-01-05" in physical(joined)
    plain = dataclasses.replace(source, date_partition_column=None)
    same = get_historical_features(
        spark, ["t:v"], spine, [dataclasses.replace(table, batch_source=plain)]
    )
    assert rows_of(joined) == rows_of(same)


def test_latest_row_is_reduced_before_the_shuffle(spark, stored):
    plan = physical(online.latest_per_key(spark.read.parquet(stored).drop("day"), ["k"], "ts"))
    before, after = plan.split("Exchange hashpartitioning")
    assert "partial_max" in after and "partial_max" not in before


def test_a_log_is_folded_in_one_shuffle(spark, stored, tmp_path):
    table = FeatureTable("t", KEY, VALUE, 60)
    log = online.log_rows(spark.read.parquet(stored), table, "ts", 0)
    log.write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert shuffles(online.fold_table(log, table)) == 1
    assert shuffles(online.fold_table(log, table, "row")) == 1
    assert shuffles(online.fold_expiry([log, log, log], ["k"])) == 1


def test_checkpoint_cuts_the_plan(spark, stored, tmp_path):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path / "checkpoints"))
    rows = spark.read.parquet(stored)
    source = FrameSource("ts", "ts", df=rows)
    tables = [
        FeatureTable("a", KEY, VALUE, 7200, batch_source=source),
        FeatureTable("b", [Field("v", "int64")], [Field("k", "int64")], 60, batch_source=source),
    ]
    spine = FrameSource("ts", df=rows.select("k", "v", "ts"))
    refs = ["a:v", "b:k"]
    cut = get_historical_features(spark, refs, spine, tables, checkpoint=True)
    assert "Window" not in physical(cut)
    assert rows_of(cut) == rows_of(get_historical_features(spark, refs, spine, tables))
