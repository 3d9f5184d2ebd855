"""Key filters, lag sketches, uniqueness, the schema registry with several writers, staged copies."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.checks import Rule, prepare_suite
from tidemark.operators.asof import SkewPolicy, _key_filter_bits, as_of_join, filter_by_keys
from tidemark.operators.metrics import lag_sketches, lag_stats, merge_lag_sketches, sketched_lag
from tidemark.operators.online import schema_reference
from tidemark.operators.validate import check_counts, mark_unique
from tidemark.sinks.registry import read_schemas, register_schema
from tidemark.sources.staging import stage_rows_by_day, sweep_staged
from tidemark.spec import FeatureTable, Field


def test_key_filter_drops_no_key_of_the_spine(spark):
    spine = spark.range(0, 40_000, 7).select(F.concat(F.lit("key"), "id").alias("k"), F.lit(None).alias("x"))
    features = spark.range(100_000).select(F.concat(F.lit("key"), "id").alias("k"), F.col("id").alias("v"))
    bits = _key_filter_bits(spine.count(), SkewPolicy())
    assert bits == 1 << 17
    kept = filter_by_keys(features, ["k"], spine, bits)
    assert kept.columns == features.columns
    assert kept.join(spine, "k", "left_semi").count() == spine.count()
    assert kept.count() < spine.count() + 0.1 * features.count()
    assert filter_by_keys(features, ["k"], spine.filter("false"), bits).count() == 0
    # Too many keys for the bytes that may be sent out: no filter.
    assert _key_filter_bits(10**9, SkewPolicy()) == 0 and _key_filter_bits(10**7, SkewPolicy()) <= 64 * 8 << 20


def test_features_are_filtered_before_they_are_shuffled(spark, tmp_path):
    spark.range(0, 20_000, 9).selectExpr("id k", "timestamp_seconds(1000) ts").write.parquet(str(tmp_path / "s"))
    spark.range(60_000).selectExpr(
        "id k", "timestamp_seconds(500 + id % 100) event_timestamp", "timestamp_seconds(1000) created_timestamp", "id v"
    ).write.parquet(str(tmp_path / "f"))
    spine, features = spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "f"))
    table = FeatureTable("t", [Field("k", "int64")], [Field("v", "int64")], 1_000)
    policy = SkewPolicy(least_row_bytes=0, broadcast_bytes=0)
    with_filter = as_of_join(spine, "ts", features, table, policy=policy)
    plan = with_filter._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan and "BroadcastHashJoin" in plan
    without = as_of_join(spine, "ts", features, table, strategy="window")
    assert with_filter.exceptAll(without).count() == 0 and with_filter.count() == without.count() == spine.count()


def test_lag_of_merged_batches(spark):
    now = F.expr("timestamp_seconds(2000000)")
    df = spark.range(200_000).select(
        F.timestamp_millis(F.pmod(F.xxhash64("id"), F.lit(10**9))).alias("ts"), (F.col("id") % 7).alias("batch")
    ).repartition(20)
    kept = lag_sketches(df, "ts", now, [F.col("batch")], accuracy=500)
    assert kept.count() == 7
    merged = sketched_lag(merge_lag_sketches(kept.filter("batch < 4"), accuracy=500)).first()
    rows = df.filter("batch < 4").select((2_000_000_000 - F.unix_millis("ts")).alias("lag")).sort("lag").toPandas()["lag"]
    assert (merged["lag_count"], merged["lag_min"], merged["lag_max"]) == (len(rows), rows.min(), rows.max())
    assert merged["lag_mean"] == pytest.approx(rows.mean())
    for name, share in {"p50": 0.5, "p75": 0.75, "p99": 0.99}.items():
        assert abs(rows.searchsorted(merged[f"lag_{name}"]) / len(rows) - share) < 1 / 500
    none = sketched_lag(merge_lag_sketches(lag_sketches(df.filter("false"), "ts", now, []))).first()
    assert none["lag_count"] == 0 and none["lag_p50"] is None
    assert lag_stats(df.filter("false"), "ts", now).first()["lag_count"] == 0


def test_no_task_gets_a_sketch_from_every_task(spark):
    df = spark.range(1_000).select(F.timestamp_seconds("id").alias("ts")).repartition(100)
    plan = lag_stats(df, "ts", F.current_timestamp())._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile_approx" not in plan and plan.count("kll_merge_agg_bigint") >= 2


def test_uniqueness(spark):
    rows = [(1, "a", 1.0), (1, "a", 2.0), (1, "b", 3.0), (None, "c", 4.0), (None, "c", 5.0), (None, None, 6.0), (None, None, 7.0)]
    df = spark.createDataFrame(rows, "k int, `t.x` string, v double")
    rules = prepare_suite(
        [
            Rule("expect_column_values_to_be_unique", {"column": "tab__k"}),
            Rule("expect_compound_columns_to_be_unique", {"column_list": ["tab__k", "t.x"]}),
            Rule("expect_column_values_to_be_unique", {"column": "v"}),
            Rule("expect_column_values_to_be_unique", {"column": "absent"}),
        ],
        "tab",
    )
    counts = rows_of(check_counts(df, rules), "check_name", "violations", "errored")
    assert counts == sorted(
        [
            ("expect_column_values_to_be_unique_k", 3, 0),
            ("expect_compound_columns_to_be_unique_k_t.x", 4, 0),
            ("expect_column_values_to_be_unique_v", 0, 0),
            ("expect_column_values_to_be_unique_absent", 0, 7),
        ],
        key=repr,
    )
    marked = mark_unique(df, rules)
    assert marked.columns == ["k", "t.x", "v", "_unique0", "_unique1", "_unique2", "_unique3"]
    flags = {r["v"]: (r["_unique0"], r["_unique1"], r["_unique2"], r["_unique3"]) for r in marked.collect()}
    assert flags == {
        1.0: (False, False, True, None),
        2.0: (False, False, True, None),
        3.0: (False, True, True, None),
        4.0: (True, False, True, None),
        5.0: (True, False, True, None),
        6.0: (True, True, True, None),
        7.0: (True, True, True, None),
    }
    assert mark_unique(df.filter("false"), rules).count() == 0
    plan = check_counts(df, rules[:1])._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_registry_with_several_writers(spark, tmp_path):
    path = str(tmp_path / "schemas")
    schemas = [T.StructType([T.StructField(f"f{i}", T.LongType())]) for i in range(3)]
    with ThreadPoolExecutor(6) as pool:
        made = list(pool.map(lambda i: register_schema(spark, path, schemas[i % 3]), range(12)))
    rows = read_schemas(spark, path).collect()
    assert sum(made) >= 3 and len(rows) == 3
    assert {bytes(r[0]): r[1] for r in rows} == {schema_reference(s): s.json() for s in schemas}
    # A writer that broke off leaves an empty file, which counts as none and is replaced.
    other = T.StructType([T.StructField("g", T.StringType())])
    broken = tmp_path / "schemas" / f"schema-{schema_reference(other).hex()}.json"
    broken.write_text("")
    assert read_schemas(spark, path).count() == 3
    assert register_schema(spark, path, other, patience=0.1) and not register_schema(spark, path, other)
    assert read_schemas(spark, path).count() == 4
    taken = tmp_path / "schemas" / f"schema-{schema_reference(schemas[0]).hex()}.json"
    for aside in taken.parent.glob(f".{taken.name}.crc"):
        aside.unlink()
    taken.write_text(other.json())
    with pytest.raises(ValueError, match="another schema"):
        register_schema(spark, path, schemas[0])


def test_staged_copies_past_their_day_are_swept(spark, tmp_path):
    now = dt.datetime(2021, 5, 1, 12, tzinfo=dt.timezone.utc)
    df = spark.sql("SELECT 1 k, timestamp'2021-01-01 00:00:00' ts")
    old = stage_rows_by_day(spark, df, "ts", str(tmp_path), now - dt.timedelta(days=1))
    new = stage_rows_by_day(spark, df, "ts", str(tmp_path), now)
    (tmp_path / "entities-until-soon").mkdir()
    assert sweep_staged(spark, str(tmp_path), now) == [old.path.rsplit("/", 1)[1]]
    assert sweep_staged(spark, str(tmp_path), now) == [] and spark.read.parquet(new.path).count() == 1
    assert (tmp_path / "entities-until-soon").exists()
