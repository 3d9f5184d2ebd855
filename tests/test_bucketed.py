"""Features stored by key: the same rows as the plain join, and no shuffle of them."""

import re

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.operators.asof import SkewPolicy, as_of_join
from tidemark.sinks.bucketed import join_bucketed, write_bucketed
from tidemark.spec import FeatureTable, Field

KEYS = [Field("user", "int32"), Field("kind", "string")]
TABLE = FeatureTable("t", KEYS, [Field("v", "int32")], 7200, tiebreak="n")


def made(spark, rows, step):
    """A third of the rows on one key; some without a key or a time; repeated times."""
    ids = spark.range(rows).select((F.col("id") * step).alias("n"))
    return ids.select(
        F.expr("CASE WHEN n % 3 = 0 THEN 0 WHEN n % 31 = 0 THEN NULL ELSE n % 11 END").cast("int").alias("user"),
        F.expr("CASE WHEN n % 3 = 0 THEN 'a' ELSE string(n % 2) END").alias("kind"),
        F.expr("CASE WHEN n % 41 <> 0 THEN timestamp_seconds(n div 2 * 60) END").alias("event_timestamp"),
        F.timestamp_seconds(F.lit(0)).alias("created_timestamp"),
        (F.col("n") % 97).cast("int").alias("v"),
        "n",
    )


def shuffled_scans(plan):
    """Lines of scans below an exchange, by indentation."""
    found, open_at = [], None
    for line in plan.splitlines():
        depth = len(re.match(r"[\s:|+\-]*", line).group())
        if open_at is not None and depth <= open_at:
            open_at = None
        if "Exchange hashpartitioning" in line and open_at is None:
            open_at = depth
        elif "FileScan" in line and open_at is not None:
            found.append(line)
    return found


@pytest.mark.parametrize("hot_rows", [10**6, 50])
def test_same_rows_and_features_stay(spark, tmp_path, hot_rows):
    policy = SkewPolicy(hot_rows=hot_rows, least_row_bytes=0 if hot_rows == 50 else 8, sketch_share=1)
    features = made(spark, 600, 2)
    made(spark, 400, 3).withColumnRenamed("event_timestamp", "at").drop("v").write.parquet(str(tmp_path / "s"))
    spine, path = spark.read.parquet(str(tmp_path / "s")), str(tmp_path / "t")
    write_bucketed(features, TABLE, f"stored_{hot_rows}", path, 6, policy)
    assert (spark.read.parquet(f"{path}/hot").count() > 0) == (hot_rows == 50)
    joined = join_bucketed(spine, "at", TABLE, path, policy)
    plain = as_of_join(spine, "at", features, TABLE, "window")
    assert rows_of(joined) == rows_of(plain) and joined.filter("t__v IS NOT NULL").count() > 50
    if hot_rows > 50:
        plan = joined._jdf.queryExecution().executedPlan().toString()
        scans = shuffled_scans(plan)
        assert scans and not any("stored_" in s for s in scans) and "Bucketed: true" in plan


def test_no_features_and_no_spine(spark, tmp_path):
    path = str(tmp_path / "t")
    spine = made(spark, 5, 1).withColumnRenamed("event_timestamp", "at").drop("v")
    write_bucketed(made(spark, 0, 1), TABLE, "stored_none", path, 3)
    assert [r["t__v"] for r in join_bucketed(spine, "at", TABLE, path).collect()] == [None] * 5
    assert join_bucketed(spine.limit(0), "at", TABLE, path).collect() == []
