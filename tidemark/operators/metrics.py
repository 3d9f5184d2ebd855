"""Figures about ingested rows: counts, lag, freshness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import add_seconds, epoch_micros
from tidemark.operators.mapping import quoted
from tidemark.spec import FeatureTable

LAG_PERCENTILES = {"p50": 0.5, "p75": 0.75, "p95": 0.95, "p98": 0.98, "p99": 0.99, "p999": 0.999}


def row_counts(df: DataFrame, check: Column) -> DataFrame:
    """Rows read, ingested and rejected, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(check).alias("rows_ingested"),
        F.count_if(~check).alias("rows_rejected"),
    )


def lag_millis(df: DataFrame, event_ts: str, now: Column) -> Column:
    """``now - event time`` in whole milliseconds."""
    kind = df.schema[event_ts].dataType
    return F.floor((epoch_micros(now, kind) - epoch_micros(quoted(event_ts), kind)) / 1000)


# Sketches of tasks, or of batches, meet in so many groups first.
SKETCH_GROUPS = 64


def sketch_size(accuracy: int) -> int:
    """The parameter of a KLL sketch whose ranks are within about one part in ``accuracy``."""
    return max(8, min(65_535, 7 * accuracy))


def _lag_parts(sketch: Column) -> list[Column]:
    return [
        F.sum("lag_count").alias("lag_count"),
        F.min("lag_min").alias("lag_min"),
        F.max("lag_max").alias("lag_max"),
        F.sum("lag_sum").alias("lag_sum"),
        sketch.alias("lag_sketch"),
    ]


def lag_sketches(df: DataFrame, event_ts: str, now: Column, by: Sequence[Column], accuracy: int = 10_000) -> DataFrame:
    """Per group ``by`` (a batch, a day): figures of the lag that can be merged, and a quantile sketch.

    Kept beside the batches, they answer for any span of them without a second scan. Within a group the
    tasks' sketches are merged in two steps, so that none gets one from each task.
    """
    size = sketch_size(accuracy)
    names = [f"_tm_by{i}" for i in range(len(by))]
    lags = df.select(*[c.alias(n) for c, n in zip(by, names)], lag_millis(df, event_ts, now).alias("lag"))
    parts = lags.groupBy(*names, F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_tm_part")).agg(
        F.count("lag").alias("lag_count"),
        F.min("lag").alias("lag_min"),
        F.max("lag").alias("lag_max"),
        F.sum("lag").alias("lag_sum"),
        F.kll_sketch_agg_bigint("lag", size).alias("lag_sketch"),
    )
    merged = parts.groupBy(*names).agg(*_lag_parts(F.kll_merge_agg_bigint("lag_sketch", size)))
    shown = [c for c in merged.columns if c not in names]
    titles = df.select(*by).columns
    return merged.select(*[F.col(n).alias(t) for n, t in zip(names, titles)], *shown)


def merge_lag_sketches(sketches: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """One row of :func:`lag_sketches` out of many, merged in two steps."""
    size = sketch_size(accuracy)
    merge = F.kll_merge_agg_bigint("lag_sketch", size)
    parts = sketches.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_tm_part")).agg(*_lag_parts(merge))
    return parts.agg(*_lag_parts(merge))


def sketched_lag(merged: DataFrame) -> DataFrame:
    """Count, least, greatest, mean and the percentiles of rows with a sketch; without any lag all but
    the count are NULL."""
    cut = {n: F.kll_sketch_get_quantile_bigint("lag_sketch", F.lit(share)) for n, share in LAG_PERCENTILES.items()}
    rest = [c for c in merged.columns if not c.startswith("lag_")]
    return merged.select(
        *[quoted(c) for c in rest],
        F.coalesce("lag_count", F.lit(0)).cast("bigint").alias("lag_count"),
        "lag_min",
        "lag_max",
        (F.col("lag_sum") / F.nullif("lag_count", F.lit(0))).alias("lag_mean"),
        *[F.when(F.col("lag_count") > 0, c).alias(f"lag_{n}") for n, c in cut.items()],
    )


def lag_figures(lag: Column, accuracy: int = 10_000) -> list[Column]:
    """Aggregates of a lag: exact figures and ``lag_cuts``, the approximate percentiles."""
    return [
        F.count(lag).alias("lag_count"),
        F.min(lag).alias("lag_min"),
        F.max(lag).alias("lag_max"),
        F.avg(lag).alias("lag_mean"),
        F.stddev_samp(lag).alias("lag_stddev"),
        F.percentile_approx(lag, list(LAG_PERCENTILES.values()), accuracy).alias("lag_cuts"),
    ]


def lag_by_name(row: Mapping[str, object]) -> dict[str, object]:
    """The figures out of a row of :func:`lag_figures`, by name."""
    plain = {c: row[c] for c in ("lag_count", "lag_min", "lag_max", "lag_mean", "lag_stddev")}
    cuts = row["lag_cuts"] or [None] * len(LAG_PERCENTILES)
    return plain | {f"lag_{n}": cut for n, cut in zip(LAG_PERCENTILES, cuts)}


def lag_stats(df: DataFrame, event_ts: str, now: Column, accuracy: int = 10_000) -> DataFrame:
    """Distribution of ``now - event time`` in milliseconds; the percentiles are approximate, from
    sketches that are merged in groups."""
    lag = df.select(lag_millis(df, event_ts, now).alias("lag"))
    plain = lag.agg(*lag_figures(F.col("lag"))[:-1])
    cuts = sketched_lag(merge_lag_sketches(lag_sketches(df, event_ts, now, [], accuracy), accuracy))
    return plain.join(F.broadcast(cuts.select(*[f"lag_{n}" for n in LAG_PERCENTILES])))


def freshness(
    df: DataFrame, by: str, event_ts: str, max_ages: Mapping[str, int | None], now: Column
) -> DataFrame:
    """Per feature table (column ``by``): its last event time and whether it passes.

    A table fails when ``now - max_age`` is past its last event; without an age limit, or
    without any row yet, it passes. Every table of ``max_ages`` gets a row.
    """
    declared = df.sparkSession.createDataFrame(
        [(name, age) for name, age in max_ages.items()], "feature_table string, max_age int"
    )
    last = df.groupBy(quoted(by).alias("feature_table")).agg(
        F.max(quoted(event_ts)).alias("last_event")
    )
    stale = F.col("last_event") < add_seconds(now, -F.col("max_age"))
    return declared.join(last, on="feature_table", how="left").select(
        "feature_table", "last_event", F.coalesce(~stale, F.lit(True)).alias("passed")
    )


def stored_freshness(store, tables: Sequence[FeatureTable], now: Column) -> DataFrame:
    """:func:`freshness` of an online store's tables, by the times noted with its batches and runs:
    no row of the store is read."""
    kind = store.spark.range(0).select(now.alias("now")).schema["now"].dataType
    rows = [(t.name, t.max_age, at) for t, at in zip(tables, store.last_events(tables).values())]
    noted = store.spark.createDataFrame(rows, "feature_table string, max_age int, micros bigint")
    last = F.timestamp_micros("micros")
    if kind == T.TimestampNTZType():
        last = F.convert_timezone(F.current_timezone(), F.lit("UTC"), last.cast(kind))
    noted = noted.withColumn("last_event", last)
    stale = F.col("last_event") < add_seconds(now, -F.col("max_age"))
    return noted.select("feature_table", "last_event", F.coalesce(~stale, F.lit(True)).alias("passed"))


def health(
    df: DataFrame, by: str, event_ts: str, tables: Sequence[FeatureTable], now: Column
) -> dict[str, list[str]]:
    """Names of the tables that pass and that fail :func:`freshness`, in the order given."""
    rows = freshness(df, by, event_ts, {t.name: t.max_age for t in tables}, now).collect()
    passed = {r["feature_table"] for r in rows if r["passed"]}
    return {
        "passed": [t.name for t in tables if t.name in passed],
        "failed": [t.name for t in tables if t.name not in passed],
    }
