"""One query per operator, each over the whole of the tables it reads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import checks
from tidemark.functions.scalars import entity_key, key_text
from tidemark.operators import online
from tidemark.operators.asof import SkewPolicy, nearest_feature_rows, prune_to_spine, spine_bounds
from tidemark.operators.mapping import map_fields, schema_differences
from tidemark.operators.metrics import LAG_PERCENTILES, freshness, health, lag_sketches, lag_stats, merge_lag_sketches, row_counts, sketched_lag, stored_freshness
from tidemark.operators.unions import union_rows
from tidemark.operators.validate import check_counts, check_observed, mark_unique, split_valid
from tidemark.plans.ingestion import ingest_batch, project_input
from tidemark.plans.retrieval import get_historical_features, read_features, retrieve_historical_features
from tidemark.sinks.bucketed import join_bucketed, write_bucketed
from tidemark.sinks.history import FeatureHistory
from tidemark.sinks.online import OnlineStore
from tidemark.sinks.registry import read_schemas, register_schema
from tidemark.sinks.training import export_epoch
from tidemark.sources.batch import scan_range
from tidemark.sources.decode import JsonFormat, decode_messages
from tidemark.sources.staging import scratch_path, stage_rows, stage_rows_by_day, sweep_staged
from tidemark.sources.stream import MESSAGE_TIME
from tidemark.spec import (
    GC_THRESHOLD_LABEL,
    FeatureTable,
    Field,
    FileSource,
    FileStreamSource,
    FrameSource,
    TableSource,
    apply_validation,
)
from tidemark.streaming.ingest import ingest_stream
from tidemark.streaming.progress import recent_progress

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


USER = (Field("user_id", "int64"),)
USER_TYPE = (Field("user_id", "int64"), Field("event_type", "string"))
VALUE = (Field("value", "double"),)
DAY = 86_400


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def numbered(df: DataFrame) -> DataFrame:
    """With ``k`` out of the JSON column, to split the table in two."""
    return df.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def purchases(df: DataFrame) -> DataFrame:
    return df.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")


def feature_source(df: DataFrame) -> FrameSource:
    stamped = df.withColumn("created_ts", F.expr("ts + INTERVAL 5 MINUTES"))
    return FrameSource("ts", "created_ts", df=stamped)


def features_of(df: DataFrame, kind: str, name: str, max_age: int | None) -> FeatureTable:
    return FeatureTable(
        name,
        USER,
        VALUE,
        max_age,
        batch_source=feature_source(df.filter(F.col("event_type") == kind)),
        tiebreak="event_id",
    )


def spine_of(df: DataFrame) -> FrameSource:
    return FrameSource("ts", df=df)


def odd_even(df: DataFrame, max_age: int | None) -> tuple[DataFrame, FeatureTable]:
    split = numbered(df)
    spine = split.filter("k % 2 = 1").select("event_id", "user_id", "event_type", "ts")
    table = FeatureTable(
        "even",
        USER_TYPE,
        VALUE,
        max_age,
        batch_source=feature_source(split.filter("k % 2 = 0")),
        tiebreak="event_id",
    )
    return spine, table


# Point-in-time joins


@query
def asof_single(spark, sf_dir):
    ev = events(spark, sf_dir)
    tables = [features_of(ev, "click", "clicks", DAY)]
    return get_historical_features(spark, ["clicks:value"], spine_of(purchases(ev)), tables)


@query
def asof_composite(spark, sf_dir):
    spine, table = odd_even(events(spark, sf_dir), DAY)
    return get_historical_features(spark, ["even:value"], spine_of(spine), [table])


@query
def asof_no_max_age(spark, sf_dir):
    spine, table = odd_even(events(spark, sf_dir), None)
    return get_historical_features(spark, ["even:value"], spine_of(spine), [table])


@query
def asof_bucketed(spark, sf_dir):
    """Features stored by key: only the spine is shuffled."""
    spine, table = odd_even(events(spark, sf_dir), DAY)
    path = scratch_path(spark, "bucketed")
    name = "even_" + path.rpartition("-")[2]
    write_bucketed(read_features(spark, table, table.batch_source), table, name, path, 16)
    return join_bucketed(spine, "ts", table, path)


def history_of(spark, table: FeatureTable) -> FeatureHistory:
    """The table's features in two batches with mixed times, the second after a roll-up."""
    history = FeatureHistory(spark, scratch_path(spark, "history"), table, fanout=4, levels=3)
    source = table.batch_source
    late = F.pmod("event_id", F.lit(4)) == 0
    history.append(replace(source, df=source.df.filter(~late)), "first")
    history.roll_up()
    history.append(replace(source, df=source.df.filter(late)), "late")
    return history


@query
def asof_history(spark, sf_dir):
    spine, table = odd_even(events(spark, sf_dir), None)
    table = replace(table, batch_source=history_of(spark, table).source(spine, "ts"))
    return get_historical_features(spark, ["even:value"], spine_of(spine), [table])


@query
def asof_history_days(spark, sf_dir):
    """A spine of the Sundays: of the days between, only each user's latest rows are read."""
    spine, table = odd_even(events(spark, sf_dir), None)
    spine = spine.filter(F.dayofweek("ts") == 1)
    table = replace(table, batch_source=history_of(spark, table).source(spine, "ts"))
    return get_historical_features(spark, ["even:value"], spine_of(spine), [table])


@query
def asof_hot_key(spark, sf_dir):
    """A third of all rows on one key, every key cut into time slices."""
    ev = events(spark, sf_dir).withColumn(
        "user_id", F.expr("CASE WHEN event_id % 3 = 0 THEN 0L ELSE user_id END")
    )
    spine, table = odd_even(ev, None)
    table = replace(table, entities=USER)
    return get_historical_features(
        spark, ["even:value"], spine_of(spine), [table], strategy="sliced"
    )


@query
def asof_broadcast(spark, sf_dir):
    ev = events(spark, sf_dir)
    tables = [features_of(ev, "click", "clicks", DAY)]
    return get_historical_features(
        spark, ["clicks:value"], spine_of(purchases(ev)), tables, strategy="broadcast"
    )


@query
def asof_tie_created(spark, sf_dir):
    ev = events(spark, sf_dir)
    table = features_of(ev, "click", "clicks", DAY)
    first = table.batch_source.df
    later = first.withColumn("created_ts", F.expr("created_ts + INTERVAL 10 MINUTES")).withColumn(
        "value", F.col("value") * 2
    )
    source = FrameSource("ts", "created_ts", df=union_rows([later, first]))
    table = replace(table, batch_source=source)
    return get_historical_features(spark, ["clicks:value"], spine_of(purchases(ev)), [table])


@query
def asof_edge(spark, sf_dir):
    """Exactly at the feature's time, exactly max_age later, and a microsecond after that."""
    ev = events(spark, sf_dir)
    clicks = ev.filter("event_type = 'click'")
    shifts = ["0 00:00:00.000000", "1 00:00:00.000000", "1 00:00:00.000001"]
    copies = [
        clicks.select(
            (F.col("event_id") * 3 + i).alias("spine_id"),
            "user_id",
            F.expr(f"ts + INTERVAL '{shift}' DAY TO SECOND").alias("ts"),
        )
        for i, shift in enumerate(shifts)
    ]
    spine = union_rows(copies)
    tables = [features_of(ev, "click", "clicks", DAY)]
    return get_historical_features(spark, ["clicks:value"], spine_of(spine), tables)


@query
def asof_multi(spark, sf_dir):
    ev = events(spark, sf_dir)
    tables = [
        features_of(ev, "click", "clicks", DAY),
        features_of(ev, "view", "views", DAY // 4),
        features_of(ev, "error", "errors", None),
    ]
    refs = ["clicks:value", "views:value", "errors:value"]
    return get_historical_features(spark, refs, spine_of(purchases(ev)), tables)


@query
def asof_mixed_keys(spark, sf_dir):
    ev = events(spark, sf_dir)
    spine, even = odd_even(ev, DAY // 2)
    clicks = features_of(ev, "click", "clicks", DAY)
    refs = ["even:value", "clicks:value"]
    return get_historical_features(spark, refs, spine_of(spine), [clicks, even])


@query
def asof_dup_spine(spark, sf_dir):
    ev = events(spark, sf_dir)
    spine = purchases(ev)
    tables = [features_of(ev, "click", "clicks", DAY)]
    doubled = union_rows([spine, spine])
    return get_historical_features(spark, ["clicks:value"], spine_of(doubled), tables)


@query
def asof_subset_keys(spark, sf_dir):
    ev = events(spark, sf_dir)
    spine, table = odd_even(ev, DAY)
    table = replace(table, entities=USER)
    return get_historical_features(spark, ["even:value"], spine_of(spine), [table])


@query
def asof_null_features(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn(
        "value", F.expr("CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END")
    )
    tables = [features_of(ev, "click", "clicks", DAY)]
    return get_historical_features(spark, ["clicks:value"], spine_of(purchases(ev)), tables)


@query
def asof_null_keys(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn(
        "user_id", F.expr("CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id END")
    )
    tables = [features_of(ev, "click", "clicks", DAY)]
    return get_historical_features(spark, ["clicks:value"], spine_of(purchases(ev)), tables)


@query
def asof_float(spark, sf_dir):
    """A double source column narrowed to its declared float."""
    ev = events(spark, sf_dir)
    table = features_of(ev, "click", "clicks", DAY)
    table = replace(table, features=(Field("value", "float"),))
    return get_historical_features(spark, ["clicks:value"], spine_of(purchases(ev)), [table])


@query
def asof_customer_orders(spark, sf_dir):
    """For each finished order, the customer's open order before it."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    spine = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderdate")
    table = FeatureTable(
        "open_orders",
        [Field("o_custkey", "int64")],
        [Field("o_totalprice", "double"), Field("o_orderpriority", "string")],
        365 * DAY,
        batch_source=FrameSource(
            "o_orderdate",
            "created",
            df=orders.filter("o_orderstatus = 'O'").withColumn("created", F.col("o_orderdate")),
        ),
        tiebreak="o_orderkey",
    )
    refs = ["open_orders:o_totalprice", "open_orders:o_orderpriority"]
    return get_historical_features(spark, refs, FrameSource("o_orderdate", df=spine), [table])


@query
def nearest_rows(spark, sf_dir):
    ev = events(spark, sf_dir)
    table = features_of(ev, "click", "clicks", DAY)
    stamped = table.batch_source.df.select(
        "value",
        "user_id",
        "event_id",
        F.col("ts").alias("event_timestamp"),
        F.col("created_ts").alias("created_timestamp"),
    )
    return nearest_feature_rows(stamped, table, purchases(ev), "ts")


@query
def spine_range(spark, sf_dir):
    """How many feature rows lie within reach of a spine of two days."""
    ev = events(spark, sf_dir)
    spine = purchases(ev).filter("ts >= '2024-01-10' AND ts < '2024-01-12'")
    table = features_of(ev, "click", "clicks", DAY)
    low, high = spine_bounds(spine, "ts")
    kept = prune_to_spine(table.batch_source.df, table, low, high, event_ts="ts")
    return kept.agg(F.count(F.lit(1)).alias("kept"))


@query
def feature_refs(spark, sf_dir):
    ev = events(spark, sf_dir)
    both = (*VALUE, Field("props", "string"))
    clicks = replace(features_of(ev, "click", "clicks", DAY), features=both)
    views = replace(features_of(ev, "view", "views", DAY), features=both)
    refs = ["clicks:props", "views:value", "clicks:value"]
    return get_historical_features(spark, refs, spine_of(purchases(ev)), [views, clicks])


@query
def epoch_export(spark, sf_dir):
    return export_epoch(purchases(events(spark, sf_dir)), "ts")


# Scans, staging, mapping

WINDOW = (dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 10))


@query
def time_range_scan(spark, sf_dir):
    source = FileSource("ts", path=f"{sf_dir}/events.parquet")
    return scan_range(spark, source, *WINDOW).select("event_id", "ts", "value")


@query
def partition_scan(spark, sf_dir):
    path = scratch_path(spark, "by-date")
    by_date = events(spark, sf_dir).withColumn("date", F.to_date("ts"))
    by_date.hint("rebalance", F.col("date")).write.partitionBy("date").parquet(path)
    source = FileSource("ts", path=path, date_partition_column="date")
    return scan_range(spark, source, *WINDOW).select("event_id", "ts", "value", "date")


@query
def staged_spine(spark, sf_dir):
    source = stage_rows_by_day(spark, purchases(events(spark, sf_dir)), "ts")
    staged = spark.read.parquet(source.path)
    return staged.withColumnRenamed("_partition_date", "partition_date")


@query
def field_mapping(spark, sf_dir):
    mapping = {
        "amount": "value",
        "amount_scaled": "value * 2 + 1",
        "props": "upper(event_type)",
    }
    return map_fields(events(spark, sf_dir), mapping)


@query
def input_projection(spark, sf_dir):
    source = FileSource(
        "ts",
        field_mapping={
            "whole_amount": "value",
            "id_number": "event_id",
            "hour_of_day": "hour(ts)",
            "kind": "event_type",
        },
        path=f"{sf_dir}/events.parquet",
    )
    table = FeatureTable(
        "t",
        [Field("user_id", "int32")],
        [
            Field("whole_amount", "int64"),
            Field("id_number", "double"),
            Field("hour_of_day", "int32"),
            Field("kind", "string"),
        ],
    )
    return project_input(events(spark, sf_dir), table, source)


@query
def entity_keys(spark, sf_dir):
    names = ["user_id", "event_type"]
    return events(spark, sf_dir).select(
        "event_id",
        entity_key("default", names).alias("entity_key"),
        key_text(names).alias("sorted_key"),
        key_text(names, order="declared").alias("declared_key"),
    )


# Validation


def flawed(df: DataFrame) -> DataFrame:
    """Events with missing keys, times and values."""
    return df.select(
        "event_id",
        F.expr("CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id END").alias("user_id"),
        F.expr("CASE WHEN event_id % 23 = 0 THEN NULL ELSE ts END").alias("ts"),
        "event_type",
        F.expr("CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END").alias("value"),
    )


FLAWED_TABLE = FeatureTable("flawed", USER, VALUE)
EXPECTATIONS = [
    {
        "expectation_type": "expect_column_values_to_be_between",
        "kwargs": {"column": "value", "min_value": 1, "max_value": 100},
    },
    {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "event_type"}},
]


@query
def valid_rows(spark, sf_dir):
    return split_valid(flawed(events(spark, sf_dir)), FLAWED_TABLE, "ts", EXPECTATIONS)[0]


@query
def rejected_rows(spark, sf_dir):
    return split_valid(flawed(events(spark, sf_dir)), FLAWED_TABLE, "ts", EXPECTATIONS)[1]


@query
def valid_counts(spark, sf_dir):
    check = checks.all_checks(FLAWED_TABLE, "ts", EXPECTATIONS, require_any_feature=True)
    return row_counts(flawed(events(spark, sf_dir)), check)


SUITE = checks.prepare_suite(
    [
        checks.Rule(
            "expect_column_values_to_be_between",
            {"column": "flawed__value", "min_value": 1, "max_value": 100},
        ),
        checks.Rule(
            "expect_column_values_to_be_in_set",
            {"column": "flawed__event_type", "value_set": ["click", "view", "purchase"]},
        ),
        checks.Rule("expect_column_values_to_not_be_null", {"column": "flawed__value"}),
        checks.Rule("expect_column_values_to_not_be_null", {"column": "absent"}),
        checks.Rule(
            "expect_column_mean_to_be_between",
            {"column": "flawed__value", "min_value": 0, "max_value": 10},
        ),
        checks.Rule(
            "expect_column_max_to_be_between",
            {"column": "flawed__value", "min_value": 0, "max_value": 100_000},
        ),
        checks.Rule(
            "expect_column_min_to_be_between", {"column": "flawed__value", "min_value": 5}
        ),
    ],
    "flawed",
)


@query
def suite_violations(spark, sf_dir):
    return check_counts(flawed(events(spark, sf_dir)), SUITE)


UNIQUE = [
    checks.Rule("expect_compound_columns_to_be_unique", {"column_list": ["l_orderkey", "l_linenumber"]}),
    checks.Rule("expect_column_values_to_be_unique", {"column": "l_suppkey"}),
    checks.Rule("expect_compound_columns_to_be_unique", {"column_list": ["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"]}),
    checks.Rule("expect_column_values_to_be_unique", {"column": "absent"}),
]


@query
def unique_violations(spark, sf_dir):
    """Rules over several rows, and one over each, of a table whose key is not unique."""
    between = checks.Rule("expect_column_values_to_be_between", {"column": "l_quantity", "min_value": 5, "max_value": 40})
    return check_counts(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), [*UNIQUE, between])


@query
def unique_rows(spark, sf_dir):
    """The rows themselves, marked."""
    marked = mark_unique(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), UNIQUE)
    return marked.select("l_orderkey", "l_linenumber", "l_extendedprice", "_unique0", "_unique1", "_unique2", "_unique3")


@query
def suite_observed(spark, sf_dir):
    return check_observed(flawed(events(spark, sf_dir)), SUITE)


@query
def suite_rows(spark, sf_dir):
    df = flawed(events(spark, sf_dir))
    return df.filter(checks.suite_holds(SUITE, df.columns))


@query
def validation_function(spark, sf_dir):
    """The same kind of rule as a user function over Arrow batches."""

    def in_range(batch: pd.DataFrame) -> pd.Series:
        return batch["value"].between(1, 100) & batch["event_type"].isin(["click", "view"])

    df = events(spark, sf_dir).select("event_id", "event_type", "value")
    return df.filter(checks.validation_udf(in_range, df.columns))


# The latest-value table

KIND_TABLE = FeatureTable("latest", USER_TYPE, (*VALUE, Field("event_id", "int64")), 2 * DAY)


@query
def latest_row_per_key(spark, sf_dir):
    df = events(spark, sf_dir).select("user_id", "event_type", "ts", "event_id", "value")
    return online.latest_per_key(df, ["user_id", "event_type"], "ts", ["event_id"])


def three_batches(df: DataFrame) -> list[DataFrame]:
    """The middle of the month, then what was before it, then what came after."""
    return [
        df.filter("ts >= '2024-01-10' AND ts < '2024-01-20'"),
        df.filter("ts < '2024-01-10'"),
        df.filter("ts >= '2024-01-20'"),
    ]


def batch_log(df: DataFrame, table: FeatureTable, layout: str = "feature") -> DataFrame:
    batches = [
        online.log_rows(batch, table, "ts", seq, layout=layout)
        for seq, batch in enumerate(three_batches(df))
    ]
    return union_rows(batches, table.entity_names)


def gappy(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.expr("CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END"))


@query
def upsert_last_writer(spark, sf_dir):
    return online.fold_table(batch_log(events(spark, sf_dir), KIND_TABLE), KIND_TABLE)


@query
def upsert_null_merge(spark, sf_dir):
    return online.fold_table(batch_log(gappy(events(spark, sf_dir)), KIND_TABLE), KIND_TABLE)


@query
def upsert_row_replace(spark, sf_dir):
    log = batch_log(gappy(events(spark, sf_dir)), KIND_TABLE, "row")
    state = online.fold_table(log, KIND_TABLE, "row")
    return state.withColumnRenamed("_expiry", "expiry")


@query
def expiry_shared(spark, sf_dir):
    """Expiry of a user over four tables: the third, without an age limit, removes it, and what
    the fourth has starts anew."""
    ev = events(spark, sf_dir)
    ages = {"click": DAY, "view": 3 * DAY, "error": None, "signup": 2 * DAY}
    logs = []
    for seq, (kind, age) in enumerate(ages.items()):
        table = FeatureTable(kind, USER, VALUE, age)
        rows = ev.filter(F.col("event_type") == kind)
        logs.append(online.log_rows(rows, table, "ts", seq))
    state = online.fold_expiry(logs, ["user_id"])
    return state.withColumnRenamed("_expiry", "expiry")


@query
def expiry_jitter(spark, sf_dir):
    """Expiries of all keys, spread by less than ten minutes."""
    log = online.log_rows(events(spark, sf_dir), KIND_TABLE, "ts", 0, max_jitter=600)
    low = F.col("event_timestamp") + F.expr("INTERVAL 2 DAYS")
    within = (F.col("_expiry") >= low) & (F.col("_expiry") < low + F.expr("INTERVAL 10 MINUTES"))
    return log.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(within).alias("within"),
        (F.count_distinct(F.col("_expiry") - low) > 1).alias("spread"),
    )


@query
def packed_rows(spark, sf_dir):
    """Rows packed to one binary value and unpacked again."""
    columns = ["event_type", "value", "ts"]
    ev = events(spark, sf_dir)
    packed = ev.select("event_id", online.pack_row(ev, columns).alias("packed"))
    back = online.unpack_row(F.col("packed"), ev.select(*columns).schema)
    return packed.select("event_id", back.alias("r")).select("event_id", "r.*")


def user_tables(ev: DataFrame) -> list[FeatureTable]:
    return [features_of(ev, "click", "clicks", DAY), features_of(ev, "view", "views", 3 * DAY)]


@query
def online_lookup(spark, sf_dir):
    """Both tables ingested in two batches each, then looked up at the end of the month."""
    ev = events(spark, sf_dir)
    store = OnlineStore(spark, scratch_path(spark, "online"))
    tables = user_tables(ev)
    mid = dt.datetime(2024, 1, 16)
    for table in tables:
        ingest_batch(spark, table, store, mid, dt.datetime(2024, 1, 31))
        ingest_batch(spark, table, store, dt.datetime(2024, 1, 1), mid)
    known = ev.select("user_id").distinct()
    unknown = known.select((-F.col("user_id") - 1).alias("user_id"))
    requests = union_rows([known, unknown])
    now = F.expr("timestamp_ntz'2024-01-31 00:00:00'")
    return store.get(requests, tables, now, with_status=True)


@query
def compacted_store(spark, sf_dir):
    """Three batches with a compaction in between; values, times and shared expiry."""
    store = OnlineStore(spark, scratch_path(spark, "compacted"), buckets=8)
    first, second, third = three_batches(gappy(events(spark, sf_dir)))
    store.write(first, KIND_TABLE, "ts")
    store.write(second, KIND_TABLE, "ts")
    store.compact([KIND_TABLE])
    # Another writer and another reader, which know of the store only what is written there.
    OnlineStore(spark, store.root).write(third, KIND_TABLE, "ts")
    return OnlineStore(spark, store.root).read(KIND_TABLE).withColumnRenamed("_expiry", "expiry")


@query
def concurrent_writers(spark, sf_dir):
    """Two stores at one place write at the same moment, and merge what is there. Their batches'
    keys and times decide, not which of them came first."""
    root = scratch_path(spark, "writers")
    rows = gappy(events(spark, sf_dir))
    parts = [[rows.filter(f"event_type {x} 'click' AND {half}") for half in HALVES] for x in ("=", "<>")]

    def work(number: int) -> None:
        store = OnlineStore(spark, root, compact_every=2, buckets=4)
        for i, part in enumerate(parts[number]):
            store.write(part, KIND_TABLE, "ts", tag=f"writer-{number}-{i}")

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(work, range(2)))
    return OnlineStore(spark, root).read(KIND_TABLE).withColumnRenamed("_expiry", "expiry")


HALVES = ("ts < '2024-01-16'", "ts >= '2024-01-16'")


@query
def tiered_store(spark, sf_dir):
    """A batch for every three days, merged in tiers as they come; every key and one unknown of each
    type looked up at the end of the month."""
    ev = gappy(events(spark, sf_dir))
    store = OnlineStore(spark, scratch_path(spark, "tiers"), compact_every=3, buckets=8)
    for day in range(0, 31, 3):
        begin = dt.datetime(2024, 1, 1) + dt.timedelta(days=day)
        part = ev.filter(F.col("ts").between(begin, begin + dt.timedelta(days=3, microseconds=-1)))
        store.write(part, KIND_TABLE, "ts")
    known = ev.select("user_id", "event_type").distinct()
    unknown = known.select((-F.col("user_id") - 1).alias("user_id"), "event_type")
    now = F.expr("timestamp_ntz'2024-01-31 00:00:00'")
    return store.get(union_rows([known, unknown]), [KIND_TABLE], now, with_status=True)


@query
def point_lookup(spark, sf_dir):
    """Two users of a compacted store: only the buckets, and rows, that can hold them are read."""
    ev = events(spark, sf_dir)
    store = OnlineStore(spark, scratch_path(spark, "points"), buckets=8)
    tables = user_tables(ev)
    for table in tables:
        store.write(ev.filter(F.col("event_type") == table.name.removesuffix("s")), table, "ts")
    store.compact(tables)
    requests = ev.agg(F.explode(F.array(F.min("user_id"), F.max("user_id"))).alias("user_id"))
    return store.get(requests, tables, F.expr("timestamp_ntz'2024-01-31 00:00:00'"), with_status=True)


@query
def expired_removed(spark, sf_dir):
    """Clicks (one day) and views (three days) up to the 25th; keys expired by the 27th are removed. The
    oldest events come again, late, and the rest of the month after that."""
    ev = gappy(events(spark, sf_dir))
    store = OnlineStore(spark, scratch_path(spark, "expired"), buckets=8)
    tables = user_tables(ev)
    mine = {t.name: ev.filter(F.col("event_type") == t.name.removesuffix("s")) for t in tables}
    for table in tables:
        store.write(mine[table.name].filter("ts < '2024-01-25'"), table, "ts")
    store.remove_expired(tables, F.expr("timestamp_ntz'2024-01-27 00:00:00'"))
    states = []
    for table in tables:
        store.write(mine[table.name].filter("ts < '2024-01-10'"), table, "ts")
        store.write(mine[table.name].filter("ts >= '2024-01-28'"), table, "ts")
    store.compact(tables)
    for table in tables:
        states.append(store.read(table).select(F.lit(table.name).alias("feature_table"), "*"))
    return union_rows(states).withColumnRenamed("_expiry", "expiry")


@query
def store_freshness(spark, sf_dir):
    """The figures of ``table_freshness`` from the times noted beside a store's batches and runs."""
    ev = events(spark, sf_dir)
    store = OnlineStore(spark, scratch_path(spark, "fresh"), buckets=4)
    ages = {"click": 3600, "view": DAY, "signup": None, "purchase": 1800, "refund": 60}
    tables = [FeatureTable(name, USER, VALUE, age) for name, age in ages.items()]
    for table in tables:
        store.write(ev.filter(F.col("event_type") == table.name), table, "ts")
    store.compact(tables)
    store.write(ev.filter("event_type = 'click'").filter("false"), tables[0], "ts")
    return stored_freshness(store, tables, F.expr("timestamp_ntz'2024-01-31 00:00:00'"))


@query
def batch_ingestion(spark, sf_dir):
    """The last five days into the store, rejects to dead letters; both read back."""
    source = FrameSource("ts", "ts", df=flawed(events(spark, sf_dir)))
    table = replace(FLAWED_TABLE, features=(*VALUE, Field("event_id", "int64")), max_age=DAY)
    table = replace(table, batch_source=source)
    rules = [r for r in EXPECTATIONS if r["kwargs"]["column"] == "value"]
    store = OnlineStore(spark, scratch_path(spark, "batch"))
    rejects = scratch_path(spark, "rejects")
    ingest_batch(
        spark,
        table,
        store,
        last_n_days=5,
        now=dt.datetime(2024, 1, 30, 12),
        dead_letter=rejects,
        expectations=rules,
    )
    dead = spark.read.option("recursiveFileLookup", "true").parquet(rejects)
    stored = store.read(table).select(
        "user_id", "value", "event_id", F.col("event_timestamp").alias("ts"), F.lit(True).alias("kept")
    )
    rejected = dead.select("user_id", "value", "event_id", "ts", F.lit(False).alias("kept"))
    return union_rows([stored, rejected])


# Metrics


@query
def lag_figures(spark, sf_dir):
    now = F.expr("timestamp_ntz'2024-01-31 00:00:00'")
    ev = events(spark, sf_dir)
    stats = lag_stats(ev, "ts", now)
    # Approximate percentiles are held against the promise: ranks within 1 / accuracy of all rows.
    lags = ev.select(F.floor((F.expr("unix_micros(timestamp'2024-01-31 00:00:00') - unix_micros(cast(ts as timestamp))")) / 1000).alias("lag"))
    ranks = lags.join(F.broadcast(stats.select("lag_count", *[f"lag_{n}" for n in LAG_PERCENTILES])))
    slack = F.greatest(F.lit(1), F.ceil(F.col("lag_count") / 10_000))
    within = [
        (
            (F.count_if(F.col("lag") < F.col(f"lag_{n}")) <= F.max(F.col("lag_count") * share + slack))
            & (F.count_if(F.col("lag") <= F.col(f"lag_{n}")) >= F.max(F.col("lag_count") * share - slack))
        ).alias(f"{n}_within")
        for n, share in LAG_PERCENTILES.items()
    ]
    checked = ranks.agg(*within)
    plain = ["lag_count", "lag_min", "lag_max", "lag_mean", "lag_stddev"]
    return stats.select(*plain).join(F.broadcast(checked))


@query
def lag_over_days(spark, sf_dir):
    """Lag sketches kept per day and written; those of ten days answer for them, as do those of each
    day, within the promised ranks of all their rows."""
    now = F.expr("timestamp_ntz'2024-01-31 00:00:00'")
    ev = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    path = scratch_path(spark, "lags")
    lag_sketches(ev, "ts", now, [F.col("day")]).write.parquet(path)
    kept = spark.read.parquet(path)
    span = F.col("day").between(dt.date(2024, 1, 5), dt.date(2024, 1, 14))
    whole = sketched_lag(merge_lag_sketches(kept.filter(span))).withColumn("day", F.lit(None).cast("date"))
    figures = union_rows([sketched_lag(kept), whole])
    lag = F.floor((F.expr("unix_micros(timestamp'2024-01-31 00:00:00') - unix_micros(cast(ts as timestamp))")) / 1000)
    rows = ev.select("day", span.alias("in_span"), lag.alias("lag"))
    rows = union_rows([rows.select("day", "lag"), rows.filter("in_span").select(F.lit(None).cast("date").alias("day"), "lag")])
    held = rows.join(F.broadcast(figures.withColumnRenamed("day", "of")), F.col("day").eqNullSafe(F.col("of")))
    slack = F.max(F.greatest(F.lit(1.0), F.col("lag_count") / 5_000))
    within = F.lit(True)
    for n, share in LAG_PERCENTILES.items():
        wanted, cut = F.max(F.col("lag_count") * share), F.col(f"lag_{n}")
        within = within & (F.count_if(F.col("lag") < cut) <= wanted + slack) & (F.count_if(F.col("lag") <= cut) >= wanted - slack)
    plain = ["lag_count", "lag_min", "lag_max"]
    return held.groupBy("day", *plain).agg(within.alias("ranks_within"))


@query
def table_freshness(spark, sf_dir):
    ages = {"click": 3600, "view": DAY, "signup": None, "purchase": 1800, "refund": 60}
    now = F.expr("timestamp_ntz'2024-01-31 00:00:00'")
    return freshness(events(spark, sf_dir), "event_type", "ts", ages, now)


# Messages and streams


@query
def decode_json(spark, sf_dir):
    raw = events(spark, sf_dir).withColumnRenamed("props", "value_json")
    return decode_messages(raw, JsonFormat("k int"), "value_json", keep=["event_id"])


@query
def decode_malformed(spark, sf_dir):
    raw = events(spark, sf_dir).select(
        "event_id", F.expr("CASE WHEN event_id % 13 = 0 THEN '{bad' ELSE props END").alias("body")
    )
    return decode_messages(raw, JsonFormat("k int"), "body", keep=["event_id"])


@query
def nested_mapping(spark, sf_dir):
    """Map and nested fields of a message taken by path."""
    ev = events(spark, sf_dir)
    body = F.to_json(
        F.struct(
            "user_id",
            "ts",
            F.struct(F.col("value").alias("amount"), F.array("event_id").alias("ids")).alias("inner"),
            F.create_map(F.lit("kind"), F.col("event_type")).alias("tags"),
        ),
        {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"},
    )
    schema = (
        "user_id bigint, ts timestamp_ntz, inner struct<amount: double, ids: array<bigint>>, "
        "tags map<string, string>"
    )
    decoded = decode_messages(ev.select(body.alias("body")), JsonFormat(schema), "body")
    source = FrameSource(
        "ts", field_mapping={"amount": "inner.amount", "kind": "tags.kind", "id": "inner.ids[0]"}
    )
    table = FeatureTable(
        "t",
        USER,
        [Field("amount", "double"), Field("kind", "string"), Field("id", "int64")],
    )
    return project_input(decoded, table, source)


def _stream(spark: SparkSession, parts: list[DataFrame], table: FeatureTable, **options):
    """Drop the parts into a folder one after the other; the stream takes each up where the
    one before it ended."""
    path, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "checkpoint")
    source = FileStreamSource("ts", path=path, schema=parts[0].schema)
    table = replace(table, stream_source=source)
    store = OnlineStore(spark, scratch_path(spark, "online"))
    for part in parts:
        part.write.mode("append").parquet(path)
        running = ingest_stream(
            spark, table, store, checkpoint=checkpoint, available_now=True, **options
        )
        running.awaitTermination()
    return store, table


def _state(store: OnlineStore, table: FeatureTable) -> DataFrame:
    return store.read(table).withColumnRenamed("_expiry", "expiry")


@query
def stream_ingestion(spark, sf_dir):
    return _state(*_stream(spark, three_batches(events(spark, sf_dir)), KIND_TABLE))


@query
def stream_redelivered(spark, sf_dir):
    """Every third message comes again in its part and every fifth in the next one, after a restart:
    what is read, and the state, are as if each had come once."""
    ev = events(spark, sf_dir)
    parts = three_batches(ev)
    again = [union_rows([part, part.filter("event_id % 3 = 0")]) for part in parts]
    for i in (1, 2):
        again[i] = union_rows([again[i], parts[i - 1].filter("event_id % 5 = 0")])
    reports = []
    store, table = _stream(spark, again, KIND_TABLE, message_id="event_id", on_batch=reports.append)
    read, late = sum(r.read for r in reports), sum(r.late for r in reports)
    state = _state(store, table)
    return state.withColumns({"messages": F.lit(read).cast("bigint"), "late": F.lit(late).cast("bigint")})


@query
def stream_refused(spark, sf_dir):
    """A user function refuses rows; they are dropped."""

    def small(batch: pd.DataFrame) -> pd.Series:
        return batch["value"] <= 50

    parts = [flawed(events(spark, sf_dir))]
    table = replace(FLAWED_TABLE, features=(*VALUE, Field("event_id", "int64")))
    return _state(*_stream(spark, parts, table, validator=small, drop_invalid=True))


@query
def stream_kept(spark, sf_dir):
    """The same refusals, ingested all the same and written to the dead letters too."""

    def small(batch: pd.DataFrame) -> pd.Series:
        return batch["value"] <= 50

    parts = [flawed(events(spark, sf_dir))]
    table = replace(FLAWED_TABLE, features=(*VALUE, Field("event_id", "int64")))
    rejects = scratch_path(spark, "rejects")
    store, table = _stream(spark, parts, table, validator=small, dead_letter=rejects)
    dead = spark.read.option("recursiveFileLookup", "true").parquet(rejects)
    stored = store.read(table).select("user_id", "event_id", F.lit("stored").alias("place"))
    rejected = dead.select("user_id", "event_id", F.lit("rejected").alias("place"))
    return union_rows([stored, rejected])


@query
def stream_suite(spark, sf_dir):
    """A suite on a stream: rows that break a rule are dropped; per-rule counts per batch."""
    parts = [flawed(events(spark, sf_dir))]
    table = replace(FLAWED_TABLE, features=(*VALUE, Field("event_id", "int64"), Field("event_type", "string")))
    return _state(*_stream(spark, parts, apply_validation(table, SUITE, 60), drop_invalid=True))


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per figure of the reports of a stream over the three parts of the month."""
    table = replace(FLAWED_TABLE, suite=tuple(SUITE), features=(*VALUE, Field("event_type", "string")))
    month = events(spark, sf_dir).withColumn(MESSAGE_TIME, F.expr("ts + INTERVAL 1 MINUTE"))
    parts = [flawed(part).join(part.select("event_id", MESSAGE_TIME), "event_id") for part in three_batches(month)]
    reports: list = []
    _stream(spark, parts, table, on_batch=reports.append, drop_invalid=True)
    rows = []
    for part, r in enumerate(reports):
        figures = {"read": r.read, "ingested": r.ingested, "rejected": r.rejected, "lagging": r.lag["lag_count"]}
        rows += [(part, name, n, r.latest_message) for name, n in (figures | dict(r.violations)).items()]
    return spark.createDataFrame(rows, "part int, figure string, n bigint, latest_message timestamp_ntz")


@query
def stream_report(spark, sf_dir):
    """Counts, violations by rule and the newest message time of every micro-batch."""
    return _reports(spark, sf_dir)


@query
def stream_progress(spark, sf_dir):
    """Batches and rows of a stream by Spark's own progress figures, started by a trigger's clock."""
    path = scratch_path(spark, "stream")
    ev = events(spark, sf_dir)
    ev.write.parquet(path)
    table = replace(KIND_TABLE, stream_source=FileStreamSource("ts", path=path, schema=ev.schema))
    store = OnlineStore(spark, scratch_path(spark, "online"))
    running = ingest_stream(spark, table, store, checkpoint=scratch_path(spark, "checkpoint"), trigger_seconds=0)
    try:
        running.processAllAvailable()
        n_rows = sum(p.numInputRows for p in running.recentProgress)
        batches = recent_progress(spark, running).filter("batch_duration_ms >= 0")
        named = batches.agg((F.count("*") > 0).alias("has_batches")).collect()[0][0]
    finally:
        running.stop()
    state = store.read(table)
    return state.agg(F.count("*").alias("keys")).select("keys", F.lit(n_rows).cast("bigint").alias("rows"), F.lit(named).alias("has_batches"))


# Declared in other ways


@query
def asof_partitioned(spark, sf_dir):
    """Date partitions as text, some of which name no day: the same rows as without."""
    ev = events(spark, sf_dir)
    part = F.expr(
        "CASE event_id % 3 WHEN 0 THEN date_format(ts, 'yyyy-MM-dd') WHEN 1 THEN date_format(ts, 'yyyy-MM') END"
    )
    table = features_of(ev.withColumn("part", part), "click", "clicks", DAY)
    source = replace(table.batch_source, date_partition_column="part")
    tables = [replace(table, batch_source=source)]
    return get_historical_features(
        spark, ["clicks:value"], spine_of(purchases(ev)), tables, policy=SkewPolicy(least_row_bytes=0)
    )


@query
def asof_hot_measured(spark, sf_dir):
    """The hot key found by measuring, with a policy under which it counts as one."""
    spine, table = odd_even(events(spark, sf_dir), None)
    hot = F.expr("CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END")
    features = table.batch_source.df.withColumn("user_id", hot)
    table = replace(table, entities=USER, batch_source=FrameSource("ts", "created_ts", df=features))
    policy = SkewPolicy(hot_rows=500, least_row_bytes=0, sketch_share=1)
    spine = spine_of(spine.withColumn("user_id", hot))
    return get_historical_features(spark, ["even:value"], spine, [table], policy=policy)


@query
def training_set_output(spark, sf_dir):
    """Written as Parquet over what was there before, and read back."""
    ev = events(spark, sf_dir)
    path = scratch_path(spark, "training")
    ev.write.parquet(path)
    tables = [features_of(ev, "click", "clicks", DAY)]
    spine = spine_of(purchases(ev))
    get_historical_features(spark, ["clicks:value"], spine, tables, output=("parquet", path))
    return spark.read.parquet(path)


@query
def dict_retrieval(spark, sf_dir):
    """Sources and table declared as dictionaries, the features as CSV."""
    ev = events(spark, sf_dir)
    path = scratch_path(spark, "declared")
    clicks = feature_source(ev.filter("event_type = 'click'")).df
    clicks.select("event_id", "user_id", "ts", "created_ts", "value").write.option("header", "true").csv(f"{path}/clicks")
    purchases(ev).withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{path}/spine")
    common = {"event_timestamp_column": "ts"}
    spine = {"file": {"path": f"{path}/spine", "format": {"json_class": "ParquetFormat"}, **common}}
    options = {"header": "true", "inferSchema": "true"}
    features = {
        "file": {
            "path": f"{path}/clicks",
            "format": {"json_class": "CSVFormat"},
            "options": options,
            "created_timestamp_column": "created_ts",
            "field_mapping": {"user_id": "cast(user_id as bigint)"},
            **common,
        }
    }
    table = {
        "name": "clicks",
        "entities": [{"name": "user_id", "type": "int64"}],
        "features": [{"name": "value", "type": "double"}],
        "max_age": DAY,
        "tiebreak": "event_id",
    }
    found = retrieve_historical_features(spark, spine, [features], [table])
    return found.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def table_source(spark, sf_dir):
    """Features out of a catalogue view."""
    ev = events(spark, sf_dir)
    feature_source(ev.filter("event_type = 'click'")).df.createOrReplaceTempView("tidemark_clicks")
    table = features_of(ev, "click", "clicks", DAY)
    tables = [replace(table, batch_source=TableSource("ts", "created_ts", table="tidemark_clicks"))]
    return get_historical_features(spark, ["clicks:value"], spine_of(purchases(ev)), tables)


@query
def staged_rows(spark, sf_dir):
    """The spine staged as Parquet first."""
    ev = events(spark, sf_dir)
    spine = stage_rows(spark, purchases(ev), "ts", scratch_path(spark, "staging"))
    return get_historical_features(spark, ["clicks:value"], spine, [features_of(ev, "click", "clicks", DAY)])


@query
def schema_registry(spark, sf_dir):
    """Packed rows beside the schema that their reference names, read back through it."""
    ev = events(spark, sf_dir)
    path = scratch_path(spark, "schemas")
    columns = ["event_type", "value", "ts"]
    schema = ev.select(*columns).schema
    with ThreadPoolExecutor(4) as pool:
        made = list(pool.map(lambda _: register_schema(spark, path, schema), range(8)))
    assert sum(made) >= 1
    packed = ev.select("event_id", online.pack_row(ev, columns).alias("packed"))
    known = read_schemas(spark, path)
    named = packed.join(F.broadcast(known), F.substring("packed", 1, 4) == F.col("schema_ref"))
    return named.select("event_id", online.unpack_row(F.col("packed"), schema).alias("r")).select("event_id", "r.*")


@query
def schema_report(spark, sf_dir):
    """Declared fields that the table lacks or has with another type."""
    wanted = [Field("value", "double"), Field("props", "int64"), Field("absent", "string")]
    return schema_differences(events(spark, sf_dir), FeatureTable("t", USER, wanted))


@query
def gc_threshold(spark, sf_dir):
    """The label lengthens the age limit of stored rows."""
    table = replace(KIND_TABLE, labels={GC_THRESHOLD_LABEL: str(5 * DAY)})
    log = online.log_rows(events(spark, sf_dir), table, "ts", 0)
    return log.select("user_id", "event_type", F.col("_expiry").alias("expiry"))


@query
def table_health(spark, sf_dir):
    """Tables that pass and that fail their age limit at the end of the month."""
    tables = [FeatureTable(n, USER, VALUE, a) for n, a in (("click", 3600), ("view", DAY), ("signup", 60), ("refund", 60))]
    found = health(events(spark, sf_dir), "event_type", "ts", tables, F.expr("timestamp_ntz'2024-01-31 00:00:00'"))
    rows = [(name, state) for state, names in found.items() for name in names]
    return spark.createDataFrame(rows, "feature_table string, state string")


@query
def entity_repartition(spark, sf_dir):
    """A batch shuffled by key into a given number of parts; rows and files of the log."""
    ev = events(spark, sf_dir)
    store = OnlineStore(spark, scratch_path(spark, "parts"))
    table = replace(features_of(ev, "click", "clicks", DAY), tiebreak=None)
    ingest_batch(spark, table, store, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), partitions=3)
    files = spark.read.option("recursiveFileLookup", "true").parquet(f"{store.root}/default__user_id/log")
    return files.select(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("keys"), (F.count_distinct("file") <= 3).alias("few_files")
    )


@query
def staged_swept(spark, sf_dir):
    """Two staged spines, of which one is past its day; rows of what a sweep leaves."""
    location = scratch_path(spark, "staging")
    now = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
    spine = purchases(events(spark, sf_dir))
    kept = stage_rows_by_day(spark, spine, "ts", location, now)
    stage_rows_by_day(spark, spine, "ts", location, now - dt.timedelta(days=2))
    swept = sweep_staged(spark, location, now + dt.timedelta(hours=23))
    left = spark.read.option("recursiveFileLookup", "true").parquet(location)
    return left.select("event_id", "user_id", F.lit(len(swept)).alias("swept"), F.lit(kept.path.startswith(location)).alias("kept"))


@query
def asof_key_filter(spark, sf_dir):
    """Keys too large to send out: a bitmap of their hashes drops features before they are shuffled."""
    ev = events(spark, sf_dir)
    policy = SkewPolicy(least_row_bytes=0, broadcast_bytes=0, filter_ratio=0)
    tables = [features_of(ev, "click", "clicks", DAY)]
    return get_historical_features(spark, ["clicks:value"], spine_of(purchases(ev)), tables, policy=policy)


@query
def asof_broadcast_spread(spark, sf_dir):
    """The broadcast strategy with the features spread over a given number of parts first."""
    ev = events(spark, sf_dir)
    tables = [features_of(ev, "click", "clicks", DAY)]
    policy = SkewPolicy(broadcast_partitions=5)
    spine = spine_of(purchases(ev))
    return get_historical_features(spark, ["clicks:value"], spine, tables, strategy="broadcast", policy=policy)
