"""Scans, staging, batch and stream ingestion, decoding and figures."""

import dataclasses
import datetime as dt
import re
import json
import time

import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.operators.metrics import freshness, health, lag_stats, row_counts
from tidemark.plans.ingestion import IngestionReport, ingest_batch
from tidemark.sinks.online import OnlineStore
from tidemark.sources.batch import last_days, read_source, scan_range
from tidemark.sources.decode import AvroFormat, JsonFormat, ProtoFormat, decode_messages
from tidemark.sources.staging import scratch_path, stage_rows, stage_rows_by_day
from tidemark.sources.stream import MESSAGE_TIME, read_stream, stream_source_from_dict
from tidemark.spec import (
    FeatureTable,
    Field,
    FileSource,
    FileStreamSource,
    FrameSource,
    KafkaSource,
    SchemaError,
    TableSource,
    apply_validation,
)
from tidemark.streaming.ingest import ingest_stream
from tidemark.streaming.progress import ProgressLog, recent_progress

ROWS = "customer string, feature1 int, feature2 double, ts timestamp"
TABLE = FeatureTable(
    "customers",
    [Field("customer", "string")],
    [Field("feature1", "int32"), Field("feature2", "double")],
    3600,
)
RULES = [
    {
        "expectation_type": "expect_column_values_to_be_between",
        "kwargs": {"column": "feature1", "min_value": 0, "max_value": 100},
    }
]


def day(n, text="12:00:00"):
    return f"2021-01-{n:02d} {text}"


@pytest.fixture
def customers(frame):
    return frame(
        ROWS,
        [
            ("a", 1, 0.1, day(1)),
            ("a", 2, 0.2, day(2, "00:00:00")),
            ("b", 101, 0.3, day(2)),
            (None, 4, 0.4, day(2)),
            ("c", None, 0.5, day(2)),
            ("d", 6, 0.6, day(3, "00:00:00")),
        ],
    )


def test_time_range_is_half_open_and_prunes_partitions(spark, customers, tmp_path):
    path = str(tmp_path / "parts")
    customers.withColumn("date", F.to_date("ts")).write.partitionBy("date").parquet(path)
    bounds = dt.datetime(2021, 1, 2), dt.datetime(2021, 1, 3)
    plain = scan_range(spark, FileSource("ts", path=path), *bounds)
    pruned = scan_range(spark, FileSource("ts", path=path, date_partition_column="date"), *bounds)
    assert plain.count() == pruned.count() == 4
    assert plain.exceptAll(pruned).count() == 0
    assert re.search(r"PartitionFilters: \[[^\]]*date", str(pruned._jdf.queryExecution().toString()))
    aware = [b.replace(tzinfo=dt.timezone.utc) for b in bounds]
    assert scan_range(spark, FileSource("ts", path=path), *aware).count() == 4
    texts = customers.withColumn("date", F.date_format("ts", "yyyy-MM-dd"))
    source = FrameSource("ts", date_partition_column="date", df=texts)
    assert scan_range(spark, source, *bounds).count() == 4


def test_last_days():
    now = dt.datetime(2021, 5, 3, 17, tzinfo=dt.timezone(dt.timedelta(hours=9)))
    assert last_days(1, now) == (dt.datetime(2021, 5, 3), dt.datetime(2021, 5, 4))
    assert last_days(3, now)[0] == dt.datetime(2021, 5, 1)
    with pytest.raises(ValueError):
        last_days(0)


def test_sources(spark, customers):
    customers.createOrReplaceTempView("customer_rows")
    assert read_source(spark, TableSource("ts", table="customer_rows")).count() == 6
    with pytest.raises(TypeError):
        read_source(spark, KafkaSource("ts"))
    with pytest.raises(TypeError):
        read_stream(spark, FileSource("ts"))


def test_staging(spark, frame, tmp_path):
    pdf = pd.DataFrame({"k": [1], "event_timestamp": [pd.Timestamp("2021-01-01 00:00:00.123456")]})
    staged = stage_rows(spark, pdf, "event_timestamp", str(tmp_path))
    assert read_source(spark, staged).first()["k"] == 1
    for kind in ("timestamp", "timestamp_ntz"):
        df = frame(f"k int, ts {kind}", [(1, "2021-01-01 23:59:59.987654"), (2, "1969-12-31 23:59:59.999999")])
        source = stage_rows_by_day(spark, df, "ts", str(tmp_path))
        back = read_source(spark, source)
        assert [str(r["ts"])[:23] for r in back.orderBy("k").collect()] == [
            "2021-01-01 23:59:59.987",
            "1969-12-31 23:59:59.999",
        ]
        assert all(r["ts"].microsecond % 1000 == 0 for r in back.collect())
        assert rows_of(back.select(F.col("_partition_date").cast("string"))) == [("1969-12-31",), ("2021-01-01",)]


def test_scratch_tables_go_to_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    assert folder is None or path.startswith(folder)


def test_batch_ingestion(spark, customers, tmp_path):
    store = OnlineStore(spark, str(tmp_path / "online"))
    table = dataclasses.replace(TABLE, batch_source=FrameSource("ts", df=customers))
    dead = str(tmp_path / "dead")
    window = dict(start=dt.datetime(2021, 1, 2), end=dt.datetime(2021, 1, 3))
    report = ingest_batch(spark, table, store, **window, dead_letter=dead, expectations=RULES, tag="t")
    assert report == IngestionReport(read=4, ingested=1, rejected=3)
    assert rows_of(store.read(table), "customer", "feature1") == [("a", 2)]
    rejected = spark.read.parquet(f"{dead}/default_customers/t")
    assert rows_of(rejected, "customer") == [("b",), ("c",), (None,)]
    assert ingest_batch(spark, table, store, **window, tag="t") == IngestionReport(0, 0, 0)
    again = ingest_batch(spark, table, store, last_n_days=2, now=dt.datetime(2021, 1, 3, 5))
    assert again == IngestionReport(read=5, ingested=4, rejected=1)
    assert rows_of(store.read(table), "customer") == [("a",), ("b",), ("c",), ("d",)]
    with pytest.raises(ValueError):
        ingest_batch(spark, table, store)
    with pytest.raises(SchemaError):
        ingest_batch(spark, TABLE, store, **window)


def test_a_crash_before_the_store_loses_no_rejected_rows(spark, customers, tmp_path, monkeypatch):
    store = OnlineStore(spark, str(tmp_path / "online"))
    table = dataclasses.replace(TABLE, batch_source=FrameSource("ts", df=customers))
    options = dict(start=dt.datetime(2021, 1, 2), end=dt.datetime(2021, 1, 3), expectations=RULES, tag="t")
    options["dead_letter"] = str(tmp_path / "dead")
    with monkeypatch.context() as broken:
        broken.setattr(store, "write", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest_batch(spark, table, store, **options)
    report = ingest_batch(spark, table, store, **options, partitions=3)
    assert report == IngestionReport(read=4, ingested=1, rejected=3)
    assert spark.read.parquet(f"{options['dead_letter']}/default_customers/t").count() == 3


def test_a_mapping_that_changes_between_scans_is_refused(spark, customers, tmp_path):
    source = FrameSource("ts", df=customers, field_mapping={"feature1": "cast(rand() * 10 as int)"})
    table = dataclasses.replace(TABLE, batch_source=source)
    with pytest.raises(SchemaError):
        ingest_batch(spark, table, OnlineStore(spark, str(tmp_path)), last_n_days=1)


def started(spark, tmp_path, table, frames, schema, **options):
    folder = str(tmp_path / "in")
    for df in frames:
        df.coalesce(1).write.mode("append").parquet(folder)
    source = FileStreamSource(
        "ts",
        path=folder,
        schema=schema,
        message_format=options.pop("message_format", None),
        options={"maxFilesPerTrigger": "1"},
    )
    table = dataclasses.replace(table, stream_source=source)
    store = OnlineStore(spark, str(tmp_path / "online"))
    query = ingest_stream(
        spark, table, store, checkpoint=str(tmp_path / "cp"), available_now=True, **options
    )
    query.awaitTermination()
    return store, query


def test_stream_ingestion_over_batches_and_restarts(spark, frame, customers, tmp_path):
    dead, reports, progress = str(tmp_path / "dead"), [], ProgressLog()
    options = dict(expectations=RULES, dead_letter=dead, on_batch=reports.append)
    late = frame(ROWS, [("d", 9, 0.9, day(2)), ("e", 200, 0.9, day(2))])
    spark.streams.addListener(progress)
    try:
        store, query = started(spark, tmp_path, TABLE, [customers, late], customers.schema, **options)
        assert [(r.read, r.ingested, r.rejected) for r in reports] == [(6, 3, 3), (2, 1, 1)]
        assert rows_of(store.read(TABLE), "customer", "feature1") == [("a", 2), ("d", 6)]
        assert recent_progress(spark, query).count() >= 1
        for _ in range(50):
            if progress.latest:
                break
            time.sleep(0.1)
        assert progress.frame(spark).columns == recent_progress(spark, query).columns
    finally:
        spark.streams.removeListener(progress)
    # A new run with the same checkpoint goes on behind what was ingested.
    more = frame(ROWS, [("f", 1, 0.9, day(2))])
    store, _ = started(spark, tmp_path, TABLE, [more], customers.schema, **options)
    assert [r.read for r in reports] == [6, 2, 1]
    assert rows_of(store.read(TABLE), "customer") == [("a",), ("d",), ("f",)]
    rejected = spark.read.option("recursiveFileLookup", "true").parquet(dead)
    assert rows_of(rejected, "customer") == [("b",), ("c",), ("e",), (None,)]


@pytest.mark.parametrize(("drop_invalid", "stored"), [(False, ["a", "b", "d"]), (True, ["a", "d"])])
def test_refused_rows(spark, frame, tmp_path, drop_invalid, stored):
    rows = frame(ROWS, [("a", 1, 0.1, day(1)), ("b", 50, 0.1, day(1)), (None, 1, 0.1, day(1)), ("d", 2, 0.1, day(1))])
    dead = str(tmp_path / "dead")
    store, _ = started(
        spark,
        tmp_path,
        TABLE,
        [rows],
        rows.schema,
        validator=lambda b: b["feature1"] < 10,
        drop_invalid=drop_invalid,
        dead_letter=dead,
    )
    assert [r[0] for r in rows_of(store.read(TABLE), "customer")] == stored
    rejected = spark.read.option("recursiveFileLookup", "true").parquet(dead)
    assert rows_of(rejected, "customer") == [("b",), (None,)]


def test_malformed_messages_do_not_stop_a_stream(spark, tmp_path):
    messages = spark.createDataFrame(
        [
            ('{"customer": "a", "feature1": 1, "feature2": 0.5, "ts": "2021-01-01T00:00:00Z"}',),
            ("{broken",),
            ('{"customer": "b", "ts": "2021-01-01T00:00:00Z"}',),
        ],
        "value string",
    ).select(F.encode("value", "UTF-8").alias("value"), F.timestamp_seconds(F.lit(5)).alias(MESSAGE_TIME))
    reports = []
    store, _ = started(
        spark,
        tmp_path,
        TABLE,
        [messages],
        messages.schema,
        message_format=JsonFormat(ROWS),
        on_batch=reports.append,
    )
    assert [(r.read, r.ingested, r.rejected) for r in reports] == [(3, 2, 1)]
    assert reports[0].latest_message == dt.datetime(1970, 1, 1, 0, 0, 5)
    assert rows_of(store.read(TABLE), "customer", "feature2") == [("a", 0.5), ("b", None)]


def test_text_columns_are_not_made_of_other_types(spark, frame, tmp_path):
    rows = frame("customer int, feature1 int, feature2 double, ts timestamp", [(1, 1, 0.1, day(1))])
    with pytest.raises(SchemaError):
        started(spark, tmp_path, TABLE, [rows], rows.schema)


def test_trigger_label(spark, frame, tmp_path):
    rows = frame(ROWS, [("a", 1, 0.1, day(1))])
    folder = str(tmp_path / "in")
    rows.write.parquet(folder)
    source = FileStreamSource("ts", path=folder, schema=rows.schema)
    table = dataclasses.replace(TABLE, stream_source=source, labels={"_streaming_trigger_secs": "1"})
    store = OnlineStore(spark, str(tmp_path / "online"))
    query = ingest_stream(spark, table, store)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert store.read(table).count() == 1
    with pytest.raises(SchemaError):
        ingest_stream(spark, TABLE, store)


def test_rules_of_the_table_apply(spark, frame, tmp_path):
    rows = frame(ROWS, [("a", 1, 0.1, day(1)), ("b", 500, 0.1, day(1)), ("c", 60, 0.1, day(1))])
    labels = {"_expectations": json.dumps({"expectations": RULES})}
    table = dataclasses.replace(TABLE, labels=labels, batch_source=FrameSource("ts", df=rows))
    table = apply_validation(table, lambda b: b["feature1"] < 50, 30)
    assert table.labels["_streaming_trigger_secs"] == "30"
    batch_store = OnlineStore(spark, str(tmp_path / "batch"))
    assert ingest_batch(spark, table, batch_store, dt.datetime(2021, 1, 1), dt.datetime(2021, 1, 2)).ingested == 2
    store, _ = started(spark, tmp_path, table, [rows], rows.schema, drop_invalid=True)
    assert rows_of(store.read(table), "customer") == [("a",)]


def test_stream_declarations():
    conf = {
        "bootstrap_servers": "host:9092",
        "topic": "t",
        "event_timestamp_column": "ts",
        "field_mapping": {"a": "b"},
        "format": {"json_class": "AvroFormat", "schema_json": '"string"'},
    }
    source = stream_source_from_dict({"kafka": conf})
    assert source.message_format == AvroFormat('"string"') and source.field_mapping == {"a": "b"}
    proto = {"kafka": {**conf, "format": {"json_class": "ProtoFormat", "class_path": "a.B"}}}
    assert stream_source_from_dict(proto, b"x").message_format == ProtoFormat("a.B", b"x")
    with pytest.raises(ValueError):
        stream_source_from_dict(proto)
    with pytest.raises(ValueError):
        stream_source_from_dict({"kafka": {**conf, "format": {"json_class": "Other"}}})
    assert stream_source_from_dict({"kafka": {**conf, "format": None}}).message_format is None


def test_formats_of_missing_packages_are_refused(spark):
    df = spark.createDataFrame([(b"x",)], "value binary")
    for fmt in (AvroFormat('"string"'), ProtoFormat("a.B", b"")):
        with pytest.raises(SchemaError, match="package"):
            decode_messages(df, fmt)


def test_partitions_that_name_no_date_are_kept(spark, customers):
    bounds = dt.datetime(2021, 1, 2), dt.datetime(2021, 1, 3)
    part = F.when(F.col("customer") == "a", "2021-01").when(F.col("customer") == "b", None)
    texts = customers.withColumn("date", part.otherwise(F.date_format("ts", "yyyy-MM-dd")))
    source = FrameSource("ts", date_partition_column="date", df=texts)
    assert scan_range(spark, source, *bounds).count() == 4


def test_decode_without_format(customers):
    assert decode_messages(customers) is customers
    with pytest.raises(TypeError):
        decode_messages(customers, "csv", value="customer")


def test_figures(spark, customers):
    now = F.expr("timestamp'2021-01-03 00:00:01'")
    lag = lag_stats(customers, "ts", now).first()
    assert (lag["lag_count"], lag["lag_min"], lag["lag_max"]) == (6, 1000, 129_601_000)
    assert lag["lag_p50"] == 43_201_000
    assert tuple(row_counts(customers, F.col("feature1") > 1).first()) == (6, 4, 1)
    tables = [
        dataclasses.replace(TABLE, name="a", max_age=86_401),
        dataclasses.replace(TABLE, name="b", max_age=60),
        dataclasses.replace(TABLE, name="c", max_age=None),
        dataclasses.replace(TABLE, name="unseen", max_age=1),
    ]
    known = customers.filter("customer IN ('a', 'b', 'c')")
    assert health(known, "customer", "ts", tables, now) == {
        "passed": ["a", "c", "unseen"],
        "failed": ["b"],
    }
    rows = freshness(known, "customer", "ts", {"a": 86_400}, now).collect()
    assert [r["passed"] for r in rows] == [False]
