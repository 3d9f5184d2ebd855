"""Batch scans: files, warehouse tables and frames, optionally bounded in time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import instant, partition_date
from tidemark.operators.mapping import quoted
from tidemark.spec import FileSource, FrameSource, Source, TableSource


def read_source(spark: SparkSession, source: Source) -> DataFrame:
    """All rows of a batch source, unmapped."""
    if isinstance(source, FrameSource):
        return source.df
    if isinstance(source, FileSource):
        reader = spark.read.format(source.format).options(**source.options)
        if source.schema is not None:
            reader = reader.schema(source.schema)
        return reader.load(source.path)
    if isinstance(source, TableSource):
        if source.format is None:
            return spark.read.options(**source.options).table(source.table)
        return spark.read.format(source.format).options(**source.options).load(source.table)
    raise TypeError(f"not a batch source: {type(source).__name__}")


def _utc(value: dt.datetime) -> dt.datetime:
    return value.astimezone(dt.timezone.utc) if value.tzinfo else value


def scan_range(
    spark: SparkSession, source: Source, start: dt.datetime, end: dt.datetime
) -> DataFrame:
    """Rows with an event time in ``[start, end)``.

    With a date partition column, also only its dates from ``start`` to ``end``, both included,
    so that other partitions are not read; partitions that name no date are. Naive bounds are UTC.
    """
    df = read_source(spark, source)
    kind = df.schema[source.event_timestamp_column].dataType
    ts = quoted(source.event_timestamp_column)
    bounded = df.filter((ts >= instant(start, kind)) & (ts < instant(end, kind)))
    if source.date_partition_column:
        name = source.date_partition_column
        part = partition_date(quoted(name), df.schema[name].dataType)
        days = part.between(F.lit(_utc(start).date()), F.lit(_utc(end).date()))
        bounded = bounded.filter(part.isNull() | days)
    return bounded


def last_days(days: int, now: dt.datetime | None = None) -> tuple[dt.datetime, dt.datetime]:
    """``[midnight of today - (days - 1), midnight tomorrow)`` in UTC, as naive datetimes."""
    if days < 1:
        raise ValueError("an ingestion window spans at least one day")
    now = _utc(now or dt.datetime.now(dt.timezone.utc)).replace(tzinfo=None)
    today = dt.datetime(now.year, now.month, now.day)
    return today - dt.timedelta(days=days - 1), today + dt.timedelta(days=1)
