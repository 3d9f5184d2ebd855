"""Batch ingestion: a bounded scan into the latest-value table, rejects to dead letters."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.checks import all_checks
from tidemark.operators.mapping import input_projection
from tidemark.sinks.dead_letter import dead_letter_root, write_dead_letters
from tidemark.sinks.online import OnlineStore
from tidemark.sources.batch import last_days, scan_range
from tidemark.spec import FeatureTable, SchemaError


@dataclass(frozen=True)
class IngestionReport:
    read: int
    ingested: int
    rejected: int


def project_input(df: DataFrame, table: FeatureTable, source) -> DataFrame:
    return df.select(*input_projection(df.schema, source, table.entities, table.features))


def ingest_batch(
    spark: SparkSession,
    table: FeatureTable,
    store: OnlineStore,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    last_n_days: int | None = None,
    now: dt.datetime | None = None,
    dead_letter: str | None = None,
    expectations=None,
    tag: str | None = None,
    partitions: int | None = None,
) -> IngestionReport:
    """Ingest rows with an event time in ``[start, end)``, or of the last days up to today.

    Without ``expectations`` the rules in the table's labels apply.
    Rejected rows are kept under ``dead_letter`` if given, before the others are applied, so that
    a crash between the two loses none; a repeated try with the same ``tag`` replaces them. They
    come from a second scan with the opposite filter, which at scale costs less than caching the
    input would, so the mapping must give the same values twice. A batch whose ``tag`` was
    ingested before is left alone and reported as empty. ``partitions``: into how many parts the
    batch is shuffled by key.
    """
    source = table.batch_source
    if source is None:
        raise SchemaError(f"feature table {table.name} has no batch source")
    if last_n_days is not None:
        start, end = last_days(last_n_days, now)
    if start is None or end is None:
        raise ValueError("give start and end, or last_n_days")
    projected = project_input(scan_range(spark, source, start, end), table, source)
    if not projected._jdf.queryExecution().analyzed().deterministic():
        raise SchemaError(f"{table.name} has a mapping that gives other values when read again")
    rules = expectations if expectations is not None else table.expectations
    check = all_checks(table, source.event_timestamp_column, rules)
    seen = Observation()
    counted = projected.observe(
        seen,
        F.count(F.lit(1)).alias("read"),
        F.count_if(check).alias("ingested"),
        F.count_if(~check).alias("rejected"),
    )
    if tag and store.has_batch(table, tag):
        return IngestionReport(0, 0, 0)
    if dead_letter:
        write_dead_letters(projected.filter(~check), dead_letter_root(dead_letter, table), tag)
    if not store.write(counted.filter(check), table, source.event_timestamp_column, tag, partitions):
        return IngestionReport(0, 0, 0)
    return IngestionReport(**seen.get)
