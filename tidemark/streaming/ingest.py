"""Stream ingestion: every micro-batch is checked, applied to the store and its rejects kept."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.functions.checks import all_checks, prepare_suite, row_rule, validation_udf
from tidemark.functions.scalars import epoch_micros
from tidemark.operators.mapping import input_projection, quoted
from tidemark.operators.metrics import lag_by_name, lag_figures, lag_millis
from tidemark.sinks.dead_letter import dead_letter_root, write_dead_letters
from tidemark.sinks.online import OnlineStore
from tidemark.sources.stream import MESSAGE_TIME, read_stream
from tidemark.spec import STREAM_TRIGGER_LABEL, FeatureTable, SchemaError

ARRIVAL = "_arrival"
ROW_OK, IS_VALID, RULE = "_row_ok", "_is_valid", "_rule"


@dataclass(frozen=True)
class BatchReport:
    """Figures of one micro-batch; ``latest_message`` is the newest message time (Kafka).

    ``violations``: rows that break a rule of the table's suite, by the rule's name. ``lag``: from
    event time to now of the ingested rows in milliseconds, as in
    :func:`tidemark.operators.metrics.lag_stats`. ``late``: ingested rows older than the newest one that the
    store had of the table.
    """

    batch_id: int
    read: int
    ingested: int
    rejected: int
    latest_message: Any = None
    violations: Mapping[str, int] = field(default_factory=dict)
    late: int = 0
    lag: Mapping[str, float] = field(default_factory=dict)


def suite_columns(table: FeatureTable, columns) -> list[tuple[str, Column]]:
    """Name and column of each row rule of the table's suite."""
    rules = prepare_suite(table.suite, table.name)
    named = [(r.name, row_rule(r, columns)) for r in rules]
    return [(name, held) for name, held in named if held is not None]


def mark_rows(
    df: DataFrame,
    table: FeatureTable,
    event_ts: str,
    expectations=None,
    validator: Callable[[pd.DataFrame], pd.Series] | None = None,
) -> DataFrame:
    """Flags per row: ``_row_ok`` for the declared rules, ``_rule<n>`` for each row rule of the
    table's suite, ``_is_valid`` with the suite and the validator."""
    for i, (_, held) in enumerate(suite_columns(table, df.columns)):
        df = df.withColumn(f"{RULE}{i}", held)
    rules = [c for c in df.columns if c.startswith(RULE)]
    row_ok = all_checks(table, event_ts, expectations)
    valid = F.col(ROW_OK)
    if validator is not None:
        accepted = validation_udf(validator, [c for c in df.columns if c not in rules])
        valid = valid & F.coalesce(accepted, F.lit(False))
    for rule in rules:
        # A rule that could not be evaluated breaks none.
        valid = valid & F.coalesce(F.col(rule), F.lit(True))
    return df.withColumn(ROW_OK, row_ok).withColumn(IS_VALID, valid)


def apply_batch(
    batch: DataFrame,
    batch_id: int,
    table: FeatureTable,
    event_ts: str,
    store: OnlineStore,
    tag: str,
    dead_letter: str | None = None,
    expectations=None,
    validator=None,
    drop_invalid: bool = False,
    partitions: int | None = None,
) -> BatchReport:
    """One micro-batch. Rows that only the validator refuses are ingested and kept as rejects,
    unless ``drop_invalid``. The flags are computed once and kept while both sinks are written."""
    payload = [c for c in batch.columns if c != MESSAGE_TIME]
    names = [name for name, _ in suite_columns(table, batch.columns)]
    kind = batch.schema[event_ts].dataType
    now = F.current_timestamp() if isinstance(kind, T.TimestampType) else F.localtimestamp()
    marked = mark_rows(batch, table, event_ts, expectations, validator)
    marked = marked.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        taken = F.col(IS_VALID) if drop_invalid else F.col(ROW_OK)
        seen = store.last_events([table])[table.name]
        late = F.lit(False) if seen is None else epoch_micros(quoted(event_ts), kind) < seen
        newest = F.max(MESSAGE_TIME) if MESSAGE_TIME in batch.columns else F.lit(None)
        counts = marked.agg(
            F.count(F.lit(1)).alias("read"),
            F.count_if(taken).alias("ingested"),
            F.count_if(~F.col(IS_VALID)).alias("rejected"),
            newest.alias("latest_message"),
            F.count_if(taken & late).alias("late"),
            *[F.count_if(~F.col(f"{RULE}{i}")).alias(f"{RULE}{i}") for i in range(len(names))],
            *lag_figures(F.when(taken, lag_millis(marked, event_ts, now))),
        ).first()
        found = counts.asDict()
        report = BatchReport(
            batch_id,
            *[found[c] for c in ("read", "ingested", "rejected", "latest_message")],
            {name: found[f"{RULE}{i}"] for i, name in enumerate(names)},
            found["late"],
            lag_by_name(found),
        )
        if dead_letter and report.rejected:
            rejected = marked.filter(~F.col(IS_VALID)).select(*batch.columns)
            write_dead_letters(rejected, dead_letter_root(dead_letter, table), tag)
        if report.ingested:
            store.write(marked.filter(taken).select(*payload), table, event_ts, tag, partitions)
        return report
    finally:
        marked.unpersist()


def ingest_stream(
    spark: SparkSession,
    table: FeatureTable,
    store: OnlineStore,
    dead_letter: str | None = None,
    checkpoint: str | None = None,
    trigger_seconds: int | None = None,
    available_now: bool = False,
    expectations=None,
    validator: Callable[[pd.DataFrame], pd.Series] | None = None,
    drop_invalid: bool = False,
    partitions: int | None = None,
    on_batch: Callable[[BatchReport], None] | None = None,
    message_id: str | None = None,
    redelivery_seconds: int = 3_600,
) -> StreamingQuery:
    """Start ingesting a table's stream; ``available_now`` stops after what is there.

    The checkpoint lies at ``<checkpoint>/<project>/<table>``, so a restarted application goes
    on where it was. Micro-batches carry the query's id and their number into the store, which
    applies each of them once; their dead letters replace those of a broken-off try. Late rows need no
    watermark: the store never lets an older event time replace a newer one. Without
    ``expectations``, ``validator`` and ``trigger_seconds`` those of the table apply.

    ``message_id`` names the column of the message by which one that is delivered again within
    ``redelivery_seconds`` of its first arrival is left out. The state holds the ids of that time, across
    restarts; arrival is the time of the micro-batch, so that no row is too late however old its
    event time. ``recent_progress`` counts the repeated ones.
    """
    expectations = expectations if expectations is not None else table.expectations
    validator = validator or table.validator
    source = table.stream_source
    if source is None:
        raise SchemaError(f"feature table {table.name} has no stream source")
    parsed = read_stream(spark, source)
    columns = input_projection(parsed.schema, source, table.entities, table.features)
    if MESSAGE_TIME in parsed.columns:
        columns.append(F.col(MESSAGE_TIME))
    started, query_id = threading.Event(), []

    def run(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        report = apply_batch(
            batch,
            batch_id,
            table,
            source.event_timestamp_column,
            store,
            f"{query_id[0]}-{batch_id}",
            dead_letter,
            expectations,
            validator,
            drop_invalid,
            partitions,
        )
        if on_batch is not None:
            on_batch(report)

    if message_id is not None:
        if message_id not in parsed.columns:
            raise SchemaError(f"the messages of {table.name} have no column {message_id!r}")
        parsed = (
            parsed.withColumn(ARRIVAL, F.current_timestamp())
            .withWatermark(ARRIVAL, f"{redelivery_seconds} seconds")
            .dropDuplicatesWithinWatermark([message_id])
        )

    writer = parsed.select(*columns).writeStream.foreachBatch(run)
    if checkpoint:
        place = f"{checkpoint.rstrip('/')}/{table.project}/{table.name}"
        writer = writer.option("checkpointLocation", place)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        seconds = trigger_seconds
        if seconds is None:
            seconds = int(table.labels.get(STREAM_TRIGGER_LABEL, 0))
        writer = writer.trigger(processingTime=f"{seconds} seconds")
    query = writer.start()
    query_id.append(str(query.id))
    started.set()
    return query
