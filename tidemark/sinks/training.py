"""Output of retrieved training sets and rejected rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.scalars import epoch_seconds
from tidemark.operators.mapping import quoted


def export_epoch(df: DataFrame, event_ts: str) -> DataFrame:
    """The event time as whole seconds since 1970, for formats without a timestamp type."""
    kind = df.schema[event_ts].dataType
    return df.select(
        *[
            epoch_seconds(quoted(c), kind).alias(c) if c == event_ts else quoted(c)
            for c in df.columns
        ]
    )


def write_training_set(df: DataFrame, event_ts: str, format: str, path: str) -> None:
    """Write in any Spark format, replacing what is there; ``tfrecord`` gets epoch seconds."""
    if format == "tfrecord":
        df = export_epoch(df, event_ts)
    df.write.format(format).mode("overwrite").save(path)
