"""Progress figures of running streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

_SCHEMA = (
    "query_id string, batch_id long, batch_time string, batch_duration_ms long, "
    "input_rows_per_second double, processed_rows_per_second double, "
    "repeated_rows long"
)


def _row(progress) -> tuple:
    return (
        str(progress.id),
        progress.batchId,
        progress.timestamp,
        progress.batchDuration,
        progress.inputRowsPerSecond,
        progress.processedRowsPerSecond,
        sum(int(op.customMetrics.get("numDroppedDuplicateRows", 0)) for op in progress.stateOperators),
    )


class ProgressLog(StreamingQueryListener):
    """Keeps the last figures of every query of the session: ``spark.streams.addListener``."""

    def __init__(self):
        self.latest: dict[str, tuple] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.latest[str(event.progress.id)] = _row(event.progress)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.latest.values()), _SCHEMA)


def recent_progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per recent micro-batch of a query."""
    return spark.createDataFrame([_row(p) for p in query.recentProgress], _SCHEMA)
