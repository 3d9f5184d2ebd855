"""Staging of caller-held rows, and the shared folder for scratch tables."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import floor_millis
from tidemark.operators.mapping import quoted
from tidemark.sinks.files import Folder
from tidemark.spec import FileSource

PARTITION_DATE = "_partition_date"
STAGED = "entities-until-"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a scratch table, in the shared folder ``spark.checkpoint.dir`` names.

    Where that is unset, a session that runs all tasks in this process gets a temporary folder;
    on a cluster no such folder is shared, and the call fails.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _frame(spark: SparkSession, rows) -> DataFrame:
    return rows if isinstance(rows, DataFrame) else spark.createDataFrame(rows)


def stage_rows(
    spark: SparkSession, rows, event_timestamp_column: str, location: str | None = None
) -> FileSource:
    """Write rows (pandas or Spark) as Parquet under ``location`` and return them as a source."""
    df = _frame(spark, rows)
    path = (
        f"{location.rstrip('/')}/dataframes/{uuid.uuid4().hex}"
        if location
        else scratch_path(spark, "staged")
    )
    df.write.parquet(path)
    return FileSource(event_timestamp_column, path=path, schema=df.schema)


def sweep_staged(spark: SparkSession, location: str, now: dt.datetime | None = None) -> list[str]:
    """Remove the staged copies under ``location`` whose day is past; their names."""
    files, passed = Folder(spark, location), []
    limit = (now or dt.datetime.now(dt.timezone.utc)).strftime("%Y%m%d%H%M%S")
    for name in files.names(location):
        until = name.removeprefix(STAGED).partition("-")[0]
        if name.startswith(STAGED) and until.isdigit() and until <= limit:
            files.remove(f"{location.rstrip('/')}/{name}")
            passed.append(name)
    return passed


def stage_rows_by_day(
    spark: SparkSession,
    rows,
    event_timestamp_column: str,
    location: str | None = None,
    now: dt.datetime | None = None,
) -> FileSource:
    """Stage rows in one partition per day, with times cut to milliseconds.

    The path carries the moment from which ``sweep_staged`` removes the copy (one day from now).
    """
    ts = event_timestamp_column
    df = _frame(spark, rows)
    columns = [
        floor_millis(quoted(c), df.schema[c].dataType).alias(c) if c == ts else quoted(c)
        for c in df.columns
    ]
    expires = (now or dt.datetime.now(dt.timezone.utc)) + dt.timedelta(days=1)
    name = f"{STAGED}{expires:%Y%m%d%H%M%S}"
    path = (
        f"{location.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        if location
        else scratch_path(spark, name)
    )
    staged = df.select(*columns, F.to_date(quoted(ts)).alias(PARTITION_DATE))
    # Few files per day, and no task with a whole hot day.
    staged = staged.hint("rebalance", F.col(PARTITION_DATE))
    staged.write.partitionBy(PARTITION_DATE).parquet(path)
    return FileSource(ts, path=path, date_partition_column=PARTITION_DATE)
