"""Rejected rows as Parquet: a folder per tagged batch, else under the application that rejected them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.spec import FeatureTable


def dead_letter_root(path: str, table: FeatureTable) -> str:
    return f"{path.rstrip('/')}/{table.project}_{table.name}"


def write_dead_letters(df: DataFrame, path: str, tag: str | None = None) -> None:
    """Keep rejected rows. A batch with a ``tag`` has a folder of its own, which a repeated try
    replaces; others are appended."""
    if tag:
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{tag}")
    else:
        application = df.sparkSession.sparkContext.applicationId
        df.write.mode("append").parquet(f"{path.rstrip('/')}/{application}")
