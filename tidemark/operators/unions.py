"""Unions that later stages may group by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.operators.mapping import quoted

# Spark 4.1 lets a union of inputs partitioned by the same keys pass for partitioned by them, but
# adaptive execution may coalesce the inputs' partitions differently; keys then meet in no one
# partition and a window or aggregate over the union gives wrong rows. A union of which ``keys``
# are named is therefore shuffled by them, which is what the window or aggregate would do anyway.


def union_rows(frames: Sequence[DataFrame], keys: Sequence[str] = ()) -> DataFrame:
    """All rows by column name; columns that a frame lacks are NULL. ``keys``: what the rows are
    going to be grouped by."""
    merged = frames[0]
    for df in frames[1:]:
        merged = merged.unionByName(df, allowMissingColumns=True)
    return merged.repartition(*[quoted(k) for k in keys]) if keys else merged
