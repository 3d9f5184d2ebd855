"""Feature tables stored by key: an as-of join reads them in place and shuffles only the spine."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame

from tidemark.functions.scalars import all_not_null
from tidemark.operators.asof import SkewPolicy, hot_feature_keys, is_hot_key, join_stored_features
from tidemark.operators.mapping import quoted
from tidemark.sinks.files import Folder
from tidemark.spec import EVENT_TS, FeatureTable


def write_bucketed(
    features: DataFrame,
    table: FeatureTable,
    name: str,
    path: str,
    buckets: int,
    policy: SkewPolicy = SkewPolicy(),
) -> None:
    """Store the rows of a feature projection under ``path``, as catalogue table ``name``.

    Rows go into ``buckets`` by key, sorted by key and time; choose as many as make a bucket fit one
    task. Keys with ``policy.hot_rows`` rows or more are kept beside, unbucketed, so that no bucket holds
    a large key. Rows without a key or a time match nothing and are left out. The table can be
    joined once its layout, the last file, is written.
    """
    spark, keys = features.sparkSession, sorted(table.entity_names)
    usable = features.filter(all_not_null([quoted(c) for c in [*keys, EVENT_TS]]))
    hot = hot_feature_keys(usable, table, policy)
    large = is_hot_key(table, list(hot))
    rows = usable.filter(~large).repartition(buckets, *[quoted(k) for k in keys])
    write = rows.write.bucketBy(buckets, *keys).sortBy(*keys, EVENT_TS)
    write.option("path", f"{path}/rows").saveAsTable(name)
    usable.filter(large).write.parquet(f"{path}/hot")
    layout = {"name": name, "buckets": buckets, "hot": [[h, n] for h, n in sorted(hot.items())]}
    Folder(spark, path).write_text(f"{path}/layout.json", json.dumps(layout))


def join_bucketed(
    spine: DataFrame,
    spine_ts: str,
    table: FeatureTable,
    path: str,
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """The rows of ``as_of_join`` with the features that ``write_bucketed`` stored at ``path``."""
    spark = spine.sparkSession
    layout = json.loads(Folder(spark, path).read_text(f"{path}/layout.json"))
    rows, hot = spark.table(layout["name"]), spark.read.parquet(f"{path}/hot")
    sizes = {h: n for h, n in layout["hot"]}
    return join_stored_features(spine, spine_ts, rows, layout["buckets"], hot, sizes, table, policy)
