"""Historical retrieval: from sources and declarations to one training set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.asof import SkewPolicy, join_feature_tables
from tidemark.operators.mapping import check_spine, feature_projection, map_fields
from tidemark.sinks.training import write_training_set
from tidemark.sources.batch import read_source
from tidemark.sources.staging import stage_rows
from tidemark.spec import (
    FeatureTable,
    FrameSource,
    SchemaError,
    Source,
    feature_table_from_dict,
    select_feature_refs,
    source_from_dict,
)


def read_spine(spark: SparkSession, source: Source, tables: Sequence[FeatureTable]) -> DataFrame:
    spine = map_fields(read_source(spark, source), source.field_mapping)
    check_spine(spine, source.event_timestamp_column, tables)
    return spine


def read_features(spark: SparkSession, table: FeatureTable, source: Source) -> DataFrame:
    mapped = map_fields(read_source(spark, source), source.field_mapping)
    return feature_projection(mapped, table, source)


def retrieve(
    spark: SparkSession,
    spine_source: Source,
    feature_sources: Sequence[Source],
    tables: Sequence[FeatureTable],
    strategy: str = "auto",
    policy: SkewPolicy = SkewPolicy(),
    checkpoint: bool = False,
) -> DataFrame:
    """Read and check all sources, then join the spine with every feature table."""
    if len(feature_sources) != len(tables):
        raise ValueError("every feature table needs exactly one source")
    frames = [read_features(spark, t, s) for t, s in zip(tables, feature_sources)]
    spine = read_spine(spark, spine_source, tables)
    return join_feature_tables(
        spine,
        spine_source.event_timestamp_column,
        frames,
        tables,
        strategy,
        policy,
        checkpoint,
    )


def retrieve_historical_features(
    spark: SparkSession,
    entity_source_conf: Mapping[str, Any],
    feature_tables_sources_conf: Sequence[Mapping[str, Any]],
    feature_tables_conf: Sequence[Mapping[str, Any]],
    strategy: str = "auto",
    policy: SkewPolicy = SkewPolicy(),
    checkpoint: bool = False,
    output: tuple[str, str] | None = None,
) -> DataFrame:
    """:func:`retrieve` for sources and tables declared as dictionaries; ``output`` as in
    :func:`get_historical_features`."""
    spine = source_from_dict(entity_source_conf)
    result = retrieve(
        spark,
        spine,
        [source_from_dict(c) for c in feature_tables_sources_conf],
        [feature_table_from_dict(c) for c in feature_tables_conf],
        strategy,
        policy,
        checkpoint,
    )
    if output is not None:
        write_training_set(result, spine.event_timestamp_column, *output)
    return result


def get_historical_features(
    spark: SparkSession,
    feature_refs: Sequence[str],
    spine: Source | DataFrame,
    tables: Sequence[FeatureTable],
    output: tuple[str, str] | None = None,
    event_timestamp_column: str = "event_timestamp",
    strategy: str = "auto",
    policy: SkewPolicy = SkewPolicy(),
    staging_location: str | None = None,
    checkpoint: bool = False,
) -> DataFrame:
    """Values of ``"table:feature"`` refs at each spine row's time.

    The spine is a source, a Spark DataFrame or a pandas DataFrame (staged as Parquet first);
    the latter two use ``event_timestamp_column``. A feature source's date partition column, if
    declared, must hold the date of the event time, or no plain date: partitions out of reach are
    not read. With ``output=(format, path)`` the result is also written there, replacing earlier output.
    """
    wanted = select_feature_refs(feature_refs, tables)
    for table in wanted:
        if table.batch_source is None:
            raise SchemaError(f"feature table {table.name} has no batch source")
        if not table.batch_source.created_timestamp_column:
            raise SchemaError(f"feature table {table.name} needs a created timestamp column")
    if isinstance(spine, DataFrame):
        spine = FrameSource(event_timestamp_column, df=spine)
    elif not isinstance(spine, Source):
        spine = stage_rows(spark, spine, event_timestamp_column, staging_location)
    sources = [t.batch_source for t in wanted]
    result = retrieve(spark, spine, sources, wanted, strategy, policy, checkpoint)
    if output is not None:
        write_training_set(result, spine.event_timestamp_column, *output)
    return result
