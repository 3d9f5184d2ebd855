"""Column mapping, typing and the canonical projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import is_timestamp, partition_date
from tidemark.spec import CREATED_TS, EVENT_TS, FeatureTable, Field, SchemaError, Source

# The date partition of a feature row, kept until the partitions out of reach are dropped.
DATE_PARTITION = "_tm_date"

_METADATA_SCHEMA = "field string, declared string, found string, problem string"


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def map_fields(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Apply ``{target: source column or SQL expression}`` and pass the other columns on.

    A mapped source column is renamed in place; an expression adds the target or replaces it.
    """
    if not mapping:
        return df
    renamed: dict[str, list[str]] = {}
    computed: dict[str, str] = {}
    for target, source in mapping.items():
        if source in df.columns:
            renamed.setdefault(source, []).append(target)
        else:
            computed[target] = source
    produced = {t for targets in renamed.values() for t in targets} | set(computed)
    out: list[Column] = []
    for name in df.columns:
        if name in renamed:
            out += [quoted(name).alias(target) for target in renamed[name]]
        elif name not in produced:
            out.append(quoted(name))
        elif name in computed:
            out.append(F.expr(computed.pop(name)).alias(name))
    out += [F.expr(sql).alias(target) for target, sql in computed.items()]
    return df.select(*out)


def types_match(declared: Field, column_type: T.DataType) -> bool:
    """Same type, whether or not the column's arrays may hold NULLs."""
    want = declared.spark_type
    if isinstance(want, T.ArrayType) and isinstance(column_type, T.ArrayType):
        return want.elementType == column_type.elementType
    return want == column_type


def _has_text(declared: Field) -> bool:
    return declared.type.lower() in ("string", "string_list")


def input_projection(
    schema: T.StructType, source: Source, entities: Sequence[Field], features: Sequence[Field]
) -> list[Column]:
    """Columns of an ingested row: entities, features and the event timestamp.

    A field comes from its mapped column or expression, else from the column of its own name.
    Columns of another type are cast to the declared type (NULL where that fails); expressions
    are taken as they are. Nothing is silently turned into text.
    """
    found = {f.name: f.dataType for f in schema.fields}
    out: list[Column] = []
    for field in [*entities, *features]:
        origin = source.field_mapping.get(field.name, field.name)
        if origin not in found:
            out.append(F.expr(origin).alias(field.name))
        elif types_match(field, found[origin]):
            out.append(quoted(origin).alias(field.name))
        elif _has_text(field):
            raise SchemaError(
                f"{field.name} is declared {field.type} but {origin} is "
                f"{found[origin].simpleString()}"
            )
        else:
            out.append(quoted(origin).try_cast(field.spark_type).alias(field.name))
    out.append(quoted(source.event_timestamp_column))
    return out


def schema_differences(df: DataFrame, table: FeatureTable) -> DataFrame:
    """One row per declared field that is missing from ``df`` or has another type there."""
    found = {f.name: f.dataType for f in df.schema.fields}
    rows = []
    for field in [*table.entities, *table.features]:
        if field.name not in found:
            rows.append((field.name, field.spark_type.simpleString(), None, "missing"))
        elif not types_match(field, found[field.name]):
            rows.append(
                (
                    field.name,
                    field.spark_type.simpleString(),
                    found[field.name].simpleString(),
                    "type",
                )
            )
    return df.sparkSession.createDataFrame(rows, _METADATA_SCHEMA)


def _narrows(declared: Field, column_type: T.DataType) -> bool:
    return isinstance(declared.spark_type, T.FloatType) and isinstance(column_type, T.DoubleType)


def feature_projection(df: DataFrame, table: FeatureTable, source: Source) -> DataFrame:
    """Check a mapped feature source and bring it to features, entities and both timestamps.

    The only type change allowed is double to float. A ``table.tiebreak`` column is kept too,
    and so is the date partition as ``_tm_date``; a partition value that is not a plain date is
    NULL there and its rows are never pruned.
    """
    if not source.created_timestamp_column:
        raise SchemaError(f"feature table {table.name} needs a created timestamp column")
    stamps = [source.event_timestamp_column, source.created_timestamp_column]
    found = {f.name: f.dataType for f in df.schema.fields}
    extra = [table.tiebreak] if table.tiebreak else []
    missing = [
        n for n in [*table.feature_names, *table.entity_names, *stamps, *extra] if n not in found
    ]
    if missing:
        raise SchemaError(f"{', '.join(missing)} missing for feature table {table.name}")
    out: list[Column] = []
    for field in [*table.features, *table.entities]:
        if types_match(field, found[field.name]):
            out.append(quoted(field.name))
        elif _narrows(field, found[field.name]):
            out.append(quoted(field.name).cast("float").alias(field.name))
        else:
            raise SchemaError(
                f"{field.name} of {table.name} should be {field.spark_type.simpleString()}, "
                f"but is {found[field.name].simpleString()}"
            )
    for name in stamps:
        if not is_timestamp(found[name]):
            raise SchemaError(f"{name} should be a timestamp, but is {found[name].simpleString()}")
    out += [quoted(stamps[0]).alias(EVENT_TS), quoted(stamps[1]).alias(CREATED_TS)]
    out += [quoted(n) for n in extra if n not in [*table.feature_names, *table.entity_names]]
    if source.date_partition_column in found:
        part = source.date_partition_column
        out.append(partition_date(quoted(part), found[part]).alias(DATE_PARTITION))
    return df.select(*out)


def check_spine(spine: DataFrame, event_ts: str, tables: Sequence[FeatureTable]) -> None:
    """The spine needs its timestamp and every table's keys, with exactly the declared types."""
    found = {f.name: f.dataType for f in spine.schema.fields}
    if event_ts not in found:
        raise SchemaError(f"{event_ts} is missing for the entity dataframe")
    if not is_timestamp(found[event_ts]):
        raise SchemaError(
            f"{event_ts} should be a timestamp, but is {found[event_ts].simpleString()}"
        )
    for table in tables:
        for field in table.entities:
            if field.name not in found or not types_match(field, found[field.name]):
                raise SchemaError(
                    f"{field.name} ({field.spark_type.simpleString()}) is not present in the "
                    f"entity dataframe"
                )


def prefixed(table: FeatureTable, column: str) -> str:
    return f"{table.name}__{column}"


def output_columns(spine: DataFrame, tables: Sequence[FeatureTable]) -> list[str]:
    """Spine columns in order, then ``table__feature`` in declared order."""
    return [*spine.columns, *(prefixed(t, f) for t in tables for f in t.feature_names)]


def flatten(df: DataFrame, struct_column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Fields of a decoded message as top-level columns, next to the ``keep`` columns."""
    return df.select(*[quoted(c) for c in keep], F.col(f"{struct_column}.*"))
