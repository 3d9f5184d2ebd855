"""Declarations: value types, fields, feature tables and where their data comes from."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T


class SchemaError(Exception):
    """A spine or feature source lacks a column or has one of the wrong type."""


# The declared value types and the Spark type each one stands for.
VALUE_TYPES: dict[str, T.DataType] = {
    "bytes": T.BinaryType(),
    "string": T.StringType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "bool": T.BooleanType(),
    "bytes_list": T.ArrayType(T.BinaryType()),
    "string_list": T.ArrayType(T.StringType()),
    "int32_list": T.ArrayType(T.IntegerType()),
    "int64_list": T.ArrayType(T.LongType()),
    "double_list": T.ArrayType(T.DoubleType()),
    "float_list": T.ArrayType(T.FloatType()),
    "bool_list": T.ArrayType(T.BooleanType()),
}

EVENT_TS = "event_timestamp"
CREATED_TS = "created_timestamp"

# The labels by which a table declares how long its online rows must at least live,
# the seconds between micro-batches, and its row rules.
GC_THRESHOLD_LABEL = "gcThresholdSec"
STREAM_TRIGGER_LABEL = "_streaming_trigger_secs"
EXPECTATIONS_LABEL = "_expectations"


@dataclass(frozen=True)
class Field:
    name: str
    type: str

    def __post_init__(self):
        if self.type.lower() not in VALUE_TYPES:
            raise ValueError(f"unknown value type {self.type!r} for field {self.name!r}")

    @property
    def spark_type(self) -> T.DataType:
        return VALUE_TYPES[self.type.lower()]


@dataclass(frozen=True)
class Source:
    """What every batch or stream source declares about its rows."""

    event_timestamp_column: str
    created_timestamp_column: str | None = None
    field_mapping: Mapping[str, str] = field(default_factory=dict)
    date_partition_column: str | None = None


@dataclass(frozen=True)
class FileSource(Source):
    path: str = ""
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    schema: T.StructType | str | None = None


@dataclass(frozen=True)
class TableSource(Source):
    """A warehouse table: a catalog name, or the table name of a connector ``format``."""

    table: str = ""
    format: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class FrameSource(Source):
    """A DataFrame the caller already has."""

    df: DataFrame | None = None


@dataclass(frozen=True)
class KafkaSource(Source):
    bootstrap_servers: str = ""
    topic: str = ""
    message_format: Any = None
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class FileStreamSource(Source):
    """Files dropped into a directory, read as a stream."""

    path: str = ""
    schema: T.StructType | str | None = None
    format: str = "parquet"
    message_format: Any = None
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class FeatureTable:
    name: str
    entities: tuple[Field, ...]
    features: tuple[Field, ...]
    max_age: int | None = None
    project: str = "default"
    labels: Mapping[str, str] = field(default_factory=dict)
    batch_source: Source | None = None
    stream_source: Source | None = None
    tiebreak: str | None = None
    validator: Callable | None = None
    suite: tuple[Any, ...] = ()

    def __post_init__(self):
        object.__setattr__(self, "entities", tuple(self.entities))
        object.__setattr__(self, "features", tuple(self.features))
        if not self.entities:
            raise ValueError(f"feature table {self.name} needs at least one entity")
        if self.max_age is not None and self.max_age <= 0:
            raise ValueError(f"max_age of {self.name} must be a positive number of seconds")

    @property
    def entity_names(self) -> list[str]:
        return [f.name for f in self.entities]

    @property
    def feature_names(self) -> list[str]:
        return [f.name for f in self.features]

    @property
    def online_max_age(self) -> int | None:
        """Age limit used on ingestion: the declared one, lengthened by the gc label."""
        return max(self.max_age or 0, int(self.labels.get(GC_THRESHOLD_LABEL, 0))) or None


    @property
    def expectations(self) -> str | None:
        """JSON of the table's own row rules."""
        return self.labels.get(EXPECTATIONS_LABEL)


def apply_validation(
    table: FeatureTable, validator: Callable | Sequence[Any], validation_window_secs: int
) -> FeatureTable:
    """The table with a check of its stream in windows of the given length.

    ``validator`` is the rules of a suite, or a function that takes a pandas DataFrame of rows
    and returns one boolean per row.
    """
    labels = {**table.labels, STREAM_TRIGGER_LABEL: str(validation_window_secs)}
    if callable(validator):
        return replace(table, validator=validator, labels=labels)
    return replace(table, suite=tuple(validator), labels=labels)


def field_from_dict(dct: Mapping[str, str]) -> Field:
    return Field(dct["name"], dct["type"])


def feature_table_from_dict(dct: Mapping[str, Any]) -> FeatureTable:
    return FeatureTable(
        name=dct["name"],
        entities=tuple(map(field_from_dict, dct["entities"])),
        features=tuple(map(field_from_dict, dct["features"])),
        max_age=dct.get("max_age"),
        project=dct.get("project") or "default",
        labels=dct.get("labels") or {},
        tiebreak=dct.get("tiebreak"),
    )


# Names of the file formats in source declarations.
FORMAT_NAMES = {"ParquetFormat": "parquet", "AvroFormat": "avro", "CSVFormat": "csv"}


def source_from_dict(dct: Mapping[str, Any]) -> Source:
    """Build a batch source from ``{"file": {...}}`` or ``{"bq": {...}}``."""
    if len(dct) != 1 or next(iter(dct)) not in ("file", "bq"):
        raise ValueError(f"a source must be declared under 'file' or 'bq', got {sorted(dct)}")
    kind, conf = next(iter(dct.items()))
    common = dict(
        event_timestamp_column=conf["event_timestamp_column"],
        created_timestamp_column=conf.get("created_timestamp_column"),
        field_mapping=conf.get("field_mapping") or {},
        date_partition_column=conf.get("date_partition_column"),
    )
    if kind == "file":
        return FileSource(
            path=conf["path"],
            format=FORMAT_NAMES[conf["format"]["json_class"]],
            options=conf.get("options") or {},
            **common,
        )
    options = {"viewsEnabled": "true"}
    if conf.get("materialization"):
        options["materializationProject"] = conf["materialization"]["project"]
        options["materializationDataset"] = conf["materialization"]["dataset"]
    return TableSource(
        table=f"{conf['project']}:{conf['dataset']}.{conf['table']}",
        format="bigquery",
        options=options,
        **common,
    )


def select_feature_refs(refs: Sequence[str], tables: Sequence[FeatureTable]) -> list[FeatureTable]:
    """Tables named by ``"table:feature"`` refs, in first-seen order, cut down to those features.

    Features keep their declared order; entities, age limit and sources are kept.
    """
    known = {t.name: t for t in tables}
    wanted: dict[str, set[str]] = {}
    for ref in refs:
        table, sep, feature = ref.partition(":")
        if not sep or table not in known or feature not in known[table].feature_names:
            raise ValueError(f"unknown feature reference {ref!r}")
        wanted.setdefault(table, set()).add(feature)
    return [
        replace(known[name], features=tuple(f for f in known[name].features if f.name in features))
        for name, features in wanted.items()
    ]
