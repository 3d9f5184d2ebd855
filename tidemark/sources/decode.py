"""Decoding of message bytes into columns. A message that cannot be read gives NULL fields."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.mapping import flatten
from tidemark.spec import SchemaError

FEATURES = "_tm_features"


@dataclass(frozen=True)
class JsonFormat:
    schema: T.StructType | str


@dataclass(frozen=True)
class AvroFormat:
    """``schema_json`` is the writer's schema."""

    schema_json: str


@dataclass(frozen=True)
class ProtoFormat:
    """``descriptor_set`` is a serialised FileDescriptorSet with the message and its imports."""

    message: str
    descriptor_set: bytes


def _built_in(package: str, example: str) -> None:
    """Fail clearly where the session lacks one of Spark's own format packages."""
    from pyspark.sql import SparkSession

    loader = SparkSession.active()._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    if loader.getResource(example) is None:
        raise SchemaError(f"this needs Spark's {package} package on the class path of the session")


def from_proto(value: Column, fmt: ProtoFormat) -> Column:
    """Message bytes as a struct by Spark's protobuf package; NULL for malformed bytes."""
    _built_in("spark-protobuf", "org/apache/spark/sql/protobuf/ProtobufDataToCatalyst.class")
    from pyspark.sql.protobuf.functions import from_protobuf

    options = {"mode": "PERMISSIVE", "emit.default.values": "true"}
    return from_protobuf(value, fmt.message, options=options, binaryDescriptorSet=fmt.descriptor_set)


def from_avro(value: Column, fmt: AvroFormat) -> Column:
    """Message bytes as a struct by Spark's Avro package; NULL for malformed bytes."""
    _built_in("spark-avro", "org/apache/spark/sql/avro/AvroDataToCatalyst.class")
    from pyspark.sql.avro.functions import from_avro as spark_from_avro

    return spark_from_avro(value, fmt.schema_json, {"mode": "PERMISSIVE"})


def decode_value(value: Column, fmt) -> Column:
    """A message column as a struct of its fields."""
    if isinstance(fmt, JsonFormat):
        return F.from_json(value.cast("string"), fmt.schema, {"mode": "PERMISSIVE"})
    if isinstance(fmt, AvroFormat):
        return from_avro(value, fmt)
    if isinstance(fmt, ProtoFormat):
        return from_proto(value, fmt)
    raise TypeError(f"unknown message format {fmt!r}")


def decode_messages(
    df: DataFrame, fmt=None, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Fields of the messages as columns, next to ``keep``; without a format ``df`` as it is."""
    if fmt is None:
        return df
    decoded = df.select(*[F.col(c) for c in keep], decode_value(F.col(value), fmt).alias(FEATURES))
    return flatten(decoded, FEATURES, keep)
