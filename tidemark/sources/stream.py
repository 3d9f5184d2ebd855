"""Stream scans."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.decode import AvroFormat, ProtoFormat, decode_messages
from tidemark.spec import FileStreamSource, KafkaSource, Source

MESSAGE_TIME = "_message_timestamp"


def stream_source_from_dict(
    dct: Mapping[str, Any], descriptor_set: bytes | None = None
) -> KafkaSource:
    """Build a stream source from ``{"kafka": {...}}``.

    Its format is ``AvroFormat`` with ``schema_json``, ``ProtoFormat`` with ``class_path`` (the
    message is then looked up in ``descriptor_set``), or none.
    """
    conf = dct["kafka"]
    declared = conf.get("format") or {}
    kind, message_format = declared.get("json_class"), None
    if kind == "AvroFormat":
        message_format = AvroFormat(declared["schema_json"])
    elif kind == "ProtoFormat":
        if descriptor_set is None:
            raise ValueError("a protobuf stream needs the descriptor set of its messages")
        message_format = ProtoFormat(declared["class_path"], descriptor_set)
    elif kind is not None:
        raise ValueError(f"unknown message format {kind!r}")
    return KafkaSource(
        conf["event_timestamp_column"],
        conf.get("created_timestamp_column"),
        conf.get("field_mapping") or {},
        bootstrap_servers=conf["bootstrap_servers"],
        topic=conf["topic"],
        message_format=message_format,
    )


def read_stream(spark: SparkSession, source: Source) -> DataFrame:
    """Decoded rows of a stream; Kafka rows keep their message time as ``_message_timestamp``."""
    if isinstance(source, KafkaSource):
        raw = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", source.bootstrap_servers)
            .option("subscribe", source.topic)
            .options(**source.options)
            .load()
        )
        stamped = raw.select(F.col("timestamp").alias(MESSAGE_TIME), "value")
        return decode_messages(stamped, source.message_format, keep=[MESSAGE_TIME])
    if isinstance(source, FileStreamSource):
        reader = spark.readStream.format(source.format).options(**source.options)
        raw = reader.schema(source.schema).load(source.path)
        keep = [c for c in [MESSAGE_TIME] if c in raw.columns]
        return decode_messages(raw, source.message_format, keep=keep)
    raise TypeError(f"not a stream source: {type(source).__name__}")
