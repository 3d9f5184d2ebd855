"""Registry of the schemas that packed rows were written with: one file per schema reference.

A file is created exclusively, so that of several writers one makes it; the others read what it
wrote. A reference is four bytes of a hash: a second schema with the same one is refused.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.online import schema_reference
from tidemark.sinks.files import Folder

SCHEMA_FILE = "schema-{}.json"


def read_schemas(spark: SparkSession, path: str) -> DataFrame:
    """All registered schemas (schema_ref, schema_json); none before the first is written."""
    names = [n for n in Folder(spark, path).names(path) if n.startswith("schema-") and n.endswith(".json")]
    if not names:
        return spark.createDataFrame([], "schema_ref binary, schema_json string")
    files = spark.read.option("wholetext", True).text([f"{path.rstrip('/')}/{n}" for n in names])
    name = F.element_at(F.split(files.metadataColumn("_metadata")["file_name"], "[-.]"), -2)
    # A file whose writer broke off is no JSON yet.
    return files.select(F.unhex(name).alias("schema_ref"), F.col("value").alias("schema_json")).filter(
        F.get_json_object("schema_json", "$.type").isNotNull()
    )


def register_schema(spark: SparkSession, path: str, schema: T.StructType, patience: float = 10.0) -> bool:
    """Add a schema under its reference; False if it is there already.

    A file without content, of a writer that broke off, is written anew after ``patience`` seconds.
    """
    files, text = Folder(spark, path), schema.json()
    place = f"{path.rstrip('/')}/{SCHEMA_FILE.format(schema_reference(schema).hex())}"
    if files.create_text(place, text):
        return True
    known = files.read_text(place, patience)
    if not known:
        files.remove(place)
        return register_schema(spark, path, schema, patience)
    if known != text and T.StructType.fromJson(json.loads(known)) != schema:
        raise ValueError(f"another schema has the reference {schema_reference(schema).hex()}")
    return False
