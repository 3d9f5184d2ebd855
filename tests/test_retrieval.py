"""Retrieval from sources and declarations, with its schema checks."""


import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.plans.retrieval import get_historical_features, retrieve_historical_features
from tidemark.sinks.training import export_epoch, write_training_set
from tidemark.spec import (
    FeatureTable,
    Field,
    FileSource,
    FrameSource,
    SchemaError,
    TableSource,
    feature_table_from_dict,
    select_feature_refs,
    source_from_dict,
)

SPINE_CSV = """id,driver_id,event_timestamp
11,1,2021-05-02T00:00:00Z
11,1,2021-05-02T00:00:00Z
12,2,2021-05-02T06:00:00Z
12,1,2021-05-04T00:00:00Z
"""
DRIVER_CSV = """driver,datetime,created,trips
1,2021-05-01T12:00:00Z,2021-05-01T12:00:00Z,4
1,2021-05-01T12:00:00Z,2021-05-01T13:00:00Z,5
2,2021-05-02T06:00:00Z,2021-05-02T07:00:00Z,8
"""
CUSTOMER_CSV = """customer_id,event_timestamp,created_timestamp,spend
11,2021-05-01T00:00:00Z,2021-05-01T00:00:00Z,10.5
12,2021-05-03T23:00:00Z,2021-05-03T23:00:00Z,7.25
"""


@pytest.fixture
def csv(tmp_path):
    for name, text in [("spine", SPINE_CSV), ("driver", DRIVER_CSV), ("customer", CUSTOMER_CSV)]:
        (tmp_path / f"{name}.csv").write_text(text)

    def conf(name, **extra):
        file = {
            "format": {"json_class": "CSVFormat"},
            "path": str(tmp_path / f"{name}.csv"),
            "options": {"header": "true", "inferSchema": "true"},
            "event_timestamp_column": "event_timestamp",
            "created_timestamp_column": "created_timestamp",
        }
        return {"file": {**file, **extra}}

    return conf


DRIVERS = {
    "name": "drivers",
    "entities": [{"name": "driver_id", "type": "int32"}],
    "features": [{"name": "trips", "type": "int32"}],
    "max_age": 86_400,
}
CUSTOMERS = {
    "name": "customers",
    "entities": [{"name": "customer_id", "type": "int32"}],
    "features": [{"name": "spend", "type": "double"}],
    "max_age": 172_800,
}


def driver_conf(csv, **extra):
    return csv(
        "driver",
        event_timestamp_column="datetime",
        created_timestamp_column="created",
        field_mapping={"driver_id": "driver"},
        **extra,
    )


def test_retrieval_from_declarations(spark, csv):
    joined = retrieve_historical_features(
        spark,
        csv("spine", field_mapping={"customer_id": "id"}),
        [csv("customer"), driver_conf(csv)],
        [CUSTOMERS, DRIVERS],
    )
    assert joined.columns == [
        "customer_id",
        "driver_id",
        "event_timestamp",
        "customers__spend",
        "drivers__trips",
    ]
    got = rows_of(joined, "customer_id", "driver_id", "customers__spend", "drivers__trips")
    assert got == [(11, 1, 10.5, 5), (11, 1, 10.5, 5), (12, 1, 7.25, None), (12, 2, None, 8)]


@pytest.mark.parametrize(
    "change",
    [
        {"customers": {"entities": [{"name": "nobody", "type": "int32"}]}},
        {"customers": {"features": [{"name": "absent", "type": "double"}]}},
        {"customers": {"features": [{"name": "spend", "type": "int64"}]}},
        {"customers": {"entities": [{"name": "customer_id", "type": "int64"}]}},
        {"source": {"created_timestamp_column": None}},
        {"source": {"event_timestamp_column": "spend"}},
        {"source": {"created_timestamp_column": "nothing"}},
        {"spine": {"event_timestamp_column": "nothing"}},
        {"spine": {"event_timestamp_column": "driver_id"}},
        {"spine": {"field_mapping": {}}},
    ],
)
def test_schema_errors(spark, csv, change):
    table = {**CUSTOMERS, **change.get("customers", {})}
    spine = {"field_mapping": {"customer_id": "id"}, **change.get("spine", {})}
    with pytest.raises(SchemaError):
        retrieve_historical_features(
            spark, csv("spine", **spine), [csv("customer", **change.get("source", {}))], [table]
        )


def test_double_is_narrowed_to_float(spark, csv):
    table = {**CUSTOMERS, "features": [{"name": "spend", "type": "float"}]}
    joined = retrieve_historical_features(
        spark, csv("spine", field_mapping={"customer_id": "id"}), [csv("customer")], [table]
    )
    assert joined.schema["customers__spend"].dataType.simpleString() == "float"


def test_declarations():
    with pytest.raises(ValueError):
        feature_table_from_dict({**DRIVERS, "max_age": 0})
    assert feature_table_from_dict({**DRIVERS, "max_age": None}).max_age is None
    with pytest.raises(ValueError):
        Field("x", "decimal")
    with pytest.raises(ValueError):
        source_from_dict({"file": {}, "bq": {}})
    warehouse = source_from_dict(
        {
            "bq": {
                "project": "p",
                "dataset": "d",
                "table": "t",
                "event_timestamp_column": "ts",
                "materialization": {"project": "mp", "dataset": "md"},
            }
        }
    )
    assert isinstance(warehouse, TableSource) and warehouse.table == "p:d.t"
    assert warehouse.options["viewsEnabled"] == "true"
    assert warehouse.options["materializationDataset"] == "md"
    kept = FeatureTable(
        "t", [Field("k", "int32")], [Field("v", "int32")], 60, labels={"gcThresholdSec": "90"}
    )
    assert (kept.max_age, kept.online_max_age) == (60, 90)


def test_every_value_type_has_a_spark_type():
    # Declared type and Spark's name for it.
    expected = {
        "BYTES": "binary",
        "STRING": "string",
        "INT32": "int",
        "INT64": "bigint",
        "DOUBLE": "double",
        "FLOAT": "float",
        "BOOL": "boolean",
    }
    for name, spark_name in expected.items():
        assert Field("f", name).spark_type.simpleString() == spark_name
        assert Field("f", f"{name}_LIST").spark_type.simpleString() == f"array<{spark_name}>"


def test_feature_refs():
    fields = [Field("a", "int32"), Field("b", "int32")]
    tables = [FeatureTable(n, [Field("k", "int32")], fields) for n in ("t", "u")]
    chosen = select_feature_refs(["u:b", "t:a", "u:a"], tables)
    assert [(t.name, t.feature_names) for t in chosen] == [("u", ["a", "b"]), ("t", ["a"])]
    for bad in ("u:c", "x:a", "u"):
        with pytest.raises(ValueError):
            select_feature_refs([bad], tables)


def test_features_of_a_pandas_spine_and_output(spark, tmp_path):
    events = spark.sql(
        "SELECT 1L k, timestamp_ntz'2021-01-01 00:00:00' ts, timestamp_ntz'2021-01-01 00:00:00' c, 2.5D v"
    )
    source = FrameSource("ts", "c", df=events)
    table = FeatureTable("t", [Field("k", "int64")], [Field("v", "double")], 60, batch_source=source)
    spine = pd.DataFrame({"k": [1, 1], "event_timestamp": pd.to_datetime(["2021-01-01 00:01:00", "2021-01-01 00:02:00"])})
    spine = spark.createDataFrame(spine).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))
    out = str(tmp_path / "out")
    for _ in range(2):
        get_historical_features(spark, ["t:v"], spine, [table], output=("parquet", out))
    assert rows_of(spark.read.parquet(out), "t__v") == [(2.5,), (None,)]
    with pytest.raises(SchemaError):
        bare = FeatureTable("t", [Field("k", "int64")], [Field("v", "double")])
        get_historical_features(spark, ["t:v"], spine, [bare])
    stamped = events.select("k", F.col("ts").cast("timestamp").alias("ts"), F.col("c").cast("timestamp").alias("c"), "v")
    table = FeatureTable(
        "t",
        [Field("k", "int64")],
        [Field("v", "double")],
        60,
        batch_source=FrameSource("ts", "c", df=stamped),
    )
    pandas_spine = pd.DataFrame({"k": [1], "event_timestamp": [pd.Timestamp("2021-01-01 00:01:00")]})
    joined = get_historical_features(
        spark, ["t:v"], pandas_spine, [table], staging_location=str(tmp_path)
    )
    assert joined.first()["t__v"] == 2.5


def test_retrieval_from_a_catalog_table(spark):
    spark.sql("SELECT 1L k, timestamp'2021-01-01' ts, timestamp'2021-01-01' c, 3 v").createOrReplaceTempView("rates")
    table = FeatureTable(
        "rates",
        [Field("k", "int64")],
        [Field("v", "int32")],
        batch_source=TableSource("ts", "c", table="rates"),
    )
    spine = spark.sql("SELECT 1L k, timestamp'2021-01-02' event_timestamp")
    assert get_historical_features(spark, ["rates:v"], spine, [table]).first()["rates__v"] == 3


def test_epoch_export(spark, tmp_path):
    df = spark.sql(
        "SELECT timestamp'1970-01-02 00:00:00.9' ts UNION ALL SELECT timestamp'1969-12-31 23:59:59.5'"
    )
    assert rows_of(export_epoch(df, "ts")) == [(-1,), (86400,)]
    ntz = df.select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    assert rows_of(export_epoch(ntz, "ts")) == [(-1,), (86400,)]
    write_training_set(df, "ts", "json", str(tmp_path / "o"))
    assert spark.read.json(str(tmp_path / "o")).count() == 2


def test_only_needed_columns_and_times_are_read(spark, tmp_path):
    wide = spark.sql("SELECT 1L k, timestamp'2021-01-01' ts, timestamp'2021-01-01' c, 3 v, 'x' unused")
    wide.write.parquet(str(tmp_path / "wide"))
    table = FeatureTable(
        "t",
        [Field("k", "int64")],
        [Field("v", "int32")],
        60,
        batch_source=FileSource("ts", "c", path=str(tmp_path / "wide")),
    )
    spine = spark.sql("SELECT 1L k, timestamp'2021-01-01' event_timestamp")
    plan = get_historical_features(spark, ["t:v"], spine, [table])._jdf.queryExecution().toString()
    scans = [line for line in plan.split("== Physical Plan ==")[1].splitlines() if "FileScan" in line]
    assert scans and all("unused" not in s for s in scans)
    assert all("GreaterThanOrEqual(ts,2020-12-31" in s for s in scans)
