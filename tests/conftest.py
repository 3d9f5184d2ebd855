import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, partitions=4, **{"spark.sql.dataFrameQueryContext.enabled": "false"})
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """``frame(schema, rows)`` with timestamps given as ISO text."""

    def build(schema, rows):
        from pyspark.sql import functions as F
        from pyspark.sql import types as T

        target = T._parse_datatype_string(schema)
        text = T.StructType(
            [
                T.StructField(f.name, T.StringType() if "timestamp" in f.dataType.simpleString() else f.dataType)
                for f in target.fields
            ]
        )
        df = spark.createDataFrame(rows, text)
        return df.select(*[F.col(f.name).cast(f.dataType) for f in target.fields])

    return build


def rows_of(df, *columns):
    """Rows as sorted tuples, the columns in the order given."""
    names = columns or df.columns
    return sorted((tuple(r[c] for c in names) for r in df.select(*names).collect()), key=repr)
