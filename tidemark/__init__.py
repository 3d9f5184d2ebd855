"""Feature data on Spark: point-in-time joins, batch and stream ingestion, latest-value tables."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python workers travel with the query, so that the
# executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from tidemark.operators.asof import (  # noqa: E402
    SkewPolicy,
    as_of_join,
    join_feature_tables,
)
from tidemark.plans.ingestion import ingest_batch  # noqa: E402
from tidemark.plans.retrieval import (  # noqa: E402
    get_historical_features,
    retrieve_historical_features,
)
from tidemark.sinks.bucketed import join_bucketed, write_bucketed  # noqa: E402
from tidemark.sinks.history import FeatureHistory  # noqa: E402
from tidemark.sinks.online import OnlineStore  # noqa: E402
from tidemark.spec import (  # noqa: E402
    FeatureTable,
    Field,
    FileSource,
    FileStreamSource,
    FrameSource,
    KafkaSource,
    SchemaError,
    TableSource,
)
from tidemark.streaming.ingest import ingest_stream  # noqa: E402

__all__ = [
    "FeatureHistory",
    "FeatureTable",
    "Field",
    "FileSource",
    "FileStreamSource",
    "FrameSource",
    "KafkaSource",
    "OnlineStore",
    "SchemaError",
    "SkewPolicy",
    "TableSource",
    "as_of_join",
    "get_historical_features",
    "ingest_batch",
    "ingest_stream",
    "join_bucketed",
    "join_feature_tables",
    "retrieve_historical_features",
    "write_bucketed",
]
