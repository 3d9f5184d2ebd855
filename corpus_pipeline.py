"""Documents to packed training batches: five stages, each over all that the one before kept.

``run`` writes each stage's result to the shared scratch folder and reads it again, so that a
lost executor costs no more than tasks of the stage at hand.

Defined results: texts are taken whole, however long, and rows are told apart by file and position,
so that null and repeated doc_ids do no harm. Null, empty and blank texts go in the first stage, as
does what has fewer than ten words. Of equal rows one stays, the first by file and position. Null
sources are a source of their own. Each stage of an empty table is empty. Columns of other names,
also those that a stage uses itself, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import documents, saved
from tidemark.llm.exact_dedup import drop_exact_copies
from tidemark.llm.mixing import mixture
from tidemark.llm.packing import packed
from tidemark.llm.quality import drop_low_quality
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.simhash import drop_near_copies


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the weighed rules reject; equal texts fare alike."""
    return drop_low_quality(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the longest, then that with the smallest doc_id (null last)."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest doc_id (null last)."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture: any stretch of it has each source's share of the text."""
    return mixture(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a batch."""
    return packed(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# Expectation maximisation apart, XXH64 fingerprints and byte-pair encoding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
