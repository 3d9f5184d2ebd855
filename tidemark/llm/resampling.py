"""Importance resampling towards a target text, ranked by parallel sorting with regular sampling.

*Weights.* Words (ASCII letters lower-cased, digits, everything beyond ASCII) and runs of them are
features; a feature's bucket is its CRC32 modulo ``buckets``. One pass turns each text into an
array of buckets, and counts them on the way; a bucket's gain is the log ratio of its smoothed
share in the target to that in the documents, in whole thousandths. A document weighs the sum of
its features' gains, looked up as an array. Gumbel noise fixed by the doc_id makes the largest
scores a sample without replacement.

*Ranks.* Each task sorts its own rows and writes a sorted run. Every g-th row of a run is a sample
(g follows the number of rows, so that there are some 16 samples a segment); of all samples in order, every 16th
begins a segment. How many rows a segment has gives, summed up, the rank that it starts with, so
that segments behind the last rank drawn never move. The others are exchanged, merged in
their tasks and numbered. Keys end with the row's own place, so that no two are equal and a
segment can be cut anywhere, however many scores are equal.

Bounded: gains are ``buckets`` numbers, segments are as many as shuffle partitions (65,536 at
most), the driver sees samples and one count per segment.

Defined results: null texts have no feature and weight 0. A null doc_id is drawn with the noise of
an empty number and comes last among equal scores. Rows that repeat have ranks of their own, in the
order of file and position. Documents with fewer than ``least_words`` words have no rank. Without a
target text all gains follow from the smoothing alone. An empty table gives an empty result. Texts
are taken whole; other columns are never read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import AT, FILE, cut_array, cuts_before, identified, partitions_of, saved

CACHED_WORDS = 1 << 19
SAMPLES_PER_SEGMENT = 16
MOST_SEGMENTS = 1 << 16
# Lower-cases A-Z and turns all other ASCII characters but digits and letters into blanks.
CLEAN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


class _Checksums(dict):
    """Word to its CRC32, kept for the most recent words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        number = self[word] = zlib.crc32(word)
        return number


def feature_checksums(words: list[bytes], longest: int, known: _Checksums) -> np.ndarray:
    """CRC32 of all runs of 1 to ``longest`` words."""
    found = [list(map(known.__getitem__, words))]
    for extra in range(1, longest):
        found.append([zlib.crc32(w, zlib.crc32(b" ", c)) for c, w in zip(found[-1], words[extra:])])
    return np.concatenate([np.array(f, np.uint32) for f in found])


def featured(texts: DataFrame, longest: int, buckets: int) -> DataFrame:
    """row_file, row_at, doc_id and text (binary) to row_file, row_at, doc_id, n_words, n_features and
    marks (the buckets of all features); and a row per task with its ``counts`` of each bucket."""
    width = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _Checksums(), np.zeros(buckets, np.int64)
        for batch in batches:
            n_words, sizes, marks = [], [], []
            for text in batch["text"].to_pylist():
                words = text.translate(CLEAN).split()
                mark = (feature_checksums(words, longest, known) % np.uint32(buckets)).astype(width)
                n_words.append(len(words))
                sizes.append(len(mark))
                marks.append(mark.tobytes())
                # A short text has fewer features than there are buckets.
                if len(mark) < buckets:
                    np.add.at(total, mark, 1)
                else:
                    total += np.bincount(mark, minlength=buckets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch[FILE],
                    batch[AT],
                    batch["doc_id"],
                    pa.array(n_words, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(marks, pa.binary()),
                    pa.nulls(len(marks), pa.binary()),
                ],
                names=[FILE, AT, "doc_id", "n_words", "n_features", "marks", "counts"],
            )
        if total.any():
            none = [pa.nulls(1, pa.int64())] * 5
            yield pa.RecordBatch.from_arrays(
                [*none, pa.nulls(1, pa.binary()), pa.array([total.astype("<i8").tobytes()], pa.binary())],
                names=[FILE, AT, "doc_id", "n_words", "n_features", "marks", "counts"],
            )

    return texts.mapInArrow(
        run,
        f"{FILE} bigint, {AT} bigint, doc_id bigint, n_words bigint, n_features bigint, marks binary, counts binary",
    )


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """Sums of the tasks' counts; at most a row per bucket comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for counts in batch["counts"].to_pylist():
                total += np.frombuffer(counts, "<i8")
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})

    counted = features.filter("counts IS NOT NULL").select("counts").mapInArrow(run, "bucket bigint, n bigint")
    total = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] = n
    return total


def gains(target: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, by bucket."""
    all_target, all_documents, buckets = float(target.sum()), float(documents.sum()), len(target)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (all_documents + buckets) / ((s + 1.0) * (all_target + buckets))))
            for t, s in zip(target.tolist(), documents.tolist())
        ],
        np.int64,
    )


def noise(doc_id: int | None, seed: int) -> int:
    """Thousandths of a Gumbel variable that the doc_id fixes."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(features: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """Rows of ``featured`` to row_file, row_at, doc_id, n_words, n_features, weight and score."""
    width = "<u2" if len(gain) <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = [int(gain[np.frombuffer(m, width)].sum()) for m in batch["marks"].to_pylist()]
            scores = [w + noise(d, seed) for w, d in zip(weights, batch["doc_id"].to_pylist())]
            names = [FILE, AT, "doc_id", "n_words", "n_features"]
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in names], pa.array(weights, pa.int64()), pa.array(scores, pa.int64())],
                names=[*names, "weight", "score"],
            )

    return features.filter("marks IS NOT NULL").drop("counts").mapInArrow(
        run,
        f"{FILE} bigint, {AT} bigint, doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint",
    )


def first_ranks(rows: DataFrame, key: Column, wanted: int, n: int) -> DataFrame:
    """``rows``, ``n`` in number, with ``rank``: 1 to ``wanted`` by ``key``, which no two rows share; null beyond."""
    spark = rows.sparkSession
    segments = min(MOST_SEGMENTS, partitions_of(spark))
    every = max(1, n // (SAMPLES_PER_SEGMENT * segments))
    # The place in the sorted run is the number's lower half; runs take their samples at different places.
    sorted_rows = rows.withColumn("_key", key).sortWithinPartitions("_key")
    place = F.monotonically_increasing_id()
    sample = F.pmod(place + F.xxhash64(F.spark_partition_id()), F.lit(every)) == 0
    runs = saved(sorted_rows.withColumn("_sample", sample), "sorted_runs")
    samples = sorted(tuple(r["_key"]) for r in runs.filter("_sample").select("_key").collect())
    cuts = samples[SAMPLES_PER_SEGMENT - 1 :: SAMPLES_PER_SEGMENT]
    segment = cuts_before(F.col("_key"), cut_array(cuts, runs.schema["_key"].dataType))
    runs = runs.drop("_sample").withColumn("_segment", segment)
    sizes = dict(map(tuple, runs.groupBy("_segment").count().collect()))  # a row per segment
    starts, total = [], 0
    for number in sorted(sizes):
        if total >= wanted:
            break
        starts.append((number, total))
        total += sizes[number]
    last = starts[-1][0] if starts else -1
    begins = spark.createDataFrame(starts, "_segment int, _start bigint")
    within = F.row_number().over(Window.partitionBy("_segment").orderBy("_key"))
    ranked = runs.filter(F.col("_segment") <= last).withColumn("_within", within).join(F.broadcast(begins), "_segment")
    rank = (F.col("_start") + F.col("_within")).cast("bigint")
    ranked = ranked.withColumn("rank", F.when(rank <= wanted, rank)).drop("_start", "_within", "_segment", "_key")
    behind = runs.filter(F.col("_segment") > last).drop("_segment", "_key").withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(behind)


def ranked(
    rows: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    longest: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
) -> DataFrame:
    """Rows of ``identified`` to row_file, row_at, doc_id, n_features, weight, score and rank.

    ``target``: a frame with ``text``. ``percent`` of the documents with ``least_words`` are drawn;
    features are runs of up to ``longest`` words.
    """
    text = F.coalesce(F.col("doc.text").cast("string"), F.lit("")).cast("binary").alias("text")
    features = saved(
        featured(rows.select(FILE, AT, F.col("doc.doc_id").cast("bigint").alias("doc_id"), text), longest, buckets),
        "features",
    )
    nothing = F.lit(None).cast("bigint")
    wanted_texts = target.select(
        nothing.alias(FILE),
        nothing.alias(AT),
        nothing.alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    gain = gains(
        bucket_counts(featured(wanted_texts, longest, buckets), buckets), bucket_counts(features, buckets)
    )
    n = features.filter(F.col("n_words") >= least_words).count()
    key = F.struct(
        (F.col("n_words") < least_words).alias("short"),
        F.bitwise_not("score").alias("down"),  # descending
        F.col("doc_id").isNull().alias("unnamed"),
        F.coalesce("doc_id", F.lit(0).cast("bigint")).alias("doc_id"),
        F.col(FILE).alias("file"),
        F.col(AT).alias("at"),
    )
    return first_ranks(scored(features, gain, seed), key, percent * n // 100, n).drop("n_words")


def importance_resampling(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (null: not drawn)."""
    return ranked(identified(docs), target, **options).select("doc_id", "n_features", "weight", "score", "rank")


def resampled(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs``, all columns kept."""
    rows = identified(docs)
    drawn = saved(ranked(rows, target, **options).filter("rank IS NOT NULL").select(FILE, AT), "drawn")
    return rows.join(drawn, [FILE, AT], "left_semi").select("doc.*")
