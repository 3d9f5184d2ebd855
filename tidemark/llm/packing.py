"""Packing into batches of a token budget, in length buckets that waste least.

Every batch is a rectangle: its rows are padded to their bucket's boundary. The boundaries come
from dynamic programming over the histogram of all lengths, which is exact: no other choice of
as many boundaries pads less. Batches then form inside each bucket, in the order of the input
(files by name, the shorter one first, and rows by their place in the file), so that a mixture that
was written in its order keeps it from batch to batch.

Texts longer than ``max_length`` tokens are cut into pieces of that length and a rest, so that
no token is lost and the histogram has at most ``max_length`` entries, at any size of input; only
that histogram reaches the driver.

Defined results: null and empty texts are one piece with the end id alone. Rows that repeat are
packed each. An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import AT, FILE, PATH, identified, running_totals, saved
from tidemark.llm.tokens import encoded


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """At most ``buckets`` of the (ascending, distinct) lengths, the last included, such that
    padding every length up to the next one costs least in all."""
    n = len(lengths)
    if n == 0:
        return []
    rows = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.int64)
    # cost[j]: least padding of the first j lengths with the buckets used so far.
    cost = np.full(n + 1, np.iinfo(np.int64).max // 4)
    cost[0] = 0
    choices = []
    for _ in range(min(buckets, n)):
        better, choice = np.empty_like(cost), np.zeros(n + 1, np.int64)
        better[0] = 0
        for j in range(1, n + 1):
            padded = cost[:j] + lengths[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            choice[j] = int(padded.argmin())
            better[j] = padded[choice[j]]
        choices.append(choice)
        cost = better
    found, j = [], n
    for choice in reversed(choices):
        if j == 0:
            break
        found.append(int(lengths[j - 1]))
        j = int(choice[j])
    return found[::-1]


def packed(
    docs: DataFrame, path: str, end_id: int = 2, buckets: int = 16, max_length: int = 4096, budget: int = 65_536
) -> DataFrame:
    """One row per piece: doc_id, piece, n_tokens, boundary, batch, slot, padding.

    ``batch`` numbers the batches of a bucket; the pair (boundary, batch) names one. A batch
    holds ``budget`` div boundary rows, the last of a bucket maybe fewer.
    """
    if not 0 < max_length <= budget:
        raise ValueError("max_length must be at least 1 and at most the budget")
    spark = docs.sparkSession
    rows = identified(docs)
    lengths = saved(encoded(rows, path, ids=False, end_id=end_id), "token_numbers")
    # A row per file. Part numbers of more than five digits make longer names.
    files = saved(rows.select(FILE, PATH).distinct(), "files").select(
        FILE, F.row_number().over(Window.orderBy(F.length(PATH), PATH)).alias("file_no")
    )
    pieces = lengths.withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n_tokens - 1) div {max_length}")))
    ).withColumn("n_tokens", F.least(F.lit(max_length), F.col("n_tokens") - F.col("piece") * max_length))
    histogram = pieces.groupBy("n_tokens").count().orderBy("n_tokens").collect()  # at most max_length rows
    found = boundaries(
        np.array([r[0] for r in histogram], np.int64), np.array([r[1] for r in histogram], np.int64), buckets
    )
    bucket_of = spark.createDataFrame(
        [(r[0], next(b for b in found if b >= r[0])) for r in histogram], "n_tokens bigint, boundary bigint"
    )
    table = saved(pieces.join(F.broadcast(bucket_of), "n_tokens").join(files, FILE), "pieces")
    ranked = running_totals(table, ["boundary"], ["file_no", AT, "piece"], F.lit(1), "rank", hashed=False)
    per_batch = F.expr(f"{budget} div boundary")
    return ranked.select(
        "doc_id",
        "piece",
        "n_tokens",
        "boundary",
        F.floor(F.col("rank") / per_batch).alias("batch"),
        (F.col("rank") % per_batch).alias("slot"),
        (F.col("boundary") - F.col("n_tokens")).alias("padding"),
    )
