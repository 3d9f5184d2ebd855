"""Token ids of all documents as compressed blocks in ascending doc_id order, and back.

1. Texts are encoded once, to a scratch table; each task adds how often it saw each id.
2. One shared frequency table comes from these counts (bounded by the vocabulary), and is stored
   beside the blocks.
3. Rows are range-partitioned and sorted by doc_id; each partition is a shard of independent
   blocks of whole documents (see ``rans``). Spark writes the blocks as Parquet rows, so that
   files appear only when complete, on any file system, and a repeated task leaves no rest.
4. Readers decode blocks by themselves; where a block starts in the sequence of all ids comes
   from sums of blocks within shards and of shards.

Defined results: null and empty texts have the end id alone. Null doc_ids come first; rows with
the same doc_id come in file order. A text larger than a block is a block with more checkpoints.
An empty table gives no blocks. Other columns are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import rans
from tidemark.llm.common import AT, FILE, identified, partitions_of, saved
from tidemark.llm.tokens import Encoder, encoded

BLOCK_TOKENS = 1 << 17


def blocks_of(frequencies: np.ndarray, width: int, block_tokens: int):
    """Sorted documents to blocks; the partition's number is the shard's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, table, number = TaskContext.get().partitionId(), rans.Table(frequencies), 0

        def block(docs: list, sizes: list, held: list) -> pa.RecordBatch:
            lengths, tokens = np.concatenate(sizes), np.concatenate(held)
            return pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "block": pa.array([number], pa.int64()),
                    "n_tokens": pa.array([len(tokens)], pa.int64()),
                    "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(lengths)], pa.int32()), pa.concat_arrays(docs)),
                    "lengths": pa.array([lengths], pa.list_(pa.int64())),
                    "payload": pa.array([rans.encode(tokens, table)], pa.binary()),
                }
            )

        docs, sizes, held = [], [], []
        for batch in batches:
            ids, n = batch["ids"], batch.num_rows
            if not n:
                continue
            # All texts of the batch are one stretch of memory.
            offsets = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + n + 1].astype(np.int64) // width
            tokens = np.frombuffer(ids.buffers()[2], f"<u{width}", int(offsets[-1]))
            first = 0
            while first < n:
                room = block_tokens - sum(map(len, held))
                end = min(n, int(np.searchsorted(offsets, offsets[first] + room, "left")))
                docs.append(batch["doc_id"].slice(first, end - first))
                sizes.append(np.diff(offsets[first : end + 1]))
                held.append(tokens[offsets[first] : offsets[end]].copy())
                if sum(map(len, held)) >= block_tokens:
                    yield block(docs, sizes, held)
                    docs, sizes, held, number = [], [], [], number + 1
                first = end
        if docs:
            yield block(docs, sizes, held)

    return run


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, block_tokens: int = BLOCK_TOKENS, shards: int | None = None
) -> None:
    """Token files of ``docs`` at ``path``: ``blocks`` and ``frequencies``."""
    spark = docs.sparkSession
    width = Encoder(tokenizer).width
    made = saved(encoded(identified(docs), tokenizer, end_id=end_id, counts=True), "token_ids")
    ids = made.filter("ids IS NOT NULL")
    per_task = made.filter("seen IS NOT NULL").select(F.explode(F.arrays_zip("seen", "times")).alias("c"))
    counts = per_task.groupBy(F.col("c.seen").alias("id")).agg(F.sum("c.times").alias("n"))
    found = counts.collect()  # at most a row per id of the vocabulary
    by_id = np.zeros(1 + max((r["id"] for r in found), default=0), np.int64)
    for r in found:
        by_id[r["id"]] = r["n"]
    table = rans.frequencies(by_id)
    rows = [(i, int(f)) for i, f in enumerate(table.tolist()) if f]
    spark.createDataFrame(rows, "id bigint, frequency bigint").coalesce(1).write.parquet(f"{path}/frequencies")
    order = ["doc_id", AT, FILE]
    (
        ids.select(*order, "ids")
        .repartitionByRange(shards or partitions_of(spark), *order)
        .sortWithinPartitions(*order)
        .mapInArrow(
            blocks_of(table, width, block_tokens),
            "shard int, block bigint, n_tokens bigint, doc_ids array<bigint>, lengths array<bigint>, payload binary",
        )
        .write.option("compression", "none")
        .parquet(f"{path}/blocks")
    )


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """Token files to a row per document: doc_id, start, n_tokens, ids_crc32 and, on demand, ids
    (little-endian unsigned 32-bit)."""
    blocks = spark.read.parquet(f"{path}/blocks")
    found = spark.read.parquet(f"{path}/frequencies").collect()
    frequencies = np.zeros(1 + max((r["id"] for r in found), default=0), np.int64)
    for r in found:
        frequencies[r["id"]] = r["frequency"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(frequencies)
        for batch in batches:
            for row in batch.to_pylist():
                tokens = rans.decode(row["payload"], table).astype("<u4", copy=False)
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                if len(tokens) != ends[-1]:
                    raise ValueError("a token block that does not fit its documents")
                data = memoryview(tokens.tobytes())
                each = [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
                columns = {
                    "shard": pa.array([row["shard"]] * len(each), pa.int32()),
                    "block": pa.array([row["block"]] * len(each), pa.int64()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "within": pa.array(ends - lengths),
                    "n_tokens": pa.array(lengths),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in each], pa.int64()),
                }
                if ids:
                    columns["ids"] = pa.array([bytes(x) for x in each], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    schema = "shard int, block bigint, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint"
    decoded = blocks.mapInArrow(run, schema + (", ids binary" if ids else ""))

    def before(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    sizes = blocks.select("shard", "block", "n_tokens")
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    starts = (
        sizes.withColumn("in_shard", before("n_tokens", Window.partitionBy("shard").orderBy("block")))
        .join(shards.select("shard", before("total", Window.orderBy("shard")).alias("of_shard")), "shard")
        .select("shard", "block", (F.col("in_shard") + F.col("of_shard")).alias("block_start"))
    )
    columns = ["doc_id", (F.col("block_start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"]
    return decoded.join(starts, ["shard", "block"]).select(*columns, *(["ids"] if ids else []))
