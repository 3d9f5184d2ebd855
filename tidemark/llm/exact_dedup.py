"""Exact deduplication by an exchange of Golomb-coded fingerprints.

Texts are equal if they are the same without blanks (space, tab to carriage return). Of equal
texts the row with the most code points stays, then the one with the smallest doc_id.

1. *Senders.* Each task cuts its rows into blocks, sorts a block by fingerprint (the leading bits
   of SHA-256) and makes a message per owner of a fingerprint range: the distinct fingerprints in
   Golomb-Rice code. The rows' ids stay in the same written row, outside the exchange.
2. *Owners* decode the messages for their range and answer each sender with a bitmap of the
   fingerprints that others sent as well. A block sends a fingerprint once, however many rows
   have it: a group of copies that holds a third of all rows is one entry per block.
3. *Suspects* are the rows whose bit is set or whose fingerprint occurs twice in the block. A bitmap
   of their places picks them in the scan, so that only their texts are shuffled (of a table so large
   that the bitmaps pass a measured bound, a join by place picks them instead); grouping
   by the bytes of the text decides.

Defined results: texts are taken whole, however long. Null text counts as empty, and all empty texts are equal to each other. Rows
with the same doc_id are rows of their own; of fully equal rows exactly one stays (the first by
file and position). A null doc_id is greater than any other. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import golomb
from tidemark.llm.common import AT, BLANK, FILE, at_places, identified, partitions_of, saved

MESSAGE = (
    "block bigint, owner int, n int, k int, payload binary, row_files array<bigint>, row_ats array<bigint>, "
    "doc_ids array<bigint>, digests array<binary>"
)


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, f"[{BLANK}]+", "")


def owner_low(owner: int, owners: int, bits: int) -> int:
    return -(-(owner << bits) // owners)


def sender(owners: int, bits: int, rows_per_block: int):
    """Rows to messages; ``bits`` of fingerprint, the same for all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        held, rows = [], 0

        def messages(table: pa.Table, block: int) -> Iterator[pa.RecordBatch]:
            digests = table["digest"].combine_chunks()
            heads = np.frombuffer(b"".join(d[:8] for d in digests.to_pylist()), ">u8").astype(np.uint64)
            marks = heads >> np.uint64(64 - bits)
            order = np.argsort(marks, kind="stable")
            marks, table = marks[order], table.take(order)
            owner_of = np.array([int(m) * owners >> bits for m in marks.tolist()])
            cuts = np.flatnonzero(np.diff(owner_of, prepend=-1))
            out = {name: [] for name in ("owner", "n", "k", "payload")}
            for start, end in zip(cuts, [*cuts[1:], len(marks)]):
                owner, distinct = int(owner_of[start]), np.unique(marks[start:end])
                low = owner_low(owner, owners, bits)
                k = golomb.rice_bits(owner_low(owner + 1, owners, bits) - low, len(distinct))
                out["owner"].append(owner)
                out["n"].append(len(distinct))
                out["k"].append(k)
                out["payload"].append(golomb.encode(distinct, low, k))
            offsets = pa.array([*cuts, len(marks)], pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, table[c].combine_chunks())
                for c in (FILE, AT, "doc_id", "digest")
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * len(cuts), pa.int64()),
                    pa.array(out["owner"], pa.int32()),
                    pa.array(out["n"], pa.int32()),
                    pa.array(out["k"], pa.int32()),
                    pa.array(out["payload"], pa.binary()),
                    *lists,
                ],
                names=["block", "owner", "n", "k", "payload", "row_files", "row_ats", "doc_ids", "digests"],
            )

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= rows_per_block:
                yield from messages(pa.Table.from_batches(held), block)
                held, rows, block = [], 0, block + 1
        if rows:
            yield from messages(pa.Table.from_batches(held), block)

    return run


def owner_answers(owners: int, bits: int):
    """All messages of one owner to a bitmap for each that has a fingerprint sent twice or more."""

    def run(messages: pd.DataFrame) -> pd.DataFrame:
        low = owner_low(int(messages["owner"].iloc[0]), owners, bits)
        sent = [
            golomb.decode(p, n, low, k)
            for p, n, k in zip(messages["payload"], messages["n"], messages["k"])
        ]
        _, at, times = np.unique(np.concatenate(sent), return_inverse=True, return_counts=True)
        twice = np.split(times[at] > 1, np.cumsum([len(s) for s in sent])[:-1])
        bitmaps = [np.packbits(t).tobytes() if t.any() else None for t in twice]
        return messages[["block", "owner"]].assign(bitmap=bitmaps).dropna()

    return run


def flagged(bits: int):
    """Messages beside their bitmaps to rows with ``suspect``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                heads = np.frombuffer(b"".join(d[:8] for d in row["digests"]), ">u8").astype(np.uint64)
                _, rank, times = np.unique(heads >> np.uint64(64 - bits), return_inverse=True, return_counts=True)
                suspect = times[rank] > 1
                if row["bitmap"] is not None:
                    suspect |= np.unpackbits(np.frombuffer(row["bitmap"], np.uint8))[rank].astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["row_files"], pa.int64()),
                        pa.array(row["row_ats"], pa.int64()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["digests"], pa.binary()),
                        pa.array(suspect),
                    ],
                    names=[FILE, AT, "doc_id", "digest", "suspect"],
                )

    return run


def exact_groups(rows: DataFrame, false_bits: int = 10, rows_per_block: int = 65_536) -> DataFrame:
    """``rows`` of ``identified`` to row_file, row_at, doc_id, keep_id, group_size, kept, digest.

    ``false_bits``: bits of fingerprint beyond those that number the rows; each halves the share
    of rows that are verified in vain. It changes no result.
    """
    spark = rows.sparkSession
    text = F.coalesce(F.col("doc.text").cast("string"), F.lit(""))
    owners = partitions_of(spark)
    bits = min(64, max(16, rows.count().bit_length() + false_bits))
    marked = rows.select(
        FILE,
        AT,
        F.col("doc.doc_id").cast("bigint").alias("doc_id"),
        F.unhex(F.sha2(normalised(text).cast("binary"), 256)).alias("digest"),
    )
    sent = saved(marked.mapInArrow(sender(owners, bits, rows_per_block), MESSAGE), "fingerprints")
    answers = (
        sent.select("block", "owner", "n", "k", "payload")
        .groupBy("owner")
        .applyInPandas(owner_answers(owners, bits), "block bigint, owner int, bitmap binary")
    )
    all_rows = saved(
        sent.drop("n", "k", "payload")
        .join(answers, ["block", "owner"], "left")
        .select("row_files", "row_ats", "doc_ids", "digests", "bitmap")
        .mapInArrow(
            flagged(bits),
            f"{FILE} bigint, {AT} bigint, doc_id bigint, digest binary, suspect boolean",
        ),
        "flagged",
    )
    suspects = saved(
        at_places(rows, all_rows.filter("suspect"), True).select(
            FILE,
            AT,
            F.col("doc.doc_id").cast("bigint").alias("doc_id"),
            F.char_length(text).alias("chars"),
            normalised(text).alias("bytes"),
        ),
        "suspects",
    )
    best = F.struct(
        (-F.col("chars")).alias("longest"),
        F.col("doc_id").isNull().alias("unnamed"),
        F.col("doc_id").alias("id"),
        F.col(FILE).alias("file"),
        F.col(AT).alias("at"),
    )
    # Written, so that the join below reads both sides afresh and a large group can be split there.
    groups = saved(
        suspects.groupBy("bytes").agg(F.min(best).alias("best"), F.count("*").alias("group_size")), "groups"
    )
    verified = suspects.join(groups, "bytes").select(
        FILE,
        AT,
        F.col("best.id").alias("keep_id"),
        "group_size",
        ((F.col(FILE) == F.col("best.file")) & (F.col(AT) == F.col("best.at"))).alias("kept"),
    )
    return all_rows.join(verified, [FILE, AT], "left").select(
        FILE,
        AT,
        "doc_id",
        F.when(F.col("kept").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.coalesce("kept", F.lit(True)).alias("kept"),
        "digest",
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    return exact_groups(identified(docs)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    rows = identified(docs)
    dropped = exact_groups(rows).filter(~F.col("kept")).select(FILE, AT)
    return at_places(rows, saved(dropped, "copies"), False).select("doc.*")
