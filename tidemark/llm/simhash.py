"""Near-duplicates by SimHash fingerprints, matched exactly with Golay fuzzy keys.

A fingerprint has a bit for each of the 64 bits that is set in over half the hashes of a text's
word shingles. Fingerprints link if at most 4 bits differ, and texts are grouped by what they
reach over links.

*Keys.* The 64 bits are cut into ``exact + 4`` blocks, of which at least ``exact`` have no error
(pigeonhole). For each choice of so many blocks, the other bits hold at most four errors; of two
Golay segments of them one has at most two, and then a key in common. A key is the choice, its
exact bits, the segment and a codeword index, so every link has a key in common and none is
missed. More exact blocks give more, but longer keys: their number follows that of the
distinct fingerprints, so that a key's bucket stays small. The links found are the same.

*Buckets.* Copies are one fingerprint before keys are made. Within a bucket, distances are
checked and a spanning forest of the links is sent on, never all pairs. A bucket with more than
``chunk`` fingerprints is cut into chunks, and every two chunks meet in a task of their own.

Defined results: null and wordless texts have fingerprint zero, which links like any other. Texts
of fewer than four words are one shingle. Rows that repeat are one group. component_id is the
smallest doc_id that is not null, or null. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import AT, FILE, at_places, components, identified, partitions_of, saved
from tidemark.llm.golay import LENGTH, Golay

SEED, SHINGLE, DISTANCE = 42, 4, 4
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str) -> int:
    from xxhash import xxh64_intdigest

    # Bytes: lower() changes A to Z only, and split() cuts at space and tab to carriage return.
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        words = [b" ".join(words)]
        columns = [words]
    else:
        columns = [words[i:] for i in range(SHINGLE)]
    n = len(columns[-1])
    set_in = np.zeros(64, np.int64)
    for start in range(0, n, SHINGLES_AT_ONCE):
        part = zip(*[c[start : start + SHINGLES_AT_ONCE] for c in columns])
        hashes = np.fromiter(map(xxh64_intdigest, map(b" ".join, part), repeat(SEED)), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > n, bitorder="little").view("<u8")[0])


def fingerprints(rows: DataFrame) -> DataFrame:
    """Rows of ``identified`` to row_file, row_at, doc_id, fp (the bits as a signed number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(t or "") for t in batch["text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_pydict(
                {
                    FILE: batch[FILE],
                    AT: batch[AT],
                    "doc_id": batch["doc_id"],
                    "fp": pa.array(marks.view(np.int64)),
                }
            )

    return rows.select(
        FILE,
        AT,
        F.col("doc.doc_id").cast("bigint").alias("doc_id"),
        F.col("doc.text").cast("string").alias("text"),
    ).mapInArrow(run, f"{FILE} bigint, {AT} bigint, doc_id bigint, fp bigint")


def picked(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each value, side by side."""
    out = np.zeros(len(values), np.int64)
    for i, bit in enumerate(bits):
        out |= (values >> np.uint64(bit) & np.uint64(1)).astype(np.int64) << i
    return out


def layout(exact: int) -> list[tuple[list[int], list[list[int]]]]:
    """By choice: the bits that must be equal, and the two segments of the others."""
    edges = np.linspace(0, 64, exact + DISTANCE + 1).astype(int).tolist()
    blocks = [list(range(a, b)) for a, b in zip(edges, edges[1:])]
    out = []
    for chosen in combinations(range(len(blocks)), exact):
        equal = [b for i in chosen for b in blocks[i]]
        rest = [b for i in range(len(blocks)) if i not in chosen for b in blocks[i]]
        half = min(LENGTH, -(-len(rest) // 2))
        out.append((equal, [rest[:half], rest[half : half + LENGTH]]))
    return out


def keyed(exact: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay, choices = Golay(), layout(exact)
        for batch in batches:
            marks = batch["fp"].to_numpy().view(np.uint64)
            for c, (equal, segments) in enumerate(choices):
                exactly = picked(marks, equal)
                for half, bits in enumerate(segments):
                    at, index = golay.keys(picked(marks, bits))
                    key = (((exactly[at] << 12) | index) * len(choices) + c) * 2 + half
                    yield pa.RecordBatch.from_pydict({"key": pa.array(key), "fp": batch["fp"].take(pa.array(at))})

    return run


def close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= DISTANCE


def forest(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between the given distinct fingerprints that join what any links would join."""
    left, right, unseen, open_ = [], [], marks, []
    while len(unseen):
        if not open_:
            open_, unseen = [unseen[0]], unseen[1:]
        at = open_.pop()
        near = close(unseen, at)
        found = unseen[near]
        if len(found):
            left.append(np.full(len(found), at))
            right.append(found)
            open_.extend(found)
            unseen = unseen[~near]
    empty = np.empty(0, np.uint64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def bucket_links(chunk: int):
    """Sorted (key, fp) to links, and to chunks of the buckets that are too large for one task."""

    def made(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        pairs = np.unique(np.stack([a, b], axis=1).view(np.int64), axis=0)
        n = len(pairs)
        return pa.RecordBatch.from_pydict(
            {
                "a": pa.array(pairs[:, 0]),
                "b": pa.array(pairs[:, 1]),
                "key": pa.nulls(n, pa.int64()),
                "chunk": pa.nulls(n, pa.int32()),
                "fps": pa.nulls(n, pa.list_(pa.int64())),
            }
        )

    def held_back(key: int, number: int, marks: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {
                "a": pa.nulls(1, pa.int64()),
                "b": pa.nulls(1, pa.int64()),
                "key": pa.array([key], pa.int64()),
                "chunk": pa.array([number], pa.int32()),
                "fps": pa.array([marks.view(np.int64)], pa.list_(pa.int64())),
            }
        )

    def links(keys: np.ndarray, marks: np.ndarray) -> pa.RecordBatch | None:
        """Of whole buckets. Small ones side by side, larger ones each by itself."""
        starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
        sizes = np.diff(starts, append=len(keys))
        left, right = [], []
        for start, size in zip(starts[sizes > 16], sizes[sizes > 16]):
            a, b = forest(marks[start : start + size])
            left.append(a)
            right.append(b)
        small = np.repeat((sizes > 1) & (sizes <= 16), sizes)
        keys, marks = keys[small], marks[small]
        for shift in range(1, 16):
            both = np.flatnonzero(keys[:-shift] == keys[shift:])
            if not len(both):
                break
            both = both[close(marks[both], marks[both + shift])]
            left.append(marks[both])
            right.append(marks[both + shift])
        if sum(map(len, left)):
            return made(np.concatenate(left), np.concatenate(right))
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, marks, number = np.empty(0, np.int64), np.empty(0, np.uint64), 0
        for batch in batches:
            keys = np.concatenate([keys, batch["key"].to_numpy()])
            marks = np.concatenate([marks, batch["fp"].to_numpy().view(np.uint64)])
            if not len(keys):
                continue
            last = int(np.searchsorted(keys, keys[-1]))
            if last:
                if number:  # the rest of a bucket of which chunks were held back
                    end = int(np.searchsorted(keys, keys[0], "right"))
                    yield held_back(int(keys[0]), number, marks[:end])
                    keys, marks, last, number = keys[end:], marks[end:], last - end, 0
                if last and (found := links(keys[:last], marks[:last])):
                    yield found
                keys, marks = keys[last:], marks[last:]
            while len(keys) > chunk:
                yield held_back(int(keys[0]), number, marks[:chunk])
                keys, marks, number = keys[chunk:], marks[chunk:], number + 1
        if number:
            yield held_back(int(keys[0]), number, marks)
        elif len(keys) and (found := links(keys, marks)):
            yield found

    return run


def tile_links(chunks: pd.DataFrame) -> pd.DataFrame:
    a, b = forest(np.unique(np.concatenate(list(chunks["fps"])).astype(np.int64).view(np.uint64)))
    return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})


def linked(marks: DataFrame, exact: int | None = None, chunk: int = 8192) -> DataFrame:
    """Distinct ``fp`` (a saved table) to links (a, b) that connect what links connect."""
    spark = marks.sparkSession
    if exact is None:
        exact = 1 if (n := marks.count()) < 1 << 25 else 2 if n < 1 << 30 else 3
    keys = marks.select("fp").mapInArrow(keyed(exact), "key bigint, fp bigint")
    found = saved(
        keys.repartition(partitions_of(spark), "key")
        .sortWithinPartitions("key", "fp")
        .mapInArrow(bucket_links(chunk), "a bigint, b bigint, key bigint, chunk int, fps array<bigint>"),
        "bucket_links",
    )
    large = found.filter("key IS NOT NULL").select("key", "chunk", "fps")
    chunks = large.groupBy("key").agg((F.max("chunk") + 1).alias("chunks"))
    tiles = (
        large.join(chunks, "key")
        .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
        .select("key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "fps")
        .groupBy("key", "i", "j")
        .applyInPandas(tile_links, "a bigint, b bigint")
    )
    return found.filter("key IS NULL").select("a", "b").unionByName(tiles)


def near_groups(rows: DataFrame) -> DataFrame:
    """Rows of ``identified`` to row_file, row_at, doc_id, fp, component_id, kept (one row a group)."""
    marked = saved(fingerprints(rows), "simhash")
    first = F.struct(
        F.col("doc_id").isNull().alias("unnamed"),
        F.col("doc_id").alias("id"),
        F.col(FILE).alias("file"),
        F.col(AT).alias("at"),
    )
    distinct = saved(marked.groupBy("fp").agg(F.min(first).alias("first")), "distinct_fp")
    roots = components(linked(distinct), "near_links")
    rooted = saved(
        distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )
    best = rooted.groupBy("root").agg(F.min("first").alias("best"))
    by_mark = saved(rooted.join(best, "root").select("fp", "best"), "fp_groups")
    return marked.join(by_mark, "fp").select(
        FILE,
        AT,
        "doc_id",
        "fp",
        F.col("best.id").alias("component_id"),
        ((F.col(FILE) == F.col("best.file")) & (F.col(AT) == F.col("best.at"))).alias("kept"),
    )


def near_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, kept."""
    return near_groups(identified(docs)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "kept"
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group, all columns kept."""
    rows = identified(docs)
    dropped = near_groups(rows).filter(~F.col("kept")).select(FILE, AT)
    return at_places(rows, saved(dropped, "near_copies"), False).select("doc.*")
