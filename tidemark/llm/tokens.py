"""Token ids of whole texts, and the exact histogram of their number."""

from __future__ import annotations

import json
import re
import struct
import sys
from collections.abc import Callable, Iterator, Sequence
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import AT, FILE, identified, saved

CACHED_WORDS, CACHED_PIECES = 1 << 18, 1 << 19
LENGTHS_PER_SLICE = 1024


def byte_characters() -> dict[int, str]:
    """Byte to the character that byte-level vocabularies write for it: itself where it is
    printable Latin-1, else the next free code point from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Cache(dict):
    """Word to ids as bytes, made on first use."""

    def __init__(self, make: Callable[[str], bytes]):
        self.make = make

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = self.make(word)
        return ids


class Encoder:
    """Ids of texts by the ``tokenizers`` library, word by word from a bounded cache where that is the same.

    It is the same where the tokenizer lower-cases, drops white space and never joins what white
    space separates; any other tokenizer, and any text with a piece of a special token's mark,
    is encoded as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = f"<u{self.width}"
        self.letter = "H" if self.width == 2 else "I"
        marks = [t["content"][:2] for t in config["added_tokens"]]
        self.marked = re.compile("|".join(map(re.escape, marks)) or r"(?!)", re.I).search
        pattern = self._word_pattern(config)
        self.by_word = pattern is not None
        if self.by_word:
            import regex

            self.pieces = regex.compile(pattern).findall
            self.table = byte_characters()
            self.split = self.tokenizer.model.tokenize
            self.packed = [self._pack([i]) for i in range(self.tokenizer.get_vocab_size())]
            self.known = _Cache(self._piece)
            self.words = _Cache(self._word)
            # Letters, digits and marks whose case, composition and class all libraries agree on;
            # composed already.
            self.simple = re.compile("[!-~¡-įı-ſ]+").fullmatch

    @staticmethod
    def _word_pattern(config: dict) -> str | None:
        """The pattern that cuts pieces, if the tokenizer works word by word."""
        steps = (config["normalizer"] or {}).get("normalizers", [])
        cuts = (config["pre_tokenizer"] or {}).get("pretokenizers", [])
        if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or steps[1]["pattern"] != {"Regex": r"\s+"}:
            return None
        if [c["type"] for c in cuts] != ["Split", "ByteLevel"] or not cuts[0]["invert"] or cuts[0]["behavior"] != "Removed":
            return None
        if cuts[1]["add_prefix_space"] or cuts[1]["use_regex"] or config["model"]["type"] != "BPE":
            return None
        pattern = cuts[0]["pattern"].get("Regex", "")
        return pattern if r"[^\s" in pattern else None

    def _pack(self, ids: Sequence[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.letter}", *ids)

    def _piece(self, piece: str) -> bytes:
        # Printable ASCII, all that simple words have of it, is written as itself.
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.table)
        return b"".join([self.packed[t.id] for t in self.split(shown)])

    def _word(self, word: str) -> bytes:
        if not self.simple(word):
            return self._pack(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if not word.isascii():
            word = word.lower()
        # Letters, and letters before one mark or digit, need no search for pieces.
        if word.isalpha():
            return self.known[word]
        if word[:-1].isalpha() and not word[-1].isalpha():
            return self.known[word[:-1]] + self.known[word[-1]]
        return b"".join(map(self.known.__getitem__, self.pieces(word)))

    def encode(self, text: str) -> bytes:
        """Little-endian ids of ``width`` bytes each."""
        if not self.by_word or self.marked(text):
            return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        for cache, most in ((self.words, CACHED_WORDS), (self.known, CACHED_PIECES)):
            if len(cache) > most:
                cache.clear()
        # Only A to Z change here, as in the tokenizer; fewer words then differ.
        lower = text.encode().lower().decode().replace("\n", " ").replace("\t", " ").replace("\r", " ")
        return b"".join(map(self.words.__getitem__, lower.split(" ")))


def worker_encoder(path: str) -> Encoder:
    """The worker process's encoder, whose cache outlives a task."""
    kept = sys.modules.setdefault("_encoders", ModuleType("_encoders")).__dict__
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def encoded(rows: DataFrame, path: str, ids: bool = True, end_id: int | None = None, counts: bool = False) -> DataFrame:
    """Rows of ``identified`` to row_file, row_at, doc_id, n_tokens and, on demand, ids (binary).

    Null texts are empty. ``end_id`` is appended to every text and counted. With ``counts`` each
    task adds a row of its own that has only ``seen`` (ids) and ``times``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total = worker_encoder(path), np.zeros(0, np.int64)
        end = b"" if end_id is None else encoder._pack([end_id])
        for batch in batches:
            made = [encoder.encode(t or "") + end for t in batch["text"].to_pylist()]
            columns = {
                FILE: batch[FILE],
                AT: batch[AT],
                "doc_id": batch["doc_id"],
                "n_tokens": pa.array([len(b) // encoder.width for b in made], pa.int64()),
            }
            if ids:
                columns["ids"] = pa.array(made, pa.binary())
            if counts:
                found = np.bincount(np.frombuffer(b"".join(made), encoder.dtype), minlength=len(total))
                found[: len(total)] += total
                total = found
                columns |= {c: pa.nulls(batch.num_rows, pa.list_(pa.int64())) for c in ("seen", "times")}
            yield pa.RecordBatch.from_pydict(columns)
        if total.any():
            seen = np.flatnonzero(total)
            none = {c: pa.nulls(1, pa.int64()) for c in (FILE, AT, "doc_id", "n_tokens")}
            if ids:
                none["ids"] = pa.nulls(1, pa.binary())
            lists = {"seen": pa.array([seen]), "times": pa.array([total[seen]])}
            yield pa.RecordBatch.from_pydict(none | lists)

    schema = f"{FILE} bigint, {AT} bigint, doc_id bigint, n_tokens bigint" + (", ids binary" if ids else "")
    schema += ", seen array<bigint>, times array<bigint>" if counts else ""
    return rows.select(
        FILE,
        AT,
        F.col("doc.doc_id").cast("bigint").alias("doc_id"),
        F.col("doc.text").cast("string").alias("text"),
    ).mapInArrow(run, schema)


def length_table(lengths: DataFrame) -> DataFrame:
    """Documents by number of tokens, with suffix sums; a row per length that occurs.

    docs_at_least and tokens_at_least are the sums over this and all greater lengths;
    truncated_total is what remains of all documents if each is cut to n_tokens; quantile is the
    share of documents of at most n_tokens. Sums within slices of the lengths and sums of slices
    are added, so that no task holds the whole table.
    """
    counts = saved(lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "lengths")
    sliced = counts.withColumn("slice", F.expr(f"n_tokens div {LENGTHS_PER_SLICE}")).withColumn(
        "tokens", F.col("n_tokens") * F.col("n_docs")
    )
    after = Window.orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    slices = (
        sliced.groupBy("slice")
        .agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("slice_tokens"))
        .select(
            "slice",
            F.coalesce(F.sum("docs").over(after), F.lit(0)).alias("docs_above"),
            F.coalesce(F.sum("slice_tokens").over(after), F.lit(0)).alias("tokens_above"),
            F.sum("docs").over(everything).alias("total_docs"),
            F.sum("slice_tokens").over(everything).alias("total_tokens"),
        )
    )
    here = Window.partitionBy("slice").orderBy(F.desc("n_tokens"))
    suffix = (
        sliced.withColumn("docs_here", F.sum("n_docs").over(here))
        .withColumn("tokens_here", F.sum("tokens").over(here))
        .join(slices, "slice")
        .withColumn("docs_at_least", F.col("docs_here") + F.col("docs_above"))
        .withColumn("tokens_at_least", F.col("tokens_here") + F.col("tokens_above"))
    )
    return suffix.select(
        "n_tokens",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        (F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_total"),
        ((F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("total_docs")).alias("quantile"),
        "total_docs",
        "total_tokens",
    )


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """The length table of ``docs``. An empty table gives an empty result; null and empty texts
    count as 0 tokens; repeated rows count each."""
    return length_table(encoded(identified(docs), path, ids=False))


def at_limits(table: DataFrame, limits: Sequence[int]) -> DataFrame:
    """Of a length table, for any context limits: limit, docs_over, tokens_kept, tokens_cut."""
    each = table.withColumn("limit", F.explode(F.array(*[F.lit(x).cast("bigint") for x in limits])))
    kept = F.least("n_tokens", "limit") * F.col("n_docs")
    return each.groupBy("limit").agg(
        F.sum(F.when(F.col("n_tokens") > F.col("limit"), F.col("n_docs")).otherwise(0)).alias("docs_over"),
        F.sum(kept).alias("tokens_kept"),
        F.sum(F.col("n_tokens") * F.col("n_docs") - kept).alias("tokens_cut"),
    )


def quantiles(table: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Of a length table: share, n_tokens (the smallest that at least this share does not exceed)."""
    each = table.withColumn("share", F.explode(F.array(*[F.lit(float(x)) for x in shares])))
    return each.filter("quantile >= share").groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
