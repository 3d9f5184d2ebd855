"""Periodic runs of words, from multi-scale minimizers.

A run is a stretch of words with smallest period q that is at least 6 words and 4 periods long
and that no neighbouring word extends.

*Scales.* The scale of periods above 2^(s-1) and up to 2^s takes k-mers of 2^s words and, of every
2^(s-1) of them in a row, the one with the smallest hash, the first of equal ones. Within a run,
two such windows a period apart see the same words and choose places a period apart; as a k-mer is
no shorter than the period, it has no copy in between. So the run shows as two successive
minimizers with equal hashes at its period's distance. These pairs are seeds; each is extended to
both sides word by word, which also rules out hash collisions. A scale takes time in proportion
to the words of the texts that are long enough for it, whatever their periods.

*Short periods*, up to 8 words, are looked for by comparing the words with themselves shifted.

Texts are taken side by side, some megabytes at a time, and cut by words of their own. A row
needs nothing but itself, so that there is no shuffle.

Defined results: words are what blanks (space, tab to carriage return) separate. Null, empty and
blank texts have no word, no run and an empty collapsed text. A text may have runs that overlap;
a word goes if any run has it after its first period. Rows that repeat, or have the same or null
doc_ids, are texts of their own. Texts are taken whole, however long. An empty table gives an
empty result. Kept columns travel in the struct ``doc`` and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import let, text_of, words_of
from tidemark.operators.mapping import quoted

LEAST_WORDS, COPIES = 6, 4
SHORT_BITS = 3  # periods up to 2^3 are scanned for directly
BYTES_AT_ONCE = 1 << 21
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class _Numbers(dict):
    """Word to a number, in the order of first use."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit hashes of 64-bit numbers (fixed values: the finaliser of MurmurHash3)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def least_length(period: int) -> int:
    return max(LEAST_WORDS, COPIES * period)


def lag_stretches(ids: np.ndarray, lag: int) -> list[tuple[int, int]]:
    """(start, length) of the stretches with this period, long enough, that nothing extends."""
    same = np.flatnonzero(ids[lag:] == ids[:-lag])
    if not len(same):
        return []
    begins = np.flatnonzero(np.diff(same, prepend=-2) > 1)
    sizes = np.diff(begins, append=len(same)) + lag
    long = sizes >= least_length(lag)
    return list(zip(same[begins[long]].tolist(), sizes[long].tolist()))


def equal_ahead(ids: np.ndarray, a: int, b: int, step: int = 64) -> int:
    """How many words from ``a`` on equal those from ``b`` on; a < b."""
    n = 0
    while True:
        there = ids[b + n : b + n + step]
        other = np.flatnonzero(there != ids[a + n : a + n + len(there)])
        if len(other):
            return n + int(other[0])
        n += len(there)
        if len(there) < step:
            return n
        step = min(2 * step, 1 << 16)


def seeds(ids: np.ndarray, hashes: np.ndarray, half: int) -> Iterator[tuple[int, int]]:
    """(place, period) of successive equal minimizers, by period and place.

    ``hashes`` are those of the k-mers of 2 * half words that begin at each place.
    """
    bits = np.uint64(len(ids).bit_length())
    places = np.arange(len(ids), dtype=np.uint64)
    least = hashes >> bits << bits | places
    step = 1
    while step < half:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    chosen = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    chosen = chosen[np.flatnonzero(np.diff(chosen, prepend=-1))]
    order = np.argsort(hashes[chosen], kind="stable")
    chosen = chosen[order]
    gaps = np.diff(chosen)
    fit = (np.diff(hashes[chosen]) == 0) & (gaps > half) & (gaps <= 2 * half)
    at, period = chosen[:-1][fit], gaps[fit]
    order = np.lexsort((at, period))
    return zip(at[order].tolist(), period[order].tolist())


def is_smallest(ids: np.ndarray, start: int, period: int) -> bool:
    """Whether no divisor of the period is a period as well."""
    rest, factor = period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            shorter = period // factor
            one = ids[start : start + period]
            if np.array_equal(one[shorter:], one[:-shorter]):
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


def runs_of(ids: np.ndarray, starts: np.ndarray) -> set[tuple[int, int, int]]:
    """(start, length, period) of all runs in several texts side by side, and some with a multiple of their period.

    Each text begins at one of ``starts`` and is followed by a word that occurs nowhere else.
    """
    found = set()
    for lag in range(1, min(1 << SHORT_BITS, len(ids) - 1) + 1):
        found.update((start, length, lag) for start, length in lag_stretches(ids, lag))
    sizes = np.diff(starts, append=len(ids))
    hashes = mixed(ids.view(np.uint64))
    original = np.arange(len(ids))
    half = 1
    while (long := sizes > least_length(max(half, 1 << SHORT_BITS) + 1)).any():
        if not long.all():
            kept = np.repeat(long, sizes)
            ids, hashes, original, sizes = ids[kept], hashes[kept], original[kept], sizes[long]
        # From k-mers of ``half`` words to those of twice as many.
        after = np.zeros_like(hashes)
        after[:-half] = hashes[half:]
        hashes = mixed(hashes * np.uint64(3) + after)
        if half >= 1 << SHORT_BITS:
            seen, end = 0, 0
            for at, period in seeds(ids, hashes, half):
                if period == seen and at < end:
                    continue
                ahead = equal_ahead(ids, at, at + period)
                # The same to the left, on the words in reverse order.
                back = equal_ahead(ids[::-1], len(ids) - at - period, len(ids) - at)
                seen, end = period, at + ahead
                start, length = at - back, back + ahead + period
                if length >= least_length(period):
                    found.add((int(original[start]), length, period))
        half *= 2
    return found


def text_runs(texts: Sequence[bytes]) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """For each text its words and its runs (start, length, period), by start, then period."""
    words = [text.split() for text in texts]
    numbers = _Numbers()
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    ids = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    ids[ends - 1] = -1 - np.arange(len(ends))
    for start, some in zip(starts.tolist(), words):
        ids[start : start + len(some)] = np.fromiter(map(numbers.__getitem__, some), np.int64, len(some))
    runs: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for start, length, period in sorted(runs_of(ids, starts)):
        if is_smallest(ids, start, period):
            text = int(np.searchsorted(starts, start, "right")) - 1
            runs[text].append((start - int(starts[text]), length, period))
    return zip(words, (sorted(r, key=lambda x: (x[0], x[2])) for r in runs))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by a blank, without what repeats the first period of a run."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """A row per row of ``docs``: doc (a struct of the columns to ``keep``), runs (start, length
    and period, by start, then period) and collapsed (the text without repetitions)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch["text"]).to_numpy())
            first = 0
            while first < batch.num_rows:
                before = sizes[first - 1] if first else 0
                end = max(first + 1, int(np.searchsorted(sizes, before + BYTES_AT_ONCE, "right")))
                part = batch.slice(first, end - first)
                runs, short = [], []
                for words, found in text_runs(part["text"].to_pylist()):
                    runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                    short.append(collapsed(words, found))
                yield pa.RecordBatch.from_arrays(
                    [part["doc"], pa.array(runs, RUNS), pa.array(short, pa.binary())], names=["doc", "runs", "collapsed"]
                )
                first = end

    given = docs.select(
        F.struct(*[quoted(c) for c in keep]).alias("doc"), text_of(docs).cast("binary").alias("text")
    )
    run_kind = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
    schema = T.StructType([given.schema["doc"]]).add("runs", T.ArrayType(run_kind)).add("collapsed", T.BinaryType())
    found = given.mapInArrow(run, schema)
    return found.select("doc", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def drop_repetitions(docs: DataFrame) -> DataFrame:
    """``docs`` with the text of rows that have a run collapsed, all columns kept."""
    text = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col("doc")["text"])
    return periodic_runs(docs, docs.columns).select(
        *[text.alias(c) if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns]
    )


def longest(runs: Column) -> Column:
    """The longest run of a list, the first of equal ones; null for none."""
    order = F.transform(runs, lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    return F.array_max(order)


def digests(found: DataFrame) -> DataFrame:
    """Rows of ``periodic_runs`` to doc_id, n_runs, the longest run and hashes of all runs and of
    the collapsed text."""
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    best = found.select("*", longest(F.col("runs")).alias("best"), F.array_join(line, "").alias("lines"))
    return best.select(
        F.col("doc.doc_id").alias("doc_id"),
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with a run to the end of the text in about every tenth row, fixed by the doc_id.

    Of h, the CRC32 of the doc_id in decimal, and g = h div 10: rows with words and h mod 10 = 0
    repeat, from word a = g mod n on, the p = 1 + (n - a) div (3 + g mod 8) words from there.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        a = F.pmod(g, n)
        period = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("bigint")

        def tail(a: Column, period: Column) -> Column:
            return F.transform(
                F.sequence(a, n - 1), lambda i: F.get(words, (a + F.pmod(i - a, period)).cast("int"))
            )

        planted = let(
            F.struct(a.alias("a"), period.alias("p")),
            lambda x: F.concat(F.slice(words, F.lit(1), x["a"].cast("int")), tail(x["a"], x["p"])),
        )
        return F.when(n > 0, F.array_join(planted, " ")).otherwise(F.lit(""))

    text = F.when(F.pmod(h, F.lit(10)) == 0, let(words_of(text_of(docs)), repeated)).otherwise(F.col("text"))
    return docs.withColumn("text", text)
