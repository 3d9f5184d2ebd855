"""Toxicity by two class-conditional Kneser-Ney models of words' spelling.

Each class (toxic, ordinary) has a model that spells a word character by character from the
``ORDER`` characters before; what it has not seen it takes from lower orders that both classes
share, whose counts are those of different continuations. A rare expression so says little by
itself, but as much as its parts say. A word's log-likelihood ratio is the sum over its
characters; a document's figures are the ratio per character of the whole text (length-normalised)
and the largest ratio of a single word, so that one expression counts in a long text too. A
logistic function of both, fitted on rows that the models have not seen, is the score.

Learning rows are labelled documents whose crc32(doc_id) mod 5 is not 0: all of them, or, of a
class with more than ``max_rows``, the share with the smallest hashes. That bound bounds the
models, which are all that reaches the driver; scoring reads every whole text without a shuffle.
The logistic function weighs each of its rows by how many labels of its class it stands for, so
that the bound leaves the share of toxic rows, and with it the scores, as they are.

Defined results: null and wordless texts have both figures 0. Labels without a doc_id or a value
are ignored; of several for one doc_id, toxic wins. Labels without a document are ignored, and
all documents of a repeated doc_id take its label. Without learning rows of both classes every
score is the share of toxic ones among those there are, or 0. Other columns are never read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved

ORDER, DISCOUNT, UNSEEN = 5, 0.75, 1e-4
CACHED_WORDS = 1 << 18
START, END = "\x02", "\x03"


def remainder(doc_id: Column, by: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % by


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W\d_]+", text.lower())


def spelled(word: str, order: int) -> list[str]:
    """Each character of the word and its end, with up to ``order`` characters before it."""
    marked = f"{START}{word}{END}"
    return [marked[max(0, i - order) : i + 1] for i in range(1, len(marked))]


def model(grams: dict[str, tuple[int, int]]) -> tuple[dict[str, float], dict[str, float]]:
    """Counts (toxic, ordinary) by gram to the log ratio of each gram, and of each context for
    what neither class has seen there."""
    totals: tuple[Counter, Counter] = Counter(), Counter()
    kinds: tuple[Counter, Counter] = Counter(), Counter()
    for gram, counts in grams.items():
        for side in (0, 1):
            if counts[side]:
                totals[side][gram[:-1]] += counts[side]
                kinds[side][gram[:-1]] += 1
    # Shared lower orders: how many different longer grams end in this one.
    endings: Counter = Counter()
    level = set(grams)
    while level:
        shorter = Counter(g[1:] for g in level if len(g) > 1)
        endings.update(shorter)
        level = set(shorter)
    shared_totals, shared_kinds = Counter(), Counter()
    for gram, n in endings.items():
        shared_totals[gram[:-1]] += n
        shared_kinds[gram[:-1]] += 1
    known: dict[str, float] = {}

    def shared(gram: str) -> float:
        if gram not in known:
            lower = shared(gram[1:]) if len(gram) > 1 else UNSEEN
            n = shared_totals[gram[:-1]]
            known[gram] = (
                (max(endings[gram] - DISCOUNT, 0) + DISCOUNT * shared_kinds[gram[:-1]] * lower) / n if n else lower
            )
        return known[gram]

    def chance(side: int, gram: str, count: int) -> float:
        n = totals[side][gram[:-1]]
        if not n:
            return shared(gram[1:])
        return (max(count - DISCOUNT, 0) + DISCOUNT * kinds[side][gram[:-1]] * shared(gram[1:])) / n

    def escape(side: int, context: str) -> float:
        n = totals[side][context]
        return DISCOUNT * kinds[side][context] / n if n else 1.0

    ratios = {g: math.log(chance(0, g, c[0]) / chance(1, g, c[1])) for g, c in grams.items()}
    escapes = {h: math.log(escape(0, h) / escape(1, h)) for h in {g[:-1] for g in grams}}
    return ratios, escapes


def figures_of(fitted: tuple[dict[str, float], dict[str, float]]):
    """Text to (ratio per character, largest ratio of a word)."""
    ratios, escapes = fitted
    known: dict[str, float] = {}

    def word_ratio(word: str) -> float:
        found = known.get(word)
        if found is None:
            found = sum(ratios[g] if g in ratios else escapes.get(g[:-1], 0.0) for g in spelled(word, ORDER))
            known[word] = found
        return found

    def figures(text: str) -> tuple[float, float]:
        if len(known) > CACHED_WORDS:
            known.clear()
        words = words_of(text)
        each = [word_ratio(w) for w in words]
        return (sum(each) / sum(map(len, words)), max(each)) if words else (0.0, 0.0)

    return figures


def learning_rows(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """text, toxic, fold (1: for the logistic function, else for the models) and weight (the
    labels of the row's class and kind of fold for each one that is chosen)."""
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter((remainder(F.col("doc_id"), 5) != 0) & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    known = saved(known, "labels")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.lit(0.0)
    for toxic in (0, 1):
        share = F.when(F.col("toxic") == toxic, min(1.0, max_rows / sizes.get(toxic, 1))).otherwise(share)
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53)
    back = remainder(F.col("doc_id"), 5) == 1
    weight = F.lit(1.0)
    for r in known.groupBy("toxic", back.alias("back")).agg(F.count("*").alias("n"), F.count_if(place < share).alias("m")).collect():
        if r["m"]:
            mine = (F.col("toxic") == r["toxic"]) & (back == r["back"])
            weight = F.when(mine, r["n"] / r["m"]).otherwise(weight)
    # About 2 * max_rows rows of three numbers: a proven bound.
    chosen = F.broadcast(known.filter(place < share).withColumn("weight", weight))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(chosen, "doc_id").select("text", "toxic", remainder(F.col("doc_id"), 5).alias("fold"), "weight")


def class_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: tuple[Counter, Counter] = Counter(), Counter()
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
            counts[0 if toxic else 1].update(words_of(text or ""))
        words = list(set(counts[0]) | set(counts[1]))
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(words, pa.string()),
                "toxic": pa.array([counts[0][w] for w in words], pa.int64()),
                "ordinary": pa.array([counts[1][w] for w in words], pa.int64()),
            }
        )


def word_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: dict[str, list[int]] = {}
        for word, toxic, ordinary in zip(*[batch[c].to_pylist() for c in ("part", "toxic", "ordinary")]):
            for gram in spelled(word, ORDER):
                counts = found.setdefault(gram, [0, 0])
                counts[0] += toxic
                counts[1] += ordinary
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(list(found), pa.string()),
                "toxic": pa.array([c[0] for c in found.values()], pa.int64()),
                "ordinary": pa.array([c[1] for c in found.values()], pa.int64()),
            }
        )


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, times: np.ndarray | None = None) -> np.ndarray:
    """Weights (constant first) by Newton's method; the ridge keeps them finite where classes separate.
    A row counts as ``times`` rows, or once."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    times = np.ones(len(x)) if times is None else times
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (times * (y - p)) - ridge * w
        curve = (x * (times * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    spark = docs.sparkSession
    rows = saved(learning_rows(docs, labels, max_rows), "learning_rows")
    counts = "part string, toxic bigint, ordinary bigint"

    def summed(df: DataFrame) -> DataFrame:
        return df.groupBy("part").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))

    words = summed(rows.filter("fold <> 1").select("text", "toxic").mapInArrow(class_words, counts))
    grams = summed(words.mapInArrow(word_grams, counts)).toArrow()  # bounded by max_rows
    fitted = model(
        dict(zip(grams["part"].to_pylist(), zip(grams["toxic"].to_pylist(), grams["ordinary"].to_pylist())))
    )
    shipped = spark.sparkContext.broadcast(fitted)

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = figures_of(shipped.value)
        for batch in batches:
            found = [of(t or "") for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([a for a, _ in found], pa.float64()),
                    pa.array([b for _, b in found], pa.float64()),
                ],
                names=["key", "mean", "most"],
            )

    schema = "key bigint, mean double, most double"
    # Rows of a class all weigh the same here, so that the class is all the key that they need.
    held_back = rows.filter("fold = 1").select(F.col("toxic").cast("bigint").alias("key"), "text")
    seen = held_back.mapInArrow(figures, schema).toArrow()  # at most 2 * max_rows rows
    weight_of = {r["toxic"]: r["weight"] for r in rows.filter("fold = 1").groupBy("toxic").agg(F.first("weight").alias("weight")).collect()}
    x = np.column_stack([seen["mean"].to_numpy(), seen["most"].to_numpy()])
    y = seen["key"].to_numpy().astype(float)
    if 0 < y.sum() < len(y):
        times = np.array([weight_of[k] for k in seen["key"].to_pylist()])
        constant, mean, most = (float(v) for v in logistic(x, y, times=times))
        score = 1 / (1 + F.exp(-(constant + mean * F.col("mean") + most * F.col("most"))))
    else:
        share = rows.agg(F.sum(F.col("toxic") * F.col("weight")) / F.sum("weight")).first()[0]
        score = F.lit(float(share or 0.0))
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("key"), F.col("text").cast("string").alias("text"))
    return keyed.mapInArrow(figures, schema).select(
        F.col("key").alias("doc_id"),
        F.coalesce(remainder(F.col("key"), 5) == 0, F.lit(False)).alias("held_out"),
        score.alias("score"),
        F.when(score >= 0.5, 1).otherwise(0).alias("predicted"),
    )
