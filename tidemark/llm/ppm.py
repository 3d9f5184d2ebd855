"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts of up to ``ORDER`` bytes, counted over all learning texts.
A byte seen c of n times after a context has the share (2c - 1) / 2n there; what is left over is
the chance of an escape to the context one byte shorter, where bytes that the longer context
knows are excluded (their share is taken out and the rest scaled up). Shares and escapes of
every trie node are worked out once; a document's score is the sum of log10 shares.

Texts are modelled as their words (A to Z in lower case) with single spaces, from a mark at the
start to one at the end, so that the shares of all texts add up to one.

* Counts: tasks send each different gram of their part once; lower orders are sums over endings.
* The model is a table of all grams with their shares and escapes; nothing is pruned. Its most
  frequent rows (at most ``max_nodes``) go to every task as a trie. Grams that are not there are
  joined with the table, one row per document and gram; those that no learning text has look up
  all their shorter forms. ``max_nodes`` so changes no score.
* Base score: the frequent words' counts (``max_words``) go to every task; all rarer tokens are
  joined with the table of all counts, in which no key is hot any more. Both are exact.

Defined results: null and wordless texts are the end alone. Null doc_ids are learned from and
not held out. Rows that repeat count and are scored each. Without learning texts every byte has
the share 1/256 and no word is known. Other columns are never read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved

ORDER = 5
MARK = b"\n"
# Bytes of text that a task works on at once; a longer text is worked on by itself.
BUFFER = 1 << 19
COUNTED_GRAMS, COUNTED_WORDS = 1 << 20, 1 << 18
# Fixed value: an odd multiplier that spreads keys over a table (2^64 over the golden ratio).
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def modelled(text: str) -> bytes:
    # Bytes: lower() changes A to Z only, and split() cuts at space and tab to carriage return.
    return MARK + b" ".join(text.encode().lower().split()) + MARK


def grams(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of texts side by side: the position of every byte but the first of each text, and the
    byte with up to ORDER bytes before it as a number with a leading one."""
    place = np.arange(len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
    code = np.zeros(len(data), np.uint64)
    for back in range(ORDER, -1, -1):
        code <<= np.uint64(8)
        code[back:] |= data[: max(0, len(data) - back)]
    length = (np.minimum(place, ORDER) + 1).astype(np.uint64) * np.uint64(8)
    one = np.uint64(1) << length
    at = np.flatnonzero(place)
    return at, (code & (one - np.uint64(1)) | one)[at]


def buffered(texts: Iterator[str]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append(modelled(text))
        size += len(held[-1])
        if size >= BUFFER:
            yield held
            held, size = [], 0
    if held:
        yield held


def side_by_side(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])[:-1]


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"gram": pa.array(keys.view(np.int64)), "n": pa.array(counts, pa.int64())})

    texts = (t or "" for b in batches for t in b["text"].to_pylist())
    waiting: list[np.ndarray] = []
    for held in buffered(texts):
        waiting.append(grams(*side_by_side(held))[1])
        if len(waiting) < 8:
            continue
        keys, counts = merged(keys, counts, waiting)
        waiting = []
        if len(keys) > COUNTED_GRAMS:
            yield out()
            keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    keys, counts = merged(keys, counts, waiting)
    if len(keys):
        yield out()


def merged(keys: np.ndarray, counts: np.ndarray, more: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of grams with those of further occurrences."""
    if not more:
        return keys, counts
    new, n = np.unique(np.concatenate(more), return_counts=True)
    keys, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([counts, n]), len(keys)).astype(np.int64)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"word": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64())}
        )

    for batch in batches:
        for text in batch["text"].to_pylist():
            counts.update((text or "").encode().lower().split())
            if len(counts) > COUNTED_WORDS:
                yield out()
                counts.clear()
    if counts:
        yield out()


class Trie:
    """Nodes by gram in an open-addressed table: log10 share of the last byte, and log10 weight
    of an escape from the gram as a context."""

    def __init__(self, keys: np.ndarray, shares: np.ndarray, escapes: np.ndarray, unseen: float):
        self.unseen = unseen
        self.bits = max(4, int(2 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys = np.zeros(size, np.uint64)
        self.shares, self.escapes = np.zeros(size, np.float32), np.zeros(size, np.float32)
        left, slot = np.arange(len(keys)), self._slots(keys)
        while len(left):
            free = np.flatnonzero(self.keys[slot] == 0)
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]] = keys[left[won]]
            self.shares[slot[won]], self.escapes[slot[won]] = shares[left[won]], escapes[left[won]]
            again = np.ones(len(left), bool)
            again[won] = False
            left, slot = left[again], (slot[again] + 1) & (size - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * SPREAD >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots, or -1."""
        out = np.full(len(keys), -1)
        slot, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            there = self.keys[slot]
            hit = there == keys[left]
            out[left[hit]] = slot[hit]
            on = ~hit & (there != 0)
            left, slot = left[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out

    def log_shares(self, found: np.ndarray) -> np.ndarray:
        """For every gram, the log10 share of its last byte after the bytes before it."""
        total = np.zeros(len(found))
        left, gram = np.arange(len(found)), found
        while len(left):
            slot = self.find(gram)
            hit = slot >= 0
            total[left[hit]] += self.shares[slot[hit]]
            left, gram = left[~hit], gram[~hit]
            context = self.find(gram >> np.uint64(8))
            known = context >= 0
            total[left[known]] += self.escapes[context[known]]
            # One byte less of context: the leading one moves down over the oldest byte.
            bits = np.frexp(gram.astype(np.float64))[1] - 1
            last = bits <= 8
            total[left[last]] += self.unseen
            left, gram, bits = left[~last], gram[~last], bits[~last]
            one = np.uint64(1) << (bits - 8).astype(np.uint64)
            gram = gram & (one - np.uint64(1)) | one
        return total


def trie(keys: np.ndarray, counts: np.ndarray, contexts: np.ndarray, totals: np.ndarray) -> Trie:
    """Grams that are kept and their counts, and contexts with the number of bytes after them."""
    if not len(keys):
        return Trie(np.empty(0, np.uint64), np.empty(0), np.empty(0), -math.log10(256))
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    order = np.argsort(contexts)
    contexts, totals = contexts[order], totals[order]
    parent = np.searchsorted(contexts, keys >> np.uint64(8))
    share = (2 * counts - 1) / (2 * totals[parent])
    bits = (np.frexp(keys.astype(np.float64))[1] - 1).astype(np.uint64)
    longer = np.flatnonzero(bits > 8)
    one = np.uint64(1) << (bits[longer] - np.uint64(8))
    shorter = np.zeros(len(keys))
    shorter[longer] = share[np.searchsorted(keys, keys[longer] & (one - np.uint64(1)) | one)]
    escape = 1 - np.bincount(parent, share, len(contexts))
    left = 1 - np.bincount(parent, shorter, len(contexts))
    children = np.bincount(parent, minlength=len(contexts))
    weight = np.where(children > 0, np.log10(np.maximum(escape, 1e-12)) - np.log10(np.maximum(left, 1e-12)), 0)
    root = int(np.searchsorted(contexts, np.uint64(1)))
    unseen = math.log10(max(escape[root], 1e-12) / max(1, 256 - children[root]))
    weights = np.zeros(len(keys))
    at = np.searchsorted(keys, contexts)
    inside = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == contexts)
    weights[at[inside]] = weight[inside]
    return Trie(keys, np.log10(share), weights, unseen)


def threshold(table: DataFrame, most: int) -> int:
    """The smallest power of two such that at most ``most`` rows have that ``n`` or more."""
    sizes = table.groupBy(F.floor(F.log2("n")).cast("int").alias("p")).count().collect()  # at most 64 rows
    left, p = most, 64
    for row in sorted(sizes, reverse=True):
        left -= row["count"]
        if left < 0:
            break
        p = row["p"]
    return 1 if left >= 0 else 1 << p


def shorter(gram: Column, by: int = 1) -> Column:
    """A gram without its oldest bytes: the leading one moves down over them."""
    bits = F.length(F.bin(gram)) - 1 - 8 * by
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits)
    return gram.bitwiseAND(one - 1) + one


def fitted(learning: DataFrame) -> tuple[DataFrame, float]:
    """The model of ``text`` rows: a saved table of gram, n, share (log10 of the last byte's after
    the bytes before) and escape (log10 of the weight of an escape from the gram as a context), and
    the log10 share of a byte that no learning text has."""
    longest = learning.mapInArrow(count_grams, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    # Endings of each gram, itself included: all orders' counts.
    endings = F.filter(
        F.transform(
            F.sequence(F.lit(1), F.lit(ORDER + 1)),
            lambda k: F.when(
                F.expr("gram") >= F.call_function("shiftleft", F.lit(1).cast("bigint"), 8 * k),
                F.expr("gram").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), 8 * k) - 1)
                + F.call_function("shiftleft", F.lit(1).cast("bigint"), 8 * k),
            ),
        ),
        lambda g: g.isNotNull(),
    )
    counts = longest.select(F.explode(endings).alias("gram"), "n").groupBy("gram").agg(F.sum("n").alias("n"))
    context = F.shiftright("gram", 8)
    # At most 256 rows of a context.
    total = F.sum("n").over(Window.partitionBy("context"))
    table = saved(counts.withColumn("context", context).withColumn("total", total), "grams")
    # What a context leaves to the one a byte shorter, from whole numbers: of k bytes that follow
    # n times in all, (2c - 1) / 2n each leave k / 2n, and the same bytes' shares there are
    # taken out, which all have the total of the shorter context.
    less = table.select(F.col("gram").alias("less"), F.col("n").alias("less_n"), F.col("total").alias("less_total"))
    escapes = (
        table.filter("context > 1")
        .withColumn("less", shorter(F.col("gram")))
        .join(less, "less")
        .groupBy("context")
        .agg(
            F.count("*").alias("k"),
            F.max("total").alias("all"),
            F.sum("less_n").alias("less_n"),
            F.max("less_total").alias("less_all"),
        )
        .select(
            F.col("context").alias("gram"),
            (
                F.log10(F.col("k") / (2 * F.col("all")))
                - F.log10((2 * F.col("less_all") - 2 * F.col("less_n") + F.col("k")) / (2 * F.col("less_all")))
            ).cast("float").alias("escape"),
        )
    )
    # Single precision, as in the trie: where a gram is looked up does not change its score.
    model = saved(
        table.join(escapes, "gram", "left").select(
            "gram",
            "n",
            F.log10((2 * F.col("n") - 1) / (2 * F.col("total"))).cast("float").alias("share"),
            F.coalesce("escape", F.lit(0.0).cast("float")).alias("escape"),
        ),
        "model",
    )
    kinds, size = table.filter("context = 1").agg(F.count("*"), F.max("total")).first()
    unseen = math.log10(kinds / (2 * size) / max(1, 256 - kinds)) if kinds else -math.log10(256)
    return model, unseen


def unknown_scores(lost: DataFrame, model: DataFrame, unseen: float) -> DataFrame:
    """Grams that the model does not have (``gram``, distinct) with their log10 ``score``: escapes
    from one context to the next shorter one, up to the longest ending that the model has."""
    forms = []
    for k in range(ORDER + 1):
        # Null where no byte would be left.
        here = F.when(F.col("gram") >= F.lit(1 << 8 * (k + 1)), shorter(F.col("gram"), k) if k else F.col("gram"))
        forms += [
            F.struct(F.lit(k).alias("k"), F.lit(False).alias("as_context"), here.alias("form")),
            F.struct(F.lit(k).alias("k"), F.lit(True).alias("as_context"), F.shiftright(here, 8).alias("form")),
        ]
    asked = lost.select("gram", F.explode(F.array(*forms)).alias("f")).select("gram", "f.*").filter("form > 1")
    rows = model.select(F.col("gram").alias("form"), "share", "escape")
    each = (
        asked.join(rows, "form")
        .groupBy("gram")
        .agg(
            F.min(F.when(~F.col("as_context"), F.struct("k", "share"))).alias("found"),
            F.sort_array(F.collect_list(F.when(F.col("as_context"), F.struct("k", "escape")))).alias("escapes"),
        )
    )
    return lost.join(each, "gram", "left").select(
        "gram",
        (
            F.coalesce(F.col("found.share").cast("double"), F.lit(unseen))
            + F.expr(
                "coalesce(aggregate(filter(escapes, e -> found IS NULL OR e.k < found.k), 0D, (x, e) -> x + e.escape), 0D)"
            )
        ).alias("score"),
    )


def lm_scores(docs: DataFrame, max_nodes: int = 1 << 20, max_words: int = 1 << 18) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learning = texts.filter(~held_out(F.col("doc_id"))).select("text")
    words = saved(
        learning.mapInArrow(count_words, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "words"
    )
    n_texts = learning.count()
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # The end is a token of every text.
    total, distinct = total + n_texts, distinct + (n_texts > 0)
    room = math.log10(total + distinct + 1)
    common = words.filter(F.col("n") >= threshold(words, max_words)).toArrow()  # at most max_words rows
    frequent = dict(zip(common["word"].to_pylist(), np.log10(common["n"].to_numpy() + 1.0).tolist()))
    model, unseen = fitted(learning)
    least = threshold(model, max_nodes)
    head = model.filter(F.col("n") >= least).toArrow()  # at most max_nodes rows
    nodes = [head[c].to_numpy() for c in ("gram", "share", "escape")]
    shipped = spark.sparkContext.broadcast(Trie(nodes[0].astype(np.int64).view(np.uint64), *nodes[1:], unseen))
    del head, nodes
    known = spark.sparkContext.broadcast(frequent)
    of_end = math.log10(n_texts + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        of_word, nodes = known.value.get, shipped.value
        for batch in batches:
            every, at_text = [t or "" for t in batch["text"].to_pylist()], 0
            for held in buffered(iter(every)):
                data, starts = side_by_side(held)
                at, found = grams(data, starts)
                text_of = np.searchsorted(starts, at, "right") - 1
                slot = nodes.find(found)
                hit = slot >= 0
                scores = np.bincount(text_of[hit], nodes.shares[slot[hit]].astype(np.float64), len(held))
                far_text, far = text_of[~hit], found[~hit]
                order = np.lexsort((far, far_text))
                far_text, far = far_text[order], far[order]
                new = np.flatnonzero(np.diff(far, prepend=0).astype(bool) | np.diff(far_text, prepend=-1).astype(bool))
                offsets = np.searchsorted(far_text[new], np.arange(len(held) + 1))
                n_tokens, n_known, sums, rare = [], [], [], []
                for text in every[at_text : at_text + len(held)]:
                    tokens = text.encode().lower().split()
                    logs = list(map(of_word, tokens))
                    missing = [w for w, x in zip(tokens, logs) if x is None]
                    n_tokens.append(len(tokens) + 1)
                    n_known.append(len(tokens) - len(missing) + (n_texts > 0))
                    sums.append(math.fsum(x for x in logs if x is not None) + of_end)
                    rare.append(missing)
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array(range(row, row + len(held)), pa.int64()),
                        "doc_id": batch["doc_id"].slice(at_text, len(held)),
                        "n_tokens": pa.array(n_tokens, pa.int64()),
                        "n_known": pa.array(n_known, pa.int64()),
                        "logs": pa.array(sums, pa.float64()),
                        "score": pa.array(scores, pa.float64()),
                        "rare": pa.array(rare, pa.list_(pa.binary())),
                        "far": pa.ListArray.from_arrays(
                            pa.array(offsets, pa.int32()), pa.array(far[new].view(np.int64), pa.int64())
                        ),
                        "far_n": pa.ListArray.from_arrays(
                            pa.array(offsets, pa.int32()),
                            pa.array(np.diff(new, append=len(far)), pa.int64()),
                        ),
                    }
                )
                row += len(held)
                at_text += len(held)

    scored = saved(
        texts.mapInArrow(
            run,
            "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, logs double, score double, "
            "rare array<binary>, far array<bigint>, far_n array<bigint>",
        ),
        "scored",
    )
    # Nothing that follows needs the trie.
    shipped.unpersist()
    known.unpersist()
    # Grams that are not in the trie: those of the table collapse to a row per document.
    tail = model.filter(F.col("n") < least).select("gram", "share")
    lost = F.when(F.col("share").isNull(), F.col("gram")).alias("lost")
    far = saved(
        scored.select("row", F.explode(F.arrays_zip("far", "far_n")).alias("f"))
        .select("row", F.col("f.far").alias("gram"), F.col("f.far_n").alias("times"))
        .join(tail, "gram", "left")
        .groupBy("row", lost)
        .agg(F.sum("times").alias("times"), F.sum(F.col("times") * F.col("share").cast("double")).alias("far_score")),
        "far",
    )
    unknown = unknown_scores(far.filter("lost IS NOT NULL").select(F.col("lost").alias("gram")).distinct(), model, unseen)
    # The sum that each document keeps of its known grams has no gram to join by.
    lost = far.filter("lost IS NOT NULL")
    looked_up = lost.join(unknown, lost["lost"] == unknown["gram"]).select(
        "row", (F.col("times") * unknown["score"]).alias("far_score")
    )
    far_scores = (
        far.filter("lost IS NULL").select("row", "far_score").unionByName(looked_up)
        .groupBy("row")
        .agg(F.sum("far_score").alias("far_score"))
    )
    rest = (
        scored.select("row", F.explode("rare").alias("word"))
        .join(words, "word")
        .groupBy("row")
        .agg(F.count("*").alias("rare_known"), F.sum(F.log10(F.col("n") + 1)).alias("rare_logs"))
    )
    return scored.drop("rare", "far", "far_n").join(rest, "row", "left").join(far_scores, "row", "left").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) - F.col("n_tokens") * room).alias("base_score"),
        (F.col("score") + F.coalesce("far_score", F.lit(0.0))).alias("score"),
    )
