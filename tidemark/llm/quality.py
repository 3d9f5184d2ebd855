"""Quality by weak supervision: rules vote or abstain, and EM weighs them.

Every rule looks at one figure of a document and says good (1), bad (-1) or nothing (0). A
document's votes are one of 3^rules patterns, so the whole corpus is a small table of pattern
counts, however large it is; expectation maximisation over that table estimates, for each rule
and each class, how often it says what, and so how far to trust it. The posterior probability of
being good replaces a list of filters that must all pass.

Only DataFrame expressions: figures are computed inside the row, without a shuffle, and each EM
step is one aggregate over the pattern counts.

Defined results: null and blank texts have no words and fail the base rule. A figure whose
denominator is zero makes its rule abstain. Rows with the same doc_id are judged by themselves.
With no documents at all the result is empty. Window equality is that of 64-bit hashes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import AT, BLANK, FILE, at_places, identified, saved

WINDOW = 5
ROUNDS = 25
RULES = [
    "function_words", "symbols", "repetition", "variety", "capitals", "loudness", "lines", "word_length"
]

# The most frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "the of and to in a is that it for on was as with by at from are this be or an "
    "der die das und in den von zu mit sich des ist im dem nicht ein eine auf für als auch "
    "le la les de des du et en un une que est pour qui dans par sur au il pas "
    "el los las y del se por con no para una su al lo como"
).split()


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(hashes: Column) -> Column:
    """Words in windows that occur twice or more, given each window's hash in order."""

    def gaps(starts: Column) -> Column:
        steps = F.transform(
            starts, lambda x, i: F.least(F.coalesce(F.get(starts, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))
        )
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, x: total + x)

    def covered(pairs: Column) -> Column:
        again = F.filter(
            pairs,
            lambda e, i: ((i > 0) & (F.get(pairs, i - 1)["h"] == e["h"])) | (F.get(pairs, i + 1)["h"] == e["h"]),
        )
        return let(F.sort_array(F.transform(again, lambda e: e["i"])), gaps)

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(pairs, covered)).otherwise(0)


def signals(rows: DataFrame) -> DataFrame:
    """The figures of each row of ``identified``; one pass over the texts, no shuffle."""
    text = F.col("text")
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    blank = f"[{BLANK}]+"
    base = rows.select(
        FILE,
        AT,
        F.col("doc.doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc.text").cast("string"), F.lit("")).alias("text"),
    )
    split = base.select(
        FILE,
        AT,
        "doc_id",
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, blank)).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{BLANK}]")).alias("lines"),
        *[
            (F.octet_length(text) - F.octet_length(F.regexp_replace(text, pattern, ""))).cast("bigint").alias(name)
            for name, pattern in (("n_symbols", r"[#*$%&|<>]+"), ("n_capitals", "[A-Z]+"), ("n_loud", "[!?]+"))
        ],
    ).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))

    def window(i: Column) -> Column:
        return F.xxhash64(*[F.get("hashes", i + j) for j in range(WINDOW)])

    windows = F.when(
        F.size("hashes") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("hashes") - WINDOW), window)
    ).otherwise(F.array().cast("array<bigint>"))
    counted = split.select(
        FILE,
        AT,
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("lines").cast("bigint").alias("n_lines"),
        "n_capitals",
        "n_loud",
        F.size(F.array_distinct("hashes")).cast("bigint").alias("n_distinct_words"),
        F.size(F.filter("words", lambda w: w.isin(FUNCTION_WORDS))).cast("bigint").alias("n_function_words"),
        windows.alias("windows"),
    )
    return counted.withColumn("n_repeat_words", repeated_words(F.col("windows")).cast("bigint")).drop("windows")


def ratio(a: str, b: str, least: int = 1) -> Column:
    """Null below ``least``, so that the rule abstains."""
    return F.when(F.col(b) >= least, F.col(a) / F.col(b))


def votes() -> dict[str, Column]:
    """-1, 0 or 1 by rule. Bounds are parameters of the method, chosen once for prose of any language."""
    by_word = {c: ratio(c, "n_words") for c in ("word_chars", "n_symbols", "n_loud", "n_repeat_words")}
    function_words, distinct = ratio("n_function_words", "n_words", 20), ratio("n_distinct_words", "n_words", 20)
    capitals, lines = ratio("n_capitals", "word_chars"), ratio("n_dup_lines", "n_lines", 2)

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    return {
        "function_words": vote(function_words < 0.08, function_words > 0.14),
        "symbols": vote(by_word["n_symbols"] > 0.1, by_word["n_symbols"] < 0.01),
        "repetition": vote(by_word["n_repeat_words"] > 0.2, by_word["n_repeat_words"] < 0.03),
        "variety": vote(distinct < 0.3, distinct > 0.6),
        "capitals": vote(capitals > 0.3, capitals < 0.1),
        "loudness": vote(by_word["n_loud"] > 0.2, by_word["n_loud"] < 0.02),
        "lines": vote(lines > 0.3, lines == 0),
        "word_length": vote((by_word["word_chars"] < 2.5) | (by_word["word_chars"] > 12), by_word["word_chars"].between(3.5, 7)),
    }



def odds(prior: float, weights: list[tuple[float, float]], prefix: str = "") -> Column:
    """Log odds of being good. Looked up by vote, so that every round runs the same compiled code."""
    by_vote = F.lit([x for bad, good in weights for x in (bad, 0.0, good)] + [prior])
    votes = [F.get(by_vote, 3 * i + 1 + F.col(f"{prefix}{rule}")) for i, rule in enumerate(RULES)]
    return sum(votes, F.get(by_vote, 3 * len(RULES) + 0 * F.col(f"{prefix}{RULES[0]}")))


def fitted(patterns: DataFrame, rounds: int = ROUNDS) -> tuple[float, list[tuple[float, float]]]:
    """Log odds of being good before any vote, and by rule what a bad and a good vote add.

    ``patterns``: a row per pattern with a column per rule and ``n``; at most 3^rules rows. The
    first posterior is a plain count of votes in which a bad vote weighs as much as four good
    ones, as most rules look for one fault that few documents have; then each round estimates
    rates from posteriors and posteriors from rates. An abstention says nothing. Rates have one
    vote of each kind added.
    """
    prior, weights = 0.0, [(-4.0, 1.0)] * len(RULES)
    said = F.explode(F.array(*[F.struct(F.lit(i).alias("rule"), F.col(r).alias("vote")) for i, r in enumerate(RULES)]))
    for _ in range(rounds):
        good = 1 / (1 + F.exp(-odds(prior, weights)))
        counts = (
            patterns.withColumn("good", good)
            .select("n", "good", said.alias("said"))
            .groupBy("said.rule", "said.vote")
            .agg(F.sum(F.col("good") * F.col("n")), F.sum((1 - F.col("good")) * F.col("n")))
            .collect()  # three rows a rule
        )
        by_vote = {(rule, vote): (a, b) for rule, vote, a, b in counts}
        goods, bads = (sum(by_vote.get((0, v), (0, 0))[side] for v in (-1, 0, 1)) for side in (0, 1))

        def weight(rule: int, vote: int) -> float:
            """How much more often good documents get this vote than bad ones."""
            a, b = by_vote.get((rule, vote), (0, 0))
            return math.log((a + 1) / (goods + 3)) - math.log((b + 1) / (bads + 3))

        prior = math.log((goods + 1) / (bads + 1))
        weights = [(weight(i, -1), weight(i, 1)) for i in range(len(RULES))]
    return prior, weights


def judged(rows: DataFrame) -> DataFrame:
    """Rows of ``identified`` with figures, base_failed, good_odds and kept.

    Figures and votes are written once, as a table without texts, and read for the pattern
    counts and for the result.
    """
    figures = signals(rows).select("*", *[v.alias(f"vote_{k}") for k, v in votes().items()])
    table = saved(figures, "figures")
    patterns = saved(
        table.groupBy(*[F.col(f"vote_{k}").alias(k) for k in RULES]).agg(F.count("*").alias("n")), "patterns"
    )
    prior, weights = fitted(patterns)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return table.withColumn("base_failed", failed).withColumn("good_odds", odds(prior, weights, "vote_")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("good_odds") >= 0)
    )


def quality(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, the four figures, base_failed, kept."""
    return judged(identified(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def drop_low_quality(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that ``quality`` rejects, all columns kept."""
    rows = identified(docs)
    rejected = judged(rows).filter(~F.col("kept")).select(FILE, AT)
    return at_places(rows, saved(rejected, "rejected"), False).select("doc.*")
