"""Order MinHash fingerprints, whose likeness follows the edit distance of texts.

A text's k-mers are its stretches of three words, each with the number of its earlier occurrences,
so that they are all different. A fingerprint has 128 tuples. Each tuple takes the two k-mers that
come first in an order of its own, puts them in the order of the text, and hashes them to 16 bits:
two texts share it if both chosen k-mers are common to them *and* stand in the same order. The
likeness of two fingerprints is the share of equal tuples.

All orders come from one hash per k-mer: hashes lie on a ring, tuple i starts at the i-th of 128
equally distant points and takes the next ones from there on (one-permutation hashing; where no
hash is up to the next point, that is the next ones beyond). So a text's k-mers are sorted once,
and not looked at 128 times. Hashes have 40 bits; two k-mers of a text with equal ones count as equal.

Only DataFrame expressions, without a shuffle: everything is inside the row. Repetitions are
numbered by stretches of equal hashes in the sorted list, as are the points that a hash serves,
so that the work is in proportion to the words but for two sorts.

Defined results: null, empty and blank texts have no k-mer; all their tuples are 0. Fewer than three
words are one k-mer; a single k-mer is a tuple by itself. Equal texts have equal fingerprints. The
order of words beyond the 2^24-th is that of their hashes. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import AT, FILE, cut_array, cuts_before, identified, let, partitions_of, words_of

WORDS, TUPLE, TUPLES = 3, 2, 128
PLACE_BITS = 24
PLACES = (1 << PLACE_BITS) - 1
HASHES = (1 << (64 - PLACE_BITS)) - 1
SAMPLES_PER_SLICE = 16
MOST_SLICES = 1 << 16


def big(number: int) -> Column:
    return F.lit(number).cast("bigint")


def upto(n: Column) -> Column:
    """0, 1 ... n - 1 for n > 0."""
    return F.sequence(F.lit(0), n - 1)


def begins(values: Column, mark) -> Column:
    """Where in an array that is not empty stretches of equal ``mark`` begin."""
    return F.filter(
        upto(F.size(values)), lambda i: (i == 0) | (mark(F.get(values, i)) != mark(F.get(values, i - 1)))
    )


def placed(x: Column, place: Column) -> Column:
    """A hash's upper 40 bits beside a place."""
    return x.bitwiseAND(big(~PLACES)).bitwiseOR(F.least(place.cast("bigint"), big(PLACES)))


def hash_of(entry: Column) -> Column:
    return F.shiftrightunsigned(entry, PLACE_BITS)


def entries(words: Column) -> Column:
    """The k-mers of a text as (hash, place) in one number each, sorted; words that are there."""

    def kmers(h: Column) -> Column:
        longer = F.transform(
            upto(F.size(h) - WORDS + 1),
            lambda i: placed(F.xxhash64(*[F.get(h, i + j) for j in range(WORDS)]), i),
        )
        return F.when(F.size(h) < WORDS, F.array(placed(F.xxhash64(h), F.lit(0)))).otherwise(longer)

    def numbered(e: Column) -> Column:
        """Later occurrences get hashes of their own."""

        def again(starts: Column) -> Column:
            def stretch(first: Column, j: Column) -> Column:
                end = F.coalesce(F.get(starts, j + 1), F.size(e))
                return F.transform(
                    F.sequence(first, end - 1),
                    lambda i: F.when(i == first, F.get(e, i)).otherwise(
                        placed(F.xxhash64(hash_of(F.get(e, i)), i - first), F.get(e, i).bitwiseAND(big(PLACES)))
                    ),
                )

            parts = F.sort_array(F.flatten(F.transform(starts, stretch)))
            return F.when(F.size(starts) == F.size(e), e).otherwise(parts)

        return let(begins(e, hash_of), again)

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return let(F.sort_array(let(hashed, kmers)), numbered)


def signature(text: Column) -> Column:
    """The fingerprint of a text as an array of 128 numbers of 16 bits."""
    bits = TUPLES.bit_length() - 1

    def point(entry: Column) -> Column:
        """The part of the ring, 0 to 127 in the order of the sorted entries, that an entry is in."""
        return (F.shiftright(entry, 64 - bits) + TUPLES // 2).cast("int")

    def tuple_at(e: Column, first: Column) -> Column:
        def turned(x: Column) -> Column:
            return F.call_function("shiftleft", x.bitwiseAND(big(PLACES)), F.lit(64 - PLACE_BITS)).bitwiseOR(hash_of(x))

        chosen = F.transform(
            upto(F.least(F.lit(TUPLE), F.size(e))),
            lambda j: turned(F.get(e, F.pmod(first + j, F.size(e)))),
        )
        in_order = F.transform(F.sort_array(chosen), lambda x: x.bitwiseAND(big(HASHES)))
        return F.xxhash64(in_order).bitwiseAND(big(0xFFFF)).cast("int")

    def tuples(e: Column) -> Column:
        def served(firsts: Column) -> Column:
            """Each first entry of a part serves the points from behind the one before up to its part's."""
            last = point(F.get(e, F.size(e) - 1))
            own = F.transform(
                firsts,
                lambda first, j: F.array_repeat(
                    tuple_at(e, first),
                    point(F.get(e, first)) - F.when(j == 0, -1).otherwise(point(F.get(e, F.get(firsts, j - 1)))),
                ),
            )
            # Beyond the last part the ring goes on with the first entry.
            return F.concat(F.flatten(own), F.array_repeat(tuple_at(e, F.lit(0)), TUPLES - 1 - last))

        return let(begins(e, point), served)

    def of_words(words: Column) -> Column:
        none = F.array_repeat(F.lit(0), TUPLES)
        return F.when(F.size(words) == 0, none).otherwise(let(entries(words), tuples))

    return let(words_of(text), of_words)


def fingerprint(signature: Column) -> Column:
    """Four hex digits a tuple."""
    return F.array_join(F.transform(signature, lambda x: F.lower(F.lpad(F.hex(x), 4, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of equal tuples of two signatures, 0 to 1."""
    same = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda equal: equal)
    return F.size(same) / F.lit(float(TUPLES))


def fingerprints(docs: DataFrame, column: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn(column, fingerprint(signature(text)))


def with_next(rows: DataFrame, order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """Rows of ``identified`` as slices in ``order``, each also with the first row of the next slice.

    ``slice``, ``halo`` (true for that extra row) and ``columns`` of the rows. The first row of all
    follows the last slice. So every row that is no halo finds its next one in its own slice, over
    (slice) in the order of (halo, place). Slices begin at rows: a sample of some 16 rows
    a slice, picked by hash, and the very first. The text goes through one shuffle.
    """
    spark = rows.sparkSession
    slices = min(MOST_SLICES, 4 * partitions_of(spark))
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)], F.col(AT).alias("at"), F.col(FILE).alias("file"))
    keys = rows.select(key.alias("place"))
    n, first = keys.agg(F.count("*"), F.min("place")).first()
    if not n:
        return rows.select(*columns, key.alias("place"), F.lit(0).alias("slice"), F.lit(False).alias("halo"))
    every = max(1, n // (SAMPLES_PER_SLICE * slices))
    sample = keys.filter(F.pmod(F.xxhash64("place"), F.lit(every)) == 0).collect()
    cuts = sorted({tuple(first), *sorted(tuple(r["place"]) for r in sample)[::SAMPLES_PER_SLICE]})
    array = cut_array(cuts, keys.schema["place"].dataType)
    number = cuts_before(F.col("place"), array) - 1
    sliced = rows.select(*columns, key.alias("place")).withColumn("_own", number)
    own = F.struct(F.col("_own").alias("slice"), F.lit(False).alias("halo"))
    extra = F.struct(F.pmod(F.col("_own") - 1, F.lit(len(cuts))).alias("slice"), F.lit(True).alias("halo"))
    begins_slice = F.get(array, F.col("_own")) == F.col("place")
    both = F.explode(F.when(begins_slice, F.array(own, extra)).otherwise(F.array(own)))
    return sliced.withColumn("_at", both).select(*columns, "place", "_at.slice", "_at.halo")


def edited_by_next(text: Column, following: Column) -> Column:
    """The text with its second half replaced by as much of the beginning of the next one."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.left(text, F.char_length(text) - half), F.left(following, half))


def edit_likeness(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its text edited by the next document (in
    descending order of doc_id, then position and file; null last; the first follows the last), and the likeness of
    its own to both."""
    rows = identified(docs).select(
        FILE,
        AT,
        F.col("doc.doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc.text").cast("string"), F.lit("")).alias("text"),
    )
    order = [F.col("doc_id").isNull(), F.bitwise_not(F.coalesce("doc_id", big(0)))]
    slices = with_next(rows, order, ["doc_id", "text"])
    following = Window.partitionBy("slice").orderBy("halo", "place")
    edited = slices.withColumn("next_text", F.coalesce(F.lead("text").over(following), F.lit(""))).select(
        "slice",
        "halo",
        "place",
        "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        "text",
        edited_by_next(F.col("text"), F.col("next_text")).alias("edited"),
    )
    signed = edited.select(
        "slice",
        "halo",
        "place",
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        signature(F.col("text")).alias("own"),
        signature(F.col("edited")).alias("after"),
    )
    return (
        signed.withColumn("next", F.lead("own").over(following))
        .filter(~F.col("halo"))
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            fingerprint(F.col("own")).alias("fingerprint"),
            fingerprint(F.col("after")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("after")).alias("near_edited"),
            likeness(F.col("own"), F.col("next")).alias("near_next"),
        )
    )
