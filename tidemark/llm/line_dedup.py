"""Removal of lines that are similar to an earlier line, by an exact set-similarity join.

A line is the set of its words; a line goes if the Jaccard similarity to any earlier line is 0.8
or more. Earlier is by doc_id, file position and line number. Only DataFrame expressions.

1. *Rarity.* All words of all lines are counted in 65,536 classes of their hashes: a table of
   fixed size that gives every word the same place in every line, rare ones first. Any other order gives the same result.
2. *Words* of every line are then cut, hashed and put in order in one pass; of each line a hash of the whole set, its rarest
   words as 31-bit tokens and its parities are kept in a scratch table.
3. Lines with the same set are one row from here on, however many there are.
4. *Prefix, length, position.* The first word that two similar sets share, rare ones first, has at least
   as many words from it to the end in both as they must share at all, 4/9 of their sizes together. So
   it is among a set's n - ceil(0.8 n) + 1 rarest, and among the n - ceil(8/9 n) + 1 rarest of the
   smaller one. A parity signature (the number of its differing bits is at most that of differing
   words) rules out nearly all other pairs.
5. *Earliest set first.* Under three tokens of its prefix, the least, a set is compared with the earliest one only:
   linear, and enough for nearly all members of a large group.
6. *All others*, by token and size class, one half of the tokens after the other: pairs whose later set goes already are left out, as another reason
   changes nothing. Sets that went still count as earlier ones.
7. What is left of 5 and of 6 is verified on the whole sets, read again. Only those lines are shuffled.

Set sizes, positions and the similarity are compared in whole numbers. Words are compared by
64-bit hash. Different words with the same token only make more candidates: tokens of a set are not made
distinct, so that sizes and places stay those of words.

Defined results: null texts have one line without a word; lines without a word stay and are not
counted. Null doc_ids come last. Rows that repeat are documents of their own, so that all lines
of the later one go. Texts and lines may have any length; a line is one row. An empty table gives an
empty result. Other columns are never read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import AT, FILE, at_places, discard, identified, saved

CLASSES = 1 << 16
# Tokens of a set under which it meets the earliest one first. Their number does not change the result.
HUBS = 3
# The lists of all tokens are joined in so many rounds (a power of two), one after the other, as they need the most room.
ROUNDS = 2
# Sets of up to so many words have 64 parities.
FEW_WORDS = 64
# Size classes go up by this, at least 1.25: a set's similar ones are in its class and the ones beside it.
STEP = 1.5
# Tables of hashes, which do not repeat or shrink, are written as they are.
PLAIN = {"codec": "lz4_raw", "parquet.enable.dictionary": "false"}


def lines_of(rows: DataFrame) -> DataFrame:
    """row_file, row_at, doc_id, line_no, line: lines with a word, all blanks in them as spaces."""
    text = F.coalesce(F.col("doc.text").cast("string"), F.lit(""))
    others = [F.contains(text, F.lit(c)) for c in "\t\x0b\x0c\r"]
    plain = F.when(others[0] | others[1] | others[2] | others[3], F.translate(text, "\t\x0b\x0c\r", "    ")).otherwise(text)
    lines = rows.select(
        FILE, AT, F.col("doc.doc_id").cast("bigint").alias("doc_id"), F.posexplode(F.split(plain, "\n")).alias("line_no", "line")
    )
    return lines.filter(F.trim("line") != "")


def hashes(line: Column) -> Column:
    """Each word's hash once, without that of the nothing between successive spaces."""
    every = F.transform(F.split(line, " "), lambda w: F.xxhash64(w))
    return F.array_except(every, F.array(F.xxhash64(F.lit(""))))


def by_rarity(rows: DataFrame):
    """A function of a word's hash, another number for every hash, smaller the rarer its class is; and a number that parts the words in halves.

    Classes are a hash's first 16 bits, put in the order of their counts over all lines of ``rows``: every word, as often
    as it occurs. Any order gives the same result; this one makes the lists of the join short.
    """
    words = lines_of(rows).select(F.explode(F.split("line", " ")).alias("word")).filter("word <> ''")
    classes = F.shiftrightunsigned(F.xxhash64("word"), 48).cast("int").alias("class")
    counts = dict(words.groupBy(classes).count().collect())  # at most CLASSES rows
    change, half, seen, sum_of_counts = ["0"] * CLASSES, 0, 0, sum(counts.values())
    for rank, at in enumerate(sorted(range(CLASSES), key=lambda c: (counts.get(c, 0), c))):
        bits = (rank ^ at ^ (CLASSES // 2)) << 48  # numbers are signed: half of the places are below 0
        change[at] = str(bits - (1 << 64) if bits >> 63 else bits)
        seen += counts.get(at, 0)
        if 2 * seen <= sum_of_counts:
            half = (rank + 1 - CLASSES // 2) << 48
    table = F.split(F.lit(",".join(change)), ",").cast("array<bigint>")
    # Never null, which lets arrays of it be sorted as plain numbers.
    return lambda h: F.coalesce(h.bitwiseXOR(table[F.shiftrightunsigned(h, 48)]), h), min(half, (1 << 63) - 1)


def described(rows: DataFrame) -> DataFrame:
    """A row per line with a word: place, sid, n (different words), prefix (tokens, rare ones first), its least tokens, and parities.

    ``parity`` has 64; of sets over ``FEW_WORDS`` words it has those of the rarer half of all words, and ``odd`` of the others.
    """

    bits = F.split(F.lit(",".join(str(1 << i) for i in range(63)) + f",{-1 << 63}"), ",").cast("array<bigint>")

    def flipped(words: Column) -> Column:
        return F.aggregate(words, F.lit(0).cast("bigint"), lambda total, x: total.bitwiseXOR(bits[x.bitwiseAND(63)]))

    place, half = by_rarity(rows)
    words, n = F.col("words"), F.size("words")
    cut = lines_of(rows).select(FILE, AT, "doc_id", "line_no", F.sort_array(F.transform(hashes(F.col("line")), place)).alias("words"))
    middle = F.lit(half).cast("bigint")
    rarer = F.array_position(F.sort_array(F.concat(words, F.array(middle))), middle).cast("int") - 1
    prefix = F.slice(words, 1, F.expr("size(words) - (4 * size(words) + 4) div 5 + 1").cast("int"))
    # Other bits than those of the parities.
    tokens = F.transform(prefix, lambda x: F.shiftright(x, 16).bitwiseAND(0x7FFFFFFF).cast("int"))
    cut = cut.select("*", F.when(n > FEW_WORDS, rarer).otherwise(n).alias("rarer"), tokens.alias("prefix"))
    return cut.select(
        FILE,
        AT,
        "doc_id",
        "line_no",
        F.xxhash64("words").alias("sid"),
        n.alias("n"),
        "prefix",
        F.slice(F.sort_array("prefix"), 1, HUBS).alias("least"),
        flipped(F.when(n > FEW_WORDS, F.slice(words, F.lit(1), F.col("rarer"))).otherwise(words)).alias("parity"),
        F.when(n > FEW_WORDS, flipped(F.slice(words, F.col("rarer") + 1, n))).otherwise(F.lit(0).cast("bigint")).alias("odd"),
    )


# What a row of a list is: one of the smaller set (SMALLER), of the larger (LARGER), of a set that goes already (GOES).
SMALLER, LARGER, GOES = 1, 2, 4


def figures(n: Column, pos: Column, kind: Column) -> Column:
    """A set's size, a token's place in it (under a fifth of that) and what the row is, in one number: lists are what is shuffled most."""
    return F.shiftleft(n.cast("bigint"), 32) + F.shiftleft(pos.cast("bigint"), 3) + kind


def unpacked(condition: str) -> str:
    """``condition`` on a.n, a.pos, a.is and those of b, in terms of their ``figures``."""
    for side in "ab":
        for name, value in (("n", "shiftright({}.figures, 32)"), ("pos", "(shiftright({}.figures, 3) & 536870911)"), ("is", "({}.figures & 7)")):
            condition = condition.replace(f"{side}.{name}", value.format(side))
    return condition


# Where sets of a and b that are similar may first share a word, by parity, place and length. They share 4/9 of their
# sizes together at least and differ in 1/9 at most.
POSSIBLE = unpacked(
    f"9 * CASE WHEN least(a.n, b.n) > {FEW_WORDS} "
    "THEN bit_count(a.parity ^ b.parity) + bit_count(a.odd ^ b.odd) ELSE bit_count(a.parity ^ a.odd ^ b.parity ^ b.odd) END <= a.n + b.n "
    "AND 9 * least(a.n - a.pos, b.n - b.pos) >= 4 * (a.n + b.n) AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)"
)
# Whether a is the smaller one, ties by number. Both sides in one condition: the lists are shuffled once for both.
ORDERED = unpacked(f"(a.is & {SMALLER}) + (b.is & {LARGER}) = {SMALLER + LARGER} AND (a.n < b.n OR a.n = b.n AND a.gid < b.gid)")
# Whether the later one of a and b does not go already, where the doc_ids tell which that is.
OPEN = unpacked(
    f"CASE WHEN a.doc_id < b.doc_id THEN b.is & {GOES} = 0 WHEN a.doc_id > b.doc_id THEN a.is & {GOES} = 0 "
    f"ELSE a.is & b.is & {GOES} = 0 END"
)


def size_class(n: Column) -> Column:
    return F.floor(F.log(STEP, n)).cast("int")


def by_size(sets: DataFrame, turn: int) -> DataFrame:
    """The lists of ``sets`` (gid, doc_id, n, goes, tokens and more) in a round: a row each, under ``key``, the token and the size class of the larger set.

    Sets that others in the next class may be similar to are there as well, but only as the smaller ones, and with
    fewer tokens: those among which they share a word with the smallest of that class.
    """
    n, own, tokens = F.col("n"), size_class(F.col("n")), F.size("prefix")
    next_ = F.ceil(F.pow(F.lit(STEP), F.col("own") + 1) * (1 - 1e-9))
    above = F.when(next_ <= n * 5 / 4, n - F.floor((4 * (n + next_) + 8) / 9) + 1).otherwise(0).cast("int")
    early = F.expr("n - (8 * n + 8) div 9").alias("early")
    both = F.concat("prefix", F.slice("prefix", F.lit(1), above))
    listed = sets.withColumn("own", own).select("*", early, tokens.alias("tokens"), F.posexplode(both).alias("at", "token"))
    postings = (
        listed.filter(F.col("token").bitwiseAND(ROUNDS - 1) == turn)
        .withColumn("above", F.when(F.col("at") >= F.col("tokens"), 1).otherwise(0))
        .withColumn("pos", F.col("at") - F.col("above") * F.col("tokens"))
    )
    kind = F.when(F.col("pos") <= F.col("early"), SMALLER).otherwise(0) + F.when(F.col("above") == 0, LARGER).otherwise(0) + F.when(F.col("goes"), GOES).otherwise(0)
    key = F.shiftleft(F.col("token").cast("bigint"), 7) + F.col("own") + F.col("above")
    return postings.select(key.alias("key"), "gid", "doc_id", "parity", "odd", figures(n, F.col("pos"), kind).alias("figures"))


def verified(pairs: DataFrame, sets: DataFrame, rows: DataFrame) -> DataFrame:
    """``pairs`` (a, b) that are similar: the later ones, as ``gid``."""
    pairs = saved(pairs.distinct(), "line_pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("gid")).distinct()
    needed = saved(
        sets.join(ids, "gid").select("gid", F.struct("first.unnamed", "first.doc_id", "first.at", "first.file", "first.line_no").alias("place")),
        "line_places",
    )
    docs = needed.select(F.col("place.file").alias(FILE), F.col("place.at").alias(AT)).distinct()
    lines = lines_of(at_places(rows, docs, True)).alias("l")
    on = F.expr(f"l.{FILE} = place.file AND l.{AT} = place.at AND l.line_no = place.line_no")
    content = saved(
        lines.join(needed, on).select("gid", "place", hashes(F.col("line")).alias("words")),
        "line_words",
        **PLAIN,
    )
    a, b = (content.select(F.col("gid").alias(side), F.col("place").alias(f"{side}_place"), F.col("words").alias(f"{side}_words")) for side in "ab")
    both = pairs.join(a, "a").join(b, "b")
    shared = F.size(F.array_intersect("a_words", "b_words"))
    later = F.when(F.col("a_place") < F.col("b_place"), F.col("b")).otherwise(F.col("a"))
    return both.filter(9 * shared >= 4 * (F.size("a_words") + F.size("b_words"))).select(later.alias("gid")).distinct()


def numbered(lines: DataFrame, name: str) -> DataFrame:
    """row_file, row_at, piece and, as ``name``, the line numbers of ``lines`` in it: a bit each, 64 to a piece."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("line_no").bitwiseAND(63))
    return lines.groupBy(FILE, AT, F.shiftright("line_no", 6).alias("piece")).agg(F.bit_or(bit).alias(name))


def by_document(rows: DataFrame) -> DataFrame:
    """Rows of ``identified``: row_file, row_at, n_lines (with a word) and removed (line numbers from 0, ascending)."""
    lines = saved(described(rows), "lines", **PLAIN)
    numbers = saved(numbered(lines, "numbers"), "line_numbers")
    first = F.struct(
        F.col("doc_id").isNull().alias("unnamed"),
        F.col("doc_id").alias("doc_id"),
        F.col(AT).alias("at"),
        F.col(FILE).alias("file"),
        F.col("line_no").alias("line_no"),
        *["n", "parity", "odd", "least", "prefix"],
    )
    sets = lines.groupBy("sid").agg(F.min(first).alias("first"))
    sets = saved(sets.select("first", F.monotonically_increasing_id().alias("gid")), "line_sets", **PLAIN)
    discard(lines)
    # Read back, columns count as nullable; said not to be, they need no checks in the joins.
    gid, n, parity, odd = (F.coalesce(c, F.lit(0)).alias(c.rpartition(".")[2]) for c in ("gid", "first.n", "first.parity", "first.odd"))
    # Under the least tokens of each prefix, which similar sets mostly share, all with the earliest one: what
    # goes by that needs no further pair.
    whole = figures(n, F.lit(0), F.lit(0)).alias("figures")
    place = [f"first.{c}" for c in ("unnamed", "doc_id", "at", "line_no")]
    many = sets.select(*place, gid, whole, parity, odd, F.explode("first.least").alias("token"))
    earliest = F.min(F.struct("unnamed", "doc_id", "at", "line_no", "gid", "figures", "parity", "odd"))
    hubs = many.groupBy("token").agg(earliest.alias("h")).select("token", "h.*")
    near_first = many.alias("b").join(hubs.alias("a"), F.expr(f"a.token = b.token AND a.gid <> b.gid AND {POSSIBLE}"))
    easy = saved(verified(near_first.select(F.col("a.gid").alias("a"), F.col("b.gid").alias("b")), sets, rows), "easy")
    # All other pairs, each under the size of the larger one.
    known = sets.join(easy.withColumn("goes", F.lit(True)), "gid", "left").select(
        gid, "first.doc_id", n, parity, odd, F.coalesce("goes", F.lit(False)).alias("goes"), "first.prefix"
    )
    others = []
    for turn in range(ROUNDS):
        postings = by_size(known, turn)
        pairs = postings.alias("a").join(postings.alias("b"), F.expr(f"a.key = b.key AND {ORDERED} AND {POSSIBLE} AND {OPEN}"))
        others.append(saved(pairs.select(F.col("a.gid").alias("a"), F.col("b.gid").alias("b")).distinct(), "line_candidates"))
    hard = saved(verified(reduce(DataFrame.unionByName, others), sets, rows), "hard")
    similar = easy.unionByName(hard)
    # Of a set's lines the first stays, unless an earlier set is similar.
    stays = sets.join(similar, "gid", "left_anti").select(F.col("first.file").alias(FILE), F.col("first.at").alias(AT), "first.line_no")
    pieces = numbers.join(numbered(stays, "kept"), [FILE, AT, "piece"], "left")
    gone = F.col("numbers").bitwiseAND(F.bitwise_not(F.coalesce("kept", F.lit(0).cast("bigint"))))
    bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("getbit", gone, i) == 1)
    removed = F.when(gone != 0, F.transform(bits, lambda i: F.shiftleft("piece", 6) + i))
    return pieces.groupBy(FILE, AT).agg(
        F.sum(F.bit_count("numbers")).alias("n_lines"), F.sort_array(F.flatten(F.collect_list(removed))).alias("removed")
    )


def line_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, removed (line numbers, comma-separated)."""
    rows = identified(docs)
    ids = rows.select(FILE, AT, F.col("doc.doc_id").cast("bigint").alias("doc_id"))
    return ids.join(by_document(rows), [FILE, AT], "left").select(
        "doc_id",
        F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed"),
    )


def drop_similar_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with those lines left out of ``text``, all columns kept."""
    rows = identified(docs)
    gone = saved(by_document(rows).filter(F.size("removed") > 0).select(FILE, AT, "removed"), "gone")
    kept = F.array_join(
        F.filter(F.split("doc.text", "\n"), lambda line, i: F.coalesce(~F.array_contains("removed", i), F.lit(True))), "\n"
    )
    text = F.when(F.col("removed").isNull(), F.col("doc.text")).otherwise(kept)
    return rows.join(gone, [FILE, AT], "left").select(
        *[text.alias(c) if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns]
    )
