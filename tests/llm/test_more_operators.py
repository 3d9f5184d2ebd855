"""Periodic runs, importance resampling and order MinHash against plain loops, on the table of hard cases."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import pytest
from test_operators import PROSE, ROWS, SCHEMA, bag, docs, none, path, words  # noqa: F401
from xxhash import xxh64_intdigest

from tidemark.llm import mixing, order_minhash, periodic, resampling, tokens, toxicity
from tidemark.llm.common import at_places, cut_array, cuts_before, identified, saved


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Runs


def plain_runs(words):
    """All runs, by comparing at every distance."""
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                stretch = words[i : i + length]
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, words):
    if doc_id is None:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 or not words:
        return words
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def some_text(rng):
    letters = rng.choice([1, 2, 3, 40])
    words = [str(rng.randrange(letters)) for _ in range(rng.choice([0, 1, 6, 30, 120]))]
    for _ in range(rng.randrange(4)):
        base = [str(rng.randrange(letters)) for _ in range(rng.randint(1, 45))]
        at = rng.randint(0, len(words))
        words[at:at] = (base * 6)[: rng.randint(1, 6 * len(base))]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_texts_side_by_side(seed):
    rng = random.Random(seed)
    for _ in range(60):
        texts = [some_text(rng) for _ in range(rng.randint(0, 9))]
        got = list(periodic.text_runs([" ".join(t).encode() for t in texts]))
        assert len(got) == len(texts)
        for (_, runs), text in zip(got, texts):
            assert runs == plain_runs(text)


def test_runs_of_the_largest_scales():
    rng = random.Random(7)
    base = [f"w{rng.randrange(10**6)}" for _ in range(5_000)]
    text = [*base[:777], *base, *base, *base, *base, *base[:1234], "end"]
    ((_, runs),) = periodic.text_runs([" ".join(text).encode()])
    # The text begins with words that the period does not end with, so that the run begins behind them.
    assert runs == [(777, 4 * 5_000 + 1_234, 5_000)]


HARD = [
    (20, "a b " * 400 + "c", "x"),
    (21, "one two three\n" * 5 + "one two other", "x"),
    (22, "x x x x x x y y y y y", "x"),
    (None, "z " * 6, None),
]


@pytest.fixture(scope="module")
def more(spark):
    rows = ROWS + [(d, t, "en", s, len(t), "x", 7, 7, "fp", 7, 7) for d, t, s in HARD]
    for doc_id in range(100, 160):
        text = " ".join(some_text(random.Random(doc_id)))
        rows.append((doc_id, text, "en", "y", len(text), "x", 7, 7, "fp", 7, 7))
    return saved(spark.createDataFrame(rows, SCHEMA).repartition(3), "more")


def test_periodic_runs(more, none):
    table = [(r["doc_id"], r["text"]) for r in more.collect()]
    want = []
    for doc_id, text in table:
        w = planted(doc_id, words(text))
        runs = plain_runs(w) if len(w) < 5_000 else []
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        figures = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        want.append((doc_id, len(runs), *figures, sha(lines), sha(plain_collapsed(w, runs))))
    got = periodic.digests(periodic.periodic_runs(periodic.with_planted_runs(more)))
    assert bag(map(tuple, got.collect())) == bag(want)
    assert sum(r[1] for r in want) > 20
    assert periodic.digests(periodic.periodic_runs(periodic.with_planted_runs(none))).count() == 0


def test_drop_repetitions(more):
    got = periodic.drop_repetitions(more)
    assert got.columns == more.columns
    want = []
    for row in more.collect():
        runs = plain_runs(words(row["text"])) if len(row["text"] or "") < 10_000 else []
        text = plain_collapsed(words(row["text"]), runs) if runs else row["text"]
        want.append(tuple(text if c == "text" else row[c] for c in more.columns))
    assert bag(map(tuple, got.collect())) == bag(want)


# Resampling


def feature_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_resampling(rows, target, percent, least_words, longest, buckets, seed):
    def marks(text):
        w = feature_words(text)
        runs = [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
        return [zlib.crc32(r.encode()) % buckets for r in runs]

    ours, theirs = Counter(), Counter()
    for _, text in rows:
        ours.update(marks(text))
    for text in target:
        theirs.update(marks(text))
    s, t = sum(ours.values()), sum(theirs.values())

    def gain(b):
        return math.floor(1000 * math.log((theirs[b] + 1.0) * (s + buckets) / ((ours[b] + 1.0) * (t + buckets))))

    out = []
    for doc_id, text in rows:
        weight = sum(map(gain, marks(text)))
        h = int(sha(f"{seed}:{'' if doc_id is None else doc_id}")[:8], 16)
        out.append((doc_id, len(marks(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    order = sorted(
        (-score, doc_id is None, doc_id or 0) for (doc_id, _, _, score), (_, text) in zip(out, rows)
        if len(feature_words(text)) >= least_words
    )
    return out, order[: percent * len(order) // 100], len(order)


@pytest.mark.parametrize("percent,least_words,longest,buckets", [(10, 20, 1, 10_000), (50, 3, 2, 17), (100, 0, 3, 70_000)])
def test_importance_resampling(spark, more, percent, least_words, longest, buckets):
    target = ["old HOUSE by the river", None, "", "é two apple trees, apple-trees 42"]
    rows = [(r["doc_id"], r["text"]) for r in more.collect()]
    figures, drawn, _ = plain_resampling(rows, target, percent, least_words, longest, buckets, 2024)
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    options = dict(percent=percent, least_words=least_words, longest=longest, buckets=buckets)
    got = resampling.importance_resampling(more, frame, **options).collect()
    assert bag((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got) == bag(figures)
    ranks = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranks] == list(range(1, len(drawn) + 1))
    assert [(-r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in ranks] == drawn


def test_resampling_without_rows_or_target(spark, more, none):
    nothing = spark.createDataFrame([], "text string")
    assert resampling.importance_resampling(none, nothing).count() == 0
    rows = resampling.importance_resampling(more, nothing, percent=0).collect()
    assert len(rows) == more.count() and all(r["rank"] is None for r in rows)
    kept = resampling.resampled(more, nothing, percent=30)
    assert kept.columns == more.columns and kept.count() == 30 * sum(len(feature_words(r["text"])) >= 20 for r in more.collect()) // 100


def test_ranks_of_equal_scores_in_many_segments(spark):
    from pyspark.sql import functions as F

    rows = saved(spark.range(5_000).repartition(7).withColumn("score", F.when(F.col("id") < 4_000, 5).otherwise(F.col("id"))), "ties")
    key = F.struct((-F.col("score")).alias("down"), F.col("id").alias("id"))
    got = resampling.first_ranks(rows, key, 3_210, 5_000).collect()
    order = sorted(((-r["score"], r["id"]) for r in got))
    assert len(got) == 5_000
    assert {r["id"]: r["rank"] for r in got if r["rank"]} == {i: n + 1 for n, (_, i) in enumerate(order[:3_210])}


def test_cuts(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    kind = T.StructType([T.StructField("a", T.BooleanType()), T.StructField("b", T.LongType())])
    cuts = sorted((b % 3 == 0, b) for b in range(-20, 60, 2))
    df = spark.range(-30, 70).select((F.col("id") % 2 == 0).alias("a"), F.col("id").alias("b"))
    for some in (cuts, cuts[:1], []):
        got = df.select("a", "b", cuts_before(F.struct("a", "b"), cut_array(some, kind)).alias("n")).collect()
        assert all(r["n"] == sum(c <= (r["a"], r["b"]) for c in some) for r in got)


# Order MinHash


def chained(numbers):
    """Spark's xxhash64 of several 64-bit numbers: each is hashed with what the one before gave."""
    seed = 42
    for x in numbers:
        seed = xxh64_intdigest(struct.pack("<Q", x % (1 << 64)), seed)
    return seed


def plain_signature(text):
    """128 tuples, each by looking at all k-mers."""
    h = [xxh64_intdigest(w.encode(), 42) for w in words(text)]
    if not h:
        return [0] * 128
    parts = [h[i : i + 3] for i in range(len(h) - 2)] if len(h) >= 3 else [h]
    seen, kmers = Counter(), []
    for place, part in enumerate(parts):
        head = chained(part) >> 24
        number = seen[head]
        seen[head] += 1
        if number:
            # The occurrence is a 32-bit number to Spark.
            first = xxh64_intdigest(struct.pack("<q", head), 42)
            head = int_hash(number, first) >> 24
        kmers.append((head, place))
    out = []
    for i in range(128):
        begin = ((i - 64) << 57) % (1 << 64)

        def distance(kmer):
            return ((kmer[0] << 24) - begin) % (1 << 64), kmer[1]

        first = sorted(kmers, key=distance)[:2]
        out.append(chained([hash_ for hash_, _ in sorted(first, key=lambda k: (k[1], k[0]))]) & 0xFFFF)
    return out


def int_hash(x, seed):
    return xxh64_intdigest(struct.pack("<i", x), seed)


def test_signatures(more):
    from pyspark.sql import functions as F

    rows = more.select("text", order_minhash.signature(F.coalesce("text", F.lit(""))).alias("s")).collect()
    for text, got in rows:
        if len(text or "") < 10_000:
            assert got == plain_signature(text or ""), text


def test_edit_likeness(more, none):
    rows = [(r["doc_id"], r["text"] or "") for r in more.collect()]
    got = order_minhash.edit_likeness(more).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, _ in rows)
    # Those with doc_ids of their own have one next row, whatever the order among equal ones.
    counts = Counter(d for d, _ in rows)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    checked = 0
    for i, (doc_id, text) in enumerate(order):
        doc_id_after, following = order[(i + 1) % len(order)]
        if counts[doc_id] > 1 or counts[doc_id_after] > 1 or len(text) > 9_000 or len(following) > 9_000:
            continue
        (r,) = [r for r in got if r["doc_id"] == doc_id]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, after, other = map(plain_signature, (text, edited, following))
        assert r["n_chars"] == len(text) and r["edited_sha256"] == sha(edited)
        assert r["fingerprint"] == "".join(f"{x:04x}" for x in own)
        assert r["edited_fingerprint"] == "".join(f"{x:04x}" for x in after)
        assert r["near_edited"] == sum(a == b for a, b in zip(own, after)) / 128
        assert r["near_next"] == sum(a == b for a, b in zip(own, other)) / 128
        checked += 1
    assert checked > 60
    assert order_minhash.edit_likeness(none).count() == 0


def test_next_rows_across_slices(spark):
    from pyspark.sql import functions as F

    rows = identified(saved(spark.range(1_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text")).repartition(5), "line"))
    rows = rows.select("row_file", "row_at", F.col("doc.doc_id").alias("doc_id"))
    sliced = order_minhash.with_next(rows, [F.bitwise_not("doc_id")], ["doc_id"]).collect()
    slices = {}
    for r in sliced:
        slices.setdefault(r["slice"], []).append((r["halo"], -r["doc_id"]))
    assert len(slices) > 4
    after = {}
    for members in slices.values():
        members.sort()
        assert [halo for halo, _ in members].count(True) == 1
        after.update((-a, -b) for (_, a), (_, b) in zip(members, members[1:]))
    assert after == {i: (i - 1) % 1_000 for i in range(1_000)}


def test_likeness_follows_the_edits(spark):
    from pyspark.sql import functions as F

    text = " ".join(f"{w}{i % 17}" for i, w in enumerate((PROSE.split() * 12)))
    few = text.replace("river5", "stream")
    w = text.split()
    swapped = " ".join(w[len(w) // 2 :] + w[: len(w) // 2])
    rows = [("same", text), ("few", few), ("swapped", swapped), ("other", " ".join(reversed(w)))]
    df = spark.createDataFrame([(n, text, t) for n, t in rows], "name string, a string, b string")
    got = dict(
        map(tuple, df.select("name", order_minhash.likeness(order_minhash.signature(F.col("a")), order_minhash.signature(F.col("b")))).collect())
    )
    assert got["same"] == 1 and got["few"] > 0.8 and got["other"] < 0.1
    # The same k-mers in another order: about half of the pairs are turned.
    assert 0.2 < got["swapped"] < 0.8


def test_order_minhash_stays_in_the_jvm(more):
    plan = order_minhash.edit_likeness(more)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan
    # One exchange for the next rows, none for the fingerprints.
    assert plan.count("Exchange hashpartitioning") == 1


# Helpers


@pytest.mark.parametrize("most_bytes", [64 << 20, 0])
def test_rows_at_places(more, most_bytes):
    rows = identified(more)
    every = [(r["row_file"], r["row_at"]) for r in rows.select("row_file", "row_at").collect()]
    chosen = rows.filter("row_at % 3 = 0 OR doc.doc_id = 14").select("row_file", "row_at")
    want = {(r[0], r[1]) for r in chosen.collect()}
    for there in (True, False):
        got = at_places(rows, chosen, there, most_bytes)
        assert got.columns == rows.columns
        assert sorted((r["row_file"], r["row_at"]) for r in got.collect()) == sorted(p for p in every if (p in want) == there)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert ("bits_file" in plan) == (most_bytes > 0)
    assert at_places(rows, chosen.filter("false"), False, most_bytes).count() == len(every)
    assert at_places(rows, chosen.filter("false"), True, most_bytes).count() == 0


def test_texts_of_rows_that_are_no_suspects_are_not_shuffled(more):
    rows = identified(more)
    picked = at_places(rows, rows.filter("row_at = 0"), True).select("doc.text")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_positions_beyond_the_first_piece(spark):
    rows = identified(saved(spark.range(100_000).coalesce(1).withColumnRenamed("id", "doc_id"), "long_file"))
    gone = rows.filter("row_at % 32768 IN (0, 1, 7, 8, 32767)").select("row_file", "row_at")
    n = gone.count()
    assert n == 19 and at_places(rows, gone, False).count() == 100_000 - n
    assert at_places(rows, gone, True).select("row_file", "row_at").exceptAll(gone).count() == 0


def test_counts_of_the_encoding_pass(more):
    made = tokens.encoded(identified(more), path(), end_id=2, counts=True).collect()
    total, seen = Counter(), Counter()
    for r in made:
        if r["ids"] is None:
            seen.update(dict(zip(r["seen"], r["times"])))
        else:
            total.update(struct.unpack(f"<{len(r['ids']) // 2}H", r["ids"]))
    assert seen == total and total[2] >= len(ROWS)


# Mixing


def plain_mixture(rows, slots, max_sources, weigh):
    """(doc_id, slot, block, start) by plain loops; rows are (file, at, doc_id, source, size).

    ``weigh``: source and size of all its text to its weight, None for no part of the mixture.
    """
    totals = Counter()
    for _, _, _, source, size in rows:
        totals[source] += size
    weights = {s: weigh(s, n) for s, n in totals.items() if weigh(s, n) is not None}
    ranked = sorted(weights, key=lambda s: (-totals[s], s is None, s or ""))
    own, pool = ranked[:max_sources], ranked[max_sources:]
    lanes = {s: i for i, s in enumerate(own)} | {s: len(own) for s in pool}
    sizes, shares = [totals[s] for s in own], [weights[s] for s in own]
    if pool:
        sizes.append(sum(totals[s] for s in pool))
        shares.append(sum(weights[s] for s in pool))
    block = max(1, math.ceil(sum(sizes) / slots))
    table = mixing.schedule([-(-n // block) for n in sizes], shares)

    def order(row):
        file, at, doc_id, _, _ = row
        return chained([x for x in (doc_id, at) if x is not None]), doc_id is not None, doc_id or 0, at, file

    out, before = [], Counter()
    for row in sorted(rows, key=order):
        lane = lanes.get(row[3])
        if lane is None:
            out.append((row[2], None, row[3]))
        else:
            out.append((row[2], table[lane][before[lane] // block][0], row[3]))
            before[lane] += row[4]
    return bag(out)


@pytest.mark.parametrize("max_sources", [10_000, 5])
@pytest.mark.parametrize("temperature", [2.0, None])
def test_mixing_against_loops(spark, temperature, max_sources):
    rng = random.Random(5)
    names = [None, "", "big", *[f"s{i}" for i in range(12)]]
    shape = [20, 3, 300, *[rng.randint(1, 60) for _ in range(12)]]
    rows = [(i, "y" * rng.randrange(200), s) for i, s in enumerate(s for s, n in zip(names, shape) for _ in range(n))]
    df = saved(spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4), "mixed")
    given = {None: 2.0, "big": 0.25, "s1": 1.5, "s2": 1.0, "s3": 0.125, "s4": 1.0, "s5": 0.5, "s6": 3.0}
    found = identified(df).collect()
    plain = [(r["row_file"], r["row_at"], r["doc"]["doc_id"], r["doc"]["source"], len(r["doc"]["text"]) + 1) for r in found]
    if temperature is None:
        options, weigh = {"weights": given}, lambda s, n: given.get(s)
    else:
        options, weigh = {"temperature": temperature}, lambda s, n: n ** (1 / temperature)
    got = mixing.mixing(df, slots=200, max_sources=max_sources, **options).collect()
    assert bag((r["doc_id"], r["slot"], r["source"]) for r in got) == plain_mixture(plain, 200, max_sources, weigh)
    assert all(r["in_mixture"] == (r["slot"] is not None) for r in got)
    taken = sorted((r["slot"], r["size"]) for r in got if r["in_mixture"])
    assert len(taken) == len([r for r in got if weigh(r["source"], 1) is not None])


def test_small_sources_share_a_place_in_the_schedule(spark):
    rows = [(i, "z" * 20, f"site{i % 90}" if i % 3 else "large") for i in range(900)]
    df = saved(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), "sites")
    got = mixing.mixing(df, slots=90, max_sources=1).collect()
    assert len(got) == 900 and all(r["in_mixture"] for r in got)
    # A third is the large one's; so it is of every stretch, less than a block aside.
    for end in (10, 30, 60, 90):
        large = sum(r["size"] for r in got if r["slot"] < end and r["source"] == "large")
        assert abs(large - sum(r["size"] for r in got if r["slot"] < end) / 3) <= 2 * 900 * 21 / 90


# Toxicity


def test_toxicity_on_labels_held_out(spark):
    """Documents whose labels were not learned from: toxic ones rank above the others, and few are mistaken."""
    sf_dir = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = toxicity.toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = [(labels[r["doc_id"]], r["score"], r["predicted"]) for r in got.collect() if r["held_out"] and r["doc_id"] in labels]
    toxic, clean = ([s for label, s, _ in rows if label == x] for x in (1, 0))
    assert len(toxic) >= 5 and len(clean) >= 50
    above = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / len(toxic) / len(clean)
    assert above > 0.9
    assert sum(label != predicted for label, _, predicted in rows) < 0.1 * len(rows)
