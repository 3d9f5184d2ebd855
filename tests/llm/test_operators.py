"""Every operator on a small table of hard cases, against plain loops.

The table has null, empty and blank texts, null and repeated doc_ids, fully repeated rows, ties,
a long text, and columns named like the operators' own.
"""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import exact_dedup, line_dedup, mixing, packing, ppm, quality, simhash, token_files, tokens, toxicity
from tidemark.llm.common import components, identified, running_totals, saved

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "row_file string, kept int, block int, fp string, size int, `a.b` int"
)
PROSE = (
    "the old house by the river was for sale and nobody in the town could say who had lived there "
    "before the war but the garden was full of apple trees that somebody must have planted with care"
)
WORDS = PROSE.split()


def changed(*at):
    return " ".join("zebra" if i in at else w for i, w in enumerate(WORDS))


TEXTS = [
    (1, PROSE, "a"),
    (2, PROSE.replace(" ", "  ") + "\n", "a"),
    (3, PROSE, "b"),
    (4, None, "b"),
    (5, "", "b"),
    (6, " \n\t\x0b", None),
    (7, changed(5), "a"),
    (8, changed(5, 20) + "\n" + PROSE, "a"),
    (9, "Short one", "c"),
    (10, "é ß <|endoftext|> \U0001f600 x y", "c"),
    (11, "spam spam spam spam spam spam spam spam spam spam spam spam", "c"),
    (12, "$$$ ### buy|now ### $$$ *** now|buy %%% &&& <<< >>> ||| ***", "a"),
    (13, ("word%d " * 0) + " ".join(f"w{i}" for i in range(30_000)), "a"),
    (14, "first line here now\nsecond line\n\nfirst line here now\nfirst line here today", "b"),
    (14, "another text with the same number as the one before it", "b"),
    (15, "repeated row", "b"),
    (15, "repeated row", "b"),
    (None, "no number " + PROSE, "a"),
    (None, None, None),
    (16, "line of five good words\nline of five good words more", "a"),
    (-3, "negative number", "a"),
]
ROWS = [(d, t, "en", s, len(t or ""), "x", 7, 7, "fp", 7, 7) for d, t, s in TEXTS]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return saved(df, "fixture")


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("doc_id = 12345")


def path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def n_ids(text):
    from tokenizers import Tokenizer

    return len(Tokenizer.from_file(path()).encode(text or "", add_special_tokens=False).ids)


def bag(rows):
    return sorted(map(repr, rows))


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_rows_keep_their_names(docs, spark):
    for df in (docs, spark.createDataFrame(ROWS, SCHEMA)):
        rows = identified(df)
        first, again = (sorted(map(tuple, rows.select("row_file", "row_at").collect())) for _ in range(2))
        assert first == again and len(set(first)) == len(ROWS)
        assert bag(map(tuple, rows.select("doc.*").collect())) == bag(ROWS)


def test_running_totals(spark):
    from pyspark.sql import functions as F

    rows = [(g, i, i % 4) for g in ("x", None, "y") for i in range(50)]
    df = saved(spark.createDataFrame(rows, "g string, i bigint, n bigint"), "totals")
    got = running_totals(df, ["g"], ["i"], F.col("n"), "before", rows_per_slice=3).collect()
    for group in ("x", None, "y"):
        mine = [r for r in got if r["g"] == group]
        assert len(mine) == 50
        at = 0
        for r in sorted(mine, key=lambda r: (r["before"], r["n"] > 0)):
            assert r["before"] == at
            at += r["n"]


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(7, 3), (9, 7), (-5, 9), (4, 4)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a bigint, b bigint"), "links").collect()))
    assert got == {i: 100 for i in range(101, 161)} | {3: -5, 7: -5, 9: -5}
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "links").count() == 0


def test_token_counts(docs, none):
    lengths = Counter(n_ids(t) for _, t, _ in TEXTS)
    got = {r["n_tokens"]: r for r in tokens.token_counts(docs, path()).collect()}
    assert {k: r["n_docs"] for k, r in got.items()} == lengths
    for limit, r in got.items():
        assert r["docs_at_least"] == sum(n for x, n in lengths.items() if x >= limit)
        assert r["tokens_at_least"] == sum(n * x for x, n in lengths.items() if x >= limit)
        assert r["truncated_total"] == sum(n * min(x, limit) for x, n in lengths.items())
        assert r["quantile"] == sum(n for x, n in lengths.items() if x <= limit) / len(TEXTS)
    table = tokens.token_counts(docs, path())
    for r in tokens.at_limits(table, [0, 3, 10, 10**6]).collect():
        cut = sum(n * max(0, x - r["limit"]) for x, n in lengths.items())
        assert (r["docs_over"], r["tokens_cut"]) == (sum(n for x, n in lengths.items() if x > r["limit"]), cut)
    every = sorted(lengths.elements())
    for r in tokens.quantiles(table, [0.5, 1.0]).collect():
        assert r["n_tokens"] == every[math.ceil(r["share"] * len(every)) - 1]
    assert tokens.token_counts(none, path()).count() == 0


def test_exact_dedup(docs, none):
    groups = {}
    for doc, text, _ in TEXTS:
        groups.setdefault(plain(text), []).append((-len(text or ""), doc is None, doc or 0, doc))
    got = exact_dedup.exact_dedup(docs).collect()
    want = []
    for key, rows in groups.items():
        rows.sort(key=lambda r: r[:3])
        for i, row in enumerate(rows):
            want.append((row[3], rows[0][3], len(rows), i == 0, hashlib.sha256(key.encode()).hexdigest()))
    assert bag(map(tuple, got)) == bag(want)
    assert exact_dedup.exact_dedup(none).count() == 0
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def figures(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_quality(docs, none):
    got = quality.quality(docs).collect()
    want = []
    for doc, text, _ in TEXTS:
        n, chars, symbols, dup, again = figures(text)
        want.append((doc, n, chars, symbols, dup, again, n < 10 or 100 * again > 20 * n))
    assert bag(tuple(r)[:7] for r in got) == bag(want)
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert {1, 2, 3, 7} <= kept and not {4, 5, 9, 11} & kept
    assert quality.quality(none).count() == 0
    assert quality.drop_low_quality(docs).columns == docs.columns
    assert quality.drop_low_quality(docs).count() == sum(r["kept"] for r in got)


def test_fit_trusts_rules_that_agree(spark):
    good = [tuple([1] * 8 + [80])]
    bad = [tuple([-1, -1] + [1] * 6 + [15])]
    odd = [tuple([1] * 6 + [-1, 1] + [5])]
    table = spark.createDataFrame(good + bad + odd, ", ".join(f"{r} int" for r in quality.RULES) + ", n bigint")
    prior, weights = quality.fitted(table)
    odds = [prior + sum(w[0 if v < 0 else 1] for v, w in zip(row[0], weights)) for row in (good, bad, odd)]
    assert odds[0] > 0 > odds[1] and odds[2] > 0


def linked_groups(marks):
    ids = list(range(len(marks)))
    for i in range(len(marks)):
        for j in range(i):
            if bin(marks[i] ^ marks[j]).count("1") <= 4:
                a, b = ids[i], ids[j]
                ids = [b if x == a else x for x in ids]
    return ids


def test_near_dedup(docs, none):
    marks = [simhash.fingerprint(t or "") for _, t, _ in TEXTS]
    groups = linked_groups(marks)
    smallest = {}
    for (doc, _, _), g in zip(TEXTS, groups):
        if doc is not None:
            smallest[g] = min(doc, smallest.get(g, doc))
    got = simhash.near_dedup(docs).collect()
    want = [(d, f"{m:016x}", smallest.get(g)) for (d, _, _), m, g in zip(TEXTS, marks, groups)]
    assert bag(tuple(r)[:3] for r in got) == bag(want)
    assert sum(r["kept"] for r in got) == len(set(groups))
    assert simhash.near_dedup(none).count() == 0
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(groups))


@pytest.mark.parametrize("exact, chunk", [(1, 8192), (2, 8192), (1, 3)])
def test_links_of_a_dense_and_a_sparse_set(spark, exact, chunk):
    chance = np.random.default_rng(5)
    marks = set(chance.integers(0, 2**63, 100).tolist())
    for centre in list(marks)[:5]:
        for _ in range(25):
            mark = centre
            for bit in chance.integers(0, 64, 3).tolist():
                mark ^= 1 << bit
            marks.add(mark)
    marks = sorted(marks)
    signed = [(m - 2**64 if m >= 2**63 else m,) for m in marks]
    table = saved(spark.createDataFrame(signed, "fp bigint"), "marks")
    roots = dict(map(tuple, components(simhash.linked(table, exact, chunk), "links").collect()))
    groups = linked_groups(marks)
    want = {}
    for (m,), g in zip(signed, groups):
        want[g] = min(m, want.get(g, m))
    assert {m: roots.get(m, m) for (m,) in signed} == {m: want[g] for (m,), g in zip(signed, groups)}


def test_toxicity(spark, docs, none):
    texts = [f"{w} morning to the {x} of number {i}" for i in range(60) for w, x in [("good", "house"), ("bad", "vexorum")]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [(i, "vexorum" in t and 1 or 0, None) for i, t in enumerate(texts)] + [(None, 1, 1), (3, None, 1), (999, 1, 1)],
        "doc_id bigint, toxic int, quality int",
    )
    for r in toxicity.toxicity(df, labels).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == ("vexorum" in texts[r["doc_id"]]) == (r["score"] >= 0.5)
    got = toxicity.toxicity(docs, labels.filter("doc_id < 10")).collect()
    assert bag(r["doc_id"] for r in got) == bag(d for d, _, _ in TEXTS)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(none, labels).count() == 0


def test_toxicity_scores_do_not_follow_the_bound(spark):
    """One label in ten is toxic and the words tell only a little: a cut of the larger class alone
    must not raise every score."""
    chance = np.random.default_rng(3)
    toxic = [int(i % 10 == 0) for i in range(3000)]
    texts = [" ".join(chance.choice(["house", "river", "garden", "vexorum"], 4, p=[0.3, 0.3, 0.3 - t / 10, 0.1 + t / 10])) for t in toxic]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id bigint, toxic int")
    full, cut = (
        np.array([r["score"] for r in toxicity.toxicity(df, labels, **options).orderBy("doc_id").collect()])
        for options in ({}, {"max_rows": 250})
    )
    assert abs(full.mean() - 0.1) < 0.03
    assert abs(cut.mean() - full.mean()) < 0.03 and np.abs(cut - full).mean() < 0.05


def test_token_files(spark, docs, none, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path())
    token_files.write_tokens(docs, str(tmp_path / "a"), path(), block_tokens=40, shards=3)
    got = token_files.read_tokens(spark, str(tmp_path / "a")).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((d for d, _, _ in TEXTS), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(r["ids"]))
        at += len(ids)
    want = [(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for d, t, _ in TEXTS]
    assert bag((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == bag(want)
    token_files.write_tokens(none, str(tmp_path / "b"), path())
    assert token_files.read_tokens(spark, str(tmp_path / "b")).count() == 0


def test_line_dedup(docs, none):
    order = sorted(range(len(TEXTS)), key=lambda i: (TEXTS[i][0] is None, TEXTS[i][0] or 0))
    seen, want = [], []
    for i in order:
        lines = [(n, set(words(x))) for n, x in enumerate((TEXTS[i][1] or "").split("\n")) if words(x)]
        gone = []
        for n, s in lines:
            if any(len(s & o) / len(s | o) >= 0.8 for o in seen):
                gone.append(n)
            seen.append(s)
        want.append((TEXTS[i][0], len(lines), len(gone), ",".join(map(str, gone))))
    got = [tuple(r) for r in line_dedup.line_dedup(docs).collect()]
    # Rows of one doc_id come in file order, which the table does not fix.
    unique = {d for d, n in Counter(d for d, _, _ in TEXTS).items() if n == 1}
    assert bag(r for r in got if r[0] in unique) == bag(r for r in want if r[0] in unique)
    assert sum(r[2] for r in got) == sum(r[2] for r in want)
    assert line_dedup.line_dedup(none).count() == 0
    cleaned = {r["doc_id"]: r["text"] for r in line_dedup.drop_similar_lines(docs).collect()}
    assert cleaned[16] == "line of five good words" and cleaned[1] == PROSE and cleaned[4] is None
    assert line_dedup.drop_similar_lines(docs).columns == docs.columns


def test_line_dedup_of_a_large_group(spark, tmp_path, monkeypatch):
    """Copies that differ in a word each meet the earliest one: the pairs verified follow the group, not its square."""
    base = [f"word{i}" for i in range(60)]
    rows = [(n, " ".join([*base[: n % 60], f"other{n}", *base[n % 60 + 1 :]])) for n in range(240)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "docs"))
    verify, pairs = line_dedup.verified, []

    def counted(found, *rest):
        pairs.append(found.distinct().count())
        return verify(found, *rest)

    monkeypatch.setattr(line_dedup, "verified", counted)
    got = line_dedup.line_dedup(spark.read.parquet(str(tmp_path / "docs"))).collect()
    assert {r["doc_id"]: r["removed"] for r in got} == {n: "0" if n else "" for n, _ in rows}
    assert sum(pairs) <= 8 * len(rows)


@pytest.mark.parametrize("hubs", [0, 1, 3])
def test_line_dedup_of_all_sizes(spark, tmp_path, monkeypatch, hubs):
    """Around the limits of the size classes and of the longer signatures, whatever meets the earliest first."""
    monkeypatch.setattr(line_dedup, "HUBS", hubs)
    rng = random.Random(7)
    lines = []
    for size in (1, 2, 4, 5, 6, 8, 13, 16, 20, 32, 52, 64, 66, 80, 128):
        for _ in range(3):
            line = [f"w{rng.randrange(400)}" for _ in range(size)]
            for _ in range(6):
                lines.append(" ".join(line))
                line = [w for w in line if rng.random() > 0.06] + [f"w{rng.randrange(400)}" for _ in range(rng.randrange(2 + size // 8))]
    rng.shuffle(lines)
    rows = [(n // 3 if n % 10 else None, line) for n, line in enumerate(lines)]
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "docs"))
    seen, want = [], []
    for doc_id, line in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        s = set(words(line))
        gone = any(9 * len(s & o) >= 4 * (len(s) + len(o)) for o in seen)
        seen.append(s)
        want.append((doc_id, int(bool(s)), int(gone)))
    got = line_dedup.line_dedup(spark.read.parquet(str(tmp_path / "docs")))
    assert 50 < sum(r[2] for r in want) < len(want) - 50
    assert bag(tuple(r)[:3] for r in got.collect()) == bag(want)


def test_line_dedup_counts_all_words(spark, tmp_path):
    """The order of rarity comes from every word of every document."""
    from pyspark.sql import functions as F

    texts = [f"all  w{n % 50}\town{n}\n\n all last{n}" for n in range(20_000)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs.write.parquet(str(tmp_path / "docs"))
    often = Counter(w for t in texts for w in words(t or ""))
    place, half = line_dedup.by_rarity(identified(spark.read.parquet(str(tmp_path / "docs"))))
    spark.createDataFrame([(w,) for w in often], "word string").write.parquet(str(tmp_path / "words"))
    hashed = spark.read.parquet(str(tmp_path / "words")).select("word", F.xxhash64("word").alias("h"))
    got = [(w, h % (1 << 64) >> 48, p % (1 << 64) >> 48, p) for w, h, p in hashed.select("*", place(F.col("h")).alias("place")).collect()]
    classes = Counter()
    for word, at, _, _ in got:
        classes[at] += often[word]
    ranks = {at: rank for rank, at in enumerate(sorted(range(1 << 16), key=lambda c: (classes[c], c)))}
    assert sum(ranks[at] != rank ^ (1 << 15) for _, at, rank, _ in got) == 0
    rarer = sum(often[word] for word, _, _, p in got if p < half)
    assert 2 * rarer <= often.total() < 2 * (rarer + max(classes.values()))


def test_line_dedup_lists(spark):
    """Similar sets of any sizes meet where they first share a word; sets too different in size do not."""
    from pyspark.sql import functions as F

    sizes = [(n, m) for n in range(1, 80) for m in range(n, 5 * n // 4 + 1)]
    far = [(n, 2 * n) for n in range(1, 80)]
    rows, own = [], iter(range(1 << 20, 1 << 30))
    for at, (n, m) in enumerate(sizes + far):
        shared = -(-4 * (n + m) // 9)
        for side, size in enumerate((n, m)):
            places = size - -(-4 * size // 5) + 1
            first = max(0, min(size - shared, places - 1))
            rows.append((2 * at + side, at, size, [at if i == first else next(own) for i in range(places)], False, 0, 0))
    sets = spark.createDataFrame(rows, "gid bigint, doc_id bigint, n int, prefix array<int>, goes boolean, parity bigint, odd bigint")
    met = set()
    for turn in range(line_dedup.ROUNDS):
        a, b = (line_dedup.by_size(sets, turn).alias(x) for x in "ab")
        on = f"a.key = b.key AND a.gid + 1 = b.gid AND a.doc_id = b.doc_id AND {line_dedup.ORDERED} AND {line_dedup.POSSIBLE}"
        met |= {r["doc_id"] for r in a.join(b, F.expr(on)).select("a.doc_id").collect()}
    assert met == set(range(len(sizes)))
    keys = line_dedup.by_size(sets, 0).unionByName(line_dedup.by_size(sets, 1)).filter(f"doc_id >= {len(sizes)}")
    assert keys.groupBy("key").count().filter("count > 1").count() == 0


def test_lm_scores(docs, none):
    counts = Counter()
    for doc, text, _ in TEXTS:
        if doc is None or zlib.crc32(str(doc).encode()) % 7 != 2:
            counts.update((text or "").encode().lower().split())
            counts[b"\n"] += 1
    n, v = sum(counts.values()), len(counts)
    want = []
    for doc, text, _ in TEXTS:
        w = [*(text or "").encode().lower().split(), b"\n"]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        held = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2
        want.append((doc, held, len(w), sum(x in counts for x in w), n, round(base, 6)))
    for most in (1 << 18, 4):
        got = ppm.lm_scores(docs, max_words=most).collect()
        assert bag((*tuple(r)[:5], round(r["base_score"], 6)) for r in got) == bag(want)
        assert all(r["score"] < 0 for r in got)
    by = {r["doc_id"]: r["score"] / r["n_tokens"] for r in got}
    assert by[1] > by[12]
    assert ppm.lm_scores(docs, max_nodes=50).count() == len(TEXTS)
    assert ppm.lm_scores(none).count() == 0


def test_lm_scores_do_not_follow_the_size_of_the_trie(docs):
    """Scores of the whole model, by counts in a plain loop, whatever part of it is sent to the tasks."""
    learned = [t for d, t, _ in TEXTS if d is None or zlib.crc32(str(d).encode()) % 7 != 2]
    counts, totals = Counter(), Counter()
    for text in learned:
        data = ppm.modelled(text or "")
        for at in range(1, len(data)):
            for k in range(min(ppm.ORDER, at) + 1):
                gram = int.from_bytes(b"\x01" + data[at - k : at + 1], "big")
                counts[gram] += 1
                totals[gram >> 8] += 1
    keys, contexts = np.array(list(counts), np.uint64), np.array(list(totals), np.uint64)
    whole = ppm.trie(keys, np.array([*counts.values()], float), contexts, np.array([*totals.values()], float))
    want = []
    for doc, text, _ in TEXTS:
        found = ppm.grams(*ppm.side_by_side([ppm.modelled(text or "")]))[1]
        want.append((repr(doc), whole.log_shares(found).sum()))
    for most in (1 << 20, 300, 1):
        got = [(repr(r["doc_id"]), r["score"]) for r in ppm.lm_scores(docs, max_nodes=most).collect()]
        for (a, x), (b, y) in zip(sorted(got), sorted(want)):
            assert a == b and abs(x - y) < 1e-5 * abs(y)


def test_mixing(docs, none):
    got = mixing.mixing(docs, slots=40).collect()
    assert bag((r["doc_id"], r["source"], r["size"]) for r in got) == bag((d, s, len(t or "") + 1) for d, t, s in TEXTS)
    by_source = {}
    for r in got:
        by_source.setdefault(r["source"], []).append(r)
    for rows in by_source.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["start"]):
            assert r["start"] == at
            at += r["size"]
    assert all((r["slot"] is not None) and r["release"] <= r["slot"] < r["deadline"] for r in got if r["in_mixture"])
    # No source is a block ahead of or behind its weight, document sizes apart.
    total = 1 + max(r["slot"] for r in got if r["in_mixture"])
    assert total <= 44
    order = [r["doc_id"] for r in sorted((r for r in got if r["in_mixture"]), key=lambda r: (r["slot"], r["start"]))]
    assert sorted(map(repr, order)) == bag(r["doc_id"] for r in mixing.mixture(docs, slots=40).collect())
    chosen = mixing.mixing(docs, weights={"b": 1.0, "c": 3.0, "zz": 5.0}, slots=20).collect()
    assert {r["source"] for r in chosen if r["in_mixture"]} == {"b", "c"}
    assert all(r["in_mixture"] for r in chosen if r["source"] == "c")
    assert mixing.mixing(none).count() == 0 and mixing.mixture(none).count() == 0


def test_mixing_leaves_out_no_document(spark):
    """Skewed sources: every document has a slot, with and without weights, and weights hold while they can."""
    many = {"big": 900, "mid": 50, "small": 50}
    rows = [(i, "x" * 9, s) for i, s in enumerate(s for s, n in many.items() for _ in range(n))]
    df = saved(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), "skewed")
    for options in ({}, {"max_share": 0.4}, {"weights": {"big": 1.0, "mid": 1.0, "small": 2.0}}):
        got = mixing.mixing(df, slots=100, **options).collect()
        assert len(got) == 1000 and all(r["in_mixture"] and r["slot"] is not None for r in got)
        assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)
        assert {r["slot"] for r in got} == set(range(100))
        assert mixing.mixture(df, slots=100, **options).count() == 1000
    # 5 blocks of the small source at 2 of 4 end after 10 slots, then 1:1 until mid has no more.
    of = {r["slot"]: r["source"] for r in got}
    assert Counter(of[i] for i in range(10)).keys() == {"big", "mid", "small"}
    assert sum(of[i] == "small" for i in range(10)) == 5
    assert sum(of[i] == "mid" for i in range(15)) == 5
    assert {of[i] for i in range(15, 100)} == {"big"}


def test_packing(docs, none):
    got = packing.packed(docs, path(), buckets=3, max_length=50, budget=200).collect()
    whole = Counter()
    for r in got:
        assert r["n_tokens"] <= r["boundary"] <= 50 and r["padding"] == r["boundary"] - r["n_tokens"]
        assert r["slot"] < 200 // r["boundary"]
        whole[r["doc_id"]] += r["n_tokens"]
    places = Counter((r["boundary"], r["batch"], r["slot"]) for r in got)
    assert max(places.values()) == 1 and len({r["boundary"] for r in got}) <= 3
    for boundary in {r["boundary"] for r in got}:
        ranks = sorted(r["batch"] * (200 // boundary) + r["slot"] for r in got if r["boundary"] == boundary)
        assert ranks == list(range(len(ranks)))
    want = Counter()
    for doc, text, _ in TEXTS:
        want[doc] += n_ids(text) + 1
    assert whole == want
    assert packing.packed(none, path()).count() == 0


def test_batches_keep_the_order_of_the_mixture(spark):
    """A quarter of the text is of one source: so is a quarter of every batch, to one block."""
    text = "the old house by the river"
    rows = [(i, text, "b" if i % 4 == 0 else "a") for i in range(800)]
    df = saved(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), "quarters")
    ordered = saved(mixing.mixture(df, slots=800), "ordered")
    n = n_ids(text) + 1
    got = packing.packed(ordered, path(), max_length=n, budget=40 * n).collect()
    batches = Counter(r["batch"] for r in got)
    assert batches == {i: 40 for i in range(20)}
    shares = Counter(r["batch"] for r in got if r["doc_id"] % 4 == 0)
    assert all(abs(shares[i] - 10) <= 1 for i in batches)


def test_running_totals_by_place(spark):
    from pyspark.sql import functions as F

    rows = [(g, f, i, i % 4) for g in ("x", None) for f in (1, 2) for i in range(50)]
    df = saved(spark.createDataFrame(rows, "g string, f int, i bigint, n bigint"), "totals")
    got = running_totals(df, ["g"], ["f", "i"], F.col("n"), "before", rows_per_slice=7, hashed=False).collect()
    for group in ("x", None):
        at = 0
        for r in sorted((r for r in got if r["g"] == group), key=lambda r: (r["f"], r["i"])):
            assert r["before"] == at
            at += r["n"]


def test_pipeline_against_loops(spark, docs, tmp_path):
    """Each stage's decision by plain loops over its own input."""
    current = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    current = saved(current, "unique")
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in current.collect()}
        result = saved(stage(spark, current, ""), name)
        after = [r["doc_id"] for r in result.collect()]
        if name == "quality_rules":
            want = {r["doc_id"] for r in quality.quality(current).collect() if r["kept"]}
        elif name == "exact_dedup":
            best = {}
            for d, r in before.items():
                key = plain(r["text"])
                best[key] = min(best.get(key, (0, d)), (-len(r["text"] or ""), d))
            want = {d for _, d in best.values()}
        elif name == "simhash_near_dedup":
            ids = sorted(before)
            groups = linked_groups([simhash.fingerprint(before[d]["text"] or "") for d in ids])
            want = {min(d for d, g in zip(ids, groups) if g == x) for x in set(groups)}
        elif name == "mixing":
            want = {r["doc_id"] for r in mixing.mixing(current).collect() if r["in_mixture"]}
        else:
            lengths = Counter()
            for r in result.collect():
                lengths[r["doc_id"]] += r["n_tokens"]
            assert lengths == {d: n_ids(r["text"]) + 1 for d, r in before.items()}
            continue
        assert sorted(after) == sorted(want) and result.columns == docs.columns
        current = result
    (tmp_path / "sf").mkdir()
    docs.write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "sf")).count() > 0
