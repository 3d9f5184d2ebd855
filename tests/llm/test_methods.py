"""The codes, models and schedules by themselves, against plain loops."""

import math
import random
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import golomb, rans
from tidemark.llm.golay import Golay
from tidemark.llm.mixing import capped_shares, schedule
from tidemark.llm.packing import boundaries
from tidemark.llm.ppm import grams, modelled, side_by_side, trie
from tidemark.llm.simhash import close, fingerprint, forest, layout
from tidemark.llm.tokens import Encoder
from tidemark.llm.toxicity import logistic, model


def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@given(st.sets(st.integers(0, 2**40)), st.integers(0, 30))
def test_golomb_round_trip(values, extra):
    values = np.array(sorted(values), np.uint64) + np.uint64(7)
    k = golomb.rice_bits(2**40 + extra, len(values))
    assert (golomb.decode(golomb.encode(values, 7, k), len(values), 7, k) == values).all()


@settings(deadline=None)
@given(st.lists(st.integers(0, 300), max_size=2000), st.integers(1, 9), st.integers(1, 5))
def test_rans_round_trip_and_checkpoints(tokens, lanes, interval):
    tokens = np.array(tokens, np.uint32)
    table = rans.Table(rans.frequencies(np.bincount(tokens, minlength=301)))
    block = rans.encode(tokens, table, lanes, interval)
    assert (rans.decode(block, table) == tokens).all()
    step = lanes * interval
    for i in range(-(-len(tokens) // step)):
        assert (rans.decode(block, table, i, i + 1) == tokens[i * step : (i + 1) * step]).all()


def test_rans_refuses_a_changed_block_and_another_table():
    tokens = np.arange(50, dtype=np.uint32)
    table = rans.Table(rans.frequencies(np.ones(50, int)))
    block = bytearray(rans.encode(tokens, table))
    block[-1] ^= 1
    with pytest.raises(ValueError):
        rans.decode(bytes(block), table)
    with pytest.raises(ValueError):
        rans.decode(rans.encode(tokens, table), rans.Table(rans.frequencies(np.arange(1, 51))))
    with pytest.raises(ValueError):
        rans.encode(np.array([1], np.uint32), rans.Table(rans.frequencies(np.array([1, 0]))))


def test_golay_is_perfect_and_close_words_share_a_key():
    golay, chance = Golay(), np.random.default_rng(1)
    words = chance.integers(0, 1 << 23, 4000)
    assert len(set(golay.nearest(np.arange(1 << 23)).tolist())) == 4096
    near = words.copy()
    for _ in range(2):
        near ^= 1 << chance.integers(0, 23, len(words))

    def keys(x):
        out = [set() for _ in x]
        for at, key in zip(*(k.tolist() for k in golay.keys(x))):
            out[at].add(key)
        return out

    assert all(a & b for a, b in zip(keys(words), keys(near)))
    assert {len(k) for k in keys(words)} == {1, 6}


@pytest.mark.parametrize("exact", [1, 2, 3])
def test_any_four_errors_leave_a_choice_with_two_in_a_segment(exact):
    chance = random.Random(exact)
    for _ in range(300):
        errors = set(chance.sample(range(64), 4))
        assert any(
            not errors & set(equal) and min(len(errors & set(s)) for s in segments) <= 2
            for equal, segments in layout(exact)
        )


@given(st.lists(st.integers(0, 255), min_size=1, max_size=40, unique=True))
def test_forest_joins_what_links_join(marks):
    marks = np.array(marks, np.uint64)

    def groups(links):
        of = {int(m): {int(m)} for m in marks}
        for a, b in links:
            if of[a] is not of[b]:
                of[a] |= of[b]
                for x in of[b]:
                    of[x] = of[a]
        return {frozenset(x) for x in of.values()}

    a, b = forest(marks)
    assert len(a) < len(marks)
    every = [(int(x), int(y)) for x, y in combinations(marks, 2) if close(np.array([x]), np.array([y]))[0]]
    assert groups(zip(a.tolist(), b.tolist())) == groups(every)


def test_fingerprint_follows_its_definition():
    import xxhash

    for text in ["", " \n", "one", "A b C", "a b c d", "a b c d a b c d a b c d é Ä", "x " * 70_000]:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()
        shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert fingerprint(text) == want


def test_words_are_encoded_as_whole_texts_are():
    encoder, chance = Encoder(tokenizer_path()), random.Random(3)
    assert encoder.by_word
    letters = "aAbB'sdtéÉßΣσςİı  \t\n\r\x0b\x0c\x1c\x85\xa0 ́e<|endoftext|>１2½²ªº.,!?☃😀K"
    texts = ["", " ", "<|ENDOFTEXT|> <|endoftext|>", "a" * 5000]
    texts += ["".join(chance.choice(letters) for _ in range(chance.randrange(30))) for _ in range(3000)]
    for text in texts:
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == want, repr(text)


def naive_share(text, at, counts, limit):
    """By the definition: longest context first, escapes with exclusion."""

    def kept(context):
        return {s: n for (c, s), n in counts.items() if c == context and n >= limit}

    def total(context):
        return sum(n for (c, _), n in counts.items() if c == context)

    excluded, share = set(), 1.0
    for k in range(min(5, at), -1, -1):
        context = text[at - k : at]
        n = total(context)
        if n < limit:
            continue
        shares = {s: (2 * c - 1) / (2 * n) for s, c in kept(context).items()}
        if not shares:
            continue
        room = 1 - sum(v for s, v in shares.items() if s in excluded)
        if text[at] in shares:
            return share * shares[text[at]] / room
        share *= (1 - sum(shares.values())) / room
        excluded |= set(shares)
    return share / (256 - len(kept(b"")))


@pytest.mark.parametrize("limit", [1, 2])
def test_ppm_shares(limit):
    texts = [modelled(t) for t in ["the cat sat", "the rat sat on the mat", "", "a cat", "the the the"]]
    counts = {}
    for t in texts:
        for at in range(1, len(t)):
            for k in range(min(5, at) + 1):
                key = (t[at - k : at], t[at])
                counts[key] = counts.get(key, 0) + 1

    def code(b):
        return int.from_bytes(b"\x01" + b, "big")

    keys = {code(c + bytes([s])): n for (c, s), n in counts.items() if n >= limit}
    totals = {}
    for (c, _), n in counts.items():
        totals[code(c)] = totals.get(code(c), 0) + n
    totals = {k: n for k, n in totals.items() if n >= limit}
    model_ = trie(
        np.array(list(keys), np.uint64), np.array(list(keys.values()), float), np.array(list(totals), np.uint64), np.array(list(totals.values()), float)
    )
    for text in [*texts, modelled("the dog sat at the zoo"), modelled("éß")]:
        at, found = grams(*side_by_side([text]))
        got = model_.log_shares(found)
        want = [math.log10(naive_share(text, i, counts, limit)) for i in at.tolist()]
        assert np.allclose(got, want, atol=1e-4)
    # The shares of all bytes after a context add up to one.
    for start in (b"\nthe ", b"\nzz", b"\n"):
        every = sum(10 ** model_.log_shares(grams(*side_by_side([start + bytes([s])]))[1])[-1] for s in range(256))
        assert abs(every - 1) < 1e-4


@given(st.lists(st.integers(1, 40), min_size=1, max_size=6))
def test_schedule_keeps_every_window_and_stays_within_a_block(blocks):
    table, total = schedule(blocks), sum(blocks)
    slots = sorted(w[0] for windows in table for w in windows)
    assert slots == list(range(total))
    for n, windows in zip(blocks, table):
        for slot, release, deadline in windows:
            assert release <= slot < deadline
        done = [0] * (total + 1)
        for slot, _, _ in windows:
            done[slot + 1] += 1
        for t in range(total + 1):
            assert abs(sum(done[: t + 1]) - t * n / total) < 1


@given(st.lists(st.integers(1, 1000), min_size=1, max_size=8))
def test_capped_shares(sizes):
    shares = capped_shares(sizes, 0.25)
    assert abs(sum(shares) - 1) < 1e-9
    assert max(shares) <= max(0.25, 1 / len(sizes)) + 1e-9


@given(st.dictionaries(st.integers(1, 60), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 4))
def test_boundaries_waste_least(histogram, buckets):
    lengths = sorted(histogram)

    def waste(bounds):
        return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in histogram.items())

    got = boundaries(np.array(lengths), np.array([histogram[x] for x in lengths]), buckets)
    choices = [(*c, lengths[-1]) for k in range(buckets) for c in combinations(lengths[:-1], k)]
    assert len(got) <= buckets and waste(got) == min(map(waste, choices))


def test_spelling_model_prefers_each_class_and_shares_what_it_has_not_seen():
    words = {"idiot": (50, 0), "house": (40, 400), "garden": (30, 300)}
    from tidemark.llm.toxicity import ORDER, figures_of, spelled

    counts = {}
    for word, (toxic, ordinary) in words.items():
        for gram in spelled(word, ORDER):
            a, b = counts.get(gram, (0, 0))
            counts[gram] = (a + toxic, b + ordinary)
    of = figures_of(model(counts))
    assert of("") == (0.0, 0.0) == of("123 !?")
    assert of("an idiot")[1] > 1 > of("house garden")[1]
    assert abs(of("qqqq")[1]) < 3


def test_logistic_separates():
    x, y = np.array([[0.0], [1], [2], [3]]), np.array([0.0, 0, 1, 1])
    w = logistic(x, y)
    assert w[0] + w[1] < 0 < w[0] + 2 * w[1]
