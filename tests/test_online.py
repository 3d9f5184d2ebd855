"""The latest-value table: golden rules and random batches against a sequential model."""

import dataclasses
import hashlib
import json
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.scalars import entity_key, identifier, key_bytes, key_text, short_name
from tidemark.operators import online
from tidemark.operators.metrics import stored_freshness
from tidemark.operators.runs import BUCKET
from tidemark.operators.unions import union_rows
from tidemark.sinks.online import OnlineStore
from tidemark.sinks.registry import read_schemas, register_schema
from tidemark.spec import FeatureTable, Field, SchemaError

A = FeatureTable("a", [Field("k", "string")], [Field("x", "int32"), Field("y", "int32")], 100)
B = dataclasses.replace(A, name="b", max_age=10)
C = dataclasses.replace(A, name="c", max_age=None)
ROWS = "k string, at int, x int, y int"


def batch(spark, rows):
    return spark.createDataFrame(rows, ROWS).withColumn("ts", F.timestamp_seconds("at"))


def state(store, table):
    df = store.read(table)
    return rows_of(
        df.select("k", "x", "y", F.unix_seconds("event_timestamp").alias("at"), F.unix_seconds("_expiry").alias("e"))
    )


def test_keys(spark):
    df = spark.sql("SELECT 7L b, 'v' a")
    row = df.select(
        entity_key("proj", ["b", "a"]), key_text(["b", "a"]), key_bytes(["b", "a"], "declared")
    ).first()
    assert row[0] == hashlib.md5(b"proj#a#b:v#7").hexdigest()
    assert (row[1], bytes(row[2])) == ("v#7", b"7#v")
    with pytest.raises(ValueError):
        key_text(["a"], "random")
    long = "project__" + "e" * 60
    assert len(short_name(long, 50)) == 50 and short_name(long, 50)[:42] == long[:42]
    assert short_name("short", 50) == "short" and identifier("a-b") == "a_b"
    assert short_name(long + "1", 50) != short_name(long + "2", 50)


def test_newer_rows_win_and_equal_times_overwrite(spark, tmp_path):
    store = OnlineStore(spark, str(tmp_path))
    store.write(batch(spark, [("k", 50, 1, 1), ("k", 40, 9, 9), ("old", 5, 1, 1)]), A, "ts")
    store.write(batch(spark, [("k", 49, 2, 2), ("new", 1, 7, 7)]), A, "ts")
    assert state(store, A) == [("k", 1, 1, 50, 150), ("new", 7, 7, 1, 101), ("old", 1, 1, 5, 105)]
    store.write(batch(spark, [("k", 50, 3, None)]), A, "ts")
    assert state(store, A)[0] == ("k", 3, 1, 50, 150)


def test_value_of_a_refused_row_does_not_come_back(spark, tmp_path):
    store = OnlineStore(spark, str(tmp_path))
    for rows in ([("k", 50, None, 1)], [("k", 40, 8, 8)], [("k", 60, None, None)]):
        store.write(batch(spark, rows), A, "ts")
    assert state(store, A) == [("k", None, 1, 60, 160)]


def test_expiry_is_shared_and_only_moves_up(spark, tmp_path):
    store = OnlineStore(spark, str(tmp_path))
    store.write(batch(spark, [("k", 50, 1, 1)]), A, "ts")
    store.write(batch(spark, [("k", 60, 1, 1)]), B, "ts")
    assert state(store, A)[0][-1] == 150 and state(store, B)[0][-1] == 150
    store.write(batch(spark, [("k", 200, 1, 1)]), B, "ts")
    assert state(store, A)[0][-1] == 210
    store.write(batch(spark, [("k", 201, 1, 1)]), C, "ts")
    assert state(store, A)[0][-1] is None
    store.write(batch(spark, [("k", 202, 1, 1)]), B, "ts")
    assert state(store, C)[0][-1] == 212


def test_expiry_jitter_is_bounded_and_repeatable(spark):
    df = batch(spark, [(str(i), 0, 1, 1) for i in range(200)])
    log = online.log_rows(df, A, "ts", 0, max_jitter=30)
    shifts = [r[0] - 100 for r in log.select(F.unix_seconds("_expiry")).collect()]
    assert min(shifts) >= 0 and max(shifts) < 30 and len(set(shifts)) > 10
    again = online.log_rows(df, A, "ts", 0, max_jitter=30)
    assert log.exceptAll(again).count() == 0


def test_row_layout_replaces_whole_rows(spark, tmp_path):
    store = OnlineStore(spark, str(tmp_path), layout="row", buckets=2)
    store.write(batch(spark, [("k", 50, 1, 1), ("", 50, 1, 1)]), A, "ts")
    store.write(batch(spark, [("k", 60, None, 2)]), A, "ts")
    store.write(batch(spark, [("k", 60, 5, None)]), A, "ts")
    store.write(batch(spark, [("k", 10, 8, 8)]), A, "ts")
    store.write(batch(spark, [("k", 300, 1, 1)]), B, "ts")
    assert state(store, A) == [("k", 5, None, 60, 160)]
    store.compact([A, B])
    assert state(store, A) == [("k", 5, None, 60, 160)]


def test_repeated_batches_are_applied_once(spark, tmp_path):
    store = OnlineStore(spark, str(tmp_path))
    first = batch(spark, [("k", 50, 1, 1)])
    assert store.write(first, A, "ts", tag="q-0")
    assert not store.write(batch(spark, [("k", 99, 9, 9)]), A, "ts", tag="q-0")
    assert state(store, A) == [("k", 1, 1, 50, 150)]
    # An incomplete try does not count, and is replaced under its own number.
    folder = next((tmp_path / "default__k" / "log" / "a").iterdir())
    (folder / "_SUCCESS").unlink()
    assert store.read(A).count() == 0
    assert store.write(first, A, "ts", tag="q-0")
    assert len(list((tmp_path / "default__k" / "log" / "a").iterdir())) == 1
    assert state(store, A) == [("k", 1, 1, 50, 150)]


def test_time_kinds_are_not_mixed(spark, tmp_path):
    rows = batch(spark, [("k", 50, 1, 1)])
    OnlineStore(spark, str(tmp_path)).write(rows, A, "ts")
    naive = rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    with pytest.raises(SchemaError):
        OnlineStore(spark, str(tmp_path)).write(naive, B, "ts")
    other = OnlineStore(spark, str(tmp_path / "other"))
    other.write(naive, B, "ts")
    assert other.read(B).schema["_expiry"].dataType.simpleString() == "timestamp_ntz"


def test_lookup(spark, tmp_path):
    store = OnlineStore(spark, str(tmp_path))
    store.write(batch(spark, [("k", 50, 1, 2), ("j", 10, 3, 4)]), A, "ts")
    store.write(batch(spark, [("k", 50, 5, None)]), B, "ts")
    requests = spark.createDataFrame([("k", 1), ("k", 2), ("j", 3), ("zz", 4)], "k string, n int")
    found = store.get(requests, [A, B], F.timestamp_seconds(F.lit(61)), with_status=True)
    assert found.columns[:5] == ["k", "n", "a__x", "a__y", "a__status"]
    assert rows_of(found, "n", "a__x", "a__y", "a__status", "b__x", "b__status") == [
        (1, 1, 2, "PRESENT", None, "OUTSIDE_MAX_AGE"),
        (2, 1, 2, "PRESENT", None, "OUTSIDE_MAX_AGE"),
        (3, 3, 4, "PRESENT", None, "NOT_FOUND"),
        (4, None, None, "NOT_FOUND", None, "NOT_FOUND"),
    ]
    empty = OnlineStore(spark, str(tmp_path / "empty")).get(requests, [A], F.current_timestamp())
    assert rows_of(empty, "n", "a__x") == [(1, None), (2, None), (3, None), (4, None)]
    by_row = OnlineStore(spark, str(tmp_path / "rows"), layout="row")
    by_row.write(batch(spark, [("k", 50, 1, 2)]), A, "ts")
    seen = by_row.get(requests, [A, B], F.timestamp_seconds(F.lit(150)))
    assert rows_of(seen, "n", "a__x", "b__x") == [(n, None, None) for n in (1, 2, 3, 4)]
    seen = by_row.get(requests, [A, B], F.timestamp_seconds(F.lit(149)))
    assert rows_of(seen.filter("a__x IS NOT NULL"), "n", "a__x") == [(1, 1), (2, 1)]
    exact = store.get(requests.filter("n = 1"), [B], F.timestamp_seconds(F.lit(60)))
    assert exact.first()["b__x"] == 5


def test_compaction_keeps_the_state(spark, tmp_path):
    store, plain = OnlineStore(spark, str(tmp_path / "c"), buckets=2), OnlineStore(spark, str(tmp_path / "p"))
    steps = [
        (A, [("k", 50, 1, None), ("j", 10, 3, 4)]),
        (B, [("k", 70, 1, 1)]),
        (C, [("j", 71, 1, 1)]),
        (A, [("k", 40, 9, 9), ("j", 80, None, 5)]),
        (A, [("k", 90, None, 6)]),
    ]
    for i, (table, rows) in enumerate(steps):
        store.write(batch(spark, rows), table, "ts")
        plain.write(batch(spark, rows), table, "ts")
        if i >= 2:
            assert store.compact([A, B, C]) == i
            assert store.compact([A, B, C]) == i
            store.drop_compacted(A)
    for table in (A, B, C):
        assert state(store, table) == state(plain, table)
    with pytest.raises(ValueError):
        store.compact([A, B])
    # Two states, the runs of one table at most twice.
    assert len(list((tmp_path / "c" / "default__k" / "state").glob("*.json"))) == 2
    assert len(list((tmp_path / "c" / "default__k" / "runs" / "a").glob("_run*"))) <= 2


def test_packed_rows_and_schema_registry(spark, tmp_path):
    df = spark.sql(
        "SELECT 1 i, 2.5D d, CAST(1.5 AS FLOAT) f, 'ü' s, true b, array(1L, 2L) l, X'00ff' bin, "
        "timestamp'2021-01-01 00:00:00.123456' t, CAST(NULL AS INT) n"
    )
    packed = df.select(online.pack_row(df, df.columns).alias("p"))
    back = packed.select(online.unpack_row(F.col("p"), df.schema).alias("r")).select("r.*")
    assert back.first() == df.first()
    other = df.drop("n").schema
    assert packed.select(online.unpack_row(F.col("p"), other)).first()[0] is None
    assert bytes(packed.first()[0])[:4] == online.schema_reference(df.schema)
    path = str(tmp_path / "schemas")
    assert read_schemas(spark, path).count() == 0
    for schema in (df.schema, other, df.schema):
        register_schema(spark, path, schema)
    assert read_schemas(spark, path).count() == 2


def test_latest_per_key(spark):
    df = batch(spark, [("k", 1, 1, 1), ("k", 3, 2, None), ("k", 3, 2, 1), ("j", 1, None, None)])
    latest = online.latest_per_key(df, ["k"], "ts")
    assert latest.columns == df.columns
    assert rows_of(latest, "k", "at", "x", "y") == [("j", 1, None, None), ("k", 3, 2, 1)]
    first = online.latest_per_key(df.withColumn("y", -F.col("y")), ["k"], "ts", ["y"])
    assert rows_of(first, "k", "y") == [("j", None), ("k", -1)]


EVENT = st.tuples(
    st.sampled_from(["a", "b", "c"]),
    st.lists(
        st.tuples(
            st.sampled_from(["k", "j"]),
            st.integers(0, 6),
            st.integers(0, 3) | st.none(),
            st.integers(0, 3) | st.none(),
        ),
        min_size=1,
        max_size=4,
    ),
)


def sequential_model(steps):
    tables = {"a": 100, "b": 10, "c": None}
    rows, expiry = {}, {}
    for name, events in steps:
        latest = {}
        for key, at, x, y in events:
            rank = (at, -1 if x is None else x, -1 if y is None else y)
            if key not in latest or rank > latest[key][0]:
                latest[key] = (rank, at, x, y)
        for key, (_, at, x, y) in latest.items():
            stored = rows.get((name, key))
            if stored and stored[2] > at:
                continue
            old_x, old_y = stored[:2] if stored else (None, None)
            rows[name, key] = (old_x if x is None else x, old_y if y is None else y, at)
            age = tables[name]
            if age is None:
                expiry[key] = None
            else:
                known = expiry.get(key)
                expiry[key] = at + age if known is None else max(known, at + age)
    return {
        name: sorted(((k, *rows[n, k], expiry[k]) for n, k in rows if n == name), key=repr)
        for name in tables
    }


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(EVENT, min_size=1, max_size=5))
def test_log_against_sequential_model(spark, steps):
    tables = {"a": A, "b": B, "c": C}
    parts = {}
    for seq, (name, rows) in enumerate(steps):
        part = online.log_rows(batch(spark, rows), tables[name], "ts", seq)
        parts.setdefault(name, []).append(part)
    logs = {name: union_rows(frames, ["k"]) for name, frames in parts.items()}
    expiry = online.fold_expiry(list(logs.values()), ["k"])
    want = sequential_model(steps)
    for name, log in logs.items():
        folded = online.fold_table(log, tables[name]).join(expiry, "k")
        got = rows_of(
            folded.select(
                "k", "x", "y", F.unix_seconds("event_timestamp").alias("t"), F.unix_seconds("_expiry").alias("e")
            )
        )
        assert got == want[name]


def test_a_compacted_store_opens_anew(spark, tmp_path):
    rows = [("k", 50, 1, None), ("j", 10, 3, 4)]
    store = OnlineStore(spark, str(tmp_path))
    store.write(batch(spark, rows), A, "ts")
    store.compact([A])
    other = OnlineStore(spark.newSession(), str(tmp_path))
    assert state(other, A) == state(store, A)
    other.write(batch(spark, [("k", 60, None, 7)]), A, "ts")
    assert state(OnlineStore(spark, str(tmp_path)), A) == [("j", 3, 4, 10, 110), ("k", 1, 7, 60, 160)]


def test_writes_compact_by_themselves(spark, tmp_path):
    store = OnlineStore(spark, str(tmp_path / "c"), compact_every=2, buckets=2)
    plain = OnlineStore(spark, str(tmp_path / "p"), compact_every=None)
    for i, table in enumerate([A, B, A, A, B, C, A]):
        rows = [("k", 50 + 7 * i, i, None if i % 2 else i), (f"k{i % 2}", 40 - i, i, i)]
        store.write(batch(spark, rows), table, "ts", tag=f"t{i}")
        plain.write(batch(spark, rows), table, "ts", tag=f"t{i}")
    for table in (A, B, C):
        assert state(store, table) == state(plain, table)
    assert not store.write(batch(spark, [("k", 999, 9, 9)]), A, "ts", tag="t6")
    assert len(list((tmp_path / "c" / "default__k" / "state").glob("*.json"))) == 2
    left = sum(len(list(d.iterdir())) for d in (tmp_path / "c" / "default__k" / "log").iterdir())
    assert left < 6


def test_a_late_batch_of_another_writer_is_not_lost(spark, tmp_path):
    """It took its number before a compaction that does not know of it."""
    slow, quick = OnlineStore(spark, str(tmp_path), buckets=2), OnlineStore(spark, str(tmp_path))
    slow.write(batch(spark, [("a", 1, 1, 1)]), A, "ts")
    seen = slow._snapshot(slow._space(A))
    quick.write(batch(spark, [("k", 50, 1, 2)]), A, "ts", tag="quick")
    quick.compact([A])
    slow._snapshot = lambda space: seen
    slow.write(batch(spark, [("k", 60, 3, None)]), A, "ts", tag="slow")
    want = [("a", 1, 1, 1, 101), ("k", 3, 2, 60, 160)]
    assert state(OnlineStore(spark, str(tmp_path)), A) == want
    quick.compact([A])
    assert state(OnlineStore(spark, str(tmp_path)), A) == want


def test_runs_of_any_stretches_give_the_state_of_all_batches(spark, tmp_path):
    """Tiers, partial merges within a small allowance, a full compaction: the state is the model's."""
    rng = random.Random(3)
    steps = []
    for _ in range(10):
        rows = [
            (rng.choice("kjih"), rng.randrange(30), rng.choice([None, 1, 2, 3]), rng.choice([None, 4, 5]))
            for _ in range(5)
        ]
        steps.append((rng.choice("abc"), rows))
    store = OnlineStore(spark, str(tmp_path), compact_every=2, buckets=2, rewrite_factor=3)
    tables = {"a": A, "b": B, "c": C}
    for i, (name, rows) in enumerate(steps):
        store.write(batch(spark, rows), tables[name], "ts")
        if i in (5, 9):
            want = sequential_model(steps[: i + 1])
            for n, table in tables.items():
                assert state(store, table) == want[n]
    snap = store._snapshot(store._space(A))
    assert max(r["tier"] for n in "abc" for r in snap.runs(n)) > 1
    store.compact([A, B, C])
    for n, table in tables.items():
        assert state(OnlineStore(spark, str(tmp_path)), table) == want[n]


def test_a_write_rewrites_no_more_than_its_allowance(spark, tmp_path):
    store = OnlineStore(spark, str(tmp_path), compact_every=2, buckets=2, rewrite_factor=4)
    space = store._space(A)
    written, rewritten, rng = 0, 0, random.Random(1)
    for i in range(8):
        rows = [(f"{i}-{rng.random()}", i, rng.randrange(10**9), n) for n in range(3_000)]
        store.write(batch(spark, rows), A, "ts")
        snap = store._snapshot(space)
        written += store._files.size(max(snap.complete["a"])[-1])
        if not snap.newer("a"):
            version = f"{snap.state['version']:08d}"
            rewritten += sum(sum(r["sizes"].values()) for r in snap.runs("a") if r["id"].startswith(version) and r["tier"] > 1)
    assert written / 2 < rewritten <= 4 * written
    assert store.read(A).count() == 24_000
    # The number of runs follows the logarithm of the number of batches.
    assert all(sum(b in r["sizes"] for r in snap.runs("a")) <= 3 for b in "01")
    # Without an allowance nothing but new batches is written.
    frugal = OnlineStore(spark, str(tmp_path / "f"), compact_every=2, buckets=2, rewrite_factor=0)
    for i in range(6):
        frugal.write(batch(spark, [("k", i, i, i)]), A, "ts")
    assert [r["tier"] for r in frugal._snapshot(frugal._space(A)).runs("a")] == [1, 1, 1]
    assert state(frugal, A) == [("k", 5, 5, 5, 105)]


def scanned_buckets(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line and BUCKET in line]


def test_lookups_read_the_buckets_of_their_keys(spark, tmp_path):
    store = OnlineStore(spark, str(tmp_path), buckets=16)
    store.write(batch(spark, [(f"k{i}", 50, i, i) for i in range(200)]), A, "ts")
    store.compact([A])
    requests = spark.createDataFrame([("k7",), ("k7",), (None,), ("none",)], "k string")
    found = store.get(requests, [A], F.timestamp_seconds(F.lit(60)))
    assert rows_of(found, "k", "a__x") == [("k7", 7), ("k7", 7), ("none", None), (None, None)]
    scans = scanned_buckets(found)
    assert scans and all("PartitionFilters: [" in s and f"{BUCKET}" in s.split("PartitionFilters")[1] for s in scans)
    assert all("In(k, [k7,none])" in s for s in scans)
    space, snap = store._space(A), store._snapshot(store._space(A))
    buckets = {r[0] for r in requests.dropna().select(F.pmod(F.xxhash64("k"), F.lit(16)).cast("int")).distinct().collect()}
    some = store._stored(space, snap, A, snap.runs("a"), buckets)
    assert {r[0] for r in some.select(BUCKET).distinct().collect()} <= buckets
    # More keys than are pushed down one by one are still confined to their buckets.
    many = OnlineStore(spark, str(tmp_path), point_keys=1).get(requests, [A], F.timestamp_seconds(F.lit(60)))
    assert rows_of(many, "k", "a__x") == rows_of(found, "k", "a__x")
    assert all("In(k" not in s and BUCKET in s.split("PartitionFilters")[1] for s in scanned_buckets(many))


def test_removed_keys_stay_removed(spark, tmp_path):
    """Keys past their shared expiry go from all tables; what was under way does not revive them."""
    store = OnlineStore(spark, str(tmp_path), buckets=4)
    store.write(batch(spark, [("k", 50, 1, 1), ("j", 10, 1, 1), ("live", 500, 1, 1)]), A, "ts")
    store.write(batch(spark, [("k", 60, 2, 2), ("kept", 1, 3, 3)]), B, "ts")
    store.write(batch(spark, [("kept", 2, 4, 4)]), C, "ts")
    now = F.timestamp_seconds(F.lit(300))
    store.remove_expired([A, B, C], now)
    assert state(store, A) == [("live", 1, 1, 500, 600)]
    assert state(store, B) == [("kept", 3, 3, 1, None)] and state(store, C) == [("kept", 4, 4, 2, None)]
    # A refused older row stays refused, a row as old as the mark or newer starts anew.
    store.write(batch(spark, [("k", 49, 9, 9), ("j", 10, None, 8)]), A, "ts")
    assert state(store, A) == [("j", None, 8, 10, 110), ("live", 1, 1, 500, 600)]
    store.write(batch(spark, [("k", 400, 7, None)]), A, "ts")
    store.compact([A, B, C])
    assert state(store, A) == [("j", None, 8, 10, 110), ("k", 7, None, 400, 500), ("live", 1, 1, 500, 600)]
    requests = spark.createDataFrame([("k",), ("j",)], "k string")
    found = store.get(requests, [A], F.timestamp_seconds(F.lit(450)), with_status=True)
    assert rows_of(found, "k", "a__x", "a__status") == [("j", None, "OUTSIDE_MAX_AGE"), ("k", 7, "PRESENT")]
    store.remove_expired([A, B, C], F.timestamp_seconds(F.lit(10_000)), keep_marks=100)
    space = store._space(A)
    assert store._stored(space, store._snapshot(space), A, store._snapshot(space).runs("a")).count() == 0
    store.write(batch(spark, [("k", 1, 5, 5)]), A, "ts")
    assert state(store, A)[0][:4] == ("k", 5, 5, 1)


def test_removed_rows_of_the_row_layout(spark, tmp_path):
    store = OnlineStore(spark, str(tmp_path), layout="row", buckets=4)
    store.write(batch(spark, [("k", 50, 1, 1), ("live", 500, 1, 1)]), A, "ts")
    store.write(batch(spark, [("k", 280, 2, 2)]), B, "ts")
    store.remove_expired([A, B], F.timestamp_seconds(F.lit(285)))
    assert state(store, A) == [("live", 1, 1, 500, 600)] and state(store, B) == [("k", 2, 2, 280, 290)]
    store.write(batch(spark, [("k", 40, 9, 9)]), A, "ts")
    store.compact([A, B])
    assert state(store, A) == [("live", 1, 1, 500, 600)]
    store.write(batch(spark, [("k", 51, 9, None)]), A, "ts")
    assert state(store, A) == [("k", 9, None, 51, 151), ("live", 1, 1, 500, 600)]


@pytest.mark.parametrize("layout", ["feature", "row"])
def test_writers_side_by_side(spark, tmp_path, layout):
    """Several stores at one place write and merge at the same time: no batch is lost or counted twice."""

    def work(writer):
        store = OnlineStore(spark, str(tmp_path), layout=layout, compact_every=2, buckets=3)
        for i in range(3):
            rows = [(f"{writer}-{i}", i, writer, i), ("all", 10 * i + writer, writer, i)]
            store.write(batch(spark, rows), A if writer % 2 else B, "ts", tag=f"{writer}-{i}")

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(work, range(3)))
    store = OnlineStore(spark, str(tmp_path), layout=layout)
    for again in range(2):
        rows = {r["k"]: (r["x"], r["y"]) for t in (A, B) for r in store.read(t).filter("k <> 'all'").collect()}
        assert rows == {f"{w}-{i}": (w, i) for w in range(3) for i in range(3)}
        assert state(store, A)[-1][:4] == ("all", 1, 2, 21) and state(store, B)[-1][:4] == ("all", 2, 2, 22)
        store.compact([A, B])


def test_features_added_later_survive_merges(spark, tmp_path):
    store = OnlineStore(spark, str(tmp_path), buckets=2)
    store.write(batch(spark, [("k", 50, 1, 1)]), A, "ts")
    store.compact([A])
    wider = dataclasses.replace(A, features=(*A.features, Field("z", "int32")))
    store.write(batch(spark, [("k", 60, None, 2)]).withColumn("z", F.lit(3)), wider, "ts")
    store.compact([wider])
    df = OnlineStore(spark, str(tmp_path)).read(wider)
    assert rows_of(df, "k", "x", "y", "z") == [("k", 1, 2, 3)]


def test_interrupted_merges_are_swept_away(spark, tmp_path):
    store = OnlineStore(spark, str(tmp_path), buckets=2)
    runs = tmp_path / "default__k" / "runs" / "a"
    for i in range(4):
        store.write(batch(spark, [("k", i, i, i)]), A, "ts")
        store.compact([A])
        if i == 0:
            (runs / "_run=00000002-dead").mkdir()
    assert not (runs / "_run=00000002-dead").exists()
    assert state(store, A) == [("k", 3, 3, 3, 103)]


def test_freshness_without_reading_rows(spark, tmp_path):
    store = OnlineStore(spark, str(tmp_path), buckets=2)
    store.write(batch(spark, [("k", 50, 1, 1), ("j", 70, 1, 1)]), A, "ts")
    store.write(batch(spark, [("k", 60, 1, 1)]), A, "ts")
    store.write(batch(spark, []), C, "ts")
    D = dataclasses.replace(A, name="d")
    for _ in range(2):
        rows = rows_of(stored_freshness(store, [A, C, D], F.timestamp_seconds(F.lit(171))), "feature_table", "passed")
        assert rows == [("a", False), ("c", True), ("d", True)]
        fresh = stored_freshness(store, [A], F.timestamp_seconds(F.lit(170))).select(F.unix_seconds("last_event"), "passed")
        assert fresh.collect() == [(70, True)]
        store.compact([A, C])
    # A writer that ended before it noted its zone costs a reading of its batch.
    store.write(batch(spark, [("k", 90, 1, 1)]), A, "ts")
    zone = max((tmp_path / "default__k" / "log" / "a").glob("*/_zone.json"))
    assert json.loads(zone.read_text()) == {"rows": 1, "first": 90_000_000, "last": 90_000_000}
    for path in (tmp_path / "default__k" / "log" / "a").glob("*/*_zone.json*"):
        path.unlink()
    assert store.last_events([A]) == {"a": 90_000_000}
