"""The latest-value table in shared storage: a log of Parquet batches, merged in tiers.

*Batches.* Writing one costs what the batch costs: it is compacted to one row per key and written to a
directory of its own, which counts once Spark has marked it complete. A batch with a known tag is
written once: a repeated one replaces an incomplete try and is left alone after a complete one.

*Runs.* Every ``compact_every`` batches become a run (:mod:`tidemark.operators.runs`): its rows lie
in ``buckets`` partitions by a hash of the key, sorted by key. As many neighbouring runs of one
tier become one of the next, bucket by bucket. A write may rewrite ``rewrite_factor`` bytes for each byte
that was written; what is not used is saved, and what would cost more waits. So no write folds the
whole table, and a key is in a number of runs that grows with the logarithm of the table. Lookups
read only the buckets of the keys asked for, and for few keys only the row groups that can hold them.

*State.* A numbered file lists, by bucket, the runs that count and the batches in them. It is
written whole and never changed; of two with the same number, one counts and the other's work is lost,
but no batch, as batches are removed only when two states in a row have them in runs.
What neither of the last two states names is swept away, also after a crash.

All feature tables of one project with the same entities share a key space and their expiry.
Several writers may be at work in it: a batch's sequence is a number and, below it, a part of
its tag's hash, so that two batches that took the same number still have one order. A batch that
another writer finishes late comes after the runs that were made without it.
"""

from __future__ import annotations

import json
import math
import uuid
import zlib
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import add_seconds, epoch_micros, short_name
from tidemark.operators.mapping import quoted
from tidemark.operators.online import EXPIRY, LAYOUTS, SEQ, key_space, log_rows, log_schema, look_up
from tidemark.operators.runs import (
    BUCKET,
    GONE,
    as_run,
    bucket_of,
    key_expiry,
    merge_runs,
    run_schema,
    without_expired,
)
from tidemark.operators.unions import union_rows
from tidemark.sinks.files import Folder
from tidemark.spec import EVENT_TS, FeatureTable, Field, SchemaError

TAG_BITS = 24
RUN, PART = "_run", "_part"
ZONE = "_zone.json"
# Tags of the last batches are remembered when the batches themselves are gone.
KNOWN_TAGS = 512


def sequence(number: int, tag: str) -> int:
    return number << TAG_BITS | zlib.crc32(tag.encode()) >> (32 - TAG_BITS)


@dataclass
class _Snapshot:
    """What a key space holds at one moment: its latest state and the batches of each table.

    A batch is (sequence, tag, name of its folder, path)."""

    state: dict = field(default_factory=dict)
    states: list[str] = field(default_factory=list)
    complete: dict[str, list[tuple[int, str, str, str]]] = field(default_factory=dict)
    incomplete: dict[str, list[tuple[int, str, str, str]]] = field(default_factory=dict)

    def runs(self, name: str) -> list[dict]:
        return self.state.get("runs", {}).get(name, [])

    def folded(self, name: str) -> set[str]:
        return set(self.state.get("folded", {}).get(name, []))

    def newer(self, name: str) -> list[tuple[int, str, str, str]]:
        folded = self.folded(name)
        return [batch for batch in self.complete.get(name, []) if batch[2] not in folded]

    def ready(self) -> dict[str, list[tuple[int, str, str, str]]]:
        """Newer batches by table, without those that come after one that is not complete."""
        opened = [seq for batches in self.incomplete.values() for seq, *_ in batches]
        first_open = min(opened, default=None)
        return {
            name: [b for b in self.newer(name) if first_open is None or b[0] < first_open]
            for name in self.complete
        }

    def has_rows(self, name: str) -> bool:
        return bool(self.newer(name)) or bool(self.runs(name))

    def tables(self) -> list[str]:
        return sorted(n for n in {*self.complete, *self.state.get("runs", {})} if self.has_rows(n))

    def last_number(self) -> int:
        lists = [*self.complete.values(), *self.incomplete.values()]
        known = [seq >> TAG_BITS for batches in lists for seq, *_ in batches]
        return max([self.state.get("last", -1), *known])

    def order(self, name: str, batches: Sequence[tuple[int, str, str, str]]) -> dict[int, int]:
        """Sequences of batches that came late to their place behind the runs made without them."""
        top = max([run["hi"] for run in self.runs(name)], default=-1)
        late = sorted(seq for seq, *_ in batches if seq <= top)
        return {seq: top + 1 + i for i, seq in enumerate(late)}


class OnlineStore:
    """``layout="feature"`` merges per feature and shares the expiry of a key between tables;
    ``layout="row"`` replaces whole rows, each table with its own expiry.

    ``compact_every``: batches that become a run, and runs that become one of the next tier (None:
    a write merges nothing). ``buckets``: partitions of a run, fixed by the first write to a key
    space; such that a bucket of the whole table is some gigabytes. A lookup of at most
    ``point_keys`` keys is pushed down to the files by their values.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        layout: str = "feature",
        max_jitter: int = 0,
        compact_every: int | None = 8,
        buckets: int = 16,
        rewrite_factor: int = 8,
        point_keys: int = 256,
    ):
        if layout not in LAYOUTS:
            raise ValueError(f"layout must be one of {LAYOUTS}")
        if compact_every is not None and compact_every < 2:
            raise ValueError("compact_every must be at least 2")
        self.spark, self.root = spark, root.rstrip("/")
        self.layout, self.max_jitter, self.compact_every = layout, max_jitter, compact_every
        self.buckets, self.rewrite_factor, self.point_keys = buckets, rewrite_factor, point_keys
        self._files = Folder(spark, root)
        self._kinds: dict[str, T.DataType] = {}

    # Places

    def _space(self, table: FeatureTable) -> str:
        return f"{self.root}/{short_name('__'.join(key_space(table)), 50)}"

    def _snapshot(self, space: str) -> _Snapshot:
        snap = _Snapshot()
        # The latest state is only swept away once there are newer ones.
        while True:
            snap.states = [n for n in self._files.names(f"{space}/state") if n.endswith(".json")]
            if not snap.states:
                break
            if noted := self._files.read_if_there(f"{space}/state/{snap.states[-1]}"):
                snap.state = json.loads(noted)
                break
        for name in self._files.names(f"{space}/log"):
            snap.complete[name], snap.incomplete[name] = [], []
            folded = snap.folded(name)
            for entry in self._files.names(f"{space}/log/{name}"):
                seq, _, tag = entry.partition("-")
                path = f"{space}/log/{name}/{entry}"
                done = entry in folded or self._files.exists(f"{path}/_SUCCESS")
                (snap.complete if done else snap.incomplete)[name].append((int(seq), tag, entry, path))
        return snap

    def _declare(self, space: str, table: FeatureTable, kind: T.DataType) -> None:
        """Note the table's fields and its time type; fields that are new to it are added."""
        path = f"{space}/tables/{table.name}.json"
        fields = {part: [[f.name, f.type] for f in getattr(table, part)] for part in ("entities", "features")}
        noted = json.loads(self._files.read_text(path)) if self._files.exists(path) else None
        if noted:
            known = {name for name, _ in noted["features"]}
            new = [f for f in fields["features"] if f[0] not in known]
            if not new:
                return
            fields["features"] = noted["features"] + new
            self._files.remove(path)
        self._files.write_text(
            path, json.dumps({"project": table.project, "time": kind.simpleString(), **fields})
        )

    def _declared(self, space: str, name: str) -> FeatureTable:
        noted = json.loads(self._files.read_text(f"{space}/tables/{name}.json"))
        fields = [tuple(Field(*f) for f in noted[part]) for part in ("entities", "features")]
        return FeatureTable(name, *fields, project=noted["project"])

    def _buckets(self, space: str) -> int:
        """The key space's number of buckets, fixed by whoever asks first."""
        path = f"{space}/buckets.json"
        for _ in range(2):
            if not self._files.exists(path):
                self._files.create_text(path, json.dumps(self.buckets))
            if noted := self._files.read_text(path, patience=10.0):
                return json.loads(noted)
            # Its writer broke off.
            self._files.remove(path)
        raise OSError(f"{path} cannot be written")

    # Writing

    def write(
        self,
        df: DataFrame,
        table: FeatureTable,
        event_ts: str,
        tag: str | None = None,
        partitions: int | None = None,
    ) -> bool:
        """Apply a batch of valid rows; False if a batch with this ``tag`` is there already.

        The batch is shuffled once, by key; ``partitions`` fixes into how many parts.
        """
        space, tag = self._space(table), tag or uuid.uuid4().hex
        snap = self._snapshot(space)
        kind = df.schema[event_ts].dataType
        if self._kind(space, snap) not in (None, kind):
            raise SchemaError(
                f"{table.name} has {kind.simpleString()} event times, its key space "
                f"{self._kinds[space].simpleString()}"
            )
        if tag in self._tags(snap, table.name):
            return False
        seq = sequence(snap.last_number() + 1, tag)
        for known, t, *_ in snap.incomplete.get(table.name, []):
            if t == tag:
                seq = known
        self._declare(space, table, kind)
        if partitions:
            df = df.repartition(partitions, *[quoted(k) for k in table.entity_names])
        path = f"{space}/log/{table.name}/{seq:019d}-{tag}"
        rows, zone = self._zoned(log_rows(df, table, event_ts, seq, self.max_jitter, self.layout))
        rows.write.mode("overwrite").parquet(path)
        self._files.write_text(f"{path}/{ZONE}", json.dumps(zone.get))
        if self.compact_every:
            self._tend(space)
        return True

    @staticmethod
    def _tags(snap: _Snapshot, name: str) -> set[str]:
        known = {t for _, t, *_ in snap.complete.get(name, [])}
        return known | {entry.partition("-")[2] for entry in snap.folded(name)}

    @staticmethod
    def _zoned(rows: DataFrame) -> tuple[DataFrame, Observation]:
        """Rows that tell, once written, how many they are and between which event times."""
        us = epoch_micros(F.col(EVENT_TS), rows.schema[EVENT_TS].dataType)
        zone = Observation()
        figures = [F.count(F.lit(1)).alias("rows"), F.min(us).alias("first"), F.max(us).alias("last")]
        return rows.observe(zone, *figures), zone

    def has_batch(self, table: FeatureTable, tag: str) -> bool:
        """Whether a batch with this tag is there, complete."""
        return tag in self._tags(self._snapshot(self._space(table)), table.name)

    # Reading

    def _kind(self, space: str, snap: _Snapshot) -> T.DataType | None:
        """Timestamp type of a key space, None while it is empty."""
        if space not in self._kinds:
            noted = self._files.names(f"{space}/tables")
            noted = [n for n in noted if n.endswith(".json")]
            if not noted:
                return None
            declared = json.loads(self._files.read_text(f"{space}/tables/{noted[0]}"))
            self._kinds[space] = T._parse_datatype_string(declared["time"])
        return self._kinds[space]

    def _batches(
        self, space: str, snap: _Snapshot, table: FeatureTable, batches: Sequence[tuple[int, str, str, str]]
    ) -> DataFrame:
        """Rows of batches, in the columns of a run."""
        schema = log_schema(table, self._kind(space, snap))
        log = self.spark.read.schema(schema).parquet(*[path for *_, path in batches])
        for seq, place in snap.order(table.name, batches).items():
            log = log.withColumn(SEQ, F.when(F.col(SEQ) == seq, F.lit(place)).otherwise(F.col(SEQ)))
        return as_run(log, table, self._buckets(space), self.layout)

    def _stored(
        self, space: str, snap: _Snapshot, table: FeatureTable, runs: Sequence[dict], buckets: set[int] | None = None
    ) -> DataFrame:
        """Rows of runs, of their buckets that count and of those in ``buckets``."""
        schema = run_schema(table, self._kind(space, snap), self.layout)
        folder = f"{space}/runs/{table.name}"
        read = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(RUN, T.StringType())]))
        wanted = F.lit(False)
        paths = []
        for run in runs:
            has = {int(b) for b in run["sizes"]}
            mine = has if buckets is None else has & buckets
            if mine:
                whole = len(mine) == run["buckets"]
                inside = F.lit(True) if whole else F.col(BUCKET).isin(sorted(mine))
                wanted = wanted | ((F.col(RUN) == run["id"]) & inside)
                paths.append(f"{folder}/{RUN}={run['id']}")
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = read.option("basePath", folder).parquet(*paths).filter(wanted)
        return rows.select(*[quoted(c) for c in schema.names])

    def _rows(
        self,
        space: str,
        snap: _Snapshot,
        table: FeatureTable,
        asked: _Asked | None = None,
    ) -> DataFrame:
        """All rows of a table that count, or those that may have the keys asked for."""
        batches, runs = snap.newer(table.name), snap.runs(table.name)
        parts = []
        if runs:
            parts.append(self._stored(space, snap, table, runs, asked and asked.buckets))
        if batches:
            parts.append(self._batches(space, snap, table, batches))
        if asked is not None:
            parts = [asked.among(part) for part in parts]
        return union_rows(parts)

    def _merged(
        self, space: str, snap: _Snapshot, table: FeatureTable, asked: _Asked | None = None
    ) -> DataFrame:
        return merge_runs(self._rows(space, snap, table, asked), table, self.layout)

    def _expiry(self, snap: _Snapshot, table: FeatureTable, asked: _Asked | None = None) -> DataFrame:
        """Shared expiry of a table's keys, by the marks of all tables."""
        space = self._space(table)
        bare = [replace(self._declared(space, name), features=()) for name in snap.tables()]
        return key_expiry([self._merged(space, snap, t, asked) for t in bare], table.entity_names)

    def _state(
        self,
        snap: _Snapshot,
        table: FeatureTable,
        kind: T.DataType | None = None,
        asked: _Asked | None = None,
    ) -> DataFrame:
        """State of a table; with the ``"feature"`` layout without expiry."""
        space = self._space(table)
        rest = [] if self.layout == "feature" else [EXPIRY]
        columns = [*table.entity_names, *table.feature_names, EVENT_TS, *rest]
        if not snap.has_rows(table.name):
            return self.spark.createDataFrame([], log_schema(table, kind or T.TimestampNTZType())).select(
                *[quoted(c) for c in columns]
            )
        return self._merged(space, snap, table, asked).filter(~F.col(GONE)).select(*[quoted(c) for c in columns])

    def read(self, table: FeatureTable, kind: T.DataType | None = None) -> DataFrame:
        """State of a table: keys, features, ``event_timestamp``, ``_expiry``.

        ``kind`` is the timestamp type of a table that has no rows yet.
        """
        space = self._space(table)
        snap = self._snapshot(space)
        state = self._state(snap, table, kind)
        if self.layout == "feature":
            if snap.has_rows(table.name):
                expiry = self._expiry(snap, table)
                state = state.join(expiry, on=table.entity_names, how="left")
            else:
                state = state.withColumn(EXPIRY, F.lit(None).cast(state.schema[EVENT_TS].dataType))
        names = [*table.entity_names, *table.feature_names, EVENT_TS, EXPIRY]
        return state.select(*[quoted(n) for n in names])

    def get(
        self,
        requests: DataFrame,
        tables: Sequence[FeatureTable],
        now: Column,
        with_status: bool = False,
    ) -> DataFrame:
        """Latest features for request rows, see :func:`tidemark.operators.online.look_up`.

        Only the buckets of the requested keys are read, and only rows of those keys folded. The
        requests are read beforehand for that. Each key space is seen at one moment.
        """
        kind = requests.select(now.alias("now")).schema["now"].dataType
        spaces, states, expiry = {}, [], {}
        for table in tables:
            key, space = key_space(table), self._space(table)
            if key not in spaces:
                snap = self._snapshot(space)
                asked = _Asked(requests, key[1:], self._buckets(space), self.point_keys)
                spaces[key] = snap, asked
                if self.layout == "feature" and snap.tables():
                    expiry[key] = self._expiry(snap, table, asked)
            snap, asked = spaces[key]
            state = self._state(snap, table, kind, asked)
            if self.layout == "feature" and key not in expiry:
                state = state.withColumn(EXPIRY, F.lit(None).cast(kind))
            states.append(state)
        return look_up(requests, states, tables, now, with_status, expiry)

    def last_events(self, tables: Sequence[FeatureTable]) -> dict[str, int | None]:
        """Microseconds of each table's latest event time, from the batches' and runs' zones: no
        row is read, but for batches whose writer ended before it noted the zone."""
        found = {}
        for table in tables:
            space = self._space(table)
            snap = self._snapshot(space)
            last = [run["last"] for run in snap.runs(table.name)]
            for batch in snap.newer(table.name):
                last.append(self._zone(space, snap, table, batch)["last"])
            found[table.name] = max([x for x in last if x is not None], default=None)
        return found

    def _zone(self, space: str, snap: _Snapshot, table: FeatureTable, batch: tuple[int, str, str, str]) -> dict:
        path = f"{batch[3]}/{ZONE}"
        if self._files.exists(path):
            return json.loads(self._files.read_text(path))
        rows, zone = self._zoned(self.spark.read.schema(log_schema(table, self._kind(space, snap))).parquet(batch[3]))
        rows.write.format("noop").mode("overwrite").save()
        return zone.get

    # Maintenance

    def _write_run(
        self, space: str, version: int, table: FeatureTable, rows: DataFrame, hi: int, tier: int, last: int | None
    ) -> dict:
        """Merge ``rows`` into one run; its entry in the state. One shuffle, by bucket and key."""
        keys = [quoted(k) for k in table.entity_names]
        parts = max(1, math.ceil(int(self.spark.conf.get("spark.sql.shuffle.partitions")) / self._buckets(space)))
        placed = rows.withColumn(PART, F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(parts))).repartition(BUCKET, PART)
        merged = merge_runs(placed, table, self.layout, [BUCKET, PART]).drop(PART)
        name = f"{version:08d}-{uuid.uuid4().hex[:8]}"
        path = f"{space}/runs/{table.name}/{RUN}={name}"
        merged.sortWithinPartitions(BUCKET, *keys).write.partitionBy(BUCKET).parquet(path)
        sizes = {
            entry.partition("=")[2]: self._files.size(f"{path}/{entry}")
            for entry in self._files.names(path)
            if entry.startswith(f"{BUCKET}=")
        }
        return {"id": name, "hi": hi, "tier": tier, "last": last, "buckets": len(sizes), "sizes": sizes}

    @staticmethod
    def _replace(state: dict, name: str, used: Sequence[dict], made: dict, buckets: set[str] | None = None) -> None:
        """``made`` in the place of ``used``, wholly or in some buckets."""
        for run in used:
            run["sizes"] = {b: n for b, n in run["sizes"].items() if buckets is not None and b not in buckets}
        runs = state["runs"].setdefault(name, [])
        state["runs"][name] = sorted([r for r in [*runs, made] if r["sizes"]], key=lambda r: r["hi"])

    def _next(self, snap: _Snapshot) -> dict:
        state = json.loads(json.dumps(snap.state or {"version": 0, "last": -1, "credit": 0, "runs": {}, "folded": {}}))
        state["version"] += 1
        state["last"] = snap.last_number()
        return state

    @staticmethod
    def _note(snap: _Snapshot, state: dict, name: str, batches: Sequence[tuple[int, str, str, str]]) -> None:
        """Batches that are in runs now, beside those that were; the oldest are forgotten with their files."""
        here = {entry for *_, entry, _ in snap.complete.get(name, [])}
        folded = [*state["folded"].get(name, []), *[entry for *_, entry, _ in batches]]
        recent = set(folded[-KNOWN_TAGS:])
        state["folded"][name] = [e for e in folded if e in here or e in recent]

    def _fold(self, space: str, snap: _Snapshot, state: dict) -> int:
        """All batches that are ready become a run of the first tier per table; their bytes."""
        written = 0
        for name, batches in snap.ready().items():
            if not batches:
                continue
            table = self._declared(space, name)
            hi = max(snap.order(name, batches).get(seq, seq) for seq, *_ in batches)
            zones = [self._zone(space, snap, table, b)["last"] for b in batches]
            last = max([z for z in zones if z is not None], default=None)
            rows = self._batches(space, snap, table, batches)
            run = self._write_run(space, state["version"], table, rows, hi, 1, last)
            self._replace(state, name, [], run)
            self._note(snap, state, name, batches)
            written += sum(self._files.size(path) for *_, path in batches)
        return written

    def _mergeable(self, state: dict) -> dict[tuple, list[str]]:
        """(tier, table, ids of neighbouring runs of that tier) to the buckets that have them all."""
        found: dict[tuple, list[str]] = {}
        for name, runs in state["runs"].items():
            for bucket in sorted({b for run in runs for b in run["sizes"]}, key=int):
                mine = [run for run in runs if bucket in run["sizes"]]
                stretches, i = [], 0
                while i < len(mine):
                    j = i
                    while j < len(mine) and mine[j]["tier"] == mine[i]["tier"]:
                        j += 1
                    if j - i >= self.compact_every:
                        stretches.append((mine[i]["tier"], name, tuple(run["id"] for run in mine[i:j])))
                    i = j
                if stretches:
                    found.setdefault(min(stretches), []).append(bucket)
        return found

    def _tend(self, space: str) -> None:
        """Merge what is due, as far as the bytes written so far allow."""
        snap = self._snapshot(space)
        if sum(map(len, snap.ready().values())) < self.compact_every:
            return
        state = self._next(snap)
        state["credit"] += self.rewrite_factor * self._fold(space, snap, state)
        for (tier, name, ids), buckets in sorted(self._mergeable(state).items()):
            used = [run for run in state["runs"][name] if run["id"] in ids]
            chosen = []
            for bucket in buckets:
                cost = sum(run["sizes"][bucket] for run in used)
                if cost <= state["credit"]:
                    state["credit"] -= cost
                    chosen.append(bucket)
            if chosen:
                table = self._declared(space, name)
                rows = self._stored(space, snap, table, used, {int(b) for b in chosen})
                last = max([run["last"] for run in used if run["last"] is not None], default=None)
                made = self._write_run(space, state["version"], table, rows, used[-1]["hi"], tier + 1, last)
                self._replace(state, name, used, made, set(chosen))
        self._publish(space, state)

    def _publish(self, space: str, state: dict) -> None:
        name = f"{state['version']:08d}-{uuid.uuid4().hex[:8]}.json"
        self._files.write_text(f"{space}/state/{name}", json.dumps(state))
        self._sweep(space)

    def compact(self, tables: Sequence[FeatureTable] | None = None) -> int:
        """Merge all batches and runs of one key space to one run per table; the number of the
        last batch in it.

        ``tables``: all of the key space. Batches that are not complete, and all after them,
        stay in the log.
        """
        return self._compact(self._whole_space(tables))

    def _whole_space(self, tables: Sequence[FeatureTable] | None) -> str:
        if not tables:
            raise ValueError("compact takes the tables of one key space")
        space = self._space(tables[0])
        snap = self._snapshot(space)
        known = {*snap.complete, *snap.state.get("runs", {})}
        if any(self._space(t) != space for t in tables) or {t.name for t in tables} != known:
            raise ValueError("compact takes exactly the tables of one key space")
        return space

    def _compact(self, space: str) -> int:
        snap = self._snapshot(space)
        state = self._next(snap)
        ready = snap.ready()
        left = [b[0] >> TAG_BITS for name in ready for b in snap.newer(name) if b not in ready[name]]
        opened = [b[0] >> TAG_BITS for batches in snap.incomplete.values() for b in batches]
        if left or opened:
            state["last"] = min(state["last"], min([*left, *opened]) - 1)
        changed = False
        for name in sorted({*ready, *state["runs"]}):
            runs, batches = state["runs"].get(name, []), ready.get(name, [])
            single = len(runs) <= 1 or len({b for r in runs for b in r["sizes"]}) == sum(len(r["sizes"]) for r in runs)
            if not batches and single:
                continue
            changed = True
            table = self._declared(space, name)
            parts = [self._stored(space, snap, table, runs)] if runs else []
            if batches:
                parts.append(self._batches(space, snap, table, batches))
            order = snap.order(name, batches)
            hi = max([*[r["hi"] for r in runs], *[order.get(b[0], b[0]) for b in batches]])
            ends = [r["last"] for r in runs] + [self._zone(space, snap, table, b)["last"] for b in batches]
            tier = max([r["tier"] for r in runs], default=0) + bool(batches or len(runs) > 1)
            made = self._write_run(
                space, state["version"], table, union_rows(parts), hi, tier, max([e for e in ends if e is not None], default=None)
            )
            self._replace(state, name, runs, made)
            self._note(snap, state, name, batches)
        if changed:
            self._publish(space, state)
        return state["last"]

    def remove_expired(
        self, tables: Sequence[FeatureTable], now: Column, keep_marks: int | None = None
    ) -> None:
        """Compact, and remove what has expired at ``now``: keys from all tables of the key space
        by their shared expiry, with ``layout="row"`` the rows of each table by their own.

        Of a removed row its key and event time stay as a mark, so that an older row that is still
        under way is refused as before; a newer one starts anew. Marks are dropped once their event time is
        ``keep_marks`` seconds before ``now`` (None: never). Only buckets with something to remove
        are written anew.
        """
        space = self._whole_space(tables)
        self._compact(space)
        snap = self._snapshot(space)
        state, changed = self._next(snap), False
        keys = [quoted(k) for k in tables[0].entity_names]
        since = None if keep_marks is None else add_seconds(now, -keep_marks)
        expired = None
        if self.layout == "feature":
            bare = [replace(self._declared(space, n), features=()) for n in snap.state.get("runs", {})]
            stored = [self._stored(space, snap, t, snap.runs(t.name)) for t in bare]
            expired = key_expiry(stored, tables[0].entity_names).filter(F.col(EXPIRY) <= now)
            expired = expired.select(*keys, F.lit(True).alias("_tm_expired"))
        for name, runs in list(state["runs"].items()):
            table = self._declared(space, name)

            def flagged(rows: DataFrame) -> DataFrame:
                if expired is None:
                    return rows.withColumn("_tm_expired", F.col(EXPIRY) <= now)
                return rows.join(expired, on=table.entity_names, how="left")

            rows = flagged(self._stored(space, snap, replace(table, features=()), runs))
            due = F.coalesce(F.col("_tm_expired"), F.lit(False)) & ~F.col(GONE)
            if since is not None:
                due = due | (F.col(GONE) & (F.col(EVENT_TS) < since))
            found = {str(r[0]) for r in rows.filter(due).select(BUCKET).distinct().collect()}  # at most all buckets
            if not found:
                continue
            changed = True
            rows = flagged(self._stored(space, snap, table, runs, {int(b) for b in found}))
            cut = without_expired(rows, table, self.layout, F.col("_tm_expired"), since).drop("_tm_expired")
            hi, tier = max(r["hi"] for r in runs), max(r["tier"] for r in runs)
            ends = [r["last"] for r in runs if r["last"] is not None]
            made = self._write_run(space, state["version"], table, cut, hi, tier, max(ends, default=None))
            self._replace(state, name, runs, made, found)
        if changed:
            self._publish(space, state)

    def drop_compacted(self, table: FeatureTable) -> None:
        """Remove batches and runs that the last two states do not need; writes do so themselves."""
        self._sweep(self._space(table))

    def _sweep(self, space: str) -> None:
        snap = self._snapshot(space)
        versions = sorted({name.partition("-")[0] for name in snap.states})
        if len(versions) < 2:
            return
        kept = [n for n in snap.states if n.partition("-")[0] in versions[-2:]]
        noted = [self._files.read_if_there(f"{space}/state/{n}") for n in kept]
        if not all(noted):
            return  # another writer is sweeping
        states = [json.loads(text) for text in noted]
        for name, batches in snap.complete.items():
            covered = set.intersection(*[set(s["folded"].get(name, [])) for s in states])
            for *_, entry, path in batches:
                if entry in covered:
                    self._files.remove(path)
        # A run bears the number of the state it was made for: older ones cannot come to count.
        for name in self._files.names(f"{space}/runs"):
            used = {f"{RUN}={run['id']}" for s in states for run in s["runs"].get(name, [])}
            for entry in self._files.names(f"{space}/runs/{name}"):
                if entry not in used and entry.partition("=")[2].partition("-")[0] < versions[-2]:
                    self._files.remove(f"{space}/runs/{name}/{entry}")
        for name in snap.states:
            if name not in kept:
                self._files.remove(f"{space}/state/{name}")


class _Asked:
    """The keys of a lookup: which buckets they are in, and the keys themselves where they are few."""

    def __init__(self, requests: DataFrame, keys: Sequence[str], buckets: int, point_keys: int):
        self.keys = list(keys)
        self.wanted = requests.select(*[quoted(k) for k in keys]).distinct()
        numbered = self.wanted.select("*", bucket_of(keys, buckets).alias(BUCKET))
        few = numbered.limit(point_keys + 1).collect()
        self.points = few if len(few) <= point_keys else None
        if self.points is None:
            few = numbered.select(BUCKET).distinct().collect()  # at most all buckets
        self.buckets = {row[BUCKET] for row in few}

    def among(self, rows: DataFrame) -> DataFrame:
        """Rows of the keys asked for."""
        if self.points is not None:
            for k in self.keys:
                values = {row[k] for row in self.points if row[k] is not None}
                rows = rows.filter(quoted(k).isin(sorted(values)) if values else F.lit(False))
        return rows.join(self.wanted, on=self.keys, how="left_semi")
