"""Feature history kept by period, with the latest row of each key for stretches of periods.

Level ``ROWS`` holds all rows, by the period of their event time; level 0 the latest row per key
of a period, and level n that of ``fanout**n`` periods. A join reads the rows of the spine's own
periods and, for the time between them, the few blocks that cover it: each key's latest row of a
stretch is all that a later spine row can match. Rows keep their event times, so blocks, rows and
repeated rows mix freely and the plain as-of join over them is exact.

Batches only add directories; a batch counts once its marker is there, and a tag counts once.
``roll_up`` writes the blocks whose time is over, or in which late rows arrived, and a manifest that names
them and the batches they hold; what later batches add to a block is read from those batches.
Manifests are complete by themselves, so roll-ups side by side lose nothing: one of them counts.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_left
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import all_not_null, epoch_micros
from tidemark.operators.asof import candidate
from tidemark.operators.mapping import feature_projection, map_fields, quoted
from tidemark.operators.unions import union_rows
from tidemark.sinks.files import Folder
from tidemark.sources.batch import read_source
from tidemark.spec import CREATED_TS, EVENT_TS, FeatureTable, FrameSource, Source

ROWS = -1
_EVER = -(1 << 62)
_PART, _LEVEL, _BLOCK = "_tm_part", "_tm_level", "_tm_block"


def _block_of(us: Column, width: int) -> Column:
    """Number of the stretch of ``width`` microseconds, rounded down also before 1970."""
    start = us - F.pmod(us, F.lit(width))
    return F.call_function("div", start, F.lit(width).cast("long")).alias(_BLOCK)


class FeatureHistory:
    """History of one feature table at ``path``.

    ``period_seconds``, ``fanout`` and ``levels`` are fixed by the first writer. Rows without a key
    or an event time match nothing and are left out. Without any batch, no spine row has a match.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        table: FeatureTable,
        period_seconds: int = 86_400,
        fanout: int = 8,
        levels: int = 4,
    ):
        if period_seconds <= 0 or fanout < 2 or levels < 0:
            raise ValueError("a period needs a length, a block two periods, and levels a number")
        self.spark, self.table, self.path = spark, table, path.rstrip("/")
        self.files = Folder(spark, path)
        wanted = {"period": period_seconds * 1_000_000, "fanout": fanout, "levels": levels}
        if not self.files.create_text(f"{self.path}/layout.json", json.dumps(wanted)):
            found = json.loads(self.files.read_text(f"{self.path}/layout.json", patience=5))
            if found != wanted:
                raise ValueError(f"the history at {self.path} has another layout: {found}")
        self.period, self.fanout, self.levels = wanted["period"], fanout, levels

    # Writing

    def _part(self, name: str) -> str:
        return f"{self.path}/parts/{_PART}={name}"

    def _columns(self) -> list[str]:
        names = [*self.table.feature_names, *self.table.entity_names, EVENT_TS, CREATED_TS]
        tie = self.table.tiebreak
        return [*names, tie] if tie and tie not in names else names

    def _latest(self, rows: DataFrame) -> DataFrame:
        """The latest row of each key and block, reduced before it is shuffled."""
        place = [*self.table.entity_names, _LEVEL, _BLOCK]
        best = rows.groupBy(*[quoted(c) for c in place]).agg(F.max(candidate(self.table)).alias("_tm_best"))
        fields = {EVENT_TS: "at", CREATED_TS: "created"}
        if self.table.tiebreak:
            fields.setdefault(self.table.tiebreak, "tie")
        values = set(self.table.feature_names)
        return best.select(
            *[
                quoted(c)
                if c in self.table.entity_names
                else (F.col("_tm_best")["v"][c] if c in values else F.col("_tm_best")[fields[c]]).alias(c)
                for c in self._columns()
            ],
            _LEVEL,
            _BLOCK,
        )

    def _write(self, rows: DataFrame, name: str) -> None:
        # Few files per block, and no task with a whole large one.
        rows = rows.hint("rebalance", F.col(_LEVEL), F.col(_BLOCK))
        write = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        write.partitionBy(_LEVEL, _BLOCK).parquet(self._part(name))

    def append(self, features: Source | DataFrame, tag: str) -> bool:
        """Add rows, late ones too; False if ``tag`` is there already. A frame has the columns of
        a feature projection. It is read twice and should give the same rows each time."""
        if not tag.replace("-", "").isalnum() or tag.startswith("roll-"):
            raise ValueError(f"a tag has letters, digits and dashes, not {tag!r}")
        marker = f"{self.path}/batches/{tag}"
        if self.files.exists(marker):
            return False
        if isinstance(features, Source):
            mapped = map_fields(read_source(self.spark, features), features.field_mapping)
            features = feature_projection(mapped, self.table, features)
        usable = all_not_null([quoted(c) for c in [*self.table.entity_names, EVENT_TS]])
        us = epoch_micros(quoted(EVENT_TS), features.schema[EVENT_TS].dataType)
        rows = features.filter(usable).select(
            *[quoted(c) for c in self._columns()], F.lit(ROWS).alias(_LEVEL), _block_of(us, self.period)
        )
        latest = self._latest(rows.withColumn(_LEVEL, F.lit(0)))
        self._write(union_rows([rows, latest]), tag)
        self.files.create_text(f"{self.path}/schema.json", features.select(*self._columns()).schema.json())
        names = self.files.names(f"{self._part(tag)}/{_LEVEL}=0")
        periods = sorted(int(n.partition("=")[2]) for n in names if n.startswith(_BLOCK))
        self.files.write_text(marker, json.dumps(periods))
        return True

    def roll_up(self) -> int:
        """Write the blocks that are due; how many."""
        batches, (covered, blocks) = self._batches(), self._manifest()
        stored = sorted({p for periods in batches.values() for p in periods})
        late = {p for tag, periods in batches.items() if tag not in covered for p in periods}
        if not late:
            return 0
        written, schema = 0, self._schema()
        for level in range(1, self.levels + 1):
            width = self.fanout**level
            over = {p // width for p in stored if (p // width + 1) * width <= stored[-1]}
            moved = {p // width for p in late}
            due = sorted(b for b in over if b in moved or (level, b) not in blocks)
            if not due:
                continue
            below = [c for b in due for c in range(b * self.fanout, (b + 1) * self.fanout)]
            if level == 1:
                source = self._scan(schema, {(tag, 0): below for tag in batches})
            else:
                places: dict[tuple[str, int], list[int]] = {}
                for block in below:
                    if (level - 1, block) in blocks:
                        places.setdefault((blocks[level - 1, block], level - 1), []).append(block)
                source = self._scan(schema, places)
            name = f"roll-{level}-{uuid.uuid4().hex}"
            up = _block_of(F.col(_BLOCK), self.fanout)
            self._write(self._latest(source.withColumns({_LEVEL: F.lit(level), _BLOCK: up})), name)
            blocks |= {(level, b): name for b in due}
            written += len(due)
        text = json.dumps({"batches": sorted(batches), "blocks": [[*k, v] for k, v in sorted(blocks.items())]})
        last = max([0, *[int(n.partition("-")[0]) for n in self._manifests()]])
        self.files.write_text(f"{self.path}/manifests/{last + 1:08}-{uuid.uuid4().hex}", text)
        return written

    def sweep(self, keep: int = 2) -> list[str]:
        """Remove all but the last ``keep`` manifests and the blocks that only those named; their
        parts. Readers that began more than ``keep`` roll-ups ago would miss them."""
        if keep < 1:
            raise ValueError("the last manifest has to stay")
        names = self._manifests()
        held = {p for n in names[-keep:] for p in self._manifest(n)[1].values()}
        old = {p for n in names[:-keep] for p in self._manifest(n)[1].values()} - held
        for name in names[:-keep]:
            self.files.remove(f"{self.path}/manifests/{name}")
        for part in sorted(old):
            self.files.remove(self._part(part))
        return sorted(old)

    # Reading

    def _batches(self) -> dict[str, list[int]]:
        """Complete batches and their periods: a line each, as many as there were writes."""
        folder = f"{self.path}/batches"
        names = [n for n in self.files.names(folder) if "." not in n]
        return {n: json.loads(self.files.read_text(f"{folder}/{n}", patience=5)) for n in names}

    def _manifests(self) -> list[str]:
        return [n for n in self.files.names(f"{self.path}/manifests") if "." not in n]

    def _manifest(self, name: str | None = None) -> tuple[set[str], dict[tuple[int, int], str]]:
        """Batches whose rows are in the blocks, and the part that holds each block."""
        name = name or next(iter(self._manifests()[-1:]), None)
        if name is None:
            return set(), {}
        found = json.loads(self.files.read_text(f"{self.path}/manifests/{name}", patience=5))
        return set(found["batches"]), {(level, b): part for level, b, part in found["blocks"]}

    def _schema(self) -> T.StructType:
        path = f"{self.path}/schema.json"
        return T.StructType.fromJson(json.loads(self.files.read_text(path, patience=5)))

    def _scan(self, schema: T.StructType, places: dict[tuple[str, int], Iterable[int]]) -> DataFrame:
        """Rows of ``{(part, level): blocks}``, by filters on directories alone."""
        full = T.StructType([*schema.fields])
        for name, kind in ((_PART, T.StringType()), (_LEVEL, T.IntegerType()), (_BLOCK, T.LongType())):
            full.add(name, kind)
        same: dict[tuple[int, tuple[int, ...]], list[str]] = {}
        for (part, level), blocks in places.items():
            same.setdefault((level, tuple(sorted(set(blocks)))), []).append(part)
        wanted = [
            F.col(_PART).isin(parts) & (F.col(_LEVEL) == level) & F.col(_BLOCK).isin(list(blocks))
            for (level, blocks), parts in same.items()
            if blocks
        ]
        if not wanted:
            return self.spark.createDataFrame([], full)
        paths = sorted({self._part(part) for part, _ in places})
        read = self.spark.read.schema(full).option("basePath", f"{self.path}/parts")
        return read.parquet(*paths).filter(reduce(or_, wanted))

    def _cover(self, low: int, high: int, stored: list[int], blocks) -> list[tuple[int, int]]:
        """The largest blocks there are for the periods from ``low`` to before ``high``."""
        found, at = [], bisect_left(stored, low)
        while at < len(stored) and stored[at] < high:
            period = stored[at]
            level = next(
                n
                for n in range(self.levels, -1, -1)
                if n == 0
                or (n, period // self.fanout**n) in blocks
                and period // self.fanout**n * self.fanout**n >= low
                and (period // self.fanout**n + 1) * self.fanout**n <= high
            )
            block = period // self.fanout**level
            found.append((level, block))
            at = bisect_left(stored, (block + 1) * self.fanout**level)
        return found

    def places(self, periods: Iterable[int]) -> dict[tuple[str, int], set[int]]:
        """What has to be read for spine rows of these periods, as ``{(part, level): blocks}``."""
        batches, (covered, blocks) = self._batches(), self._manifest()
        stored = sorted({p for own in batches.values() for p in own})
        own, gaps, before = set(periods), [], None
        reach = None if self.table.max_age is None else -(-self.table.max_age * 1_000_000 // self.period)
        for period in sorted(own):
            lows = [period - reach] if reach is not None else []
            lows += [before + 1] if before is not None else []
            gaps += self._cover(max(lows, default=_EVER), period, stored, blocks)
            before = period
        found: dict[tuple[str, int], set[int]] = {}
        plain = {b for level, b in gaps if level == 0}
        rolled = [(b * self.fanout**n, (b + 1) * self.fanout**n) for n, b in gaps if n]
        for level, block in gaps:
            if level:
                found.setdefault((blocks[level, block], level), set()).add(block)
        for tag, there in batches.items():
            late = () if tag in covered else (p for p in there if any(lo <= p < hi for lo, hi in rolled))
            for level, wanted in ((ROWS, own.intersection(there)), (0, plain.intersection(there).union(late))):
                if wanted:
                    found[tag, level] = wanted
        return found

    def rows_for(self, spine: DataFrame, spine_ts: str) -> DataFrame:
        """Feature rows among which every spine row finds its match."""
        stored = sorted({p for periods in self._batches().values() for p in periods})
        if not stored:
            fields = [*self.table.features, *self.table.entities]
            schema = T.StructType([T.StructField(f.name, f.spark_type) for f in fields])
            for name in (EVENT_TS, CREATED_TS):
                schema.add(name, spine.schema[spine_ts].dataType)
            if self.table.tiebreak and self.table.tiebreak not in schema.names:
                schema.add(self.table.tiebreak, T.LongType())
            return self.spark.createDataFrame([], schema)
        us = epoch_micros(quoted(spine_ts), spine.schema[spine_ts].dataType)
        # Times after the last period need what it needs, so there are no more than are stored.
        period = F.least(_block_of(us, self.period), F.lit(stored[-1] + 1))
        seen = spine.select(period.alias(_BLOCK)).filter(F.col(_BLOCK) >= stored[0]).distinct()
        places = self.places(r[0] for r in seen.collect())
        return self._scan(self._schema(), places).select(*[quoted(c) for c in self._columns()])

    def source(self, spine: DataFrame, spine_ts: str) -> FrameSource:
        """:meth:`rows_for` as the batch source of the table, for retrieval along with others."""
        return FrameSource(EVENT_TS, CREATED_TS, df=self.rows_for(spine, spine_ts))
