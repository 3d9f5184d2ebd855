"""Point-in-time joins: every spine row gets the feature values current at its timestamp.

The plan is a union of spine and feature rows and one running ``max`` per feature table over
``(keys ordered by time)``: one shuffle by key serves all tables with the same keys, and no
pair of rows is ever formed. A feature row is compared as the struct ``(event time, created
time, tie-break, values)``, so the running maximum is the latest row with ties resolved.

A key with more rows than one task should sort is *hot*. Hot keys are found with a mergeable
heavy-hitter sketch over a part of the rows; it only steers the plan, never the result. Their
rows are cut into time slices of about equal size, by a sample of their times; each slice is scanned on its own and inherits
the best row of the slices before it. Times too frequent to cut are reduced to one row first.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import (
    add_seconds,
    all_not_null,
    epoch_micros,
    timestamp_literal,
    utc_date,
)
from tidemark.operators.mapping import DATE_PARTITION, output_columns, prefixed, quoted
from tidemark.operators.unions import union_rows
from tidemark.spec import CREATED_TS, EVENT_TS, FeatureTable, SchemaError

SPINE_EVENT_TS = "event_timestamp_entity"

_ROW, _TS, _SIDE, _SLICE = "_tm_row", "_tm_ts", "_tm_side", "_tm_slice"


@dataclass(frozen=True)
class SkewPolicy:
    """Sizes that steer the physical plan; none of them changes a result.

    ``least_row_bytes``: stored bytes that a row takes at least, by which ``"auto"`` tells from the
    inputs' stored size that no key can have ``hot_rows`` rows. ``slices``: into how many parts
    ``"sliced"`` cuts.
    """

    hot_rows: int = 1_000_000
    max_hot_keys: int = 4096
    tracked_keys: int = 16_384
    slices: int = 2048
    least_row_bytes: int = 8
    sketch_share: float = 1 / 16
    sampled_times: int = 1 << 16
    key_filter_bytes: int = 64 << 20
    broadcast_bytes: int = 16 << 20
    broadcast_ratio: int = 16
    filter_ratio: int = 2
    broadcast_partitions: int | None = None


@dataclass(frozen=True)
class SpineStats:
    """Figures of one pass over the spine; ``hot`` maps a key set to ``{key hash: rows}``."""

    rows: int
    min_micros: int | None
    max_micros: int | None
    unmatchable: dict[tuple[str, ...], int] = field(default_factory=dict)
    key_bytes: dict[tuple[str, ...], int] = field(default_factory=dict)
    hot: dict[tuple[str, ...], dict[int, int]] = field(default_factory=dict)


def _check_strategy(strategy: str) -> None:
    if strategy not in ("auto", "window", "sliced", "broadcast"):
        raise ValueError(f"unknown strategy {strategy!r}")


def _key_set(table: FeatureTable) -> tuple[str, ...]:
    return tuple(sorted(table.entity_names))


def _type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[quoted(k) for k in keys])


def _usable(keys: Sequence[str], ts: str) -> Column:
    return all_not_null([quoted(n) for n in [*keys, ts]])


def _picked(policy: SkewPolicy) -> Column:
    """A random part of the rows is enough to see which keys are large."""
    return F.lit(True) if policy.sketch_share >= 1 else F.rand(0) < policy.sketch_share


# Tasks' sketches meet in so many groups first, so that no single task gets one from each of them.
_SKETCH_GROUPS = 256


def _sketch_group() -> Column:
    return F.pmod(F.spark_partition_id(), F.lit(_SKETCH_GROUPS)).alias("part")


def _sketched(usable: str, hashed: str, policy: SkewPolicy) -> Column:
    """Heavy hitters of one group of tasks."""
    sketch = f"approx_top_k_accumulate({hashed}, {policy.tracked_keys})"
    return F.expr(f"{sketch} FILTER (WHERE picked AND {usable})")


def _heavy_hitters(sketch: str, policy: SkewPolicy) -> Column:
    """Those of all groups."""
    combined = f"approx_top_k_combine({sketch}, {policy.tracked_keys})"
    return F.expr(f"approx_top_k_estimate({combined}, {policy.max_hot_keys})")


def _constants(values: Sequence[int]) -> str:
    """Many constants as SQL text, which costs one call instead of one per value."""
    return ", ".join(f"{v}L" if v > -(1 << 63) else f"(-{(1 << 63) - 1}L - 1L)" for v in values)


def _is_hot(keys: Sequence[str], hot: Sequence[int]) -> Column:
    names = ", ".join("`" + k.replace("`", "``") + "`" for k in keys)
    return F.expr(f"xxhash64({names}) IN ({_constants(hot)})")


def _as_hot(entries, policy: SkewPolicy) -> dict[int, int]:
    scale = 1 / min(policy.sketch_share, 1)
    sizes = {e["item"]: math.ceil(e["count"] * scale) for e in entries or []}
    return {h: n for h, n in sizes.items() if n >= policy.hot_rows}


def spine_bounds(spine: DataFrame, spine_ts: str) -> tuple[int | None, int | None]:
    """Earliest and latest spine timestamp in microseconds, (None, None) without any."""
    us = epoch_micros(quoted(spine_ts), _type_of(spine, spine_ts))
    row = spine.agg(F.min(us).alias("lo"), F.max(us).alias("hi")).first()
    return row["lo"], row["hi"]


def _stored_bytes(key: Column, kind: T.DataType, policy: SkewPolicy) -> Column:
    """Size of a key value; one of unknown size counts as too large to broadcast."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(key), F.lit(0)) + 8
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return F.lit(8)
    return F.lit(policy.broadcast_bytes + 1)


def spine_stats(
    spine: DataFrame,
    spine_ts: str,
    key_sets: Sequence[tuple[str, ...]],
    policy: SkewPolicy = SkewPolicy(),
) -> SpineStats:
    """Row count, time bounds and per key set: rows without a key, key bytes and hot keys."""
    us = epoch_micros(quoted(spine_ts), _type_of(spine, spine_ts))
    narrow = [us.alias("us"), _picked(policy).alias("picked"), _sketch_group()]
    aggs = [F.count(F.lit(1)).alias("rows"), F.min("us").alias("lo"), F.max("us").alias("hi")]
    totals = [F.sum("rows").alias("rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi")]
    for i, keys in enumerate(key_sets):
        sizes = [_stored_bytes(quoted(k), _type_of(spine, k), policy) for k in keys]
        size = sum(sizes, F.lit(16.0))
        narrow += [
            _usable(keys, spine_ts).alias(f"ok{i}"),
            _key_hash(keys).alias(f"h{i}"),
            size.alias(f"b{i}"),
        ]
        aggs += [
            F.count_if(~F.col(f"ok{i}")).alias(f"bad{i}"),
            F.sum(f"b{i}").alias(f"bytes{i}"),
            _sketched(f"ok{i}", f"h{i}", policy).alias(f"top{i}"),
        ]
        totals += [
            F.sum(f"bad{i}").alias(f"bad{i}"),
            F.sum(f"bytes{i}").alias(f"bytes{i}"),
            _heavy_hitters(f"top{i}", policy).alias(f"top{i}"),
        ]
    # Grouped by a constant: sketches of no rows at all cannot be combined.
    parts = spine.select(*narrow).groupBy("part").agg(*aggs)
    row = parts.groupBy(F.lit(0).alias("all")).agg(*totals).first()
    if row is None:
        none = {k: 0 for k in key_sets}
        return SpineStats(0, None, None, none, none, {k: {} for k in key_sets})
    return SpineStats(
        rows=row["rows"],
        min_micros=row["lo"],
        max_micros=row["hi"],
        unmatchable={k: row[f"bad{i}"] for i, k in enumerate(key_sets)},
        key_bytes={k: math.ceil(row[f"bytes{i}"] or 0) for i, k in enumerate(key_sets)},
        hot={k: _as_hot(row[f"top{i}"], policy) for i, k in enumerate(key_sets)},
    )


def _feature_stats(
    frames: Sequence[DataFrame], tables: Sequence[FeatureTable], policy: SkewPolicy
) -> list[tuple[int, dict[int, int]]]:
    """Per table, in one job: row count and hot keys."""
    parts = [
        df.select(
            F.lit(i).alias("i"),
            _key_hash(_key_set(t)).alias("h"),
            _picked(policy).alias("picked"),
            _sketch_group(),
        )
        for i, (df, t) in enumerate(zip(frames, tables))
    ]
    rows = (
        union_rows(parts)
        .groupBy("i", "part")
        .agg(F.count(F.lit(1)).alias("rows"), _sketched("true", "h", policy).alias("top"))
        .groupBy("i")
        .agg(F.sum("rows").alias("rows"), _heavy_hitters("top", policy).alias("top"))
        .collect()
    )
    found = {r["i"]: (r["rows"], _as_hot(r["top"], policy)) for r in rows}
    return [found.get(i, (0, {})) for i in range(len(frames))]


def _may_be_hot(inputs: Sequence[DataFrame], policy: SkewPolicy) -> bool:
    """Whether, by the optimiser's size of the inputs, any key could have ``hot_rows`` rows."""
    sizes = [int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in inputs]
    return sum(sizes) >= policy.hot_rows * policy.least_row_bytes


def _measured(
    spine: DataFrame,
    spine_ts: str,
    frames: Sequence[DataFrame],
    tables: Sequence[FeatureTable],
    key_sets: Sequence[tuple[str, ...]],
    strategy: str,
    policy: SkewPolicy,
) -> tuple[str, list[DataFrame], SpineStats | None, list | None]:
    """The strategy to follow, the features within reach, and what was measured for it.

    Features are always cut to the reach of the spine's times. Keys are measured only where one
    could be large. A spine whose keys are too large to broadcast, or of a type whose size is
    not known, is joined without.
    """
    if strategy not in ("auto", "broadcast"):
        return strategy, list(frames), None, None
    if strategy == "auto" and not _may_be_hot([spine, *frames], policy):
        bounds = spine_bounds(spine, spine_ts)
        return strategy, [prune_to_spine(df, t, *bounds) for df, t in zip(frames, tables)], None, None
    stats = spine_stats(spine, spine_ts, key_sets, policy)
    if strategy == "broadcast" and max(stats.key_bytes.values()) > policy.broadcast_bytes:
        strategy = "auto"
    reached = [prune_to_spine(df, t, stats.min_micros, stats.max_micros) for df, t in zip(frames, tables)]
    return strategy, reached, stats, _feature_stats(reached, tables, policy)


def prune_to_spine(
    features: DataFrame,
    table: FeatureTable,
    min_micros: int | None,
    max_micros: int | None,
    event_ts: str = EVENT_TS,
) -> DataFrame:
    """Feature rows within ``[first spine time - max_age, last spine time]``, as constants.

    Without a spine time there is nothing to match, and the features are kept as they are. The
    date partitions of the event times are dropped alike, with a day to spare for the time zone
    the dates were taken in; partitions that name no date are kept.
    """
    if min_micros is None:
        return features
    kind = _type_of(features, event_ts)
    ts = quoted(event_ts)
    kept = features.filter(ts <= timestamp_literal(max_micros, kind))
    dated = DATE_PARTITION in features.columns
    if dated:
        no_date, day = F.col(DATE_PARTITION).isNull(), F.col(DATE_PARTITION)
        kept = kept.filter(no_date | (day <= F.lit(utc_date(max_micros, 1))))
    if table.max_age is not None:
        lowest = min_micros - table.max_age * 1_000_000
        kept = kept.filter(ts >= timestamp_literal(lowest, kind))
        if dated:
            kept = kept.filter(no_date | (day >= F.lit(utc_date(lowest, -1))))
    return kept


def _semi_join_spine(
    features: DataFrame,
    table: FeatureTable,
    spine: DataFrame,
    spine_ts: str,
    partitions: int | None = None,
) -> DataFrame:
    """Drop feature rows whose key or time cannot match, with one broadcast row per spine key.

    ``partitions`` spreads features that are stored in a few large pieces before the join.
    """
    if partitions:
        features = features.repartition(partitions)
    keys = table.entity_names
    per_key = (
        spine.filter(_usable(keys, spine_ts))
        .groupBy(*[quoted(k) for k in keys])
        .agg(F.min(quoted(spine_ts)).alias("_tm_lo"), F.max(quoted(spine_ts)).alias("_tm_hi"))
    )
    in_reach = F.col(EVENT_TS) <= F.col("_tm_hi")
    if table.max_age is not None:
        in_reach = in_reach & (F.col(EVENT_TS) >= add_seconds(F.col("_tm_lo"), -table.max_age))
    joined = features.join(F.broadcast(per_key), on=keys, how="inner")
    return joined.filter(in_reach).select(*[quoted(c) for c in features.columns])


# Bits of a key filter per spine row, and per row of it that is sent out.
_FILTER_BITS, _FILTER_ROW_BITS = 16, 8 * 4096


def _key_filter_bits(rows: int, policy: SkewPolicy) -> int:
    """Size of a filter for the keys of so many spine rows; 0 if it would be too large to send out
    or let most keys through."""
    bits = 1 << max(15, (min(rows, policy.key_filter_bytes * 8) * _FILTER_BITS - 1).bit_length())
    bits = min(bits, 1 << (policy.key_filter_bytes * 8).bit_length() - 1)
    return bits if bits >= 4 * rows and bits >= _FILTER_ROW_BITS else 0


def filter_by_keys(features: DataFrame, keys: Sequence[str], spine: DataFrame, bits: int) -> DataFrame:
    """Feature rows whose key may be in the spine, by a bitmap of ``bits`` key hashes.

    The bitmap is made in pieces of 4 KB, each by its own group, and sent out: its size is
    bounded whatever the keys are, and wide text keys cost no more than numbers. Hashes that meet let a
    row through in vain; none is lost.
    """
    place = F.pmod(_key_hash(keys), F.lit(bits))
    piece, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    pieces = spine.select(piece.alias("_tm_piece"), bit.alias("_tm_bit")).groupBy("_tm_piece").agg(
        F.bitmap_construct_agg("_tm_bit").alias("_tm_bits")
    )
    byte = F.conv(F.hex(F.substring("_tm_bits", F.expr("_tm_bit div 8 + 1").cast("int"), F.lit(1))), 16, 10)
    is_set = F.call_function("getbit", byte.cast("bigint"), F.expr("_tm_bit % 8").cast("int")) == 1
    placed = features.withColumn("_tm_piece", piece).withColumn("_tm_bit", bit)
    return placed.join(F.broadcast(pieces), "_tm_piece").filter(is_set).select(*[quoted(c) for c in features.columns])


def candidate(table: FeatureTable) -> Column:
    """A feature row as one struct that orders by event time, created time, then tie-break."""
    parts = [quoted(EVENT_TS).alias("at"), quoted(CREATED_TS).alias("created")]
    if table.tiebreak:
        parts.append(quoted(table.tiebreak).alias("tie"))
    values = F.struct(*[quoted(n) for n in table.feature_names])
    return F.struct(*parts, values.alias("v"))


def _spine_rows(spine: DataFrame, spine_ts: str, keys: Sequence[str]) -> DataFrame:
    return spine.select(
        *[quoted(k) for k in keys],
        quoted(spine_ts).alias(_TS),
        F.lit(1).alias(_SIDE),
        F.struct(*[quoted(c) for c in spine.columns]).alias(_ROW),
    )


def _feature_rows(
    frames: Sequence[DataFrame], tables: Sequence[FeatureTable], keys: Sequence[str]
) -> list[DataFrame]:
    return [
        df.select(
            *[quoted(k) for k in keys],
            quoted(EVENT_TS).alias(_TS),
            F.lit(0).alias(_SIDE),
            candidate(table).alias(f"_tm_f{i}"),
        )
        for i, (df, table) in enumerate(zip(frames, tables))
    ]


def _best_columns(tables: Sequence[FeatureTable]) -> list[str]:
    return [f"_tm_f{i}" for i in range(len(tables))]


def _scan_by_key(
    spine: DataFrame, spine_ts: str, keys: Sequence[str], frames, tables, buckets: int | None = None
) -> DataFrame:
    """One window per key: spine rows travel as structs, so copies and extra columns survive.

    ``buckets``: the features are stored in so many buckets of ``keys``, and only the spine moves.
    A fixed number of partitions is one that adaptive execution leaves alone.
    """
    spine_rows, feature_rows = _spine_rows(spine, spine_ts, keys), _feature_rows(frames, tables, keys)
    if buckets:
        # Under new names, as Spark tells by the columns that both sides are placed alike.
        names = {k: f"_tm_k{i}" for i, k in enumerate(keys)}
        placed = spine_rows.repartition(buckets, *[quoted(k) for k in keys])
        rows = union_rows([df.withColumnsRenamed(names) for df in [*feature_rows, placed]])
        keys = list(names.values())
    else:
        rows = union_rows([spine_rows, *feature_rows], keys)
    upto = (
        Window.partitionBy(*[quoted(k) for k in keys])
        .orderBy(_TS, _SIDE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    best = [F.max(c).over(upto).alias(c) for c in _best_columns(tables)]
    return (
        rows.select(_ROW, _SIDE, *best)
        .filter(F.col(_SIDE) == 1)
        .select(f"{_ROW}.*", *_best_columns(tables))
    )


def _slice_of(ts: Column, kind: T.DataType, splits: Sequence[int]) -> Column:
    """Number of splits before ``ts``: a binary search in the sorted constants."""
    us, found = epoch_micros(ts, kind), F.expr(f"array({_constants(splits)})")
    steps = [1 << b for b in reversed(range(len(splits).bit_length()))]
    return F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda at, step: F.when(F.get(found, at + step - 1) < us, at + step).otherwise(at),
    )


def _time_splits(
    times: Sequence[DataFrame], kind: T.DataType, slices: int, policy: SkewPolicy
) -> tuple[list[int], bool]:
    """Times that cut all rows into about equal slices, from a sample of bounded size.

    Also tells whether a single time fills a slice by itself, so that no cut can divide it.
    """
    us = union_rows([df.select(epoch_micros(F.col(_TS), kind).alias("us")) for df in times])
    wanted = max(policy.sampled_times, 64 * slices)
    share = wanted / max(us.count(), 1)
    if share < 1:
        us = us.filter(F.rand(1) < share)
    sample = np.sort(us.toArrow()["us"].to_numpy())
    if not len(sample):
        return [0], False
    found = sample[np.arange(1, slices) * len(sample) // slices].tolist() or [int(sample[0])]
    splits = sorted(set(found))
    return splits, len(splits) < len(found)


def _scan_slices(
    spine_rows: DataFrame,
    feature_rows: Sequence[DataFrame],
    keys: Sequence[str],
    kind: T.DataType,
    splits: Sequence[int],
) -> DataFrame:
    """``spine_rows`` with the best feature row of each table at or before their time.

    Every slice of a key is scanned on its own; what came before it is the best row of the
    earlier slices, taken from a summary with one row per key and slice.
    """
    key_cols = [quoted(k) for k in keys]
    best = [f"_tm_f{i}" for i in range(len(feature_rows))]
    number = _slice_of(F.col(_TS), kind, splits)
    spine_rows = spine_rows.withColumn(_SLICE, number)
    feature_rows = [df.withColumn(_SLICE, number) for df in feature_rows]
    upto = (
        Window.partitionBy(*key_cols, _SLICE)
        .orderBy(_TS, _SIDE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = [c for c in spine_rows.columns if c not in (*keys, _SIDE, _SLICE)]
    within = (
        union_rows([spine_rows, *feature_rows], [*keys, _SLICE])
        .select(
            *key_cols, _SLICE, _SIDE, *carried, *[F.max(c).over(upto).alias(c) for c in best]
        )
        .filter(F.col(_SIDE) == 1)
    )
    before = (
        Window.partitionBy(*key_cols)
        .orderBy(_SLICE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    summaries = [
        df.groupBy(*key_cols, _SLICE).agg(F.max(c).alias(c)) for df, c in zip(feature_rows, best)
    ]
    summaries.append(spine_rows.select(*key_cols, _SLICE).distinct())
    inherited = (
        union_rows(summaries, keys)
        .groupBy(*key_cols, _SLICE)
        .agg(*[F.max(c).alias(c) for c in best])
        .select(*key_cols, _SLICE, *[F.max(c).over(before).alias(f"{c}_old") for c in best])
    )
    return within.join(inherited, on=[*keys, _SLICE], how="left").select(
        *key_cols, *carried, *[F.coalesce(c, f"{c}_old").alias(c) for c in best]
    )


def _scan_by_slice(
    spine: DataFrame,
    spine_ts: str,
    keys: Sequence[str],
    frames: Sequence[DataFrame],
    tables: Sequence[FeatureTable],
    slices: int,
    policy: SkewPolicy,
) -> DataFrame:
    """The same result for keys of any size: no task holds more than a time slice of a key.

    Where single times are too large to cut, spine and features are first reduced to one row
    per key and time; adaptive execution divides the large groups of the join that brings the
    spine rows back.
    """
    kind = _type_of(spine, spine_ts)
    best = _best_columns(tables)
    key_cols = [quoted(k) for k in keys]
    feature_rows = _feature_rows(frames, tables, keys)
    spine_rows = _spine_rows(spine, spine_ts, keys)
    splits, heavy_times = _time_splits(
        [df.select(_TS) for df in [spine_rows, *feature_rows]], kind, slices, policy
    )
    if not heavy_times:
        matches = _scan_slices(spine_rows, feature_rows, keys, kind, splits)
        return matches.select(f"{_ROW}.*", *best)
    points = spine_rows.select(*key_cols, _TS, _SIDE).distinct()
    latest = [
        rows.groupBy(*key_cols, _TS, _SIDE).agg(F.max(c).alias(c))
        for rows, c in zip(feature_rows, best)
    ]
    matches = _scan_slices(points, latest, keys, kind, splits)
    matched = spine.join(
        matches.withColumnRenamed(_TS, spine_ts), on=[*keys, spine_ts], how="left"
    )
    return matched.select(*[quoted(c) for c in spine.columns], *best)


def _without_match(spine: DataFrame, frames, tables) -> DataFrame:
    empty = []
    for i, (df, table) in enumerate(zip(frames, tables)):
        kind = df.select(candidate(table).alias("c")).schema["c"].dataType
        empty.append(F.lit(None).cast(kind).alias(f"_tm_f{i}"))
    return spine.select(*[quoted(c) for c in spine.columns], *empty)


def _check_kinds(spine: DataFrame, spine_ts: str, frames, tables) -> None:
    for df, table in zip(frames, tables):
        if _type_of(df, EVENT_TS) != _type_of(spine, spine_ts):
            raise SchemaError(
                f"{table.name} has {_type_of(df, EVENT_TS).simpleString()} event times, the spine "
                f"{_type_of(spine, spine_ts).simpleString()}"
            )


def _match(
    spine: DataFrame,
    spine_ts: str,
    frames: Sequence[DataFrame],
    tables: Sequence[FeatureTable],
    stats: SpineStats | None,
    counts: Sequence[tuple[int, dict[int, int]]] | None,
    strategy: str,
    policy: SkewPolicy,
    complete_keys: bool = False,
    buckets: int | None = None,
    beside: Sequence[DataFrame] = (),
) -> DataFrame:
    """Spine plus one struct ``_tm_f<i>`` per table (all with the same keys): its match or NULL.

    ``complete_keys`` tells that no spine row lacks its key or time. ``buckets`` is the number of
    buckets that ``frames`` are stored in, and ``beside`` holds their rows of hot keys.
    """
    keys = list(_key_set(tables[0]))
    names = tuple(keys)
    usable = _usable(keys, spine_ts)
    frames = [df.filter(_usable(keys, EVENT_TS)) for df in frames]
    parts = []
    hot: dict[int, int] = {}
    if stats is not None:
        hot = dict(stats.hot.get(names, {}))
        for _, found in counts or []:
            for h, n in found.items():
                hot[h] = hot.get(h, 0) + n
    if strategy == "broadcast":
        spread = policy.broadcast_partitions
        frames = [
            _semi_join_spine(df, t, spine, spine_ts, spread) for df, t in zip(frames, tables)
        ]
    elif stats is not None and counts is not None:
        fits = stats.key_bytes.get(names, policy.broadcast_bytes + 1) <= policy.broadcast_bytes
        bits = 0 if fits else _key_filter_bits(stats.rows, policy)

        def reduced(df: DataFrame, table: FeatureTable, n: int) -> DataFrame:
            if fits and n >= policy.broadcast_ratio * max(stats.rows, 1):
                return _semi_join_spine(df, table, spine, spine_ts)
            if bits and n >= policy.filter_ratio * max(stats.rows, 1):
                return filter_by_keys(df, keys, spine.filter(usable), bits)
            return df

        frames = [reduced(df, t, n) for df, t, (n, _) in zip(frames, tables, counts)]
    if strategy == "sliced":
        parts.append(
            _scan_by_slice(
                spine.filter(usable), spine_ts, keys, frames, tables, policy.slices, policy
            )
        )
    elif hot:
        is_hot = _is_hot(keys, sorted(hot))
        # Some slices per task's worth of rows, so that tasks of a large key come out even.
        slices = max(8, math.ceil(4 * sum(hot.values()) / policy.hot_rows))
        parts.append(
            _scan_by_key(
                spine.filter(usable & ~is_hot),
                spine_ts,
                keys,
                [df.filter(~is_hot) for df in frames],
                tables,
                buckets,
            )
        )
        if beside:
            frames = [union_rows([df, more]) for df, more in zip(frames, beside)]
        parts.append(
            _scan_by_slice(
                spine.filter(usable & is_hot),
                spine_ts,
                keys,
                [df.filter(is_hot) for df in frames],
                tables,
                slices,
                policy,
            )
        )
    else:
        parts.append(_scan_by_key(spine.filter(usable), spine_ts, keys, frames, tables, buckets))
    if not complete_keys and (stats is None or stats.unmatchable.get(names, 1)):
        parts.append(_without_match(spine.filter(~usable), frames, tables))
    joined = union_rows(parts)
    out = [quoted(c) for c in spine.columns]
    for i, table in enumerate(tables):
        match = F.col(f"_tm_f{i}")
        if table.max_age is not None:
            fresh = match["at"] >= add_seconds(quoted(spine_ts), -table.max_age)
            match = F.when(fresh, match)
        out.append(match.alias(f"_tm_f{i}"))
    return joined.select(*out)


def join_feature_tables(
    spine: DataFrame,
    spine_ts: str,
    frames: Sequence[DataFrame],
    tables: Sequence[FeatureTable],
    strategy: str = "auto",
    policy: SkewPolicy = SkewPolicy(),
    checkpoint: bool = False,
) -> DataFrame:
    """As-of join of the spine with several feature tables, each with its own keys and age limit.

    ``frames[i]`` holds features, keys, ``event_timestamp`` and ``created_timestamp`` of
    ``tables[i]``. A spine row gets the latest feature row with equal keys and an event time in
    ``[spine time - max_age, spine time]``; ties go to the later created time, then to
    ``table.tiebreak``, then to the greater values. Without a match the features are NULL.
    The result has the spine's columns, then ``table__feature`` in declared order.

    Tables with the same keys share one pass; the spine is read once for each key set and should
    be cheap and repeatable to read. ``strategy``: ``"auto"`` measures spine and
    features first, drops features out of reach and handles hot keys; ``"window"`` plans without
    running anything; ``"sliced"`` treats every key as hot; ``"broadcast"`` also reduces the
    features by the broadcast distinct spine keys, unless those are too large for that.
    With ``checkpoint`` the plan is cut after each pass, for very many tables.
    """
    _check_strategy(strategy)
    _check_kinds(spine, spine_ts, frames, tables)
    groups: dict[tuple[str, ...], list[int]] = {}
    for i, table in enumerate(tables):
        groups.setdefault(_key_set(table), []).append(i)
    strategy, frames, stats, counts = _measured(
        spine, spine_ts, frames, tables, list(groups), strategy, policy
    )
    joined = None
    for keys, members in groups.items():
        own = [tables[i] for i in members]
        plan = (
            [frames[i] for i in members],
            own,
            stats,
            counts and [counts[i] for i in members],
            strategy,
            policy,
        )
        values = [
            F.col(f"_tm_f{n}")["v"][feature].alias(prefixed(table, feature))
            for n, table in enumerate(own)
            for feature in table.feature_names
        ]
        if joined is None:
            matched = _match(spine, spine_ts, *plan)
            joined = matched.select(*[quoted(c) for c in spine.columns], *values)
        else:
            # From the bare spine, so that what is joined so far occurs once in the plan; the
            # equal join leaves large groups to adaptive execution.
            points = spine.select(*[quoted(n) for n in [*keys, spine_ts]])
            points = points.filter(_usable(keys, spine_ts)).distinct()
            matches = _match(points, spine_ts, *plan, complete_keys=True).select(
                *[quoted(n) for n in [*keys, spine_ts]], *values
            )
            joined = joined.join(matches, on=[*keys, spine_ts], how="left")
        if checkpoint:
            joined = joined.checkpoint()
    return joined.select(*[quoted(c) for c in output_columns(spine, tables)])


def as_of_join(
    spine: DataFrame,
    spine_ts: str,
    features: DataFrame,
    table: FeatureTable,
    strategy: str = "auto",
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """As-of join with one feature table; see :func:`join_feature_tables`."""
    return join_feature_tables(spine, spine_ts, [features], [table], strategy, policy)


def join_stored_features(
    spine: DataFrame,
    spine_ts: str,
    features: DataFrame,
    buckets: int,
    beside: DataFrame,
    hot: dict[int, int],
    table: FeatureTable,
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """:func:`as_of_join` with features that are stored in ``buckets`` of the keys and are read in
    place. ``hot`` are the hashes of keys whose rows are ``beside``; these, and keys with too many
    spine rows, are cut into time slices."""
    _check_kinds(spine, spine_ts, [features], [table])
    keys = _key_set(table)
    if hot or _may_be_hot([spine], policy):
        stats = spine_stats(spine, spine_ts, [keys], policy)
        bounds = stats.min_micros, stats.max_micros
    else:
        stats, bounds = None, spine_bounds(spine, spine_ts)
    frames = [prune_to_spine(df, table, *bounds) for df in (features, beside)]
    # No features are counted, so that none are looked up by the spine's keys before the join.
    matched = _match(
        spine, spine_ts, frames[:1], [table], stats, [(-1, hot)], "auto", policy, False, buckets, frames[1:]
    )
    values = [F.col("_tm_f0")["v"][n].alias(prefixed(table, n)) for n in table.feature_names]
    return matched.select(*[quoted(c) for c in spine.columns], *values)


def hot_feature_keys(
    features: DataFrame, table: FeatureTable, policy: SkewPolicy = SkewPolicy()
) -> dict[int, int]:
    """Hashes and sizes of the keys with ``hot_rows`` feature rows or more."""
    if not _may_be_hot([features], policy):
        return {}
    return _feature_stats([features], [table], policy)[0][1]


def is_hot_key(table: FeatureTable, hot: Sequence[int]) -> Column:
    return _is_hot(_key_set(table), sorted(hot)) if hot else F.lit(False)


def nearest_feature_rows(
    features: DataFrame,
    table: FeatureTable,
    spine: DataFrame,
    spine_ts: str,
    strategy: str = "auto",
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """For each distinct spine key and time, the nearest feature row within ``max_age``.

    The spine time is added as ``event_timestamp_entity``; keys and times without a match are
    left out. This is the feature side of :func:`as_of_join` with the ties already resolved.
    """
    _check_strategy(strategy)
    keys = table.entity_names
    points = spine.select(*[quoted(k) for k in keys], quoted(spine_ts).alias(SPINE_EVENT_TS))
    points = points.filter(_usable(keys, SPINE_EVENT_TS)).distinct()
    _check_kinds(points, SPINE_EVENT_TS, [features], [table])
    strategy, frames, stats, counts = _measured(
        points, SPINE_EVENT_TS, [features], [table], [_key_set(table)], strategy, policy
    )
    matched = _match(
        points, SPINE_EVENT_TS, frames, [table], stats, counts, strategy, policy, True
    )
    return matched.filter(F.col("_tm_f0").isNotNull()).select(
        *[F.col("_tm_f0")["v"][n].alias(n) for n in table.feature_names],
        *[quoted(k) for k in keys],
        F.col("_tm_f0")["at"].alias(EVENT_TS),
        F.col("_tm_f0")["created"].alias(CREATED_TS),
        SPINE_EVENT_TS,
    )
