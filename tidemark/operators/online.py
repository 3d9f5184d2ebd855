"""Rules of the latest-value table, as operations on a log of compacted batches.

A log holds at most one row per key and batch: the keys, the features, ``event_timestamp``,
``_expiry`` (NULL for a table without an age limit) and ``_seq``, the order of the batches. The
state of a key is a fold over its log rows, so a group is never larger than the number of
batches written since the last compaction, however often a key occurs in the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import add_seconds, key_text
from tidemark.operators.mapping import prefixed, quoted
from tidemark.operators.unions import union_rows
from tidemark.spec import EVENT_TS, FeatureTable

SEQ, EXPIRY = "_seq", "_expiry"
# The sequence of rows that a base holds: before all batches.
BASE_SEQ = -1
LAYOUTS = ("feature", "row")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The row with the latest ``ts`` for each key; ties go to the greatest other values.

    A plain aggregate, so that each task first reduces its own rows to one per key.
    """
    order = [ts, *tiebreak]
    rest = [c for c in df.columns if c not in [*keys, *order]]
    best = F.max(F.struct(*[quoted(c) for c in [*order, *rest]])).alias("_tm_best")
    reduced = df.groupBy(*[quoted(k) for k in keys]).agg(best)
    return reduced.select(
        *[quoted(c) if c in keys else F.col("_tm_best")[c].alias(c) for c in df.columns]
    )


def row_expiry(ts: Column, max_age: int | None, keys: Sequence[str], max_jitter: int = 0) -> Column:
    """``ts + max_age`` plus a per-key number of seconds below ``max_jitter``; NULL without age."""
    if not max_age:
        return F.lit(None)
    seconds: int | Column = max_age
    if max_jitter > 0:
        spread = F.pmod(F.xxhash64(*[quoted(k) for k in keys]), F.lit(max_jitter))
        seconds = F.lit(max_age) + spread.cast("int")
    return add_seconds(ts, seconds)


def log_rows(
    df: DataFrame,
    table: FeatureTable,
    event_ts: str,
    seq: int,
    max_jitter: int = 0,
    layout: str = "feature",
) -> DataFrame:
    """A batch of valid rows, compacted and in the shape of the log."""
    keys = table.entity_names
    kind = df.schema[event_ts].dataType
    rows = df.select(
        *[quoted(k) for k in keys],
        quoted(event_ts).alias(EVENT_TS),
        *[quoted(f) for f in table.feature_names],
    )
    if layout == "row":
        rows = rows.filter(F.length(key_text(keys)) > 0)
    expiry = row_expiry(quoted(EVENT_TS), table.online_max_age, keys, max_jitter)
    return latest_per_key(rows, keys, EVENT_TS).select(
        "*", expiry.cast(kind).alias(EXPIRY), F.lit(seq).cast("long").alias(SEQ)
    )


def log_schema(table: FeatureTable, kind: T.DataType) -> T.StructType:
    schema = T.StructType([T.StructField(f.name, f.spark_type) for f in table.entities])
    schema.add(EVENT_TS, kind)
    for f in table.features:
        schema.add(f.name, f.spark_type)
    return schema.add(EXPIRY, kind).add(SEQ, T.LongType())


def accepted(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Log rows that were applied: those not older than any earlier row of their key."""
    earlier = (
        Window.partitionBy(*[quoted(k) for k in keys])
        .orderBy(SEQ)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    newest = F.max(EVENT_TS).over(earlier)
    flagged = log.withColumn("_tm_ok", F.col(EVENT_TS) >= F.coalesce(newest, F.col(EVENT_TS)))
    return flagged.filter("_tm_ok").drop("_tm_ok")


def fold_table(log: DataFrame, table: FeatureTable, layout: str = "feature") -> DataFrame:
    """State of one feature table: keys, features, ``event_timestamp`` and ``_expiry``.

    ``"feature"``: an applied row replaces the features it has a value for; the older value of
    a feature that is NULL in it stays (``_expiry`` is then :func:`fold_expiry`'s matter and left
    out). ``"row"``: the latest row replaces the whole one before it, expiry included.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    keys = table.entity_names
    key_cols = [quoted(k) for k in keys]
    if layout == "row":
        names = [*table.feature_names, EXPIRY]
        best = F.max(F.struct(EVENT_TS, SEQ, F.struct(*[quoted(n) for n in names]).alias("v")))
        return (
            log.groupBy(*key_cols)
            .agg(best.alias("_tm_best"))
            .select(
                *key_cols,
                *[F.col("_tm_best")["v"][n].alias(n) for n in table.feature_names],
                F.col("_tm_best")[EVENT_TS].alias(EVENT_TS),
                F.col("_tm_best")["v"][EXPIRY].alias(EXPIRY),
            )
        )
    merged = [
        F.max_by(quoted(f), F.when(quoted(f).isNotNull(), F.col(SEQ))).alias(f)
        for f in table.feature_names
    ]
    return accepted(log, keys).groupBy(*key_cols).agg(*merged, F.max(EVENT_TS).alias(EVENT_TS))


def fold_expiry(
    logs: Sequence[DataFrame],
    keys: Sequence[str],
    kept: DataFrame | None = None,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Expiry of each key, shared by all feature tables on it.

    Every applied row of a table with an age limit can only move the expiry up; one of a table
    without removes it, and later rows start anew. Rows of a base only say which later ones were
    applied; the expiries at that point are ``kept`` (keys, ``_seq``, ``_expiry``).
    ``wanted`` (distinct keys) restricts the result.
    """
    key_cols = [quoted(k) for k in keys]
    columns = [*key_cols, EVENT_TS, SEQ, EXPIRY]
    tagged = [log.select(*columns, F.lit(i).alias("_tm_log")) for i, log in enumerate(logs)]
    rows = union_rows(tagged)
    if wanted is not None:
        rows = rows.join(wanted, on=list(keys), how="left_semi")
    # Placed by key once, for the windows per table and per key alike.
    rows = accepted(rows.repartition(*key_cols), [*keys, "_tm_log"]).filter(F.col(SEQ) > BASE_SEQ)
    if kept is not None:
        if wanted is not None:
            kept = kept.join(wanted, on=list(keys), how="left_semi")
        columns = [*key_cols, SEQ, EXPIRY]
        rows = union_rows([rows.select(*columns), kept.select(*columns)], keys)
    reset = F.max(F.when(F.col(EXPIRY).isNull(), F.col(SEQ))).over(Window.partitionBy(*key_cols))
    since = rows.withColumn("_tm_reset", F.coalesce(reset, F.lit(BASE_SEQ - 1)))
    return since.groupBy(*key_cols).agg(
        F.max(F.when(F.col(SEQ) > F.col("_tm_reset"), F.col(EXPIRY))).alias(EXPIRY)
    )


def key_space(table: FeatureTable) -> tuple[str, ...]:
    """Project and sorted entity names: what tables that share their keys have in common."""
    return (table.project, *sorted(table.entity_names))


def look_up(
    requests: DataFrame,
    states: Sequence[DataFrame],
    tables: Sequence[FeatureTable],
    now: Column,
    with_status: bool = False,
    shared_expiry: Mapping[tuple[str, ...], DataFrame] | None = None,
) -> DataFrame:
    """Latest features for each request row; values past their age limit or expiry are unset.

    The expiry is a state's own, or that of its keys in ``shared_expiry`` (by key space). With
    ``with_status`` each table adds ``<table>__status``: ``PRESENT``, ``NOT_FOUND`` or
    ``OUTSIDE_MAX_AGE``.
    """
    spaces: dict[tuple[str, ...], list[int]] = {}
    for i, table in enumerate(tables):
        spaces.setdefault(key_space(table), []).append(i)
    joined, values = requests, {}
    for n, (space, members) in enumerate(spaces.items()):
        keys = list(space[1:])
        shared = (shared_expiry or {}).get(space)
        if shared is not None:
            joined = joined.join(
                shared.select(*[quoted(k) for k in keys], F.col(EXPIRY).alias(f"_tm_expiry{n}")),
                on=keys,
                how="left",
            )
        for i in members:
            table, own = tables[i], [] if shared is not None else [F.col(EXPIRY)]
            features = F.struct(*[quoted(f) for f in tables[i].feature_names]).alias("v")
            state = F.struct(F.col(EVENT_TS), features, *own).alias(f"_tm_state{i}")
            joined = joined.join(
                states[i].select(*[quoted(k) for k in keys], state), on=keys, how="left"
            )
            found = F.col(f"_tm_state{i}")
            expiry = found[EXPIRY] if shared is None else F.col(f"_tm_expiry{n}")
            live = F.coalesce(expiry > now, F.lit(True))
            if table.max_age is not None:
                live = live & (found[EVENT_TS] >= add_seconds(now, -table.max_age))
            live = found.isNotNull() & live
            values[i] = [
                F.when(live, found["v"][f]).alias(prefixed(table, f)) for f in table.feature_names
            ]
            if with_status:
                status = (
                    F.when(found.isNull(), "NOT_FOUND")
                    .when(live, "PRESENT")
                    .otherwise("OUTSIDE_MAX_AGE")
                )
                values[i].append(status.alias(prefixed(table, "status")))
    return joined.select(
        *[quoted(c) for c in requests.columns],
        *[v for i in range(len(tables)) for v in values[i]],
    )


# Times in packed rows keep their microseconds.
_JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def schema_reference(schema: T.StructType) -> bytes:
    """Four bytes that tell which schema a packed row was written with."""
    return hashlib.md5(schema.json().encode()).digest()[:4]


def pack_row(df: DataFrame, columns: Sequence[str]) -> Column:
    """All ``columns`` in one binary value: the schema reference, then the row as JSON."""
    schema = df.select(*[quoted(c) for c in columns]).schema
    body = F.to_json(F.struct(*[quoted(c) for c in columns]), _JSON_TIMES)
    return F.concat(F.lit(schema_reference(schema)), F.encode(body, "UTF-8"))


def unpack_row(value: Column, schema: T.StructType) -> Column:
    """A packed row as a struct; NULL when it was written with another schema."""
    same = F.substring(value, 1, 4) == F.lit(schema_reference(schema))
    body = F.decode(F.substring(value, 5, 2_147_483_647), "UTF-8")
    return F.when(same, F.from_json(body, schema, _JSON_TIMES))
