"""SQL with the same result as each query, over the same tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

DAY = 86_400
PURCHASES = "SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'"
SPLIT = "SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"


def _features(rows: str) -> str:
    return f"SELECT *, ts AS f_ts, ts + INTERVAL 5 MINUTE AS c_ts, event_id AS f_id FROM ({rows})"


def _of(kind: str) -> str:
    return _features(f"SELECT * FROM events WHERE event_type = '{kind}'")


ODD = f"SELECT event_id, user_id, event_type, ts FROM ({SPLIT}) WHERE k % 2 = 1"
EVEN = _features(f"SELECT * FROM ({SPLIT}) WHERE k % 2 = 0")


def _asof(spine: str, spine_columns: str, tables: list[tuple], ts: str = "ts") -> str:
    """``tables``: (name, feature rows, keys, max_age, features)."""
    ctes = [f"s AS MATERIALIZED (SELECT *, row_number() OVER () AS rid FROM ({spine}))"]
    joins, columns = [], [f"s.{c.strip()}" for c in spine_columns.split(",")]
    for i, (name, rows, keys, max_age, features) in enumerate(tables):
        on = " AND ".join(f"s.{k} = f.{k}" for k in keys)
        low = "" if max_age is None else f" AND f.f_ts >= s.{ts} - INTERVAL {max_age} SECOND"
        values = ", ".join(f"f.{c}" for c in features)
        ctes.append(
            f"m{i} AS (SELECT s.rid, {values}, row_number() OVER (PARTITION BY s.rid ORDER BY "
            f"f.f_ts DESC, f.c_ts DESC NULLS LAST, f.f_id DESC) AS rn FROM s JOIN ({rows}) f "
            f"ON {on} AND f.f_ts <= s.{ts}{low})"
        )
        joins.append(f"LEFT JOIN m{i} ON m{i}.rid = s.rid AND m{i}.rn = 1")
        columns += [f"m{i}.{c} AS {name}__{c}" for c in features]
    return f"WITH {', '.join(ctes)} SELECT {', '.join(columns)} FROM s {' '.join(joins)}"


SPINE = "event_id, user_id, ts"
KIND_SPINE = "event_id, user_id, event_type, ts"
USER, USER_TYPE, VALUE = ["user_id"], ["user_id", "event_type"], ["value"]
CLICKS = ("clicks", _of("click"), USER, DAY, VALUE)

ORACLE["asof_single"] = _asof(PURCHASES, SPINE, [CLICKS])
ORACLE["asof_broadcast"] = ORACLE["asof_single"]
ORACLE["asof_composite"] = _asof(ODD, KIND_SPINE, [("even", EVEN, USER_TYPE, DAY, VALUE)])
ORACLE["asof_no_max_age"] = _asof(ODD, KIND_SPINE, [("even", EVEN, USER_TYPE, None, VALUE)])
ORACLE["asof_bucketed"] = ORACLE["asof_composite"]
ORACLE["asof_history"] = ORACLE["asof_no_max_age"]
ORACLE["asof_history_days"] = _asof(
    f"SELECT * FROM ({ODD}) WHERE isodow(ts) = 7",
    KIND_SPINE,
    [("even", EVEN, USER_TYPE, None, VALUE)],
)
_HOT = "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id) FROM"
# DuckDB's own as-of join: ranking all pairs of a hot key would take hours at larger scale.
ORACLE["asof_hot_key"] = (
    f"WITH s AS ({_HOT} ({ODD})), f AS ({_HOT} ({EVEN})) "
    f"SELECT s.event_id, s.user_id, s.event_type, s.ts, f.value AS even__value "
    f"FROM s ASOF LEFT JOIN f ON s.user_id = f.user_id AND s.ts >= f.f_ts"
)
_TIED = (
    f"SELECT event_id, user_id, value, f_ts, c_ts, f_id FROM ({_of('click')}) UNION ALL "
    f"SELECT event_id, user_id, value * 2, f_ts, c_ts + INTERVAL 10 MINUTE, f_id "
    f"FROM ({_of('click')})"
)
ORACLE["asof_tie_created"] = _asof(PURCHASES, SPINE, [("clicks", _TIED, USER, DAY, VALUE)])
_EDGE = " UNION ALL ".join(
    f"SELECT event_id * 3 + {i} AS spine_id, user_id, ts + INTERVAL {us} MICROSECOND AS ts "
    f"FROM events WHERE event_type = 'click'"
    for i, us in enumerate([0, DAY * 1_000_000, DAY * 1_000_000 + 1])
)
ORACLE["asof_edge"] = _asof(_EDGE, "spine_id, user_id, ts", [CLICKS])
ORACLE["asof_multi"] = _asof(
    PURCHASES,
    SPINE,
    [
        CLICKS,
        ("views", _of("view"), USER, DAY // 4, VALUE),
        ("errors", _of("error"), USER, None, VALUE),
    ],
)
ORACLE["asof_mixed_keys"] = _asof(
    ODD, KIND_SPINE, [("even", EVEN, USER_TYPE, DAY // 2, VALUE), CLICKS]
)
ORACLE["asof_dup_spine"] = _asof(f"{PURCHASES} UNION ALL {PURCHASES}", SPINE, [CLICKS])
ORACLE["asof_subset_keys"] = _asof(ODD, KIND_SPINE, [("even", EVEN, USER, DAY, VALUE)])
_GAPS = "CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END"
ORACLE["asof_null_features"] = _asof(
    PURCHASES,
    SPINE,
    [("clicks", f"SELECT * REPLACE ({_GAPS} AS value) FROM ({_of('click')})", USER, DAY, VALUE)],
)
_NO_KEY = "SELECT * REPLACE (CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id END AS user_id)"
ORACLE["asof_null_keys"] = _asof(
    f"{_NO_KEY} FROM ({PURCHASES})",
    SPINE,
    [("clicks", f"{_NO_KEY} FROM ({_of('click')})", USER, DAY, VALUE)],
)
ORACLE["asof_float"] = _asof(
    PURCHASES,
    SPINE,
    [
        (
            "clicks",
            f"SELECT * REPLACE (CAST(value AS FLOAT) AS value) FROM ({_of('click')})",
            USER,
            DAY,
            VALUE,
        )
    ],
)
ORACLE["asof_customer_orders"] = _asof(
    "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'F'",
    "o_orderkey, o_custkey, o_orderdate",
    [
        (
            "open_orders",
            "SELECT *, o_orderdate AS f_ts, o_orderdate AS c_ts, o_orderkey AS f_id FROM orders "
            "WHERE o_orderstatus = 'O'",
            ["o_custkey"],
            365 * DAY,
            ["o_totalprice", "o_orderpriority"],
        )
    ],
    ts="o_orderdate",
)
ORACLE["nearest_rows"] = f"""
WITH s AS (SELECT DISTINCT user_id, ts FROM ({PURCHASES})),
j AS (
  SELECT f.value, s.user_id, f.f_ts AS event_timestamp, f.c_ts AS created_timestamp,
    s.ts AS event_timestamp_entity,
    row_number() OVER (PARTITION BY s.user_id, s.ts ORDER BY f.f_ts DESC, f.c_ts DESC, f.f_id DESC) AS rn
  FROM s JOIN ({_of('click')}) f ON s.user_id = f.user_id AND f.f_ts <= s.ts
    AND s.ts - f.f_ts <= INTERVAL 1 DAY)
SELECT value, user_id, event_timestamp, created_timestamp, event_timestamp_entity
FROM j WHERE rn = 1"""
ORACLE["spine_range"] = f"""
WITH s AS (SELECT min(ts) AS lo, max(ts) AS hi FROM ({PURCHASES})
  WHERE ts >= '2024-01-10' AND ts < '2024-01-12')
SELECT count(*) AS kept FROM events, s
WHERE event_type = 'click' AND ts >= lo - INTERVAL 1 DAY AND ts <= hi"""
ORACLE["feature_refs"] = _asof(
    PURCHASES,
    SPINE,
    [
        ("clicks", _of("click"), USER, DAY, ["value", "props"]),
        ("views", _of("view"), USER, DAY, ["value"]),
    ],
)
ORACLE["epoch_export"] = f"""
SELECT event_id, user_id, epoch_us(ts) // 1000000 AS ts FROM ({PURCHASES})"""

_WINDOW = "ts >= '2024-01-05' AND ts < '2024-01-10'"
ORACLE["time_range_scan"] = f"SELECT event_id, ts, value FROM events WHERE {_WINDOW}"
ORACLE["partition_scan"] = (
    f"SELECT event_id, ts, value, CAST(ts AS DATE) AS date FROM events WHERE {_WINDOW}"
)
ORACLE["staged_spine"] = f"""
SELECT event_id, user_id, date_trunc('millisecond', ts) AS ts, CAST(ts AS DATE) AS partition_date
FROM ({PURCHASES})"""
ORACLE["field_mapping"] = """
SELECT event_id, ts, user_id, event_type, value AS amount, upper(event_type) AS props,
  value * 2 + 1 AS amount_scaled FROM events"""
ORACLE["input_projection"] = """
SELECT CAST(user_id AS INTEGER) AS user_id, CAST(trunc(value) AS BIGINT) AS whole_amount,
  CAST(event_id AS DOUBLE) AS id_number, CAST(hour(ts) AS INTEGER) AS hour_of_day,
  event_type AS kind, ts FROM events"""
ORACLE["entity_keys"] = """
SELECT event_id, md5('default#event_type#user_id:' || event_type || '#' || user_id) AS entity_key,
  event_type || '#' || user_id AS sorted_key, user_id || '#' || event_type AS declared_key
FROM events"""

FLAWED = """
SELECT event_id, CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id END AS user_id,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE ts END AS ts, event_type,
  CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value FROM events"""
_OK = "(user_id IS NOT NULL AND ts IS NOT NULL AND coalesce(value >= 1 AND value <= 100, FALSE))"
ORACLE["valid_rows"] = f"SELECT * FROM ({FLAWED}) WHERE {_OK}"
ORACLE["rejected_rows"] = f"SELECT * FROM ({FLAWED}) WHERE NOT {_OK}"
ORACLE["valid_counts"] = f"""
SELECT count(*) AS rows_read, count(*) FILTER ({_OK}) AS rows_ingested,
  count(*) FILTER (NOT {_OK}) AS rows_rejected FROM ({FLAWED})"""
_KINDS = "('click', 'view', 'purchase')"
ORACLE["suite_violations"] = f"""
SELECT 'expect_column_values_to_be_between_value_1_100' AS check_name,
  count(*) FILTER (value < 1 OR value > 100) AS violations, CAST(0 AS BIGINT) AS errored
FROM ({FLAWED}) UNION ALL
SELECT 'expect_column_values_to_be_in_set_event_type',
  count(*) FILTER (event_type NOT IN {_KINDS}), 0 FROM ({FLAWED}) UNION ALL
SELECT 'expect_column_values_to_not_be_null_value', count(*) FILTER (value IS NULL), 0
FROM ({FLAWED}) UNION ALL
SELECT 'expect_column_values_to_not_be_null_absent', 0, count(*) FROM ({FLAWED})"""
ORACLE["suite_observed"] = f"""
SELECT 'expect_column_mean_to_be_between_value_0_10' AS check_name,
  CAST(CASE WHEN avg(value) BETWEEN 0 AND 10 THEN 0 ELSE trunc(avg(value) * 100) END AS BIGINT)
    AS observed FROM ({FLAWED}) UNION ALL
SELECT 'expect_column_max_to_be_between_value_0_100000',
  CAST(CASE WHEN max(value) BETWEEN 0 AND 100000 THEN 0 ELSE trunc(max(value) * 100) END AS BIGINT)
FROM ({FLAWED}) UNION ALL
SELECT 'expect_column_min_to_be_between_value_5',
  CAST(CASE WHEN min(value) >= 5 THEN 0 ELSE trunc(min(value) * 100) END AS BIGINT)
FROM ({FLAWED})"""
ORACLE["suite_rows"] = f"""
SELECT * FROM ({FLAWED}) WHERE value >= 1 AND value <= 100 AND event_type IN {_KINDS}"""
ORACLE["validation_function"] = """
SELECT event_id, event_type, value FROM events
WHERE value BETWEEN 1 AND 100 AND event_type IN ('click', 'view')"""

ORACLE["latest_row_per_key"] = """
SELECT user_id, event_type, ts, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""


def _log(value: str) -> str:
    """Applied rows of the three batches, one per key and batch."""
    return f"""
l AS (
  SELECT user_id, event_type, event_id, ts, {value} AS value,
    CASE WHEN ts < '2024-01-10' THEN 1 WHEN ts < '2024-01-20' THEN 0 ELSE 2 END AS seq
  FROM events),
c AS (SELECT * FROM l QUALIFY row_number() OVER (
  PARTITION BY user_id, event_type, seq ORDER BY ts DESC, event_id DESC) = 1),
a AS (SELECT * FROM c QUALIFY ts >= coalesce(max(ts) OVER (PARTITION BY user_id, event_type
  ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ts))"""


_GAPPY = "CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END"
_MERGED = """
arg_max(value, seq) FILTER (value IS NOT NULL) AS value, arg_max(event_id, seq) AS event_id,
max(ts) AS event_timestamp"""
_REPLACED = """
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, seq DESC) = 1"""
ORACLE["upsert_last_writer"] = f"""
WITH {_log('value')} SELECT user_id, event_type, {_MERGED} FROM a GROUP BY user_id, event_type"""
ORACLE["upsert_null_merge"] = f"""
WITH {_log(_GAPPY)} SELECT user_id, event_type, {_MERGED} FROM a GROUP BY user_id, event_type"""
ORACLE["upsert_row_replace"] = f"""
WITH {_log(_GAPPY)} SELECT user_id, event_type, value, event_id, ts AS event_timestamp,
  ts + INTERVAL 2 DAY AS expiry FROM c {_REPLACED}"""
ORACLE["compacted_store"] = f"""
WITH {_log(_GAPPY)} SELECT user_id, event_type, {_MERGED}, max(ts) + INTERVAL 2 DAY AS expiry
FROM a GROUP BY user_id, event_type"""
ORACLE["stream_ingestion"] = f"""
WITH {_log('value')} SELECT user_id, event_type, {_MERGED}, max(ts) + INTERVAL 2 DAY AS expiry
FROM a GROUP BY user_id, event_type"""
ORACLE["expiry_shared"] = """
WITH e AS (
  SELECT user_id, max(ts) + INTERVAL 1 DAY AS expiry FROM events WHERE event_type = 'click'
  GROUP BY user_id UNION ALL
  SELECT user_id, max(ts) + INTERVAL 3 DAY FROM events WHERE event_type = 'view' GROUP BY user_id
  UNION ALL SELECT user_id, NULL FROM events WHERE event_type = 'error'),
s AS (SELECT user_id, max(ts) + INTERVAL 2 DAY AS again FROM events WHERE event_type = 'signup' GROUP BY user_id),
x AS (SELECT user_id, count(*) = count(expiry) AS kept, max(expiry) AS expiry FROM e GROUP BY user_id)
SELECT coalesce(x.user_id, s.user_id) AS user_id,
  CASE WHEN x.kept THEN greatest(x.expiry, s.again) ELSE s.again END AS expiry
FROM x FULL JOIN s ON s.user_id = x.user_id"""
ORACLE["expiry_jitter"] = """
SELECT count(*) AS keys, count(*) AS within, TRUE AS spread
FROM (SELECT DISTINCT user_id, event_type FROM events)"""
ORACLE["packed_rows"] = "SELECT event_id, event_type, value, ts FROM events"
ORACLE["online_lookup"] = """
WITH c AS (SELECT * FROM events WHERE event_type = 'click'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1),
v AS (SELECT * FROM events WHERE event_type = 'view'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1),
r AS (SELECT DISTINCT user_id FROM events UNION ALL SELECT DISTINCT -user_id - 1 FROM events)
SELECT r.user_id,
  CASE WHEN c.ts >= TIMESTAMP '2024-01-30' THEN c.value END AS clicks__value,
  CASE WHEN c.ts IS NULL THEN 'NOT_FOUND' WHEN c.ts >= TIMESTAMP '2024-01-30' THEN 'PRESENT'
    ELSE 'OUTSIDE_MAX_AGE' END AS clicks__status,
  CASE WHEN v.ts >= TIMESTAMP '2024-01-28' THEN v.value END AS views__value,
  CASE WHEN v.ts IS NULL THEN 'NOT_FOUND' WHEN v.ts >= TIMESTAMP '2024-01-28' THEN 'PRESENT'
    ELSE 'OUTSIDE_MAX_AGE' END AS views__status
FROM r LEFT JOIN c ON r.user_id = c.user_id LEFT JOIN v ON r.user_id = v.user_id"""
_LAST_DAYS = f"SELECT * FROM ({FLAWED}) WHERE ts >= '2024-01-26' AND ts < '2024-01-31'"
_KEPT = "(user_id IS NOT NULL AND coalesce(value >= 1 AND value <= 100, FALSE))"
ORACLE["batch_ingestion"] = f"""
SELECT user_id, value, event_id, ts, TRUE AS kept FROM ({_LAST_DAYS}) WHERE {_KEPT}
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1
UNION ALL SELECT user_id, value, event_id, ts, FALSE FROM ({_LAST_DAYS}) WHERE NOT {_KEPT}"""
_PERCENTILES = ["p50", "p75", "p95", "p98", "p99", "p999"]
ORACLE["lag_figures"] = f"""
WITH l AS (SELECT epoch_us(TIMESTAMP '2024-01-31' - ts) // 1000 AS lag FROM events)
SELECT count(lag) AS lag_count, min(lag) AS lag_min, max(lag) AS lag_max, avg(lag) AS lag_mean,
  stddev_samp(lag) AS lag_stddev, {", ".join(f"TRUE AS {p}_within" for p in _PERCENTILES)} FROM l"""
ORACLE["table_freshness"] = """
WITH t(feature_table, max_age) AS (
  VALUES ('click', 3600), ('view', 86400), ('signup', NULL), ('purchase', 1800), ('refund', 60)),
e AS (SELECT event_type, max(ts) AS last_event FROM events GROUP BY event_type)
SELECT feature_table, last_event, coalesce(
  last_event >= TIMESTAMP '2024-01-31' - max_age * INTERVAL 1 SECOND, TRUE) AS passed
FROM t LEFT JOIN e ON event_type = feature_table"""
ORACLE["decode_json"] = (
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"
)
ORACLE["decode_malformed"] = """
SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN
  CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k FROM events"""
ORACLE["nested_mapping"] = (
    "SELECT user_id, value AS amount, event_type AS kind, event_id AS id, ts FROM events"
)
_STORED = f"""SELECT * FROM ({FLAWED}) WHERE user_id IS NOT NULL AND ts IS NOT NULL
  {{}} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1"""
ORACLE["stream_refused"] = f"""
SELECT user_id, value, event_id, ts AS event_timestamp, CAST(NULL AS TIMESTAMP) AS expiry
FROM ({_STORED.format('AND value <= 50')})"""
ORACLE["stream_kept"] = f"""
SELECT user_id, event_id, 'stored' AS place FROM ({_STORED.format('')}) UNION ALL
SELECT user_id, event_id, 'rejected' FROM ({FLAWED})
WHERE user_id IS NULL OR ts IS NULL OR value IS NULL OR value > 50"""

for _name in ("asof_partitioned", "training_set_output", "dict_retrieval", "table_source", "staged_rows"):
    ORACLE[_name] = ORACLE["asof_single"]
ORACLE["asof_hot_measured"] = ORACLE["asof_hot_key"]
ORACLE["schema_registry"] = ORACLE["packed_rows"]
ORACLE["schema_report"] = """
SELECT * FROM (VALUES ('props', 'bigint', 'string', 'type'), ('absent', 'string', NULL, 'missing'))
AS t(field, declared, found, problem) WHERE EXISTS (SELECT 1 FROM events)"""
ORACLE["gc_threshold"] = """
SELECT user_id, event_type, max(ts) + INTERVAL 5 DAY AS expiry FROM events GROUP BY user_id, event_type"""
ORACLE["table_health"] = """
WITH t(feature_table, max_age) AS (VALUES ('click', 3600), ('view', 86400), ('signup', 60), ('refund', 60)),
e AS (SELECT event_type, max(ts) AS last_event FROM events GROUP BY event_type)
SELECT feature_table, CASE WHEN last_event < TIMESTAMP '2024-01-31' - max_age * INTERVAL 1 SECOND
  THEN 'failed' ELSE 'passed' END AS state FROM t LEFT JOIN e ON event_type = feature_table"""
ORACLE["entity_repartition"] = """
SELECT count(DISTINCT user_id) AS keys, TRUE AS few_files FROM events WHERE event_type = 'click'"""
ORACLE["stream_progress"] = """
SELECT count(DISTINCT (user_id, event_type)) AS keys, count(*) AS rows, TRUE AS has_batches FROM events"""
_SUITE_OK = "AND value >= 1 AND value <= 100 AND event_type IN ('click', 'view', 'purchase')"
ORACLE["stream_suite"] = f"""
SELECT user_id, value, event_id, event_type, ts AS event_timestamp, CAST(NULL AS TIMESTAMP) AS expiry
FROM ({_STORED.format(_SUITE_OK)})"""
ORACLE["stream_report"] = f"""
WITH f AS (SELECT *, CASE WHEN t < '2024-01-10' THEN 1 WHEN t < '2024-01-20' THEN 0 ELSE 2 END AS part,
    user_id IS NOT NULL AND ts IS NOT NULL {_SUITE_OK} AS good
  FROM ({FLAWED}) JOIN (SELECT event_id, ts AS t FROM events) USING (event_id)),
g AS (SELECT part, count(*) AS read, count(*) FILTER (coalesce(good, FALSE)) AS ingested,
    count(*) FILTER (NOT coalesce(good, FALSE)) AS rejected,
    count(*) FILTER (NOT (value >= 1 AND value <= 100)) AS between_,
    count(*) FILTER (event_type NOT IN ('click', 'view', 'purchase')) AS in_set,
    count(*) FILTER (value IS NULL) AS nulls, max(t) + INTERVAL 1 MINUTE AS latest_message FROM f GROUP BY part)
SELECT part, unnest(['read', 'ingested', 'rejected', 'lagging',
  'expect_column_values_to_be_between_value_1_100', 'expect_column_values_to_be_in_set_event_type',
  'expect_column_values_to_not_be_null_value', 'expect_column_values_to_not_be_null_absent']) AS figure,
  unnest([read, ingested, rejected, ingested, between_, in_set, nulls, 0]) AS n, latest_message FROM g"""
# Two writers: clicks and the others, each the first half of the month before the second.
ORACLE["concurrent_writers"] = f"""
WITH l AS (SELECT user_id, event_type, event_id, ts, {_GAPPY} AS value,
    CASE WHEN ts < '2024-01-16' THEN 0 ELSE 1 END AS seq FROM events),
a AS (SELECT * FROM l QUALIFY row_number() OVER (
  PARTITION BY user_id, event_type, seq ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, event_type, {_MERGED}, max(ts) + INTERVAL 2 DAY AS expiry FROM a GROUP BY user_id, event_type"""
ORACLE["tiered_store"] = f"""
WITH l AS (SELECT user_id, event_type, event_id, ts, {_GAPPY} AS value,
    (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // (3 * 86400000000) AS seq FROM events),
a AS (SELECT * FROM l QUALIFY row_number() OVER (
  PARTITION BY user_id, event_type, seq ORDER BY ts DESC, event_id DESC) = 1),
m AS (SELECT user_id, event_type, {_MERGED} FROM a GROUP BY user_id, event_type),
r AS (SELECT user_id, event_type FROM m UNION ALL SELECT -user_id - 1, event_type FROM m),
x AS (SELECT r.*, value, event_id, event_timestamp IS NOT NULL AS found,
  event_timestamp >= TIMESTAMP '2024-01-31' - INTERVAL 2 DAY
    AND event_timestamp + INTERVAL 2 DAY > TIMESTAMP '2024-01-31' AS live
  FROM r LEFT JOIN m ON m.user_id = r.user_id AND m.event_type = r.event_type)
SELECT user_id, event_type, CASE WHEN live THEN value END AS latest__value,
  CASE WHEN live THEN event_id END AS latest__event_id,
  CASE WHEN NOT found THEN 'NOT_FOUND' WHEN live THEN 'PRESENT' ELSE 'OUTSIDE_MAX_AGE' END AS latest__status FROM x"""
ORACLE["point_lookup"] = ORACLE["online_lookup"].replace(
    "SELECT DISTINCT user_id FROM events UNION ALL SELECT DISTINCT -user_id - 1 FROM events",
    "SELECT min(user_id) AS user_id FROM events UNION ALL SELECT max(user_id) FROM events",
)
# Batch 0 up to the 25th, batch 1 the old events again, batch 2 the last days. What has expired
# by the 27th has no value left, but its time, which the old events do not reach.
ORACLE["expired_removed"] = f"""
WITH e AS (SELECT user_id, event_type || 's' AS feature_table, event_id, ts, {_GAPPY} AS value FROM events
  WHERE event_type IN ('click', 'view')),
b AS (SELECT *, 0 AS seq FROM e WHERE ts < '2024-01-25'
  UNION ALL SELECT *, 2 FROM e WHERE ts >= '2024-01-28'),
c AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY user_id, feature_table, seq
  ORDER BY ts DESC, value DESC NULLS LAST) = 1),
x AS (SELECT user_id, max(ts + CASE feature_table WHEN 'clicks' THEN INTERVAL 1 DAY ELSE INTERVAL 3 DAY END)
  <= TIMESTAMP '2024-01-27' AS expired FROM c WHERE seq = 0 GROUP BY user_id),
s AS (SELECT c.* FROM c LEFT JOIN x ON x.user_id = c.user_id WHERE seq = 2 OR NOT expired),
k AS (SELECT user_id, max(ts + CASE feature_table WHEN 'clicks' THEN INTERVAL 1 DAY ELSE INTERVAL 3 DAY END)
  AS expiry FROM c GROUP BY user_id)
SELECT feature_table, s.user_id, arg_max(value, seq) FILTER (value IS NOT NULL) AS value,
  max(ts) AS event_timestamp, any_value(expiry) AS expiry
FROM s JOIN k ON k.user_id = s.user_id GROUP BY feature_table, s.user_id"""
ORACLE["store_freshness"] = ORACLE["table_freshness"]
for _name in ("asof_key_filter", "asof_broadcast_spread"):
    ORACLE[_name] = ORACLE["asof_single"]
ORACLE["lag_over_days"] = """
WITH l AS (SELECT CAST(ts AS DATE) AS day, epoch_us(TIMESTAMP '2024-01-31' - ts) // 1000 AS lag FROM events),
d AS (SELECT * FROM l UNION ALL
  SELECT NULL, lag FROM l WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-14')
SELECT day, count(*) AS lag_count, min(lag) AS lag_min, max(lag) AS lag_max, TRUE AS ranks_within
FROM d GROUP BY day"""
# Three parts as stored: of the second, all rows are late, of the last none.
ORACLE["stream_redelivered"] = f"""
WITH {_log('value')}, n AS (SELECT count(*) AS messages, count(*) FILTER (ts < '2024-01-10') AS late FROM events)
SELECT user_id, event_type, {_MERGED}, max(ts) + INTERVAL 2 DAY AS expiry,
  any_value(messages) AS messages, any_value(late) AS late
FROM a, n GROUP BY user_id, event_type"""


def _shared(columns: str) -> str:
    return f"(count(*) OVER (PARTITION BY {columns}))"


_KEY, _LONG_KEY = "l_orderkey, l_linenumber", "l_orderkey, l_partkey, l_suppkey, l_shipdate"
ORACLE["unique_rows"] = f"""
SELECT l_orderkey, l_linenumber, l_extendedprice, {_shared(_KEY)} = 1 AS _unique0, {_shared('l_suppkey')} = 1 AS _unique1,
  {_shared(_LONG_KEY)} = 1 AS _unique2, CAST(NULL AS BOOLEAN) AS _unique3 FROM lineitem"""
ORACLE["unique_violations"] = f"""
WITH u AS ({ORACLE['unique_rows']})
SELECT 'expect_compound_columns_to_be_unique_l_orderkey_l_linenumber' AS check_name,
  count(*) FILTER (NOT _unique0) AS violations, CAST(0 AS BIGINT) AS errored FROM u UNION ALL
SELECT 'expect_column_values_to_be_unique_l_suppkey', count(*) FILTER (NOT _unique1), 0 FROM u UNION ALL
SELECT 'expect_compound_columns_to_be_unique_l_orderkey_l_partkey_l_suppkey_l_shipdate',
  count(*) FILTER (NOT _unique2), 0 FROM u UNION ALL
SELECT 'expect_column_values_to_be_unique_absent', 0, count(*) FROM u UNION ALL
SELECT 'expect_column_values_to_be_between_l_quantity_5_40',
  count(*) FILTER (l_quantity < 5 OR l_quantity > 40), 0 FROM lineitem"""
ORACLE["staged_swept"] = f"SELECT event_id, user_id, 1 AS swept, TRUE AS kept FROM ({PURCHASES})"
