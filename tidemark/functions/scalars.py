"""Scalar building blocks shared by the operators."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = dt.datetime(1970, 1, 1)


def is_timestamp(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.TimestampType, T.TimestampNTZType))


def epoch_micros(ts: Column, data_type: T.DataType) -> Column:
    """Microseconds since 1970, without going through the session time zone for NTZ."""
    if isinstance(data_type, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), ts)
    return F.unix_micros(ts)


def partition_date(column: Column, kind: T.DataType) -> Column:
    """The day that a partition value names; NULL (not to be pruned by) for anything else."""
    if isinstance(kind, T.DateType):
        return column
    if not isinstance(kind, T.StringType):
        return F.lit(None).cast("date")
    return F.when(column.rlike(r"^\d{4}-\d{2}-\d{2}$"), column.try_cast("date"))


def epoch_seconds(ts: Column, data_type: T.DataType) -> Column:
    """Whole seconds since 1970, rounded down also before 1970."""
    if not isinstance(data_type, T.TimestampNTZType):
        return F.unix_seconds(ts)
    us = epoch_micros(ts, data_type)
    return F.call_function("div", us - F.pmod(us, F.lit(1_000_000)), F.lit(1_000_000).cast("long"))


def timestamp_literal(micros: int, data_type: T.DataType) -> Column:
    """A constant of the column's own timestamp kind, so that filters on it can be pushed down."""
    if isinstance(data_type, T.TimestampNTZType):
        at = _EPOCH + dt.timedelta(microseconds=micros)
        return F.expr(f"timestamp_ntz'{at.isoformat(sep=' ', timespec='microseconds')}'")
    return F.timestamp_micros(F.lit(micros))


def utc_date(micros: int, shift_days: int = 0) -> dt.date:
    return (_EPOCH + dt.timedelta(microseconds=micros, days=shift_days)).date()


def instant(value: dt.datetime | Column, data_type: T.DataType) -> Column:
    """``value`` as a timestamp of the wanted kind; naive datetimes are read as UTC."""
    if isinstance(value, Column):
        return value
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return timestamp_literal((value - _EPOCH) // dt.timedelta(microseconds=1), data_type)


def add_seconds(ts: Column, seconds: int | Column) -> Column:
    secs = F.lit(seconds) if not isinstance(seconds, Column) else seconds
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def floor_millis(ts: Column, data_type: T.DataType) -> Column:
    """The timestamp cut to whole milliseconds, kind kept."""
    micros = F.pmod(epoch_micros(ts, data_type), F.lit(1000)).cast("int")
    return ts - F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (micros / F.lit(1_000_000)).cast("decimal(18,6)")
    )


def all_not_null(columns: Sequence[Column]) -> Column:
    check = columns[0].isNotNull()
    for c in columns[1:]:
        check = check & c.isNotNull()
    return check


def key_text(names: Sequence[str], order: str = "sorted") -> Column:
    """Key values as text joined by ``#``; names sorted, or in ``"declared"`` order."""
    if order not in ("sorted", "declared"):
        raise ValueError(f"key order must be 'sorted' or 'declared', not {order!r}")
    names = sorted(names) if order == "sorted" else names
    return F.concat_ws("#", *[F.col(n).cast("string") for n in names])


def key_bytes(names: Sequence[str], order: str = "sorted") -> Column:
    return F.encode(key_text(names, order), "UTF-8")


def entity_key(project: str, names: Sequence[str]) -> Column:
    """Hash of project, sorted entity names and their values: ``md5(project#e1#e2:v1#v2)``."""
    prefix = "#".join([project, *sorted(names)]) + ":"
    return F.md5(F.concat(F.lit(prefix), key_text(names)))


def short_name(text: str, max_length: int) -> str:
    """``text``, with the tail of an over-long one replaced by 8 hex digits of its hash."""
    keep = max_length - 8
    if keep < 0:
        raise ValueError("max_length must leave room for 8 hash digits")
    if len(text) <= max_length:
        return text
    return text[:keep] + hashlib.md5(text[keep:].encode()).hexdigest()[:8]


def identifier(text: str, max_length: int = 48) -> str:
    """A name that SQL catalogs take unquoted: shortened, with dashes replaced."""
    return short_name(text.replace("-", "_"), max_length)
