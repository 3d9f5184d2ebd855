"""Row rules as boolean columns: presence, declared expectations, validation suites."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import all_not_null
from tidemark.spec import FeatureTable


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def entities_present(table: FeatureTable) -> Column:
    return all_not_null([_column(n) for n in table.entity_names])


def timestamp_present(event_ts: str) -> Column:
    return _column(event_ts).isNotNull()


def any_feature_present(table: FeatureTable) -> Column:
    """Opt-in rule: at least one feature has a value."""
    present = [_column(n).isNotNull() for n in table.feature_names]
    return reduce(lambda a, b: a | b, present, F.lit(False))


def not_null(column: str) -> Column:
    return _column(column).isNotNull()


def between(column: str, min_value=None, max_value=None) -> Column:
    """Both bounds included, either may be missing; NULL for a NULL value under a bound."""
    checks = []
    if min_value is not None:
        checks.append(_column(column) >= F.lit(min_value))
    if max_value is not None:
        checks.append(_column(column) <= F.lit(max_value))
    return reduce(lambda a, b: a & b, checks) if checks else F.lit(True)


def in_set(column: str, value_set: Sequence[Any]) -> Column:
    return _column(column).isin(list(value_set))


def greater_pair(column_A: str, column_B: str, or_equal: bool = False) -> Column:
    a, b = _column(column_A), _column(column_B)
    return a >= b if or_equal else a > b


# Names under which rules are declared.
_NOT_NULL = "expect_column_values_to_not_be_null"
_BETWEEN = "expect_column_values_to_be_between"
_IN_SET = "expect_column_values_to_be_in_set"
_PAIR_GREATER = "expect_column_pair_values_A_to_be_greater_than_B"
_MEAN = "expect_column_mean_to_be_between"
_MIN = "expect_column_min_to_be_between"
_MAX = "expect_column_max_to_be_between"
_SUM = "expect_column_sum_to_be_between"
_STDEV = "expect_column_stdev_to_be_between"


def _from_kwargs(expectation_type: str, kwargs: Mapping[str, Any]) -> Column | None:
    """The rule as a column, or None for a type without a native form."""
    if expectation_type == _NOT_NULL:
        return not_null(kwargs["column"])
    if expectation_type == _BETWEEN:
        return between(kwargs["column"], kwargs.get("min_value"), kwargs.get("max_value"))
    if expectation_type == _IN_SET:
        return in_set(kwargs["column"], kwargs["value_set"])
    if expectation_type == _PAIR_GREATER:
        return greater_pair(kwargs["column_A"], kwargs["column_B"], kwargs.get("or_equal", False))
    return None


def expectation(spec: Mapping[str, Any]) -> Column:
    """A declared table rule ``{"expectation_type": ..., "kwargs": {...}}`` as a column."""
    kind = spec["expectation_type"]
    if kind not in (_NOT_NULL, _BETWEEN):
        raise ValueError(f"unknown expectation {kind!r}")
    return _from_kwargs(kind, spec["kwargs"])


def expectations_hold(specs: Sequence[Mapping[str, Any]] | str | None) -> Column:
    """All declared rules; TRUE without any. Also takes the JSON kept in a table's labels."""
    if isinstance(specs, str):
        specs = json.loads(specs)
    if isinstance(specs, Mapping):
        specs = specs.get("expectations")
    return reduce(lambda a, b: a & b, map(expectation, specs or []), F.lit(True))


def all_checks(
    table: FeatureTable, event_ts: str, specs=None, require_any_feature: bool = False
) -> Column:
    """Keys and time are there and every rule holds; a rule that yields NULL does not hold."""
    check = entities_present(table) & timestamp_present(event_ts) & expectations_hold(specs)
    if require_any_feature:
        check = check & any_feature_present(table)
    return F.coalesce(check, F.lit(False))


@dataclass(frozen=True)
class Rule:
    """One rule of a validation suite. NULL values pass every rule but not-null.

    ``function`` serves types without a native form: it gets the batch and the arguments and
    returns one boolean per row.
    """

    expectation_type: str
    kwargs: Mapping[str, Any]
    function: Callable[[pd.DataFrame, Mapping[str, Any]], pd.Series] | None = None

    @property
    def name(self) -> str:
        words = []
        for v in self.kwargs.values():
            if isinstance(v, (str, int, float)):
                words.append(str(v))
            elif self.expectation_type in UNIQUE_RULES:
                words += map(str, v)
        return "_".join([self.expectation_type, *words])


def prepare_suite(rules: Sequence[Rule], table_name: str) -> list[Rule]:
    """Rules written against a training set: ``table__`` prefixes of column names are dropped."""
    prefix = f"{table_name}__"
    out = []
    for rule in rules:
        kwargs = dict(rule.kwargs)
        for k in ("column", "column_A", "column_B"):
            if k in kwargs:
                kwargs[k] = kwargs[k].removeprefix(prefix)
        if "column_list" in kwargs:
            kwargs["column_list"] = [c.removeprefix(prefix) for c in kwargs["column_list"]]
        out.append(Rule(rule.expectation_type, kwargs, rule.function))
    return out


def validation_udf(function: Callable[[pd.DataFrame], pd.Series], columns: Sequence[str]) -> Column:
    """A user function over whole Arrow batches (DataFrame in, one boolean per row out)."""

    def run(batch: pd.DataFrame) -> pd.Series:
        return pd.Series(function(batch)).astype("boolean")

    return F.pandas_udf(run, T.BooleanType())(F.struct(*[_column(c) for c in columns]))


def _guarded(rule: Rule) -> Callable[[pd.DataFrame], pd.Series]:
    """A rule that raises marks no row: NULL tells 'not evaluated' from 'valid'."""

    function, kwargs = rule.function, dict(rule.kwargs)

    def run(batch: pd.DataFrame) -> pd.Series:
        try:
            return pd.Series(function(batch, kwargs)).reset_index(drop=True)
        except Exception:
            return pd.Series([None] * len(batch), dtype="boolean")

    return run


def row_rule(rule: Rule, columns: Sequence[str]) -> Column | None:
    """A rule as a column: TRUE, FALSE, or NULL where it could not be evaluated.

    None for a rule about a whole table (see ``AGGREGATE_RULES``, ``UNIQUE_RULES``).
    """
    if rule.expectation_type in AGGREGATE_RULES or rule.expectation_type in UNIQUE_RULES:
        return None
    named = [v for k, v in rule.kwargs.items() if k in ("column", "column_A", "column_B")]
    if rule.function is not None:
        return validation_udf(_guarded(rule), columns)
    if any(n not in columns for n in named):
        return F.lit(None).cast("boolean")
    native = _from_kwargs(rule.expectation_type, rule.kwargs)
    if native is None:
        raise ValueError(f"no native form of {rule.expectation_type!r}: give the rule a function")
    return F.coalesce(native, F.lit(True))


def suite_holds(rules: Sequence[Rule], columns: Sequence[str]) -> Column:
    """Rows that break no rule of the suite; a rule that could not be evaluated breaks none."""
    checks = [row_rule(r, columns) for r in rules]
    held = [F.coalesce(c, F.lit(True)) for c in checks if c is not None]
    return reduce(lambda a, b: a & b, held, F.lit(True))


# Rules that no two rows may break together, by the argument that names the columns.
UNIQUE_RULES = {
    "expect_column_values_to_be_unique": "column",
    "expect_compound_columns_to_be_unique": "column_list",
}


def unique_columns(rule: Rule) -> list[str]:
    """The columns whose values a uniqueness rule forbids to occur twice together."""
    named = rule.kwargs[UNIQUE_RULES[rule.expectation_type]]
    return [named] if isinstance(named, str) else list(named)


# Rules about a whole column, by the aggregate they bound.
AGGREGATE_RULES: dict[str, Callable[[str], Column]] = {
    _MEAN: lambda c: F.avg(_column(c)),
    _MIN: lambda c: F.min(_column(c)),
    _MAX: lambda c: F.max(_column(c)),
    _SUM: lambda c: F.sum(_column(c)),
    _STDEV: lambda c: F.stddev_samp(_column(c)),
}
