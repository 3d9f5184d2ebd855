"""Checks over whole DataFrames: the valid/rejected split and violation figures."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.checks import AGGREGATE_RULES, UNIQUE_RULES, Rule, all_checks, row_rule, unique_columns
from tidemark.operators.mapping import quoted
from tidemark.operators.unions import union_rows
from tidemark.spec import FeatureTable

IS_VALID = "_is_valid"


def split_valid(
    df: DataFrame, table: FeatureTable, event_ts: str, specs=None, **options
) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all checks, and exactly the others."""
    check = all_checks(table, event_ts, specs, **options)
    return df.filter(check), df.filter(~check)


def _repeated(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of ``columns`` that occur in more than one row, with their number. Counted where the
    rows are first, so that a value that most rows have is one row per task."""
    some = reduce(lambda a, b: a | b, [quoted(c).isNotNull() for c in columns])
    return df.filter(some).groupBy(*[quoted(c) for c in columns]).count().filter("count > 1")


def unique_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per uniqueness rule: rows that share their values with another, and rows it could not be
    evaluated on. Rows with NULL in all of its columns break none."""
    found = []
    for rule in rules:
        if rule.expectation_type in UNIQUE_RULES:
            columns, name = unique_columns(rule), F.lit(rule.name).alias("check_name")
            none = F.lit(0).cast("bigint")
            if set(columns) <= set(df.columns):
                counts = _repeated(df, columns).agg(F.coalesce(F.sum("count"), none).alias("violations"))
                found.append(counts.select(name, "violations", none.alias("errored")))
            else:
                found.append(df.agg(F.count("*").alias("errored")).select(name, none.alias("violations"), "errored"))
    return union_rows(found)


def mark_unique(df: DataFrame, rules: Sequence[Rule], column: str = "_unique") -> DataFrame:
    """``df`` with ``_unique<n>`` for the n-th uniqueness rule: whether the row keeps it, NULL where
    the rule could not be evaluated.

    Only repeated values are joined, one row each; adaptive execution divides a frequent one.
    """
    mine = [r for r in rules if r.expectation_type in UNIQUE_RULES]
    for i, rule in enumerate(mine):
        columns = unique_columns(rule)
        if not set(columns) <= set(df.columns):
            df = df.withColumn(f"{column}{i}", F.lit(None).cast("boolean"))
            continue
        names = [f"_tm_key{n}" for n in range(len(columns))]
        again = _repeated(df, columns).select(
            *[quoted(c).alias(n) for c, n in zip(columns, names)], F.lit(True).alias("_tm_again")
        )
        same = reduce(lambda a, b: a & b, [quoted(c).eqNullSafe(F.col(n)) for c, n in zip(columns, names)])
        df = df.join(again, same, "left").withColumn(f"{column}{i}", F.col("_tm_again").isNull()).drop(*names, "_tm_again")
    return df


def check_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per rule of a suite about rows: rows that break it, and rows it could not be evaluated on."""
    rules, unique = (
        [r for r in rules if (r.expectation_type in UNIQUE_RULES) == several] for several in (False, True)
    )
    if unique:
        several = unique_counts(df, unique)
        return union_rows([check_counts(df, rules), several]) if rules else several
    checks = [(r, row_rule(r, df.columns)) for r in rules]
    named = [(r.name, c) for r, c in checks if c is not None]
    flags = df.select(*[c.alias(f"c{i}") for i, (_, c) in enumerate(named)])
    totals = flags.agg(
        *[F.count_if(~F.col(f"c{i}")).alias(f"n{i}") for i in range(len(named))],
        *[F.count_if(F.col(f"c{i}").isNull()).alias(f"e{i}") for i in range(len(named))],
    )
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.col(f"n{i}").alias("violations"),
            F.col(f"e{i}").alias("errored"),
        )
        for i, (name, _) in enumerate(named)
    ]
    return totals.select(F.inline(F.array(*rows)))


def check_observed(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per whole-column rule: 100 times the observed value as an integer, 0 when it is in bounds."""
    bounded = [r for r in rules if r.expectation_type in AGGREGATE_RULES]
    values = df.agg(
        *[
            AGGREGATE_RULES[r.expectation_type](r.kwargs["column"]).cast("double").alias(f"v{i}")
            for i, r in enumerate(bounded)
        ]
    )
    rows = []
    for i, rule in enumerate(bounded):
        low, high = rule.kwargs.get("min_value"), rule.kwargs.get("max_value")
        value, holds = F.col(f"v{i}"), F.lit(True)
        if low is not None:
            holds = holds & (value >= F.lit(low))
        if high is not None:
            holds = holds & (value <= F.lit(high))
        shown = F.when(F.coalesce(holds, F.lit(False)), F.lit(0).cast("long")).otherwise(
            (value * 100).cast("long")
        )
        rows.append(F.struct(F.lit(rule.name).alias("check_name"), shown.alias("observed")))
    return values.select(F.inline(F.array(*rows)))
