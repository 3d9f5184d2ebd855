"""Row rules, suites and the split into valid and rejected rows."""

import pytest
from conftest import rows_of

from tidemark.functions import checks
from tidemark.functions.checks import Rule
from tidemark.operators.mapping import (
    flatten,
    input_projection,
    map_fields,
    schema_differences,
)
from tidemark.operators.validate import check_counts, check_observed, split_valid
from tidemark.spec import FeatureTable, Field, FileSource, SchemaError

TABLE = FeatureTable("cars", [Field("cell", "int64")], [Field("drivers", "int32"), Field("kind", "string")])
SCHEMA = "cell bigint, drivers int, kind string, ts timestamp"
NOW = "2021-01-01 00:00:00"


def not_null(column):
    return {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": column}}


def between(column, **bounds):
    return {
        "expectation_type": "expect_column_values_to_be_between",
        "kwargs": {"column": column, **bounds},
    }


@pytest.fixture
def cars(frame):
    return frame(
        SCHEMA,
        [
            (1, 5, "car", NOW),
            (None, 5, "car", NOW),
            (2, 5, "car", None),
            (3, None, None, NOW),
            (4, 2, "bike", NOW),
            (5, 20, "car", NOW),
            (6, 21, "car", NOW),
        ],
    )


@pytest.mark.parametrize(
    ("rules", "cells"),
    [
        (None, [1, 3, 4, 5, 6]),
        ([], [1, 3, 4, 5, 6]),
        ([not_null("drivers")], [1, 4, 5, 6]),
        ([between("drivers", min_value=2, max_value=20)], [1, 4, 5]),
        ([between("drivers", min_value=20)], [5, 6]),
        ([between("drivers", max_value=5)], [1, 4]),
        ([between("drivers")], [1, 3, 4, 5, 6]),
        ('{"expectations": []}', [1, 3, 4, 5, 6]),
    ],
)
def test_checks(cars, rules, cells):
    valid, rejected = split_valid(cars, TABLE, "ts", rules)
    assert [r[0] for r in rows_of(valid, "cell")] == cells
    # Also rows under a NULL check are rejected, none is lost.
    assert valid.count() + rejected.count() == cars.count()


def test_opt_in_rule_and_unknown_rule(cars):
    valid, _ = split_valid(cars, TABLE, "ts", require_any_feature=True)
    assert [r[0] for r in rows_of(valid, "cell")] == [1, 4, 5, 6]
    with pytest.raises(ValueError):
        checks.expectations_hold([{"expectation_type": "expect_nothing", "kwargs": {}}])


@pytest.fixture
def suite():
    # Local functions travel to the workers by value.
    def broken(batch, kwargs):
        raise RuntimeError("no verdict")

    def even(batch, kwargs):
        return batch[kwargs["column"]] % 2 == 0

    bounds = {"min_value": 3, "max_value": 20}
    rules = [
        Rule("expect_column_values_to_be_between", {"column": "cars__drivers", **bounds}),
        Rule("expect_column_values_to_be_in_set", {"column": "cars__kind", "value_set": ["car"]}),
        Rule("even_cells", {"column": "cars__cell"}, even),
        Rule("broken", {"column": "cell"}, broken),
        Rule(
            "expect_column_pair_values_A_to_be_greater_than_B",
            {"column_A": "cars__drivers", "column_B": "cell"},
        ),
        Rule("expect_column_mean_to_be_between", {"column": "cars__drivers", "max_value": 1}),
        Rule("expect_column_sum_to_be_between", {"column": "cars__drivers", "min_value": 1}),
    ]
    return checks.prepare_suite(rules, "cars")


def test_suite(cars, suite):
    held = cars.filter(checks.suite_holds(suite, cars.columns))
    assert [r[0] for r in rows_of(held, "cell")] == [2]
    counts = {r[0]: (r[1], r[2]) for r in check_counts(cars, suite).collect()}
    assert counts == {
        "expect_column_values_to_be_between_drivers_3_20": (2, 0),
        "expect_column_values_to_be_in_set_kind": (1, 0),
        "even_cells_cell": (4, 0),
        "broken_cell": (0, 7),
        "expect_column_pair_values_A_to_be_greater_than_B_drivers_cell": (1, 0),
    }
    observed = {r[0]: r[1] for r in check_observed(cars, suite).collect()}
    assert observed == {
        "expect_column_mean_to_be_between_drivers_1": 966,
        "expect_column_sum_to_be_between_drivers_1": 0,
    }
    with pytest.raises(ValueError):
        checks.suite_holds([Rule("unheard_of", {"column": "cell"})], cars.columns)


def test_validation_function(cars):
    check = checks.validation_udf(lambda b: b["drivers"] > 4, cars.columns)
    assert [r[0] for r in rows_of(cars.filter(check), "cell")] == [1, 2, 5, 6, None]


def test_input_projection(spark):
    df = spark.sql(
        "SELECT '7' id, 2.9D amount, 'x' word, map('key', 5) m, named_struct('d', 1.5D) inner, "
        "array(1, 2) list, timestamp'2021-01-01' ts, 9 unused"
    )
    source = FileSource("ts", field_mapping={"n": "amount", "by_key": "m.key", "deep": "inner.d", "up": "upper(word)"})
    out = df.select(
        *input_projection(
            df.schema,
            source,
            [Field("id", "int64")],
            [
                Field("n", "int32"),
                Field("by_key", "int32"),
                Field("deep", "double"),
                Field("up", "string"),
                Field("list", "int64_list"),
            ],
        )
    )
    assert out.columns == ["id", "n", "by_key", "deep", "up", "list", "ts"]
    assert tuple(out.first())[:6] == (7, 2, 5, 1.5, "X", [1, 2])
    bad = df.select(*input_projection(df.schema, FileSource("ts"), [Field("word", "int64")], []))
    assert bad.first()["word"] is None
    with pytest.raises(SchemaError):
        input_projection(df.schema, FileSource("ts"), [Field("amount", "string")], [])


def test_field_mapping(spark):
    df = spark.sql("SELECT 1 a, 2 b, 3 c")
    out = map_fields(df, {"x": "a", "y": "a", "b": "b * 10", "sum": "a + c"})
    assert out.columns == ["x", "y", "b", "c", "sum"]
    assert tuple(out.first()) == (1, 1, 20, 3, 4)
    swapped = map_fields(df, {"a": "b", "b": "a"})
    assert dict(swapped.first().asDict()) == {"b": 1, "a": 2, "c": 3}
    assert map_fields(df, {}) is df
    nested = spark.sql("SELECT named_struct('p', 1, 'q', 'z') s, 5 k")
    assert flatten(nested, "s", ["k"]).columns == ["k", "p", "q"]


def test_schema_differences(cars):
    table = FeatureTable("cars", [Field("cell", "int32")], [Field("kind", "string"), Field("gone", "bool")])
    assert rows_of(schema_differences(cars, table)) == [
        ("cell", "int", "bigint", "type"),
        ("gone", "boolean", None, "missing"),
    ]
