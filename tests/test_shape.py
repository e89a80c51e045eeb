from __future__ import annotations

import datetime

import pytest

from larder.operators.features import assemble
from larder.operators.profile import column_profile, column_types, null_profile
from larder.operators.shape import (
    cast_columns,
    drop_if_present,
    drop_sparse,
    drop_strict,
    drop_vectors,
    fill_missing,
    keep_numeric,
    rename_columns,
    sample_rows,
)

NAN = float("nan")


@pytest.fixture
def mixed(spark):
    rows = [
        (1, 1.0, "a", True, None, datetime.date(2020, 1, 1)),
        (2, NAN, None, None, None, None),
        (None, None, "c", False, None, None),
    ]
    return spark.createDataFrame(
        rows, "whole int, `real-part` double, text string, flag boolean, nothing double, day date"
    )


def test_null_profile_counts_null_and_nan(mixed):
    found = {row["column_name"]: (row["n_missing"], row["n_present"]) for row in null_profile(mixed).collect()}
    assert found == {
        "whole": (1, 2), "real-part": (2, 1), "text": (1, 2), "flag": (1, 2), "nothing": (3, 0), "day": (2, 1),
    }


def test_profile_of_an_empty_table(mixed):
    found = null_profile(mixed.limit(0)).collect()
    assert [(row["n_missing"], row["n_present"]) for row in found] == [(0, 0)] * 6


def test_types_in_column_order(mixed):
    types = [("whole", "int"), ("real-part", "double"), ("text", "string"), ("flag", "boolean"),
             ("nothing", "double"), ("day", "date")]
    assert [tuple(row) for row in column_types(mixed).collect()] == types
    assert [tuple(row)[:2] for row in column_profile(mixed).collect()] == types


def test_wide_table_is_profiled_in_one_aggregation(spark):
    wide = spark.range(10).selectExpr(*[f"if(id < {i % 10}, id, null) as c{i}" for i in range(200)])
    found = {row["column_name"]: row["n_present"] for row in null_profile(wide).collect()}
    assert found == {f"c{i}": i % 10 for i in range(200)}
    assert len(drop_sparse(wide, min_present=5).columns) == 100


def test_drop_sparse_threshold_is_inclusive(mixed):
    assert drop_sparse(mixed, min_present=2).columns == ["whole", "text", "flag"]
    assert drop_sparse(mixed, min_present=1).columns == ["whole", "real-part", "text", "flag", "day"]
    assert drop_sparse(mixed, min_fraction=0.5).columns == ["whole", "text", "flag"]
    with pytest.raises(ValueError):
        drop_sparse(mixed)


def test_fill_replaces_null_and_nan_in_numbers_only(mixed):
    rows = [tuple(row) for row in fill_missing(mixed).collect()]
    assert rows[1][:5] == (2, 0.0, None, None, 0.0)
    assert rows[2][:5] == (0, 0.0, "c", False, 0.0)


def test_keep_numeric_drops_a_boolean_with_nulls(mixed, spark):
    assert keep_numeric(mixed).columns == ["whole", "real-part", "nothing"]
    full = spark.createDataFrame([(True, [1], "x")], "flag boolean, items array<int>, text string")
    assert keep_numeric(full).columns == ["flag"]


def test_drop(mixed):
    assert "text" not in drop_strict(mixed, "text").columns
    with pytest.raises(ValueError):
        drop_strict(mixed, "code")
    assert drop_if_present(mixed, "code", "day").columns == ["whole", "real-part", "text", "flag", "nothing"]


def test_drop_vectors(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert drop_vectors(assemble(assemble(df), ["a"], "other")).columns == ["a", "b"]


def test_rename(spark):
    df = spark.createDataFrame([(1, 2)], "`a-b-c` int, d int")
    assert rename_columns(df).columns == ["a_b_c", "d"]
    with pytest.raises(ValueError):
        rename_columns(spark.createDataFrame([(1, 2)], "`a-b` int, a_b int"))
    with pytest.raises(ValueError):
        rename_columns(spark.createDataFrame([(1, 2)], "`a-b` int, A_B int"))


def test_cast_by_name(spark):
    df = spark.createDataFrame([("1.5", "x")], "`a-1` string, b string")
    assert cast_columns(df, {"a-1": "double"}).collect()[0]["a-1"] == 1.5
    with pytest.raises(ValueError):
        cast_columns(df, {"c": "double"})


def test_sample_is_repeatable_when_ordered(spark):
    df = spark.range(1000).repartition(7)
    assert [row["id"] for row in sample_rows(df, 5, ["id"]).collect()] == [0, 1, 2, 3, 4]
    assert sample_rows(df, 5).count() == 5
    assert sample_rows(df, 5000).count() == 1000
