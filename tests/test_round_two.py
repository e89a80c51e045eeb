"""Cases that an earlier version got wrong."""

from __future__ import annotations

from decimal import Decimal

import pytest

from larder.operators.shape import drop_sparse
from larder.sinks import publish_parquet
from larder.sinks.jdbc import limited_writers
from larder.sources import read_csv, read_jdbc
from larder.sources.files import infer_types
from larder.streaming import count_new_lines, merged_counts


def test_long_whole_numbers_keep_their_digits(spark):
    rows = spark.createDataFrame(
        [("1234567890123456789", "18446744073709551615", "18446744073709551616"), ("-5", "7", "1")], "a string, b string, c string"
    )
    typed = infer_types(rows)
    assert dict(typed.dtypes) == {"a": "bigint", "b": "decimal(20,0)", "c": "string"}
    assert typed.orderBy("a").collect()[1][:2] == (1234567890123456789, Decimal("18446744073709551615"))


def test_headers_in_another_order_are_an_error(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,2\n")
    (tmp_path / "two.csv").write_text("b,a\n40,4\n")
    for infer in (False, True):
        with pytest.raises(Exception, match="(?i)header"):
            read_csv(spark, str(tmp_path), infer=infer).collect()


def test_sparse_threshold_is_exact(spark):
    rows = spark.range(100).selectExpr("id", "if(id < 55, id, null) AS half")
    assert drop_sparse(rows, min_fraction=0.55).columns == ["id", "half"]
    assert drop_sparse(rows.limit(0), min_fraction=0.55).columns == ["id", "half"]


def test_a_run_is_not_replaced(spark, tmp_path):
    publish_parquet(spark.range(3), str(tmp_path), "1")
    with pytest.raises(Exception, match="(?i)exists"):
        publish_parquet(spark.range(5), str(tmp_path), "1")


def test_streams_share_an_output(spark, tmp_path):
    for name, line in (("x", "a b"), ("y", "c")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.txt").write_text(line + "\n")
        count_new_lines(spark, str(tmp_path / name), str(tmp_path / "counts"), str(tmp_path / f"check-{name}"))
    assert {row["word"] for row in merged_counts(spark, str(tmp_path / "counts")).collect()} == {"a", "b", "c"}


def test_limited_writers_keep_the_tasks_before(spark):
    plan = limited_writers(spark.range(100), 3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange RoundRobinPartitioning(3)" in plan


def test_one_task_reads_have_to_be_asked_for(spark):
    with pytest.raises(ValueError, match="one task"):
        read_jdbc(spark, "jdbc:nowhere", "t")
