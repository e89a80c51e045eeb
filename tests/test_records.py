"""CSV records read by splits, against Spark's one-task reading and Python's csv module."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.errors import PySparkException

from larder.sources import read_csv, read_quoted_csv
from larder.sources import records
from larder.sources.records import quote_state

TITLES = ["id", "note", "more"]


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.fixture
def small_splits(spark):
    """Splits of 64 bytes, so that records, pieces and quotes lie across many of them."""
    names = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def field(rng: random.Random) -> str:
    pieces = ["a", "bc", " ", '"', ",", "\n", "\n\n", "é", "\r\n", '""', "12", '",', ',"', "\n\""]
    return "".join(rng.choice(pieces) for _ in range(rng.choice([0, 1, 2, 5, 40])))


def write(path, table, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator=end).writerows([TITLES, *table])


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_split_reading_equals_the_file(spark, tmp_path, small_splits, seed, end):
    rng = random.Random(seed)
    table = [[str(i), field(rng), field(rng)] for i in range(120)]
    path = str(tmp_path / "in.csv")
    write(path, table, end)
    found = read_quoted_csv(spark, path)
    assert records.split_lines(spark, path).rdd.getNumPartitions() > 20
    assert rows(found) == sorted(((i, a or None, b or None) for i, a, b in table), key=repr)
    if end == "\n":
        assert rows(found) == rows(read_csv(spark, path, multiline=True))


def test_one_record_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f'line {i} "quoted", and more' for i in range(300))
    table = [["1", "x", "y"], ["2", long, long], ["3", "", "z"]]
    write(tmp_path / "in.csv", table)
    found = read_quoted_csv(spark, str(tmp_path / "in.csv"), "id int, note string, more string")
    assert rows(found) == [(1, "x", "y"), (2, long, long), (3, None, "z")]


def test_states_joined_by_a_shuffle(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(records, "BROADCAST_SPLITS", 0)
    rng = random.Random(9)
    table = [[str(i), field(rng), field(rng)] for i in range(60)]
    write(tmp_path / "in.csv", table)
    found = read_quoted_csv(spark, str(tmp_path / "in.csv"))
    assert rows(found) == sorted(((i, a or None, b or None) for i, a, b in table), key=repr)


def test_many_files_and_stray_quotes(spark, tmp_path, small_splits):
    for i in range(3):
        text = f'id,note,more\n{i},5" pipe,"two\nlines"\n\n{i + 10},x"y"z,"a ""b"""\n'
        (tmp_path / f"{i}.csv").write_text(text)
    expected = [(str(i), '5" pipe', "two\nlines") for i in range(3)] + [(str(i + 10), 'x"y"z', 'a "b"') for i in range(3)]
    assert rows(read_quoted_csv(spark, str(tmp_path))) == sorted(expected, key=repr)


def test_headers_must_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note\n1,x\n")
    (tmp_path / "b.csv").write_text("note,id\nx,1\n")
    with pytest.raises(PySparkException, match="header"):
        read_quoted_csv(spark, str(tmp_path)).collect()
    with pytest.raises(ValueError, match="header"):
        read_quoted_csv(spark, str(tmp_path / "a.csv"), "note string, id int")


def test_types_header_only_and_empty(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('﻿id,note\n1,"two\nlines"\n22,\n', encoding="utf-8")
    found = read_quoted_csv(spark, str(path), infer=True)
    assert found.dtypes == [("id", "bigint"), ("note", "string")]
    assert rows(found) == [(1, "two\nlines"), (22, None)]
    path.write_text("id,note\n")
    assert rows(read_quoted_csv(spark, str(path))) == []
    path.write_text("")
    assert rows(read_quoted_csv(spark, str(path), "id int, note string")) == []


def test_states_of_a_split_by_both_ways():
    state = quote_state(b",")
    for line, from_out, from_in in [
        (b"a,b", False, True),
        (b'a,"b', True, False),
        (b'"a""', True, False),
        (b'"a"', False, False),
        (b'x"y', False, False),
        (b'","', False, True),
        (b'"', True, False),
        (b"", False, True),
    ]:
        assert (state(line, False), state(line, True)) == (from_out, from_in), line
