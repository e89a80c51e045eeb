"""Compaction of stored counts while streams and readers go on."""

from __future__ import annotations

import json
from collections import Counter
from pathlib import Path

import pytest

from larder.streaming import compact, compact_counts, count_new_lines, merged_counts, read_live, tidy
from larder.streaming import compaction
from larder.streaming.wordcount import added_up


@pytest.fixture
def stream(spark, tmp_path):
    """Two streams that count into one folder, and the lines they have seen."""
    seen = Counter()

    def add(name, number, line):
        folder = tmp_path / name
        folder.mkdir(exist_ok=True)
        (folder / f"{number}.txt").write_text(line + "\n")
        seen.update(line.split(" "))
        count_new_lines(spark, str(folder), str(tmp_path / "counts"), str(tmp_path / f"check-{name}"))

    return add, seen, str(tmp_path / "counts")


def counted(df):
    return {row["word"]: row["n"] for row in df.collect()}


def test_counts_stay_the_same_and_batches_are_not_read_again(spark, stream):
    add, seen, counts = stream
    add("x", 0, "a b a")
    add("y", 0, "b c")
    add("x", 1, "a")
    assert counted(merged_counts(spark, counts)) == seen
    assert compact_counts(spark, counts) == 3 and compact_counts(spark, counts) == 0
    assert counted(merged_counts(spark, counts)) == seen
    assert read_live(spark, counts).count() == 3  # one row a word
    add("x", 2, "a d")
    add("z", 0, "d")
    assert counted(merged_counts(spark, counts)) == seen
    assert compact_counts(spark, counts) == 2
    assert counted(merged_counts(spark, counts)) == seen and read_live(spark, counts).count() == 4


def test_readers_during_compaction_see_each_count_once(spark, stream, monkeypatch):
    add, seen, counts = stream
    add("x", 0, "a b a")
    add("x", 1, "b")
    before = merged_counts(spark, counts)

    def merge(rows):
        assert counted(merged_counts(spark, counts)) == seen  # while it runs
        add("x", 2, "a late")  # a batch that it does not take in
        return added_up(rows)

    assert compact(spark, counts, merge) == 2
    assert counted(merged_counts(spark, counts)) == seen
    assert counted(before) == {"a": 2, "b": 2}  # one that began before


def test_a_repeated_batch_is_not_counted_twice(spark, stream):
    add, seen, counts = stream
    add("x", 0, "a b a")
    compact_counts(spark, counts)
    (batch,) = Path(counts).glob("stream_id=*/batch_id=0")
    rows = spark.createDataFrame([("a", 2), ("b", 1)], "word string, n bigint")
    rows.write.mode("overwrite").parquet(str(batch))
    assert compact_counts(spark, counts) == 0 and counted(merged_counts(spark, counts)) == seen


def test_half_a_batch_is_not_taken_in(spark, stream):
    add, seen, counts = stream
    add("x", 0, "a b a")
    add("x", 1, "c")
    (batch,) = Path(counts).glob("stream_id=*/batch_id=1")
    (batch / "_SUCCESS").unlink()
    assert compact_counts(spark, counts) == 1
    assert counted(merged_counts(spark, counts)) == {"a": 2, "b": 1}
    (batch / "_SUCCESS").touch()
    assert counted(merged_counts(spark, counts)) == seen


def test_of_two_compactions_one_fails(spark, stream):
    add, seen, counts = stream
    add("x", 0, "a b a")

    def merge(rows):
        assert compact_counts(spark, counts) == 1
        return added_up(rows)

    with pytest.raises(Exception, match="(?i)exist"):
        compact(spark, counts, merge)
    assert counted(merged_counts(spark, counts)) == seen
    assert compaction.Folder(spark, counts).manifests() == [1]


def test_tidying_keeps_what_readers_may_need(spark, stream):
    add, seen, counts = stream
    for i in range(3):
        add("x", i, "a b")
        compact_counts(spark, counts)
    assert tidy(spark, counts) == 0  # all of it is young
    assert len(list(Path(counts).glob("stream_id=*/batch_id=*"))) == 3
    for path in (Path(counts) / "_manifests").glob("[0-9]*"):  # a day passes
        manifest = json.loads(path.read_text())
        (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
        path.write_text(json.dumps(manifest | {"made": manifest["made"] - 90_000}))
    assert tidy(spark, counts) == 5  # three batches and two merged folders
    assert counted(merged_counts(spark, counts)) == seen
    add("x", 3, "c")
    assert counted(merged_counts(spark, counts)) == seen
