from __future__ import annotations

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from larder.operators.text import tokenize, word_count
from larder.plans.wordcount import count_words
from larder.streaming import count_new_lines, merged_counts


def counts(df):
    return {row["word"]: row["n"] for row in df.collect()}


def expected(texts):
    return Counter(
        word
        for text in texts
        if text is not None
        for line in re.split("\r\n|\r|\n", text)
        for word in line.split(" ")
    )


def test_counts_of_a_text_file(spark, tmp_path):
    path = tmp_path / "words.txt"
    path.write_text("a dog and a cat\na cat, Ёлка!\n", encoding="utf-8")
    assert counts(count_words(spark, str(path))) == {
        "a": 3, "dog": 1, "and": 1, "cat": 1, "cat,": 1, "Ёлка!": 1,
    }


def test_empty_words_and_lines_are_counted(spark, tmp_path):
    path = tmp_path / "words.txt"
    path.write_bytes(b"a  b \n\nc\r\nd\re")
    assert counts(count_words(spark, str(path))) == {"a": 1, "": 3, "b": 1, "c": 1, "d": 1, "e": 1}


def test_null_text_has_no_words(spark):
    df = spark.createDataFrame([(None,), ("",)], "value string")
    assert counts(word_count(df)) == {"": 1}


def test_a_word_that_is_most_of_the_table(spark):
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 'hot', cast(id % 1000 as string)) as value")
    found = counts(word_count(df))
    assert found["hot"] == 10_000
    assert sum(found.values()) == 30_000


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \r\n\tab.é😀", max_size=20)), max_size=6))
def test_matches_plain_python(spark, texts):
    df = spark.createDataFrame([(text,) for text in texts], "value string")
    assert counts(word_count(df)) == expected(texts)


def test_any_text_column(spark):
    df = spark.createDataFrame([(1, "x y")], "id int, `my text` string")
    assert [row["word"] for row in tokenize(df, "my text").collect()] == ["x", "y"]


def test_plan_counts_before_the_shuffle_and_reads_one_column(spark):
    plan = word_count(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "text")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1
    assert "partial_count" in text
    assert re.search(r"ReadSchema: struct<text:string>", text)


def test_stream_counts_each_file_once(spark, tmp_path):
    source, where, checkpoint = (str(tmp_path / name) for name in ("in", "counts", "state"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("a b a\n")
    count_new_lines(spark, source, where, checkpoint)
    assert counts(merged_counts(spark, where)) == {"a": 2, "b": 1}
    count_new_lines(spark, source, where, checkpoint)
    assert counts(merged_counts(spark, where)) == {"a": 2, "b": 1}
    (tmp_path / "in" / "2.txt").write_text("a c\n")
    (tmp_path / "in" / "3.txt").write_text("c\n")
    count_new_lines(spark, source, where, checkpoint, max_files=1)
    assert counts(merged_counts(spark, where)) == {"a": 3, "b": 1, "c": 2}
    assert counts(merged_counts(spark, where)) == counts(count_words(spark, source))
