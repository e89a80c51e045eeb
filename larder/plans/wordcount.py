"""Word count of text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.operators.text import word_count
from larder.sources import read_lines


def count_words(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(word, n)`` of text files. Write it or page through it; it may not fit the driver."""
    return word_count(read_lines(spark, path))
