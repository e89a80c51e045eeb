"""Word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from larder.functions import column, words


def tokenize(df: DataFrame, text_col: str = "value") -> DataFrame:
    """One row per word, empty words included; a null text has none."""
    return df.select(F.explode(words(column(text_col))).alias("word"))


def word_count(df: DataFrame, text_col: str = "value") -> DataFrame:
    """``(word, n)``. Each task counts its own words first, so a frequent word costs no more
    than one row per task in the shuffle."""
    return tokenize(df, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
