"""Word counts over text files that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.operators.text import word_count
from larder.streaming.compaction import compact, read_live
from larder.streaming.published import append_batch_to, process_new, stream_files


def count_new_lines(
    spark: SparkSession,
    source: str,
    counts: str,
    checkpoint: str,
    max_files: int | None = None,
) -> None:
    """Count the words of the text files that are new since the last call.

    Counts add up, so each batch stores its own and no running state is kept: the cost of a
    batch depends on its size, not on all words seen before.
    """
    store = append_batch_to(counts, checkpoint)
    process_new(
        stream_files(spark, source, file_format="text", max_files=max_files),
        lambda lines, batch_id: store(word_count(lines), batch_id),
        checkpoint,
    )


def merged_counts(spark: SparkSession, counts: str) -> DataFrame:
    """``(word, n)`` over all batches stored so far."""
    return added_up(read_live(spark, counts))


def compact_counts(spark: SparkSession, counts: str) -> int:
    """Add up the counts stored so far, so that reading them costs as much as there are distinct
    words, however many batches there were; returns how many were taken in."""
    return compact(spark, counts, added_up)


def added_up(counts: DataFrame) -> DataFrame:
    return counts.groupBy("word").agg(F.sum("n").alias("n"))
