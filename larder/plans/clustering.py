"""From published feature vectors to a score per number of clusters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from larder.operators.cluster import sweep_k
from larder.streaming.published import read_published


def score_published(
    spark: SparkSession,
    path: str,
    ks: Iterable[int] = range(2, 10),
    features_col: str = "scaled",
    *,
    seed: int = 42,
    poll_seconds: float = 10,
    timeout_seconds: float | None = None,
) -> DataFrame:
    """Wait for a published dataset, then ``(k, silhouette)``; reads only the vectors."""
    return sweep_k(read_published(spark, path, poll_seconds, timeout_seconds), ks, features_col, seed)
