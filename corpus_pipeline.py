"""A corpus pipeline: documents in, packed training sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.functions import column
from larder.llm.common import saved
from larder.llm.decontaminate import find_contamination
from larder.llm.exact_dedup import drop_copies
from larder.llm.jaccard import drop_near_copies
from larder.llm.packing import pack_documents
from larder.llm.toxicity import learnt, score_toxicity


def untouched(docs: DataFrame, taken: set[str], find: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``find`` keeps of the rows, with their own columns, also those that it has names for."""
    safe = {name: f"larder_own_{i}" if name.lower() in taken else name for i, name in enumerate(docs.columns)}
    found = find(docs.select([column(name).alias(safe[name]) for name in docs.columns]))
    return found.select([column(safe[name]).alias(name) for name in docs.columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents with a toxicity score of 0.5 or more."""
    model = learnt(spark, docs, sf_dir)
    return untouched(docs, {"score", "sentences"}, lambda rows: score_toxicity(rows, model).where(F.col("score") < 0.5))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of texts that Jaccard links lead through."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    taken = {"contaminated", "items", "overlap"}
    return untouched(docs, taken, lambda rows: find_contamination(rows, benchmark).where("not contaminated"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the tokens of what is left into sequences."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: SQL cannot express the classifier and the latent space.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
