"""A two-pass external shuffle that deals rows out to shards in random order."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from larder.functions import column
from larder.llm.common import saved, small, text_of
from larder.session import new_run_dir

BUCKET_BYTES = 32 << 20
PART = "larder_bucket"
SALT = "larder_salt"


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A random order of 0..n-1: from the end, each place swaps with one not after it."""
    order = list(range(n))
    picks = rng.random(n) * np.arange(1, n + 1)
    for i, j in zip(range(n - 1, 0, -1), picks[:0:-1].astype(int).tolist()):
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def shuffle_bucket(starts: np.ndarray, bounds: np.ndarray, seed: int, names: list[str], schema: pa.Schema):
    """A function for ``mapInArrow`` over partitions that are one bucket each.

    Rows are put into an order of their own first, so that a retried task, which may read
    them in another order, writes the same places again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = [batch for batch in batches if batch.num_rows]
        if not full:
            return
        table = pa.Table.from_batches(full)
        bucket = table[PART][0].as_py()
        order = pc.sort_indices(table, sort_keys=[(name, "ascending") for name in (SALT, "larder_size", "larder_id")])
        table = table.take(order)
        table = table.take(pa.array(fisher_yates(table.num_rows, np.random.default_rng([seed, bucket]))))
        place = starts[bucket] + np.arange(table.num_rows, dtype=np.int64)
        shard = np.searchsorted(bounds, place, side="right") - 1
        out = table.select(names)
        out = out.append_column("shard", pa.array(shard.astype(np.int32)))
        out = out.append_column("slot", pa.array(place - bounds[shard]))
        yield from out.cast(schema).to_batches(max_chunksize=5_000)

    return run


def shard_rows(
    df: DataFrame,
    path: str,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 42,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Write the rows under ``path`` in random order, in shards whose counts differ by one at
    most, and return them with ``shard`` and ``slot`` (their place in the shard, from 0).

    First pass: a seeded hash of id and text scatters the rows into buckets of about
    ``bucket_bytes``. Second pass: each bucket is one task, which puts its rows into a
    random order by Fisher-Yates and writes them; buckets follow one another, and the shards
    are equal stretches of that sequence. Only the row count of each bucket goes to the
    driver.

    Null ids and texts are values of their own, a null or empty text has no bytes, and
    repeated rows are rows like any other. An id that would fill a quarter of a bucket by
    itself is spread over all buckets by its rows' places in the input, so that no bucket
    outgrows its task; such ids number at most four per bucket. An empty table writes no
    rows. An input column named ``shard`` or ``slot`` is replaced; names that begin with
    ``larder_`` are reserved. The same rows and seed give the same shards; with such frequent
    ids, the same files and split sizes.
    """
    spark = df.sparkSession
    names = [name for name in df.columns if name not in ("shard", "slot")]
    size = F.octet_length(text_of(text_col)).cast("bigint") + 1
    rows, total = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    buckets = max(1, math.ceil(total / bucket_bytes))
    share = max(1, rows // buckets // 4)
    row_id = column(id_col)
    often = df.groupBy(row_id.cast("string").alias("larder_often")).agg(F.count("*").alias("n"))
    often = saved(often.where(F.col("n") > share).select("larder_often"), "shard-ids")
    place = F.monotonically_increasing_id()
    dealt = df.select(*[column(name) for name in names]).withColumns(
        {"larder_size": size, "larder_id": row_id.cast("string"), "larder_place": place}
    )
    match = F.col("larder_id").eqNullSafe(F.col("larder_often"))
    dealt = dealt.join(small(often).withColumn("larder_yes", F.lit(True)), match, "left")
    spread = F.when(F.col("larder_yes"), F.col("larder_place")).otherwise(F.lit(0))
    dealt = dealt.withColumn("larder_place", spread).drop("larder_often", "larder_yes")
    dealt = dealt.withColumn(SALT, F.xxhash64(F.lit(seed), "larder_id", text_of(text_col), "larder_place"))
    dealt = dealt.withColumn(PART, F.pmod(SALT, F.lit(buckets)).cast("int"))
    counts = {row[PART]: row["n"] for row in dealt.groupBy(PART).agg(F.count("*").alias("n")).collect()}
    starts = np.concatenate([[0], np.cumsum([counts.get(b, 0) for b in range(buckets)])])[:-1]
    bounds = np.array([s * rows // shards for s in range(shards)], np.int64)
    fields = [field for field in df.schema.fields if field.name in names]
    schema = T.StructType([*fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    work = shuffle_bucket(starts, bounds, seed, names, to_arrow_schema(schema))
    out = dealt.repartitionById(buckets, PART).mapInArrow(work, schema)
    out.write.partitionBy("shard").parquet(path)
    return spark.read.schema(schema).parquet(path)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = shard_rows(docs, new_run_dir(spark, "shards"))
    text = text_of("text")
    return rows.select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
