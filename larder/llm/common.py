"""Helpers that several of the operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from larder.functions import column
from larder.session import new_run_dir

BROADCAST_ROWS = 200_000
BATCH_SETTING, BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def bounded_batches(spark: SparkSession) -> None:
    """Let the session send texts to Python 4 MB at a time, unless it has a limit of its own.

    By default a batch may take 64 MB, several times over in each of an executor's tasks: in
    the JVM's buffers outside the heap and in Python. A larger row is a batch by itself.
    """
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, BATCH_LIMIT)


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps before.
    """
    spark = df.sparkSession
    path = new_run_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table, with the hint to broadcast it if a count shows that it has few rows.

    Beyond ``max_rows`` it is joined by a shuffle, whose skewed partitions Spark splits.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def text_of(name: str) -> Column:
    """The text column, null as the empty text."""
    return F.coalesce(column(name).cast("string"), F.lit(""))


def without(df: DataFrame, outputs: Sequence[str]) -> list[T.StructField]:
    """The fields but for those that have the name of an output, in whatever case."""
    taken = {name.lower() for name in outputs}
    return [field for field in df.schema.fields if field.name.lower() not in taken]


def key_of(id_col: str, text: Column) -> Column:
    """The id; a null one is stood in for by a negative number made from the text."""
    stand_in = -F.shiftrightunsigned(F.xxhash64(F.lit("no id"), text), 1) - 1
    return F.coalesce(column(id_col).cast("bigint"), stand_in)


def rounds_of_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """The connected component of every end of ``edges`` (a, b): ``(node, component)``.

    The component is named by its least node. Alternating large-star and small-star steps
    keep one row per edge and need a number of rounds that grows with the logarithm of the
    component's size; each round is stored. A node that many edges meet is aggregated
    before the shuffle, and the join that hands its least neighbour out can be split.
    """
    edges = saved(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a != b")
        .distinct(),
        "edges",
    )
    for _ in range(max_rounds):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = saved(both.groupBy("a").agg(F.min("b").alias("m")), "least")
        least = least.select("a", F.least("a", "m").alias("m"))
        large = (
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = saved(large.where("a != b").distinct(), "large")
        lowest = saved(large.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        star = large.join(lowest, "a").select(
            F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e")
        )
        star = star.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).where("a != b").distinct()
        star = saved(star, "edges")
        ends = star.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
        centres = star.join(star.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        done = ends.isEmpty() and centres.isEmpty()
        edges = star
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``size`` bytes, as lists of words take many times a text's room."""
    rows = max(1, batch.num_rows * size // max(size, batch.nbytes))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def release() -> None:
    """Give what a task has freed back to the system, as Spark keeps the process for other tasks.

    The C library holds on to the memory of freed arrays; where it can be told to let go, it is.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def batches_of(schema: T.StructType | str, make, size: int) -> tuple:
    """``(function, schema)`` for ``mapInArrow`` from a function of one batch's columns.

    ``make()`` is called once per task and returns a function from a record batch to a list
    of arrays in the order of the schema.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in (part for whole in batches for part in slices(whole, size)):
            if batch.num_rows:
                columns = [
                    value if isinstance(value, pa.Array) else pa.array(value, field.type)
                    for field, value in zip(arrow, work(batch))
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        del work
        release()

    return run, schema


def map_batches(df: DataFrame, schema: T.StructType | str, make, size: int = 1 << 20) -> DataFrame:
    bounded_batches(df.sparkSession)
    return df.mapInArrow(*batches_of(schema, make, size))


def ranked(
    df: DataFrame, order_by: Sequence[str], out: str, partitions: int | None = None
) -> DataFrame:
    """Add the position of each row, from 0, in the order of ``order_by``.

    Rows are dealt out by ranges of those columns and counted per partition; only the counts
    go to the driver. Give enough columns to tell rows apart: one value must not hold a
    large share of the rows.
    """
    spark: SparkSession = df.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(count, *order_by).sortWithinPartitions(*order_by)
    stored = saved(dealt.withColumn("larder_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("larder_at", 33)
    counts = stored.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()
    starts, total = {}, 0
    for row in sorted(counts):
        starts[row["p"]] = total - (row["p"] << 33)
        total += row["n"]
    first = np.full(max(starts, default=0) + 1, 0, np.int64)
    for p, start in starts.items():
        first[p] = start
    table = F.lit([int(x) for x in first]) if len(first) <= 100_000 else None
    if table is not None:
        position = F.col("larder_at") + table[part.cast("int")]
        return stored.withColumn(out, position).drop("larder_at")
    by_part = spark.createDataFrame([(int(p), int(s)) for p, s in starts.items()], "larder_p bigint, larder_s bigint")
    joined = stored.withColumn("larder_p", part).join(F.broadcast(by_part), "larder_p")
    return joined.withColumn(out, F.col("larder_at") + F.col("larder_s")).drop("larder_at", "larder_p", "larder_s")
