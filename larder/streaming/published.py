"""Picking up datasets that another job publishes."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def is_published(spark: SparkSession, path: str) -> bool:
    """Whether a dataset is complete, which Spark marks with ``_SUCCESS``."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(marker)


def wait_until_published(
    spark: SparkSession, path: str, poll_seconds: float = 10, timeout_seconds: float | None = None
) -> None:
    """Return once the dataset is complete; the directory alone is not enough."""
    deadline = None if timeout_seconds is None else time.monotonic() + timeout_seconds
    while not is_published(spark, path):
        if deadline is not None and time.monotonic() >= deadline:
            raise TimeoutError(f"{path} was not published within {timeout_seconds} s")
        time.sleep(poll_seconds)


def read_published(
    spark: SparkSession, path: str, poll_seconds: float = 10, timeout_seconds: float | None = None
) -> DataFrame:
    """Wait for a Parquet dataset to be complete and read it whole."""
    wait_until_published(spark, path, poll_seconds, timeout_seconds)
    return spark.read.parquet(path)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    *,
    file_format: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """The files of a folder as a stream; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.format(file_format)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def process_new(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> None:
    """Hand everything not yet seen to ``handle`` in micro-batches, then stop.

    The checkpoint remembers the files, so a later call gets only newer ones. A batch that
    failed half-way is handed over again under the same number.
    """
    if isinstance(handle, BatchFolders) and handle.checkpoint is None:
        handle = BatchFolders(handle.path, checkpoint)
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


class BatchFolders:
    """Writes each batch into a folder named by the stream's own id and the batch's number."""

    def __init__(self, path: str, checkpoint: str | None = None):
        self.path = path
        self.checkpoint = checkpoint

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        folder = self.path
        if self.checkpoint is not None:
            metadata = batch.sparkSession.read.text(f"{self.checkpoint}/metadata").first()["value"]
            folder += f"/stream_id={json.loads(metadata)['id']}"
        batch.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def append_batch_to(path: str, checkpoint: str | None = None) -> BatchFolders:
    """A handler that writes each batch into its own folder; a repeated batch replaces itself.

    Streams number their batches from 0, so the folder also carries the id that the stream
    keeps in its checkpoint: several streams may write to one path. :func:`process_new`
    fills in its checkpoint; name it where the handler is called by another one.
    """
    return BatchFolders(path, checkpoint)
