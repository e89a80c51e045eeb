from __future__ import annotations

import threading

import pytest
from pyspark.ml.linalg import Vectors

from larder.operators.cluster import assign, fit_kmeans
from larder.sinks import publish_parquet, write_parquet
from larder.streaming import (
    append_batch_to,
    is_published,
    process_new,
    read_published,
    stream_files,
    wait_until_published,
)


def test_a_directory_is_not_yet_a_dataset(spark, tmp_path):
    path = tmp_path / "data"
    path.mkdir()
    assert not is_published(spark, str(path))
    with pytest.raises(TimeoutError):
        wait_until_published(spark, str(path), poll_seconds=0.01, timeout_seconds=0.05)
    write_parquet(spark.range(3), str(path))
    assert is_published(spark, str(path))
    assert read_published(spark, str(path)).count() == 3


def test_waiting_for_a_dataset_that_comes_later(spark, tmp_path):
    path = f"{tmp_path}/run_id=1"
    writer = threading.Timer(0.5, lambda: publish_parquet(spark.range(7), str(tmp_path), "1"))
    writer.start()
    assert read_published(spark, path, poll_seconds=0.05, timeout_seconds=60).count() == 7
    writer.join()


def test_each_file_is_processed_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "state"))
    batches = []

    def handle(batch, batch_id):
        batches.append(batch_id)
        append_batch_to(out)(batch, batch_id)

    def run():
        process_new(stream_files(spark, source, "id bigint"), handle, checkpoint)

    spark.range(3).write.parquet(source)
    run()
    run()
    assert batches == [0]
    spark.range(3, 8).write.mode("append").parquet(source)
    run()
    assert batches == [0, 1]
    assert sorted(row["id"] for row in spark.read.parquet(out).collect()) == list(range(8))


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    write = append_batch_to(str(tmp_path / "out"))
    write(spark.range(3), 0)
    write(spark.range(3), 0)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_new_vectors_are_assigned_as_in_a_batch(spark, tmp_path):
    rows = [(i, Vectors.dense(float(i % 10), float(i % 3))) for i in range(60)]
    df = spark.createDataFrame(rows, ["id", "scaled"])
    path = publish_parquet(df, str(tmp_path), "1")
    model = fit_kmeans(df, 3)
    process_new(
        assign(stream_files(spark, path, df.schema, max_files=1), model),
        append_batch_to(f"{tmp_path}/out"),
        f"{tmp_path}/state",
    )
    found = {row["id"]: row["prediction"] for row in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert found == {row["id"]: row["prediction"] for row in assign(df, model).collect()}
