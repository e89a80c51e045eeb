"""The nearest of many centroids, against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from larder.operators import cluster
from larder.operators.cells import nearest_by_cells
from larder.operators.lloyd import squared_distance


def frames(spark, points, centroids, ids):
    rows = [(i, Vectors.dense(v)) for i, v in enumerate(points)]
    return (
        spark.createDataFrame(rows, ["row_id", "scaled"]).repartition(3),
        spark.createDataFrame([(i, Vectors.dense(v)) for i, v in zip(ids, centroids)], ["label", "scaled"]),
    )


def brute(points, centroids, ids):
    far = np.array([squared_distance(points, c) for c in centroids])
    least = far.min(axis=0)
    return [min(ids[j] for j in np.flatnonzero(far[:, i] == least[i])) for i in range(len(points))]


@pytest.mark.parametrize(("piece_bytes", "points_per_probe"), [(8 << 20, 100_000), (200, 40)])
def test_cells_equal_brute_force(spark, piece_bytes, points_per_probe):
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(12, 3)) * 50
    centroids = np.concatenate([middles[rng.integers(0, 12, 300)] + rng.normal(size=(300, 3)).round(1), middles[:1].repeat(60, 0)])
    centroids[320:340] += rng.normal(size=(20, 3)).round(0)  # ties and equal rows
    points = np.concatenate([middles[rng.integers(0, 12, 400)] + rng.normal(size=(400, 3)).round(1), centroids[:30]])
    ids = [f"c{i:04}" for i in rng.permutation(len(centroids))]
    df, table = frames(spark, points, centroids, ids)
    found = nearest_by_cells(df, table, piece_bytes=piece_bytes, points_per_probe=points_per_probe)
    assert found.columns == ["row_id", "scaled", "nearest"]
    rows = sorted(found.collect())
    assert [row["row_id"] for row in rows] == list(range(len(points)))
    assert [row["nearest"] for row in rows] == brute(points, centroids, ids)


def test_most_cells_are_ruled_out(spark):
    from larder.operators.cells import cells_in_reach
    import pyarrow as pa

    rng = np.random.default_rng(5)
    pivots = rng.normal(size=(100, 2)) * 1000
    points = pivots[rng.integers(0, 100, 50)] + rng.normal(size=(50, 2))
    batch = pa.RecordBatch.from_pydict({"row": list(range(50)), "values": points.tolist()})
    probes = sum(b.num_rows for b in cells_in_reach(pivots, np.full(100, 3.0))(iter([batch])))
    assert 50 <= probes < 100


def test_a_table_too_large_for_a_model_is_not_refused(spark, monkeypatch):
    rng = np.random.default_rng(6)
    centroids, points = rng.normal(size=(80, 4)), rng.normal(size=(200, 4))
    df, table = frames(spark, points, centroids, list(range(80)))
    small = {row["row_id"]: row["nearest"] for row in cluster.nearest_centroid(df, table).collect()}
    monkeypatch.setattr(cluster, "MODEL_BYTES", 100)
    large = {row["row_id"]: row["nearest"] for row in cluster.nearest_centroid(df, table).collect()}
    assert large == small
    with pytest.raises(ValueError):
        nearest_by_cells(df, table.limit(0))
    assert nearest_by_cells(df.limit(0), table).collect() == []
