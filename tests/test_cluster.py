from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from larder.operators import cluster
from larder.operators.cluster import (
    assign,
    fit_kmeans,
    layout_partitions,
    nearest_centroid,
    silhouette,
    silhouettes,
    stable_layout,
    sweep_k,
)
from larder.operators.features import assemble, standardise

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@pytest.fixture(scope="module")
def points(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    return standardise(assemble(rows, MEASURES)).select("l_orderkey", "scaled")


@pytest.fixture(scope="module")
def copied(spark):
    """A third of the rows are one and the same point."""
    rng = np.random.default_rng(3)
    rows = [Vectors.dense(v) for v in rng.normal(size=(200, 3)).tolist()]
    rows += [Vectors.dense([0.0, 0.0, 0.0])] * 100
    return spark.createDataFrame([(v,) for v in rows], ["scaled"]).repartition(5)


def matrix(df, name="scaled"):
    return np.array([row[name].toArray() for row in df.collect()])


def brute_silhouette(x, labels):
    scores = []
    for i in range(len(x)):
        squared = ((x - x[i]) ** 2).sum(axis=1)
        own = labels == labels[i]
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = squared[own].sum() / (own.sum() - 1)
        b = min(squared[labels == g].mean() for g in set(labels) - {labels[i]})
        scores.append(0.0 if a == b else (b - a) / max(a, b))
    return float(np.mean(scores))


def test_layout_keeps_every_row_as_a_weight(copied):
    layout = stable_layout(copied)
    assert layout.count() == 201
    assert layout.agg(F.sum("copies"), F.max("copies")).first() == (300.0, 100.0)


def test_layout_does_not_depend_on_the_input_partitions(points):
    def places(df):
        layout = stable_layout(df, partitions=3)
        rows = layout.withColumn("p", F.spark_partition_id()).collect()
        return [(row["p"], tuple(row["values"]), row["copies"]) for row in rows]

    assert places(points.coalesce(1)) == places(points.repartition(7))


def test_layout_partitions_follow_the_data(spark, copied):
    assert layout_partitions(copied) == 1
    assert layout_partitions(copied.limit(0)) == 1
    many = spark.range(1_000_000).select(array_to_vector(F.array(F.col("id").cast("double"))).alias("scaled"))
    assert layout_partitions(many) == 10


def test_same_seed_same_model_whatever_the_layout(points):
    one = fit_kmeans(points.coalesce(1), 4, partitions=3)
    other = fit_kmeans(points.repartition(7), 4, partitions=3)
    assert np.allclose(one.clusterCenters(), other.clusterCenters(), rtol=0, atol=1e-9)


def test_every_row_goes_to_its_nearest_centre(points):
    model = fit_kmeans(points, 5)
    rows = assign(points, model).collect()
    centres = np.array(model.clusterCenters())
    x = np.array([row["scaled"].toArray() for row in rows])
    distance = ((x[:, None, :] - centres) ** 2).sum(axis=2)
    chosen = distance[np.arange(len(rows)), [row["prediction"] for row in rows]]
    assert len(rows) == 6000 and len(centres) <= 5
    assert np.allclose(chosen, distance.min(axis=1))
    cost = distance.min(axis=1).sum()  # after the last move of the centres, the summary's before it
    assert 0.99 * model.summary.trainingCost < cost <= model.summary.trainingCost * (1 + 1e-9)


def test_weighted_fit_minimises_the_cost_of_all_rows(copied):
    model = fit_kmeans(copied, 3)
    x = matrix(copied)
    labels = np.array([row["prediction"] for row in assign(copied, model).collect()])
    for i, centre in enumerate(model.clusterCenters()):
        assert np.allclose(centre, x[labels == i].mean(axis=0), atol=0.05)


def test_silhouette_equals_all_pairs(copied):
    model = fit_kmeans(copied, 4)
    rows = assign(copied, model)
    labels = np.array([row["prediction"] for row in rows.collect()])
    assert silhouette(rows) == pytest.approx(brute_silhouette(matrix(rows), labels), abs=1e-9)


def test_singleton_scores_zero(spark):
    rows = [(Vectors.dense(0.0), 0), (Vectors.dense(1.0), 0), (Vectors.dense(9.0), 1)]
    df = spark.createDataFrame(rows, ["scaled", "prediction"])
    x, labels = np.array([[0.0], [1.0], [9.0]]), np.array([0, 0, 1])
    assert silhouette(df) == pytest.approx(brute_silhouette(x, labels))


def test_one_cluster_has_no_silhouette(spark, copied):
    with pytest.raises(Exception, match="greater than one"):
        silhouette(copied.withColumn("prediction", F.lit(0)))


def test_joint_silhouettes_equal_the_evaluator_on_all_rows(copied, points):
    for df in (copied, points):
        layout = stable_layout(df, partitions=3)
        models = [fit_kmeans(df, k, partitions=3) for k in (2, 5, 9)]
        joint = silhouettes(layout, models, "scaled")
        single = [silhouette(assign(df, model.setPredictionCol("prediction"))) for model in models]
        assert joint == pytest.approx(single, abs=1e-9)


def test_silhouettes_by_blocks_of_clusters(copied, monkeypatch):
    layout = stable_layout(copied, "scaled", 3)
    centres = np.unique(matrix(copied), axis=0)[::3]
    models = [centres[:k] for k in (2, 7, 40)] + [np.concatenate([centres[:5], centres[:1] + 1e6])]
    whole = cluster.silhouettes_of(layout, models)
    assert None not in whole
    for width in (1, 3, 7):
        monkeypatch.setattr(cluster, "CENTRES_PER_BLOCK", width)
        assert cluster.silhouettes_of(layout, models) == pytest.approx(whole, abs=1e-9)


def test_joint_silhouettes_with_singletons(spark):
    x = np.array([[0.0], [0.2], [9.0], [30.0]])
    df = spark.createDataFrame([(Vectors.dense(v),) for v in x], ["scaled"])
    model = fit_kmeans(df, 3)
    labels = np.array([row["prediction"] for row in assign(df, model).collect()])
    found = silhouettes(stable_layout(df), [model], "scaled")
    assert found == pytest.approx([brute_silhouette(x, labels)])


def test_fewer_distinct_rows_than_clusters(spark):
    rows = [(Vectors.dense(float(i % 3), 0.0),) for i in range(30)]
    scores = sweep_k(spark.createDataFrame(rows, ["scaled"]), [2, 3, 9]).collect()
    assert [row["silhouette"] for row in scores][1:] == [1.0, 1.0]


def test_identical_rows_have_no_silhouette(spark):
    df = spark.createDataFrame([(Vectors.dense(1.0, 2.0),)] * 10, ["scaled"])
    assert [tuple(row) for row in sweep_k(df, [2, 3]).collect()] == [(2, None), (3, None)]
    assert sweep_k(df, []).collect() == []


def test_scores_repeat_whatever_the_partitions_that_were_scaled(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select(*MEASURES)
    found = []
    for n in (1, 7, 20):
        scaled = standardise(assemble(rows.repartition(n), MEASURES))
        found.append([row["silhouette"] for row in sweep_k(scaled, [2, 4, 7], partitions=8).collect()])
    assert found[1] == pytest.approx(found[0], abs=1e-9) and found[2] == pytest.approx(found[0], abs=1e-9)


def test_layout_takes_one_exchange(points, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    plans = []
    monkeypatch.setattr(DataFrame, "checkpoint", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()))
    stable_layout(points, partitions=3)
    assert plans[0].count("Exchange") == 1


def test_equal_hashes_of_different_vectors_stay_apart():
    import pyarrow as pa

    from larder.operators.cluster import count_equal

    batch = pa.RecordBatch.from_pydict({"key": [5, 5, 5, 6], "values": [[1.0], [2.0], [1.0], [1.0]]})
    (out,) = count_equal()(iter([batch]))
    assert sorted(zip(*(out[name].to_pylist() for name in ("key", "values", "copies")))) == [(5, [1.0], 2.0), (5, [2.0], 1.0), (6, [1.0], 1.0)]


def test_sweep_scores_every_k_and_repeats(points):
    first = sweep_k(points.coalesce(1), partitions=2)
    assert first.dtypes == [("k", "int"), ("silhouette", "double")]
    rows = [tuple(row) for row in first.collect()]
    assert [k for k, _ in rows] == list(range(2, 10))
    assert all(-1 <= score <= 1 for _, score in rows)
    again = [tuple(row) for row in sweep_k(points.repartition(5), partitions=2, parallelism=1).collect()]
    assert [score for _, score in again] == pytest.approx([score for _, score in rows], abs=1e-9)


def test_sweep_finds_the_obvious_clusters(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 0.1, size=(50, 2)) for c in ((0, 0), (10, 0), (0, 10))])
    df = spark.createDataFrame([(Vectors.dense(v),) for v in x], ["scaled"])
    scores = {row["k"]: row["silhouette"] for row in sweep_k(df, range(2, 6)).collect()}
    assert max(scores, key=scores.get) == 3


def test_given_centroids(spark, points):
    centres = points.limit(300).groupBy((F.col("l_orderkey") % 7).alias("label")).agg(
        F.min_by("scaled", "l_orderkey").alias("scaled")
    )
    table = centres.collect()
    means = {row["label"]: row["scaled"].toArray() for row in table}
    fixed = spark.createDataFrame([(k, Vectors.dense(v)) for k, v in means.items()], ["label", "scaled"])
    found = nearest_centroid(points, fixed).collect()
    labels = np.array(list(means))
    centre = np.array(list(means.values()))
    x = np.array([row["scaled"].toArray() for row in found])
    distance = ((x[:, None, :] - centre) ** 2).sum(axis=2)
    at = [int(np.flatnonzero(labels == row["nearest"])[0]) for row in found]
    assert np.allclose(distance[np.arange(len(found)), at], distance.min(axis=1))


def test_many_centroids_are_named_by_a_join(spark, points, monkeypatch):
    from larder.operators import cluster

    rows = [(f"c{i}", Vectors.dense(i / 10, 1.0, 1.0, 1.0)) for i in range(40)]
    table = spark.createDataFrame(rows, ["label", "scaled"])
    few = nearest_centroid(points, table)
    monkeypatch.setattr(cluster, "IDS_IN_PLAN", 10)
    many = nearest_centroid(points, table)
    assert many.columns == few.columns
    assert many.exceptAll(few).count() == 0 and many.count() == few.count() == 6000


def test_one_centroid_and_equal_centroids(spark, copied):
    one = spark.createDataFrame([("a", Vectors.dense(1.0, 1.0, 1.0))], ["label", "scaled"])
    assert {row["nearest"] for row in nearest_centroid(copied, one).collect()} == {"a"}
    equal = spark.createDataFrame(
        [("b", Vectors.dense(1.0, 1.0, 1.0)), ("a", Vectors.dense(1.0, 1.0, 1.0)),
         ("c", Vectors.dense(-9.0, -9.0, -9.0))],
        ["label", "scaled"],
    )
    assert {row["nearest"] for row in nearest_centroid(copied, equal).collect()} == {"a"}
    with pytest.raises(ValueError):
        nearest_centroid(copied, one.limit(0))


def test_centroid_assignment_pairs_nothing(spark, points):
    table = spark.createDataFrame(
        [(i, Vectors.dense(float(i), 0.0, 0.0, 0.0)) for i in range(3)], ["label", "scaled"]
    )
    plan = nearest_centroid(points, table)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_vectors_survive_the_layout(copied):
    model = fit_kmeans(copied, 2)
    rows = assign(copied.select(vector_to_array("scaled").alias("v"), "scaled"), model)
    assert rows.count() == 300


def test_executor_functions_need_no_package():
    """They are sent whole, so a Python without this package can run them."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from larder.operators.cluster import score_partition, sum_partition

    functions = cloudpickle.dumps((sum_partition([2, 3]), score_partition([np.ones((2, 4))])))
    code = "import pickle, sys; print(len(pickle.loads(sys.stdin.buffer.read())))"
    run = subprocess.run([sys.executable, "-c", code], input=functions, capture_output=True, cwd="/", timeout=60)
    assert run.stdout.strip() == b"2", run.stderr
