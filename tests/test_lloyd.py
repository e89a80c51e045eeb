"""K-means that partitions cannot change, against brute force."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors

from larder.operators.cluster import fit_kmeans, stable_layout, sweep_k
from larder.operators.features import assemble
from larder.operators.lloyd import Layout, cluster_sums, draws, joined, limbs, lloyd, nearest_rows, pick, squared_distance


@pytest.fixture(scope="module")
def numbers(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    return assemble(rows, ["l_quantity", "l_extendedprice", "l_discount"], "scaled").select("scaled")


@pytest.mark.parametrize("init", ["spread", "farthest"])
def test_partitions_do_not_change_a_bit(numbers, init):
    found = []
    for partitions in (1, 7, 20):
        tasks = partitions if partitions < 20 else None  # sums on the driver, or by a shuffle
        layout = Layout(stable_layout(numbers.repartition(partitions), partitions=partitions), tasks)
        starts = layout.spread_starts([3, 6], 5) if init == "spread" else [layout.farthest_first(4, 5)]
        found.append([(centres.tolist(), cost, rounds) for centres, cost, rounds in lloyd(layout, starts)])
    assert found[0] == found[1] == found[2]


def test_another_seed_draws_other_rows(numbers):
    layout = Layout(stable_layout(numbers))
    first = [layout.spread_starts([5], seed)[0].tolist() for seed in (1, 1, 2)]
    assert first[0] == first[1] != first[2]


def test_rounds_equal_plain_ones(numbers):
    x = np.array([row["scaled"].toArray() for row in numbers.collect()])
    layout = Layout(stable_layout(numbers))
    (start,) = layout.spread_starts([4], 3)
    ((centres, cost, rounds),) = lloyd(layout, [start], max_iter=4, tol=0)
    expected = start
    for _ in range(4):
        distance = ((x[:, None, :] - expected) ** 2).sum(axis=2)
        before = distance.min(axis=1).sum()
        expected = np.array([x[distance.argmin(axis=1) == i].mean(axis=0) for i in range(4)])
    assert np.allclose(centres, expected, rtol=1e-9) and cost == pytest.approx(before) and rounds == 4


def test_spread_starts_are_good_ones(numbers):
    """About as cheap as the best of many plain starts."""
    x = np.array([row["scaled"].toArray() for row in numbers.collect()])
    cost = fit_kmeans(numbers, 6).summary.trainingCost
    rng = np.random.default_rng(0)
    plain = []
    for _ in range(8):
        centres = pick(x, np.ones(len(x)), 6, rng)
        for _ in range(15):
            label = nearest_rows(x, centres)[0]
            centres = np.array([x[label == i].mean(axis=0) if (label == i).any() else centres[i] for i in range(6)])
        plain.append(nearest_rows(x, centres)[1].sum())
    assert cost < 1.3 * min(plain)


def test_farthest_first_misses_no_group(spark):
    rng = np.random.default_rng(1)
    sizes = [300, 1, 2, 5, 40, 1, 7, 90, 3]
    x = np.concatenate([rng.normal((100 * i, 50 * (i % 3)), 0.5, size=(n, 2)) for i, n in enumerate(sizes)])
    df = spark.createDataFrame([(Vectors.dense(v),) for v in x], ["scaled"]).repartition(6)
    starts = Layout(stable_layout(df)).farthest_first(9, 42)
    assert sorted(np.round(starts[:, 0] / 100).astype(int).tolist()) == list(range(9))
    scores = {row["k"]: row["silhouette"] for row in sweep_k(df, range(2, 12), init="farthest").collect()}
    assert max(scores, key=scores.get) == 9
    with pytest.raises(ValueError):
        sweep_k(df, [2], init="other")


def test_few_and_no_rows(spark):
    one = spark.createDataFrame([(Vectors.dense(1.0, 2.0),)] * 5, ["scaled"])
    for init in ("spread", "farthest"):
        assert fit_kmeans(one, 3, init=init).clusterCenters()[0].tolist() == [1.0, 2.0]
        assert [tuple(r) for r in sweep_k(one.limit(0), [2, 3], init=init).collect()] == [(2, None), (3, None)]
    with pytest.raises(ValueError, match="no rows"):
        fit_kmeans(one.limit(0), 2)
    with pytest.raises(ValueError, match="finite"):
        fit_kmeans(spark.createDataFrame([(Vectors.dense(float("inf")),), (Vectors.dense(1.0),)], ["scaled"]), 2)


@pytest.mark.parametrize("k", [1, 48, 49, 3000])
def test_nearest_rows_equal_brute_force(k):
    rng = np.random.default_rng(k)
    points = rng.normal(size=(500, 5)).round(1)  # many ties
    centres = rng.normal(size=(k, 5)).round(1)
    centres[-1] = centres[0]
    centres = centres + 1000
    points = points + 1000  # where products cancel
    distance = np.array([squared_distance(points, c) for c in centres])
    index, least = nearest_rows(points, centres)
    assert np.array_equal(index, distance.argmin(axis=0)) and np.array_equal(least, distance.min(axis=0))


def test_sums_are_exact():
    rng = np.random.default_rng(2)
    x = rng.normal(size=1000) * 10.0 ** rng.integers(-6, 3, 1000)
    unit = 2.0**-42
    parts = limbs(x, unit)
    assert [joined(p) for p in zip(*(part.tolist() for part in parts))] == np.rint(x / unit).astype(int).tolist()
    batch = pa.RecordBatch.from_pydict({"values": x.reshape(-1, 2).tolist(), "copies": [3.0] * 500})
    run = cluster_sums([np.zeros((1, 2))], np.array([unit, unit]), 2.0**-20)
    whole = next(run(iter([batch])))["total"][0].as_py()
    halves = [next(run(iter([batch.slice(i, 250)])))["total"][0].as_py() for i in (0, 250)]
    assert whole == [a + b for a, b in zip(*halves)] and whole[0] == 1500


def test_draws_are_even():
    u = draws(np.arange(100_000), 7, 1)
    assert 0 < u.min() and u.max() <= 1
    assert np.histogram(u, 10, (0, 1))[0].std() < 300
    assert abs(np.corrcoef(u, draws(np.arange(100_000), 7, 2))[0, 1]) < 0.02


def test_copies_count_as_rows(spark):
    rows = [(Vectors.dense(0.0),)] * 90 + [(Vectors.dense(1.0),)] * 10 + [(Vectors.dense(50.0),)]
    model = fit_kmeans(spark.createDataFrame(rows, ["scaled"]), 2, init="farthest")
    assert sorted(c[0] for c in model.clusterCenters()) == pytest.approx([0.1, 50.0])


def test_a_pass_takes_tasks_by_bytes_not_by_partitions(spark, numbers):
    """A layout in many partitions is not as many tasks a round, and few distinct rows are few files."""
    few = spark.range(20_000).selectExpr("cast(id % 50 as double) as x").selectExpr("x", "x * 2 as y")
    layout = Layout(stable_layout(assemble(few, ["x", "y"], "scaled"), partitions=40))
    assert len(layout.blocks.inputFiles()) == 1 and layout.tasks == 1
    assert sum(n for n, _, _ in layout.moments([np.zeros((1, 2))])[0].values()) == 20_000


@pytest.mark.parametrize("dims", [1, 2, 7, 8, 20])
@pytest.mark.parametrize("copies", [1.0, 3.0, 2.0**36])
def test_sums_of_blocks_equal_sums_of_rows(dims, copies):
    """Few dimensions and many, counts that floats add up exactly and such that they don't."""
    rng = np.random.default_rng(dims)
    points = rng.normal(size=(700, dims)).round(2)
    models = [points[:k] + 0.005 for k in (1, 3, 60)]
    models[1][2] = models[1][0]  # as near
    weights = np.where(np.arange(700) % 9, 1.0, copies)
    units, cost_unit = np.full(dims, 2.0**-45), 2.0**-40
    blocks = {"points": [points[:300].tobytes(), points[300:].tobytes()], "weights": [weights[:300].tobytes(), weights[300:].tobytes()]}
    for unit in (cost_unit, None):
        (*found,) = cluster_sums(models, units, unit)(iter([pa.RecordBatch.from_pydict(blocks)]))
        for model, batch in zip(models, found):
            far = np.array([squared_distance(points, centre) for centre in model])
            label = far.argmin(axis=0)
            numbers_of = [*([limbs(far.min(axis=0), unit)] if unit else []), limbs(points, units)]
            columns = [np.ones((700, 1), np.int64), *(part.reshape(700, -1) for parts in numbers_of for part in parts)]
            moments = np.concatenate(columns, axis=1).astype(object) * weights.astype(np.int64)[:, None].astype(object)
            for cluster, total in zip(batch["cluster"].to_pylist(), batch["total"].to_pylist()):
                assert total == moments[label == cluster].sum(axis=0).tolist()
            assert batch["cluster"].to_pylist() == np.unique(label).tolist()


def test_sums_by_a_shuffle_are_the_same(numbers):
    rows = stable_layout(numbers, partitions=5)
    centres = np.array(numbers.limit(4).toPandas()["scaled"].map(lambda v: v.toArray()).tolist())
    for costs in (True, False):
        one, other = (Layout(rows, tasks).moments([centres, centres[:2]], costs) for tasks in (None, 0))
        for a, b in zip(one, other):
            assert repr(sorted((i, n, cost, mean.tolist()) for i, (n, cost, mean) in a.items())) == repr(
                sorted((i, n, cost, mean.tolist()) for i, (n, cost, mean) in b.items())
            )
