"""K-means and the silhouette score."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from larder.functions import column
from larder.operators.cells import nearest_by_cells
from larder.operators.lloyd import CENTRES_PER_BLOCK, Layout, lloyd, nearest_rows, points_in
from larder.session import shared_dir

ROWS_PER_PARTITION = 100_000
SMALL_PARTITIONS = 4_096
BYTES_PER_PARTITION = 256 << 20
MODEL_BYTES = 256 << 20
IDS_IN_PLAN = 1_000


def vector_shape(df: DataFrame, features_col: str) -> tuple[int, int]:
    """The number of rows and of dimensions."""
    first = df.select(column(features_col)).first()
    return df.count(), first[0].size if first else 0


def layout_partitions(df: DataFrame, features_col: str = "scaled") -> int:
    """A partition count that depends on the data alone, not on the cluster.

    Small data gets 100,000 rows per partition; from 4,096 partitions on they grow, up to
    256 MiB of values, and then their number grows again.
    """
    rows, dims = vector_shape(df, features_col)
    by_rows = math.ceil(rows / ROWS_PER_PARTITION)
    by_bytes = math.ceil(rows * dims * 8 / BYTES_PER_PARTITION)
    return max(1, min(by_rows, SMALL_PARTITIONS), by_bytes)


def count_equal():
    """A function for ``mapInArrow``: equal rows of a batch become one, with their number.

    Rows are told apart by ``key``, a hash; one whose numbers differ from those of the first
    row with its key stays a row of its own.
    """

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            _, first, group = np.unique(np.asarray(batch["key"]), return_index=True, return_inverse=True)
            same = np.ones(batch.num_rows, bool)
            for name in batch.schema.names[1:]:
                lengths = np.diff(np.asarray(batch[name].offsets))
                if (lengths != lengths[0]).any():
                    same[:] = False
                    break
                numbers = np.asarray(batch[name].flatten()).reshape(batch.num_rows, -1)
                same &= (numbers == numbers[first[group]]).all(axis=1)
            same[first] = True
            copies = np.bincount(group[same], minlength=len(first)).astype(float)
            alone = np.flatnonzero(~same)
            kept = batch.take(pa.array(np.concatenate([first, alone])))
            counts = pa.array(np.concatenate([copies, np.ones(len(alone))]))
            yield pa.RecordBatch.from_arrays([*kept.columns, counts], [*batch.schema.names, "copies"])

    return combine


def distinct_rows(
    df: DataFrame,
    features_col: str = "scaled",
    partitions: int | None = None,
    source_col: str | None = None,
) -> DataFrame:
    """The distinct vectors as ``(key, values, copies)``, always in the same partitions and order.

    The key is a hash of ``source_col``, the vectors before scaling: the last bits of scaled ones
    depend on the order in which the deviations were summed. Without it the vectors
    themselves decide. Starting centres are drawn by the key. Equal vectors are counted in each batch, before
    the one shuffle, and become one weighted row, so a vector that makes up a third of the
    table is no hot partition.
    """
    if partitions is None:
        partitions = layout_partitions(df, features_col)
    values = vector_to_array(column(features_col))
    source = values if source_col in (None, features_col) else vector_to_array(column(source_col))
    keyed = df.select(F.xxhash64(source).alias("key"), values.alias("values"))
    counted = keyed.mapInArrow(count_equal(), T.StructType([*keyed.schema.fields, T.StructField("copies", T.DoubleType())]))
    return (
        counted.repartition(partitions, "key")
        .groupBy("key", "values")
        .agg(F.sum("copies").alias("copies"))
        .sortWithinPartitions("key", "values")
        .select("key", "values", "copies")
    )


def stable_layout(
    df: DataFrame,
    features_col: str = "scaled",
    partitions: int | None = None,
    source_col: str | None = None,
) -> DataFrame:
    """:func:`distinct_rows`, checkpointed: passes start from it, on lost executors too."""
    shared_dir(df.sparkSession)
    return distinct_rows(df, features_col, partitions, source_col).checkpoint()


def source_of(df: DataFrame, features_col: str) -> str | None:
    """The column of unscaled vectors, as :func:`standardise` leaves it beside the scaled ones."""
    return "features" if features_col == "scaled" and "features" in df.columns else None


def start_centres(layout: Layout, ks: Sequence[int], seed: int, init: str) -> list[np.ndarray]:
    """``init="spread"`` draws rows in proportion to their squared distance from those drawn
    before; ``"farthest"`` takes the farthest row each time, which cannot miss a far group."""
    if init == "farthest":
        rows = layout.farthest_first(max(ks), seed)
        return [rows[:k] for k in ks]
    if init != "spread":
        raise ValueError(f'init must be "spread" or "farthest", not {init!r}')
    return layout.spread_starts(ks, seed)


class FitSummary:
    """How a fit went: the cost before the last move of the centres, and the rounds."""

    def __init__(self, k: int, cost: float, rounds: int):
        self.k, self.trainingCost, self.numIter = k, cost, rounds


class FittedKMeans(KMeansModel):
    """Spark's model with given centres, and the summary of their fit."""

    fitted: FitSummary | None = None

    @property
    def hasSummary(self) -> bool:
        return self.fitted is not None

    @property
    def summary(self) -> FitSummary | None:
        return self.fitted


class CentresAsModel(KMeans):
    """Fitted to a table of distinct centres, each of which is a cluster of its own."""

    def _create_model(self, java_model) -> FittedKMeans:
        return FittedKMeans(java_model)


def model_of(spark, centres: np.ndarray, features_col: str, prediction_col: str) -> FittedKMeans:
    """A Spark model with these centres, in an order of its own."""
    rows = [(values,) for values in np.unique(centres, axis=0).tolist()]
    table = spark.createDataFrame(rows, "v array<double>").coalesce(1).select(array_to_vector("v").alias(features_col))
    return CentresAsModel(
        featuresCol=features_col,
        predictionCol=prediction_col,
        solver="row",
        initMode="random",
        maxIter=1,
        k=max(2, len(rows)),
        seed=0,
    ).fit(table)


def fit_kmeans(
    df: DataFrame,
    k: int,
    features_col: str = "scaled",
    prediction_col: str = "prediction",
    seed: int = 42,
    partitions: int | None = None,
    init: str = "spread",
) -> FittedKMeans:
    """Fit ``k`` centres; the same rows and seed give the same centres, whatever the partitions.

    Fewer distinct rows than ``k`` give fewer centres. Keep a column ``features`` with the unscaled vectors
    beside ``scaled``, or the last bits of the scaled ones count as part of the rows.
    """
    layout = Layout(distinct_rows(df, features_col, partitions, source_of(df, features_col)))
    ((centres, cost, rounds),) = lloyd(layout, start_centres(layout, [k], seed, init))
    if not len(centres):
        raise ValueError("there are no rows to fit")
    model = model_of(df.sparkSession, centres, features_col, prediction_col)
    model.fitted = FitSummary(k, cost, rounds)
    return model


def assign(df: DataFrame, model: KMeansModel) -> DataFrame:
    """Add the index of the nearest centre; works on batches and streams."""
    return model.transform(df)


def nearest_centroid(
    df: DataFrame,
    centroids: DataFrame,
    features_col: str = "scaled",
    id_col: str = "label",
    output_col: str = "nearest",
) -> DataFrame:
    """Add the ``id_col`` of the nearest row of a table of given centroids.

    Every centroid is a cluster of its own, so a k-means model fitted to that table has them
    as its centres and assigns points without pairing them. Their ids are looked up in the
    plan, or by a join on the centre's index where there are many. Equal centroids count as
    the one with the smallest id. A table too large for a model, which every task holds,
    stays partitioned: :func:`~larder.operators.cells.nearest_by_cells`.
    """
    shared_dir(df.sparkSession)
    table = centroids.select(column(id_col), column(features_col)).checkpoint()
    size, dims = vector_shape(table, features_col)
    if not size:
        raise ValueError("there are no centroids")
    if size * dims * 8 > MODEL_BYTES:
        return nearest_by_cells(df, table, features_col, id_col, output_col)
    id_type = table.schema[id_col].dataType
    if size == 1:
        return df.withColumn(output_col, F.lit(table.first()[id_col]).cast(id_type))
    model = KMeans(
        featuresCol=features_col,
        predictionCol=output_col,
        solver="row",
        initMode="random",
        maxIter=1,
        k=size,
        seed=0,
    ).fit(table)
    by_index = model.transform(table).groupBy(output_col).agg(F.min(column(id_col)).alias("larder_id"))
    found = model.transform(df)
    if size > IDS_IN_PLAN:
        named = found.join(by_index, output_col).withColumn(output_col, F.col("larder_id"))
        return named.select([column(name) for name in found.columns])
    ids = {row[output_col]: row["larder_id"] for row in by_index.collect()}
    names = F.lit([ids[i] for i in sorted(ids)]).cast(T.ArrayType(id_type))
    return found.withColumn(output_col, names[column(output_col)])


def silhouette(df: DataFrame, features_col: str = "scaled", prediction_col: str = "prediction") -> float:
    """Mean silhouette with squared Euclidean distance, for a given clustering."""
    return ClusteringEvaluator(
        featuresCol=features_col,
        predictionCol=prediction_col,
        metricName="silhouette",
        distanceMeasure="squaredEuclidean",
    ).evaluate(df)


def batch_reader(models: Sequence[np.ndarray] | None):
    """A function that gives points, squared norms, copies and the nearest centre in each model.

    Like the others below it is an inner function, which Spark sends to the executors whole:
    they need not have this package installed.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
        for _, points, copies in points_in(batches):
            yield points, np.square(points).sum(axis=1), copies, [nearest_rows(points, centres)[0] for centres in models]

    return read


def sum_partition(ks: Sequence[int], models: Sequence[np.ndarray] | None = None):
    """A function for ``mapInArrow``: per cluster, a partition's sums of (1, |x|^2, x)."""
    read = batch_reader(models)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: list = [None] * len(ks)
        for points, norms, copies, assigned in read(batches):
            moments = np.column_stack([np.ones(len(points)), norms, points]) * copies[:, None]
            for i, k in enumerate(ks):
                if totals[i] is None:
                    totals[i] = np.zeros((k, moments.shape[1]))
                order = np.argsort(assigned[i], kind="stable")
                cluster, start = np.unique(assigned[i][order], return_index=True)
                totals[i][cluster] += np.add.reduceat(moments[order], start, axis=0)
        for i, total in enumerate(totals):
            if total is not None:
                met = np.flatnonzero(total[:, 0])
                yield pa.RecordBatch.from_pydict(
                    {
                        "i": pa.array(np.full(len(met), i, np.int32)),
                        "cluster": pa.array(met.astype(np.int32)),
                        "total": pa.array(total[met].tolist(), pa.list_(pa.float64())),
                    }
                )

    return sums


def score_partition(sums: Sequence[np.ndarray], models: Sequence[np.ndarray] | None = None):
    """A function for ``mapInArrow``: a partition's sum of silhouettes per clustering.

    ``sums[i]`` has a row (n, sum of |y|^2, sum of y) for each cluster of the i-th
    clustering. The mean squared distance from x to a cluster is |x|^2 + mean |y|^2 -
    2 x.mean(y), so no pair of points is ever formed. Clusters are taken in blocks with the
    least distance so far, so memory does not grow with a batch times their number.
    """
    read = batch_reader(models)
    width = CENTRES_PER_BLOCK
    sizes = [total[:, 0] for total in sums]
    means = [total[:, 1:] / np.maximum(total[:, :1], 1) for total in sums]

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(sums))
        for points, norms, copies, assigned in read(batches):
            for i, (size, mean) in enumerate(zip(sizes, means)):
                own, other = np.zeros(len(points)), np.full(len(points), np.inf)
                for first in range(0, len(size), width):
                    block = mean[first : first + width]
                    distance = norms[:, None] + block[:, 0] - 2 * (points @ block[:, 1:].T)
                    distance[:, size[first : first + width] == 0] = np.inf
                    row = np.flatnonzero((assigned[i] >= first) & (assigned[i] < first + width))
                    at = assigned[i][row] - first
                    own[row], distance[row, at] = distance[row, at], np.inf
                    np.minimum(other, distance.min(axis=1), out=other)
                n = size[assigned[i]]
                own *= n / np.maximum(n - 1, 1)
                other[np.isinf(other)] = 0.0  # there is no other cluster
                larger = np.maximum(own, other)
                value = np.divide(other - own, larger, out=np.zeros(len(points)), where=larger > 0)
                totals[i] += np.sum(np.where(n > 1, value, 0) * copies)
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(np.arange(len(sums), dtype=np.int32)), "score": pa.array(totals)}
        )

    return scores


def silhouettes(layout: DataFrame, models: Sequence[KMeansModel], features_col: str) -> list[float | None]:
    """:func:`silhouettes_of` for the centres of Spark's models."""
    return silhouettes_of(layout, [np.array(model.clusterCenters()) for model in models])


def silhouettes_of(layout: DataFrame, models: Sequence[np.ndarray]) -> list[float | None]:
    """The silhouette for each array of centres over the rows of a layout, or its blocks, all in two passes.

    The first sums up the clusters of every model, the second scores the rows against those
    sums. A task sends on one array per cluster, then one row per model. A model that leaves
    fewer than two clusters with rows has none. The nearest centres are found in both passes,
    which costs less than storing them with the vectors.
    """
    if not models:
        return []
    if not all(len(centres) for centres in models):
        return [None] * len(models)
    rows = layout if "points" in layout.columns else layout.select("values", "copies")
    ks = [len(centres) for centres in models]
    summed = (
        rows.mapInArrow(sum_partition(ks, models), "i int, cluster int, total array<double>")
        .groupBy("i", "cluster")
        .agg(Summarizer.sum(array_to_vector("total")).alias("total"))
        .collect()
    )
    dims = models[0].shape[1]
    sums = [np.zeros((k, dims + 2)) for k in ks]
    for i, cluster, total in summed:
        sums[i][cluster] = total.toArray()
    scored = (
        rows.mapInArrow(score_partition(sums, models), "i int, score double")
        .groupBy("i")
        .agg(F.sum("score").alias("score"))
        .collect()
    )
    by_model = {row["i"]: row["score"] for row in scored}
    apart = [np.count_nonzero(total[:, 0]) > 1 for total in sums]
    return [by_model[i] / float(total[:, 0].sum()) if apart[i] else None for i, total in enumerate(sums)]


def sweep_k(
    df: DataFrame,
    ks: Iterable[int] = range(2, 10),
    features_col: str = "scaled",
    seed: int = 42,
    partitions: int | None = None,
    init: str = "spread",
    parallelism: int | None = None,
) -> DataFrame:
    """Fit k-means for every ``k`` and score it: ``(k, silhouette)``.

    A ``k`` that leaves a single cluster with rows has a null score. Where ``df`` has the
    unscaled vectors in ``features``, they decide the draws (see :func:`stable_layout`).

    All models are fitted together over one stored layout, one pass a round for all
    that still move, so ``parallelism`` has nothing left to decide.
    """
    spark = df.sparkSession
    ks = list(ks)
    if not ks:
        return spark.createDataFrame([], "k int, silhouette double")
    layout = Layout(distinct_rows(df, features_col, partitions, source_of(df, features_col)))
    models = [centres for centres, _, _ in lloyd(layout, start_centres(layout, ks, seed, init), costs=False)]
    return spark.createDataFrame(list(zip(ks, silhouettes_of(layout.points, models))), "k int, silhouette double")
