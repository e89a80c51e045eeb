"""K-means whose result depends on the rows and the seed alone, not on how they are partitioned.

Three things make that so. Every draw is a hash of the row's own key, the seed and the round. The nearest
centre is the one by distances that are computed row by row, always in the same way. And sums
are sums of whole numbers: each value is rounded to 52 bits of its column's greatest one.
Partitions, batches and their order then cannot change a bit.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from larder.session import new_run_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have the package

CENTRES_PER_BLOCK = 1_024
FEW_CENTRES = 48
FEW_DIMS, CENTRES_OF_FEW_DIMS = 7, 256  # so many numbers numpy sums from the left, as columns are summed
BLOCK_VALUES = 32_768
BLOCK_ROW_GROUP = 16 << 20
ROWS_PER_FILE = 100_000
ROWS_AT_ONCE, CENTRES_AT_ONCE = 2_048, 512
SAMPLING_ROUNDS = 2
LEAST_CANDIDATES = 32
MAX_ROUNDS = 12
LIMB, LIMBS = 18, 3
DRIVER_NUMBERS = 500_000


def squared_distance(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Of each point from its centre, or from the one; by row, so other rows don't matter."""
    return np.square(points - centres).sum(axis=1)


def nearest_rows(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point, the first of equally near ones, and the squared distance.

    Points of few dimensions are measured column by column, which gives the same bits. Otherwise
    many centres are taken in blocks: a matrix product leaves those that are nearest within its
    error, most often a single one, and only these are measured by :func:`squared_distance`.
    """
    best, least = np.zeros(len(points), np.int64), np.full(len(points), np.inf)
    if 0 < points.shape[1] <= FEW_DIMS and len(centres) <= CENTRES_OF_FEW_DIMS:
        columns = np.ascontiguousarray(points.T)
        far, part, closer = np.empty(len(points)), np.empty(len(points)), np.empty(len(points), bool)
        for index, centre in enumerate(centres.tolist()):
            np.subtract(columns[0], centre[0], out=far)
            np.multiply(far, far, out=far)
            for values, value in zip(columns[1:], centre[1:]):
                np.subtract(values, value, out=part)
                np.multiply(part, part, out=part)
                np.add(far, part, out=far)
            np.less(far, least, out=closer)
            np.copyto(best, index, where=closer)
            np.minimum(least, far, out=least)
        return best, least
    if len(centres) <= FEW_CENTRES:
        for index, centre in enumerate(centres):
            far = squared_distance(points, centre)
            closer = far < least
            best[closer], least[closer] = index, far[closer]
        return best, least
    norm = np.square(points).sum(axis=1)
    for first in range(0, len(centres), CENTRES_PER_BLOCK):
        block = centres[first : first + CENTRES_PER_BLOCK]
        norms = np.square(block).sum(axis=1)
        about = norms - 2 * (points @ block.T)
        error = 8 * points.shape[1] * 2.0**-52 * (norm + norms.max())
        row, at = np.nonzero(about <= (about.min(axis=1) + 2 * error)[:, None])
        far = squared_distance(points[row], block[at])
        order = np.lexsort((at, far, row))
        order = order[np.diff(row[order], prepend=-1) > 0]
        closer = far[order] < least  # one for each row, in their order
        best[closer], least[closer] = first + at[order][closer], far[order][closer]
    return best, least


def draws(key: np.ndarray, seed: int, round_: int) -> np.ndarray:
    """A number above 0 and up to 1 for each key, another one in each round."""
    x = key.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + (round_ + 1) * 0xD1B54A32D192ED03) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2**53 + 2.0**-54


def limbs(values: np.ndarray, unit: np.ndarray | float) -> list[np.ndarray]:
    """Values as whole multiples of the unit, in parts of 18 bits, the highest first."""
    whole = np.rint(values / unit).astype(np.int64)
    parts = [whole >> (LIMB * (LIMBS - 1))]
    return parts + [(whole >> (LIMB * i)) & ((1 << LIMB) - 1) for i in range(LIMBS - 2, -1, -1)]


def joined(parts: Sequence[int]) -> int:
    total = 0
    for part in parts:
        total = (total << LIMB) + part
    return total


def points_of(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch["values"].flatten(), float).reshape(batch.num_rows, -1)


def packed(rows: DataFrame) -> DataFrame:
    """Rows ``(key, values, copies)`` as blocks of bytes, stored to be read again and again.

    A pass then moves a few large values between Spark and Python where it had several a row, and
    Spark reads the files in tasks of its own size, so their number follows the bytes
    and not the partitions of the rows. Files that came out small are put together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points, key, copies = points_of(batch), np.asarray(batch["key"]), np.asarray(batch["copies"])
                parts = math.ceil(points.size / BLOCK_VALUES) or 1
                ends = [len(points) * i // parts for i in range(parts + 1)]
                ends = sorted(set(ends))
                parts = [slice(a, b) for a, b in zip(ends, ends[1:])]
                columns = [[x[part].tobytes() for part in parts] for x in (key, points, copies)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.stop - part.start for part in parts], pa.int32()), *map(pa.array, columns)],
                    ["n", "keys", "points", "weights"],
                )

    def stored(blocks: DataFrame) -> DataFrame:
        path = new_run_dir(spark, "blocks")
        blocks.write.option("parquet.block.size", BLOCK_ROW_GROUP).parquet(path)
        return spark.read.schema(schema).parquet(path)

    spark, schema = rows.sparkSession, "n int, keys binary, points binary, weights binary"
    blocks = stored(rows.select("key", "values", "copies").mapInArrow(run, schema))
    files = math.ceil((blocks.agg(F.sum("n")).first()[0] or 0) / ROWS_PER_FILE)
    return stored(blocks.coalesce(max(1, files))) if 4 * files < len(blocks.inputFiles()) else blocks


def points_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray | None, np.ndarray, np.ndarray]]:
    """The keys, if read, points and copies of batches of rows or of blocks."""
    for batch in batches:
        names = batch.schema.names
        if "points" not in names:
            if batch.num_rows:
                yield np.asarray(batch["key"]) if "key" in names else None, points_of(batch), np.asarray(batch["copies"])
            continue
        for i in range(batch.num_rows):
            numbers = np.frombuffer(batch["points"][i].as_buffer(), float)
            copies = np.frombuffer(batch["weights"][i].as_buffer(), float)
            points = numbers.reshape(len(copies), -1)
            if points.shape[1] <= FEW_DIMS:
                points = np.asfortranarray(points)
            yield np.frombuffer(batch["keys"][i].as_buffer(), np.int64) if "keys" in names else None, points, copies


def memberships(points: np.ndarray, models: Sequence[np.ndarray]) -> np.ndarray:
    """1 where a point's nearest centre in its model is this one, else 0: a row per centre of all models.

    One matrix product gives all distances but for its error. Points with more than one centre
    within that are given to :func:`nearest_rows`, so the centres are those that it finds.
    """
    centres = np.concatenate(models)
    norms = np.square(centres).sum(axis=1)
    about = (-2 * centres) @ points.T
    about += norms[:, None]
    error = 8 * points.shape[1] * 2.0**-52 * (np.square(points).sum(axis=1) + norms.max())
    out = np.empty(about.shape, bool)
    first = 0
    for model in models:
        part, hit = about[first : first + len(model)], out[first : first + len(model)]
        np.less_equal(part, part.min(axis=0) + 2 * error, out=hit)
        if np.count_nonzero(hit) > len(points):
            unsure = np.flatnonzero(np.count_nonzero(hit, axis=0) > 1)
            hit[:, unsure] = False
            hit[nearest_rows(points[unsure], model)[0], unsure] = True
        first += len(model)
    return out.astype(float)


def cluster_sums(models: Sequence[np.ndarray], units: np.ndarray, cost_unit: float | None):
    """For ``mapInArrow``: of each model's clusters the number of rows, the cost, if it has a unit,
    and the sums of the values, as whole numbers, one row a cluster and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims = len(units)
        costs = 0 if cost_unit is None else 1
        totals = [np.zeros((len(m), 1 + LIMBS * (costs + dims)), np.int64) for m in models]
        for _, points, weights in points_in(batches):
            values = limbs(points, units)
            # sums of so small whole numbers are exact in floats too
            exact = dims <= FEW_DIMS and weights.max() * len(weights) < 2.0 ** (52 - LIMB)
            if exact and not costs and sum(map(len, models)) <= CENTRES_AT_ONCE:
                moments = np.column_stack([weights, *(part * weights[:, None] for part in values)])
                for start in range(0, len(points), ROWS_AT_ONCE):
                    rows = slice(start, start + ROWS_AT_ONCE)
                    sums = (memberships(points[rows], models) @ moments[rows]).astype(np.int64)
                    for total, own in zip(totals, np.split(sums, np.cumsum([len(m) for m in models])[:-1])):
                        total += own
                continue
            copies = weights.astype(np.int64)
            weighted = [part[:, j] * weights for part in values for j in range(dims)] if exact else []
            for total, centres in zip(totals, models):
                nearest, far = nearest_rows(points, centres)
                if exact and len(centres) <= CENTRES_PER_BLOCK:
                    cost = [x * weights for x in limbs(far, cost_unit)] if costs else []
                    for place, numbers in enumerate([weights, *cost, *weighted]):
                        total[:, place] += np.bincount(nearest, numbers, len(total)).astype(np.int64)
                    continue
                cost = [x[:, None] for x in limbs(far, cost_unit)] if costs else []
                moments = np.concatenate([np.ones((len(points), 1), np.int64), *cost, *values], axis=1) * copies[:, None]
                order = np.argsort(nearest, kind="stable")
                cluster, start = np.unique(nearest[order], return_index=True)
                total[cluster] += np.add.reduceat(moments[order], start, axis=0)
        for i, total in enumerate(totals):
            met = np.flatnonzero(total[:, 0])
            yield pa.RecordBatch.from_pydict(
                {
                    "model": pa.array(np.full(len(met), i, np.int32)),
                    "cluster": pa.array(met.astype(np.int32)),
                    "total": pa.array(total[met].tolist(), pa.list_(pa.int64())),
                }
            )

    return run


def ends_of():
    """For ``mapInArrow``: the least and the greatest value of each dimension in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for _, points, _ in points_in(batches):
            least, most = np.fmin.reduce(points, axis=0), np.fmax.reduce(points, axis=0)
            low, high = (least, most) if low is None else (np.fmin(low, least), np.fmax(high, most))
        if low is not None:
            values = pa.array([low.tolist(), high.tolist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([values], ["ends"])

    return run


class Layout:
    """Distinct rows ``(key, values, copies)``, in blocks, with the units of their sums.

    Sums of few tasks are added up on the driver, which saves a shuffle a round. ``tasks`` stands in for
    their number; 0 asks for the shuffle. They are the same whole numbers either way.
    """

    def __init__(self, rows: DataFrame, tasks: int | None = None):
        self.blocks = packed(rows)
        self.points = self.blocks.select("points", "weights")
        self.tasks = self.points.rdd.getNumPartitions() if tasks is None else tasks
        ends = [row["ends"] for row in self.points.mapInArrow(ends_of(), "ends array<double>").collect()]
        greatest = np.fmax.reduce(np.abs(ends), axis=0) if ends else np.zeros(0)
        if not np.isfinite(greatest).all():
            raise ValueError("k-means needs finite values")
        exponent = np.array([math.frexp(x)[1] for x in greatest.tolist()], np.int64)
        self.units = np.maximum(np.ldexp(1.0, exponent - 52), np.finfo(float).tiny)
        widest = float(np.square(2 * greatest).sum())
        self.cost_unit = max(math.ldexp(1.0, math.frexp(widest)[1] - 52), sys.float_info.min)

    def moments(self, models: Sequence[np.ndarray], costs: bool = True) -> list[dict[int, tuple[int, float, np.ndarray]]]:
        """``{cluster: (rows, cost, mean)}`` of each model's clusters that have rows, in one pass.

        Without ``costs`` they are left out, as NaN.
        """
        sums = self.points.mapInArrow(
            cluster_sums(models, self.units, self.cost_unit if costs else None),
            "model int, cluster int, total array<bigint>",
        )
        dims, found = len(self.units), {}
        at = 1 + LIMBS * costs
        width = at + LIMBS * dims
        if self.tasks and self.tasks * width * sum(map(len, models)) <= DRIVER_NUMBERS:
            for model, cluster, total in sums.collect():
                held = found.setdefault((model, cluster), [0] * width)
                held[:] = map(sum, zip(held, total))
        else:
            each = sums.select("model", "cluster", F.posexplode("total").alias("place", "v"))
            added = each.groupBy("model", "cluster", "place").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("v"))
            for model, cluster, place, v in added.collect():
                found.setdefault((model, cluster), [0] * width)[place] = int(v)
        out: list[dict] = [{} for _ in models]
        for (model, cluster), total in found.items():
            n = total[0]
            cost = joined([total[1 + i] for i in range(LIMBS)]) * self.cost_unit if costs else math.nan
            mean = [joined([total[at + i * dims + j] for i in range(LIMBS)]) / n for j in range(dims)]
            out[model][cluster] = n, cost, np.array(mean) * self.units
        return out

    def cost(self, centres: np.ndarray) -> float:
        return math.fsum(cost for _, cost, _ in self.moments([centres])[0].values())

    def first_by(self, score) -> tuple[float, np.ndarray] | None:
        """The row with the least score, of equal ones the one with the least key and values."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = None
            for key, points, copies in points_in(batches):
                value = score(key, points, copies)
                for at in np.flatnonzero(value == value.min()).tolist():
                    row = float(value[at]), int(key[at]), points[at].tolist()
                    best = row if best is None or row < best else best
            if best is not None:
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("score", "key", "values"), best))],
                    pa.schema({"score": pa.float64(), "key": pa.int64(), "values": pa.list_(pa.float64())}),
                )

        tasks = self.blocks.mapInArrow(run, "score double, key bigint, values array<double>")
        row = tasks.orderBy("score", "key", "values").limit(1).first()
        return (row["score"], np.array(row["values"])) if row else None

    def first_centre(self, seed: int) -> np.ndarray | None:
        """A row drawn by its copies."""

        def score(key: np.ndarray, points: np.ndarray, copies: np.ndarray) -> np.ndarray:
            return -np.log(draws(key, seed, 0)) / copies

        found = self.first_by(score)
        return None if found is None else found[1]

    def farthest_first(self, k: int, seed: int) -> np.ndarray:
        """Up to ``k`` rows, each the one farthest from those before it: no far group is missed."""
        first = self.first_centre(seed)
        chosen = [] if first is None else [first]
        while chosen and len(chosen) < k:
            centres = np.array(chosen)
            found = self.first_by(lambda key, points, copies: -nearest_rows(points, centres)[1])
            if found[0] == 0:
                break
            chosen.append(found[1])
        return np.array(chosen)

    def sampled(self, centres: np.ndarray, chance: float, seed: int, round_: int) -> np.ndarray:
        """Rows drawn with a chance in proportion to their copies and squared distance."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for key, points, copies in points_in(batches):
                hit = np.flatnonzero(draws(key, seed, round_) < chance * (nearest_rows(points, centres)[1] * copies))
                values = pa.array(points[hit].tolist(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(key[hit]), values], ["key", "values"])

        rows = self.blocks.mapInArrow(run, "key bigint, values array<double>").orderBy("key", "values").collect()
        return np.array([row["values"] for row in rows]).reshape(-1, centres.shape[1])

    def candidates(self, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """At least ``size`` rows spread over the table, where it has them, and the rows nearest to each.

        Rounds of draws in proportion to the squared distance gather some multiple of
        ``size``. Further rounds follow while there are too few and rows remain that none covers.
        """
        first = self.first_centre(seed)
        if first is None:
            return np.zeros((0, 0)), np.zeros(0)
        found = first[None]
        for round_ in range(1, MAX_ROUNDS + 1):
            cost = self.cost(found)
            if cost == 0 or round_ > SAMPLING_ROUNDS and len(found) >= size:
                break
            found = np.concatenate([found, self.sampled(found, 2 * size / cost, seed, round_)])
        counts = self.moments([found])[0]
        return found, np.array([counts[i][0] if i in counts else 0 for i in range(len(found))], float)

    def spread_starts(self, ks: Sequence[int], seed: int) -> list[np.ndarray]:
        """Starting centres for every ``k``, by a weighted k-means++ over candidates.

        All ``k`` up to 32 share their candidates, as do those up to each further power of two, so
        a ``k`` has the same start alone and among others.
        """
        size = {k: max(LEAST_CANDIDATES, 1 << (k - 1).bit_length()) for k in ks}
        found = {n: self.candidates(n, seed) for n in sorted(set(size.values()))}
        return [pick(*found[size[k]], k, np.random.default_rng([seed, k])) for k in ks]


def pick(rows: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Weighted k-means++ over a few rows."""
    if len(rows) <= k:
        return rows
    chosen = [int(np.searchsorted(np.cumsum(weights), rng.random() * weights.sum()))]
    far = squared_distance(rows, rows[chosen[0]])
    while len(chosen) < k:
        share = np.cumsum(weights * far)
        if share[-1] == 0:
            share = np.cumsum(far)
        if share[-1] == 0:
            break
        chosen.append(min(int(np.searchsorted(share, rng.random() * share[-1], side="right")), len(rows) - 1))
        far = np.minimum(far, squared_distance(rows, rows[chosen[-1]]))
    return rows[chosen]


def lloyd(
    layout: Layout, starts: Sequence[np.ndarray], max_iter: int = 20, tol: float = 1e-4, costs: bool = True
) -> list[tuple[np.ndarray, float, int]]:
    """``(centres, cost, rounds)`` of every start, all models in one pass a round.

    A centre without rows stays where it is. A model is done when no centre moves farther than ``tol``, or after
    ``max_iter`` rounds; the cost is the one before the last move, or NaN without ``costs``.
    """
    models = [(centres, 0.0, 0) for centres in starts]
    active = [i for i, centres in enumerate(starts) if len(centres)]
    for round_ in range(1, max_iter + 1):
        if not active:
            break
        still = []
        for i, moments in zip(active, layout.moments([models[i][0] for i in active], costs)):
            before = models[i][0]
            centres = before.copy()
            for cluster, (_, _, mean) in moments.items():
                centres[cluster] = mean
            models[i] = centres, math.fsum(cost for _, cost, _ in moments.values()), round_
            if (squared_distance(centres, before) > tol * tol).any():
                still.append(i)
        active = still
    return models
