"""The nearest of very many given centroids, by cells around pivots."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from larder.functions import column
from larder.operators.lloyd import nearest_rows, squared_distance
from larder.sinks.files import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have the package

MOST_PIVOTS = 4_096
PIECE_BYTES = 8 << 20
POINTS_PER_PROBE = 100_000


def rows_of(values: pa.Array, rows: int) -> np.ndarray:
    return np.asarray(values.flatten(), float).reshape(rows, -1)


def cell_of(pivots: np.ndarray):
    """For ``mapInArrow``: centroids with their cell, that of the nearest pivot, and the distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for x in batches if x.num_rows):
            cell, far = nearest_rows(rows_of(batch["values"], batch.num_rows), pivots)
            columns = [batch["id"], batch["values"], pa.array(cell.astype(np.int32)), pa.array(np.sqrt(far))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "values", "cell", "far"])

    return run


def cells_in_reach(pivots: np.ndarray, radius: np.ndarray):
    """For ``mapInArrow``: each point with every cell that may hold its nearest centroid.

    A pivot is a centroid, so none farther than the nearest pivot matters; and no centroid of a
    cell is nearer than the cell's pivot less the cell's radius.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for x in batches if x.num_rows):
            points = rows_of(batch["values"], batch.num_rows)
            for first in range(0, len(points), 256):
                part = points[first : first + 256]
                far = np.sqrt(np.stack([squared_distance(part, pivot) for pivot in pivots], axis=1))
                slack = 1e-9 * (far.max(axis=1) + radius.max())
                point, cell = np.nonzero(far - radius <= (far.min(axis=1) + slack)[:, None])
                rows = batch.slice(first, len(part)).take(pa.array(point))
                yield pa.RecordBatch.from_arrays(
                    [rows["row"], rows["values"], pa.array(cell.astype(np.int32))], ["row", "values", "cell"]
                )

    return run


def nearest_in_pieces(id_type: pa.DataType):
    """For ``mapInArrow`` over (cell, piece, salt), centroids first: each point's nearest centroid there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, held, matrix = None, [], [], None
        for batch in (x for x in batches if x.num_rows):
            keys = np.stack([np.asarray(batch[name]) for name in ("cell", "piece", "salt", "kind")], axis=1)
            cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(keys)]):
                key, part = tuple(keys[start, :3]), batch.slice(start, end - start)
                if key != at:
                    at, ids, held, matrix = key, [], [], None
                values = rows_of(part["values"], part.num_rows)
                if keys[start, 3] == 0:
                    ids.append(part["id"])
                    held.append(values)
                    continue
                if matrix is None:
                    matrix, names = np.concatenate(held), pa.concat_arrays(ids)
                index, far = nearest_rows(values, matrix)
                found = names.take(pa.array(index)).cast(id_type)
                yield pa.RecordBatch.from_arrays([part["row"], pa.array(far), found], ["row", "far", "id"])

    return run


def nearest_by_cells(
    df: DataFrame,
    centroids: DataFrame,
    features_col: str = "scaled",
    id_col: str = "label",
    output_col: str = "nearest",
    piece_bytes: int = PIECE_BYTES,
    points_per_probe: int = POINTS_PER_PROBE,
) -> DataFrame:
    """Add the ``id_col`` of the nearest centroid, of equally near ones the least id; exact.

    The centroids stay a partitioned table. Some of them, about the square root of their number and
    4,096 at most, are pivots; each centroid belongs to the cell of its nearest pivot.
    A point is compared with the pivots, and then only with the centroids of cells that the
    triangle inequality does not rule out. Cells are cut into pieces of ``piece_bytes``, and
    the points of a cell are salted, so neither a cell that holds most centroids nor one that most points
    need is one task. How many cells a point needs depends on the data: few where
    centroids lie in groups, many where all are about equally far.
    """
    spark = df.sparkSession
    vectors = centroids.select(column(id_col).alias("id"), vector_to_array(column(features_col)).alias("values"))
    table = stage(vectors.groupBy("values").agg(F.min("id").alias("id")).select("id", "values"))
    size, dims = table.count(), F.size("values")
    if not size:
        raise ValueError("there are no centroids")
    width = table.agg(F.max(dims)).first()[0]
    chosen = table.orderBy(F.xxhash64("values"), "values").limit(min(MOST_PIVOTS, math.ceil(math.sqrt(size))))
    pivots = np.array([row["values"] for row in chosen.collect()])

    id_name = table.schema["id"].dataType.simpleString()
    celled = stage(table.mapInArrow(cell_of(pivots), f"id {id_name}, values array<double>, cell int, far double"))
    cells = celled.groupBy("cell").agg(F.max("far").alias("radius"), F.count("*").alias("n")).collect()
    radius = np.full(len(pivots), -np.inf)
    piece_rows = max(1, piece_bytes // (8 * width))
    pieces = [1] * len(pivots)
    for cell, far, n in cells:
        radius[cell], pieces[cell] = far, math.ceil(n / piece_rows)

    rows = stage(df.withColumn("larder_row", F.monotonically_increasing_id()))
    points = rows.select(F.col("larder_row").alias("row"), vector_to_array(column(features_col)).alias("values"))
    wide = np.where(np.isfinite(radius), radius, -1e300)
    probes = stage(points.mapInArrow(cells_in_reach(pivots, wide), "row bigint, values array<double>, cell int"))
    asked = {row["cell"]: row["n"] for row in probes.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    salts = [max(1, math.ceil(asked.get(cell, 0) / points_per_probe)) for cell in range(len(pivots))]

    of_cell = lambda numbers: F.lit(numbers)[F.col("cell")]
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    piece = F.pmod(F.xxhash64("values"), of_cell(pieces)).cast("int").alias("piece")
    own = celled.select("id", "values", "cell", piece, F.lit(0).alias("kind"), every(of_cell(salts)).alias("salt"))
    salt = F.pmod(F.xxhash64("row"), of_cell(salts)).cast("int").alias("salt")
    needs = probes.select("row", "values", "cell", salt, F.lit(1).alias("kind"), every(of_cell(pieces)).alias("piece"))
    from pyspark.sql.pandas.types import to_arrow_type

    dealt = own.unionByName(needs, True).repartition("cell", "piece", "salt")
    dealt = dealt.sortWithinPartitions("cell", "piece", "salt", "kind", "id")
    work = nearest_in_pieces(to_arrow_type(table.schema["id"].dataType))
    found = dealt.mapInArrow(work, T.StructType.fromDDL(f"row bigint, far double, id {id_name}"))
    best = found.groupBy("row").agg(F.min(F.struct("far", "id"))["id"].alias("larder_id"))
    named = rows.join(best, F.col("larder_row") == F.col("row")).withColumn(output_col, F.col("larder_id"))
    names = [*df.columns, *([] if output_col in df.columns else [output_col])]
    return named.select([column(name) for name in names])
