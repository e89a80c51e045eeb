"""Short codes for vectors: one codebook per part of the vector, fitted by Lloyd's rounds.

Members, the parts of all vectors, live with the entry that they belong to: they are stored in
buckets by (position, entry, salt). An owner updates its entry from the members it has, where
they are; then each member looks for its nearest entry, and only those that change to
another one go through the shuffle, to join the members there.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from larder.functions import column
from larder.llm.common import map_batches, saved, small
from larder.session import new_run_dir

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
OWNER_ROWS = 200_000
MAX_BUCKETS = 100_000
LARGEST = 1 << 27
OWNER = ["position", "entry", "salt"]
BATCH_BYTES = 1 << 20


def whole_numbers(df: DataFrame, vector_col: str, keep: Sequence[Column], scale: int = SCALE) -> DataFrame:
    """The kept columns and ``larder_x``, the vector as floor(scale * component); stored.

    Rows whose vector is null or empty or holds a null or a number that is not finite are left out.
    ``larder_row`` tells the rows apart.
    """
    vector = column(vector_col).cast("array<double>")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    kept = df.where(vector.isNotNull() & (F.size(vector) > 0)).where(~odd)
    numbers = F.transform(vector, lambda x: F.floor(x * scale).cast("bigint"))
    row = F.monotonically_increasing_id()
    return saved(kept.select(*keep, numbers.alias("larder_x"), row.alias("larder_row")), "vectors")


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry to each row and the squared distance; of equally near ones the first."""
    best, least = np.zeros(len(x), np.int64), np.full(len(x), np.iinfo(np.int64).max)
    for index, entry in enumerate(entries):
        far = x - entry
        far = np.einsum("ij,ij->i", far, far)
        closer = far < least
        best[closer], least[closer] = index, far[closer]
    return best, least


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    return np.asarray(lists.flatten(), np.int64).reshape(-1, width)


def place_parts(vectors: DataFrame, books: np.ndarray, salts: int) -> DataFrame:
    """Every part of every vector as a member of its nearest entry."""
    parts, _, width = books.shape

    def make():
        def work(batch: pa.RecordBatch) -> list:
            x = matrix(batch["larder_x"], parts * width).reshape(-1, parts, width)
            entry = np.stack([nearest(x[:, p], books[p])[0] for p in range(parts)], axis=1)
            offsets = pa.array(np.arange(0, x.size + 1, width, dtype=np.int32))
            salt = np.repeat(np.asarray(batch["salt"]), parts)
            members = pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))
            return [np.tile(np.arange(parts, dtype=np.int32), len(x)), entry.ravel().astype(np.int32), salt, members]

        return work

    salt = F.pmod(F.xxhash64("larder_row"), F.lit(salts)).cast("int")
    rows = vectors.select("larder_x", salt.alias("salt"))
    return map_batches(rows, "position int, entry int, salt int, x array<bigint>", make, BATCH_BYTES)


def marked(members: DataFrame, books: np.ndarray) -> DataFrame:
    """The members with their nearest entries, and whether that is another one than before."""
    width = books.shape[2]

    def make():
        def work(batch: pa.RecordBatch) -> list:
            x, position = matrix(batch["x"], width), np.asarray(batch["position"])
            before, entry = np.asarray(batch["entry"]), np.zeros(len(x), np.int32)
            for p in np.unique(position):
                at = position == p
                entry[at] = nearest(x[at], books[p])[0]
            return [batch["position"], entry, batch["salt"], batch["x"], entry != before]

        return work

    schema = "position int, entry int, salt int, x array<bigint>, moved boolean"
    return map_batches(members.select(*OWNER, "x"), schema, make, BATCH_BYTES)


class Residents:
    """The members of one round, as a table in the shared folder bucketed by their owners.

    A retried task finds them there; the round before is dropped once the next is stored.
    """

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.name = self.path = None

    def store(self, members: DataFrame) -> None:
        name, path = f"larder_members_{uuid.uuid4().hex}", new_run_dir(self.spark, "members")
        writer = members.write.format("parquet").bucketBy(self.buckets, *OWNER).option("path", path)
        writer.saveAsTable(name)
        self.drop()
        self.name, self.path = name, path

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        if self.name:
            self.spark.sql(f"DROP TABLE {self.name}")
            place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
            place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
            self.name = None


def owners_update(members: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks with each entry as the floored mean of its members; unused ones stay.

    Buckets hold whole owners, so their sums need no shuffle; the salted owners of one entry
    are added up, at most one row an entry and task.
    """
    width = books.shape[2]
    sums = [F.sum(F.col("x")[j]).alias(f"s{j}") for j in range(width)]
    own = members.groupBy(*OWNER).agg(F.count("*").alias("n"), *sums)
    total = [F.sum(f"s{j}").alias(f"s{j}") for j in range(width)]
    rows = own.groupBy("position", "entry").agg(F.sum("n").alias("n"), *total).collect()
    books = books.copy()
    for row in rows:
        books[row["position"], row["entry"]] = [row[f"s{j}"] // row["n"] for j in range(width)]
    return books


def fit_codebooks(
    vectors: DataFrame,
    id_col: str,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    owner_rows: int = OWNER_ROWS,
) -> np.ndarray:
    """The codebooks after ``rounds`` rounds: whole numbers by part, entry and place.

    ``vectors`` come from :func:`whole_numbers`. Entries start as the parts of the vectors with
    the least ids, null ids last, equal ids in the order of their vectors; with fewer vectors there
    are fewer entries. Each round assigns every part to its nearest entry, ties to the
    lower one, and replaces entries by their members' floored mean. A round that changes no entry
    is the last one, as all after it would be the same.

    The rows of an owner are bounded by a salt of the row's number, however many members
    an entry has; equal vectors are salted like others. Only the codebooks go to the driver
    and to the tasks. Raises ValueError for vectors of several lengths, for a length that
    ``parts`` does not divide, and for numbers of 2^27 or more, whose distances could leave 64 bits.
    """
    spark = vectors.sparkSession
    size = F.size("larder_x")
    top = F.greatest(F.array_max("larder_x"), -F.array_min("larder_x"))
    rows, low, high, largest = vectors.agg(F.count("*"), F.min(size), F.max(size), F.max(top)).first()
    if not rows:
        return np.zeros((parts, 0, 0), np.int64)
    if low != high or low % parts:
        raise ValueError(f"vectors must have one length that {parts} divides, not {low} to {high}")
    if largest >= LARGEST:
        raise ValueError(f"scaled components must be below {LARGEST}, not {largest}")
    first = vectors.orderBy(F.col(id_col).asc_nulls_last(), "larder_x").limit(entries)
    start = np.array([row["larder_x"] for row in first.select("larder_x").collect()], np.int64)
    books = start.reshape(len(start), parts, -1).swapaxes(0, 1).copy()

    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_BUCKETS)
    residents = Residents(spark, buckets)
    try:
        placed = place_parts(vectors, books, math.ceil(rows / owner_rows))
        residents.store(placed.repartition(buckets, *OWNER))
        for round_ in range(1, rounds + 1):
            before, books = books, owners_update(residents.read(), books)
            if round_ == rounds or np.array_equal(before, books):
                break
            now = marked(residents.read(), books)
            stay = now.where("not moved").drop("moved")
            arrive = now.where("moved").drop("moved").repartition(buckets, *OWNER)
            residents.store(stay.unionByName(arrive))
    finally:
        residents.drop()
    return books


def encode_vectors(vectors: DataFrame, books: np.ndarray, keep: Sequence[str]) -> DataFrame:
    """The kept columns, ``code`` (two hex digits for the entry of each part, in order) and ``error`` (the
    squared distances of all parts, summed). Narrow: each task has the codebooks."""
    parts, entries, width = books.shape
    if entries > 256:
        raise ValueError("two hex digits name at most 256 entries")

    def make():
        def work(batch: pa.RecordBatch) -> list:
            x = matrix(batch["larder_x"], parts * width).reshape(-1, parts, width)
            found = [nearest(x[:, p], books[p]) for p in range(parts)]
            code = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8)
            digits = code.tobytes().hex()
            codes = [digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)]
            return [*[batch[name] for name in keep], codes, sum(far for _, far in found)]

        return work

    fields = [vectors.schema[name] for name in keep]
    schema = T.StructType([*fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return map_batches(vectors.select(*keep, "larder_x"), schema, make, BATCH_BYTES)


def decode_codes(codes: Sequence[str], books: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The vectors that codes stand for: the entries of their parts, one after another."""
    parts, _, width = books.shape
    picked = np.frombuffer(bytes.fromhex("".join(codes)), np.uint8).reshape(-1, parts)
    return books[np.arange(parts), picked].reshape(-1, parts * width) / scale


def digest(books: np.ndarray) -> str:
    """The SHA-256 of all components by part, entry and place, with commas between them."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``(id, code, error, label_error, codebooks_sha256)`` of every vector that is whole.

    ``label_error`` is the error summed over the rows of the label, nulls together; a label that
    many rows have is added up before the shuffle, and the sums are joined. Rows whose
    vector is null or empty or holds a null, NaN or infinity are left out; null ids stay, repeated rows stay
    as often as they occur. No vectors give no rows. Only the three named columns are read.
    """
    keep = [column(id_col).alias("larder_id"), column(label_col).alias("larder_label")]
    vectors = whole_numbers(df, vector_col, keep)
    books = fit_codebooks(vectors, "larder_id", parts, entries, rounds)
    coded = saved(encode_vectors(vectors, books, ["larder_id", "larder_label"]), "codes")
    totals = coded.groupBy("larder_label").agg(F.sum("error").alias("label_error"))
    totals = small(saved(totals.withColumnRenamed("larder_label", "larder_of"), "label-errors"))
    joined = coded.join(totals, F.col("larder_label").eqNullSafe(F.col("larder_of")))
    return joined.select(
        F.col("larder_id").alias(id_col),
        "code",
        "error",
        "label_error",
        F.lit(digest(books)).alias("codebooks_sha256"),
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def codes_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The query in SQL, its rounds written out."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
        near{r} AS MATERIALIZED (
          SELECT vec_id, p, any_value(x) AS x, min(far * {entries} + e) AS best
          FROM (SELECT vec_id, p, x, e, list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(x, c)])::BIGINT AS far
                FROM parts JOIN book{r} USING (p))
          GROUP BY vec_id, p)""")
        if r < rounds:
            steps.append(f"""
        sums{r} AS (
          SELECT p, e, j, sum(v)::BIGINT AS s, count(*) AS n
          FROM (SELECT p, best % {entries} AS e, unnest(x) AS v, unnest(range(len(x))) AS j FROM near{r})
          GROUP BY p, e, j),
        mean{r} AS (
          SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY j) AS m FROM sums{r} GROUP BY p, e),
        book{r + 1} AS MATERIALIZED (
          SELECT p, e, coalesce(m, c) AS c FROM book{r} LEFT JOIN mean{r} USING (p, e))""")
    return f"""
        WITH kept AS MATERIALIZED (
          SELECT vec_id, label, [floor(x::DOUBLE * {SCALE})::BIGINT for x in embedding] AS v
          FROM embeddings
          WHERE len(embedding) > 0
            AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
        parts AS MATERIALIZED (
          SELECT vec_id, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x
          FROM kept, range({parts}) AS t(p)),
        first AS (
          SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e
          FROM kept ORDER BY vec_id LIMIT {entries}),
        book0 AS MATERIALIZED (SELECT p, e, x AS c FROM parts JOIN first USING (vec_id)),
        {",".join(steps)},
        coded AS (
          SELECT vec_id, string_agg(printf('%02x', best % {entries}), '' ORDER BY p) AS code,
                 sum(best // {entries})::BIGINT AS error
          FROM near{rounds} GROUP BY vec_id),
        digest AS (
          SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256
          FROM book{rounds})
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
        FROM coded JOIN kept USING (vec_id), digest
    """


OP12_SQL = codes_sql()
