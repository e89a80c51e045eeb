
from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.operators.cluster import assign, fit_kmeans, nearest_centroid, silhouette, sweep_k
from larder.operators.features import assemble, fit_scaler, scale, standardise
from larder.operators.profile import column_profile, null_profile
from larder.operators.shape import (
    drop_if_present,
    drop_sparse,
    drop_strict,
    drop_vectors,
    fill_missing,
    keep_numeric,
    rename_columns,
    sample_rows,
)
from larder.operators.text import word_count
from larder.plans.clustering import score_published
from larder.plans.datamart import publish_scaled, scale_jdbc_table
from larder.plans.products import clean_products, load_products_jdbc, load_products_table
from larder.plans.wordcount import count_words
from larder.session import new_run_dir
from larder.sinks import publish_parquet, run_sql, write_csv, write_jdbc, write_parquet
from larder.sources import read_csv, read_jdbc, read_jdbc_query, read_lines, read_parquet, read_quoted_csv, read_tsv
from larder.streaming import (
    append_batch_to,
    count_new_lines,
    merged_counts,
    process_new,
    read_published,
    stream_files,
)

try:
    import corpus_pipeline
    from larder.llm.queries import llm_oracle_sql, llm_queries

    LLM_QUERIES = llm_queries() | {"pipeline": corpus_pipeline.run}
    LLM_SQL = llm_oracle_sql()
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "larder.llm"):
        raise
    LLM_QUERIES, LLM_SQL = {}, {}

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def holed_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with missing values, as the tables themselves have none."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.when(F.col("l_linenumber") == 1, F.col("l_quantity")).alias("q1"),
        "l_returnflag",
    )


def scaled_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardise(assemble(table(spark, sf_dir, "lineitem"), MEASURES))


def vector_values(df: DataFrame, vector_col: str, keys: list[str]) -> DataFrame:
    """The keys and the four vector elements, rounded, as plain columns."""
    values = vector_to_array(vector_col)
    return df.select(
        *keys, *[F.round(values[i], 6).alias(f"f{i}") for i in range(len(MEASURES))]
    )


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("scaled")
    )


def label_means(vectors: DataFrame) -> DataFrame:
    return vectors.groupBy("label").agg(Summarizer.mean(F.col("scaled")).alias("scaled"))


def score_row(spark: SparkSession, score: float) -> DataFrame:
    return spark.createDataFrame([(round(score, 6),)], "silhouette double")


def entry(spark: SparkSession) -> DataFrame:
    """lineitem -> assemble -> standardise -> k-means for k = 2..9 -> silhouette per k."""
    return sweep_k(scaled_measures(spark, "/root/testdata/sf0.001"))


# Word counts


def word_count_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(table(spark, sf_dir, "documents"), "text")


def word_count_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(table(spark, sf_dir, "conversations"), "text")


def document_files(spark: SparkSession, sf_dir: str) -> str:
    path = f"{new_run_dir(spark, 'lines')}/text"
    table(spark, sf_dir, "documents").select("text").write.text(path)
    return path


def word_count_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_words(spark, document_files(spark, sf_dir))


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_lines(spark, document_files(spark, sf_dir))
    return lines.groupBy(F.length("value").alias("n_chars")).agg(F.count("*").alias("n_lines"))


def word_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = new_run_dir(spark, "word-stream")
    source = document_files(spark, sf_dir)
    count_new_lines(spark, source, f"{run}/counts", f"{run}/checkpoint")
    return merged_counts(spark, f"{run}/counts")


# Profiles and column shaping


def null_profile_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(holed_lineitem(spark, sf_dir))


def column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_profile(table(spark, sf_dir, "part"))


def drop_sparse_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_sparse(holed_lineitem(spark, sf_dir), min_fraction=0.3)


def fill_missing_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_missing(holed_lineitem(spark, sf_dir))


def keep_numeric_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_numeric(table(spark, sf_dir, "orders"))


def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return drop_if_present(drop_strict(customer, "c_name"), "c_mktsegment", "no_such_column")


def rename_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return rename_columns(part.toDF(*[name.replace("_", "-") for name in part.columns]))


def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sample_rows(table(spark, sf_dir, "orders"), 1000, order_by=["o_orderkey"])
    return rows.withColumn("o_orderdate", F.col("o_orderdate").cast("date").cast("string"))


def clean_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = holed_lineitem(spark, sf_dir)
    return clean_products(
        rows, sample=1000, order_by=rows.columns, min_present=300, drop=["l_orderkey"]
    )


def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_products(holed_lineitem(spark, sf_dir), min_fraction=0.3, drop=["l_orderkey"])


def clean_raw_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{new_run_dir(spark, 'raw')}/products"
    write_csv(holed_lineitem(spark, sf_dir), path, sep="\t", compression="gzip")
    return clean_products(read_tsv(spark, path), min_fraction=0.3, drop=["l_orderkey"], infer=True)


# Features


def skip_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assemble(holed_lineitem(spark, sf_dir), MEASURES, handle_invalid="skip")
    return vector_values(rows, "features", ["l_orderkey", "l_linenumber"])


def reject_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null or NaN would fail the job; ``lineitem`` has none."""
    rows = assemble(table(spark, sf_dir, "lineitem"), MEASURES, handle_invalid="error")
    return vector_values(rows, "features", ["l_orderkey", "l_linenumber"])


def column_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fit_scaler(assemble(table(spark, sf_dir, "lineitem"), MEASURES))
    rows = [(name, round(float(std), 6)) for name, std in zip(MEASURES, model.std)]
    return spark.createDataFrame(rows, "column_name string, std double")


def scaled_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assemble(table(spark, sf_dir, "lineitem"), MEASURES)
    return vector_values(scale(rows, fit_scaler(rows)), "scaled", ["l_orderkey", "l_linenumber"])


def published_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = new_run_dir(spark, "datamart")
    write_csv(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES), f"{run}/csv")
    path = publish_scaled(spark, f"{run}/csv", f"{run}/scaled", MEASURES)
    rows = vector_values(read_published(spark, path), "scaled", ["l_orderkey", "l_linenumber"])
    return rows.withColumns(
        {"l_orderkey": F.col("l_orderkey").cast("bigint"), "l_linenumber": F.col("l_linenumber").cast("int")}
    )


# Clustering


def silhouette_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scaled_measures(spark, sf_dir).select(
        "scaled", (F.ascii("l_returnflag") % 3).alias("prediction")
    )
    return score_row(spark, silhouette(rows))


def silhouette_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_row(spark, silhouette(embedding_vectors(spark, sf_dir), prediction_col="label"))


def nearest_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = embedding_vectors(spark, sf_dir)
    return nearest_centroid(vectors, label_means(vectors)).select("vec_id", "nearest")


def kmeans_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweep_k(embedding_vectors(spark, sf_dir).select("scaled"))


def separated_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as two groups so far apart that every k-means with k = 2 must find them."""
    apart = F.when(F.col("l_linenumber") <= 3, F.lit(0.0)).otherwise(F.lit(200.0))
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity") + apart).alias("x"), F.col("l_discount").alias("y")
    )
    return assemble(rows, ["x", "y"], "scaled")


def kmeans_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = separated_groups(spark, sf_dir)
    found = assign(rows, fit_kmeans(rows, k=2)).groupBy("prediction")
    return found.agg(
        F.count("*").alias("n_rows"), F.round(F.avg("x"), 6).alias("mean_x"), F.max("x").alias("max_x")
    ).drop("prediction")


def distant_groups(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """lineitem as ``k`` groups far apart, which k-means finds from one centre in each of them."""
    apart = (F.col("l_orderkey") % k) * 1000.0
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity") + apart).alias("x"), F.col("l_discount").alias("y")
    )
    return assemble(rows, ["x", "y"], "scaled")


def sweep_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [sweep_k(distant_groups(spark, sf_dir, k), [k], init="farthest") for k in range(2, 10)]
    return reduce(DataFrame.union, parts).select("k", F.round("silhouette", 6).alias("silhouette"))


def sweep_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each score of the sweep is the one that Spark's evaluator gives the same model."""
    rows = embedding_vectors(spark, sf_dir).select("scaled")
    found = []
    for k, score in sweep_k(rows).collect():
        single = silhouette(assign(rows, fit_kmeans(rows, k)))
        found.append((k, abs(score - single) < 1e-8))
    return spark.createDataFrame(found, "k int, agrees boolean")


def published_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_run_dir(spark, "sweep")
    return score_published(spark, publish_parquet(scaled_measures(spark, sf_dir), root, "1"))


def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scaled_measures(spark, sf_dir)
    model = fit_kmeans(rows, k=4)
    return assign(rows, model).select("l_orderkey", "l_linenumber", *MEASURES, "prediction")


def kmeans_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the centre that each row was given is the nearest of all."""
    rows = scaled_measures(spark, sf_dir)
    model = fit_kmeans(rows, k=4)
    values = vector_to_array("scaled")
    apart = [
        sum((values[i] - float(v)) * (values[i] - float(v)) for i, v in enumerate(centre))
        for centre in model.clusterCenters()
    ]
    distances = F.array(*apart)
    nearest = distances[F.col("prediction")] <= F.array_min(distances) + 1e-9
    return assign(rows, model).select("l_orderkey", "l_linenumber", nearest.alias("nearest"))


# Sources, sinks and published files


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_parquet(scaled_measures(spark, sf_dir), new_run_dir(spark, "parquet"))
    return drop_vectors(read_parquet(spark, path)).withColumn(
        "l_shipdate", F.col("l_shipdate").cast("date").cast("string")
    )


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return read_csv(spark, write_csv(part, new_run_dir(spark, "csv")), part.schema)


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_csv(table(spark, sf_dir, "customer"), new_run_dir(spark, "csv"))
    return read_csv(spark, path, infer=True).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


def csv_quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    note = F.concat_ws("\n", F.lit('"Note", first line'), F.col("source"), F.col("text"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", note.alias("note"))
    path = write_csv(docs, new_run_dir(spark, "csv"))
    return read_quoted_csv(spark, path, docs.schema)


def tsv_gz_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = write_csv(customer, new_run_dir(spark, "tsv"), sep="\t", compression="gzip")
    return read_tsv(spark, path, customer.schema)


def table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        *[F.col(name).alias(name.replace("_", "-")) for name in MEASURES], F.lit(0).alias("left-out")
    )
    name = f"larder_{uuid.uuid4().hex}"
    path = f"{new_run_dir(spark, 'table')}/{name}"
    load_products_table(
        rows, name, {column: "FLOAT" for column in MEASURES}, left_out=["left_out"], location=path
    )
    run_sql(spark, f"DROP TABLE {name}")  # the files of a table with a location stay
    stored = read_parquet(spark, path)
    return stored.select([F.col(column).cast("double").alias(column) for column in MEASURES])


def embedded_database() -> str:
    """An in-memory database of this JVM; executors on other machines cannot reach it."""
    return f"jdbc:derby:memory:larder{uuid.uuid4().hex};create=true"


EMBEDDED = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def jdbc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = embedded_database()
    supplier = table(spark, sf_dir, "supplier")
    write_jdbc(assemble(supplier, ["s_acctbal"]), url, "supplier", mode="overwrite", properties=EMBEDDED)
    return read_jdbc(
        spark, url, "supplier", partition_column="s_suppkey", num_partitions=4, properties=EMBEDDED
    )


def jdbc_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = embedded_database()
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("c-nationkey"),
        F.col("c_acctbal").alias("c-acctbal"),
        F.lit(0).alias("left-out"),
    )
    load_products_jdbc(
        rows,
        url,
        "balances",
        {"c_nationkey": "INTEGER", "c_acctbal": "FLOAT"},
        left_out=["left_out"],
        properties=EMBEDDED,
    )
    counts = 'SELECT "c_nationkey", COUNT(*) AS "n", MAX("c_acctbal") AS "top" FROM balances GROUP BY "c_nationkey"'
    return read_jdbc_query(spark, url, counts, EMBEDDED).select(
        "c_nationkey", F.col("n").cast("bigint").alias("n"), F.col("top").cast("double").alias("top")
    )


def jdbc_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = embedded_database()
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif("c_nationkey", F.lit(0)).alias("c_nationkey"), "c_acctbal"
    )
    write_jdbc(rows, url, "features", properties=EMBEDDED)
    values = vector_to_array("scaled")
    scaled = scale_jdbc_table(
        spark, url, "features", ["c_nationkey", "c_acctbal"],
        partition_column="c_custkey", num_partitions=4, properties=EMBEDDED,
    )
    return scaled.select(
        *[F.round(values[i], 6).alias(f"f{i}") for i in range(2)]
    )


def published_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = new_run_dir(spark, "events")
    path = publish_parquet(table(spark, sf_dir, "events"), run, "1")
    events = read_published(spark, path)
    process_new(
        stream_files(spark, path, events.schema),
        append_batch_to(f"{run}/seen"),
        f"{run}/checkpoint",
    )
    seen = spark.read.parquet(f"{run}/seen")
    return seen.groupBy("event_type").agg(F.count("*").alias("n"))


def published_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = new_run_dir(spark, "nearest")
    vectors = embedding_vectors(spark, sf_dir)
    path = publish_parquet(vectors, run, "1")
    scored = nearest_centroid(stream_files(spark, path, vectors.schema), label_means(vectors))
    process_new(scored.select("vec_id", "nearest"), append_batch_to(f"{run}/scored"), f"{run}/checkpoint")
    return spark.read.parquet(f"{run}/scored").select("vec_id", "nearest")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return LLM_QUERIES | {
        "word_count_documents": word_count_documents,
        "word_count_conversations": word_count_conversations,
        "word_count_files": word_count_files,
        "word_count_stream": word_count_stream,
        "text_lines": text_lines,
        "null_profile": null_profile_lineitem,
        "column_types": column_types,
        "drop_sparse_columns": drop_sparse_columns,
        "fill_missing": fill_missing_lineitem,
        "keep_numeric": keep_numeric_orders,
        "drop_columns": drop_columns,
        "rename_columns": rename_part,
        "first_rows": first_rows,
        "clean_sample": clean_sample,
        "clean_table": clean_table,
        "clean_raw_file": clean_raw_file,
        "skip_invalid": skip_invalid,
        "reject_invalid": reject_invalid,
        "column_std": column_std,
        "scaled_lineitem": scaled_lineitem,
        "published_scaled": published_scaled,
        "silhouette_by_flag": silhouette_by_flag,
        "silhouette_embeddings": silhouette_embeddings,
        "nearest_centroid": nearest_label,
        "kmeans_groups": kmeans_groups,
        "sweep_groups": sweep_groups,
        "sweep_agreement": sweep_agreement,
        "kmeans_nearest": kmeans_nearest,
        "kmeans_sweep": kmeans_sweep,
        "published_sweep": published_sweep,
        "kmeans_assign": kmeans_assign,
        "parquet_roundtrip": parquet_roundtrip,
        "csv_roundtrip": csv_roundtrip,
        "csv_inferred": csv_inferred,
        "csv_quoted_lines": csv_quoted_lines,
        "tsv_gz_scan": tsv_gz_scan,
        "table_load": table_load,
        "jdbc_roundtrip": jdbc_roundtrip,
        "jdbc_load": jdbc_load,
        "jdbc_scaled": jdbc_scaled,
        "published_batch": published_batch,
        "published_nearest": published_nearest,
    }


HOLED = """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
       nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax,
       CASE WHEN l_linenumber = 1 THEN l_quantity END AS q1, l_returnflag
FROM lineitem
"""

SCALED = """
SELECT l_orderkey, l_linenumber,
       round(l_quantity / (SELECT stddev_samp(l_quantity) FROM lineitem), 6) AS f0,
       round(l_extendedprice / (SELECT stddev_samp(l_extendedprice) FROM lineitem), 6) AS f1,
       round(l_discount / (SELECT stddev_samp(l_discount) FROM lineitem), 6) AS f2,
       round(l_tax / (SELECT stddev_samp(l_tax) FROM lineitem), 6) AS f3
FROM lineitem
"""

CLEAN = """
SELECT l_linenumber, l_quantity, l_extendedprice,
       coalesce(l_discount, 0) AS l_discount, coalesce(l_tax, 0) AS l_tax
"""

NEAREST = """
WITH element AS (
  SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings
), mean AS (
  SELECT label, i, avg(v) AS m FROM element GROUP BY label, i
), center AS (
  SELECT label, list(m ORDER BY i) AS c FROM mean GROUP BY label
)
SELECT vec_id, arg_min(center.label, list_distance(embedding::DOUBLE[], c)) AS nearest
FROM embeddings, center GROUP BY vec_id
"""

FLAG_POINTS = """
SELECT row_number() OVER () AS id, ascii(l_returnflag) % 3 AS g,
       l_quantity / (SELECT stddev_samp(l_quantity) FROM lineitem) AS a,
       l_extendedprice / (SELECT stddev_samp(l_extendedprice) FROM lineitem) AS b,
       l_discount / (SELECT stddev_samp(l_discount) FROM lineitem) AS c,
       l_tax / (SELECT stddev_samp(l_tax) FROM lineitem) AS d
FROM lineitem
"""

GROUPS = """
SELECT l_linenumber <= 3 AS g, l_quantity + CASE WHEN l_linenumber <= 3 THEN 0 ELSE 200 END AS x,
       l_discount AS y
FROM lineitem
"""


def silhouette_of(points: str) -> str:
    """The silhouette of points (id, a, b, c, d) in clusters g, from sums per cluster."""
    return f"""
WITH p AS ({points}), q AS (
  SELECT *, a * a + b * b + c * c + d * d AS norm FROM p
), cluster AS (
  SELECT g, count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(d) AS md, avg(norm) AS spread
  FROM q GROUP BY g
), distance AS (
  SELECT q.id, q.g = cluster.g AS own, cluster.n AS n,
         norm + spread - 2 * (a * ma + b * mb + c * mc + d * md) AS dist
  FROM q, cluster
), pair AS (
  SELECT id, max(CASE WHEN own THEN n END) AS n, max(CASE WHEN own THEN dist * n / (n - 1) END) AS x,
         min(CASE WHEN NOT own THEN dist END) AS y
  FROM distance GROUP BY id
)
SELECT round(avg(CASE WHEN n = 1 OR x = y THEN 0 WHEN x < y THEN 1 - x / y ELSE y / x - 1 END), 6)
       AS silhouette
FROM pair
"""


def scores_of(points) -> str:
    """``(k, silhouette)`` for k = 2..9; ``points(k)`` names the clusters."""
    return " UNION ALL ".join(
        f"SELECT {k} AS k, silhouette FROM ({silhouette_of(points(k))})" for k in range(2, 10)
    )


LABEL_SILHOUETTE = """
WITH e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
), pair AS (
  SELECT a.vec_id, a.label AS g, b.label AS h, list_distance(a.v, b.v) ** 2 AS dist
  FROM e a, e b WHERE a.vec_id <> b.vec_id
), per_cluster AS (
  SELECT vec_id, g, h, avg(dist) AS dist FROM pair GROUP BY vec_id, g, h
), per_point AS (
  SELECT vec_id, max(CASE WHEN g = h THEN dist END) AS x, min(CASE WHEN g <> h THEN dist END) AS y
  FROM per_cluster GROUP BY vec_id
)
SELECT round(avg(CASE WHEN x IS NULL OR x = y THEN 0 WHEN x < y THEN 1 - x / y ELSE y / x - 1 END), 6)
       AS silhouette
FROM per_point
"""

DOCUMENT_LINES = "SELECT unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS line FROM documents"


def words_of(name: str) -> str:
    return f"""
SELECT word, count(*) AS n FROM (
  SELECT unnest(string_split(line, ' ')) AS word FROM (
    SELECT unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS line FROM {name}))
GROUP BY word
"""


def oracle_sql() -> dict[str, str]:
    holed = ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "q1", "l_returnflag")
    part = {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string",
            "p_size": "int", "p_retailprice": "double"}
    return LLM_SQL | {
        "word_count_documents": words_of("documents"),
        "word_count_conversations": words_of("conversations"),
        "word_count_files": words_of("documents"),
        "word_count_stream": words_of("documents"),
        "text_lines": f"""
            SELECT length(line)::INTEGER AS n_chars, count(*) AS n_lines
            FROM ({DOCUMENT_LINES}) GROUP BY length(line)
        """,
        "null_profile": " UNION ALL ".join(
            f"SELECT '{name}' AS column_name, count(*) - count({name}) AS n_missing, "
            f"count({name}) AS n_present FROM ({HOLED})"
            for name in holed
        ),
        "column_types": " UNION ALL ".join(
            f"SELECT '{name}' AS column_name, '{kind}' AS data_type, "
            f"count(*) - count({name}) AS n_missing, count({name}) AS n_present FROM part"
            for name, kind in part.items()
        ),
        "drop_sparse_columns": f"SELECT * EXCLUDE (q1) FROM ({HOLED})",
        "fill_missing": f"""
            SELECT * REPLACE (coalesce(l_discount, 0) AS l_discount, coalesce(l_tax, 0) AS l_tax,
                              coalesce(q1, 0) AS q1)
            FROM ({HOLED})
        """,
        "keep_numeric": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
        "drop_columns": "SELECT c_custkey, c_nationkey, c_acctbal FROM customer",
        "rename_columns": "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
        "first_rows": "SELECT * REPLACE (o_orderdate::DATE::VARCHAR AS o_orderdate) FROM orders ORDER BY o_orderkey LIMIT 1000",
        "clean_sample": f"""
            {CLEAN} FROM (
              SELECT * FROM ({HOLED}) ORDER BY {", ".join(f"{name} NULLS FIRST" for name in holed)}
              LIMIT 1000)
        """,
        "clean_table": f"{CLEAN} FROM ({HOLED})",
        "clean_raw_file": f"{CLEAN.replace('l_linenumber', 'l_linenumber::BIGINT AS l_linenumber')} FROM ({HOLED})",
        "skip_invalid": f"""
            SELECT l_orderkey, l_linenumber, round(l_quantity, 6) AS f0, round(l_extendedprice, 6) AS f1,
                   round(l_discount, 6) AS f2, round(l_tax, 6) AS f3
            FROM ({HOLED}) WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL
        """,
        "reject_invalid": """
            SELECT l_orderkey, l_linenumber, round(l_quantity, 6) AS f0, round(l_extendedprice, 6) AS f1,
                   round(l_discount, 6) AS f2, round(l_tax, 6) AS f3
            FROM lineitem
        """,
        "column_std": " UNION ALL ".join(
            f"SELECT '{name}' AS column_name, round(stddev_samp({name}), 6) AS std FROM lineitem"
            for name in MEASURES
        ),
        "scaled_lineitem": SCALED,
        "published_scaled": SCALED,
        "silhouette_by_flag": silhouette_of(FLAG_POINTS),
        "silhouette_embeddings": LABEL_SILHOUETTE,
        "nearest_centroid": NEAREST,
        "kmeans_groups": f"""
            SELECT count(*) AS n_rows, round(avg(x), 6) AS mean_x, max(x) AS max_x
            FROM ({GROUPS}) GROUP BY g
        """,
        "sweep_groups": scores_of(
            lambda k: f"SELECT row_number() OVER () AS id, l_orderkey % {k} AS g, "
            f"l_quantity + (l_orderkey % {k}) * 1000 AS a, l_discount AS b, 0 AS c, 0 AS d FROM lineitem"
        ),
        "sweep_agreement": "SELECT k::INTEGER AS k, true AS agrees FROM range(2, 10) AS t(k)",
        "kmeans_nearest": "SELECT l_orderkey, l_linenumber, true AS nearest FROM lineitem",
        "parquet_roundtrip": "SELECT * REPLACE (l_shipdate::DATE::VARCHAR AS l_shipdate) FROM lineitem",
        "csv_roundtrip": "SELECT * FROM part",
        "csv_inferred": "SELECT * FROM customer",
        "csv_quoted_lines": """
            SELECT doc_id, lang, concat_ws(chr(10), '"Note", first line', source, text) AS note FROM documents
        """,
        "tsv_gz_scan": "SELECT * FROM customer",
        "table_load": "SELECT " + ", ".join(f"{n}::FLOAT::DOUBLE AS {n}" for n in MEASURES) + " FROM lineitem",
        "jdbc_roundtrip": "SELECT * FROM supplier",
        "jdbc_load": """
            SELECT c_nationkey, count(*) AS n, max(c_acctbal::FLOAT)::DOUBLE AS top
            FROM customer GROUP BY c_nationkey
        """,
        "jdbc_scaled": """
            SELECT round(c_nationkey / stddev_samp(c_nationkey) OVER (), 6) AS f0,
                   round(c_acctbal / stddev_samp(c_acctbal) OVER (), 6) AS f1
            FROM customer WHERE c_nationkey <> 0
        """,
        "published_batch": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
        "published_nearest": NEAREST,
    }
