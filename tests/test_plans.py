from __future__ import annotations

import csv
import gzip
import random

import pytest

from larder.__main__ import arguments, main
from larder.operators.features import NUTRITION_COLUMNS
from larder.plans.clustering import score_published
from larder.plans.datamart import publish_scaled, scale_jdbc_table
from larder.plans.products import PRODUCT_TABLE, clean_products, load_products_jdbc, load_products_table
from larder.session import CHECKPOINT_DIR, new_run_dir, shared_dir
from larder.sinks import write_jdbc
from larder.sources import read_csv, read_jdbc


@pytest.fixture
def products(tmp_path):
    """A product CSV with the ten nutrition columns and a name."""
    rng = random.Random(5)
    path = tmp_path / "products.csv"
    with open(path, "w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(["name", *NUTRITION_COLUMNS])
        for i in range(200):
            writer.writerow([f"item, {i}", *(round(rng.uniform(0, 100), 2) for _ in NUTRITION_COLUMNS)])
    return str(path)


@pytest.fixture
def raw_dump(tmp_path):
    """A raw product TSV: 20 of 30 rows have fat, 5 have salt."""
    path = tmp_path / "dump.csv.gz"
    with gzip.open(path, "wt") as file:
        file.write("code\tname\tfat_100g\tsalt_100g\tadded_t\n")
        for i in range(30):
            fat = f"{i / 4}" if i < 20 else ""
            salt = "1" if i < 5 else "NA"
            file.write(f"{i:05d}\tfood {i}\t{fat}\t{salt}\t2020-01-01\n")
    return str(path)


def test_csv_to_published_vectors_to_scores(spark, products, tmp_path):
    path = publish_scaled(spark, products, f"{tmp_path}/scaled", run_id="1")
    assert path.endswith("run_id=1")
    rows = spark.read.parquet(path)
    assert rows.columns == ["name", *NUTRITION_COLUMNS, "features", "scaled"]
    assert rows.count() == 200
    scores = score_published(spark, path, [2, 3]).collect()
    assert [row["k"] for row in scores] == [2, 3]


def test_a_hole_stops_the_datamart_unless_skipped(spark, products, tmp_path):
    with open(products, "a") as file:
        file.write("holed" + "," * len(NUTRITION_COLUMNS) + "\n")
    with pytest.raises(Exception):
        publish_scaled(spark, products, f"{tmp_path}/scaled")
    path = publish_scaled(spark, products, f"{tmp_path}/scaled", handle_invalid="skip")
    assert spark.read.parquet(path).count() == 200


def test_clean_from_text(spark, raw_dump):
    raw = read_csv(spark, raw_dump, sep="\t")
    cleaned = clean_products(raw, min_present=20, infer=True)
    assert cleaned.dtypes == [("fat_100g", "double")]
    assert sorted(row[0] for row in cleaned.collect()) == sorted([i / 4 for i in range(20)] + [0.0] * 10)
    assert clean_products(raw, min_present=5, infer=True).columns == ["fat_100g", "salt_100g"]
    sample = clean_products(raw, sample=10, order_by=["code"], min_present=5, infer=True)
    assert [row[0] for row in sample.orderBy("fat_100g").collect()] == [i / 4 for i in range(10)]
    first = clean_products(raw, sample=10, min_present=5, infer=True)
    assert sorted(row[0] for row in first.collect()) == [i / 4 for i in range(10)]
    with pytest.raises(ValueError):
        clean_products(raw, min_present=5, infer=True, drop=["nowhere"])


def test_load_products(spark, products, embedded, tmp_path):
    rows = read_csv(spark, products).drop("name")
    url, properties = embedded
    load_products_jdbc(rows, url, "food", properties=properties)
    stored = read_jdbc(spark, url, "food", num_partitions=1, properties=properties)
    assert stored.columns == list(PRODUCT_TABLE) and stored.count() == 200
    load_products_table(rows, "larder_food", location=f"{tmp_path}/food")
    table = spark.table("larder_food")
    assert table.dtypes == [(name, "float") for name in PRODUCT_TABLE] and table.count() == 200
    with pytest.raises(ValueError):
        load_products_table(read_csv(spark, products), "larder_food")
    load_products_table(read_csv(spark, products, infer=True).drop("name"), "larder_food")
    assert spark.table("larder_food").distinct().count() == 200
    spark.sql("DROP TABLE larder_food")


def test_scale_a_database_table(spark, embedded):
    url, properties = embedded
    rows = spark.createDataFrame([(1, 2.0), (2, None), (3, 6.0)], "a int, b double")
    write_jdbc(rows, url, "t", properties=properties)
    scaled = scale_jdbc_table(
        spark, url, "t", output_col="scaled_features", partition_column="a", num_partitions=2, properties=properties
    )
    found = sorted(row["scaled_features"].toArray().tolist() for row in scaled.collect())
    assert found == [pytest.approx([1 / 2**0.5, 2 / 8**0.5]), pytest.approx([3 / 2**0.5, 6 / 8**0.5])]


def test_command_line(spark, products, raw_dump, tmp_path, capsys, monkeypatch):
    main(["datamart", products, f"{tmp_path}/scaled", "--run-id", "1"])
    assert "run_id=1" in capsys.readouterr().out
    main(["clusters", f"{tmp_path}/scaled/run_id=1", "--output", f"{tmp_path}/scores"])
    assert spark.read.parquet(f"{tmp_path}/scores").count() == 8
    main(["clusters", f"{tmp_path}/scaled/run_id=1", "--output", f"{tmp_path}/two", "--ks", "3", "5"])
    assert sorted(row["k"] for row in spark.read.parquet(f"{tmp_path}/two").collect()) == [3, 5]
    main(["clean", raw_dump, f"{tmp_path}/clean", "--rows", "10", "--order-by", "code", "--min-present", "5"])
    assert read_csv(spark, f"{tmp_path}/clean").columns == ["fat_100g", "salt_100g"]
    main(["wordcount", products, "--output", f"{tmp_path}/words"])
    assert spark.read.parquet(f"{tmp_path}/words").where("word = '\"item,'").first()["n"] == 200
    main(["wordcount", products])
    spark.sql(f"CREATE TABLE larder_fat (fat_100g DOUBLE, salt_100g DOUBLE) USING parquet LOCATION '{tmp_path}/fat'")
    main(["load", f"{tmp_path}/clean", "larder_fat"])
    assert spark.table("larder_fat").count() == 10
    spark.sql("DROP TABLE larder_fat")


def test_command_line_options():
    args = arguments(["clusters", "/d", "--ks", "3", "5", "--features", "v"])
    assert (args.ks, args.features) == ([3, 5], "v")
    args = arguments(["scale", "t", "/r", "--url", "jdbc:x", "--partition-column", "id", "--partitions", "8"])
    assert (args.partition_column, args.partitions) == ("id", 8)


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    assert shared_dir(spark) == (configured or spark.sparkContext.getCheckpointDir())
    assert new_run_dir(spark, "x") != new_run_dir(spark, "x")
