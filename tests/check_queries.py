"""Run every registered query beside its SQL in DuckDB and compare rows, types and values.

python tests/check_queries.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def sorted_rows(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


SPARK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    expected = connection.execute(sql)
    names = [column[0] for column in expected.description]
    if sorted(names) != sorted(result.columns):
        return [f"columns {sorted(result.columns)} instead of {sorted(names)}"]
    found = sorted_rows(result.columns, result.collect())
    wanted = sorted_rows(names, expected.fetchall())
    found_types = dict(result.dtypes)
    wanted_types = {column[0]: SPARK_TYPES[str(column[1])] for column in expected.description}
    problems = []
    if len(found) != len(wanted):
        problems.append(f"{len(found)} rows instead of {len(wanted)}")
    if found_types != wanted_types:
        problems.append(f"types {found_types} instead of {wanted_types}")
    unequal = [(a, b) for a, b in zip(found, wanted) if a != b]
    if unequal:
        problems.append(f"{len(unequal)} unequal rows, first {unequal[0]}")
    return problems


def main(sf_dir: str = "/root/testdata/sf0.01", *chosen: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(sf_dir)
    oracle = contract.oracle_sql()
    bad = 0
    for name, query in contract.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            result = query(spark, sf_dir)
            problems = differences(result, connection, oracle[name]) if name in oracle else []
            rows = "" if name in oracle else f" (no SQL, {result.count()} rows)"
        except Exception as error:
            problems, rows = [repr(error)[:2000]], ""
        bad += bool(problems)
        print(f"{'BAD ' if problems else 'ok  '} {name} {time.time() - start:.1f}s{rows} {problems or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
