"""Schema and missing-value profiles: one row per column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from larder.functions import present


def column_types(df: DataFrame) -> DataFrame:
    """``(column_name, data_type)`` in column order."""
    return df.sparkSession.createDataFrame(df.dtypes, "column_name string, data_type string")


def column_profile(df: DataFrame) -> DataFrame:
    """``(column_name, data_type, n_missing, n_present)`` from one pass over all columns.

    Null and NaN count as missing.
    """
    fields = df.schema.fields
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.array(*[F.count(present(f)) for f in fields]).alias("n_present"),
    )
    names = F.lit([f.name for f in fields])
    types = F.lit([f.dataType.simpleString() for f in fields])
    return counts.select("n_rows", F.posexplode("n_present").alias("i", "n_present")).select(
        names[F.col("i")].alias("column_name"),
        types[F.col("i")].alias("data_type"),
        (F.col("n_rows") - F.col("n_present")).alias("n_missing"),
        "n_present",
    )


def null_profile(df: DataFrame) -> DataFrame:
    """``(column_name, n_missing, n_present)``."""
    return column_profile(df).drop("data_type")
