"""Tables of the session catalog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.functions import column
from larder.sinks.jdbc import ddl


def run_sql(spark: SparkSession, statement: str) -> DataFrame:
    """Run one SQL statement; a failure is raised."""
    return spark.sql(statement)


def create_table(
    spark: SparkSession, table: str, columns: Mapping[str, str], location: str | None = None
) -> None:
    """Create a Parquet table unless it exists; ``columns`` maps names to SQL types."""
    where = f" LOCATION '{location}'" if location else ""
    run_sql(spark, f"CREATE TABLE IF NOT EXISTS {table} ({ddl(columns)}) USING parquet{where}")


def append_table(df: DataFrame, table: str) -> None:
    """Insert rows by column name; columns the frame lacks become null.

    A column the table lacks is an error.
    """
    target = df.sparkSession.table(table).schema
    unknown = [name for name in df.columns if name not in target.names]
    if unknown:
        raise ValueError(f"{table} has no column {unknown}")
    df.select(
        [
            column(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    ).write.insertInto(table)
