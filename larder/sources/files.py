"""File scans: CSV, compressed TSV, text lines, Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from larder.functions import column

# The texts that pandas reads as a missing value.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

INTEGER = r"^\s*[+-]?\d{1,18}\s*$"
LONG_INTEGER = r"^\s*[+-]?\d{19,}\s*$"
UNSIGNED_MAX = "18446744073709551615"
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf(inity)?)\s*$"
BOOLEAN = r"^(?:True|TRUE|true|False|FALSE|false)$"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    *,
    infer: bool = False,
    sep: str = ",",
    multiline: bool = False,
) -> DataFrame:
    """CSV files with a header line and doubled quotes inside quoted fields.

    Give ``schema`` to type the columns without an extra read; it must name every column
    of the file, and the header is checked against it. ``infer=True`` reads the data once
    more to find the types. With neither, every column is a string.

    ``multiline`` allows line ends inside quoted fields, at the price of one task per file.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
    )
    # files whose headers differ in names or order must not be read by position
    reader = reader.option("enforceSchema", False)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", infer).csv(path)


def read_tsv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    *,
    infer: bool = False,
    partitions: int | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Tab-separated files with a header; a ``.gz`` file is read without unpacking.

    One gzip file is one task, however big: give ``partitions`` to spread its rows for the
    work that follows.
    """
    rows = read_csv(spark, path, schema, infer=infer, sep="\t", multiline=multiline)
    return rows if partitions is None else rows.repartition(partitions)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text files as one ``value`` per line; lines end with ``\\n``, ``\\r\\n`` or ``\\r``."""
    return spark.read.text(path)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows if columns is None else rows.select([column(name) for name in columns])


def blank_tokens(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Null out the string values that stand for "missing"."""
    return df.select(
        [
            F.when(~column(f.name).isin(*tokens), column(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else column(f.name)
            for f in df.schema.fields
        ]
    )


def infer_types(df: DataFrame) -> DataFrame:
    """Type the string columns whose every present value is a number or a boolean.

    One aggregation looks at all columns at once: it turns them into rows, which keeps the
    generated code small for hundreds of columns, and each task reduces them to one row per
    column. Whole numbers become ``bigint``, ones up to 2^64 - 1 ``decimal(20,0)``, and larger
    ones, or such next to fractions, stay strings, as no type keeps all their digits; other numbers ``double``, true/false texts
    ``boolean``; mixed columns, texts and columns without any value stay strings, and so do
    dates.
    """
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not strings:
        return df
    text = F.col("text")
    unsigned = F.trim(text).try_cast("decimal(38,0)").between(F.lit(0), F.lit(UNSIGNED_MAX).cast("decimal(20,0)"))
    long_kind = F.when(F.trim(text).try_cast("bigint").isNotNull(), 1).when(unsigned, 16).otherwise(8)
    seen = (
        df.select(F.posexplode(F.array(*[column(name) for name in strings])).alias("i", "text"))
        .groupBy("i")
        .agg(
            F.bit_or(
                F.when(text.rlike(INTEGER), 1)
                .when(text.rlike(LONG_INTEGER), long_kind)
                .when(text.rlike(NUMBER), 2)
                .when(text.rlike(BOOLEAN), 4)
                .when(text.isNotNull(), 8)
            ).alias("bits")
        )
        .collect()
    )
    kinds = {1: "bigint", 2: "double", 3: "double", 4: "boolean", 16: "decimal(20,0)", 17: "decimal(20,0)"}
    target = {strings[row["i"]]: kinds[row["bits"]] for row in seen if row["bits"] in kinds}
    return df.select(
        [
            column(name).cast(target[name]).alias(name) if name in target else column(name)
            for name in df.columns
        ]
    )
