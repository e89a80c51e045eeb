from larder.sources.files import (
    NA_TOKENS,
    blank_tokens,
    infer_types,
    read_csv,
    read_lines,
    read_parquet,
    read_tsv,
)
from larder.sources.jdbc import read_jdbc, read_jdbc_query
from larder.sources.records import read_quoted_csv

__all__ = [
    "NA_TOKENS",
    "blank_tokens",
    "infer_types",
    "read_csv",
    "read_jdbc",
    "read_jdbc_query",
    "read_lines",
    "read_parquet",
    "read_quoted_csv",
    "read_tsv",
]
