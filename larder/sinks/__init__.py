from larder.sinks.files import publish_parquet, stage, write_csv, write_parquet
from larder.sinks.jdbc import create_jdbc_table, write_jdbc
from larder.sinks.once import load_once
from larder.sinks.tables import append_table, create_table, run_sql

__all__ = [
    "append_table",
    "create_jdbc_table",
    "create_table",
    "load_once",
    "publish_parquet",
    "run_sql",
    "stage",
    "write_csv",
    "write_jdbc",
    "write_parquet",
]
