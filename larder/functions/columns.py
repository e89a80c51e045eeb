"""Column expressions that depend on a column's name or type."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T


def column(name: str) -> Column:
    """A top-level column by its exact name; hyphens, dots and backticks are allowed."""
    return F.col("`" + name.replace("`", "``") + "`")


def present(field: T.StructField) -> Column:
    """The value, or null where it is missing: null or, for floating point, NaN."""
    value = column(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return F.nanvl(value, F.lit(None))
    return value
