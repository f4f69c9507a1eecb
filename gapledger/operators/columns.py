"""Schema-dependent projections."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_default(df: DataFrame, column: str, value: Any, type_name: str) -> DataFrame:
    """Add a constant column when the frame has none of that name."""
    if column in df.columns:
        return df
    return df.withColumn(column, F.lit(value).cast(type_name))


def renamed(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the columns that exist."""
    return df.withColumnsRenamed({old: new for old, new in mapping.items() if old in df.columns})
