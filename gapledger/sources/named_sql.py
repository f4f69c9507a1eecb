"""Queries kept as ``.sql`` files and run with named parameters."""

from __future__ import annotations

from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

FOLDER = Path(__file__).parent / "sql"


def query_text(name: str, folder: Path | str = FOLDER) -> str:
    return (Path(folder) / f"{name}.sql").read_text(encoding="utf-8")


def run_named_query(
    spark: SparkSession,
    name: str,
    params: dict[str, Any] | None = None,
    tables: dict[str, DataFrame] | None = None,
    folder: Path | str = FOLDER,
) -> DataFrame:
    """The query's result as a lazy DataFrame.

    ``:name`` in the text takes a value from ``params``; ``{name}`` takes a frame
    from ``tables``; other tables come from the session catalog.
    """
    return spark.sql(query_text(name, folder), args=params or {}, **(tables or {}))
