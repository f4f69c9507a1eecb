"""Issue-side tables from files or from a database over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

TABLES = ("issues", "folders", "team", "sprints")


@dataclass(frozen=True)
class JdbcSource:
    """A database to read from. Credentials belong into ``options`` at run time
    or into a Spark credential provider, never into code."""

    url: str
    options: dict[str, str] = field(default_factory=dict)
    fetch_size: int = 10_000

    def reader_options(self) -> dict[str, str]:
        """Spark options for any table."""
        return {"fetchsize": str(self.fetch_size), **self.options}


def range_predicates(column: str, bounds: list[str]) -> list[str]:
    """SQL conditions that cut a table at the given texts, each row in exactly one of them,
    nulls included. Texts are what the issue table has for ids and dates, which Spark's own
    numeric split can't use."""
    cuts = ["'" + bound.replace("'", "''") + "'" for bound in sorted(set(bounds))]
    if not cuts:
        raise ValueError("at least one bound is needed to split a table")
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def read_jdbc(
    spark: SparkSession, source: JdbcSource, table: str, predicates: list[str] | None = None
) -> DataFrame:
    """A table over one connection per predicate. The issues, which grow without bound,
    can't be read without; the other tables come through one connection."""
    if predicates is None and table == "issues":
        raise ValueError("issues need predicates, as one connection would read the whole table")
    return spark.read.jdbc(source.url, table, predicates=predicates, properties=source.reader_options())


def read_files(spark: SparkSession, folder: str, table: str, file_format: str = "parquet") -> DataFrame:
    """A table stored as ``<folder>/<table>``, in any format Spark reads."""
    return spark.read.format(file_format).load(f"{folder}/{table}")


def read_issue_tables(spark: SparkSession, folder: str, file_format: str = "parquet") -> dict[str, DataFrame]:
    return {table: read_files(spark, folder, table, file_format) for table in TABLES}
