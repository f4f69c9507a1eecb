"""Dated report snapshots: one partition per run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DATE_COLUMN = "report_date"


def write_snapshot(report: DataFrame, path: str, report_date: dt.date, order_column: str | None = None) -> None:
    """Write one run. A rerun of the same date replaces that date only, also when it has
    no rows any more: Spark leaves a partition alone for which no row comes, so that one
    is then overwritten by a file without rows. With rows, the earlier ones go only when
    the new files are complete.

    ``order_column`` range-sorts the files, so that a reader of the folder sees
    the report in order.
    """
    if order_column:
        report = report.orderBy(order_column)
    written = Observation()
    (
        report.withColumn(DATE_COLUMN, F.lit(report_date))
        .observe(written, F.count(F.lit(1)).alias("row_count"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DATE_COLUMN)
        .parquet(path)
    )
    if not written.get["row_count"]:
        none = report.sparkSession.createDataFrame([], report.schema)
        none.write.mode("overwrite").parquet(f"{path}/{DATE_COLUMN}={report_date.isoformat()}")


def read_snapshot(spark: SparkSession, path: str, report_date: dt.date) -> DataFrame:
    return spark.read.parquet(path).filter(F.col(DATE_COLUMN) == F.lit(report_date))


def latest_snapshot(snapshots: DataFrame, before: dt.date) -> DataFrame:
    """The rows of the latest run before a date.

    The date comes from a scalar subquery, so that a partitioned store reads
    only that run's files.
    """
    dated = snapshots.filter(F.col(DATE_COLUMN) < F.lit(before))
    latest = dated.agg(F.max(DATE_COLUMN)).scalar()
    return dated.filter(F.col(DATE_COLUMN) == latest)
