"""Intermediate tables in the shared folder.

A written table cuts the lineage like a checkpoint does, but it is compressed and its
columns can be pruned.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Staging folder and staged tables of every application of this process.
_FOLDERS: dict[str, str] = {}
_TABLES: dict[str, list[str]] = {}


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder, on whatever file system it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staging_folder(spark: SparkSession) -> str:
    """This application's part of ``spark.checkpoint.dir``, removed when the process ends.

    Only a local session without that setting gets a temporary folder of its own; a cluster
    has to name shared storage, since executors may be lost.
    """
    application = spark.sparkContext.applicationId
    if application not in _FOLDERS:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if spark.sparkContext.master.split("[")[0] != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            shared = tempfile.mkdtemp(prefix="gapledger-local-only-")
        _FOLDERS[application] = f"{shared.rstrip('/')}/reports-{application}"
        _TABLES[application] = []
        atexit.register(remove_staged, spark)
    return _FOLDERS[application]


def remove_staged(spark: SparkSession) -> None:
    """Delete all that this application has staged. Frames that read it can't be used after."""
    if spark.sparkContext._jsc is None:
        return
    application = spark.sparkContext.applicationId
    if (folder := _FOLDERS.pop(application, None)) is not None:
        _TABLES.pop(application)
        remove_folder(spark, folder)


def staged(df: DataFrame) -> DataFrame:
    """``df``, worked out now, written as a table of its own and read back."""
    spark = df.sparkSession
    path = f"{staging_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _TABLES[spark.sparkContext.applicationId].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def discarding(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what was staged inside, whether the work succeeded or not."""
    staging_folder(spark)
    tables = _TABLES[spark.sparkContext.applicationId]
    before = len(tables)
    try:
        yield
    finally:
        for path in tables[before:]:
            remove_folder(spark, path)
        del tables[before:]
