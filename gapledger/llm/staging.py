"""Intermediate tables in the shared folder.

Unlike a checkpoint, a written table is compressed, its columns can be pruned, and the
plan that reads it carries nothing of the plan that wrote it: in loops, inferred
constraints would otherwise grow with every round.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession


def staging_folder(spark: SparkSession) -> str:
    """This application's part of ``spark.checkpoint.dir``; removed when the driver's Python ends.

    A local session without that setting uses a temporary folder; a cluster has to name one.
    """
    application = spark.sparkContext.applicationId
    if application not in _FOLDERS:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if spark.sparkContext.master.split("[")[0] != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            shared = tempfile.mkdtemp(prefix="gapledger-")
        _FOLDERS[application] = f"{shared.rstrip('/')}/staged-{application}"
        atexit.register(remove_staged, spark)
    return _FOLDERS[application]


_FOLDERS: dict[str, str] = {}


def remove_staged(spark: SparkSession) -> None:
    """Delete what this application has staged. Frames that read it can't be used after."""
    if (context := spark.sparkContext)._jsc is None or (folder := _FOLDERS.pop(context.applicationId, None)) is None:
        return
    _delete(spark, folder)


#: Spark then deletes what a query has shuffled when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows that are worth a file. Each is created, renamed and opened by itself; where Hadoop has no native
#: library, the executor also starts three processes to set the rights of a file on a local folder.
FILE_ROWS = 100_000


def in_few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has ``rows`` rows at most, in one partition for ``FILE_ROWS`` of them or for each core.

    Partitions are only merged with others. Those of a large table are larger anyway and stay.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))


def staged(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df``, computed, written as a table of its own and read back.

    What was shuffled for it goes once the table stands. Otherwise it stays until the driver
    collects garbage, so that an operator of many steps holds the shuffles of all of them.
    With ``rows``, how many it has at most, it is written in few files.
    """
    spark = df.sparkSession
    if rows is not None:
        df = in_few_files(df, rows)
    path = f"{staging_folder(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


# Where the staged frames of this process lie.
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def remove_table(table: DataFrame) -> None:
    """Delete a frame that ``staged`` has returned, when nothing that is still to run reads it."""
    if (path := _PATHS.pop(table, None)) is not None:
        _delete(table.sparkSession, path)


def _delete(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
