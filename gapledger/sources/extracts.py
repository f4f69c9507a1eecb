"""Approval extracts and earlier reports kept as CSV or Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapledger.operators.numbering import number_rows

APPROVAL_FIELDS = {
    "approval_id": T.LongType(),
    "title": T.StringType(),
    "needed_on": T.StringType(),
    "decision": T.StringType(),
    "approver": T.StringType(),
    "status": T.StringType(),
    "template_id": T.IntegerType(),
    "role": T.StringType(),
}
OPTIONAL_FIELDS = ("template_id", "role")


def approval_schema(with_template: bool = True, with_role: bool = True) -> T.StructType:
    left_out = set()
    if not with_template:
        left_out.add("template_id")
    if not with_role:
        left_out.add("role")
    return T.StructType([T.StructField(n, t) for n, t in APPROVAL_FIELDS.items() if n not in left_out])


# What reconciliation needs of an earlier report; everything else in it is left alone.
PREVIOUS_FIELDS = (
    "approval_link string, region string, plan_year string, request_type string, clean_title string, "
    "amount_mm double"
)


def read_approvals_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV extract with a header line. The schema is declared, so the file is
    read once; a header that disagrees with it is an error.

    ``multi_line`` allows line breaks inside quotes. It costs the split: each file is
    then read by one task, however long it is. Without it such a break is an error.
    """
    return spark.read.schema(schema or approval_schema()).csv(
        path, header=True, enforceSchema=False, multiLine=multi_line, escape='"', mode="FAILFAST"
    )


DAMAGED = "damaged_line"


def read_damaged_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """A CSV extract of which some lines may be damaged: the good rows, and the others as they stand.

    A line is damaged when it has more or fewer values than the schema has columns, or one
    that is not of its column's type. Such a line is part of the second frame, whole, beside
    its file; the rows around it are read as ever. A header that disagrees with the schema
    still is an error, since it puts every line in doubt.

    Lines are parsed whole whatever columns are asked for later: with fewer columns parsed,
    damage in the others would go unseen, and a line be good for one report and not for the next.
    ``multi_line`` is that of ``read_approvals_csv``; a quote that is never closed then takes the
    rest of its file along.
    """
    declared = schema or approval_schema()
    rows = spark.read.schema(T.StructType([*declared.fields, T.StructField(DAMAGED, T.StringType())])).csv(
        path, header=True, enforceSchema=False, multiLine=multi_line, escape='"', mode="PERMISSIVE",
        columnNameOfCorruptRecord=DAMAGED,
    )
    # True of every row, but it needs all columns, which makes the reader parse all.
    whole = F.xxhash64(*declared.names) <= F.lit(2**63 - 1)
    rows = rows.select(*declared.names, DAMAGED, F.col("_metadata.file_path").alias("source_file")).filter(whole)
    return (
        rows.filter(F.col(DAMAGED).isNull()).select(*declared.names),
        rows.filter(F.col(DAMAGED).isNotNull()).select("source_file", DAMAGED),
    )


def read_previous_csv(spark: SparkSession, path: str, position: str = "row_pos") -> DataFrame:
    """An earlier report as CSV without a header line, its first column ``position`` holding
    the row's place in the sheet. Lead rows (titles, headings) need not be cut off: their
    links hold no id, so that they match nothing, and amounts that are no numbers read null."""
    declared = ", ".join(f"{field.name} string" for field in _previous_schema())
    rows = spark.read.schema(f"{position} string, {declared}").csv(path, escape='"', mode="PERMISSIVE")
    return rows.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in _previous_schema()],
        F.col(position).try_cast("bigint").alias("row_pos"),
    )


def read_previous_parquet(spark: SparkSession, path: str) -> DataFrame:
    """An earlier report as Parquet, rows in sheet order. ``row_pos`` counts from 0 on through
    all files of a folder, as sorted reports are written to files that follow each other by name."""
    rows = spark.read.parquet(path).select("*", "_metadata.file_path", "_metadata.row_index")
    placed = counted_through_files(rows, spark.read.parquet(path).select("_metadata.file_path", "_metadata.row_index"))
    return placed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in _previous_schema()], "row_pos")


def counted_through_files(rows: DataFrame, places: DataFrame) -> DataFrame:
    """``rows`` with ``row_pos``, their place among the rows of all files; the files' own
    columns ``file_path`` and ``row_index`` go.

    ``places`` has these two columns of the same files and nothing else, so that sizing the
    files reads none of their data. No row moves: the sizes, one row per file, go to the rows.
    """
    sizes = places.groupBy("file_path").agg((F.max("row_index") + 1).alias("_rows"))
    # Shorter names first, as part-99999 comes before part-100000.
    folder, name = F.regexp_extract("file_path", "^(.*/)", 1), F.regexp_extract("file_path", "([^/]*)$", 1)
    before = Window.orderBy(folder, F.length(name), name).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("file_path").alias("_file"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    # As many rows as there are files, which the driver lists for any scan.
    joined = rows.join(F.broadcast(starts), F.col("file_path") == F.col("_file"))
    return joined.withColumn("row_pos", F.col("_start") + F.col("row_index")).drop(
        "file_path", "row_index", "_file", "_start"
    )


def _previous_schema() -> T.StructType:
    return T.StructType.fromDDL(PREVIOUS_FIELDS)


def read_approvals_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def approval_link(approval_id: Column, link_prefix: str) -> Column:
    """Spreadsheet formula that links to a request."""
    return F.format_string(f'=HYPERLINK("{link_prefix.replace("%", "%%")}%d", %d)', approval_id, approval_id)


def id_of_link(link: Column) -> Column:
    """Request id out of such a formula; 0 for any other text."""
    found = F.regexp_extract(link, r"HYPERLINK.*, (\d+)\)", 1)
    return F.coalesce(found.try_cast("bigint"), F.lit(0).cast("bigint"))


def positioned(report: DataFrame, order_by: list[Column]) -> DataFrame:
    """Give an earlier report without positions its ``row_pos``."""
    return number_rows(report, order_by, "row_pos")
