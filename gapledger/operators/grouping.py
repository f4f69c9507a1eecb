"""Distinct values: joined, ordered, or as set differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_values(value: Column) -> Column:
    """Aggregate: distinct non-null values, sorted so that runs agree."""
    return F.array_sort(F.collect_set(value))


def distinct_join(value: Column, separator: str) -> Column:
    """Aggregate: distinct non-null values as one text."""
    return F.array_join(distinct_values(value), separator)


def distinct_join_count(df: DataFrame, keys: list[str], columns: list[str], separator: str = ",") -> DataFrame:
    """Per key, the distinct values of each column as text and the row count.

    The columns should draw on bounded value sets (codes, names of a roster), as a key's
    sets are held at once while they grow. ``distinct_join_wide`` takes any number of values.
    """
    joined = [distinct_join(F.col(c).cast("string"), separator).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*joined, F.count(F.lit(1)).alias("count"))


#: Values that are joined to one text at a time.
PART_VALUES = 1_000


def distinct_join_wide(
    df: DataFrame, keys: list[str], columns: list[str], separator: str = ",", part_values: int = PART_VALUES
) -> DataFrame:
    """``distinct_join_count`` for keys with any number of distinct values.

    Values are made distinct first, as rows of (key, column, value): copies go before the
    shuffle, and the values of a hot key are spread over all tasks. Then they are sorted
    by key, which can spill, numbered, and joined to texts of ``part_values`` of them; what a
    key holds at once are these texts, that is the result itself. No set grows in the state
    of an aggregate.
    """
    slots = [F.struct(F.lit(i).alias("_slot"), F.col(c).cast("string").alias("_value")) for i, c in enumerate(columns)]
    # A row of its own counts the key's rows, also where all values are null.
    slots.append(F.struct(F.lit(-1).alias("_slot"), F.lit(None).cast("string").alias("_value")))
    valued = df.select(*keys, F.inline(F.array(*slots))).filter("_value IS NOT NULL OR _slot = -1")
    distinct = valued.groupBy(*keys, "_slot", "_value").agg(F.count(F.lit(1)).alias("_rows"))
    place = F.row_number().over(Window.partitionBy(*keys, "_slot").orderBy("_value"))
    part = F.floor((place - 1) / part_values).alias("_part")
    parts = distinct.select(*keys, "_slot", "_value", "_rows", place.alias("_place"), part)
    joined = lambda order, text: F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), separator
    )
    texts = parts.groupBy(*keys, "_slot", "_part").agg(
        joined("_place", "_value").alias("_text"), F.sum("_rows").alias("_rows")
    )
    texts = texts.groupBy(*keys, "_slot").agg(joined("_part", "_text").alias("_text"), F.sum("_rows").alias("_rows"))
    of = lambda i, c: F.max(F.when(F.col("_slot") == i, F.col(c)))
    return texts.groupBy(*keys).agg(
        *[F.coalesce(of(i, "_text"), F.lit("")).alias(c) for i, c in enumerate(columns)], of(-1, "_rows").alias("count")
    )


def first_seen(df: DataFrame, value: str, order: Column) -> DataFrame:
    """Distinct non-null values with the lowest ``order`` of each, as
    ``first_seen``. Sorting by it gives the values in order of appearance."""
    return df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.min(order).alias("first_seen"))


def values_not_in(df: DataFrame, column: str, known: tuple) -> DataFrame:
    """Distinct values outside a constant set; a null counts as outside."""
    outside = ~F.col(column).isin(list(known)) | F.col(column).isNull()
    return df.filter(outside).select(column).distinct()
