"""Row numbers over any amount of data, without a one-task window.

``row_number() over (order by ...)`` moves all rows, or all rows of a hot group,
into one task. Here the rows are range-sorted, which spreads even one hot group
over many partitions; the sorted rows are staged as a table, so that partition ids and
positions are fixed; and a table with one row per (partition, group) supplies
what has to be added to each partition's own positions.

``number_rows_lazily`` does without the table: what has to be added comes from a count of the
leading sort keys, so that nothing runs before the caller's own action.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapledger.staging import staged

# monotonically_increasing_id keeps the position in the low 33 bits and the
# partition above them.
_POSITION_BITS = 33


def number_rows(
    df: DataFrame,
    order_by: list[Column],
    number_column: str,
    group_by: list[str] | None = None,
) -> DataFrame:
    """``df`` with a 1-based ``number_column`` in ``order_by`` order, per group
    when ``group_by`` is given.

    The order has to be total (end it in a unique key), or equal rows may swap
    numbers between runs. Numbering is an action: the sorted rows are written to the
    staging folder while the plan is built, so pass only columns that are needed after it.
    """
    groups = list(group_by or [])
    placed = staged(
        df.orderBy(*[F.col(g).asc_nulls_first() for g in groups], *order_by)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    partition = F.shiftright("_place", _POSITION_BITS).alias("_partition")
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_position")
    placed = placed.select(*df.columns, partition, position)

    sizes = placed.groupBy("_partition", *groups).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_position").alias("_first")
    )
    # At most one row per partition in each window group.
    before = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = before.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        F.col("_partition").alias("_of_partition"),
        *[F.col(g).alias(f"_of_{g}") for g in groups],
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    same = F.col("_partition") == F.col("_of_partition")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    # Ungrouped, the shifts number one row per partition. Grouped, they grow with
    # the groups, so Spark decides by size; a hot group spans many partitions,
    # which keeps that join balanced either way.
    if not groups:
        shifts = F.broadcast(shifts)
    return placed.join(shifts, same, "left").select(
        *df.columns, (F.col("_position") + F.col("_shift")).alias(number_column)
    )


def number_rows_lazily(
    df: DataFrame,
    leading: dict[str, Callable[[Column], Column]],
    order_by: list[Column],
    number_column: str,
    split: str | None = None,
    parts: int = 64,
) -> DataFrame:
    """``df`` with a 1-based ``number_column``, by the ``leading`` columns (each with its sort
    order, say ``Column.desc``) and then ``order_by``. The plan runs no job of its own.

    Rows with equal leading columns are a cell. Cells are counted, and the counts of all cells
    before one are added to the row numbers inside it; each cell is a window of its own, so
    the leading columns should have few values beside the rows, and many beside the tasks. A cell
    that may be large is cut: ``split`` names the number by which ``order_by`` begins, ascending
    with nulls first, and a cell's span of it is cut into ``parts`` of equal width. Cuts come
    from the least and the largest value, which do not depend on the order rows are read in;
    cuts that did could differ between the plan's branches, and numbers with them.

    ``df`` is worked out up to three times, unless Spark finds that it can use a shuffle again.
    As with ``number_rows``, the whole order has to be total.
    """
    keys = list(leading)

    def at(table: DataFrame, *more: str) -> DataFrame:
        """A table by cell under other names, for the joins."""
        return table.select(
            *[F.col(k).alias(f"_of_{k}") for k in (*keys, *more)], *[c for c in table.columns if c not in (*keys, *more)]
        )

    def same(*more: str) -> Column:
        found = F.lit(True)
        for k in (*keys, *more):
            found = found & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
        return found

    if split is None:
        celled = df.withColumn("_part", F.lit(0))
    else:
        spans = df.groupBy(*keys).agg(F.min(split).alias("_least"), F.max(split).alias("_most"))
        # As double: monotone in the value, and neither sum nor difference leaves its range.
        wide = lambda c: F.col(c).cast("double")
        share = (wide(split) - wide("_least")) / F.greatest(wide("_most") - wide("_least"), F.lit(1.0))
        part = F.when(share.isNull(), F.lit(-1)).otherwise(F.least(F.floor(share * parts), F.lit(parts - 1))).cast("int")
        celled = df.join(at(spans), same(), "left").select(*df.columns, part.alias("_part"))
    counts = celled.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per cell and part.
    before = Window.orderBy(*[order(F.col(k)) for k, order in leading.items()], "_part")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order_by))
    return celled.withColumn("_inside", inside).join(at(starts, "_part"), same("_part"), "left").select(
        *df.columns, (F.col("_start") + F.col("_inside")).alias(number_column)
    )
