"""Cutting hot keys into consecutive slices.

A running computation over one key needs that key's rows in order, which for a hot symbol would mean
one huge task. Once any key has more than ``rows_per_slice`` rows, all rows are range-partitioned by key
and position, sorted, and written once with their slice: every ``rows_per_slice`` rows of a range are one. A
key that spans several slices hands its totals on, one small row per slice (see ``carry_in``). The number of
slices follows the number of rows, and Spark's range partitioner picks the bounds of the ranges, also within one
instant. Ranges are tasks: small slices share one, since what the driver samples, plans and tracks grows with
the number of tasks. Cuts only move work between tasks; any cuts give the same results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.session import materialise


#: Rows of a task that holds many small slices, about, and slices up to which each has its own.
TASK_ROWS, FEW = 500_000, 64
_NUMBER = (1 << 33) - 1  # the part of monotonically_increasing_id that counts a partition's rows


def tasks_of(rows: DataFrame, slices: int, count: int) -> int:
    """Tasks for so many slices of ``count`` rows."""
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(slices, max(FEW, usual, -(-count // TASK_ROWS)))


def cut(rows: DataFrame, by: list[str], count: int, rows_per_slice: int, name: str) -> tuple[DataFrame, int]:
    """``rows`` with their ``slice``, stored, and the number of slices. ``by`` starts with the key."""
    slices = max(2, -(-count // rows_per_slice))
    placed = rows.repartitionByRange(tasks_of(rows, slices, count), *by).sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id())
    # A slice is named by the place of its first row, so slices of one key are in order.
    first = F.col("_place") - F.col("_place").bitwiseAND(F.lit(_NUMBER)) % F.lit(rows_per_slice)
    return materialise(placed.withColumn("slice", first).drop("_place"), name), slices


def carry_in(totals: DataFrame, key: str, sums: dict[str, str]) -> DataFrame:
    """Total of all earlier slices of the key, per slice: ``totals(key, slice, *sums)``.

    ``sums`` maps each column to the aggregate that combines it (``sum`` or ``max``). One row per slice
    of a key, so the ordered pass over a key is as long as its number of slices.
    """
    before = Window.partitionBy(key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = [getattr(F, how)(name).over(before).alias(name) for name, how in sums.items()]
    first = next(iter(sums))
    return totals.select(key, "slice", *carried).filter(F.col(first).isNotNull())
