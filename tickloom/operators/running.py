"""Running aggregates over one ordered key, cut into slices where a key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.operators.slices import carry_in, cut, tasks_of


def _running(
    df: DataFrame, key: str, position: str, value: str, out: str, how: str, rows_per_slice: int, most: int | None
) -> tuple[DataFrame, bool]:
    combine = getattr(F, how)
    if most is None or most > rows_per_slice:
        sizes = df.groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
        most = sizes["most"] or 0
    if most <= rows_per_slice:
        so_far = Window.partitionBy(key).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, combine(value).over(so_far)), False

    rows = df.select(key, F.struct(*df.columns).alias("_row"), F.col(position).alias("_position"), F.col(value).alias("_value"))
    placed, slices = cut(rows, [key, "_position"], sizes["rows"], rows_per_slice, "running-slices")
    totals = placed.groupBy(key, "slice").agg(combine("_value").alias("_value"))
    carried = carry_in(totals, key, {"_value": how}).withColumn("_value", F.col("_value").cast(placed.schema["_value"].dataType))
    # A carried-in row has no position; nulls sort first.
    so_far = Window.partitionBy(key, "slice").orderBy("_position").rowsBetween(Window.unboundedPreceding, 0)
    joined = placed.unionByName(carried, allowMissingColumns=True).repartition(tasks_of(rows, slices, sizes["rows"]), key, "slice")
    summed = joined.withColumn(out, combine("_value").over(so_far)).filter(F.col("_row").isNotNull())
    return summed.select("_row.*", out), True


def running_max(
    df: DataFrame, key: str, position: str, value: str, out: str, rows_per_slice: int, most: int | None = None
) -> tuple[DataFrame, bool]:
    """Largest value so far per key, in order of ``position`` (unique per key).

    Also tells whether any key was cut into slices, i.e. whether the data is large. ``most`` is the
    number of rows of the largest key, if known.
    """
    return _running(df, key, position, value, out, "max", rows_per_slice, most)


def running_sum(df: DataFrame, key: str, position: str, value: str, out: str, rows_per_slice: int) -> tuple[DataFrame, bool]:
    """Sum so far per key, in order of ``position`` (unique per key)."""
    return _running(df, key, position, value, out, "sum", rows_per_slice, None)
