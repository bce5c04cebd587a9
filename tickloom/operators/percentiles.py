"""Exact percentile summary per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.operators.running import running_sum
from tickloom.params import WindowParams
from tickloom.session import materialise

DEFAULT_QUANTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}


def percentiles(
    df: DataFrame, key: str, value: str, quantiles: dict[str, float] | None = None,
    rows_per_slice: int = WindowParams.rows_per_slice,
) -> DataFrame:
    """Per key the number of values and, per quantile q, the sorted value at 0-based index int(n*q).

    ``value`` is a whole-number column, such as a latency in microseconds. Equal values are counted
    before the shuffle; the running count over distinct values is cut into slices for hot keys.
    """
    quantiles = quantiles or DEFAULT_QUANTILES
    for name, q in quantiles.items():
        if not 0 <= q < 1:
            raise ValueError(f"quantile {name} must be in [0, 1), got {q!r}")
    counts = materialise(
        df.filter(F.col(value).isNotNull()).groupBy(key, F.col(value).cast("bigint").alias("_value"))
        .agg(F.count("*").alias("_rows")),
        "value-counts",
    )
    totals = materialise(counts.groupBy(key).agg(F.sum("_rows").alias("n")), "value-totals")
    ranked, _ = running_sum(counts, key, "_value", "_rows", "_upto", rows_per_slice)
    picks = [
        F.min(F.when(F.col("_upto") > F.floor(F.col("n") * F.lit(float(q))), F.col("_value"))).alias(name)
        for name, q in quantiles.items()
    ]
    return ranked.join(totals, key).groupBy(key, "n").agg(*picks)
