"""Flagging ticks whose price is far from their window's mean."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.functions.stats import evaluate_zscore
from tickloom.params import AnomalyParams


def zscore_anomaly(with_stats: DataFrame, params: AnomalyParams | None = None) -> DataFrame:
    """Add ``zscore`` and ``is_anomaly`` to ticks that carry ``stats``.

    A tick is an anomaly if |z| is strictly above the threshold; with fewer than ``min_samples``
    points in the window z is 0.0.
    """
    params = params or AnomalyParams()
    scored = with_stats.withColumn("zscore", evaluate_zscore(F.col("price"), F.col("stats"), params))
    return scored.withColumn("is_anomaly", F.abs("zscore") > F.lit(float(params.threshold)))


def processed_ticks(scored: DataFrame, *keep: str) -> DataFrame:
    """PROCESSED rows: tick, statistics, flag, and z where flagged."""
    return scored.select(
        "symbol", "price", "quantity", "trade_time", "side", "stats", "is_anomaly",
        F.when(F.col("is_anomaly"), F.col("zscore")).alias("anomaly_zscore"),
        *keep,
    )


def anomaly_events(processed: DataFrame, params: AnomalyParams | None = None, *keep: str) -> DataFrame:
    """ANOMALY rows, one per flagged tick."""
    params = params or AnomalyParams()
    return processed.filter("is_anomaly").select(
        "symbol",
        F.col("trade_time").alias("timestamp"),
        F.col("price").alias("triggering_price"),
        F.col("stats.mean_price").alias("rolling_mean"),
        F.col("stats.stdev_price").alias("rolling_stdev"),
        F.col("anomaly_zscore").alias("deviation_zscore"),
        F.lit(float(params.threshold)).alias("threshold"),
        *keep,
    )


def anomaly_log(events: DataFrame) -> DataFrame:
    """Anomaly events as reported: z to 3 places, mean and deviation to 4 (ties to even)."""
    return events.withColumns(
        {
            "deviation_zscore": F.bround("deviation_zscore", 3),
            "rolling_mean": F.bround("rolling_mean", 4),
            "rolling_stdev": F.bround("rolling_stdev", 4),
        }
    )
