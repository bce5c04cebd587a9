"""Ticks around anomalies: a join of two streams over an interval of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Stretches of time that the span around an event is cut into, and their least length in microseconds.
STRETCHES, LEAST = 4, 1_000_000


def around_anomalies(
    events: DataFrame, ticks: DataFrame, before_seconds: float, after_seconds: float, lateness_seconds: float, *keep: str
) -> DataFrame:
    """Each anomaly event with its symbol's ticks from ``before_seconds`` before it to ``after_seconds`` after it, both included.

    events: symbol, timestamp, triggering_price, and columns named in ``keep``, which come out as ``event_<name>``; ticks:
    symbol, price, quantity, trade_time. On streams both sides have a watermark of ``lateness_seconds``; from the two and
    the interval Spark knows which rows can't meet any more, so the state is as large as that span of time and not as the
    stream. Ticks and events meet whichever comes first; rows that are later than the watermark don't count.

    The join is by symbol and stretch of time: a tick lies in one, an event is there once for each that its span touches. So
    each pair meets once, a row is compared with those of its stretch alone, and a hot symbol is spread over tasks.
    """
    for name, value in (("before_seconds", before_seconds), ("after_seconds", after_seconds), ("lateness_seconds", lateness_seconds)):
        if not value >= 0:
            raise ValueError(f"{name} must be >= 0, got {value!r}")

    def span(seconds: float) -> str:
        return f"interval {round(seconds * 1_000_000)} microseconds"

    late = f"{round(lateness_seconds * 1000)} milliseconds"
    before, after = round(before_seconds * 1_000_000), round(after_seconds * 1_000_000)
    width = max((before + after) // STRETCHES, LEAST)

    def stretch(micros: Column) -> Column:
        return micros - F.pmod(micros, F.lit(width))

    at = F.unix_micros("timestamp")
    touched = F.explode(F.sequence(stretch(at - before), stretch(at + after), F.lit(width))).alias("_touched")
    left = events.select(F.col("symbol").alias("_symbol"), "timestamp", "triggering_price", *[F.col(c).alias(f"event_{c}") for c in keep], touched)
    right = ticks.withColumn("_stretch", stretch(F.unix_micros("trade_time")))
    inside = f"trade_time >= timestamp - {span(before_seconds)} and trade_time <= timestamp + {span(after_seconds)}"
    met = left.withWatermark("timestamp", late).join(
        right.withWatermark("trade_time", late), F.expr(f"symbol = _symbol and _stretch = _touched and {inside}")
    )
    return met.drop("_symbol", "_touched", "_stretch")
