"""Current window of each symbol: the statistics its last tick saw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.instants import day_key
from tickloom.functions.stats import WIDE, with_stats
from tickloom.functions.symbols import allow_symbols
from tickloom.functions.units import in_units, survey
from tickloom.operators.window import tick_measures
from tickloom.params import ARRIVAL, WindowParams
from tickloom.session import materialise


def snapshot(ticks: DataFrame, params: WindowParams | None = None, symbols: list[str] | None = None) -> DataFrame:
    """(symbol, stats) per symbol seen, or per requested symbol (all zero if never seen).

    Only the last window of each symbol matters, so this aggregates instead of computing every
    tick's window: one small row per symbol says where its window starts, and the ticks from there
    on are summed with partial aggregation, which no hot symbol can overload. Requested symbols, and
    the earliest start of all windows, are filters of the scan; a day-partitioned table is pruned.
    """
    params = params or WindowParams()
    spark = ticks.sparkSession
    wanted = ticks if symbols is None else allow_symbols(ticks, symbols)
    at, seq = F.unix_micros("trade_time"), F.col("seq").cast("bigint")
    starts = materialise(wanted.groupBy("symbol").agg((F.max(at) - params.window_us).alias("_from")), "window-start")
    recent = _since(wanted, starts.agg(F.min("_from")).first()[0]).join(starts, "symbol").filter(at >= F.col("_from"))
    if params.mode == ARRIVAL:
        # Points that arrived after the first one in range stay, however old they are.
        first = materialise(recent.groupBy("symbol").agg(F.min(seq).alias("_first")), "window-first")
        lowest = first.agg(F.min("_first")).first()[0]
        later = wanted if lowest is None else wanted.filter(F.col("seq") >= F.lit(lowest))
        recent = later.join(first, "symbol").filter(seq >= F.col("_first"))

    recent = recent.select("symbol", "price", "quantity")
    units = survey(recent, params)
    scale = units.columns
    sums = in_units(recent, units).groupBy("symbol", *scale).agg(
        *[F.sum(value).cast(WIDE[name]).alias(f"_{name}") for name, value in tick_measures(WIDE).items()]
    )
    if symbols is not None:
        asked = spark.createDataFrame([(s,) for s in symbols], "symbol string").distinct()
        sums = asked.join(sums, "symbol", "left").select(
            "symbol", *[F.coalesce(c, F.lit(1.0)).alias(c) for c in scale], *[F.coalesce(f"_{n}", F.lit(0).cast(t)).alias(f"_{n}") for n, t in WIDE.items()]
        )
    return with_stats(sums, WIDE, units, params.window_seconds)


def _since(ticks: DataFrame, micros: int | None) -> DataFrame:
    """Ticks from an instant on, as a filter that reaches the scan and the day partitions."""
    if micros is None:
        return ticks
    start: Column = F.timestamp_micros(F.lit(micros))
    found = ticks.filter(F.col("trade_time") >= start)
    return found.filter(F.col("partition_key") >= day_key(start)) if "partition_key" in ticks.columns else found
