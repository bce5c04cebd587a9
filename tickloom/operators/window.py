"""Trailing time window per symbol: count, mean, VWAP and population deviation at every tick.

With the ticks of a symbol in order, the window of a tick is what has come in so far minus what came
in more than one window ago: a running sum, less that same running sum as it stood one window
earlier. Both are single passes, so the cost per tick does not depend on the window length. Ticks
of equal time count in arrival order, and a tick exactly one window old still counts. The sums are
whole-number sums, so the subtraction loses nothing.

When a symbol is hot, ticks are cut into slices (see ``slices``). There every tick is two rows, one when
it comes in and one when it leaves, and the window is a single running sum over both, on top of what
earlier slices hand on. Values too far apart for common units take a way of their own (see ``exact``).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.exact import Sums, binary_text
from tickloom.functions.stats import WIDE, with_stats
from tickloom.functions.units import Units, in_units, survey
from tickloom.operators.exact import exact_windows
from tickloom.operators.running import running_max
from tickloom.operators.slices import carry_in, cut, tasks_of
from tickloom.params import ARRIVAL, WindowParams
from tickloom.session import materialise

ENTRY, EXIT, CARRIED = 0, 1, 2


def tick_measures(types: dict[str, str]) -> dict[str, Column]:
    """What one tick adds to each sum, in the sum's type."""
    price, quantity = F.col("_p"), F.col("_q")

    def product(left: Column, right: Column, kind: str) -> Column:
        if kind == "bigint":
            return left * right
        return left.cast("decimal(18,0)") * right.cast("decimal(18,0)")

    values = {
        "n": F.lit(1),
        "s1": price,
        "s2": product(price, price, types["s2"]),
        "pv": product(price, quantity, types["pv"]),
        "qv": quantity,
    }
    return {name: values[name].cast(kind) for name, kind in types.items()}


def _sum_types(units: Units) -> dict[str, str]:
    """BIGINT for the sums that cannot outgrow it over a whole symbol, DECIMAL for the others."""
    price, quantity = units.top_price, units.top_quantity
    largest = {"n": 1, "s1": price, "s2": price * price, "pv": price * quantity, "qv": quantity}
    return {name: "bigint" if units.most * largest[name] < 2**62 else wide for name, wide in WIDE.items()}


def rolling_stats(ticks: DataFrame, params: WindowParams | None = None, stored_by_symbol: bool = False) -> DataFrame:
    """Add a ``stats`` struct to every tick; one output row per input row.

    ``ticks`` needs symbol, price, quantity, trade_time and a per-symbol unique ``seq`` (arrival
    order). ``event_time`` mode orders by (trade_time, seq). ``arrival`` mode orders by seq and
    never lets a late tick move the window back: there the window of a tick holds the earlier
    arrivals whose running maximum time is within the window of its own running maximum.

    The call itself runs small planning jobs over ``ticks`` (and writes the slices of hot symbols), and
    the result reads them again: give it a stored table, or something that reads the same every time.

    ``stored_by_symbol``: ``ticks`` reads a table that is bucketed by symbol (``sinks.table.write_by_symbol``), so
    that the window needs no shuffle as long as no symbol is cut into slices.
    """
    params = params or WindowParams()
    if params.mode == ARRIVAL:
        clocked, sliced = arrival_clock(ticks, params)
        if sliced:
            clocked = materialise(clocked, "arrival")
    else:
        clocked = ticks.withColumn("_at", F.unix_micros("trade_time"))
    return rolling_by_clock(clocked, ticks.columns, params, stored_by_symbol=stored_by_symbol)


def arrival_clock(ticks: DataFrame, params: WindowParams, most: int | None = None) -> tuple[DataFrame, bool]:
    """Add ``_at``, the latest trade time seen up to each tick in arrival order.

    An early point can only leave once everything that arrived before it has left, and it leaves
    when some tick's cutoff passes it. Together that means: the window starts at the first arrival
    whose time reaches (latest time so far - window). "Latest time so far" never decreases, so it
    serves as the clock of an ordinary trailing window.
    """
    timed = ticks.withColumn("_time", F.unix_micros("trade_time"))
    clocked, sliced = running_max(timed, "symbol", "seq", "_time", "_at", params.rows_per_slice, most)
    return clocked.drop("_time"), sliced


def exact_sums(ticks: DataFrame, params: WindowParams | None = None) -> DataFrame:
    """symbol, seq and the window's n and sums of price, price squared, price times quantity and quantity, as exact decimal text
    (``s1``, ``s2``, ``pv``, ``qv``); whatever the values' sizes. Modes as in ``rolling_stats``."""
    params = params or WindowParams()
    clocked = arrival_clock(ticks, params)[0] if params.mode == ARRIVAL else ticks.withColumn("_at", F.unix_micros("trade_time"))
    found = exact_windows(clocked, params, clocked.count(), (F.col("_at"), F.col("seq").cast("bigint")))
    shift = {"s1": Sums.FINE, "s2": 2 * Sums.FINE, "pv": 2 * Sums.FINE, "qv": Sums.FINE}

    @F.pandas_udf("string")
    def decimal(values: pd.Series, bits: pd.Series) -> pd.Series:
        return pd.Series([binary_text(int(v), b) for v, b in zip(values, bits, strict=True)])

    sums = [decimal(F.col("sums")[i + 1], F.lit(bits)).alias(name) for i, (name, bits) in enumerate(shift.items())]
    return found.select("symbol", F.col("_seq").alias("seq"), F.col("sample_count").alias("n"), *sums)


def rolling_by_clock(
    clocked: DataFrame, columns: list[str], params: WindowParams, units: Units | None = None, stored_by_symbol: bool = False
) -> DataFrame:
    """``rolling_stats`` over ticks that already carry their clock ``_at`` in microseconds, and whose
    ``units`` may be known."""
    units = units or survey(clocked, params)
    if units.exact:
        seq = F.col("seq").cast("bigint")
        found = exact_windows(clocked, params, units.rows, (F.col("_at"), seq)).withColumnsRenamed({"symbol": "_symbol"})
        met = clocked.join(found, (clocked["symbol"] == F.col("_symbol")) & (seq == F.col("_seq")))
        stats = F.struct("vwap", "mean_price", "stdev_price", "sample_count", F.lit(float(params.window_seconds)).alias("window_seconds"))
        return met.select(*[clocked[c] for c in columns], stats.alias("stats"))
    scale = units.columns
    ticks = in_units(clocked, units).select(
        "symbol",
        F.struct(*[c for c in columns if c != "symbol"]).alias("tick"),
        "_at",
        F.col("seq").cast("bigint").alias("_seq"),
        "_p",
        "_q",
        *scale,
    )
    types = _sum_types(units)
    if units.most <= params.rows_per_slice:
        windowed = _whole(ticks if stored_by_symbol else ticks.repartition("symbol"), types, params)
    else:
        windowed = _sliced(ticks, units, types, params)
    windowed = windowed.select("symbol", "tick", *scale, *[F.col(f"_{name}") for name in types])
    out = [F.col(c if c == "symbol" else f"tick.{c}") for c in columns]
    return with_stats(windowed, types, units, params.window_seconds).select(*out, "stats")


def _whole(ticks: DataFrame, types: dict[str, str], params: WindowParams) -> DataFrame:
    """Window sums where every symbol is one group: what came in, less what had by one window ago."""
    so_far = Window.partitionBy("symbol").orderBy("_at", "_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    came_in = F.struct(*[F.sum(value).over(so_far).alias(name) for name, value in tick_measures(types).items()])
    # The running sum one window ago is the largest (by count) among the ticks before that time.
    one_window_ago = Window.partitionBy("symbol").orderBy("_at").rangeBetween(Window.unboundedPreceding, -params.window_us - 1)
    summed = ticks.withColumn("_in", came_in).withColumn("_gone", F.max("_in").over(one_window_ago))
    none = F.lit(0)
    return summed.withColumns(
        {f"_{name}": (F.col(f"_in.{name}") - F.coalesce(F.col(f"_gone.{name}"), none.cast(kind))).cast(kind) for name, kind in types.items()}
    )


def _sliced(ticks: DataFrame, units: Units, types: dict[str, str], params: WindowParams) -> DataFrame:
    """Window sums over slices: ticks coming in count up, ticks going out count down."""
    moves = F.array(
        F.struct(F.col("_at"), F.lit(ENTRY).alias("_kind"), F.col("tick")),
        # A tick exactly one window old still counts: at equal times it leaves behind those coming in.
        F.struct((F.col("_at") + params.window_us).alias("_at"), F.lit(EXIT).alias("_kind"), F.lit(None).alias("tick")),
    )
    others = [c for c in ticks.columns if c not in ("_at", "tick")]
    moved = ticks.select(*others, F.inline(moves))
    placed, slices = cut(moved, ["symbol", "_at", "_kind", "_seq"], 2 * units.rows, params.rows_per_slice, "window-slices")
    measures = tick_measures(types)
    signed = {name: F.when(F.col("_kind") == EXIT, -value).otherwise(value) for name, value in measures.items()}
    totals = placed.groupBy("symbol", "slice").agg(*[F.sum(value).alias(name) for name, value in signed.items()])
    carried = carry_in(totals, "symbol", dict.fromkeys(types, "sum"))
    carry = F.struct(*[F.col(name).cast(kind).alias(name) for name, kind in types.items()]).alias("_carry")
    carried = carried.select("symbol", "slice", carry, F.lit(CARRIED).alias("_kind"))
    rows = placed.unionByName(carried, allowMissingColumns=True).repartition(tasks_of(moved, slices, 2 * units.rows), "symbol", "slice")
    # In order: the total carried in (no time; nulls sort first), then the ticks.
    so_far = Window.partitionBy("symbol", "slice").orderBy("_at", "_kind", "_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {
        f"_{name}": F.sum(F.when(F.col("_kind") == CARRIED, F.col(f"_carry.{name}")).otherwise(value)).over(so_far).cast(types[name])
        for name, value in signed.items()
    }
    return rows.select("*", *[value.alias(name) for name, value in sums.items()]).filter(F.col("_kind") == ENTRY)
