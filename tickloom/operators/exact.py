"""The trailing window with sums that lose nothing, for symbols whose values differ too much for common units.

Every tick comes in once and leaves once, in order, as in ``window._sliced``: all these moves are cut into slices, each
slice's totals are handed on to the symbol's later slices, and each slice runs through its moves on its own. Sums are
Python whole numbers of units of 2^-1074, in which any finite price or quantity is whole. A tick's sums are some 2 KB of
text and a slice is in memory whole, so slices are short, and more of them follow from more ticks.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.exact import Sums
from tickloom.operators.slices import cut
from tickloom.params import WindowParams

#: Moves of a slice, at most.
MOVES = 10_000
_SUMS = ["n", "s1", "s2", "pv", "qv"]
_IN = ["_at", "_kind", "_seq", "_price", "_quantity"]


def _added(sums: Sums, group: pd.DataFrame) -> Sums:
    for kind, price, quantity in zip(group["_kind"], group["_price"], group["_quantity"], strict=True):
        sums.add(price, quantity, -1 if kind else 1)
    return sums


def _totals(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    sums = _added(Sums(0, 0, fine=True), group).values()
    return pd.DataFrame({"symbol": [key[0]], "slice": [key[1]], "sums": [[str(x) for x in sums]]})


def _carried(key: tuple, totals: pd.DataFrame) -> pd.DataFrame:
    """For each slice of a symbol the sums of its earlier ones."""
    so_far, out = [0] * len(_SUMS), []
    totals = totals.sort_values("slice")
    for own in totals["sums"]:
        out.append([str(x) for x in so_far])
        so_far = [a + int(b) for a, b in zip(so_far, own, strict=True)]
    return totals.assign(sums=out)


def _windows(key: tuple, moves: pd.DataFrame, carried: pd.DataFrame) -> pd.DataFrame:
    sums, out = Sums(0, 0, [int(x) for x in carried["sums"].iloc[0]], True), []
    for _, kind, seq, price, quantity in moves[_IN].sort_values(["_at", "_kind", "_seq"]).itertuples(index=False, name=None):
        sums.add(price, quantity, -1 if kind else 1)
        if not kind:
            out.append((key[0], seq, *sums.stats(), [str(x) for x in sums.values()]))
    return pd.DataFrame(out, columns=["symbol", "_seq", "vwap", "mean_price", "stdev_price", "sample_count", "sums"])


def exact_windows(ticks: DataFrame, params: WindowParams, rows: int, places: tuple[Column, Column]) -> DataFrame:
    """symbol, _seq, vwap, mean_price, stdev_price, sample_count, sums (n, s1, s2, pv, qv in units of 2^-1074 for prices and quantities, of 2^-2148 for their
    products, as text). ticks: symbol, price, quantity, and clock and arrival number as ``places``."""
    at, seq = places
    moves = F.array(
        F.struct(at.alias("_at"), F.lit(0).alias("_kind")),
        # A tick exactly one window old still counts: at equal times it leaves behind those coming in.
        F.struct((at + params.window_us).alias("_at"), F.lit(1).alias("_kind")),
    )
    moved = ticks.select("symbol", seq.alias("_seq"), F.col("price").alias("_price"), F.col("quantity").alias("_quantity"), F.inline(moves))
    placed, _ = cut(moved, ["symbol", "_at", "_kind", "_seq"], 2 * rows, min(params.rows_per_slice, MOVES), "exact-slices")
    totals = placed.select("symbol", "slice", "_kind", "_price", "_quantity").groupBy("symbol", "slice")
    totals = totals.applyInPandas(_totals, "symbol string, slice bigint, sums array<string>")
    carried = totals.groupBy("symbol").applyInPandas(_carried, totals.schema)
    both = placed.groupBy("symbol", "slice").cogroup(carried.groupBy("symbol", "slice"))
    schema = "symbol string, _seq bigint, vwap double, mean_price double, stdev_price double, sample_count bigint, sums array<string>"
    return both.applyInPandas(_windows, schema)
