"""Plain simulations of the window rule, in exact fractions, for small inputs."""

from __future__ import annotations

import math
from collections import defaultdict
from fractions import Fraction


def simulate(rows, window_us: int, arrival: bool):
    """rows: (symbol, price, quantity, time_us, seq) -> {(symbol, seq): (n, mean, stdev, vwap)}."""
    per_symbol = defaultdict(list)
    for row in rows:
        per_symbol[row[0]].append(row)
    out = {}
    for symbol, items in per_symbol.items():
        items.sort(key=(lambda r: r[4]) if arrival else (lambda r: (r[3], r[4])))
        live: list = []
        for row in items:
            live.append(row)
            cutoff = row[3] - window_us
            gone = 0
            while live[gone][3] < cutoff:
                gone += 1
            live = live[gone:]
            out[symbol, row[4]] = describe(live)
    return out


def describe(live):
    prices = [Fraction(str(r[1])) for r in live]
    quantities = [Fraction(str(r[2])) for r in live]
    n = len(live)
    mean = sum(prices) / n
    variance = sum(p * p for p in prices) / n - mean * mean
    vwap = sum(p * q for p, q in zip(prices, quantities)) / sum(quantities)
    return n, float(mean), math.sqrt(variance), float(vwap)
