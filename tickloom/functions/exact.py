"""Sums of prices and quantities that lose nothing, whatever their sizes, as Python whole numbers."""

from __future__ import annotations

import math

STATS = ["vwap", "mean_price", "stdev_price", "sample_count"]


class Sums:
    """Exact count and sums of price, price squared, price times quantity and quantity.

    Values that are whole multiples of 10^-scale are counted in those units. From the first one on that isn't,
    all are counted in units of 2^-1074, of which every finite number is a whole multiple.
    """

    FINE = 1074

    def __init__(self, price_scale: int, quantity_scale: int, values: list[int] | None = None, fine: bool = False) -> None:
        self.scales = 10**price_scale, 10**quantity_scale
        self.fine = fine
        self.n, self.s1, self.s2, self.pv, self.qv = values or (0, 0, 0, 0, 0)

    def fits(self, price: float, quantity: float) -> bool:
        """Whether a tick can be counted in the present units."""
        return self.fine or all(v * s < 1e15 and round(v * s) / s == v for v, s in zip((price, quantity), self.scales, strict=True))

    def _units(self, value: float, scale: int) -> int:
        if not self.fine:
            return round(value * scale)
        top, bottom = value.as_integer_ratio()
        return (top << self.FINE) // bottom

    def add(self, price: float, quantity: float, sign: int = 1) -> None:
        p, q = self._units(price, self.scales[0]), self._units(quantity, self.scales[1])
        self.n += sign
        self.s1 += sign * p
        self.s2 += sign * p * p
        self.pv += sign * p * q
        self.qv += sign * q

    def values(self) -> list[int]:
        return [self.n, self.s1, self.s2, self.pv, self.qv]

    def stats(self) -> tuple[float, float, float, int]:
        """vwap, mean, population deviation, count. In units of a scale the steps are those of ``functions.stats``."""
        if self.n == 0:
            return 0.0, 0.0, 0.0, 0
        if self.fine:
            unit = 1 << self.FINE
            mean = _ratio(self.s1, self.n * unit)
            spread = self.n * self.s2 - self.s1 * self.s1
            deviation = _root(spread, self.n * self.n * unit * unit) if self.n > 1 and spread else 0.0
            return (_ratio(self.pv, self.qv * unit) if self.qv else mean), mean, deviation, self.n
        scale = float(self.scales[0])
        mean = float(self.s1) / float(self.n) / scale
        deviation = 0.0
        if self.n > 1:
            centre, rest = divmod(self.s1, self.n)
            part = float(rest) / float(self.n)
            about = self.s2 - centre * (self.s1 + rest)
            deviation = math.sqrt(max(0.0, float(about) / float(self.n) - part * part)) / scale
        return (float(self.pv) / float(self.qv) / scale if self.qv else mean), mean, deviation, self.n


def _ratio(top: int, bottom: int) -> float:
    """The number nearest to top / bottom; infinity beyond the largest."""
    try:
        return top / bottom
    except OverflowError:
        return math.inf


def _root(top: int, bottom: int) -> float:
    """The square root of top / bottom, from 128 bits of it."""
    shift = max(0, 256 - (top.bit_length() - bottom.bit_length()))
    shift += shift % 2
    return _ratio(math.isqrt((top << shift) // bottom), 1 << (shift // 2))


def binary_text(value: int, bits: int) -> str:
    """value / 2^bits as exact decimal text, without an exponent and without zeros at the end."""
    whole, rest = divmod(abs(value), 1 << bits)
    digits = str(rest * 5**bits).rjust(bits, "0").rstrip("0") if rest else ""
    return f"{'-' if value < 0 else ''}{whole}{'.' if digits else ''}{digits}"
