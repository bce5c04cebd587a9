"""Prices and quantities as whole numbers, so that sums are exact in any order.

Values that are whole multiples of 10^-scale, for the scales the caller names, are counted in those
units. Otherwise each symbol gets a power of ten of its own from its largest value, so that ``DIGITS``
digits of it count. Where that would lose a small value beside a large one, or sums over that many ticks
could outgrow DECIMAL(38), there are no such units, and sums are taken exactly (``operators.exact``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.params import WindowParams
from tickloom.session import materialise

DIGITS = 15
#: Largest over smallest value of a symbol up to which it has units: the smallest keeps 6 digits or more.
SPREAD = 1e9
#: Ticks of a symbol whose sums of squares of ``DIGITS`` digits fit DECIMAL(38).
FIT = 90_000_000
_LOWEST, _HIGHEST = -290, 300


@dataclass(frozen=True)
class Units:
    """What one planning pass found. ``scaled`` takes SQL text of a number of price units to a price."""

    rows: int
    most: int  # rows of the largest symbol
    top_price: int
    top_quantity: int
    fixed: tuple[int, int] | None  # the scales of price and quantity that all symbols share, if they do
    scales: DataFrame | None = None  # otherwise the factors of each symbol
    exact: bool = False  # no units would do

    def scaled(self, text: str) -> str:
        return f"{text} / _times * _over" if self.fixed is None else f"{text} / {float(10 ** self.fixed[0])!r}D"

    @property
    def columns(self) -> list[str]:
        """Columns that ``scaled`` needs."""
        return [] if self.fixed is not None else ["_times", "_over"]


def _whole(value: Column, scale: int) -> Column:
    unit = F.lit(float(10**scale))
    return F.bool_and(F.rint(value * unit) / unit == value)


def _factors(top: Column, prefix: str) -> list[Column]:
    """10^e as what to multiply by and what to divide by, one of them 1; parsed, so the nearest double."""
    exponent = F.greatest(F.lit(_LOWEST), F.least(F.lit(_HIGHEST), DIGITS - 1 - F.floor(F.log10(top)))).cast("int")
    power = lambda e: F.concat(F.lit("1e"), e.cast("string")).cast("double")
    one = F.lit(1.0)
    return [
        F.when(exponent >= 0, power(exponent)).otherwise(one).alias(f"{prefix}times"),
        F.when(exponent < 0, power(-exponent)).otherwise(one).alias(f"{prefix}over"),
    ]


def survey(ticks: DataFrame, params: WindowParams) -> Units:
    """Sizes and scales of ``ticks(symbol, price, quantity)``, from one aggregation."""
    price, quantity = F.col("price"), F.col("quantity")
    symbols = ticks.groupBy("symbol").agg(
        F.count("*").alias("n"),
        F.max(price).alias("top_price"),
        F.max(quantity).alias("top_quantity"),
        F.greatest(F.max(price) / F.min(price), F.max(quantity) / F.min(quantity)).alias("spread"),
        (_whole(price, params.price_scale) & _whole(quantity, params.quantity_scale)).alias("whole"),
    )
    found = symbols.agg(
        F.sum("n").alias("rows"), F.max("n").alias("most"), F.max("top_price").alias("p"), F.max("top_quantity").alias("q"), F.bool_and("whole").alias("whole"),
        F.max("spread").alias("spread"),
    ).first()
    rows, most = found["rows"] or 0, found["most"] or 0
    top_price, top_quantity = (found["p"] or 0.0) * 10**params.price_scale, (found["q"] or 0.0) * 10**params.quantity_scale
    limit = 10**DIGITS
    if not rows or (found["whole"] and top_price <= limit and top_quantity <= limit):
        return Units(rows, most, round(top_price), round(top_quantity), (params.price_scale, params.quantity_scale))
    if found["spread"] > SPREAD or most > FIT:
        return Units(rows, most, limit, limit, None, exact=True)
    scales = materialise(symbols.select("symbol", *_factors(F.col("top_price"), "_"), *_factors(F.col("top_quantity"), "_q")), "scales")
    return Units(rows, most, limit, limit, None, scales)


def in_units(ticks: DataFrame, units: Units) -> DataFrame:
    """Add ``_p`` and ``_q`` (BIGINT) and, if symbols differ in scale, ``_times`` and ``_over``."""
    price, quantity = F.col("price"), F.col("quantity")
    if units.fixed is not None:
        counts = {"_p": price * F.lit(float(10 ** units.fixed[0])), "_q": quantity * F.lit(float(10 ** units.fixed[1]))}
    else:
        ticks = ticks.join(units.scales, "symbol")
        counts = {"_p": price * F.col("_times") / F.col("_over"), "_q": quantity * F.col("_qtimes") / F.col("_qover")}
    return ticks.withColumns({name: F.rint(value).cast("bigint") for name, value in counts.items()}).drop("_qtimes", "_qover")
