"""Symbol lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.wire import normal_symbol

INLINE_LIMIT = 1000


def symbol_list(text: str) -> list[str]:
    """A comma list as given in a job's settings: trimmed, upper case, without empty entries."""
    trimmed = map(str.strip, text.upper().split(","))
    return [symbol for symbol in trimmed if symbol]


def symbol_list_column(text: Column) -> Column:
    """``symbol_list`` of a text column."""
    parts = F.transform(F.split(text, ","), normal_symbol)
    return F.filter(parts, lambda part: part != "")


def allow_symbols(ticks: DataFrame, symbols: list[str] | DataFrame) -> DataFrame:
    """Ticks of the listed symbols; a long or stored list becomes a semi join."""
    if isinstance(symbols, list):
        if len(symbols) <= INLINE_LIMIT:
            return ticks.filter(F.col("symbol").isin(symbols))
        symbols = ticks.sparkSession.createDataFrame([(s,) for s in symbols], "symbol string")
    return ticks.join(symbols.select("symbol"), "symbol", "left_semi")
