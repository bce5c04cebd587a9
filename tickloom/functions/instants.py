"""Timestamps as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def iso_text(instant: Column, zone: str) -> Column:
    """ISO-8601 in UTC ending in ``zone`` ("Z" or "+00:00"); no fraction when it is zero."""
    whole = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(instant), F.lit(1_000_000))
    fraction = F.when(micros == 0, F.lit("")).otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    return F.concat(whole, fraction, F.lit(zone))


def day_key(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd")
