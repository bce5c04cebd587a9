"""Column expressions over exact window sums, and the z-score rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.units import Units
from tickloom.params import AnomalyParams


WIDE = {
    "n": "bigint",
    "s1": "decimal(28,0)",
    "s2": "decimal(38,0)",
    "pv": "decimal(38,0)",
    "qv": "decimal(28,0)",
}


def with_stats(df: DataFrame, types: dict[str, str], units: Units, window_seconds: float) -> DataFrame:
    """Replace exact window sums by a ``stats`` struct.

    ``df`` holds _n, _s1, _s2, _pv, _qv: count and sums of price, price squared, price*quantity and
    quantity, in units, of the given ``types``. The squares are taken about the whole-number mean,
    exactly; only the last steps are in floating point: with r the rest of s1 over n, the variance is
    (sum of squares about the whole mean) / n - (r / n)^2. A flat window gives exactly 0.
    """
    product = "_n * _centre"
    if types["s1"] != "bigint":
        product = "cast(_n as decimal(19,0)) * cast(_centre as decimal(18,0))"
    about = "_s2 - _centre * cast(_s1 + _rest as bigint)"
    if types["s2"] != "bigint":
        about = "cast(_s2 - cast(_centre as decimal(18,0)) * cast(_s1 + _rest as decimal(28,0)) as decimal(38,0))"
    # One step per column, so that each is computed once.
    steps = {
        "_count": "cast(_n as double)",
        "_mean": f"case when _n = 0 then 0.0D else {units.scaled('cast(_s1 as double) / cast(_n as double)')} end",
        "_centre": "case when _n > 1 then _s1 div _n end",
        "_rest": f"cast(_s1 - {product} as bigint)",
        "_part": "cast(_rest as double) / _count",
        "_about": about,
        "_variance": "cast(_about as double) / _count - _part * _part",
        "stats": f"""named_struct(
            'vwap', case when _qv > 0 then {units.scaled('cast(_pv as double) / cast(_qv as double)')} else _mean end,
            'mean_price', _mean,
            'stdev_price', case when _n > 1 then {units.scaled('sqrt(greatest(0.0D, _variance))')} else 0.0D end,
            'sample_count', cast(_n as bigint),
            'window_seconds', cast({float(window_seconds)!r} as double))""",
    }
    for name, text in steps.items():
        df = df.withColumn(name, F.expr(text))
    return df.drop("_n", "_s1", "_s2", "_pv", "_qv", "_times", "_over", *[name for name in steps if name != "stats"])


def zscore(price: Column, mean: Column, stdev: Column) -> Column:
    """(price - mean) / stdev; 0.0 on a flat window."""
    return F.when(stdev <= 0, F.lit(0.0)).otherwise((price - mean) / stdev)


def evaluate_zscore(price: Column, stats: Column, params: AnomalyParams) -> Column:
    """The z-score a tick is judged by: 0.0 until the window holds enough samples."""
    return F.when(stats["sample_count"] < params.min_samples, F.lit(0.0)).otherwise(
        zscore(price, stats["mean_price"], stats["stdev_price"])
    )
