import random

import pytest
from pyspark.sql import Window, functions as F

from tests.conftest import T0, seconds
from tests.test_window import SCHEMA, random_rows
from tickloom.operators.percentiles import percentiles
from tickloom.operators.running import running_max, running_sum
from tickloom.operators.snapshot import snapshot
from tickloom.operators.window import rolling_stats
from tickloom.params import WindowParams


def late_frame(spark):
    rows = random_rows(11, 300, "late")
    return spark.createDataFrame([(s, p, float(q), T0 + seconds(t / 1e6), n) for s, p, q, t, n in rows], SCHEMA)


def test_snapshot_of_nothing_is_zero(spark):
    (row,) = snapshot(spark.createDataFrame([], SCHEMA), WindowParams(), ["X"]).collect()
    assert (row["symbol"], tuple(row["stats"])) == ("X", (0.0, 0.0, 0.0, 0, 10.0))


def test_snapshot_keeps_symbols_apart(spark):
    df = spark.createDataFrame([("BTCUSDT", 60000.0, 1.0, T0, 1)], SCHEMA)
    got = {r["symbol"]: r["stats"]["sample_count"] for r in snapshot(df, WindowParams(), ["ETHUSDT", "BTCUSDT"]).collect()}
    assert got == {"ETHUSDT": 0, "BTCUSDT": 1}


@pytest.mark.parametrize("mode", ["event_time", "arrival"])
def test_snapshot_is_what_the_last_tick_saw(spark, mode):
    df, params = late_frame(spark), WindowParams(window_seconds=12.0, mode=mode)
    order = [F.col("seq").desc()] if mode == "arrival" else [F.col("trade_time").desc(), F.col("seq").desc()]
    last = rolling_stats(df, params).withColumn("n", F.row_number().over(Window.partitionBy("symbol").orderBy(*order)))
    want = {r["symbol"]: r["stats"] for r in last.filter("n = 1").collect()}
    assert {r["symbol"]: r["stats"] for r in snapshot(df, params).collect()} == want


@pytest.mark.parametrize("rows_per_slice", [3, 10_000])
def test_percentiles_by_index(spark, rows_per_slice):
    rnd = random.Random(3)
    rows = [("HOT", 0 if rnd.random() < 0.4 else rnd.randint(-50, 5000)) for _ in range(700)]
    rows += [("COLD", v) for v in (5, 1, 9)] + [("ONE", 4), ("ONE", None)]
    df = spark.createDataFrame(rows, "symbol string, late bigint")
    got = {r["symbol"]: (r["n"], r["p50"], r["p95"], r["p99"]) for r in percentiles(df, "symbol", "late", rows_per_slice=rows_per_slice).collect()}
    for symbol in ("HOT", "COLD", "ONE"):
        values = sorted(v for s, v in rows if s == symbol and v is not None)
        n = len(values)
        assert got[symbol] == (n, *[values[int(n * q)] for q in (0.50, 0.95, 0.99)])


def test_percentiles_refuse_one():
    with pytest.raises(ValueError):
        percentiles(None, "a", "b", {"max": 1.0})


def test_running_aggregates_over_slices(spark):
    rnd = random.Random(4)
    rows = [("HOT" if i % 3 else "COLD", i if i < 300 else i * 10_000, rnd.randint(-5, 100)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, at bigint, v bigint")
    so_far = Window.partitionBy("k").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    for function, plain in ((running_max, F.max), (running_sum, F.sum)):
        got, cut = function(df, "k", "at", "v", "out", 4)
        want = df.withColumn("out", plain("v").over(so_far))
        assert cut and sorted(got.collect()) == sorted(want.collect())


def test_slices_follow_the_rows(spark):
    """Ten times the rows, ten times the slices; one instant and one key spread over them."""
    from tickloom.operators.slices import cut

    for n in (1000, 10_000):
        rows = spark.range(n).select(F.lit("K").alias("k"), F.lit(0).alias("at"), F.col("id").alias("seq"))
        placed, slices = cut(rows, ["k", "at", "seq"], n, 100, "test")
        sizes = [r["count"] for r in placed.groupBy("slice").count().collect()]
        assert slices == n // 100 and sum(sizes) == n and max(sizes) < 400
