import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.brute import simulate
from tests.conftest import T0, seconds
from tickloom.operators.slices import cut
from tickloom.operators.window import rolling_stats
from tickloom.params import WindowParams

SCHEMA = "symbol string, price double, quantity double, trade_time timestamp, seq bigint"


def frame(spark, rows):
    return spark.createDataFrame(
        [(s, float(p), float(q), T0 + seconds(t), n) for s, p, q, t, n in rows], SCHEMA
    )


def stats_by_seq(df):
    return {r["seq"]: r["stats"] for r in df.select("seq", "stats").collect()}


def counts(spark, rows, **params):
    got = stats_by_seq(rolling_stats(frame(spark, rows), WindowParams(**params)))
    return [got[n]["sample_count"] for n in sorted(got)]


def test_vwap_of_two_trades(spark):
    got = stats_by_seq(rolling_stats(frame(spark, [("X", 100, 1, 0, 1), ("X", 200, 3, 0, 2)])))
    assert got[2]["vwap"] == 175.0
    assert got[2]["sample_count"] == 2
    assert got[2]["window_seconds"] == 10.0


def test_old_trade_leaves(spark):
    got = stats_by_seq(rolling_stats(frame(spark, [("X", 100, 1, 0, 1), ("X", 150, 1, 11, 2)])))
    assert (got[2]["sample_count"], got[2]["mean_price"]) == (1, 150.0)


def test_symbols_are_independent(spark):
    rows = [("BTCUSDT", 60000, 1, 0, 1), ("ETHUSDT", 3000, 1, 0, 2), ("BTCUSDT", 60010, 1, 1, 3)]
    assert counts(spark, rows) == [1, 1, 2]


def test_many_equal_times_over_partitions(spark):
    rows = [("X", 100 + i, 1, 0, w * 50 + i) for w in range(8) for i in range(50)]
    df = frame(spark, rows).repartition(8)
    got = stats_by_seq(rolling_stats(df, WindowParams(window_seconds=60.0)))
    assert sorted(s["sample_count"] for s in got.values()) == list(range(1, 401))
    assert got[399]["sample_count"] == 400


def test_lower_bound_is_inclusive(spark):
    assert counts(spark, [("X", 1, 1, 0, 1), ("X", 1, 1, 10, 2)]) == [1, 2]
    assert counts(spark, [("X", 1, 1, 0, 1), ("X", 1, 1, 10.000001, 2)]) == [1, 1]


def test_ties_count_in_arrival_order(spark):
    assert counts(spark, [("X", 1, 1, 0, n) for n in (1, 2, 3)]) == [1, 2, 3]


def test_late_tick_in_arrival_mode_sees_newer_points(spark):
    rows = [("X", 1, 1, 0, 1), ("X", 1, 1, 20, 2), ("X", 1, 1, 5, 3)]
    assert counts(spark, rows, mode="arrival") == [1, 1, 2]


def test_head_of_line_blocks_in_arrival_mode(spark):
    rows = [("X", 1, 1, 20, 1), ("X", 1, 1, 5, 2), ("X", 1, 1, 21, 3)]
    assert counts(spark, rows, mode="arrival") == [1, 2, 3]
    assert counts(spark, rows) == [1, 1, 2]


def test_flat_window_has_zero_deviation(spark):
    got = stats_by_seq(rolling_stats(frame(spark, [("X", 0.1, 1, 0, n) for n in range(5)])))
    assert all(s["stdev_price"] == 0.0 and s["mean_price"] == 0.1 for s in got.values())


def test_large_prices_do_not_lose_precision(spark):
    rows = [("X", 100000.01 + 0.01 * (i % 2), 0.5, i * 0.001, i) for i in range(400)]
    got = stats_by_seq(rolling_stats(frame(spark, rows)))
    assert got[399]["stdev_price"] == pytest.approx(0.005, rel=1e-12)


@pytest.mark.parametrize("price_unit", [1e-10, 1.0, 1e9])
@pytest.mark.parametrize("quantity_unit", [1e-10, 1.0, 1e9])
def test_vwap_of_any_size(spark, price_unit, quantity_unit):
    rows = [("X", 100 * price_unit, quantity_unit, 0, 1), ("X", 200 * price_unit, 3 * quantity_unit, 0, 2)]
    got = stats_by_seq(rolling_stats(frame(spark, rows)))
    assert got[2]["vwap"] == pytest.approx(175 * price_unit, rel=1e-13)
    assert got[2]["mean_price"] == pytest.approx(150 * price_unit, rel=1e-13)
    assert got[2]["stdev_price"] == pytest.approx(50 * price_unit, rel=1e-13)


def test_symbols_have_their_own_scale(spark):
    """Very large and very small symbols side by side, and quantities far below any common unit."""
    rows = [("TINY", 2.5, 1e-9, 0, 1), ("TINY", 7.5, 3e-9, 0, 2), ("DUST", 4e-9, 1, 0, 3), ("HUGE", 1.5e12, 5e7, 0, 4)]
    got = stats_by_seq(rolling_stats(frame(spark, rows)))
    assert got[2]["vwap"] == pytest.approx(6.25, rel=1e-13)
    assert got[3]["mean_price"] == got[3]["vwap"] == 4e-9
    assert got[4]["vwap"] == 1.5e12


@pytest.mark.parametrize("rows_per_slice", [7, 10_000])
def test_scale_hint_does_not_change_results(spark, rows_per_slice):
    rows = [(s, p * 1.0001, float(q) / 3, t / 1e6, n) for s, p, q, t, n in random_rows(8, 200, "ordered")]
    got = [stats_by_seq(rolling_stats(frame(spark, rows), WindowParams(price_scale=k, quantity_scale=k, rows_per_slice=rows_per_slice))) for k in (0, 8)]
    assert got[0] == got[1]
    want = simulate([(s, p, q, round(t * 1e6), n) for s, p, q, t, n in rows], 10_000_000, False)
    for (_, n), (count, mean, stdev, vwap) in want.items():
        assert got[0][n]["sample_count"] == count
        assert got[0][n]["vwap"] == pytest.approx(vwap, rel=1e-12)
        assert got[0][n]["stdev_price"] == pytest.approx(stdev, rel=1e-9, abs=1e-11)


def random_rows(seed, n, shape):
    rnd = random.Random(seed)
    rows, clock = [], 0
    for seq in range(n):
        symbol = "HOT" if rnd.random() < 0.6 else rnd.choice(["A", "B", "C"])
        if shape == "ordered":
            clock += rnd.randint(0, 3_000_000)
            at = clock
        elif shape == "late":
            clock += rnd.randint(0, 3_000_000)
            at = max(0, clock - rnd.choice([0, 0, 0, rnd.randint(0, 30_000_000)]))
        elif shape == "burst":  # most rows in one instant
            at = 5_000_000 if rnd.random() < 0.7 else rnd.randint(0, 60_000_000)
        else:
            at = rnd.randint(0, 120_000_000)
        rows.append((symbol, round(rnd.uniform(0.01, 500), 2), rnd.randint(1, 9), at, seq))
    return rows


@pytest.mark.parametrize("shape", ["ordered", "late", "burst", "random"])
@pytest.mark.parametrize("mode", ["event_time", "arrival"])
@pytest.mark.parametrize("rows_per_slice", [7, 10_000])
def test_matches_simulation(spark, shape, mode, rows_per_slice):
    rows = random_rows(len(shape) * 7 + len(mode), 500, shape)
    df = spark.createDataFrame(
        [(s, p, float(q), T0 + timedelta(microseconds=t), n) for s, p, q, t, n in rows], SCHEMA
    )
    window = {7: 10.0, 10_000: 3.0}[rows_per_slice]
    params = WindowParams(window_seconds=window, mode=mode, rows_per_slice=rows_per_slice)
    got = {
        (r["symbol"], r["seq"]): r["stats"] for r in rolling_stats(df, params).collect()
    }
    want = simulate(rows, params.window_us, mode == "arrival")
    assert got.keys() == want.keys()
    for place, (n, mean, stdev, vwap) in want.items():
        stats = got[place]
        assert stats["sample_count"] == n, place
        assert stats["mean_price"] == pytest.approx(mean, rel=1e-12)
        assert stats["stdev_price"] == pytest.approx(stdev, rel=1e-9, abs=1e-12)
        assert stats["vwap"] == pytest.approx(vwap, rel=1e-12)


def test_slices_do_not_change_results(spark):
    rows = random_rows(5, 400, "burst")
    df = spark.createDataFrame(
        [(s, p, float(q), T0 + timedelta(microseconds=t), n) for s, p, q, t, n in rows], SCHEMA
    )
    whole = rolling_stats(df, WindowParams(window_seconds=20.0))
    cut = rolling_stats(df, WindowParams(window_seconds=20.0, rows_per_slice=5))
    assert whole.exceptAll(cut).isEmpty() and cut.exceptAll(whole).isEmpty()


@pytest.mark.parametrize("bad", [
    {"window_seconds": 0.0}, {"window_seconds": -1.0}, {"window_seconds": float("nan")},
    {"mode": "other"}, {"price_scale": -1}, {"rows_per_slice": 0},
])
def test_bad_parameters_are_refused(bad):
    with pytest.raises(ValueError):
        WindowParams(**bad)


def test_small_slices_share_tasks(spark):
    """Slices follow the rows, tasks don't grow with them; slices of a key are in order and none is too long."""
    rows = spark.range(4000).select(F.when(F.col("id") % 4 == 0, "A").otherwise("B").alias("k"), F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("at"))
    placed, _ = cut(rows, ["k", "at"], 4000, 10, "test-slices")
    assert len(placed.inputFiles()) <= 64
    found = placed.groupBy("k", "slice").agg(F.count("*").alias("n"), F.min("at").alias("low"), F.max("at").alias("high")).orderBy("k", "slice").collect()
    assert sum(r.n for r in found) == 4000 and len(found) >= 400 and max(r.n for r in found) <= 10
    assert all(a.k != b.k or a.high <= b.low for a, b in zip(found, found[1:]))
