"""Exact sums, tables by symbol, sketches, joins around anomalies and counts of batches."""

import random
from datetime import timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.conftest import T0
from tests.test_plans import FOLDER, plan_of
from tests.test_stateful import Setup
from tests.test_stream import ticks
from tickloom.functions.exact import Sums, binary_text
from tickloom.operators.sketches import RANK_ERROR, merged_percentiles, minute_sketches
from tickloom.operators import exact
from tickloom.operators.window import exact_sums, rolling_stats
from tickloom.params import WindowParams
from tickloom.plans.queries import EVENTS
from tickloom.plans.tables import event_ticks
from tickloom.sinks.table import write_by_symbol
from tickloom.streaming.around import around_anomalies
from tickloom.streaming.metrics import QualityListener, batch_counts, counts_of

WINDOW = WindowParams(window_seconds=10.0)


def far_apart(n=120):
    rnd = random.Random(8)
    return [("X", rnd.uniform(1, 9) * 10.0 ** rnd.choice([-300, -8, 0, 3, 299]), 10.0 ** rnd.randint(-250, 40), i * 700_000, i) for i in range(n)]


@pytest.mark.parametrize("rows_per_slice", [17, 1_000_000])
def test_prices_of_any_size_equal_rational_arithmetic(spark, rows_per_slice):
    rows = far_apart()
    found = rolling_stats(ticks(spark, rows), WindowParams(window_seconds=10.0, rows_per_slice=rows_per_slice)).collect()
    assert len(found) == len(rows)
    for r in found:
        inside = [(Fraction(p), Fraction(q)) for _, p, q, t, _ in rows if r.seq * 700_000 - 10_000_000 <= t <= r.seq * 700_000]
        n, s1 = len(inside), sum(p for p, _ in inside)
        variance = sum((p - s1 / n) ** 2 for p, _ in inside) / n
        vwap = sum(p * q for p, q in inside) / sum(q for _, q in inside)
        assert r.stats.sample_count == n
        for got, want, power in ((r.stats.mean_price, s1 / n, 1), (r.stats.vwap, vwap, 1), (r.stats.stdev_price, variance, 2)):
            assert want == got == 0 or abs(Fraction(got) ** power / want - 1) < Fraction(1, 1 << 50)


def test_exact_sums_as_text(spark):
    got = {r.seq: r for r in exact_sums(ticks(spark, [("X", 0.5, 3, 0, 1), ("X", 2.0**-1000, 1, 1, 2), ("X", 2.0**60, 1, 20_000_000, 3)]), WINDOW).collect()}
    assert (got[1].n, got[1].s1, got[1].s2, got[1].pv, got[1].qv) == (1, "0.5", "0.25", "1.5", "3")
    assert Fraction(got[2].s1) == Fraction(1, 2) + Fraction(1, 2**1000) and got[3].s1 == str(2**60)
    assert binary_text(-5, 1) == "-2.5" and binary_text(0, 9) == "0" and binary_text(1 << 9, 9) == "1"


def test_values_near_the_largest():
    sums = Sums(0, 0, fine=True)
    sums.add(1e308, 1e308)
    sums.add(1e308, 1.0)
    assert sums.stats()[:2] == (1e308, 1e308)


def test_a_table_by_symbol_needs_no_exchange(spark, tmp_path):
    table = write_by_symbol(event_ticks(spark, FOLDER), "ticks_by_symbol", f"{tmp_path}/t", 4)
    found = rolling_stats(table, EVENTS, stored_by_symbol=True)
    plan = plan_of(found)
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert "Exchange" in plan_of(rolling_stats(table, EVENTS))
    assert found.exceptAll(rolling_stats(event_ticks(spark, FOLDER), EVENTS).select(*found.columns)).isEmpty()


def test_sketches_merge_within_their_bound(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("k"), F.timestamp_seconds(F.col("id") % 7200).alias("at"), F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("v")
    )
    stored = minute_sketches(rows, "k", "at", "v").collect()
    assert len(stored) == 240 and sum(r.n for r in stored) == 60_000
    merged = {r.k: r for r in merged_percentiles(spark.createDataFrame(stored), "k").collect()}
    for k, own in merged.items():
        values = sorted(r.v for r in rows.filter(F.col("k") == k).select("v").collect())
        assert own.n == len(values)
        for q, name in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
            rank = sum(v <= own[name] for v in values) / len(values)
            assert abs(rank - q) <= RANK_ERROR


def test_state_of_the_join_levels_off(spark, tmp_path):
    """Ticks of ten seconds each, an anomaly in each step: what the join keeps is a span of time, not the stream."""
    shape = "symbol string, price double, quantity double, trade_time timestamp, seq bigint"
    want, kept = [], []
    for step in range(8):
        base = T0 + timedelta(seconds=10 * step)
        rows = [("X", float(i), 1.0, base + timedelta(seconds=i / 10), step * 100 + i) for i in range(100)]
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(f"{tmp_path}/ticks")
        at = base + timedelta(seconds=5)
        spark.createDataFrame([("X", at, 50.0, step)], "symbol string, timestamp timestamp, triggering_price double, seq bigint").coalesce(1).write.mode("append").parquet(f"{tmp_path}/events")
        want += [(step, r[4]) for r in rows if -2 <= (r[3] - at).total_seconds() <= 1]
        events = spark.readStream.schema("symbol string, timestamp timestamp, triggering_price double, seq bigint").parquet(f"{tmp_path}/events")
        met = around_anomalies(events, spark.readStream.schema(shape).parquet(f"{tmp_path}/ticks"), 2.0, 1.0, 3.0, "seq")
        query = met.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/out")
        query.awaitTermination()
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert sorted((r.event_seq, r.seq) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == sorted(want)
    assert max(kept[2:]) <= 120 < 8 * 101


def test_exact_sums_hold_few_moves_at_a_time(spark, monkeypatch):
    cuts, cut = [], exact.cut
    monkeypatch.setattr(exact, "cut", lambda *a: cuts.append(cut(*a)) or cuts[-1])
    rows = [("X", 2.0 ** (40 * (i % 2)), 1, i * 1000, i) for i in range(15_000)]
    got = {r.seq: r for r in exact_sums(ticks(spark, rows), WindowParams(window_seconds=1.0)).collect()}
    assert max(r["count"] for r in cuts[0][0].groupBy("symbol", "slice").count().collect()) <= 10_000
    for i in (0, 700, 9_999, 14_999):
        inside = [p for _, p, _, at, _ in rows if (i - 1000) * 1000 <= at <= i * 1000]
        assert (got[i].n, int(got[i].s1), int(got[i].s2)) == (len(inside), sum(map(int, inside)), sum(int(p) ** 2 for p in inside))


def test_a_hot_symbol_of_the_join_is_spread_over_tasks(spark):
    """An event meets each tick of its span once, ends included, and the ticks of one symbol are no single key of the join."""
    rows = [("X", float(i), 1.0, T0 + timedelta(seconds=i / 2), i) for i in range(400)]
    table = spark.createDataFrame(rows, "symbol string, price double, quantity double, trade_time timestamp, seq bigint")
    found = [("X", T0 + timedelta(seconds=10 * i), 50.0, i) for i in range(20)]
    events = spark.createDataFrame(found, "symbol string, timestamp timestamp, triggering_price double, seq bigint")
    for before, after in ((2.0, 1.0), (0.0, 0.0), (30.0, 15.0)):
        met = around_anomalies(events.hint("shuffle_hash"), table, before, after, 3.0, "seq")
        want = [(e[3], t[4]) for e in found for t in rows if -before <= (t[3] - e[1]).total_seconds() <= after]
        assert sorted((r.event_seq, r.seq) for r in met.collect()) == sorted(want)
        assert "_stretch" not in met.columns and "_touched" not in met.columns
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert met.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_counts_of_batches(spark, tmp_path):
    run, reported = Setup(spark, tmp_path), []
    listener = QualityListener(reported.append)
    spark.streams.addListener(listener)
    try:
        from tickloom.schema import TOPIC

        spark.createDataFrame([(b"X", b"nope", "t", 0, 1, T0), (None, None, "t", 0, 2, T0)], TOPIC).write.mode("append").parquet(run.topic)
        query = run.drain([("X", 1, 1, 0, 3), ("Y", 1, 1, 0, 4), ("X", 2, 1, 1, 5)])
        counts = counts_of(query)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(listener)
    total = {name: sum(c[name] for c in counts) for name in ("emit", "too_late", "bad_json", "null_value", "price_invalid")}
    assert total == {"emit": 3, "too_late": 0, "bad_json": 1, "null_value": 1, "price_invalid": 0}
    assert [c for c in reported if c["emit"]] == [c for c in counts if c["emit"]]
    assert batch_counts({"observedMetrics": {}, "batchId": 0}) is None
