import pytest
from pyspark.sql import functions as F

from tests.conftest import T0
from tickloom.functions.stats import zscore
from tickloom.operators.anomaly import anomaly_events, anomaly_log, processed_ticks, zscore_anomaly
from tickloom.operators.window import rolling_stats
from tickloom.params import AnomalyParams, FlushParams, WindowParams
from tickloom.schema import ANOMALY, PROCESSED

STATS = "struct<vwap:double,mean_price:double,stdev_price:double,sample_count:bigint,window_seconds:double>"


def scored(spark, cases, **params):
    rows = [
        ("X", float(price), 1.0, T0, "buy", (float(mean), float(mean), float(stdev), count, 10.0), i)
        for i, (price, mean, stdev, count) in enumerate(cases)
    ]
    df = spark.createDataFrame(
        rows, f"symbol string, price double, quantity double, trade_time timestamp, side string, stats {STATS}, seq bigint"
    )
    return zscore_anomaly(df, AnomalyParams(**params))


def test_zscore(spark):
    df = spark.createDataFrame([(100.0, 100.0, 5.0), (110.0, 100.0, 5.0), (500.0, 100.0, 0.0)], "p double, m double, s double")
    assert [r[0] for r in df.select(zscore(F.col("p"), F.col("m"), F.col("s"))).collect()] == [0.0, 2.0, 0.0]


def test_rule(spark):
    cases = [(107, 100, 2, 20), (102, 100, 2, 20), (90, 100, 2, 20), (1000, 100, 1, 2), (103, 100, 1, 20), (101, 100, 2, 20)]
    got = [(r["is_anomaly"], r["zscore"]) for r in scored(spark, cases).orderBy("seq").collect()]
    assert got == [(True, 3.5), (False, 1.0), (True, -5.0), (False, 0.0), (False, 3.0), (False, 0.5)]


def test_event_of_a_crash(spark):
    processed = processed_ticks(scored(spark, [(59500, 60000, 50, 30), (60010, 60000, 50, 30)]))
    assert [f.name for f in processed.schema] == PROCESSED.names
    assert [r["anomaly_zscore"] for r in processed.orderBy("price").collect()] == [-10.0, None]
    events = anomaly_events(processed)
    assert [f.name for f in events.schema] == ANOMALY.names
    (event,) = events.collect()
    assert (event["symbol"], event["triggering_price"], event["deviation_zscore"], event["threshold"]) == ("X", 59500.0, -10.0, 3.0)
    assert (event["rolling_mean"], event["rolling_stdev"]) == (60000.0, 50.0)


def test_only_the_spike_is_flagged(spark):
    cases = [(100, 100, 1, 10), (100.5, 100.1, 1, 11), (99.7, 100.05, 1, 12), (150, 100.1, 1, 13), (100.2, 100.1, 1, 14)]
    assert [r["price"] for r in scored(spark, cases).filter("is_anomaly").collect()] == [150.0]


def test_log_rounds(spark):
    events = anomaly_events(processed_ticks(scored(spark, [(107, 100.123456, 1.98765, 20)])))
    (line,) = anomaly_log(events).collect()
    assert (line["deviation_zscore"], line["rolling_mean"], line["rolling_stdev"]) == (3.46, 100.1235, 1.9876)


@pytest.mark.parametrize("n, flagged", [(9, False), (11, True)])
def test_a_tick_counts_in_its_own_window(spark, n, flagged):
    rows = [("X", 100.0, 1.0, T0, "buy", "binance", i) for i in range(n - 1)] + [("X", 200.0, 1.0, T0, "buy", "binance", n)]
    df = spark.createDataFrame(
        rows, "symbol string, price double, quantity double, trade_time timestamp, side string, source string, seq bigint"
    )
    last = zscore_anomaly(rolling_stats(df, WindowParams())).filter(F.col("seq") == n).first()
    assert last["is_anomaly"] is flagged
    assert last["zscore"] == pytest.approx((n - 1) ** 0.5)


@pytest.mark.parametrize("bad", [{"threshold": 0.0}, {"threshold": -3.0}, {"min_samples": 1}, {"min_samples": 2.5}])
def test_bad_rule_parameters(bad):
    with pytest.raises(ValueError):
        AnomalyParams(**bad)


@pytest.mark.parametrize("bad", [{"rows": 0}, {"seconds": 0.0}])
def test_bad_flush_parameters(bad):
    with pytest.raises(ValueError):
        FlushParams(**bad)
