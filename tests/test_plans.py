"""The shape of physical plans: one shuffle of the ticks, nothing in Python, pushdown to the scan."""

from pyspark.sql import functions as F

from tickloom.functions.instants import day_key
from tickloom.operators.quality import parse_exchange, valid_ticks
from tickloom.operators.snapshot import snapshot
from tickloom.operators.window import rolling_stats
from tickloom.params import WindowParams
from tickloom.plans.tables import event_ticks, exchange_messages
from tickloom.sinks.topic import topic_records
from tickloom.sources.table import read_table

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_shuffles_ticks_once(spark):
    plan = plan_of(rolling_stats(event_ticks(spark, FOLDER), WindowParams(price_scale=2)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("+- Sort") == 1  # both window passes use one sort
    assert "Python" not in plan and "PushedFilters: [IsNotNull(value), GreaterThan(value,0.0)]" in plan


def test_sliced_window_plan(spark):
    plan = plan_of(rolling_stats(event_ticks(spark, FOLDER), WindowParams(price_scale=2, quantity_scale=0, rows_per_slice=100)))
    # The stored moves, the partially aggregated slice totals, and the running total over those.
    assert plan.count("Exchange hashpartitioning") == 3
    # Twice 986 ticks over slices of 100: the number of partitions follows the rows.
    assert "hashpartitioning(symbol" in plan and ", 20), REPARTITION_BY_NUM" in plan
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "aggregate(" not in plan and "transform(" not in plan and "BroadcastHashJoin" not in plan


def test_snapshot_filters_reach_the_scan(spark, tmp_path):
    path = f"{tmp_path}/days"
    ticks = event_ticks(spark, FOLDER)
    ticks.withColumn("partition_key", day_key(F.col("trade_time"))).write.partitionBy("partition_key").parquet(path)
    window = WindowParams(window_seconds=86_400.0, price_scale=2, quantity_scale=0)
    found = snapshot(read_table(spark, path), window, ["PURCHASE", "VIEW"])
    plan = plan_of(found)
    assert "In(symbol, [PURCHASE,VIEW])" in plan and "GreaterThanOrEqual(trade_time" in plan
    assert "PartitionFilters: [isnotnull(partition_key" in plan
    assert found.exceptAll(snapshot(ticks, window, ["PURCHASE", "VIEW"])).isEmpty()


def test_parsing_is_one_pass(spark):
    plan = plan_of(valid_ticks(parse_exchange(exchange_messages(spark, FOLDER)), "seq"))
    assert "Exchange" not in plan and "Python" not in plan
    # Once inside brackets; the second form is only for doubtful texts.
    assert plan.lower().count("parsejson") <= 2


def test_publishing_needs_no_shuffle(spark):
    assert "Exchange" not in plan_of(topic_records(event_ticks(spark, FOLDER)))
