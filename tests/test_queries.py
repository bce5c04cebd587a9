import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tickloom.plans.oracle import ORACLE
from tickloom.plans.queries import QUERIES, _spread_events
from tickloom.plans.tables import read_table
from tests.compare import differences

FOLDER = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= registry.queries().keys()
    assert registry.oracle_sql().keys() <= registry.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, name):
    assert differences(spark, registry.queries()[name], registry.oracle_sql()[name], FOLDER) == []


def test_entry(spark):
    df = registry.entry(spark)
    assert df.count() == 986
    assert df.filter("is_anomaly").count() == 8


def test_events_of_one_file_are_read_by_many_tasks(spark, tmp_path):
    at = F.timestamp_seconds(F.col("id"))
    rows = spark.range(300_000).select(F.col("id").alias("event_id"), at.alias("ts"), F.rand(1).alias("value"), F.md5(F.col("id").cast("string")).alias("props"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    stored = read_table(spark, _spread_events(spark, str(tmp_path)), "events")
    assert read_table(spark, str(tmp_path), "events").select("event_id").inputFiles()[1:] == []
    assert len(stored.inputFiles()) > 3
    assert sorted(stored.columns) == sorted(rows.columns) and stored.exceptAll(rows).isEmpty() and stored.count() == 300_000
