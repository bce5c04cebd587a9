import json
import os
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import T0, seconds
from tickloom.functions.symbols import allow_symbols, symbol_list, symbol_list_column
from tickloom.operators.quality import parse_canonical, valid_ticks
from tickloom.params import FlushParams, WindowParams
from tickloom.plans.pipeline import Job, process, run_batch, sinks_from_settings
from tickloom import files
from tickloom.schema import REJECT, STORED, TICK, TOPIC
from tickloom.session import scratch, shared_folder
from tickloom.sinks.table import archive_days, drop_archived, market_ticks, stored_rows, with_iso_time, write_batch, write_days
from tickloom.sinks.topic import kafka_sink_options, topic_records, write_topic
from tickloom.sources.messages import read_messages
from tickloom.sources.table import anomaly_scan, archived_days, range_scan, read_history, read_table
from tickloom.sources.topic import as_arrivals, kafka_source_options, read_topic


@pytest.fixture(scope="module")
def ticks(spark):
    rows = [
        (symbol, 100.0 + i % 7 + (50 if i == 40 else 0), 0.25, T0 + timedelta(hours=i) + seconds(0.000001 * (i % 2)), "buy", "binance", i)
        for i in range(60)
        for symbol in ("BTCUSDT", "ETHUSDT")
    ]
    return spark.createDataFrame(rows, TICK)


@pytest.fixture(scope="module")
def processed(ticks):
    return process(ticks, WindowParams(window_seconds=86400.0))


def test_topic_record_shape(spark, ticks):
    records = topic_records(ticks)
    assert [(f.name, f.dataType) for f in records.schema] == [(f.name, f.dataType) for f in TOPIC]
    first, second = records.filter("offset < 2").orderBy("offset", "key").collect()[1:3]
    assert first["key"] == b"ETHUSDT"
    assert json.loads(first["value"]) == {
        "symbol": "ETHUSDT", "price": 100.0, "quantity": 0.25, "trade_time": "2026-01-01T12:00:00Z", "side": "buy", "source": "binance",
    }
    assert json.loads(second["value"])["trade_time"] == "2026-01-01T13:00:00.000001Z"


def test_empty_symbol_has_no_key(spark, ticks):
    assert topic_records(ticks.withColumn("symbol", F.lit(""))).select("key").first()[0] is None


def test_a_symbol_keeps_its_partition_and_order(spark, ticks):
    records = topic_records(ticks.repartition(5))
    assert records.groupBy("key").agg(F.countDistinct("partition").alias("n")).filter("n <> 1").isEmpty()
    assert records.groupBy("key", "offset").count().filter("count > 1").isEmpty()


def test_topic_roundtrip(spark, ticks, tmp_path):
    write_topic(topic_records(ticks), f"{tmp_path}/topic")
    back = valid_ticks(parse_canonical(as_arrivals(read_topic(spark, f"{tmp_path}/topic"))), "seq")
    assert sorted(back.collect()) == sorted(ticks.select(*back.columns).collect())


def test_kafka_options():
    source = kafka_source_options(flush=FlushParams(rows=70))
    assert source["startingOffsets"] == "latest" and source["subscribe"] == "market-data-raw"
    assert source["maxOffsetsPerTrigger"] == "70" and kafka_source_options()["maxOffsetsPerTrigger"] == "50" and source["groupIdPrefix"] == "processing-service"
    assert kafka_sink_options()["kafka.acks"] == "all"


def test_landed_text(spark, tmp_path):
    (tmp_path / "a.txt").write_text('{"s":"a"}\nnot json\n')
    rows = read_messages(spark, str(tmp_path)).orderBy("seq").collect()
    assert [r["value"] for r in rows] == ['{"s":"a"}', "not json"]


def test_stored_rows(spark, processed):
    stored = stored_rows(processed)
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in STORED]
    rows = with_iso_time(stored).filter("symbol = 'BTCUSDT'").orderBy("trade_time").limit(2).collect()
    assert [r["trade_time"] for r in rows] == ["2026-01-01T12:00:00+00:00", "2026-01-01T13:00:00.000001+00:00"]
    assert rows[0]["partition_key"] == "2026-01-01" and rows[0]["is_anomaly"] == 0


def test_market_ticks(processed):
    assert market_ticks(processed).columns == [
        "timestamp", "symbol", "price", "quantity", "rolling_vwap", "rolling_mean", "rolling_std", "is_anomaly", "z_score",
    ]


def test_day_table_scans(spark, processed, tmp_path):
    path = f"{tmp_path}/days"
    write_days(stored_rows(processed), path)
    table = read_table(spark, path)
    assert table.count() == 120
    start, end = datetime(2026, 1, 2, 6), datetime(2026, 1, 3, 5)
    found = range_scan(table, "BTCUSDT", start, end)
    want = [r for r in processed.collect() if r["symbol"] == "BTCUSDT" and start <= r["trade_time"] <= end]
    assert found.count() == len(want) > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_key" in plan
    assert "GreaterThanOrEqual(trade_time" in plan and "EqualTo(symbol,BTCUSDT)" in plan
    flagged = anomaly_scan(table)
    assert {r["price"] for r in flagged.collect()} == {155.0} and flagged.count() == 2


def test_rewritten_batch_replaces_itself(spark, processed, tmp_path):
    path = f"{tmp_path}/days"
    for _ in range(2):
        write_days(stored_rows(processed), path, 0)
    write_days(stored_rows(processed), path, 1)
    assert read_table(spark, path).count() == 240
    assert sorted(p.name for p in (tmp_path / "days").iterdir()) == ["batch=0", "batch=1"]
    assert not list((tmp_path / "days").rglob("_temporary*")) and "batch" not in read_table(spark, path).columns


def plain(rows):
    return sorted(str(tuple(r[c] for c in sorted(rows.columns))) for r in rows.collect())


def test_readers_see_every_row_while_days_are_archived(spark, processed, tmp_path):
    path, archive = f"{tmp_path}/days", f"{tmp_path}/archive"
    stored = stored_rows(processed)
    for batch in range(4):
        write_days(stored.filter(F.pmod(F.hash("trade_time", "symbol"), F.lit(4)) == batch), path, batch)
    want, seen, stop = plain(stored), [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append((plain(read_table(spark, path)), plain(read_history(spark, path, archive))))

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for day in ("2026-01-02", "2026-01-02", "2026-01-03"):
            archive_days(spark, path, archive, day)
    finally:
        stop.set()
        reader.join()
    assert len(seen) > 1 and all(a == b == want for a, b in seen)
    assert archived_days(spark, archive) == {"2026-01-01": 3, "2026-01-02": 3}
    assert drop_archived(spark, path, archive) == []  # every batch has rows of later days
    archive_days(spark, path, archive, "2027-01-01")
    assert drop_archived(spark, path, archive) == [0, 1, 2, 3]
    assert plain(read_history(spark, path, archive)) == want
    assert len(list((tmp_path / "archive").rglob("*.parquet"))) <= 8


def test_late_ticks_of_archived_days_are_kept(spark, processed, tmp_path):
    path, archive = f"{tmp_path}/days", f"{tmp_path}/archive"
    stored = stored_rows(processed)
    first, second = (stored.filter(f"partition_key = '2026-01-0{d}'") for d in (1, 2))
    late = first.orderBy("trade_time", "symbol").limit(1)
    write_days(first.exceptAll(late), path, 0)
    archive_days(spark, path, archive, "2026-01-02")
    write_days(late, path, 1)
    assert drop_archived(spark, path, archive) == [0]
    write_days(second, path, 2)
    archive_days(spark, path, archive, "2026-01-03")
    assert drop_archived(spark, path, archive) == [2]
    assert plain(read_history(spark, path, archive)) == plain(first.unionByName(second))
    found = read_history(spark, path, archive).filter("partition_key = '2026-01-02'")
    assert not [r[0] for r in found.select(F.input_file_name()).distinct().collect() if "batch=" in r[0]]


def test_what_is_not_committed_does_not_count(spark, processed, tmp_path):
    path, archive = f"{tmp_path}/days", f"{tmp_path}/archive"
    write_days(stored_rows(processed), path, 0)
    archive_days(spark, path, archive, "2026-01-02")
    (tmp_path / "archive" / "archived=1" / "_SUCCESS").unlink()
    assert archived_days(spark, archive) == {} and drop_archived(spark, path, archive) == []
    assert plain(read_history(spark, path, archive)) == plain(stored_rows(processed))


def test_anomaly_scan_reads_flagged_files_only(spark, processed, tmp_path):
    path = f"{tmp_path}/days"
    write_days(stored_rows(processed), path)
    found = anomaly_scan(read_table(spark, path))
    read = [f for f in found.inputFiles() if "is_anomaly=1" not in f]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_anomaly" in plan and "DataFilters: []" in plan
    assert found.count() == 2 and read != []


def test_batch_job_writes_every_output(spark, ticks, tmp_path):
    bad = spark.createDataFrame([(b"nope", 10_000), (None, 10_001)], "value binary, seq bigint")
    records = as_arrivals(topic_records(ticks)).select("value", "seq").unionByName(bad)
    sinks = sinks_from_settings({"backend": "Parquet", "folder": str(tmp_path)})
    job = Job(window=WindowParams(window_seconds=86400.0))
    for _ in range(2):  # a repeated run leaves no duplicates
        run_batch(records, sinks, 7, job)
    assert read_table(spark, f"{tmp_path}/processed_ticks").count() == 120
    assert read_table(spark, f"{tmp_path}/anomaly_events").count() == 2
    refused = read_table(spark, f"{tmp_path}/rejects")
    assert refused.dtypes == [(f.name, f.dataType.simpleString()) for f in REJECT]
    assert sorted((r["reject_reason"], r["value"]) for r in refused.collect()) == [("bad_json", b"nope"), ("null_value", None)]
    left = files.names(spark, os.path.dirname(scratch(spark, "x")))
    assert not [n for n in left if n.startswith(("parsed-", "processed-"))]


def test_a_cluster_needs_a_shared_folder(spark):
    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("Context", (), {"master": "spark://host:7077", "getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster)


@pytest.mark.parametrize("size", ["128m", "1k"])
def test_landed_lines_keep_their_order(spark, tmp_path, size):
    """A small old file, then a large one, then a small one whose name sorts first: by time, whatever the splits."""
    for n, (name, rows) in enumerate([("m.txt", 2), ("z.txt", 700), ("a.txt", 3)]):
        (tmp_path / name).write_text("".join(f"{n}-{i:04d}\n" for i in range(rows)))
        os.utime(tmp_path / name, (1_700_000_000 + n, 1_700_000_000 + n))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        rows = read_messages(spark, str(tmp_path)).orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["seq"] for r in rows] == list(range(705))
    assert [r["value"] for r in rows] == [f"{n}-{i:04d}" for n, k in enumerate((2, 700, 3)) for i in range(k)]


def test_a_key_that_moves_keeps_its_order(spark):
    rows = [(b"K", b"1", "t", 0, 5, T0), (b"K", b"2", "t", 0, 9, T0 + seconds(1)), (b"K", b"3", "t", 4, 0, T0 + seconds(2)), (b"L", b"4", "t", 1, 3, T0)]
    got = as_arrivals(spark.createDataFrame(rows, TOPIC)).filter("key = 'K'").orderBy("seq").collect()
    assert [r["value"] for r in got] == [b"1", b"2", b"3"]
    still = as_arrivals(spark.createDataFrame(rows[:2], TOPIC)).collect()
    assert sorted(r["seq"] for r in still) == [5, 9]


def test_unknown_settings_are_refused():
    with pytest.raises(ValueError):
        sinks_from_settings({"backend": "other", "folder": "x"})
    with pytest.raises(ValueError):
        Job(form="other")


def test_symbol_lists(spark, ticks):
    assert symbol_list(" btcusdt, ,ethusdt,,") == ["BTCUSDT", "ETHUSDT"]
    df = spark.createDataFrame([(" btcusdt, ,ethusdt,,",), ("",)], "t string")
    assert [r[0] for r in df.select(symbol_list_column(F.col("t"))).collect()] == [["BTCUSDT", "ETHUSDT"], []]
    assert allow_symbols(ticks, ["BTCUSDT"]).count() == 60
    many = [f"S{i}" for i in range(2000)] + ["ETHUSDT"]
    assert allow_symbols(ticks, many).count() == 60
    assert allow_symbols(ticks, []).count() == 0
