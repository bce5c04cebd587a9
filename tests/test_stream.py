import glob
import json
import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.brute import simulate
from tests.conftest import T0, seconds
from tickloom.params import FlushParams, WindowParams
from tickloom.plans.pipeline import Job, Sinks, process, table_sinks
from tickloom.schema import TICK, TOPIC
from tickloom.sinks.topic import topic_records, write_topic
from tickloom.sources.messages import stream_messages
from tickloom.sources.table import read_table
from tickloom.sources.topic import as_arrivals, positions, read_topic, stream_topic
from tickloom.sinks.table import write_batch
from tickloom.streaming.job import TAIL_SCHEMA, IngestJob, StreamJob, WindowTail, publish, run, start, trigger_options

WINDOW = WindowParams(window_seconds=10.0, mode="arrival")


def ticks(spark, rows):
    return spark.createDataFrame(
        [(s, float(p), float(q), T0 + timedelta(microseconds=t), "buy", "binance", n) for s, p, q, t, n in rows], TICK
    )


def late_rows(n):
    rnd, clock, rows = random.Random(21), 0, []
    for seq in range(n):
        clock += rnd.randint(0, 2_000_000)
        at = max(0, clock - rnd.choice([0, 0, rnd.randint(0, 25_000_000)]))
        rows.append((rnd.choice(["HOT", "HOT", "A"]), round(rnd.uniform(1, 99), 2), rnd.randint(1, 9), at, seq))
    return rows


class Setup:
    def __init__(self, spark, folder, **options):
        self.spark, self.topic, self.out = spark, f"{folder}/topic", f"{folder}/out"
        self.checkpoint = f"{folder}/checkpoint"
        self.tail = WindowTail(f"{folder}/tail")
        self.job = StreamJob(options.pop("sinks", table_sinks(self.out)), self.tail, Job(window=options.pop("window", WINDOW)), **options)

    def drain(self, rows=None, job=None):
        if rows is not None:
            write_topic(topic_records(ticks(self.spark, rows)).coalesce(1), self.topic)
        query = start(as_arrivals(stream_topic(self.spark, self.topic)), job or self.job, self.checkpoint, drain=True)
        query.awaitTermination()

    def counts(self):
        if not glob.glob(f"{self.out}/processed_ticks/**/*.parquet", recursive=True):
            return []
        table = read_table(self.spark, f"{self.out}/processed_ticks")
        return sorted((r["symbol"], r["trade_time"], r["price"], r["sample_count"]) for r in table.collect())


class SeenJob(Job):
    """Notes the plans of the records that it parses."""

    plans = []

    def parse(self, records):
        self.plans.append(records._jdf.queryExecution().optimizedPlan().toString())
        return super().parse(records)


def expected(rows):
    want = simulate(rows, WINDOW.window_us, arrival=True)
    return sorted(
        (s, (T0 + timedelta(microseconds=t)).replace(tzinfo=None), p, want[s, n][0]) for s, p, q, t, n in rows
    )


@pytest.mark.parametrize("rows_per_slice", [6, 10_000])
def test_window_goes_on_across_batches_and_restarts(spark, tmp_path, rows_per_slice):
    rows = late_rows(90)
    run = Setup(spark, tmp_path, window=WindowParams(window_seconds=10.0, mode="arrival", rows_per_slice=rows_per_slice))
    for first in range(0, 90, 30):
        run.drain(rows[first : first + 30])  # each drain is a fresh query on the same checkpoint
    assert run.counts() == expected(rows)


def test_records_of_one_file_are_parsed_by_many_tasks(spark, tmp_path):
    rows, plans = late_rows(30), SeenJob.plans
    plans.clear()
    run = Setup(spark, tmp_path)
    run.drain(rows, StreamJob(table_sinks(run.out), run.tail, SeenJob(window=WINDOW)))  # drain writes one file
    assert plans and all("RepartitionByExpression [seq" in plan for plan in plans)
    assert run.counts() == expected(rows)


def test_stream_equals_batch(spark, tmp_path):
    rows = late_rows(60)
    run = Setup(spark, tmp_path)
    run.drain(rows[:25])
    run.drain(rows[25:])
    batch = process(ticks(spark, rows), WINDOW)
    want = sorted((r["symbol"], r["trade_time"], *r["stats"][:4], int(r["is_anomaly"])) for r in batch.collect())
    table = read_table(spark, f"{run.out}/processed_ticks")
    got = sorted(
        (r["symbol"], r["trade_time"], r["vwap"], r["mean_price"], r["stdev_price"], r["sample_count"], r["is_anomaly"])
        for r in table.collect()
    )
    assert got == want


def test_failed_batch_is_retried_without_loss_or_duplicates(spark, tmp_path):
    rows = late_rows(60)
    run = Setup(spark, tmp_path)
    run.drain(rows[:30])

    def fails(*_):
        raise RuntimeError("sink down")

    # The ticks are written, then the batch dies before it is committed.
    broken = StreamJob(Sinks(run.job.sinks.processed, fails, run.job.sinks.rejects), run.tail, run.job.job)
    with pytest.raises(Exception, match="sink down"):
        run.drain(rows[30:], broken)
    run.drain()
    assert run.counts() == expected(rows)


def test_rejects_do_not_stop_the_stream(spark, tmp_path):
    run = Setup(spark, tmp_path)
    bad = spark.createDataFrame([(b"X", b"nope", "t", 0, 1, T0), (None, None, "t", 0, 2, T0)], TOPIC)
    bad.write.mode("append").parquet(run.topic)
    run.drain([("X", 1, 1, 0, 3)])
    assert [c[3] for c in run.counts()] == [1]
    assert spark.read.parquet(f"{run.out}/rejects").count() == 2
    run.drain([("X", 1, 1, 1_000_000, 4)])
    assert [c[3] for c in run.counts()] == [1, 2]


def test_late_tick_in_a_later_batch(spark, tmp_path):
    run = Setup(spark, tmp_path)
    for row in [("X", 1, 1, 0, 1), ("X", 1, 1, 20_000_000, 2), ("X", 1, 1, 5_000_000, 3)]:
        run.drain([row])
    assert [c[3] for c in run.counts()] == [1, 2, 1]  # in time order: T0, T0+5 s (late), T0+20 s


def test_idle_symbols_can_be_freed(spark, tmp_path):
    kept, freed = Setup(spark, tmp_path / "a"), Setup(spark, tmp_path / "b", idle_seconds=0.000001)
    for run in (kept, freed):
        run.drain([("X", 1, 1, 0, 1)])
        run.drain([("Y", 1, 1, 0, 2)])
        run.drain([("X", 1, 1, 1_000_000, 3)])
    assert [c[3] for c in kept.counts() if c[0] == "X"] == [1, 2]
    assert [c[3] for c in freed.counts() if c[0] == "X"] == [1, 1]


def test_triggers():
    assert trigger_options(drain=True) == {"availableNow": True}
    assert trigger_options(FlushParams()) == {"processingTime": "2.0 seconds"}


@pytest.mark.parametrize("lateness", [0.0, 30.0])
def test_time_order_with_allowed_lateness(spark, tmp_path, lateness):
    rows = late_rows(60)
    window = WindowParams(window_seconds=10.0)
    run = Setup(spark, tmp_path, window=window, lateness_seconds=lateness)
    newest, mark, emitted, refused = {}, {}, [], 0
    for first in (0, 20, 40):
        chunk = rows[first : first + 20]
        run.drain(chunk)
        for row in chunk:
            if row[3] < mark.get(row[0], -(10**18)):
                refused += 1
            else:
                emitted.append(row)
                newest[row[0]] = max(newest.get(row[0], row[3]), row[3])
        mark = {s: t - round(lateness * 1e6) for s, t in newest.items()}
    want = simulate(emitted, window.window_us, arrival=False)
    ready = [r for r in emitted if r[3] <= mark[r[0]]]
    assert run.counts() == sorted(
        (s, (T0 + timedelta(microseconds=t)).replace(tzinfo=None), p, want[s, n][0]) for s, p, q, t, n in ready
    )
    found = spark.read.schema("value binary, reject_reason string, batch_id int").parquet(f"{run.out}/rejects") if refused else None
    assert (found.filter("reject_reason = 'too_late'").count() if found else 0) == refused
    assert len(ready) < len(rows) if lateness else refused > 0


def test_everything_leaves_after_the_last_drain(spark, tmp_path):
    """Late ticks, a quiet symbol, and a symbol whose only tick would wait for ever."""
    rows = late_rows(60) + [("QUIET", 5.0, 1, 3_000_000, 1000)]
    window = WindowParams(window_seconds=10.0)
    run = Setup(spark, tmp_path, window=window, lateness_seconds=60.0)
    for chunk in (rows[:20], rows[20:40], rows[40:]):
        run.drain(chunk)
    held = len(rows) - len(run.counts())
    assert held > 0
    run.job.release(spark)
    run.job.release(spark)  # a second time changes nothing
    want = simulate(rows, window.window_us, arrival=False)
    every = sorted((s, (T0 + timedelta(microseconds=t)).replace(tzinfo=None), p, want[s, n][0]) for s, p, q, t, n in rows)
    assert run.counts() == every
    # The stream goes on; what is older than what has left is too late.
    run.drain([("QUIET", 6.0, 1, 2_000_000, 1001), ("QUIET", 7.0, 1, 9_000_000, 1002)])
    run.job.release(spark)
    assert run.counts() == sorted([*every, ("QUIET", (T0 + timedelta(seconds=9)).replace(tzinfo=None), 7.0, 2)])
    assert [r["reject_reason"] for r in spark.read.parquet(f"{run.out}/rejects").collect()] == ["too_late"]


def test_idle_symbol_lets_go_of_what_it_holds(spark, tmp_path):
    run = Setup(spark, tmp_path, window=WindowParams(window_seconds=10.0), lateness_seconds=60.0, idle_seconds=0.000001)
    run.drain([("X", 1, 1, 0, 1), ("X", 2, 1, 1_000_000, 2)])
    assert run.counts() == []
    run.drain([("Y", 1, 1, 0, 3)])
    assert [c[3] for c in run.counts()] == [1, 2]
    run.drain([("Y", 1, 1, 1, 4)])
    run.drain([("X", 3, 1, 2_000_000, 5)])
    run.job.release(spark)
    assert [c[3] for c in run.counts() if c[0] == "X"] == [1, 2, 1]  # its window had been freed


def test_retry_has_the_clock_of_the_first_attempt(spark, tmp_path):
    tail = WindowTail(f"{tmp_path}/tail")
    assert tail.clock(spark, 4) == tail.clock(spark, 4) != tail.clock(spark, 6)


def test_missing_tail_is_an_error(spark, tmp_path):
    tail = WindowTail(f"{tmp_path}/tail")
    assert tail.before(spark, 0).count() == 0
    with pytest.raises(ValueError, match="no tail"):
        tail.before(spark, 4)
    tail.keep(spark.createDataFrame([], TAIL_SCHEMA), 0)
    assert tail.before(spark, 2).count() == 0
    with pytest.raises(ValueError, match="can't go on"):
        tail.before(spark, 6)


def test_exchange_text_streams_to_the_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    message = lambda p, t: json.dumps({"s": "btcusdt", "p": p, "q": "1", "T": t, "m": False}) + "\n"
    (tmp_path / "in" / "b.txt").write_text(message("1", 1_700_000_000_000) + "nope\n" + message("2", 1_700_000_000_000))
    os.utime(tmp_path / "in" / "b.txt", (1_700_000_000, 1_700_000_000))
    (tmp_path / "in" / "a.txt").write_text(message("3", 1_700_000_000_000))
    job = StreamJob(table_sinks(f"{tmp_path}/out"), WindowTail(f"{tmp_path}/tail"), Job(form="exchange", window=WINDOW))
    run(stream_messages(spark, f"{tmp_path}/in"), job, f"{tmp_path}/checkpoint")
    (tmp_path / "in" / "0.txt").write_text(message("4", 1_700_000_001_000))
    run(stream_messages(spark, f"{tmp_path}/in"), job, f"{tmp_path}/checkpoint")
    table = read_table(spark, f"{tmp_path}/out/processed_ticks")
    assert sorted((r["price"], r["sample_count"]) for r in table.collect()) == [(1.0, 1), (2.0, 2), (3.0, 3), (4.0, 4)]
    assert spark.read.parquet(f"{tmp_path}/out/rejects").count() == 1


def test_a_key_that_moves_within_a_batch_is_refused(spark, tmp_path):
    stream = Setup(spark, tmp_path)
    both = topic_records(ticks(spark, [("X", 1, 1, 0, 1), ("X", 1, 1, 1, 2)])).withColumn("partition", F.col("offset").cast("int"))
    write_topic(both, stream.topic)
    with pytest.raises(Exception, match="two partitions"):
        stream.drain()


@pytest.mark.parametrize("mode, lateness", [("event_time", None), ("arrival", 1.0), ("event_time", -1.0)])
def test_lateness_goes_with_time_order(mode, lateness):
    with pytest.raises(ValueError):
        StreamJob(Sinks(), WindowTail("x"), Job(window=WindowParams(mode=mode)), lateness_seconds=lateness)


def test_handler_sees_every_message(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one\ntwo\n")
    seen = []
    query = publish(
        stream_messages(spark, str(tmp_path / "in")), lambda batch, _: seen.extend(r["value"] for r in batch.collect()),
        str(tmp_path / "checkpoint"), drain=True,
    )
    query.awaitTermination()
    assert sorted(seen) == ["one", "two"]


def test_batches_of_a_folder_have_bounded_rows(spark, tmp_path):
    flush, sizes = FlushParams(rows=7), []
    records = topic_records(ticks(spark, [("X", 1, 1, n * 1_000_000, n) for n in range(40)]))
    write_topic(records.repartition(2), f"{tmp_path}/topic", flush)
    query = publish(
        as_arrivals(stream_topic(spark, f"{tmp_path}/topic", flush=flush)), lambda batch, _: sizes.append(batch.count()), f"{tmp_path}/checkpoint", drain=True
    )
    query.awaitTermination()
    assert sum(sizes) == 40 and max(sizes) <= 7


def test_start_positions_of_a_folder(spark, tmp_path):
    path, seen = f"{tmp_path}/topic", []
    write_topic(topic_records(ticks(spark, [("X", 1, 1, n, n) for n in range(5)])), path)
    partition = read_topic(spark, path).first()["partition"]
    assert positions(spark, path) == {partition: 5}
    sources = {"latest": stream_topic(spark, path, starting="latest"), "third": stream_topic(spark, path, starting={partition: 3, 99: 0})}
    write_topic(topic_records(ticks(spark, [("X", 1, 1, n, n) for n in range(5, 8)])), path)
    for name, source in sources.items():
        publish(source, lambda batch, _: seen.extend((name, r["offset"]) for r in batch.collect()), f"{tmp_path}/{name}", drain=True).awaitTermination()
    assert sorted(seen) == [("latest", 5), ("latest", 6), ("latest", 7)] + [("third", n) for n in range(3, 8)]
    with pytest.raises(ValueError, match="starting"):
        stream_topic(spark, path, starting="last")


def test_rows_leave_one_for_one(spark, tmp_path):
    run = Setup(spark, tmp_path)
    run.drain([("X", 1, 1, 0, n) for n in range(5)])
    assert [c[3] for c in run.counts()] == [1, 2, 3, 4, 5]


def test_messages_are_published_and_rejects_set_aside(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"s":"btcusdt","p":"0.5","q":"2","T":1672515782136,"m":true}\nnope\n')
    job = IngestJob(
        lambda rows, _: rows.write.mode("append").parquet(f"{tmp_path}/topic"),
        lambda rows, batch_id: write_batch(rows, f"{tmp_path}/rejects", batch_id),
    )
    publish(stream_messages(spark, str(tmp_path / "in")), job, str(tmp_path / "checkpoint"), drain=True).awaitTermination()
    (record,) = spark.read.parquet(f"{tmp_path}/topic").collect()
    assert record["key"] == b"BTCUSDT" and b'"trade_time":"2022-12-31T19:43:02.136000Z"' in record["value"]
    assert [r["reject_reason"] for r in spark.read.parquet(f"{tmp_path}/rejects").collect()] == ["bad_json"]
