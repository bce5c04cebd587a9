import random
from datetime import timedelta
from fractions import Fraction

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.brute import simulate
from tests.conftest import T0
from tests.test_stream import late_rows, ticks
from tickloom.params import WindowParams
from tickloom.plans.pipeline import Job, process, table_sinks
from tickloom.schema import TOPIC
from tickloom.session import prepare
from tickloom.sinks.topic import topic_records, write_topic
from tickloom.sources.table import read_table
from tickloom.sources.topic import as_arrivals, stream_topic
from tickloom.operators.snapshot import snapshot
from tickloom.streaming import stateful
from tickloom.functions.exact import Sums
from tickloom.streaming.stateful import StatefulJob, state_snapshot, until_idle, use_state_store

WINDOW = WindowParams(window_seconds=10.0, mode="arrival")
ORDERED = WindowParams(window_seconds=10.0)


class Setup:
    def __init__(self, spark, folder, window=WINDOW, **options):
        self.spark, self.topic, self.out, self.checkpoint = prepare(spark), f"{folder}/topic", f"{folder}/out", f"{folder}/checkpoint"
        self.job = StatefulJob(table_sinks(self.out), Job(window=window), **options)

    def add(self, rows):
        write_topic(topic_records(ticks(self.spark, rows)).coalesce(1), self.topic)

    def drain(self, rows=None, job=None):
        if rows is not None:
            self.add(rows)
        query = (job or self.job).start(as_arrivals(stream_topic(self.spark, self.topic)), self.checkpoint, drain=True)
        query.awaitTermination()
        return query

    def counts(self):
        table = read_table(self.spark, f"{self.out}/processed_ticks")
        return sorted((r["symbol"], r["trade_time"], r["price"], r["sample_count"]) for r in table.collect())


def expected(rows, arrival=True):
    want = simulate(rows, WINDOW.window_us, arrival=arrival)
    return sorted((s, (T0 + timedelta(microseconds=t)).replace(tzinfo=None), p, want[s, n][0]) for s, p, q, t, n in rows)


def test_state_goes_on_across_batches_and_restarts(spark, tmp_path):
    rows = late_rows(90)
    run = Setup(spark, tmp_path)
    for first in range(0, 90, 30):
        run.drain(rows[first : first + 30])  # each drain is a fresh query on the same checkpoint
    assert run.counts() == expected(rows)
    batch = process(ticks(spark, rows), WINDOW)
    want = sorted((r["symbol"], r["trade_time"], *r["stats"][:4], int(r["is_anomaly"])) for r in batch.collect())
    table = read_table(spark, f"{run.out}/processed_ticks")
    names = ("symbol", "trade_time", "vwap", "mean_price", "stdev_price", "sample_count", "is_anomaly")
    assert sorted(tuple(r[n] for n in names) for r in table.collect()) == want
    assert sorted(map(str, state_snapshot(spark, run.checkpoint, WINDOW).collect())) == sorted(map(str, snapshot(ticks(spark, rows), WINDOW).collect()))


class Value:
    """A value or map state in memory."""

    def __init__(self):
        self.data = {}

    def exists(self):
        return () in self.data

    def get(self):
        return self.data[()]

    def update(self, value):
        self.data[()] = value

    def clear(self):
        self.data.clear()

    def containsKey(self, key):
        return key in self.data

    def getValue(self, key):
        return self.data[key]

    def updateValue(self, key, value):
        self.data[key] = value

    def removeKey(self, key):
        del self.data[key]

    def keys(self):
        return iter(list(self.data))


class Handle:
    def __init__(self):
        self.states, self.timers = {}, set()

    def getValueState(self, name, *schemas):
        return self.states.setdefault(name, Value())

    def getMapState(self, name, key, value):
        return self.states.setdefault(name, Value())

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def frame(rows):
    import pandas as pd

    return pd.DataFrame([("X", p, q, t, "buy", "binance", n) for p, q, t, n in rows], columns=["symbol", *stateful._TICK])


def through(processor, handle, batches, now=0):
    out = []
    for batch in batches:
        processor.init(handle)
        for found in processor.handleInputRows(("X",), iter([frame(batch[: len(batch) // 2]), frame(batch[len(batch) // 2 :])]), Clock(now)):
            out += found.to_dict("records")
    return out


@pytest.mark.parametrize("slot", [1, 3, 512])
@pytest.mark.parametrize("seed", range(6))
def test_slots_hold_the_window(monkeypatch, slot, seed):
    monkeypatch.setattr(stateful, "SLOT", slot)
    rnd, clock, rows = random.Random(seed), 0, []
    for n in range(300):
        clock += rnd.randint(0, 900_000) if rnd.random() < 0.97 else 30_000_000
        rows.append((rnd.choice([0.01, 0.1, 99.99, 7.0]), float(rnd.randint(1, 9)), max(0, clock - rnd.choice([0, 0, rnd.randint(0, 25_000_000)])), n))
    handle, batches, at = Handle(), [], 0
    while at < len(rows):
        size = rnd.randint(1, 40)
        batches.append(rows[at : at + size])
        at += size
    out = through(stateful.SymbolWindow(WINDOW), handle, batches)
    want = simulate([("X", p, q, t, n) for p, q, t, n in rows], WINDOW.window_us, arrival=True)
    assert [r["sample_count"] for r in out] == [want["X", n][0] for _, _, _, n in rows]
    # Only slots that hold points of the window are kept.
    assert len(handle.states["slots"].data) <= -(-out[-1]["sample_count"] // slot) + 1


def test_a_batch_touches_few_slots(monkeypatch):
    monkeypatch.setattr(stateful, "SLOT", 8)
    handle, touched = Handle(), []
    processor = stateful.SymbolWindow(WindowParams(window_seconds=1000.0, mode="arrival"))
    slots = handle.getMapState("slots", "", "")
    read, slots.getValue = slots.getValue, lambda key: touched.append(key) or read(key)
    for batch in range(200):
        touched.clear()
        through(processor, handle, [[(1.0, 1.0, (batch * 10 + i) * 1_000_000, batch * 10 + i) for i in range(10)]])
        assert len(set(touched)) <= 4  # the window has about 125 slots
    assert 124 <= len(slots.data) <= 128


def test_values_of_any_size_are_exact(monkeypatch):
    monkeypatch.setattr(stateful, "SLOT", 4)
    rnd = random.Random(4)
    rows = [(rnd.uniform(1, 9) * 10.0 ** rnd.choice([-300, -15, 0, 2, 300 if n > 40 else 1]), 10.0 ** rnd.randint(-290, 4), n * 1_000_000, n) for n in range(80)]
    rows = [(1.25, 2.0, 0, -2), (2.5, 1.0, 0, -1), *rows]
    out = through(stateful.SymbolWindow(WINDOW), Handle(), [rows[:30], rows[30:35], rows[35:]])
    for i, found in enumerate(out):
        inside = [(Fraction(p), Fraction(q)) for p, q, t, _ in rows[: i + 1] if t >= rows[i][2] - WINDOW.window_us]
        n, s1 = len(inside), sum(p for p, _ in inside)
        variance = sum((p - s1 / n) ** 2 for p, _ in inside) / n
        assert found["sample_count"] == n
        assert Fraction(found["mean_price"]) == Fraction(s1 / n) or abs(Fraction(found["mean_price"]) / (s1 / n) - 1) < Fraction(1, 1 << 52)
        vwap = sum(p * q for p, q in inside) / sum(q for _, q in inside)
        assert abs(Fraction(found["vwap"]) / vwap - 1) < Fraction(1, 1 << 52)
        assert variance == 0 or abs(Fraction(found["stdev_price"]) ** 2 / variance - 1) < Fraction(1, 1 << 50)


def test_sums_leave_nothing_behind():
    sums = Sums(8, 8)
    for p, q in [(0.1, 1.0), (1e-300, 3.0), (1e300, 1e-5)]:
        if not sums.fits(p, q):
            sums = Sums(8, 8, [0, 0, 0, 0, 0], True)
    for sign in (1, -1):
        for p, q in [(0.1, 1.0), (1e-300, 3.0), (1e300, 1e-5)]:
            sums.add(p, q, sign)
    assert sums.values() == [0, 0, 0, 0, 0] and sums.stats() == (0.0, 0.0, 0.0, 0)


def test_failed_batch_is_retried_without_loss_or_duplicates(spark, tmp_path):
    rows = late_rows(60)
    run = Setup(spark, tmp_path)
    run.drain(rows[:30])

    def fails(*_):
        raise RuntimeError("sink down")

    broken = StatefulJob(run.job.sinks.__class__(run.job.sinks.processed, fails, run.job.sinks.rejects), run.job.job)
    with pytest.raises(Exception, match="sink down"):
        run.drain(rows[30:], broken)
    run.drain()
    assert run.counts() == expected(rows)


def test_rejects_and_late_ticks_are_set_aside(spark, tmp_path):
    run = Setup(spark, tmp_path, ORDERED, lateness_seconds=5.0)
    bad = spark.createDataFrame([(b"X", b"nope", "t", 0, 1, T0), (None, None, "t", 0, 2, T0)], TOPIC)
    bad.write.mode("append").parquet(run.topic)
    run.drain([("X", 1, 1, 0, 3), ("X", 2, 1, 20_000_000, 4)])
    run.drain([("X", 3, 1, 14_000_000, 5), ("X", 4, 1, 15_000_000, 6), ("X", 5, 1, 30_000_000, 7)])
    assert [c[2:] for c in run.counts()] == [(1.0, 1), (4.0, 1), (2.0, 2)]
    got = sorted(r.reject_reason for r in spark.read.parquet(f"{run.out}/rejects").collect())
    assert got == ["bad_json", "null_value", "too_late"]


def test_symbols_that_fall_silent_leave_the_state(spark, tmp_path):
    rows = [("A", 1, 1, 0, 1), ("A", 2, 1, 3_000_000, 2), ("B", 1, 1, 0, 3), ("B", 5, 1, 1_000_000, 4)]
    run = Setup(spark, tmp_path, ORDERED, lateness_seconds=60.0, idle_seconds=2.0)
    run.add(rows)
    query = run.job.start(as_arrivals(stream_topic(spark, run.topic)), run.checkpoint)
    try:
        until_idle(query, 120.0)
    finally:
        query.stop()
    assert run.counts() == expected(rows, arrival=False)


def test_idle_symbols_need_a_running_query(spark, tmp_path):
    run = Setup(spark, tmp_path, idle_seconds=2.0)
    run.add([("A", 1, 1, 0, 1)])
    with pytest.raises(ValueError, match="keeps running"):
        run.drain()


def test_other_state_stores_are_refused(spark):
    other = spark.newSession()
    with pytest.raises(ValueError, match="stateStore"):
        use_state_store(other)
    use_state_store(prepare(other))


class _Kept:
    """A state variable in memory."""

    def __init__(self):
        self.rows, self.value = {}, None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def keys(self):
        return iter(list(self.rows))

    def containsKey(self, key):  # noqa: N802
        return key in self.rows

    def getValue(self, key):  # noqa: N802
        return self.rows[key]

    def updateValue(self, key, value):  # noqa: N802
        self.rows[key] = value

    def removeKey(self, key):  # noqa: N802
        del self.rows[key]


class _Handle:
    def getValueState(self, name, *schemas):  # noqa: N802
        return _Kept()

    getMapState = getValueState  # noqa: N815


@pytest.mark.parametrize("lateness", [None, 3.0])
def test_a_large_batch_of_a_symbol_is_worked_on_in_pieces(lateness):
    n, r = 20_000, random.Random(4)
    seqs = r.sample(range(n), n)
    frame = pd.DataFrame([(2.0 + i % 7, 1.0, i * 1000, "buy" if i % 3 else None, "s", i) for i in seqs], columns=["price", "quantity", "time", "side", "source", "seq"])
    own = stateful.SymbolWindow(WINDOW if lateness is None else ORDERED, lateness)
    own.init(_Handle())
    out, most = [], 0
    for part in (frame.iloc[:11_000], frame.iloc[11_000:]) if lateness is None else (frame,):
        for got in own.handleInputRows(("X",), iter([part.iloc[:5000], part.iloc[5000:]]), None):
            most = max(most, len(own.points))
            out.append(got)
    assert max(map(len, out)) < 9000 and most <= 3
    found = pd.concat(out)
    if lateness is None:
        order = sorted(seqs[:11_000]) + sorted(seqs[11_000:])
        clock, inside, want = 0, [], {}
        for i in order:
            clock = max(clock, i * 1000)
            inside.append((clock, i))
            while inside[0][0] < clock - WINDOW.window_us:
                inside.pop(0)
            want[i] = len(inside)
    else:
        want = {i: min(i, 10_000) + 1 for i in range(n - 3000)}
    assert dict(zip(found["seq"], found["sample_count"], strict=True)) == want
    assert found["side"].isna().sum() == sum(i % 3 == 0 for i in want)
