"""The window as keyed state in Spark's state store.

Each symbol keeps its clock, the exact sums over its window, and the points that are still inside it, in slots
of ``SLOT`` points. A micro-batch adds its ticks to the newest slots and takes what leaves the window from the
oldest ones; the slots between are not touched. So a batch costs what it brings and what it lets go, however
long the window is, and Spark keeps, versions and restores the state.

A symbol's ticks of one micro-batch are one task's work, in order: it holds them as arrays (48 bytes a tick), and works and
puts out ``CHUNK`` at a time; full slots go to the state as they fill. The trigger bounds how many ticks those are (see
``FlushParams.rows``); where that isn't enough, ``job.StreamJob`` cuts a hot symbol's batch into slices.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tickloom.functions.exact import STATS as _STATS, Sums
from tickloom.operators.anomaly import anomaly_events, processed_ticks, zscore_anomaly
from tickloom.operators.quality import valid_ticks
from tickloom.params import ARRIVAL, FlushParams, WindowParams
from tickloom.plans.pipeline import Job, Sinks
from tickloom.streaming.job import trigger_options
from tickloom.streaming.metrics import EMIT, REJECT, TOO_LATE, observed

#: Points of a slot, and slots of time that held ticks are kept in over their lateness.
SLOT, HELD_SLOTS = 512, 32
#: Ticks that are Python objects at a time.
CHUNK = 8192
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

POINT = np.dtype([("at", "<i8"), ("price", "<f8"), ("quantity", "<f8")])
ARRAYS = np.dtype([("price", "<f8"), ("quantity", "<f8"), ("time", "<i8"), ("seq", "<i8"), ("side", "<i4"), ("source", "<i4")])
_TICK = ["price", "quantity", "time", "side", "source", "seq"]
_OUT = (
    "symbol string, price double, quantity double, time bigint, side string, source string, seq bigint, "
    "role string, vwap double, mean_price double, stdev_price double, sample_count bigint"
)


class _Ticks:
    """A symbol's ticks of a micro-batch. ``side`` and ``source`` are places among their different values."""

    def __init__(self, rows: Iterator[pd.DataFrame]) -> None:
        self.places: dict[str | None, int] = {}
        self.found = np.concatenate([np.zeros(0, ARRAYS), *map(self._arrays, rows)])
        self.time = self.found["time"]
        self.values = list(self.places)
        self.order = np.argsort(self.found["seq"], kind="stable")

    def _arrays(self, frame: pd.DataFrame) -> np.ndarray:
        out = np.zeros(len(frame), ARRAYS)
        for name in ("price", "quantity", "time", "seq"):
            out[name] = frame[name].to_numpy()
        for name in ("side", "source"):
            values = [None if pd.isna(v) else v for v in frame[name]]
            out[name] = [self.places.setdefault(v, len(self.places)) for v in values]
        return out

    def chunks(self, which: np.ndarray) -> Iterator[list[tuple]]:
        """The ticks at these places, as rows of ``_TICK``."""
        for start in range(0, len(which), CHUNK):
            part = self.found[which[start : start + CHUNK]].tolist()
            yield [(p, q, t, self.values[side], self.values[source], seq) for p, q, t, seq, side, source in part]


@dataclass(frozen=True)
class _Held:
    """Ticks that wait, by slots of time, as JSON rows."""

    state: object
    width: int

    def add(self, ticks: _Ticks, which: np.ndarray) -> None:
        slots = ticks.time[which] // self.width
        which = which[np.argsort(slots, kind="stable")]
        found, counts = np.unique(slots, return_counts=True)
        for slot, own in zip(found.tolist(), np.split(which, np.cumsum(counts)[:-1]), strict=False):
            rows = [row for chunk in ticks.chunks(own) for row in chunk]
            if self.state.containsKey((slot,)):
                rows = json.loads(self.state.getValue((slot,))[0]) + rows
            self.state.updateValue((slot,), (json.dumps(rows),))

    def take(self, upto: int | None) -> Iterator[list[tuple]]:
        """Ticks with a time up to ``upto`` (all, if None), in order, some at a time; they are no longer held."""
        for slot in sorted(slot for (slot,) in self.state.keys()):
            if upto is not None and slot * self.width > upto:
                break
            rows = [tuple(r) for r in json.loads(self.state.getValue((slot,))[0])]
            stay = [r for r in rows if upto is not None and r[2] > upto]
            if stay:
                self.state.updateValue((slot,), (json.dumps(stay),))
            else:
                self.state.removeKey((slot,))
            out = sorted((r for r in rows if upto is None or r[2] <= upto), key=lambda r: (r[2], r[5]))
            for start in range(0, len(out), CHUNK):
                yield out[start : start + CHUNK]

    def first(self) -> int | None:
        """The earliest time that is held."""
        slots = [slot for (slot,) in self.state.keys()]
        return min(row[2] for row in json.loads(self.state.getValue((min(slots),))[0])) if slots else None


class SymbolWindow(StatefulProcessor):
    """One symbol's window. Without ``lateness_seconds`` every tick counts when it arrives; with it, ticks wait until
    their symbol has seen one that much newer, leave in time order, and later ones are ``too_late``. A symbol that is silent for
    ``idle_seconds`` of processing time has what it holds put out and its state removed, by a timer: no tick of its own is needed."""

    def __init__(self, window: WindowParams, lateness_seconds: float | None = None, idle_seconds: float | None = None) -> None:
        self.window = window
        self.lateness = None if lateness_seconds is None else round(lateness_seconds * 1_000_000)
        self.idle_ms = None if idle_seconds is None else max(1, round(idle_seconds * 1000))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # newest: largest time seen; out: clock of the last tick put out; first, gone: oldest slot and points that have left it;
        # last, size: newest slot and its points; timer: when the symbol counts as idle.
        self.totals = handle.getValueState(
            "totals", "newest bigint, out bigint, first bigint, gone bigint, last bigint, size bigint, timer bigint, fine boolean, sums array<string>"
        )
        self.slots = handle.getMapState("slots", "slot bigint", "points binary")
        self.held = _Held(handle.getMapState("held", "slot bigint", "ticks string"), max(1, (self.lateness or 0) // HELD_SLOTS))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self._load()
        ticks = _Ticks(rows)
        late, ready = ticks.order[:0], ticks.chunks(ticks.order)
        if self.lateness is not None:
            bound = None if self.newest is None else max(self.newest - self.lateness, self.out if self.out is not None else self.newest - self.lateness)
            behind = np.zeros(len(ticks.order), bool) if bound is None else ticks.time[ticks.order] < bound
            late = ticks.order[behind]
            self.newest = max([int(ticks.time.max())] + ([] if self.newest is None else [self.newest]))
            self.held.add(ticks, ticks.order[~behind])
            ready = self.held.take(self.newest - self.lateness)
        for chunk in ready:
            yield self._frame(self._advance(key[0], chunk))
        yield from self._refused(key[0], ticks, late)
        if self.idle_ms is not None:
            if self.timer is not None:
                self.handle.deleteTimer(self.timer)
            self.timer = timerValues.getCurrentProcessingTimeInMs() + self.idle_ms
            self.handle.registerTimer(self.timer)
        self._store()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self._load()
        if self.lateness is not None:
            for chunk in self.held.take(None):
                yield self._frame(self._advance(key[0], chunk))
        self.totals.clear()
        self.slots.clear()

    def close(self) -> None:
        pass

    def _refused(self, symbol: str, ticks: _Ticks, late: np.ndarray) -> Iterator[pd.DataFrame]:
        for chunk in ticks.chunks(late):
            yield self._frame([(symbol, *t, TOO_LATE, None, None, None, None) for t in chunk])

    def _load(self) -> None:
        self.points: dict[int, np.ndarray] = {}
        self.changed: set[int] = set()
        scales = self.window.price_scale, self.window.quantity_scale
        if not self.totals.exists():
            self.newest = self.out = self.timer = None
            self.first = self.gone = self.last = self.size = 0
            self.sums = Sums(*scales)
            return
        self.newest, self.out, self.first, self.gone, self.last, self.size, self.timer, fine, sums = self.totals.get()
        self.sums = Sums(*scales, [int(x) for x in sums], fine)

    def _store(self) -> None:
        self._keep(self.last + 1)
        sums = [str(x) for x in self.sums.values()]
        self.totals.update((self.newest, self.out, self.first, self.gone, self.last, self.size, self.timer, self.sums.fine, sums))

    def _keep(self, end: int) -> None:
        """Write the changed slots before ``end`` that haven't left, and hold none but the other changed ones and the oldest."""
        for slot in sorted(self.changed):
            if self.first <= slot < end:
                self.slots.updateValue((slot,), (self.points[slot].tobytes(),))
        self.changed = {slot for slot in self.changed if slot >= max(end, self.first)}
        self.points = {slot: points for slot, points in self.points.items() if slot in self.changed or slot == self.first}

    def _slot(self, slot: int) -> np.ndarray:
        if slot not in self.points:
            self.points[slot] = np.frombuffer(self.slots.getValue((slot,))[0], POINT)
        return self.points[slot]

    def _advance(self, symbol: str, ticks: list[tuple]) -> list[tuple]:
        """Ticks in order with the statistics of their windows; their points are kept."""
        out, new = [], []
        stored = (self.last - self.first) * SLOT + self.size - self.gone
        taken = 0  # points that have left, first of those stored, then of the new ones
        for price, quantity, time, side, source, seq in ticks:
            self.out = time if self.out is None else max(self.out, time)
            new.append((self.out, price, quantity))
            if not self.sums.fits(price, quantity):
                self._refine(new[max(0, taken - stored) : -1], min(taken, stored), stored)
            self.sums.add(price, quantity)
            while True:
                at, p, q = self._point(taken) if taken < stored else new[taken - stored]
                if at >= self.out - self.window.window_us:
                    break
                self.sums.add(p, q, -1)
                taken += 1
            out.append((symbol, price, quantity, time, side, source, seq, EMIT, *self.sums.stats()))
        self._append(new, stored, taken)
        self._keep(self.last)
        return out

    def _point(self, number: int) -> tuple[int, float, float]:
        """One of the stored points, counted from the oldest."""
        slot, place = divmod(self.gone + number, SLOT)
        at, price, quantity = self._slot(self.first + slot)[place].item()
        return at, price, quantity

    def _refine(self, new: list[tuple], taken: int, stored: int) -> None:
        """Count all points of the window anew, in the finest units."""
        sums = Sums(self.window.price_scale, self.window.quantity_scale, fine=True)
        for _, price, quantity in chain((self._point(i) for i in range(taken, stored)), new):
            sums.add(price, quantity)
        self.sums = sums

    def _append(self, new: list[tuple], stored: int, taken: int) -> None:
        """Keep the new points, behind the stored ones, and let go of what has left the window."""
        fresh = np.array(new, dtype=POINT)
        while len(fresh):
            if self.size == SLOT:
                self.last, self.size = self.last + 1, 0
            room = SLOT - self.size
            before = self._slot(self.last) if self.size else np.zeros(0, POINT)
            self.points[self.last] = np.concatenate([before, fresh[:room]])
            self.changed.add(self.last)
            self.size, fresh = len(self.points[self.last]), fresh[room:]
        first, gone = self.first, self.gone + taken
        self.first, self.gone = first + gone // SLOT, gone % SLOT
        for slot in range(first, min(self.first, self.last + 1)):
            if self.slots.containsKey((slot,)):
                self.slots.removeKey((slot,))
        if self.first > self.last:  # the newest slot is full, and all of it has left
            self.last, self.size = self.first, 0

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["symbol", *_TICK, "role", *_STATS]).astype({"sample_count": "Int64"})


class WatermarkWindow(SymbolWindow):
    """One symbol's window by the query's watermark: ticks wait until it has reached them, leave in time order by event-time
    timers, and those that arrive behind it are ``too_late``."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self._load()
        reached = timerValues.getCurrentWatermarkInMs() * 1000
        ticks = _Ticks(rows)
        behind = ticks.time[ticks.order] < reached
        self.held.add(ticks, ticks.order[~behind])
        yield from self._release(key[0], reached)
        yield from self._refused(key[0], ticks, ticks.order[behind])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self._load()
        self.timer = None
        yield from self._release(key[0], timerValues.getCurrentWatermarkInMs() * 1000)

    def _release(self, symbol: str, reached: int) -> Iterator[pd.DataFrame]:
        for chunk in self.held.take(reached):
            yield self._frame(self._advance(symbol, chunk))
        first = self.held.first()
        due = None if first is None else -(-first // 1000)
        if due != self.timer:
            if self.timer is not None:
                self.handle.deleteTimer(self.timer)
            if due is not None:
                self.handle.registerTimer(due)
            self.timer = due
        self._store()


def use_state_store(spark: SparkSession) -> None:
    """Keyed state needs the RocksDB state store, a setting of the session; a session that has chosen otherwise is refused."""
    if spark.conf.get(PROVIDER) != ROCKSDB:
        raise ValueError(f"set {PROVIDER} to {ROCKSDB} (tickloom.session.prepare does)")


def stateful_stats(
    ticks: DataFrame, window: WindowParams, lateness_seconds: float | None = None, idle_seconds: float | None = None, watermark: bool = False
) -> DataFrame:
    """Streaming ticks (symbol, price, quantity, trade_time, side, source, seq) with ``role`` and, where it is ``emit``, ``stats``.

    ``arrival`` mode takes every tick as it comes. In ``event_time`` mode ticks wait: for one of their symbol that is ``lateness_seconds``
    newer or, with ``watermark``, for the query's watermark of that delay, which all symbols share.
    """
    if (window.mode == ARRIVAL) != (lateness_seconds is None):
        raise ValueError("lateness_seconds belongs to event_time mode, and is needed there")
    if watermark and (lateness_seconds is None or idle_seconds is not None):
        raise ValueError("a watermark needs lateness_seconds, and has no idle_seconds: it passes silent symbols by itself")
    use_state_store(ticks.sparkSession)
    if watermark:
        ticks = ticks.withWatermark("trade_time", f"{round(lateness_seconds * 1000)} milliseconds")
    # Without the watermarked column itself: Spark would drop late rows before the operator could set them aside.
    timed = ticks.select("symbol", "price", "quantity", F.unix_micros("trade_time").alias("time"), "side", "source", "seq")
    kind = WatermarkWindow if watermark else SymbolWindow
    mode = "EventTime" if watermark else "None" if idle_seconds is None else "ProcessingTime"
    found = timed.groupBy("symbol").transformWithStateInPandas(kind(window, lateness_seconds, idle_seconds), _OUT, "Append", mode)
    stats = F.when(F.col("role") == EMIT, F.struct(*_STATS, F.lit(float(window.window_seconds)).alias("window_seconds")))
    return found.select(
        "symbol", "price", "quantity", F.timestamp_micros("time").alias("trade_time"), "side", "source", "seq", "role", stats.alias("stats")
    )


def state_snapshot(spark: SparkSession, checkpoint: str, window: WindowParams) -> DataFrame:
    """symbol, stats: each symbol's present window, from the state that a query with this checkpoint has committed. No tick is read."""
    totals = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "totals").load()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sums = [Sums(window.price_scale, window.quantity_scale, [int(x) for x in s], f) for s, f in zip(frame["sums"], frame["fine"], strict=True)]
            yield pd.DataFrame([(name, *s.stats()) for name, s in zip(frame["symbol"], sums, strict=True)], columns=["symbol", *_STATS])

    found = totals.select("key.symbol", "value.sums", "value.fine")
    found = found.mapInPandas(run, "symbol string, vwap double, mean_price double, stdev_price double, sample_count bigint")
    return found.select("symbol", F.struct(*_STATS, F.lit(float(window.window_seconds)).alias("window_seconds")).alias("stats"))


def until_idle(query: StreamingQuery, seconds: float) -> None:
    """Wait until a running query with timers has taken ticks and its state is empty again, but no longer than that many seconds.

    (``processAllAvailable`` doesn't return from a query with processing-time timers: there is always another batch.)
    """
    ends, filled = time.monotonic() + seconds, False
    while time.monotonic() < ends:
        if not query.isActive:
            raise query.exception() or RuntimeError("the query has stopped")
        for progress in query.recentProgress:
            rows = [state["numRowsTotal"] for state in progress["stateOperators"]]
            filled = filled or sum(rows) > 0 or progress["numInputRows"] > 0
        if filled and query.lastProgress["batchId"] > 0 and not sum(state["numRowsTotal"] for state in query.lastProgress["stateOperators"]):
            return
        time.sleep(0.2)
    raise TimeoutError(f"the state isn't empty after {seconds} s")


@dataclass(frozen=True)
class StatefulJob:
    """The pipeline with its window in Spark's state store. The sinks get each micro-batch with its number, so that a
    retried one replaces what its first attempt wrote; rejected messages and ticks that came too late go to ``rejects``.
    What each batch did is counted in the same pass (see ``metrics``)."""

    sinks: Sinks
    job: Job
    lateness_seconds: float | None = None
    idle_seconds: float | None = None
    watermark: bool = False

    def rows(self, records: DataFrame) -> DataFrame:
        """All that comes out, by ``role``: ticks with statistics, ticks too late, and rejects with value and reason."""
        parsed = self.job.parse(records)
        ticks = stateful_stats(valid_ticks(parsed, "seq"), self.job.window, self.lateness_seconds, self.idle_seconds, self.watermark)
        refused = parsed.filter(F.col("reject_reason").isNotNull())
        refused = refused.select(F.col("value").cast("binary").alias("value"), "reject_reason", F.lit(REJECT).alias("role"))
        return observed(ticks.unionByName(refused, allowMissingColumns=True))

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            processed = processed_ticks(zscore_anomaly(rows.filter(F.col("role") == EMIT), self.job.anomaly))
            self.sinks.processed(processed, batch_id)
            self.sinks.anomalies(anomaly_events(processed, self.job.anomaly), batch_id)
            late = F.to_json(F.struct("symbol", "price", "quantity", "trade_time", "side", "source")).cast("binary")
            refused = rows.filter(F.col("role") != EMIT).select(
                F.when(F.col("role") == REJECT, F.col("value")).otherwise(late).alias("value"),
                F.coalesce("reject_reason", "role").alias("reject_reason"),
            )
            self.sinks.rejects(refused, batch_id)
        finally:
            rows.unpersist()

    def start(self, records: DataFrame, checkpoint: str, flush: FlushParams | None = None, drain: bool = False) -> StreamingQuery:
        """Start the query over streaming ``records`` (``value``, ``seq``). Idle symbols need a query that keeps running."""
        if drain and self.idle_seconds is not None:
            raise ValueError("timers need a query that keeps running; drain without idle_seconds")
        writer = self.rows(records).writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
        return writer.trigger(**trigger_options(flush, drain)).start()
