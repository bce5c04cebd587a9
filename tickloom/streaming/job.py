"""The pipeline as a streaming query.

Every micro-batch runs the batch operators over its ticks together with the stored tail: the points
still inside each symbol's window. So the window code is the same as for batches, and a hot symbol
is cut into slices here as well instead of being one task's state.

The tail is written once per step, to a folder that carries the step's number; a step reads the
latest one before it. So a retried batch starts from the same state, with the clock of its first
attempt, and sinks replace what that attempt wrote. Offsets are committed by Spark after the batch
function returns, i.e. after every write.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom import files
from tickloom.functions.units import survey
from tickloom.operators.anomaly import anomaly_events, processed_ticks, zscore_anomaly
from tickloom.operators.quality import parse_exchange, rejects, valid_ticks
from tickloom.operators.window import arrival_clock, rolling_by_clock
from tickloom.params import ARRIVAL, FlushParams, WindowParams
from tickloom.plans.pipeline import Job, Sink, Sinks
from tickloom.session import passing_tables, spread
from tickloom.sinks.topic import keyed_values
from tickloom.sources.messages import BATCH_SPAN, numbered
from tickloom.sources.topic import unmoved

TAIL_SCHEMA = (
    "symbol string, price double, quantity double, trade_time timestamp, side string, source string, "
    "seq bigint, seen timestamp, held boolean"
)
# What a micro-batch does with a tick: use it as context, put it out, keep it back, or refuse it.
CONTEXT, EMIT, HOLD, TOO_LATE = "context", "emit", "hold", "too_late"
_COLUMNS = ["symbol", "price", "quantity", "trade_time", "side", "source", "seq", "role"]


@dataclass(frozen=True)
class WindowTail:
    """Points still in a window, between steps. Batch n is step 2n; releasing what it held is step 2n + 1."""

    folder: str

    def _tails(self, spark: SparkSession) -> list[int]:
        return [int(name.rpartition("-")[2]) for name in files.names(spark, self.folder) if name.startswith("step-")]

    def last(self, spark: SparkSession) -> int | None:
        return max(self._tails(spark), default=None)

    def before(self, spark: SparkSession, step: int) -> DataFrame:
        """The tail that ``step`` goes on from."""
        earlier = [s for s in self._tails(spark) if s < step]
        if not earlier:
            if step > 1:
                raise ValueError(f"{self.folder} holds no tail from before step {step}; the stream can't go on from it")
            return spark.createDataFrame([], TAIL_SCHEMA)
        if max(earlier) < step - 2:
            raise ValueError(f"{self.folder} ends at step {max(earlier)}; step {step} can't go on from it")
        return spark.read.schema(TAIL_SCHEMA).parquet(f"{self.folder}/step-{max(earlier):012d}")

    def keep(self, rows: DataFrame, step: int) -> None:
        """Store the tail of a step. Those that no retry can need any more are deleted."""
        spark = rows.sparkSession
        rows.write.mode("overwrite").parquet(f"{self.folder}/step-{step:012d}")
        for old in self._tails(spark):
            if old < step - 3:
                files.delete(spark, f"{self.folder}/step-{old:012d}")
                files.delete(spark, f"{self.folder}/clock-{old:012d}")

    def clock(self, spark: SparkSession, step: int) -> datetime:
        """When a step was first tried."""
        name = f"{self.folder}/clock-{step:012d}"
        if not files.exists(spark, name):
            files.write_text(spark, name, datetime.now(timezone.utc).isoformat())
        return datetime.fromisoformat(files.read_text(spark, name))


@dataclass(frozen=True)
class StreamJob:
    """What one micro-batch does.

    In ``arrival`` mode every tick is put out at once. In ``event_time`` mode a tick is held until
    its symbol has seen a tick ``lateness_seconds`` newer, ticks leave in time order, and one that
    comes even later is set aside as ``too_late``. A symbol that stays silent for ``idle_seconds`` has
    its held ticks put out, and its window freed with the batch after that. ``release`` puts out all
    that is held; ``run`` does so after it has drained its source.
    """

    sinks: Sinks
    tail: WindowTail
    job: Job = field(default_factory=Job)
    idle_seconds: float | None = None
    lateness_seconds: float | None = None

    def __post_init__(self) -> None:
        if self.idle_seconds is not None and not self.idle_seconds > 0:
            raise ValueError(f"idle_seconds must be > 0, got {self.idle_seconds!r}")
        if (self.job.window.mode == ARRIVAL) != (self.lateness_seconds is None):
            raise ValueError("lateness_seconds belongs to event_time mode, and is needed there")
        if self.lateness_seconds is not None and not self.lateness_seconds >= 0:
            raise ValueError(f"lateness_seconds must be >= 0, got {self.lateness_seconds!r}")

    def __call__(self, records: DataFrame, batch_id: int) -> None:
        """Process the records of one micro-batch: ``value`` and ``seq``, or lines of ``stream_messages``."""
        spark, step = records.sparkSession, 2 * batch_id
        now = self.tail.clock(spark, step)
        with passing_tables(spark):
            if "seq" not in records.columns:
                records = numbered(records, batch_id * BATCH_SPAN)
            if {"key", "partition"} <= set(records.columns) and not unmoved(records):
                raise ValueError("a key has records in two partitions of one batch; their order isn't known")
            # A topic of few partitions or files is read by few tasks; parsing is most of the work.
            parsed = self.job.parse(spread(records, "seq")).persist()
            try:
                self._step(parsed, step, now)
            finally:
                parsed.unpersist()

    def release(self, spark: SparkSession) -> None:
        """Put out all held ticks. A tick that comes later and is older than these is too late."""
        last = self.tail.last(spark)
        if self.job.window.mode == ARRIVAL or last is None or last % 2:
            return
        step = last + 1
        nothing = spark.createDataFrame([], "value string, seq bigint")
        with passing_tables(spark):
            self._step(self.job.parse(nothing), step, self.tail.clock(spark, step), release=True)

    def _step(self, parsed: DataFrame, step: int, now: datetime, release: bool = False) -> None:
        window = self.job.window
        before = self.tail.before(parsed.sparkSession, step)
        if window.mode == ARRIVAL:
            both = self._arrivals(before, parsed, now).persist()
        else:
            both = self._in_time_order(before, parsed, now, release).persist()
        units = survey(both, window)
        placed = arrival_clock(both, window, units.most)[0].persist() if window.mode == ARRIVAL else both
        in_window = placed.filter(F.col("role").isin(CONTEXT, EMIT))
        windowed = rolling_by_clock(in_window, _COLUMNS, window, units).filter(F.col("role") == EMIT)
        processed = processed_ticks(zscore_anomaly(windowed, self.job.anomaly)).persist()
        refused = rejects(parsed)
        if window.mode != ARRIVAL:
            late = placed.filter(F.col("role") == TOO_LATE).select(F.col("value").cast("binary"), F.col("role").alias("reject_reason"))
            refused = refused.unionByName(late)
        writes = [
            lambda: self.sinks.processed(processed, step),
            lambda: self.sinks.anomalies(anomaly_events(processed, self.job.anomaly), step),
            lambda: self.sinks.rejects(refused, step),
            lambda: self.tail.keep(self._next_tail(placed, now), step),
        ]
        try:
            # Small jobs that wait for each other's overhead more than for data: run side by side.
            with ThreadPoolExecutor(len(writes)) as pool:
                for done in [pool.submit(inheritable_thread_target(parsed.sparkSession)(write)) for write in writes]:
                    done.result()
        finally:
            for kept in (processed, placed, both):
                kept.unpersist()

    def _arrivals(self, before: DataFrame, parsed: DataFrame, now: datetime) -> DataFrame:
        """Stored points as context, new ticks to put out. A stored point keeps its clock as its time, so
        the running maximum goes on from there."""
        new = valid_ticks(parsed, "seq").withColumns({"seen": F.lit(now), "role": F.lit(EMIT)})
        return before.drop("held").withColumn("role", F.lit(CONTEXT)).unionByName(new)

    def _in_time_order(self, before: DataFrame, parsed: DataFrame, now: datetime, release: bool) -> DataFrame:
        """Ticks judged against their symbol's newest time; ``_at`` is the trade time."""
        new = valid_ticks(parsed, "seq", "value").withColumns(
            {"seen": F.lit(now), "held": F.lit(False), "_new": F.lit(True)}
        )
        both = before.withColumn("_new", F.lit(False)).unionByName(new, allowMissingColumns=True)
        both = both.withColumn("_at", F.unix_micros("trade_time"))
        lateness = round(self.lateness_seconds * 1_000_000)
        out_before = F.when(~F.col("_new") & ~F.col("held"), F.col("_at"))
        marks = both.groupBy("symbol").agg(
            (F.max("_at") - (0 if release else lateness)).alias("_mark"),
            F.greatest(F.max(F.when(~F.col("_new"), F.col("_at"))) - lateness, F.max(out_before)).alias("_mark_before"),
            F.max("seen").alias("_heard"),
        )
        ready = F.col("_at") <= F.col("_mark")
        if self.idle_seconds is not None:
            ready = ready | (F.col("_heard") < F.lit(now - timedelta(seconds=self.idle_seconds)))
        role = (
            F.when(~F.col("_new") & ~F.col("held"), CONTEXT)
            .when(F.col("_new") & (F.col("_at") < F.col("_mark_before")), TOO_LATE)
            .when(ready, EMIT)
            .otherwise(HOLD)
        )
        return both.join(marks, "symbol").withColumn("role", role).drop("_mark", "_mark_before", "_heard", "_new", "held")

    def _next_tail(self, placed: DataFrame, now: datetime) -> DataFrame:
        """Points a later tick's window can still hold, and the ticks held back."""
        out, held = F.col("role").isin(CONTEXT, EMIT), F.col("role") == HOLD
        last = placed.filter(out).groupBy("symbol").agg(
            F.max("_at").alias("_last"), F.max("seen").alias("_heard"), F.bool_and(F.col("role") == CONTEXT).alias("_quiet")
        )
        open_still = out & (F.col("_at") >= F.col("_last") - F.lit(self.job.window.window_us))
        if self.idle_seconds is not None:
            # Freed once nothing was put out for it: what an idle symbol held has left before.
            idle = F.col("_heard") < F.lit(now - timedelta(seconds=self.idle_seconds))
            open_still = open_still & ~(idle & F.col("_quiet"))
        return placed.join(last, "symbol", "left").filter(held | open_still).select(
            "symbol", "price", "quantity", F.timestamp_micros("_at").alias("trade_time"),
            "side", "source", "seq", "seen", held.alias("held"),
        )


@dataclass(frozen=True)
class IngestJob:
    """Exchange messages to topic records; malformed messages are set aside.

    The topic sink gets ``key`` and ``value`` per tick. Kafka places records by key and numbers them.
    """

    topic: Sink
    rejects: Sink

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        """Publish one micro-batch of messages (``value``)."""
        parsed = parse_exchange(messages).persist()
        try:
            self.rejects(rejects(parsed), batch_id)
            self.topic(keyed_values(valid_ticks(parsed)), batch_id)
        finally:
            parsed.unpersist()


def trigger_options(flush: FlushParams | None = None, drain: bool = False) -> dict:
    """Trigger arguments: a batch every ``flush.seconds``, or process what is there and stop.

    The row bound of ``flush`` goes to the source (``kafka_source_options``).
    """
    if drain:
        return {"availableNow": True}
    flush = flush or FlushParams()
    return {"processingTime": f"{flush.seconds} seconds"}


def start(
    records: DataFrame, stream_job: StreamJob, checkpoint: str, flush: FlushParams | None = None, drain: bool = False
) -> StreamingQuery:
    """Start the query over streaming ``records`` (``value``, ``seq``)."""
    return (
        records.writeStream.foreachBatch(stream_job)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(flush, drain))
        .start()
    )


def run(records: DataFrame, stream_job: StreamJob, checkpoint: str) -> None:
    """Process what is there, put out what is held, and stop."""
    start(records, stream_job, checkpoint, drain=True).awaitTermination()
    stream_job.release(records.sparkSession)


def publish(
    messages: DataFrame, handler, checkpoint: str, flush: FlushParams | None = None, drain: bool = False
) -> StreamingQuery:
    """Hand every micro-batch of ``messages`` to ``handler(batch, batch_id)``."""
    return start(messages, handler, checkpoint, flush, drain)
