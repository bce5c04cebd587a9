"""One runnable query per operator, over the benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import wraps

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.functions.symbols import allow_symbols, symbol_list, symbol_list_column
from tickloom.operators.anomaly import anomaly_events, anomaly_log, zscore_anomaly
from tickloom.operators.percentiles import percentiles
from tickloom.operators.quality import parse_canonical, parse_exchange, reject_counts, valid_ticks
from tickloom.operators.running import running_sum
from tickloom.operators.sketches import RANK_ERROR, merged_percentiles, minute_sketches
from tickloom.operators.snapshot import snapshot
from tickloom.operators.window import arrival_clock, exact_sums, rolling_stats
from tickloom.params import ARRIVAL, WindowParams
from tickloom.plans.pipeline import Job, process, run_batch, table_sinks
from tickloom.plans.tables import (
    canonical_messages, event_ticks, exchange_messages, order_ticks, read_table, shuffled_event_ticks,
)
from tickloom.session import materialise, prepare, scratch, spread
from tickloom.sinks.table import archive_days, drop_archived, market_ticks, stored_rows, with_iso_time, write_by_symbol, write_days
from tickloom.sinks.topic import topic_records, write_topic
from tickloom.sources.messages import read_messages
from tickloom.sources.table import anomaly_scan, range_scan, read_history
from tickloom.sources.table import read_table as read_day_table
from tickloom.sources.topic import as_arrivals, read_topic, stream_topic
from tickloom.streaming.around import around_anomalies
from tickloom.streaming.job import StreamJob, WindowTail, start
from tickloom.streaming.metrics import counts_of
from tickloom.streaming.stateful import StatefulJob, state_snapshot, until_idle

DAY, WEEK = 86_400.0, 7 * 86_400.0
EVENTS = WindowParams(window_seconds=DAY, price_scale=2, quantity_scale=0)
EVENTS_ARRIVAL = WindowParams(window_seconds=DAY, price_scale=2, quantity_scale=0, mode=ARRIVAL)
ORDERS = WindowParams(window_seconds=WEEK, price_scale=2, quantity_scale=0)
SLICE = 500
SCAN_SYMBOL = "PURCHASE"
SCAN_FROM, SCAN_TO = datetime(2024, 1, 10, 6), datetime(2024, 1, 12, 18)
SETTINGS_SYMBOLS = " purchase, view ,,Click"
#: Seconds that a stream of idle symbols is waited for.
IDLE_LIMIT = 1800.0
CHUNK_ENDS = (datetime(2024, 1, 11), datetime(2024, 1, 21))


def _flat(df: DataFrame) -> DataFrame:
    """Statistics as plain columns, instants as UTC without zone."""
    out = []
    for column in df.schema:
        if column.name == "stats":
            out += ["stats.vwap", "stats.mean_price", "stats.stdev_price", "stats.sample_count", "stats.window_seconds"]
        elif column.dataType.simpleString() == "timestamp":
            out.append(F.col(column.name).cast("timestamp_ntz").alias(column.name))
        else:
            out.append(column.name)
    return df.select(*out)


def _processed(spark: SparkSession, folder: str) -> DataFrame:
    return process(event_ticks(spark, folder), EVENTS, None, "seq")


def parse_exchange_query(spark, folder):
    return _flat(valid_ticks(parse_exchange(exchange_messages(spark, folder)), "seq"))


def landed_messages(spark, folder):
    """Messages landed as text in files of different sizes, some written side by side, read back in order of arrival and parsed."""
    path, messages = scratch(spark, "landed"), exchange_messages(spark, folder)
    edges = [F.col("seq") < 20, (F.col("seq") >= 20) & (F.col("seq") < 500), F.col("seq") >= 500]
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for step, (files, edge) in enumerate(zip((1, 2, many), edges)):
        # Part files of one write are numbered in the order of their ranges.
        chunk = messages.filter(edge).repartitionByRange(files, "seq").sortWithinPartitions("seq")
        chunk.select(F.coalesce("value", F.lit("")).alias("value")).write.text(f"{path}/step={step}")
    ticks = materialise(valid_ticks(parse_exchange(read_messages(spark, path, by_name=True)), "seq").withColumn("one", F.lit(1).cast("bigint")), "landed-ticks")
    ranked, _ = running_sum(ticks, "symbol", "seq", "one", "arrival", EVENTS.rows_per_slice)
    return _flat(ranked.withColumn("arrival", F.col("arrival").cast("bigint")).drop("seq", "one"))


def quarantine(spark, folder):
    """Rejected messages as set aside, with their arrival number."""
    parsed = parse_exchange(exchange_messages(spark, folder))
    return parsed.filter(F.col("reject_reason").isNotNull()).select("seq", "value", "reject_reason")


def parse_canonical_query(spark, folder):
    return _flat(valid_ticks(parse_canonical(canonical_messages(spark, folder)), "seq"))


def reject_counts_query(spark, folder):
    exchange = reject_counts(parse_exchange(exchange_messages(spark, folder))).withColumn("form", F.lit("exchange"))
    canonical = reject_counts(parse_canonical(canonical_messages(spark, folder))).withColumn("form", F.lit("canonical"))
    return exchange.unionByName(canonical)


def topic_records_query(spark, folder):
    """Records as published; a key has one of three partitions."""
    records = topic_records(event_ticks(spark, folder))
    value = F.col("value").cast("string")
    one = (F.min("partition") == F.max("partition")).alias("one_partition")
    places = records.groupBy(F.col("key").alias("_key")).agg(one)
    return records.join(places, records["key"].eqNullSafe(places["_key"])).select(
        records["key"].cast("string").alias("key"),
        F.get_json_object(value, "$.symbol").alias("symbol"),
        F.get_json_object(value, "$.price").cast("double").alias("price"),
        F.get_json_object(value, "$.quantity").cast("double").alias("quantity"),
        F.get_json_object(value, "$.trade_time").alias("trade_time"),
        F.get_json_object(value, "$.side").alias("side"),
        F.get_json_object(value, "$.source").alias("source"),
        "topic",
        "offset",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "one_partition",
        F.col("partition").between(0, 2).alias("known_partition"),
    )


def topic_roundtrip(spark, folder):
    path = scratch(spark, "topic")
    write_topic(topic_records(event_ticks(spark, folder)), path)
    return _flat(valid_ticks(parse_canonical(as_arrivals(read_topic(spark, path))), "seq"))


def symbol_filter(spark, folder):
    ticks = event_ticks(spark, folder)
    return _flat(allow_symbols(ticks, symbol_list(SETTINGS_SYMBOLS)))


def symbol_lists(spark, folder):
    listed = F.concat_ws(",", F.lit(" "), F.lower("o_orderpriority"), F.concat(F.lit(" "), "o_orderstatus", F.lit("\t")), F.lit(""))
    return read_table(spark, folder, "orders").select(
        "o_orderkey", F.array_join(symbol_list_column(listed), "|").alias("symbols")
    )


def rolling_stats_events(spark, folder):
    return _flat(rolling_stats(event_ticks(spark, folder), EVENTS).select("symbol", "seq", "stats"))


def rolling_stats_orders(spark, folder):
    return _flat(rolling_stats(order_ticks(spark, folder), ORDERS).select("symbol", "seq", "stats"))


def rolling_stats_short(spark, folder):
    short = WindowParams(window_seconds=3600.0, price_scale=2, quantity_scale=0)
    return _flat(rolling_stats(event_ticks(spark, folder), short).select("symbol", "seq", "stats"))


def arrival_stats(spark, folder):
    return _flat(rolling_stats(shuffled_event_ticks(spark, folder), EVENTS_ARRIVAL).select("symbol", "seq", "stats"))


def rolling_stats_large(spark, folder):
    """Prices of a million times the usual size."""
    ticks = order_ticks(spark, folder).withColumn("price", F.col("price") * 1e6)
    return _flat(rolling_stats(ticks, WindowParams(window_seconds=WEEK)).select("symbol", "seq", "stats"))


def rolling_stats_small(spark, folder):
    """Prices and quantities far below any common unit."""
    ticks = event_ticks(spark, folder).withColumns({"price": F.col("price") * 1e-10, "quantity": F.col("quantity") * 1e-9})
    return _flat(rolling_stats(ticks, WindowParams(window_seconds=DAY)).select("symbol", "seq", "stats"))


def rolling_stats_sliced(spark, folder):
    return _flat(rolling_stats(event_ticks(spark, folder), replace(EVENTS, rows_per_slice=SLICE)).select("symbol", "seq", "stats"))


def arrival_stats_sliced(spark, folder):
    return _flat(rolling_stats(shuffled_event_ticks(spark, folder), replace(EVENTS_ARRIVAL, rows_per_slice=SLICE)).select("symbol", "seq", "stats"))


def rolling_stats_by_symbol(spark, folder):
    """Over a table that is bucketed by symbol: no exchange before the window."""
    table = write_by_symbol(event_ticks(spark, folder), f"ticks_{uuid.uuid4().hex}", scratch(spark, "by-symbol"), 8)
    return _flat(rolling_stats(table, EVENTS, stored_by_symbol=True).select("symbol", "seq", "stats"))


def rolling_sums_exact(spark, folder):
    """Sums where every second price is 2^30 times as large: no common units of 15 digits hold both."""
    price = F.rint(F.col("price") * 100) * F.when(F.col("seq") % 2 == 1, float(1 << 30)).otherwise(1.0)
    return exact_sums(event_ticks(spark, folder).withColumn("price", price), EVENTS)


def zscore_query(spark, folder):
    scored = zscore_anomaly(rolling_stats(event_ticks(spark, folder), EVENTS))
    return scored.select("symbol", "seq", "zscore", "is_anomaly")


def processed_ticks_query(spark, folder):
    return _flat(_processed(spark, folder))


def anomaly_events_query(spark, folder):
    return _flat(anomaly_events(_processed(spark, folder), None, "seq"))


def anomaly_log_query(spark, folder):
    return _flat(anomaly_log(anomaly_events(_processed(spark, folder), None, "seq")))


def stored_rows_query(spark, folder):
    return with_iso_time(stored_rows(_processed(spark, folder), "seq"))


def _day_table(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "days")
    write_days(stored_rows(_processed(spark, folder), "seq"), path)
    return read_day_table(spark, path)


def stored_table(spark, folder):
    return _flat(_day_table(spark, folder))


def range_scan_query(spark, folder):
    return _flat(range_scan(_day_table(spark, folder), SCAN_SYMBOL, SCAN_FROM, SCAN_TO))


def anomaly_scan_query(spark, folder):
    return _flat(anomaly_scan(_day_table(spark, folder)))


def archived_days(spark, folder):
    """A table of three batches, of which the first days are archived and the first batch dropped, read as one with its archive."""
    path, archive = scratch(spark, "days"), scratch(spark, "archive")
    chunks = _by_time(stored_rows(_processed(spark, folder), "seq"))
    for batch, chunk in enumerate(chunks[:2]):
        write_days(chunk, path, batch)
    archive_days(spark, path, archive, CHUNK_ENDS[0].strftime("%Y-%m-%d"))
    drop_archived(spark, path, archive)
    write_days(chunks[2], path, 2)
    return _flat(read_history(spark, path, archive))


def market_ticks_query(spark, folder):
    return _flat(market_ticks(_processed(spark, folder), "seq"))


def snapshot_query(spark, folder):
    wanted = symbol_list(SETTINGS_SYMBOLS + ",ethusdt")
    return _flat(snapshot(event_ticks(spark, folder), EVENTS, wanted))


def snapshot_arrival(spark, folder):
    return _flat(snapshot(shuffled_event_ticks(spark, folder), EVENTS_ARRIVAL))


def latency_percentiles(spark, folder):
    """How late ticks arrive, behind the newest tick of their symbol, in microseconds."""
    clocked, _ = arrival_clock(shuffled_event_ticks(spark, folder), EVENTS_ARRIVAL)
    late = clocked.withColumn("late_us", F.col("_at") - F.unix_micros("trade_time"))
    return percentiles(late, "symbol", "late_us")


def percentiles_sliced(spark, folder):
    clocked, _ = arrival_clock(shuffled_event_ticks(spark, folder), replace(EVENTS_ARRIVAL, rows_per_slice=SLICE))
    late = clocked.withColumn("late_us", F.col("_at") - F.unix_micros("trade_time"))
    return percentiles(late, "symbol", "late_us", rows_per_slice=SLICE)


def latency_sketch(spark, folder):
    """Percentiles of lateness from merged sketches of a minute each, and whether their exact ranks are within the bound."""
    clocked, _ = arrival_clock(shuffled_event_ticks(spark, folder), EVENTS_ARRIVAL)
    late = materialise(clocked.select("symbol", "trade_time", (F.col("_at") - F.unix_micros("trade_time")).alias("late_us")), "late")
    sketches = materialise(minute_sketches(late, "symbol", "trade_time", "late_us"), "minute-sketches")
    wide = merged_percentiles(sketches, "symbol")
    found = wide.select("symbol", "n", F.inline(F.array(*[F.struct(F.lit(name).alias("quantile"), F.lit(q).alias("q"), F.col(name).alias("value")) for name, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))])))
    below, upto = F.count_if(F.col("late_us") < F.col("value")), F.count_if(F.col("late_us") <= F.col("value"))
    ranks = late.join(F.broadcast(found), "symbol").groupBy("symbol", "n", "quantile", "q").agg(below.alias("below"), upto.alias("upto"))
    near = (F.col("below") / F.col("n") <= F.col("q") + RANK_ERROR) & (F.col("upto") / F.col("n") >= F.col("q") - RANK_ERROR)
    return ranks.select("symbol", "n", "quantile", near.alias("within_bound"))


class _Stream:
    """A topic folder that grows step by step, and a streaming job over it that is drained after each step."""

    def __init__(self, spark: SparkSession, window: WindowParams, **options):
        self.spark = spark
        self.topic, self.out, self.checkpoint = (scratch(spark, name) for name in ("topic", "out", "checkpoint"))
        self.job = StreamJob(table_sinks(self.out), WindowTail(f"{self.checkpoint}/window-tail"), Job(window=window), **options)

    def add(self, ticks: DataFrame, job: StreamJob | None = None) -> None:
        write_topic(topic_records(ticks), self.topic)
        self.drain(job)

    def drain(self, job: StreamJob | None = None) -> None:
        records = as_arrivals(stream_topic(self.spark, self.topic))
        start(records, job or self.job, f"{self.checkpoint}/query", drain=True).awaitTermination()

    def stored(self) -> DataFrame:
        return _flat(read_day_table(self.spark, f"{self.out}/processed_ticks"))


def _spread_events(spark: SparkSession, folder: str) -> str:
    """A folder with ``events`` in many files, for queries that read it in steps: a table may be one file that one task reads."""
    stored = scratch(spark, "tables")
    spread(read_table(spark, folder, "events"), "event_id").write.parquet(f"{stored}/events.parquet")
    return stored


def _by_time(ticks: DataFrame) -> list[DataFrame]:
    at = F.col("trade_time").cast("timestamp_ntz")
    edges = [F.lit(end).cast("timestamp_ntz") for end in CHUNK_ENDS]
    return [ticks.filter(chunk) for chunk in (at < edges[0], (at >= edges[0]) & (at < edges[1]), at >= edges[1])]


def stream_processed(spark, folder):
    """Ticks in three steps, in arrival mode."""
    stream = _Stream(spark, EVENTS_ARRIVAL)
    for chunk in _by_time(event_ticks(spark, _spread_events(spark, folder))):
        stream.add(chunk)
    return stream.stored()


def stream_event_time(spark, folder):
    """Ticks out of order in three steps, put into order; what is held at the end leaves then."""
    stream = _Stream(spark, EVENTS, lateness_seconds=WEEK)
    for chunk in _by_time(shuffled_event_ticks(spark, _spread_events(spark, folder))):
        stream.add(chunk)
    stream.job.release(spark)
    return stream.stored()


def late_event_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Every third event first, then the second third, then the rest."""
    return event_ticks(spark, folder).withColumn("seq", (F.col("seq") % 3) * 1_000_000_000 + F.col("seq"))


def stream_late(spark, folder):
    """In arrival mode, steps whose ticks are older than those of earlier steps."""
    stream, ticks = _Stream(spark, EVENTS_ARRIVAL), late_event_ticks(spark, _spread_events(spark, folder))
    for third in range(3):
        stream.add(ticks.filter(F.floor(F.col("seq") / 1_000_000_000) == third))
    return stream.stored()


def stream_retry(spark, folder):
    """The sinks fail after the ticks were written; the batch runs again."""

    def fails(*_):
        raise RuntimeError("sink down")

    stream = _Stream(spark, EVENTS_ARRIVAL)
    first, second, third = _by_time(event_ticks(spark, _spread_events(spark, folder)))
    stream.add(first)
    broken = replace(stream.job, sinks=replace(stream.job.sinks, anomalies=fails))
    try:
        stream.add(second, broken)
    except StreamingQueryException as failure:
        if "sink down" not in str(failure):
            raise
    stream.drain()
    stream.add(third)
    return stream.stored()


class _Stateful:
    """A topic folder that grows step by step, and the job whose window is keyed state."""

    def __init__(self, spark: SparkSession, window: WindowParams, form: str = "canonical", **options):
        self.spark = spark
        self.topic, self.out, self.checkpoint = (scratch(spark, name) for name in ("topic", "out", "checkpoint"))
        self.job = StatefulJob(table_sinks(self.out), Job(form=form, window=window), **options)
        self.counts: list[dict[str, int]] = []

    def records(self) -> DataFrame:
        return as_arrivals(stream_topic(self.spark, self.topic))

    def add(self, ticks: DataFrame) -> None:
        write_topic(topic_records(ticks), self.topic)
        self.drain()

    def drain(self) -> None:
        query = self.job.start(self.records(), self.checkpoint, drain=True)
        query.awaitTermination()
        self.counts += counts_of(query)

    def stored(self) -> DataFrame:
        return _flat(read_day_table(self.spark, f"{self.out}/processed_ticks"))


def stream_stateful(spark, folder):
    """Ticks in three steps, each a new query on the same state: in arrival mode every tick counts when it comes."""
    stream = _Stateful(spark, EVENTS_ARRIVAL)
    for chunk in _by_time(event_ticks(spark, _spread_events(spark, folder))):
        stream.add(chunk)
    return stream.stored()


def stream_stateful_late(spark, folder):
    """In arrival mode, steps whose ticks are older than those of earlier steps."""
    stream, ticks = _Stateful(spark, EVENTS_ARRIVAL), late_event_ticks(spark, _spread_events(spark, folder))
    for third in range(3):
        stream.add(ticks.filter(F.floor(F.col("seq") / 1_000_000_000) == third))
    return stream.stored()


def snapshot_state(spark, folder):
    """Each symbol's present window as the state holds it after two steps of ticks out of order."""
    stream, ticks = _Stateful(spark, EVENTS_ARRIVAL), shuffled_event_ticks(spark, _spread_events(spark, folder))
    edge = F.lit(CHUNK_ENDS[0]).cast("timestamp_ntz")
    first = ticks.filter(F.col("trade_time").cast("timestamp_ntz") < edge).agg(F.max("seq")).first()[0] or 0
    stream.add(ticks.filter(F.col("seq") <= first))
    stream.add(ticks.filter(F.col("seq") > first))
    return _flat(state_snapshot(spark, stream.checkpoint, EVENTS_ARRIVAL))


def stream_idle(spark, folder):
    """Ticks held for a week of newer ones; when their symbol falls silent a timer puts out the rest and frees the state."""
    stream = _Stateful(spark, EVENTS, lateness_seconds=WEEK, idle_seconds=5.0)
    write_topic(topic_records(shuffled_event_ticks(spark, folder)), stream.topic)
    query = stream.job.start(stream.records(), stream.checkpoint)
    try:
        until_idle(query, IDLE_LIMIT)
    finally:
        query.stop()
    return stream.stored()


def stream_watermark(spark, folder):
    """Ticks in time order behind a watermark of a week, in three steps; the last week is still held."""
    stream = _Stateful(spark, EVENTS, lateness_seconds=WEEK, watermark=True)
    for chunk in _by_time(shuffled_event_ticks(spark, _spread_events(spark, folder))):
        stream.add(chunk)
    return stream.stored()


def stream_counts(spark, folder):
    """A stream that holds malformed messages: what its batches counted while they ran, in sum, by reason."""
    stream = _Stateful(spark, EVENTS_ARRIVAL)
    messages = canonical_messages(spark, folder).select(
        F.lit(None).cast("binary").alias("key"), "value", F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("seq").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )
    for third in range(3):
        write_topic(messages.filter(F.col("offset") % 3 == third), stream.topic)
        stream.drain()
    totals: dict[str, int] = {}
    for counts in stream.counts:
        for name, n in counts.items():
            if name != "batch" and n:
                totals[name] = totals.get(name, 0) + n
    return spark.createDataFrame(list(totals.items()), "outcome string, messages bigint")


def stream_around(spark, folder):
    """Two streams, anomaly events and ticks, joined over an hour before to half an hour after, in three steps."""
    ticks, events = scratch(spark, "ticks"), scratch(spark, "events")
    out, checkpoint = scratch(spark, "around"), scratch(spark, "checkpoint")
    processed = materialise(_processed(spark, folder), "around-ticks")
    shapes = processed.schema, anomaly_events(processed, None, "seq").schema
    for chunk in _by_time(processed):
        chunk.write.mode("append").parquet(ticks)
        anomaly_events(chunk, None, "seq").write.mode("append").parquet(events)
        left, right = (spark.readStream.schema(shape).parquet(path) for shape, path in zip(shapes[::-1], (events, ticks)))
        met = around_anomalies(left, right.select("symbol", "price", "quantity", "trade_time", "seq"), 3600.0, 1800.0, DAY, "seq")
        query = met.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
        query.awaitTermination()
    return _flat(spark.read.parquet(out))


def batch_outputs(spark, folder):
    """The batch job over canonical messages: ticks, anomaly events and rejects as read back."""
    out = scratch(spark, "outputs")
    run_batch(canonical_messages(spark, folder), table_sinks(out), 1, Job(window=EVENTS))
    empty = F.lit(None)

    def shaped(rows: DataFrame, kind: str, name: Column, at: Column, price: Column, z: Column) -> DataFrame:
        at = at.cast("timestamp").cast("timestamp_ntz")
        return rows.select(F.lit(kind).alias("kind"), name.alias("name"), at.alias("at"), price.cast("double").alias("price"), z.cast("double").alias("z"))

    ticks, events, refused = (read_day_table(spark, f"{out}/{name}") for name in ("processed_ticks", "anomaly_events", "rejects"))
    counts = refused.groupBy("reject_reason").count()
    return (
        shaped(ticks, "tick", F.col("symbol"), F.col("trade_time"), F.col("price"), F.col("anomaly_zscore"))
        .union(shaped(events, "event", F.col("symbol"), F.col("timestamp"), F.col("triggering_price"), F.col("deviation_zscore")))
        .union(shaped(counts, "reject", F.col("reject_reason"), empty, F.col("count"), empty))
    )


def _prepared(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(prepare(spark), folder)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: _prepared(query)
    for name, query in {
        "parse_exchange": parse_exchange_query,
        "parse_canonical": parse_canonical_query,
        "landed_messages": landed_messages,
        "quarantine": quarantine,
        "reject_counts": reject_counts_query,
        "topic_records": topic_records_query,
        "topic_roundtrip": topic_roundtrip,
        "symbol_filter": symbol_filter,
        "symbol_lists": symbol_lists,
        "rolling_stats_events": rolling_stats_events,
        "rolling_stats_short": rolling_stats_short,
        "rolling_stats_orders": rolling_stats_orders,
        "rolling_stats_large": rolling_stats_large,
        "rolling_stats_small": rolling_stats_small,
        "rolling_stats_sliced": rolling_stats_sliced,
        "arrival_stats": arrival_stats,
        "arrival_stats_sliced": arrival_stats_sliced,
        "rolling_stats_by_symbol": rolling_stats_by_symbol,
        "rolling_sums_exact": rolling_sums_exact,
        "zscore": zscore_query,
        "processed_ticks": processed_ticks_query,
        "anomaly_events": anomaly_events_query,
        "anomaly_log": anomaly_log_query,
        "stored_rows": stored_rows_query,
        "stored_table": stored_table,
        "range_scan": range_scan_query,
        "anomaly_scan": anomaly_scan_query,
        "archived_days": archived_days,
        "market_ticks": market_ticks_query,
        "snapshot": snapshot_query,
        "snapshot_arrival": snapshot_arrival,
        "latency_percentiles": latency_percentiles,
        "percentiles_sliced": percentiles_sliced,
        "stream_processed": stream_processed,
        "stream_event_time": stream_event_time,
        "stream_late": stream_late,
        "stream_retry": stream_retry,
        "batch_outputs": batch_outputs,
        "latency_sketch": latency_sketch,
        "stream_stateful": stream_stateful,
        "stream_stateful_late": stream_stateful_late,
        "snapshot_state": snapshot_state,
        "stream_idle": stream_idle,
        "stream_watermark": stream_watermark,
        "stream_counts": stream_counts,
        "stream_around": stream_around,
    }.items()
}
