"""Ticks as topic records keyed by symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.instants import iso_text
from tickloom.params import DEFAULT_SERVERS, DEFAULT_TOPIC, FlushParams

PARTITIONS = 3


def tick_json(zone: str = "Z") -> Column:
    """A tick as JSON text with its time in ISO-8601."""
    return F.to_json(
        F.struct(
            "symbol", "price", "quantity", iso_text(F.col("trade_time"), zone).alias("trade_time"), "side", "source"
        )
    )


def _key() -> Column:
    return F.when(F.col("symbol") != "", F.col("symbol").cast("binary")).alias("key")


def keyed_values(ticks: DataFrame) -> DataFrame:
    """What a Kafka sink needs: key (null for an empty symbol) and JSON value."""
    return ticks.select(_key(), tick_json().cast("binary").alias("value"))


def topic_records(ticks: DataFrame, topic: str = DEFAULT_TOPIC, partitions: int = PARTITIONS) -> DataFrame:
    """Key (null for an empty symbol), JSON value, and the place in the topic.

    The partition depends on the symbol alone and ``seq`` serves as the offset, so a symbol's
    records stay in order without any shuffle.
    """
    return ticks.select(
        _key(),
        tick_json().cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.hash("symbol"), F.lit(partitions)).alias("partition"),
        F.col("seq").alias("offset"),
        F.col("trade_time").alias("timestamp"),
    )


def write_topic(records: DataFrame, path: str, flush: FlushParams | None = None) -> None:
    """Append records to a folder in topic shape; with ``flush``, in files of at most its number of records (see ``stream_topic``)."""
    writer = records.write.mode("append")
    if flush is not None:
        writer = writer.option("maxRecordsPerFile", flush.rows)
    writer.parquet(path)


def kafka_sink_options(servers: str = DEFAULT_SERVERS, topic: str = DEFAULT_TOPIC) -> dict[str, str]:
    # Full acknowledgement, idempotent sends, 20 ms of batching.
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
        "kafka.linger.ms": "20",
    }


def write_kafka(records: DataFrame, **options) -> None:
    """Needs the Kafka connector on the class path; Kafka places records by key."""
    records.select("key", "value").write.format("kafka").options(**kafka_sink_options(**options)).save()
