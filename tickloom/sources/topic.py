"""Topic records in Spark's Kafka row shape, from Kafka or from a folder of such rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.params import DEFAULT_GROUP, DEFAULT_SERVERS, DEFAULT_TOPIC, FlushParams
from tickloom.schema import TOPIC
from tickloom.session import materialise


def kafka_source_options(
    servers: str = DEFAULT_SERVERS, topic: str = DEFAULT_TOPIC, group: str = DEFAULT_GROUP,
    starting: str = "latest", flush: FlushParams | None = None,
) -> dict[str, str]:
    """Start position, group and the row bound of a batch; progress lives in the query's checkpoint."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "groupIdPrefix": group,
        "startingOffsets": starting,
        "maxOffsetsPerTrigger": str((flush or FlushParams()).rows),
    }


def stream_kafka(spark: SparkSession, **options) -> DataFrame:
    """Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_source_options(**options)).load()


def read_topic(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOPIC).parquet(path)


def stream_topic(
    spark: SparkSession, path: str, max_files: int | None = None, starting: str | dict[int, int] = "earliest", flush: FlushParams | None = None
) -> DataFrame:
    """Records of a topic folder as a stream.

    starting: ``earliest``, ``latest`` (what is published after this call; the query's checkpoint keeps no start position, so hand a
    restarted query the same ``positions``), or the first offset of each partition. flush: a micro-batch takes one file, which
    ``write_topic(..., flush)`` has bounded to that many records.
    """
    reader = spark.readStream.schema(TOPIC)
    if flush is not None:
        max_files = 1
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    records = reader.parquet(path)
    if starting == "earliest":
        return records
    first = positions(spark, path) if starting == "latest" else starting
    if not isinstance(first, dict):
        raise ValueError(f"starting must be 'earliest', 'latest' or offsets by partition, got {starting!r}")
    before = F.lit(False)
    for partition, offset in first.items():
        before = before | ((F.col("partition") == int(partition)) & (F.col("offset") < int(offset)))
    return records.filter(~before)


def positions(spark: SparkSession, path: str) -> dict[int, int]:
    """The offset behind the last record of each partition of a topic folder, of which there are few."""
    ends = read_topic(spark, path).groupBy("partition").agg((F.max("offset") + 1).alias("end"))
    return {r["partition"]: r["end"] for r in ends.collect()}


def as_arrivals(records: DataFrame) -> DataFrame:
    """Records with ``seq``, their order of arrival by key.

    A key has one partition at a time, whose offsets count up. Where a key has moved to another one (the
    topic was given more partitions), the partition it was seen in first comes first. A streaming query
    numbers each micro-batch by offset alone and refuses a key that moves within it (see ``unmoved``).
    """
    if records.isStreaming:
        return records.withColumn("seq", F.col("offset"))
    if unmoved(records):
        return records.withColumn("seq", F.col("offset"))
    places = records.groupBy("key", "partition").agg(F.min("timestamp").alias("_since"), F.max("offset").alias("_last"))
    shift = "sum(_last + 1) over (partition by key order by _since, partition) - _last - 1 as _shift"
    places = materialise(places.selectExpr("key as _key", "partition as _partition", shift), "topic-places")
    same = records["key"].eqNullSafe(places["_key"]) & (records["partition"] == places["_partition"])
    return records.join(places, same).withColumn("seq", F.col("offset") + F.col("_shift")).drop("_key", "_partition", "_shift")


def unmoved(records: DataFrame) -> bool:
    """Whether every key has one partition."""
    places = records.groupBy("key").agg(F.min("partition").alias("low"), F.max("partition").alias("high"))
    return places.filter("low <> high and key is not null").isEmpty()
