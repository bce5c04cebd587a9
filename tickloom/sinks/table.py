"""Table shapes of processed ticks, and writing them by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom import files
from tickloom.functions.instants import day_key, iso_text
from tickloom.sources.table import BATCH, archived_days, batches_of, read_batches

#: Partition columns of the day table.
DAYS = ("partition_key", "is_anomaly")


def stored_rows(processed: DataFrame, *keep: str) -> DataFrame:
    """STORED rows: statistics flattened, flag as 0/1, day key added."""
    return processed.select(
        "symbol", "price", "quantity", "trade_time", "side",
        "stats.vwap", "stats.mean_price", "stats.stdev_price", "stats.sample_count",
        F.col("is_anomaly").cast("int").alias("is_anomaly"),
        "anomaly_zscore",
        day_key(F.col("trade_time")).alias("partition_key"),
        *keep,
    )


def with_iso_time(stored: DataFrame) -> DataFrame:
    """Stored rows with ``trade_time`` as ISO-8601 text."""
    return stored.withColumn("trade_time", iso_text(F.col("trade_time"), "+00:00"))


def market_ticks(processed: DataFrame, *keep: str) -> DataFrame:
    """The wide nine-column shape."""
    return processed.select(
        F.col("trade_time").alias("timestamp"), "symbol", "price", "quantity",
        F.col("stats.vwap").alias("rolling_vwap"),
        F.col("stats.mean_price").alias("rolling_mean"),
        F.col("stats.stdev_price").alias("rolling_std"),
        "is_anomaly",
        F.col("anomaly_zscore").alias("z_score"),
        *keep,
    )


def write_days(rows: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Append rows to a table partitioned by day and anomaly flag.

    REBALANCE lets Spark size the files: small days share a task and a day holding much of the
    data is split over many. With ``batch_id`` the rows replace whatever an earlier attempt of the
    same batch wrote, so a retried batch leaves no duplicates. A table has either batches or not.
    """
    sized = _sized(rows)
    if batch_id is None:
        sized.write.mode("append").partitionBy(*DAYS).parquet(path)
    else:
        sized.write.mode("overwrite").partitionBy(*DAYS).parquet(f"{path}/{batch_folder(batch_id)}")


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch to a table, replacing an earlier attempt."""
    rows.write.mode("overwrite").parquet(f"{path}/{batch_folder(batch_id)}")


def batch_folder(batch_id: int) -> str:
    """Each batch has a folder of its own, which Spark's committer fills or replaces as a whole; its number is a partition column."""
    return f"{BATCH}={batch_id}"


def _sized(rows: DataFrame) -> DataFrame:
    return rows.hint("rebalance", *DAYS).sortWithinPartitions(*DAYS, "symbol", "trade_time")


def archive_days(spark: SparkSession, path: str, archive: str, before_day: str) -> None:
    """Copy the days before ``before_day`` (text, like the day key) that are not archived yet to ``archive``, in few large files.

    The table stays as it is, so its readers see every row throughout. Each call writes one folder, which counts once Spark
    has committed it, and notes up to which batch its days go: ticks that come for them later are read from the
    table (``sources.table.read_history``). ``drop_archived`` removes what the archive holds, when no reader needs it any more.
    """
    known, batches = archived_days(spark, archive), batches_of(spark, path)
    if not batches:
        return
    rows = read_batches(spark, path, batches).filter((F.col("partition_key") < before_day) & ~F.col("partition_key").isin(*known))
    number = 1 + max((int(name.partition("=")[2]) for name in files.names(spark, archive) if name.startswith("archived=")), default=0)
    writer = _sized(rows.drop(BATCH).withColumn("upto", F.lit(batches[-1]))).write.mode("overwrite")
    writer.partitionBy("upto", *DAYS).parquet(f"{archive}/archived={number}")


def drop_archived(spark: SparkSession, path: str, archive: str) -> list[int]:
    """Delete the batches of a table whose rows are all in the archive; returns their numbers."""
    known, gone = archived_days(spark, archive), []
    for batch in batches_of(spark, path):
        folder = f"{path}/{batch_folder(batch)}"
        days = [name.partition("=")[2] for name in files.names(spark, folder) if name.startswith("partition_key=")]
        if all(known.get(day, -1) >= batch for day in days):
            files.delete(spark, folder)
            gone.append(batch)
    return gone


def write_by_symbol(ticks: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Ticks as a table bucketed by symbol, in time order within each file; returns a read of it.

    ``path`` holds the files. A window over the table needs no exchange (``rolling_stats(..., stored_by_symbol=True)``).
    """
    by = ["symbol", "trade_time", "seq"]
    placed = ticks.repartition(buckets, "symbol")
    placed.write.bucketBy(buckets, "symbol").sortBy(*by).option("path", path).mode("overwrite").saveAsTable(table)
    return ticks.sparkSession.table(table)
