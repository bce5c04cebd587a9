"""Exchange messages landed as text files, one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.session import materialise

_SPLIT = ["file_time", "file_path", "file_start"]
#: Numbers that the arrivals of one micro-batch may use.
BATCH_SPAN = 1 << 36


def _lines(lines: DataFrame) -> DataFrame:
    return lines.select(
        "value",
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_start"),
    )


def numbered(lines: DataFrame, first: int = 0, by_name: bool = False) -> DataFrame:
    """``value`` and ``seq``: files by time and path (or by path alone), then lines in order, counted from ``first``.

    A line's number is its place in its split plus the lines of all earlier splits, so it does not
    depend on how Spark packs splits into tasks, and no sort of the lines is needed. ``lines`` has the
    split of each line, as ``stream_messages`` gives it.
    """
    placed = lines.withColumn("_id", F.monotonically_increasing_id())
    splits = placed.groupBy(*_SPLIT).agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    order = ", ".join(_SPLIT[by_name:])
    offsets = materialise(splits.selectExpr(*_SPLIT, f"sum(_n) over (order by {order}) - _n - _first as _shift"), "text-splits")
    return placed.join(offsets, _SPLIT).select("value", (F.col("_id") + F.col("_shift") + F.lit(first)).alias("seq"))


def read_messages(spark: SparkSession, path: str, by_name: bool = False) -> DataFrame:
    """``value`` per line, and ``seq``, the order in which lines landed: by the files' times or, where files that
    were written side by side carry their order in their names, by name."""
    return numbered(_lines(spark.read.text(path)), by_name=by_name)


def stream_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """``value`` per line, with its split; a ``StreamJob`` numbers the lines of each micro-batch."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _lines(reader.load(path))
