"""Session settings the engine relies on, and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tickloom import files

_held: ContextVar[list[str] | None] = ContextVar("held", default=None)


def prepare(spark: SparkSession) -> SparkSession:
    """Set the run-time options every plan here assumes, for the rest of the caller's session: UTC, ANSI
    SQL, adaptive execution, later members of one JSON name win, and the state store that keyed state needs."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    On a cluster it must be set. Where driver and executors are one process, a private folder will do.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tickloom-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table. All of an application's are deleted when it ends."""
    folder = f"{shared_folder(spark)}/tickloom/{spark.sparkContext.applicationId}"
    if not files.exists(spark, folder):
        files.make_folder(spark, folder)
        files.delete_at_end(spark, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, **options: str | int) -> DataFrame:
    """Write ``df`` once to the shared folder, with the writer's ``options``, and read it back.

    Later passes then read only the columns they need from Parquet, and a lost executor costs a
    re-read instead of the whole upstream plan.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.options(**options).mode("errorifexists").parquet(path)
    if (held := _held.get()) is not None:
        held.append(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, by: str) -> DataFrame:
    """``df`` dealt over tasks by a hash of ``by``, however few files or splits it is read from."""
    return df.repartition(by)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialise`` writes inside are deleted at the end; nothing lazy may outlive it."""
    token = _held.set([])
    try:
        yield
    finally:
        for name in _held.get():
            files.delete(spark, name)
        _held.reset(token)
