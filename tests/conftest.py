import os
import tempfile
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import SparkSession

os.environ.setdefault("TZ", "UTC")
T0 = datetime(2026, 1, 1, 12, 0, 0, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tickloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tickloom-checkpoint-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tickloom-warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def t0():
    return T0


def seconds(value: float) -> timedelta:
    return timedelta(microseconds=round(value * 1_000_000))
