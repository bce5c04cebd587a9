"""Row shapes used across the engine (timestamps are UTC)."""

from pyspark.sql import types as T

_STRING, _DOUBLE, _LONG = T.StringType(), T.DoubleType(), T.LongType()

TICK = T.StructType(
    [
        T.StructField("symbol", _STRING, False),
        T.StructField("price", _DOUBLE, False),
        T.StructField("quantity", _DOUBLE, False),
        T.StructField("trade_time", T.TimestampType(), False),
        T.StructField("side", _STRING, False),
        T.StructField("source", _STRING, False),
        T.StructField("seq", _LONG, False),
    ]
)

STATS = T.StructType(
    [
        T.StructField("vwap", _DOUBLE, False),
        T.StructField("mean_price", _DOUBLE, False),
        T.StructField("stdev_price", _DOUBLE, False),
        T.StructField("sample_count", _LONG, False),
        T.StructField("window_seconds", _DOUBLE, False),
    ]
)

PROCESSED = T.StructType(
    [
        T.StructField("symbol", _STRING, False),
        T.StructField("price", _DOUBLE, False),
        T.StructField("quantity", _DOUBLE, False),
        T.StructField("trade_time", T.TimestampType(), False),
        T.StructField("side", _STRING, False),
        T.StructField("stats", STATS, False),
        T.StructField("is_anomaly", T.BooleanType(), False),
        T.StructField("anomaly_zscore", _DOUBLE, True),
    ]
)

ANOMALY = T.StructType(
    [
        T.StructField("symbol", _STRING, False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("triggering_price", _DOUBLE, False),
        T.StructField("rolling_mean", _DOUBLE, False),
        T.StructField("rolling_stdev", _DOUBLE, False),
        T.StructField("deviation_zscore", _DOUBLE, False),
        T.StructField("threshold", _DOUBLE, False),
    ]
)

STORED = T.StructType(
    [
        T.StructField("symbol", _STRING, False),
        T.StructField("price", _DOUBLE, False),
        T.StructField("quantity", _DOUBLE, False),
        T.StructField("trade_time", T.TimestampType(), False),
        T.StructField("side", _STRING, False),
        T.StructField("vwap", _DOUBLE, False),
        T.StructField("mean_price", _DOUBLE, False),
        T.StructField("stdev_price", _DOUBLE, False),
        T.StructField("sample_count", _LONG, False),
        T.StructField("is_anomaly", T.IntegerType(), False),
        T.StructField("anomaly_zscore", _DOUBLE, True),
        T.StructField("partition_key", _STRING, False),
    ]
)

# The columns of Spark's Kafka source, so a folder of such rows can stand in for a topic.
TOPIC = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", _STRING, True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", _LONG, True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

REJECT = T.StructType(
    [
        T.StructField("value", T.BinaryType(), True),
        T.StructField("reject_reason", _STRING, False),
    ]
)
