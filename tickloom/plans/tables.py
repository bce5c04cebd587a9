"""Tick views over the benchmark tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _utc(column: str) -> Column:
    return F.col(column).cast("timestamp")


def event_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Valid ticks from ``events``: type as symbol, value as price, ``props.k`` as quantity."""
    events = read_table(spark, folder, "events").select(
        F.upper("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"),
        _utc("ts").alias("trade_time"),
        F.when(F.col("event_id") % 2 == 1, "sell").otherwise("buy").alias("side"),
        F.lit("binance").alias("source"),
        F.col("event_id").alias("seq"),
    )
    return events.filter((F.col("price") > 0) & (F.col("quantity") > 0))


def order_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks with many equal times from ``orders``: priority as symbol, total as price."""
    return read_table(spark, folder, "orders").select(
        F.upper("o_orderpriority").alias("symbol"),
        F.col("o_totalprice").alias("price"),
        F.lit(1.0).alias("quantity"),
        _utc("o_orderdate").alias("trade_time"),
        F.when(F.col("o_orderkey") % 2 == 1, "sell").otherwise("buy").alias("side"),
        F.lit("binance").alias("source"),
        F.col("o_orderkey").alias("seq"),
    )


def _event_fields(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").select(
        F.col("event_id").alias("seq"),
        "event_type",
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        _utc("ts").alias("at"),
        (F.col("event_id") % 2 == 1).alias("sell"),
    )


def exchange_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as an exchange message; events of type ``error`` become malformed ones by ``k``."""
    events = _event_fields(spark, folder)
    millis = F.unix_millis("at")

    def message(s=F.col("event_type"), p=F.col("price").cast("string"), q=F.col("k"), t=millis, m=F.col("sell")) -> Column:
        return F.to_json(
            F.struct(s.alias("s"), p.alias("p"), q.alias("q"), t.alias("T"), m.alias("m")), {"ignoreNullFields": "false"}
        )

    k = F.col("k")
    broken = (
        F.when(k < 10, F.lit("not json"))
        .when(k < 20, F.expr("cast(null as string)"))
        .when(k < 30, F.concat(message(), F.lit(" x")))
        .when(k < 40, message(s=F.lit(5)))
        .when(k < 50, message(s=F.lit("  ")))
        .when(k < 60, message(p=F.lit("abc")))
        .when(k < 70, message(q=F.lit(None).cast("int")))
        .when(k < 80, message(t=millis.cast("string")))
        .when(k < 90, F.concat(F.lit("["), message(), F.lit("]")))
        .otherwise(message(m=F.lit("false")))
    )
    value = F.when(F.col("event_type") == "error", broken).otherwise(message())
    return events.select("seq", value.alias("value"))


def canonical_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a tick message with mixed spellings; ``error`` events become malformed ones."""
    events = _event_fields(spark, folder)
    plain = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    ahead = F.date_format(F.expr("at + interval 5 hours 30 minutes"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    spelled = (
        F.when(F.col("event_type") == "view", plain)
        .when(F.col("event_type") == "click", F.concat(ahead, F.lit("+05:30")))
        .when(F.col("event_type") == "signup", F.unix_millis("at").cast("string"))
        .otherwise(F.concat(plain, F.lit("Z")))
    )

    def message(side=F.when(F.col("sell"), "sell").otherwise("buy"), t=spelled, price=F.col("price"), source=F.lit("feed")) -> Column:
        return F.to_json(
            F.struct(
                F.concat(F.lit(" "), "event_type").alias("symbol"), price.alias("price"),
                F.col("k").cast("string").alias("quantity"), t.alias("trade_time"), side.alias("side"), source.alias("source"),
            )
        )

    k = F.col("k")
    broken = (
        F.when(k < 20, message(side=F.lit("BUY")).cast("binary"))
        .when(k < 40, message(t=F.lit("T12:00:00")).cast("binary"))
        .when(k < 60, message(price=-F.col("price")).cast("binary"))
        .when(k < 80, F.concat(message().cast("binary"), F.unhex(F.lit("FFFE"))))
        .otherwise(message(source=F.lit(None).cast("string")).cast("binary"))
    )
    value = F.when(F.col("event_type") == "error", broken).otherwise(message().cast("binary"))
    return events.select("seq", value.alias("value"))


def shuffled_event_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """``event_ticks`` arriving out of order: blocks of 16 event numbers are permuted."""
    block, place = F.floor(F.col("seq") / 16) * 16, F.col("seq") % 16
    return event_ticks(spark, folder).withColumn("seq", block + (place * 5 + 3) % 16)
