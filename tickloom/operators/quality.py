"""Messages to validated ticks, with malformed ones set aside and a reason attached."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions import wire
from tickloom.params import DEFAULT_SOURCE

REASONS = (
    "null_value",
    "bad_utf8",
    "bad_json",
    "not_object",
    "symbol_invalid",
    "price_invalid",
    "price_nonpositive",
    "quantity_invalid",
    "quantity_nonpositive",
    "time_invalid",
    "side_invalid",
    "source_invalid",
)


def _finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def _reason() -> Column:
    """The first rule a message breaks, over its raw field values."""
    symbol, price, quantity = F.col("_symbol"), F.col("_price"), F.col("_quantity")
    failures = {
        "null_value": F.col("value").isNull(),
        "bad_utf8": ~F.col("_utf8"),
        "bad_json": F.col("_kind").isNull(),
        "not_object": ~F.col("_kind").startswith("OBJECT"),
        "symbol_invalid": symbol.isNull() | (F.length(symbol) < 1),
        "price_invalid": ~_finite(price),
        "price_nonpositive": price <= 0,
        "quantity_invalid": ~_finite(quantity),
        "quantity_nonpositive": quantity <= 0,
        "time_invalid": F.col("_time").isNull(),
        "side_invalid": F.col("_side").isNull() | ~F.col("_side").isin("buy", "sell"),
        "source_invalid": F.col("_source").isNull(),
    }
    reason = F.when(failures[REASONS[0]], REASONS[0])
    for name in REASONS[1:]:
        reason = reason.when(failures[name], name)
    return reason


Fields = dict[str, wire.JsonValue]


def _parse(
    records: DataFrame, names: list[str], shape: wire.Shape, epoch: Callable[[Fields], Column], micros: Callable[[Column], Column],
    read: Callable[[Fields, Column], dict[str, Column]],
) -> DataFrame:
    """Parse each message once, step by step, then judge it.

    Messages in the plain spelling are cut up by its pattern; only the others go through the JSON parser
    (later members of one name win). The steps end in a generator of one row. It keeps the optimizer
    from substituting the parsing into the filters on ``reject_reason``, where it would run once per mention.
    """
    records.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    utf8 = F.is_valid_utf8(F.col("value").cast("string"))
    parsed = (
        records.withColumn("_utf8", utf8)
        .withColumn("_text", F.when(F.col("_utf8"), F.col("value").cast("string")))
        .withColumn("_apart", shape.apart(F.col("_text")))
        .withColumn("_cut", shape.cut(F.col("_text"), F.col("_apart")))
        .withColumn("_plain", F.col("_cut").isNotNull())
        .withColumn("_json", F.when(F.col("_cut").isNull(), F.col("_text")))
        .withColumn("_array", wire.in_brackets(F.col("_json")))
        .withColumn("_message", wire.only_value(F.col("_array"), F.col("_json")))
        .withColumns({f"_f_{n}": wire.field(F.col("_message"), n) for n in names})
        .withColumns({f"_k_{n}": F.schema_of_variant(f"_f_{n}") for n in names})
    )
    parsed_fields = {n: wire.JsonValue(F.col(f"_f_{n}"), F.col(f"_k_{n}")) for n in names}
    plain_fields = shape.fields(F.col("_cut"))

    def either(rule: Callable[[Fields], Column]) -> Column:
        return F.when(F.col("_plain"), rule(plain_fields)).otherwise(rule(parsed_fields))

    parsed = parsed.withColumn("_epoch", either(epoch)).withColumn("_micros", micros(F.col("_epoch")))
    plain, other = read(plain_fields, F.col("_micros")), read(parsed_fields, F.col("_micros"))
    raw = F.struct(
        F.col("_utf8"),
        F.when(F.col("_plain"), F.lit("OBJECT")).otherwise(F.schema_of_variant("_message")).alias("_kind"),
        *[F.when(F.col("_plain"), plain[name]).otherwise(other[name]).alias(f"_{name}") for name in other],
    )
    judged = (
        parsed.select(*records.columns, F.inline(F.array(raw)))
        .withColumn("_normal", wire.normal_symbol(F.col("_symbol")))
        .withColumn("reject_reason", _reason())
    )
    return judged.select(
        *records.columns,
        F.col("_normal").alias("symbol"),
        F.col("_price").alias("price"),
        F.col("_quantity").alias("quantity"),
        F.col("_time").alias("trade_time"),
        F.col("_side").alias("side"),
        F.col("_source").alias("source"),
        "reject_reason",
    )


def parse_exchange(records: DataFrame) -> DataFrame:
    """Add tick columns and ``reject_reason`` to exchange messages (``value``: s, p, q, T, m).

    ``reject_reason`` is null for a valid tick. Any finite price and quantity above 0 is valid. Other
    input columns (such as ``seq``) are kept.
    """

    def read(json: Fields, micros: Column) -> dict[str, Column]:
        return {
            "symbol": wire.text(json["s"]),
            "price": wire.number(json["p"], underscores=True),
            "quantity": wire.number(json["q"], underscores=True),
            "time": wire.instant(micros),
            "side": F.when(wire.truthy(json["m"]), F.lit("sell")).otherwise(F.lit("buy")),
            "source": F.lit(DEFAULT_SOURCE),
        }

    names = ["s", "p", "q", "T", "m"]
    return _parse(records, names, wire.EXCHANGE_SHAPE, lambda json: wire.epoch_number(json["T"]), wire.micros_from_millis, read)


def parse_canonical(records: DataFrame) -> DataFrame:
    """``parse_exchange`` for messages that carry ticks under their own field names."""

    def read(json: Fields, micros: Column) -> dict[str, Column]:
        absent = json["source"].value.isNull()
        return {
            "symbol": wire.text(json["symbol"]),
            "price": wire.number(json["price"]),
            "quantity": wire.number(json["quantity"]),
            "time": F.coalesce(wire.instant(micros), wire.iso_time(json["trade_time"])),
            "side": wire.text(json["side"]),
            "source": F.when(absent, F.lit(DEFAULT_SOURCE)).otherwise(wire.text(json["source"])),
        }

    names = ["symbol", "price", "quantity", "trade_time", "side", "source"]
    return _parse(records, names, wire.CANONICAL_SHAPE, lambda json: wire.epoch_lax(json["trade_time"]), wire.micros_by_size, read)


def valid_ticks(parsed: DataFrame, *keep: str) -> DataFrame:
    """The accepted ticks; ``keep`` names further columns such as ``seq``."""
    return parsed.filter(F.col("reject_reason").isNull()).select(
        "symbol", "price", "quantity", "trade_time", "side", "source", *keep
    )


def rejects(parsed: DataFrame) -> DataFrame:
    """The messages set aside, byte by byte as received, with the first rule they break (REJECT)."""
    return parsed.filter(F.col("reject_reason").isNotNull()).select(F.col("value").cast("binary"), "reject_reason")


def reject_counts(parsed: DataFrame) -> DataFrame:
    """Rejected messages per reason."""
    return rejects(parsed).groupBy("reject_reason").agg(F.count("*").alias("messages"))
