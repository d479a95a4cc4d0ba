"""Decoding of JSON messages into typed transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch import schema

# Years 1 to 9999 in epoch milliseconds.
EARLIEST_MS = -62_135_596_800_000
LATEST_MS = 253_402_300_799_999

JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
COUNTERS = "message_counts"


def _payload(messages: DataFrame) -> DataFrame:
    """Adds ``is_object`` and the payload struct ``p``.

    The message is parsed as an array element with a null after it: text after
    a complete object is then an error or changes the array's length. It is
    parsed inside a generator because a filter on plain projected fields would
    be pushed below the projection and parse every message again."""
    value = F.col("value")
    elements = F.from_json(
        F.concat(F.lit("["), value, F.lit(",null]")),
        f"array<{schema.PAYLOAD.simpleString()}>",
        JSON_OPTIONS,
    )
    found = F.col("found")
    # Trimming looks for each character in a list, so it is left to the messages that need it.
    complete = F.endswith(value, F.lit("}")) | F.endswith(F.rtrim(value, F.lit(" \t\r\n")), F.lit("}"))
    first = F.get(found, F.lit(0))
    # A value may close the array itself and leave text behind; then a further
    # element is never reached.
    again = F.from_json(F.concat(F.lit("["), value, F.lit(",null,null]")), "array<string>", JSON_OPTIONS)
    # Most messages have no bracket at all, which is found sooner than the pattern.
    closing = F.contains(value, F.lit("]")) & F.rlike(value, F.lit(r"null\s*\]"))
    complete = complete & (~closing | (F.size(again) == 3))
    return messages.select("*", F.explode(F.array(elements)).alias("found")).withColumns(
        {"is_object": complete & (F.size(found) == 2) & first.isNotNull(), "p": first}
    )


def _present(name: str) -> Column:
    # Only reached for fields that came out NULL, so the keys of an ordinary
    # message are never listed.
    return F.array_contains(F.json_object_keys("value"), name)


def _reject_reason(typed: dict[str, Column]) -> Column:
    text = {name: F.col(f"p.{name}") for name in schema.MESSAGE_FIELDS}
    other_json = F.try_parse_json("value").isNotNull() & ~F.startswith(F.trim("value"), F.lit("{"))

    reason = F.when(
        ~F.coalesce("is_object", F.lit(False)),
        F.when(F.coalesce(other_json, F.lit(False)), "not_object").otherwise("bad_json"),
    )
    reason = reason.when(text["user_id"].isNull() & ~_present("user_id"), "missing_user")
    reason = reason.when(typed["user_id"].isNull(), "bad_user")
    for name in ("amount", "timestamp", "city", "merchant_category"):
        reason = reason.when(text[name].isNull() & _present(name), f"null_{name}")
    reason = reason.when(text["amount"].isNotNull() & typed["amount"].isNull(), "bad_amount")
    reason = reason.when(text["timestamp"].isNotNull() & typed["timestamp"].isNull(), "bad_timestamp")
    reason = reason.when(F.length(text["city"]) > schema.MAX_CITY, "long_city")
    return reason.when(F.length(text["merchant_category"]) > schema.MAX_CATEGORY, "long_merchant_category")


def decode(messages: DataFrame, keep_currency: bool = False) -> DataFrame:
    """One row per message: the input columns, the transaction columns and
    ``reject_reason`` (NULL when accepted).

    A field that is absent takes its default (amount 0, texts empty, epoch 0);
    a field that is present but null or unreadable rejects the message. A
    message without an id gets one from its position in the topic where the
    source supplies a ``position`` column, so a replay yields the same id."""
    millis = F.col("p.timestamp").try_cast("bigint")
    instant = F.when(millis.between(EARLIEST_MS, LATEST_MS), F.timestamp_millis(millis))
    typed = {
        "user_id": F.col("p.user_id").try_cast("bigint"),
        "amount": F.col("p.amount").try_cast(schema.AMOUNT),
        "timestamp": instant,
    }
    # A blank id is no id.
    transaction_id = F.when(F.trim("p.transaction_id") != "", F.col("p.transaction_id"))
    if "position" in messages.columns:
        digest = F.md5(F.col("position"))
        parts = [F.substring(digest, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        transaction_id = F.coalesce(transaction_id, F.concat_ws("-", *parts))
    currency = F.coalesce(F.col("p.currency"), F.lit("USD")) if keep_currency else F.lit("USD")

    return _payload(messages).select(
        *messages.columns,
        transaction_id.alias("transaction_id"),
        typed["user_id"].alias("user_id"),
        F.when(F.col("p.timestamp").isNull(), F.timestamp_millis(F.lit(0))).otherwise(instant).alias("timestamp"),
        F.when(F.col("p.amount").isNull(), F.lit(0).cast(schema.AMOUNT)).otherwise(typed["amount"]).alias("amount"),
        currency.alias("currency"),
        F.coalesce(F.col("p.city"), F.lit("")).alias("city"),
        F.coalesce(F.col("p.merchant_category"), F.lit("")).alias("merchant_category"),
        _reject_reason(typed).alias("reject_reason"),
    )


def accepted(decoded: DataFrame, *more: str) -> DataFrame:
    """The transactions of the messages that decoded; ``more`` are further
    columns to keep."""
    carried = list(dict.fromkeys([*(["ingest_time"] if "ingest_time" in decoded.columns else []), *more]))
    return decoded.where(F.col("reject_reason").isNull()).select(*schema.TRANSACTION_COLUMNS, *carried)


def quarantined(decoded: DataFrame) -> DataFrame:
    """The messages that did not decode, each with its reason."""
    return decoded.where(F.col("reject_reason").isNotNull()).select("value", "reject_reason")


def parse_transactions(messages: DataFrame, keep_currency: bool = False) -> tuple[DataFrame, DataFrame]:
    """Accepted transactions and quarantined messages."""
    decoded = decode(messages, keep_currency)
    return accepted(decoded), quarantined(decoded)


def counted(decoded: DataFrame, name: str = COUNTERS) -> DataFrame:
    """The same rows; message and reject counts are reported per batch or
    query under ``name`` to query listeners and in streaming progress."""
    return decoded.observe(
        name, F.count(F.lit(1)).alias("messages"), F.count("reject_reason").alias("rejected")
    )
