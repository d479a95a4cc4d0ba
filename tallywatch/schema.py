"""Schemas of the messages and of the two stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

AMOUNT = T.DecimalType(10, 2)
TOTAL = T.DecimalType(20, 2)

MAX_CURRENCY = 3
MAX_CITY = 255
MAX_CATEGORY = 100

# Every payload field is read as text first, so that "12.5" and 12.5 are both
# numbers and a field of the wrong type spoils only itself.
MESSAGE_FIELDS = (
    "transaction_id",
    "user_id",
    "timestamp",
    "amount",
    "currency",
    "city",
    "merchant_category",
)
PAYLOAD = T.StructType([T.StructField(name, T.StringType()) for name in MESSAGE_FIELDS])

TRANSACTION = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("amount", AMOUNT),
        T.StructField("currency", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
    ]
)
TRANSACTION_COLUMNS = TRANSACTION.fieldNames()

PROFILE_COLUMNS = ["user_id", "window_start", "window_end", "transaction_count", "total_amount"]
SCORE_COLUMNS = ["is_fraud", "alert_reason"]
ALERT_COLUMNS = PROFILE_COLUMNS + SCORE_COLUMNS
ENRICHED_COLUMNS = [
    "transaction_id",
    "user_id",
    "amount",
    "city",
    "merchant_category",
    "timestamp",
    "window_start",
    "window_end",
    "transaction_count",
    "total_amount",
    "is_fraud",
    "alert_reason",
]

# Stored layouts. The last columns are the partition directories: the query and
# the micro-batch that wrote the rows, then the date.
_WRITTEN_BY = [T.StructField("query_id", T.StringType()), T.StructField("batch_id", T.LongType())]

TRANSACTIONS_TABLE = T.StructType(
    TRANSACTION.fields
    + [T.StructField("ingested_at", T.TimestampType())]
    + _WRITTEN_BY
    + [T.StructField("event_date", T.DateType())]
)
ALERT_PARTS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("city", T.StringType()),
        T.StructField("transaction_count", T.LongType()),
        T.StructField("total_amount", TOTAL),
        T.StructField("written_at", T.TimestampType()),
    ]
    + _WRITTEN_BY
    + [T.StructField("alert_date", T.DateType())]
)
MINUTE_PARTS = T.StructType(
    [
        T.StructField("minute", T.TimestampType()),
        T.StructField("transaction_count", T.LongType()),
        T.StructField("total_volume", TOTAL),
    ]
    + _WRITTEN_BY
    + [T.StructField("event_date", T.DateType())]
)
STATS_PARTS = T.StructType(
    [
        T.StructField("window_end", T.TimestampType()),
        T.StructField("alerts", T.LongType()),
        T.StructField("fraud", T.LongType()),
        T.StructField("fraud_amount", TOTAL),
    ]
    + _WRITTEN_BY
    + [T.StructField("alert_date", T.DateType())]
)
USER_PARTS = T.StructType(
    [
        T.StructField("hour", T.TimestampType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("users", T.BinaryType()),
    ]
    + _WRITTEN_BY
    + [T.StructField("alert_date", T.DateType())]
)
CLOSED_ALERTS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("transaction_count", T.LongType()),
        T.StructField("total_amount", TOTAL),
        T.StructField("is_fraud", T.IntegerType()),
        T.StructField("alert_reason", T.StringType()),
        T.StructField("correction", T.BooleanType()),
        T.StructField("version", T.LongType()),
    ]
    + _WRITTEN_BY
    + [T.StructField("alert_date", T.DateType())]
)
PROGRESS = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("high", T.TimestampType()),
        T.StructField("seen", T.TimestampType()),
        T.StructField("rows", T.LongType()),
        T.StructField("late", T.LongType()),
        T.StructField("behind", T.BinaryType()),
    ]
    + _WRITTEN_BY
)
QUARANTINE = T.StructType(
    [T.StructField("value", T.StringType()), T.StructField("reject_reason", T.StringType())] + _WRITTEN_BY
)
FEED = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("message", T.StringType()),
    ]
    + _WRITTEN_BY
    + [T.StructField("alert_date", T.DateType())]
)
ALERTS_LOG = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("transaction_count", T.LongType()),
        T.StructField("total_amount", TOTAL),
        T.StructField("is_fraud", T.IntegerType()),
        T.StructField("alert_reason", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
    + _WRITTEN_BY
    + [T.StructField("alert_date", T.DateType())]
)

# One row for each batch of the job that reached every table. ``stream`` is the
# id in the query's checkpoint, ``query_id`` names the stream and its run and is
# what the rows of the tables carry. Windows that end up to ``low`` are closed.
BATCH_MARKS = T.StructType(
    [T.StructField("stream", T.StringType())]
    + _WRITTEN_BY
    + [
        T.StructField("marked_at", T.TimestampType()),
        T.StructField("low", T.TimestampType()),
        T.StructField("version", T.LongType()),
    ]
)

# The job's tables show nothing before the latest of these times.
RETIRED = T.StructType([T.StructField("before", T.TimestampType()), T.StructField("retired_at", T.TimestampType())])
