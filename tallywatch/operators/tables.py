"""Writes to the two stored tables expressed as table-to-table functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch import schema
from tallywatch.functions.time import AsOf, since


def with_defaults(transactions: DataFrame) -> DataFrame:
    """All columns, with the defaults of the stored ones. A transaction that
    still has no id, or a blank one, gets a random one."""
    known = F.when(F.trim("transaction_id") != "", F.col("transaction_id"))
    defaults = {"transaction_id": F.coalesce(known, F.uuid()), "currency": F.coalesce("currency", F.lit("USD"))}
    return transactions.withColumns(defaults)


def transactions_rows(transactions: DataFrame) -> DataFrame:
    """Rows as stored."""
    return with_defaults(transactions).select(*schema.TRANSACTION_COLUMNS)


def insert_ignore(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """The rows of ``incoming`` whose id is not stored yet, one per id. Rows
    without an id, or with a blank one, are all kept.

    Among incoming rows with the same id the earliest wins, and on equal times
    the smallest in column order, so that a retry picks the same row. Picking
    is an aggregate: copies of one id collapse before the shuffle. The stored
    ids are first cut down to those that arrive again; when few rows arrive
    they are broadcast for that and the stored table is not shuffled."""
    order = ["timestamp", *(name for name in incoming.columns if name not in ("transaction_id", "timestamp"))]
    named = F.coalesce(F.trim("transaction_id") != "", F.lit(False))
    nameless = incoming.where(~named)
    incoming = incoming.where(named)
    firsts = (
        incoming.groupBy("transaction_id")
        .agg(F.min(F.struct(*order)).alias("first"))
        .select("transaction_id", "first.*")
    )
    arriving = incoming.select("transaction_id").distinct()
    known = stored.select("transaction_id").join(arriving, "transaction_id", "left_semi")
    return firsts.join(known, "transaction_id", "left_anti").select(*incoming.columns).unionByName(nameless)


def current_alerts(log: DataFrame) -> DataFrame:
    """State of the alerts table after applying a log of alert versions.

    Per (user_id, window_end) the last version gives the values, while
    ``window_start`` and ``created_at`` stay those of the first. Versions are
    ordered by ``updated_at`` between queries, and within a query by ``batch_id``
    (where the log has them), so a clock that runs back changes nothing: a
    version counts as written no earlier than any of its query's before it.
    Versions of one alert collapse before the shuffle, and filters on the keys,
    including the date partition, reach the scan."""
    keys = ["user_id", "window_end", *(["alert_date"] if "alert_date" in log.columns else [])]
    replaced = ["transaction_count", "total_amount", "is_fraud", "alert_reason"]
    values = F.struct(*replaced)
    ordered = {"query_id", "batch_id"} <= set(log.columns)
    if ordered:
        # First the last version of each query, then the last of those.
        log = log.groupBy(*keys, "query_id").agg(
            F.min_by("window_start", F.struct("updated_at", "batch_id")).alias("window_start"),
            F.max_by(values, "batch_id").alias("last"),
            F.min("created_at").alias("created_at"),
            F.max("updated_at").alias("updated_at"),
        )
        values = F.col("last")
    folded = log.groupBy(*keys).agg(
        F.min_by("window_start", "updated_at").alias("window_start"),
        F.max_by(values, F.struct("updated_at", *(["query_id"] if ordered else []))).alias("last"),
        F.min("created_at").alias("created_at"),
        F.max("updated_at").alias("updated_at"),
    )
    dates = keys[2:]
    return folded.select(
        "user_id", "window_start", "window_end", "last.*", "created_at", "updated_at", *dates
    )


def retained(rows: DataFrame, column: str, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """Rows that a clean-up of everything older than ``days`` leaves."""
    return since(rows, column, as_of, f"{days} days")
