"""The streaming queries: one per sink, each with its own checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywatch.config import RiskConfig
from tallywatch.functions.parse import accepted, counted, decode, quarantined
from tallywatch.functions.rules import Rule
from tallywatch.functions.time import utc_date
from tallywatch.operators.profile import alerts, closed_rows, enrich_closed
from tallywatch.operators.tables import transactions_rows
from tallywatch.streaming.sinks import BatchWriter, append_batch

EVERY_MINUTE = {"processingTime": "60 seconds"}


def _start(rows: DataFrame, writer: BatchWriter, checkpoint: str, trigger: dict, mode: str = "append") -> StreamingQuery:
    stream = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return stream.trigger(**trigger).foreachBatch(writer).start()


def _accepted(messages: DataFrame, cfg: RiskConfig) -> DataFrame:
    return accepted(counted(decode(messages, cfg.keep_currency)))


def unique_transactions(transactions: DataFrame, within: str | None = None) -> DataFrame:
    """Drops redelivered ids from a stream of transactions.

    By default every id ever seen is remembered in the state store, as a
    unique index would, and late rows are kept. With ``within`` an id is
    forgotten that long after its event time, which bounds the state but also
    drops rows later than that."""
    rows = transactions_rows(transactions)
    if within:
        return rows.withWatermark("timestamp", within).dropDuplicatesWithinWatermark(["transaction_id"])
    return rows.dropDuplicates(["transaction_id"])


def start_transactions_query(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    cfg: RiskConfig = RiskConfig(),
    trigger: dict = EVERY_MINUTE,
    within: str | None = None,
    writer: BatchWriter | None = None,
) -> StreamingQuery:
    """Stores each transaction once, as soon as it is decoded. A ``writer``
    replaces the table of files and has to ignore ids it knows itself, as a
    database with a unique key does; no ids are then remembered here."""
    accepted_rows = _accepted(messages, cfg)
    rows = transactions_rows(accepted_rows) if writer else unique_transactions(accepted_rows, within)
    # The time of a micro-batch is logged with its offsets, so a retry repeats it.
    dated = rows.withColumns({"ingested_at": F.current_timestamp(), "event_date": utc_date(F.col("timestamp"))})
    return _start(dated, writer or append_batch(path, "event_date"), checkpoint, trigger)


def start_alerts_query(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    cfg: RiskConfig = RiskConfig(),
    trigger: dict = EVERY_MINUTE,
    mode: str = "append",
    rules: list[Rule] | None = None,
    writer: BatchWriter | None = None,
) -> StreamingQuery:
    """Profiles and scores windows. ``append`` emits a window once, when the
    watermark passes its end; ``update`` emits its running values every batch
    for the upserting reader. Rows later than the watermark do not reach
    windows and are counted by ``late_rows``."""
    versions = alerts(_accepted(messages, cfg), cfg, rules).withColumns(
        {
            "created_at": F.current_timestamp(),
            "updated_at": F.current_timestamp(),
            "alert_date": utc_date(F.col("window_end")),
        }
    )
    return _start(versions, writer or append_batch(path, "alert_date"), checkpoint, trigger, mode)


def start_enriched_query(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    cfg: RiskConfig = RiskConfig(),
    trigger: dict = EVERY_MINUTE,
    rules: list[Rule] | None = None,
) -> StreamingQuery:
    """Emits each transaction with its window's totals when the window closes:
    rows wait in the state until then and are joined with the totals in the
    micro-batch they leave it in. Joining the two streams instead, as ``enrich``
    does for a stream, takes several look-ups in the state for each row."""
    append = append_batch(path, "event_date")

    def write(batch: DataFrame, batch_id: int) -> None:
        closed = batch.persist()
        try:
            # All of the state is gone through here, and once only; the join reads the rows several times.
            closed.count()
            rows = enrich_closed(closed, cfg, rules).withColumn("event_date", utc_date(F.col("timestamp")))
            append(rows, batch_id)
        finally:
            closed.unpersist()

    return _start(closed_rows(_accepted(messages, cfg), cfg), write, checkpoint, trigger)


def start_quarantine_query(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict = EVERY_MINUTE
) -> StreamingQuery:
    """Keeps the messages that could not be decoded."""
    return _start(quarantined(decode(messages)), append_batch(path), checkpoint, trigger)


def late_rows(query: StreamingQuery) -> int:
    """What the query's recent batches dropped as later than the watermark.
    Late rows of one window that a map task had already summed count as one."""
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )
