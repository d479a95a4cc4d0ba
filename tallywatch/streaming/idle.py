"""Processing-time windows that close without a next message.

A window of the wall clock ends when the clock says so, also while nothing
arrives. Each user's sums are kept in state with a timer at the window's end; the
timers live in the checkpoint, so a restart loses none. Spark offers such timers
to Python workers only: rows are summed per Arrow batch before they get there,
and again per user, and what runs in Python is additions."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallywatch import schema
from tallywatch.config import RiskConfig
from tallywatch.functions.parse import accepted, counted, decode
from tallywatch.functions.rules import Rule, default_rules, score
from tallywatch.functions.time import micros, utc_date
from tallywatch.streaming.sinks import BatchWriter, append_batch

EVERY_SECOND = {"processingTime": "1 second"}
_OUT = "user_id long, window_start timestamp, window_end timestamp, transaction_count long, total_amount decimal(20,2)"


class ClockWindows(StatefulProcessor):
    """One user's windows: sums by window end, emitted when its timer fires."""

    def __init__(self, width_ms: int):
        self.width = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getMapState("sums", "end_ms long", "n long, cents decimal(38,0)")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        end = (timerValues.getCurrentProcessingTimeInMs() // self.width + 1) * self.width
        known = self.sums.getValue((end,)) if self.sums.containsKey((end,)) else (0, Decimal(0))
        n, cents = int(known[0]), int(known[1])
        for part in rows:
            n += int(part["n"].sum())
            cents += sum(int(value) for value in part["cents"])
        self.sums.updateValue((end,), (n, Decimal(cents)))
        self.handle.registerTimer(end)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        n, cents = self.sums.getValue((end,))
        self.sums.removeKey((end,))
        times = pd.to_datetime([end - self.width, end], unit="ms")
        yield pd.DataFrame(
            {
                "user_id": [key[0]],
                "window_start": times[:1],
                "window_end": times[1:],
                "transaction_count": [int(n)],
                "total_amount": [Decimal(int(cents)) / 100],
            }
        )

    def close(self) -> None:
        pass


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in batches:
        sums = part.groupby("user_id")["cents"].agg(["size", "sum"]).reset_index()
        yield sums.rename(columns={"size": "n", "sum": "cents"})[["user_id", "n", "cents"]]


def clock_windows(transactions: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Count and sum per user and window of the wall clock, once each, when it
    has ended. The width is a whole number of milliseconds."""
    if cfg.time_basis != "processing":
        raise ValueError("windows of the wall clock need time_basis='processing'")
    width, rest = divmod(micros(cfg.window), 1000)
    if rest or not width:
        raise ValueError(f"window must be whole milliseconds: {cfg.window}")
    rows = transactions.select("user_id", (F.col("amount") * 100).cast("long").alias("cents"))
    sums = rows.mapInPandas(_summed, "user_id long, n long, cents long")
    return sums.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=ClockWindows(width), outputStructType=_OUT, outputMode="Append", timeMode="ProcessingTime"
    )


def start_clock_alerts_query(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    cfg: RiskConfig,
    trigger: dict = EVERY_SECOND,
    rules: list[Rule] | None = None,
    writer: BatchWriter | None = None,
) -> StreamingQuery:
    """Scores windows of the wall clock and stores them as they end."""
    windows = clock_windows(accepted(counted(decode(messages, cfg.keep_currency))), cfg)
    versions = score(windows, rules or default_rules(cfg)).select(
        *schema.ALERT_COLUMNS,
        F.current_timestamp().alias("created_at"),
        F.current_timestamp().alias("updated_at"),
        utc_date(F.col("window_end")).alias("alert_date"),
    )
    stream = versions.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(**trigger)
    return stream.foreachBatch(writer or append_batch(path, "alert_date")).start()
