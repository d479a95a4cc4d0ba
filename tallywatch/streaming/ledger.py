"""The job's single query: each micro-batch is decoded once and its messages go
to the quarantine, the transactions and the alert tables together.

No watermark and no state: a batch stores the transactions that no other batch
has stored, and for each user and window their count and sum. An alert is the
sum of its parts, so late rows count and wrong clocks harm nobody else.

A batch reaches all tables or none. It writes into folders of its own, named
after the stream and its run, and sets a mark when all is written; readers see
the rows of marked batches only. What a run that was cut short left behind is
never seen and its transactions don't count as stored, so the next run stores
them, with the same checkpoint or with a new one.

When all sources have passed the end of a window, its alert is emitted as final
to a table of its own, once; what rows that come later add to it is emitted as a
correction."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallywatch import schema
from tallywatch.config import RiskConfig
from tallywatch.functions.parse import accepted, counted, decode, quarantined
from tallywatch.functions.rules import Rule, alert_feed
from tallywatch.functions.time import utc_date
from tallywatch.operators.profile import TIME_COLUMN, window_totals
from tallywatch.operators.tables import insert_ignore, with_defaults
from tallywatch.sources.tables import (
    COMPACTED,
    batch_marks,
    optional_rows,
    remove,
    summed_alerts,
    table_rows,
    unmarked_rows,
)
from tallywatch.streaming.ids import IdIndex
from tallywatch.streaming.progress import Progress, source_progress
from tallywatch.streaming.rollups import minute_parts, stats_parts, user_parts

MOST_DAYS = 400  # that are named one by one when their folders are listed

Follower = Callable[[DataFrame, DataFrame, int], None]


@dataclass(frozen=True)
class Tables:
    """Where the job's tables lie, date folders outermost."""

    root: str

    @property
    def transactions(self) -> str:
        return f"{self.root}/transactions"

    @property
    def alert_parts(self) -> str:
        return f"{self.root}/alert_parts"

    @property
    def minutes(self) -> str:
        return f"{self.root}/minutes"

    @property
    def stats(self) -> str:
        return f"{self.root}/stats"

    @property
    def users(self) -> str:
        return f"{self.root}/users"

    @property
    def closed_alerts(self) -> str:
        return f"{self.root}/closed_alerts"

    @property
    def progress(self) -> str:
        return f"{self.root}/progress"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def ids(self) -> str:
        return f"{self.root}/ids"

    @property
    def batches(self) -> str:
        return f"{self.root}/batches"

    @property
    def retired(self) -> str:
        return f"{self.root}/retired"

    @property
    def dated(self) -> list[str]:
        """The tables with date folders outermost."""
        return [self.transactions, self.alert_parts, self.closed_alerts, self.feed, self.minutes, self.stats, self.users]

    @property
    def feed(self) -> str:
        return f"{self.root}/alert_feed"


def _owned(rows: DataFrame, query_id: str, batch_id: int) -> DataFrame:
    return rows.withColumns({"query_id": F.lit(query_id), "batch_id": F.lit(batch_id).cast("long")})


def _append(rows: DataFrame, path: str, *partition_by: str) -> None:
    """Writes a batch's rows to folders of its own, in as few files for each date
    as its size allows."""
    rows = rows.hint("rebalance", *partition_by)
    rows.write.mode("append").partitionBy(*partition_by, "query_id", "batch_id").parquet(path)


def _together(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Runs independent writes side by side, as jobs of the calling batch."""
    with ThreadPoolExecutor(len(writes)) as pool:
        for started in [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]:
            started.result()


def _mark(
    spark: SparkSession, tables: Tables, stream: str, query_id: str, batch_id: int, progress: Progress = Progress()
) -> None:
    row = spark.range(1).select(
        F.lit(stream).alias("stream"),
        F.lit(query_id).alias("query_id"),
        F.lit(batch_id).cast("long").alias("batch_id"),
        F.current_timestamp().alias("marked_at"),
        F.lit(progress.low).cast("timestamp").alias("low"),
        F.lit(progress.version).cast("long").alias("version"),
    )
    row.coalesce(1).write.mode("append").parquet(tables.batches)


def _catch_up(spark: SparkSession, tables: Tables, cfg: RiskConfig, rules: list[Rule] | None) -> None:
    """Rollups of tables that were written without, by compaction for instance."""
    parts = table_rows(spark, tables.alert_parts, schema.ALERT_PARTS)
    if optional_rows(spark, tables.users, schema.USER_PARTS) is not None or parts.isEmpty():
        return
    transactions = table_rows(spark, tables.transactions, schema.TRANSACTIONS_TABLE)
    for rows, path, date in (
        (minute_parts(transactions), tables.minutes, "event_date"),
        (stats_parts(parts, None, cfg, rules), tables.stats, "alert_date"),
        (user_parts(parts), tables.users, "alert_date"),
    ):
        remove(spark, path)
        _append(_owned(rows, COMPACTED, 0), path, date)


def start_ledger_query(
    messages: DataFrame,
    tables: Tables,
    checkpoint: str,
    cfg: RiskConfig = RiskConfig(),
    trigger: dict | None = None,
    rules: list[Rule] | None = None,
    feed: bool = False,
    follower: Follower | None = None,
) -> StreamingQuery:
    """Runs the job on a stream of messages.

    ``feed`` also stores the feed line of every alert that a batch touches and
    leaves fraudulent. ``follower`` is called with the batch's new transactions
    and the alerts they touch, once these are stored, for instance to send them
    to a database; it may be called again for the same batch."""
    clocked = messages.withColumn("processing_time", F.current_timestamp())
    spark = messages.sparkSession
    run = uuid.uuid4().hex[:8]
    if batch_marks(spark, tables.transactions) is None:
        # From now on nothing counts without a mark.
        _mark(spark, tables, "", run, -1)
    index = IdIndex(spark, tables.ids, tables.transactions)
    index.catch_up()
    _catch_up(spark, tables, cfg, rules)
    progress = Progress.stored(spark, tables.progress)
    started = []

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal progress
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        query_id = f"{stream}-{run}"
        if not started:
            started.append(batch_id)
            # The last run may have ended between its mark and the checkpoint's own.
            whole = batch_marks(spark, tables.transactions)
            whole = whole.where((F.col("stream") == stream) & (F.col("batch_id") == batch_id)).first()
            if whole:
                _follow(spark, whole["query_id"], batch_id)
                return
        decoded = counted(decode(batch, cfg.keep_currency))
        # Only the texts of rejected messages are needed again.
        rejected = F.when(F.col("reject_reason").isNotNull(), F.col("value"))
        decoded = decoded.withColumn("value", rejected).persist()
        try:
            carried = [*(set(TIME_COLUMN.values()) - {"timestamp"}), "position"]
            carried = sorted(name for name in carried if name in decoded.columns)
            arriving = with_defaults(accepted(decoded, *carried))
            # Arriving rows whose id no whole batch has stored.
            fresh = insert_ignore(index.candidates(arriving), arriving).persist()
            try:
                _together(
                    spark,
                    lambda: _append(_owned(quarantined(decoded), query_id, batch_id), tables.quarantine),
                    # Works the new rows out, once for all.
                    lambda: _append(_owned(_dated(fresh), query_id, batch_id), tables.transactions, "event_date"),
                )
                _store(fresh, query_id, batch_id)
                mine = _of_batch(spark, tables.alert_parts, schema.ALERT_PARTS, query_id, batch_id)
                stats = stats_parts(mine, _others(mine, query_id, batch_id), cfg, rules)
                after = progress.after(
                    _of_batch(spark, tables.progress, schema.PROGRESS, query_id, batch_id).collect(), cfg
                )
                ids = _owned(fresh.select("transaction_id"), query_id, batch_id)
                _together(
                    spark,
                    # Not before: Spark drops cached rows that were made from a folder that is written to.
                    lambda: _append(ids, f"{tables.ids}/new"),
                    lambda: _append(_owned(stats, query_id, batch_id), tables.stats, "alert_date"),
                    lambda: _append(_owned(user_parts(mine), query_id, batch_id), tables.users, "alert_date"),
                    lambda: _close(spark, after, query_id, batch_id),
                )
            finally:
                fresh.unpersist()
        finally:
            decoded.unpersist()
        if feed:
            _feed(spark, query_id, batch_id)
        _mark(spark, tables, stream, query_id, batch_id, after)
        progress = after
        index.marked(query_id, batch_id)
        _follow(spark, query_id, batch_id)

    def _dated(fresh: DataFrame) -> DataFrame:
        now = F.col("processing_time").alias("ingested_at")
        return fresh.select(*schema.TRANSACTION_COLUMNS, now, utc_date(F.col("timestamp")).alias("event_date"))

    def _store(fresh: DataFrame, query_id: str, batch_id: int) -> None:
        now = F.col("processing_time")
        parts = window_totals(fresh, cfg, F.max(now).alias("written_at"), by=("city",))
        parts = parts.withColumn("alert_date", utc_date(F.col("window_end")))
        clocks = source_progress(fresh, progress, cfg).coalesce(1)
        _together(
            fresh.sparkSession,
            lambda: _append(_owned(parts, query_id, batch_id), tables.alert_parts, "alert_date"),
            lambda: _append(_owned(clocks, query_id, batch_id), tables.progress),
            lambda: _append(_owned(minute_parts(fresh), query_id, batch_id), tables.minutes, "event_date"),
        )

    def _close(spark: SparkSession, after: Progress, query_id: str, batch_id: int) -> None:
        """Emits the windows that are final now, and corrects those that were."""
        if after.low is None:
            return
        end = F.col("window_end")
        mine = _of_batch(spark, tables.alert_parts, schema.ALERT_PARTS, query_id, batch_id)
        found = None
        if progress.low != after.low:
            # Only the days that have passed since the last time are looked at.
            passed = table_rows(spark, tables.alert_parts, schema.ALERT_PARTS, progress.days_until(after))
            passed = passed.unionByName(mine)
            passed = passed.where(end <= F.lit(after.low))
            if progress.low is not None:
                passed = passed.where(end > F.lit(progress.low))
            found = summed_alerts(passed, cfg, rules).withColumn("correction", F.lit(False))
        if after.late:
            late = _whole(mine.where(end <= F.lit(progress.low)), query_id, batch_id)
            late = summed_alerts(late, cfg, rules).withColumn("correction", F.lit(True))
            found = late if found is None else found.unionByName(late)
        if found is not None:
            closed = found.select(
                *schema.ALERT_COLUMNS, "correction", F.lit(after.version).cast("long").alias("version"), "alert_date"
            )
            _append(_owned(closed, query_id, batch_id), tables.closed_alerts, "alert_date")

    def _others(mine: DataFrame, query_id: str, batch_id: int) -> DataFrame:
        """The alert parts of other whole batches, of the days that this one touches."""
        days = [row["alert_date"] for row in mine.select("alert_date").distinct().limit(MOST_DAYS + 1).collect()]
        few = days if len(days) <= MOST_DAYS else None
        parts = table_rows(mine.sparkSession, tables.alert_parts, schema.ALERT_PARTS, few)
        return parts.where((F.col("query_id") != query_id) | (F.col("batch_id") != batch_id))

    def _whole(mine: DataFrame, query_id: str, batch_id: int) -> DataFrame:
        """A batch's own parts and all others of the same alerts."""
        others = _others(mine, query_id, batch_id)
        keys = mine.select("user_id", "window_end", "alert_date").distinct()
        known = others.join(keys, ["user_id", "window_end", "alert_date"], "left_semi").select(*others.columns)
        return mine.unionByName(known)

    def _of_batch(spark: SparkSession, path: str, layout: T.StructType, query_id: str, batch_id: int) -> DataFrame:
        """What this batch itself wrote, marked or not."""
        mine = (F.col("query_id") == query_id) & (F.col("batch_id") == batch_id)
        return unmarked_rows(spark, path, layout).where(mine)

    def _touched(spark: SparkSession, query_id: str, batch_id: int) -> DataFrame:
        """The alerts that this batch touches, each with all its parts."""
        mine = _of_batch(spark, tables.alert_parts, schema.ALERT_PARTS, query_id, batch_id)
        return summed_alerts(_whole(mine, query_id, batch_id), cfg, rules)

    def _feed(spark: SparkSession, query_id: str, batch_id: int) -> None:
        lines = alert_feed(_touched(spark, query_id, batch_id))
        lines = lines.withColumn("alert_date", utc_date(F.col("window_end")))
        _append(_owned(lines, query_id, batch_id), tables.feed, "alert_date")

    def _follow(spark: SparkSession, query_id: str, batch_id: int) -> None:
        if follower:
            fresh = _of_batch(spark, tables.transactions, schema.TRANSACTIONS_TABLE, query_id, batch_id)
            follower(fresh.select(*schema.TRANSACTION_COLUMNS), _touched(spark, query_id, batch_id), batch_id)

    stream = clocked.writeStream.option("checkpointLocation", checkpoint)
    if trigger:
        stream = stream.trigger(**trigger)
    return stream.foreachBatch(write).start()


def committed_batches(spark: SparkSession, checkpoint: str) -> int:
    """Number of the last batch that the query with this checkpoint finished; -1 if none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[0-9]*").load(f"{checkpoint}/commits")
    last = files.select(F.max(F.element_at(F.split("path", "/"), -1).cast("long"))).first()[0]
    return -1 if last is None else last
