"""Tumbling-window profiles per user, alerts, and per-transaction enrichment.

The same functions run on batch tables and on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch import schema
from tallywatch.config import RiskConfig
from tallywatch.functions.rules import Rule, default_rules, score

TIME_COLUMN = {"event": "timestamp", "ingest": "ingest_time", "processing": "processing_time"}


def with_clock(transactions: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Makes the window clock available and, on a stream, watermarks it."""
    if cfg.time_basis == "processing":
        transactions = transactions.withColumn("processing_time", F.current_timestamp())
    if transactions.isStreaming:
        return transactions.withWatermark(TIME_COLUMN[cfg.time_basis], cfg.watermark)
    return transactions


def window_column(cfg: RiskConfig) -> Column:
    return F.window(TIME_COLUMN[cfg.time_basis], cfg.window)


def _profile(clocked: DataFrame, cfg: RiskConfig, *more: Column, by: tuple[str, ...] = ()) -> DataFrame:
    return (
        clocked.groupBy("user_id", window_column(cfg).alias("window"), *by)
        .agg(F.count(F.lit(1)).alias("transaction_count"), F.sum("amount").alias("total_amount"), *more)
        .withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")})
    )


def window_profile(transactions: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Count and sum per user and window ``[window_start, window_end)``.
    Partial aggregation leaves at most one row per user, window and map task
    to shuffle, however many transactions one window holds."""
    return _profile(with_clock(transactions, cfg), cfg).select(*schema.PROFILE_COLUMNS)


def window_totals(transactions: DataFrame, cfg: RiskConfig, *more: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """The same for rows whose clock column is there already, as a part to be
    added to others, also apart ``by`` further columns; ``more`` are further
    aggregates."""
    totals = _profile(transactions, cfg, *more, by=by).drop("window")
    return totals.withColumn("total_amount", F.col("total_amount").cast(schema.TOTAL))


def alerts(transactions: DataFrame, cfg: RiskConfig, rules: list[Rule] | None = None) -> DataFrame:
    """One scored row per user and window, fraudulent or not."""
    profiles = window_profile(transactions, cfg)
    return score(profiles, rules or default_rules(cfg)).select(*schema.ALERT_COLUMNS)


def enrich(transactions: DataFrame, cfg: RiskConfig, rules: list[Rule] | None = None) -> DataFrame:
    """Every transaction with the totals and the score of its window.

    Transactions join their window's totals on (user, window, salt). In batch
    the windows that are hot, by their counts, are copied ``cfg.salts`` times and
    their transactions spread over the copies; all others have one copy, and
    salt 0. Adaptive skew join can split further, because both sides end in their
    own shuffle. A stream can't know what will be hot: see ``_stream_salted``."""
    return _enriched(with_clock(transactions, cfg), cfg, rules)


def closed_rows(transactions: DataFrame, cfg: RiskConfig) -> DataFrame:
    """The transactions of a stream, each when its window closes, with the clock
    column; all of a window's come in one micro-batch, for ``enrich_closed``.

    They wait in the state of an aggregation whose key is the whole row and that
    counts equal ones. A row is thus one entry, written once and read in order
    when windows close, and rows of a hot window lie in all partitions."""
    times = dict.fromkeys(["timestamp", TIME_COLUMN[cfg.time_basis]])
    columns = ["transaction_id", "user_id", "amount", "city", "merchant_category"]
    # Of the keys only the window may be watermarked: it says when rows leave.
    instants = [_unmarked(name).alias(name) for name in times]
    held = with_clock(transactions, cfg).groupBy(window_column(cfg).alias("window"), *columns, *instants)
    counted = held.agg(F.count(F.lit(1)).alias("copies"))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return counted.select(*columns, *times, each.alias("copy")).drop("copy")


def enrich_closed(closed: DataFrame, cfg: RiskConfig, rules: list[Rule] | None = None) -> DataFrame:
    """A micro-batch of ``closed_rows`` with the totals and the score of each
    row's window: what ``enrich`` yields for them in batch, by the same join."""
    return _enriched(closed, cfg, rules)


def _unmarked(name: str) -> Column:
    """An instant without the mark of a watermarked column."""
    return F.timestamp_micros(F.unix_micros(name))


def _enriched(clocked: DataFrame, cfg: RiskConfig, rules: list[Rule] | None) -> DataFrame:
    salted, copies = (_stream_salted if clocked.isStreaming else _salted)(clocked, cfg, rules or default_rules(cfg))

    # A stream may carry one watermarked column into the join: the window.
    instant = _unmarked("timestamp") if clocked.isStreaming else F.col("timestamp")
    rows = salted.select(
        "transaction_id", "user_id", "amount", "city", "merchant_category", instant.alias("timestamp"), "window", "salt"
    )
    return rows.join(copies, ["user_id", "window", "salt"]).select(*schema.ENRICHED_COLUMNS)


def _salt(cfg: RiskConfig) -> Column:
    return F.pmod(F.xxhash64("transaction_id", "timestamp", "amount", "city"), F.lit(cfg.salts)).cast("int")


def _salted(clocked: DataFrame, cfg: RiskConfig, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows with their window and salt, and the copies of the scored windows.

    A window is hot with more than ``cfg.hot_rows`` transactions and more than a
    ten-thousandth of all, so the hot ones that are broadcast to the rows are ten
    thousand at most. Both limits are looked up when the query runs."""
    scored = score(_profile(clocked, cfg), rules)
    every = scored.agg(F.coalesce(F.sum("transaction_count"), F.lit(0))).scalar()
    limit = F.greatest(F.lit(cfg.hot_rows).cast("double"), every / 10_000)
    hot = scored.where(F.col("transaction_count") > limit).select("user_id", "window", F.lit(True).alias("hot"))
    windowed = clocked.withColumn("window", window_column(cfg)).join(F.broadcast(hot), ["user_id", "window"], "left")
    salted = windowed.withColumn("salt", F.when(F.col("hot"), _salt(cfg)).otherwise(0))
    salts = F.when(F.col("transaction_count") > limit, F.sequence(F.lit(0), F.lit(cfg.salts - 1)))
    return salted, scored.withColumn("salt", F.explode(F.coalesce(salts, F.array(F.lit(0)))))


def _stream_salted(clocked: DataFrame, cfg: RiskConfig, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """The same where counts aren't known beforehand: every row has a salt. The
    profile keeps a bit mask of the salts its own transactions fell on and is
    copied once per set bit, so there are never more copies than transactions
    and each transaction meets exactly one. A window that holds a large share
    of all rows is thus spread over ``cfg.salts`` state partitions."""
    # Both uses must agree on the salt, so ids must not be random expressions:
    # enrich decoded transactions, not the rows made for storing.
    salted = clocked.withColumn("salt", _salt(cfg))
    mask = F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salt_mask")
    scored = score(_profile(salted, cfg, mask), rules)
    set_bits = F.filter(
        F.sequence(F.lit(0), F.lit(cfg.salts - 1)), lambda bit: F.getbit("salt_mask", bit) == 1
    )
    copies = scored.withColumn("salt", F.explode(set_bits)).drop("salt_mask")
    return salted.withColumn("window", window_column(cfg)), copies


def enrich_from_alerts(transactions: DataFrame, alerts: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Stored transactions with the totals and scores of their windows, from the
    stored alerts: the batch counterpart of a stream join, without state. Both
    sides can be cut to the same days first. Windows that ``alerts`` lacks, such
    as those that are still open, leave their transactions out."""
    rows = transactions.withColumn("_window", window_column(cfg)).withColumns(
        {"window_start": F.col("_window.start"), "window_end": F.col("_window.end")}
    )
    scored = alerts.select(*schema.ALERT_COLUMNS)
    return rows.join(scored, ["user_id", "window_start", "window_end"]).select(*schema.ENRICHED_COLUMNS)
