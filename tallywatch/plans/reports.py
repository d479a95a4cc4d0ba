"""Display projections and the snapshot document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.formatting import clock_time, currency, round_half_up
from tallywatch.functions.time import AsOf, as_of_column
from tallywatch.plans.views import fraud_stats, per_minute, recent_alerts

JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "ignoreNullFields": "false"}
FULL_PROGRESS = 100  # fraud cases that fill the progress bar


def chart_series(minutes: DataFrame) -> DataFrame:
    """Chart points from the per-minute report; ``minute`` carries the order."""
    return minutes.select(
        "minute",
        clock_time(F.col("minute")).alias("time"),
        F.col("transaction_count").alias("transactions"),
        round_half_up(F.col("total_volume")).alias("volume"),
    )


def kpi_cards(stats: DataFrame) -> DataFrame:
    """The four headline figures and the progress bar, missing values as 0."""

    def figure(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    return stats.select(
        figure("fraud_count").alias("fraud_detected"),
        currency(figure("fraud_total_amount")).alias("fraud_amount"),
        figure("total_alerts").alias("total_alerts"),
        figure("unique_users_flagged").alias("users_flagged"),
        F.least(figure("fraud_count") / F.lit(FULL_PROGRESS) * 100, F.lit(100.0)).alias("progress"),
    )


def recent_alerts_display(recent: DataFrame) -> DataFrame:
    """Table rows of the recent alerts; ``window_end`` carries the order."""
    return recent.select(
        "window_end",
        F.concat(F.lit("#"), F.col("user_id").cast("string")).alias("user"),
        currency(F.col("total_amount")).alias("amount"),
        F.col("transaction_count").alias("transactions"),
        clock_time(F.col("window_end")).alias("time"),
    )


def _latest_first(left: Column, right: Column) -> Column:
    return (
        F.when(left["window_end"] > right["window_end"], -1)
        .when(left["window_end"] < right["window_end"], 1)
        .when(left["user_id"] < right["user_id"], -1)
        .when(left["user_id"] > right["user_id"], 1)
        .otherwise(0)
    )


def stats_snapshot(transactions: DataFrame, alerts: DataFrame, as_of: AsOf = None) -> DataFrame:
    """One row: totals, the minutes of the last hour and the 20 latest alerts,
    all as of one instant, plus the whole as a JSON ``document``.

    The parts are scalar subqueries of one query. The arrays hold report rows,
    one per minute since ``as_of`` minus an hour and at most 20 alerts, never
    table rows."""
    now = as_of_column(as_of)
    stats = fraud_stats(alerts, now, zero_fill=True).select(F.struct("*"))
    minutes = per_minute(transactions, now, zero_fill=True).select(
        F.array_sort(F.collect_list(F.struct("minute", "transaction_count", "total_volume", "avg_amount")))
    )
    latest = recent_alerts(alerts)
    latest = latest.select(F.array_sort(F.collect_list(F.struct(*latest.columns)), _latest_first))
    parts = transactions.sparkSession.range(1).select(
        stats.scalar().alias("fraudStats"),
        minutes.scalar().alias("transactionsPerMinute"),
        latest.scalar().alias("recentAlerts"),
        now.alias("timestamp"),
    )
    return parts.withColumn("document", F.to_json(F.struct("*"), JSON_OPTIONS))
