"""The reporting views and the ad-hoc queries on the stored tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch import schema
from tallywatch.functions.time import AsOf, since
from tallywatch.operators.interval_join import flagged_transactions

RECENT_COLUMNS = ["user_id", "window_end", "transaction_count", "total_amount", "alert_reason"]


def _zero_if(flag: bool, total: Column) -> Column:
    return F.coalesce(total, F.lit(0).cast(schema.TOTAL)) if flag else total


def _fraud(alerts: DataFrame) -> DataFrame:
    return alerts.where(F.col("is_fraud") == 1)


def per_minute(transactions: DataFrame, as_of: AsOf = None, zero_fill: bool = False, span: str = "1 hour") -> DataFrame:
    """Transactions per minute, unordered."""
    total = F.sum("amount")
    count = F.count(F.lit(1))
    return (
        since(transactions, "timestamp", as_of, span)
        .groupBy(F.date_trunc("minute", "timestamp").alias("minute"))
        .agg(
            count.alias("transaction_count"),
            _zero_if(zero_fill, total).alias("total_volume"),
            # From the exact sum, so it does not depend on row order.
            (_zero_if(zero_fill, total).cast("double") / count).alias("avg_amount"),
        )
    )


def transactions_per_minute(
    transactions: DataFrame,
    as_of: AsOf = None,
    ascending: bool = False,
    zero_fill: bool = False,
    span: str = "1 hour",
) -> DataFrame:
    """Volume per minute of the last hour, latest minute first unless ``ascending``."""
    return per_minute(transactions, as_of, zero_fill, span).orderBy(F.col("minute").asc() if ascending else F.col("minute").desc())


def fraud_by_city(
    transactions: DataFrame,
    alerts: DataFrame,
    as_of: AsOf = None,
    span: str = "1 hour",
    bin_width: str | None = None,
) -> DataFrame:
    """Transactions inside fraudulent windows that ended in the last hour, per
    city. ``fraud_count`` counts transactions, not windows."""
    recent = _fraud(since(alerts, "window_end", as_of, span)).select("user_id", "window_start", "window_end")
    return (
        flagged_transactions(transactions, recent, bin_width)
        .groupBy("city")
        .agg(F.count(F.lit(1)).alias("fraud_count"), F.sum("amount").alias("total_fraud_amount"))
        .orderBy(F.col("fraud_count").desc(), "city")
    )


def fraud_stats(
    alerts: DataFrame,
    as_of: AsOf = None,
    zero_fill: bool = False,
    span: str = "24 hours",
    approx: bool = False,
) -> DataFrame:
    """One row of totals for the last 24 hours. ``total_alerts`` and
    ``unique_users_flagged`` cover all windows, fraudulent or not."""
    fraud = F.col("is_fraud") == 1
    users = F.approx_count_distinct("user_id") if approx else F.count_distinct("user_id")
    return since(alerts, "window_end", as_of, span).agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(fraud).alias("fraud_count"),
        _zero_if(zero_fill, F.sum(F.when(fraud, F.col("total_amount")))).alias("fraud_total_amount"),
        users.alias("unique_users_flagged"),
    )


def recent_alerts(alerts: DataFrame, n: int = 20, columns: list[str] | None = RECENT_COLUMNS) -> DataFrame:
    """The ``n`` latest fraudulent windows; equal ends are ordered by user.
    ``columns=None`` keeps every column."""
    latest = _fraud(alerts).orderBy(F.col("window_end").desc(), F.col("user_id").asc()).limit(n)
    return latest.select(*columns) if columns else latest


def sample_alerts(alerts: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` fraudulent windows, in no particular order."""
    return _fraud(alerts).limit(n)


def table_counts(transactions: DataFrame, alerts: DataFrame) -> DataFrame:
    """Stored transactions and fraudulent windows."""

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")

    return counted(transactions, "transactions").unionByName(counted(_fraud(alerts), "fraud_alerts"))


def register_views(
    spark: SparkSession,
    transactions: DataFrame | str,
    alerts: DataFrame | str,
    as_of: AsOf = None,
    bin_width: str | None = None,
) -> None:
    """Temp views of the two tables and of the three reports for ``spark.sql``.
    Without ``as_of`` they follow the clock, like any view on the current time.

    Given two tables of the catalog by name, the views are kept as SQL text, so
    that each query on them sees what the tables hold by then, however often they
    have been written to. Views of DataFrames keep the files that those list."""
    if isinstance(transactions, str) and isinstance(alerts, str):
        if isinstance(as_of, Column) or bin_width is not None:
            raise ValueError("views of named tables take as_of as a time or its text, and no bin_width")
        for name, query in _named_views(transactions, alerts, as_of).items():
            spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {query}")
        return
    views = {
        "transactions": transactions,
        "fraud_alerts": alerts,
        "transactions_per_minute": transactions_per_minute(transactions, as_of),
        "fraud_by_city": fraud_by_city(transactions, alerts, as_of, bin_width=bin_width),
        "fraud_stats_24h": fraud_stats(alerts, as_of),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)


def _named_views(transactions: str, alerts: str, as_of: str | datetime | None) -> dict[str, str]:
    """The same views as SQL; the join is that of ``dyadic_join``."""
    now = "current_timestamp()" if as_of is None else f"TIMESTAMP'{as_of}'"
    level = "CAST(ceil(length(bin(unix_micros(window_end) - unix_micros(window_start) - 1)) / 2) AS INT)"
    return {
        "transactions": f"SELECT * FROM {transactions}",
        "fraud_alerts": f"SELECT * FROM {alerts}",
        "transactions_per_minute": f"""
            SELECT date_trunc('MINUTE', timestamp) AS minute, count(*) AS transaction_count,
                   sum(amount) AS total_volume, CAST(sum(amount) AS DOUBLE) / count(*) AS avg_amount
            FROM {transactions} WHERE timestamp >= {now} - INTERVAL 1 HOUR GROUP BY 1 ORDER BY minute DESC""",
        "fraud_by_city": f"""
            WITH recent AS (
                SELECT user_id, window_start, window_end, {level} AS level FROM {alerts}
                WHERE is_fraud = 1 AND window_end >= {now} - INTERVAL 1 HOUR AND window_start < window_end),
            bounds AS (
                SELECT min(window_start) AS earliest, max(window_end) AS latest, collect_set(level) AS levels
                FROM recent),
            cells AS (
                SELECT *, explode(array_distinct(array(shiftright(unix_micros(window_start), 2 * level),
                                                       shiftright(unix_micros(window_end) - 1, 2 * level)))) AS cell
                FROM recent),
            probes AS (
                SELECT user_id, timestamp, amount, city, explode((SELECT levels FROM bounds)) AS level
                FROM {transactions}
                WHERE timestamp >= (SELECT earliest FROM bounds) AND timestamp < (SELECT latest FROM bounds))
            SELECT city, count(*) AS fraud_count, sum(amount) AS total_fraud_amount
            FROM (SELECT *, shiftright(unix_micros(timestamp), 2 * level) AS cell FROM probes)
            JOIN cells USING (user_id, level, cell)
            WHERE timestamp >= window_start AND timestamp < window_end
            GROUP BY city ORDER BY fraud_count DESC, city""",
        "fraud_stats_24h": f"""
            SELECT count(*) AS total_alerts, count_if(is_fraud = 1) AS fraud_count,
                   sum(CASE WHEN is_fraud = 1 THEN total_amount END) AS fraud_total_amount,
                   count(DISTINCT user_id) AS unique_users_flagged
            FROM {alerts} WHERE window_end >= {now} - INTERVAL 24 HOURS""",
    }
