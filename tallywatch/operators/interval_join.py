"""Join of transactions with the alert windows that contain them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.time import micros, utc_date


def _bin(instant: Column, width: int) -> Column:
    return F.unix_micros(instant) - F.pmod(F.unix_micros(instant), F.lit(width))


def interval_join(transactions: DataFrame, alerts: DataFrame, bin_width: str) -> DataFrame:
    """Pairs with equal user and ``window_start <= timestamp < window_end``.

    Time is cut into bins; a transaction lies in one, an alert is copied to
    each bin its window touches, and the join runs on (user, bin) with the
    bounds checked on top. The result does not depend on ``bin_width``; with
    the alerts' own window width each alert has one bin, so a busy user's
    transactions meet only the alerts of the same bin rather than all of that
    user's alerts."""
    width = micros(bin_width)
    first = _bin(F.col("window_start"), width)
    last = _bin(F.col("window_end") - F.expr("INTERVAL 1 MICROSECOND"), width)
    binned = alerts.where(F.col("window_start") < F.col("window_end")).withColumn(
        "bin", F.explode(F.sequence(first, last, F.lit(width)))
    )
    rows = transactions.withColumn("bin", _bin(F.col("timestamp"), width))
    inside = (F.col("timestamp") >= F.col("window_start")) & (F.col("timestamp") < F.col("window_end"))
    return rows.join(binned, ["user_id", "bin"]).where(inside).drop("bin")


def flagged_transactions(transactions: DataFrame, alerts: DataFrame, bin_width: str | None = None) -> DataFrame:
    """Transactions inside the given alerts' windows: with ``bin_width`` joined on
    bins of that width, without it on dyadic cells. What bounds the transaction
    scan is looked up when the query runs, so a view keeps up with its tables."""
    bounds = _bounds(alerts)
    near = _near(transactions, bounds)
    if bin_width is None:
        return _dyadic_join(near, alerts, bounds["levels"])
    return interval_join(near, alerts, bin_width)


def dyadic_join(transactions: DataFrame, alerts: DataFrame) -> DataFrame:
    """The same pairs as ``interval_join``, for windows of any widths.

    A cell of level ``n`` is a stretch of 4**n microseconds that starts at a
    multiple of its length. Each window goes to the finest level whose cells are
    no shorter than it, where it touches two cells at most. A transaction looks
    into the one cell that holds it at each level in use (one level, where all
    windows are of like width), in a single join on (user, level, cell). A very
    long window thus never multiplies the others, and a busy user's transactions
    meet only the windows near them. The levels in use are looked up when the
    query runs, from at most 32 possible ones."""
    return _dyadic_join(transactions, alerts, _bounds(alerts)["levels"])


def _dyadic_join(transactions: DataFrame, alerts: DataFrame, levels: Column) -> DataFrame:
    first = F.expr("shiftright(unix_micros(window_start), 2 * _level)")
    last = F.expr("shiftright(unix_micros(window_end) - 1, 2 * _level)")
    celled = _with_level(alerts).withColumn("_cell", F.explode(F.array_distinct(F.array(first, last))))
    rows = transactions.withColumn("_level", F.explode(levels)).withColumn(
        "_cell", F.expr("shiftright(unix_micros(timestamp), 2 * _level)")
    )
    inside = (F.col("timestamp") >= F.col("window_start")) & (F.col("timestamp") < F.col("window_end"))
    return rows.join(celled, ["user_id", "_level", "_cell"]).where(inside).drop("_level", "_cell")


def _with_level(alerts: DataFrame) -> DataFrame:
    """Windows that hold any instant, with the level of their width."""
    length = F.unix_micros("window_end") - F.unix_micros("window_start")
    level = F.ceil(F.length(F.bin(length - 1)) / 2).cast("int")
    return alerts.where(F.col("window_start") < F.col("window_end")).withColumn("_level", level)


def _bounds(alerts: DataFrame) -> Column:
    """The alerts' time range and the set of their levels, as one subquery."""
    found = _with_level(alerts).agg(
        F.struct(
            F.min("window_start").alias("earliest"),
            F.max("window_end").alias("latest"),
            F.collect_set("_level").alias("levels"),
        ).alias("bounds")
    )
    return found.scalar()


def _near(transactions: DataFrame, bounds: Column) -> DataFrame:
    """Transactions in the time range of the alerts."""
    earliest, latest = bounds["earliest"], bounds["latest"]
    near = transactions.where((F.col("timestamp") >= earliest) & (F.col("timestamp") < latest))
    if "event_date" in transactions.columns:
        near = near.where(F.col("event_date").between(utc_date(earliest), utc_date(latest)))
    return near
