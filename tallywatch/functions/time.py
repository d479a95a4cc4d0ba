"""Time helpers shared by the reports."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = str | datetime | Column | None

# Partition column of each time column in the stored layouts.
DATE_OF = {"timestamp": "event_date", "window_end": "alert_date"}


def as_of_column(as_of: AsOf) -> Column:
    """The report's "now": a timestamp literal, or the query's start time."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def utc_date(instant: Column) -> Column:
    """Calendar day in UTC, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))


def since(rows: DataFrame, column: str, as_of: AsOf, span: str) -> DataFrame:
    """Rows no older than ``span`` before ``as_of``. The bound is inclusive and
    there is no upper bound, so future-dated rows stay. On a stored table the
    bound is repeated on the date partition so that whole days are skipped."""
    start = as_of_column(as_of) - F.expr(f"INTERVAL {span}")
    kept = rows.where(F.col(column) >= start)
    if DATE_OF.get(column) in rows.columns:
        kept = kept.where(F.col(DATE_OF[column]) >= utc_date(start))
    return kept


def micros(width: str) -> int:
    """Length of a fixed interval such as ``1 minute`` in microseconds."""
    return pd.Timedelta(width).value // 1000
