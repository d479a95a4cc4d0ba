"""Display formats of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(amount: Column) -> Column:
    """Nearest whole number, halves toward positive infinity (-2.5 gives -2)."""
    return F.floor(amount + F.lit(0.5).cast("decimal(2,1)")).cast("bigint")


def currency(amount: Column) -> Column:
    """Whole dollars with thousands separators: ``$1,235``, ``-$50``."""
    dollars = F.format_number(F.round(F.abs(amount), 0), 0)
    return F.concat(F.when(amount < 0, F.lit("-$")).otherwise(F.lit("$")), dollars)


def clock_time(instant: Column) -> Column:
    """Two-digit 12-hour time in the session time zone: ``03:05 PM``."""
    return F.date_format(instant, "hh:mm a")
