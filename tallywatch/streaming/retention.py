"""Retention beside a running job.

``retire`` sets a line before which no table shows rows any more: one small file,
so all readers go from the old state to the new one at once and never see half a
day. ``purge`` then deletes the folders of whole days before the line, which no
reader opens. The day that the line cuts goes when the line has passed it.

Ids of retired transactions stay known to the job: a message that is delivered
again after its row has gone does not come back."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallywatch import schema
from tallywatch.functions.time import AsOf, as_of_column, utc_date
from tallywatch.sources.tables import optional_rows, remove, subfolders
from tallywatch.streaming.ledger import Tables


def retire(spark: SparkSession, tables: Tables, as_of: AsOf = None, days: int = 30) -> None:
    """Lets rows older than ``days`` go, by whole minutes. Lines never move back."""
    before = F.date_trunc("minute", as_of_column(as_of) - F.expr(f"INTERVAL {days} DAYS"))
    row = spark.range(1).select(before.alias("before"), F.current_timestamp().alias("retired_at"))
    row.coalesce(1).write.mode("append").parquet(tables.retired)


def purge(spark: SparkSession, tables: Tables, grace: str = "1 hour") -> list[str]:
    """Deletes the folders of days that were retired at least ``grace`` ago, when
    queries that were planned before have ended; returns them. What the job may
    still write there is not seen and goes with the next purge."""
    lines = optional_rows(spark, tables.retired, schema.RETIRED)
    if lines is None:
        return []
    old = lines.where(F.col("retired_at") <= F.current_timestamp() - F.expr(f"INTERVAL {grace}"))
    day = old.agg(utc_date(F.max("before")).cast("string")).first()[0]
    gone = []
    for table in tables.dated if day else []:
        for name in subfolders(spark, table):
            if "=" in name and name.split("=")[1] < day:
                remove(spark, f"{table}/{name}")
                gone.append(f"{table}/{name}")
    return gone
