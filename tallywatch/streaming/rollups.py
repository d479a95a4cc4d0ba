"""Small tables from which the reports are read without transactions: parts that
each batch adds and that add up.

``minutes`` holds counts and sums per minute; ``stats`` what a batch changes in
the number of alerts, of fraudulent ones and their amount, per window end;
``users`` the flagged users of each hour as bitmaps of 32,768 ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch import schema
from tallywatch.config import RiskConfig
from tallywatch.functions.rules import Rule, default_rules, score
from tallywatch.functions.time import AsOf, as_of_column, since, utc_date
from tallywatch.sources.tables import summed_alerts, table_rows

_WINDOW = ["user_id", "window_start", "window_end"]


def minute_parts(transactions: DataFrame) -> DataFrame:
    minutes = transactions.groupBy(F.date_trunc("minute", "timestamp").alias("minute")).agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("amount").cast(schema.TOTAL).alias("total_volume")
    )
    return minutes.withColumn("event_date", utc_date(F.col("minute")))


def stats_parts(
    parts: DataFrame, others: DataFrame | None, cfg: RiskConfig, rules: list[Rule] | None = None
) -> DataFrame:
    """The change that ``parts`` make to the alerts that ``others`` add up to."""
    count, total = F.col("transaction_count"), F.col("total_amount")
    none = (F.lit(None).cast("long").alias("n0"), F.lit(None).cast(schema.TOTAL).alias("t0"))
    rows = parts.select(*_WINDOW, count.alias("n"), total.alias("t"), *none)
    if others is not None:
        keys = ["user_id", "window_end", "alert_date"]
        known = others.join(parts.select(*keys).distinct(), keys, "left_semi")
        rows = rows.unionByName(
            known.select(*_WINDOW, count.alias("n"), total.alias("t"), count.alias("n0"), total.alias("t0"))
        )
    whole = rows.groupBy(*_WINDOW).agg(*(F.sum(name).alias(name) for name in ("n", "t", "n0", "t0")))
    for name, n, t in (("before", "n0", "t0"), ("after", "n", "t")):
        scored = whole.withColumns({"transaction_count": F.col(n), "total_amount": F.col(t).cast(schema.TOTAL)})
        scored = score(scored, rules or default_rules(cfg)).withColumn(name, F.coalesce("is_fraud", F.lit(0)))
        whole = scored.withColumn(f"{name}_amount", F.when(F.col(name) == 1, F.col("total_amount")).otherwise(0))
    changes = whole.groupBy("window_end").agg(
        F.count_if(F.col("n0").isNull()).alias("alerts"),
        F.sum(F.col("after") - F.when(F.col("n0").isNull(), 0).otherwise(F.col("before"))).alias("fraud"),
        F.sum(
            F.col("after_amount") - F.when(F.col("n0").isNull(), 0).otherwise(F.col("before_amount"))
        ).cast(schema.TOTAL).alias("fraud_amount"),
    )
    return changes.withColumn("alert_date", utc_date(F.col("window_end")))


def _hour(instant: Column) -> Column:
    return F.date_trunc("hour", instant)


def user_parts(parts: DataFrame) -> DataFrame:
    hours = parts.groupBy(_hour(F.col("window_end")).alias("hour"), F.bitmap_bucket_number("user_id").alias("bucket"))
    users = hours.agg(F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("users"))
    return users.withColumn("alert_date", utc_date(F.col("hour")))


def per_minute(spark: SparkSession, minutes: str, as_of: AsOf = None, span: str = "1 hour") -> DataFrame:
    """The report of transactions per minute; ``as_of`` is rounded down to the
    minute, since minutes are not taken apart."""
    rows = table_rows(spark, minutes, schema.MINUTE_PARTS).withColumn("timestamp", F.col("minute"))
    recent = since(rows, "timestamp", F.date_trunc("minute", as_of_column(as_of)), span).groupBy("minute")
    count, total = F.sum("transaction_count"), F.sum("total_volume").cast(schema.TOTAL)
    return recent.agg(
        count.alias("transaction_count"), total.alias("total_volume"), (total.cast("double") / count).alias("avg_amount")
    )


def fraud_by_city(
    spark: SparkSession,
    alert_parts: str,
    cfg: RiskConfig,
    as_of: AsOf = None,
    span: str = "1 hour",
    rules: list[Rule] | None = None,
) -> DataFrame:
    """The city report, from the parts of the fraudulent alerts."""
    recent = since(table_rows(spark, alert_parts, schema.ALERT_PARTS), "window_end", as_of, span)
    fraud = summed_alerts(recent, cfg, rules).where(F.col("is_fraud") == 1).select(*_WINDOW)
    by_city = recent.join(fraud, _WINDOW, "left_semi").groupBy("city")
    return by_city.agg(
        F.sum("transaction_count").alias("fraud_count"), F.sum("total_amount").alias("total_fraud_amount")
    ).orderBy(F.col("fraud_count").desc(), "city")


def fraud_stats(
    spark: SparkSession, stats: str, users: str, alert_parts: str, as_of: AsOf = None, span: str = "24 hours"
) -> DataFrame:
    """The totals of the last 24 hours, sums of nothing as 0. Users are counted exactly: whole hours by
    their bitmaps, the hour that the span cuts by the alerts in it."""
    recent = since(table_rows(spark, stats, schema.STATS_PARTS), "window_end", as_of, span)
    totals = recent.agg(
        F.coalesce(F.sum("alerts"), F.lit(0)).alias("total_alerts"),
        F.coalesce(F.sum("fraud"), F.lit(0)).alias("fraud_count"),
        F.coalesce(F.sum("fraud_amount"), F.lit(0)).cast(schema.TOTAL).alias("fraud_total_amount"),
    )
    start = as_of_column(as_of) - F.expr(f"INTERVAL {span}")
    whole = F.when(_hour(start) == start, start).otherwise(_hour(start) + F.expr("INTERVAL 1 HOUR"))
    hours = table_rows(spark, users, schema.USER_PARTS)
    hours = hours.where((F.col("hour") >= whole) & (F.col("alert_date") >= utc_date(whole))).select("bucket", "users")
    cut = table_rows(spark, alert_parts, schema.ALERT_PARTS)
    cut = cut.where(F.col("alert_date").between(utc_date(start), utc_date(whole)))
    cut = cut.where((F.col("window_end") >= start) & (F.col("window_end") < whole))
    cut = cut.groupBy(F.bitmap_bucket_number("user_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("users")
    )
    flagged = hours.unionByName(cut).groupBy("bucket").agg(F.bitmap_count(F.bitmap_or_agg("users")).alias("n"))
    flagged = flagged.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("unique_users_flagged"))
    return totals.withColumn("unique_users_flagged", flagged.scalar())


def table_counts(spark: SparkSession, minutes: str, stats: str) -> DataFrame:
    """Stored transactions and fraudulent windows."""

    def counted(path: str, layout, column: str, name: str) -> DataFrame:
        total = F.coalesce(F.sum(column), F.lit(0)).alias("row_count")
        return table_rows(spark, path, layout).agg(total).select(F.lit(name).alias("table_name"), "row_count")

    transactions = counted(minutes, schema.MINUTE_PARTS, "transaction_count", "transactions")
    return transactions.unionByName(counted(stats, schema.STATS_PARTS, "fraud", "fraud_alerts"))
