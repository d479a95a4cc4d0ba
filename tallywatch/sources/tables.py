"""Scans of the stored tables."""

from __future__ import annotations

import posixpath
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch import schema
from tallywatch.config import JobConfig, RiskConfig
from tallywatch.functions.rules import Rule, default_rules, score
from tallywatch.functions.time import utc_date
from tallywatch.operators.tables import current_alerts

POSTGRES_DRIVER = "org.postgresql.Driver"


COMPACTED = "compacted"  # stands for the query where compaction wrote rows


def optional_rows(
    spark: SparkSession, path: str, layout: T.StructType, wanted: str | list[str] | None = None
) -> DataFrame | None:
    """Rows of the files below ``path``, or of those ``wanted`` among them; None
    if there are no such folders."""
    places = [wanted] if isinstance(wanted, str) else wanted or [path]
    try:
        return spark.read.schema(layout).option("basePath", path).parquet(*places)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, wherever Spark can reach it."""
    files, place = _place(spark, path)
    files.delete(place, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    files, place = _place(spark, path)
    return [one.getPath().getName() for one in files.listStatus(place)] if files.exists(place) else []


def batch_marks(spark: SparkSession, path: str) -> DataFrame | None:
    """The marks of whole batches beside a table of files; None where the table's
    writer sets none. A mark is set after everything else of its batch, so files
    have to be listed after the marks."""
    return optional_rows(spark, f"{posixpath.dirname(path)}/batches", schema.BATCH_MARKS)


def marked(rows: DataFrame, marks: DataFrame | None) -> DataFrame:
    """Rows of batches that reached every table, and those that compaction wrote.
    The rows of a batch that was cut short stay unseen."""
    if marks is None:
        return rows
    compacted = rows.sparkSession.range(1).select(F.lit(COMPACTED).alias("query_id"), F.col("id").alias("batch_id"))
    whole = marks.select("query_id", "batch_id").unionByName(compacted)
    return rows.join(whole, ["query_id", "batch_id"], "left_semi").select(*rows.columns)


def _time_of(layout: T.StructType) -> Column | None:
    """The time by which rows of a table of the job grow old."""
    names = layout.fieldNames()
    if "hour" in names:
        return F.col("hour") + F.expr("INTERVAL 1 HOUR")
    for name in ("timestamp", "window_end", "minute"):
        if name in names:
            return F.col(name)
    return None


def unretired(rows: DataFrame, path: str, layout: T.StructType) -> DataFrame:
    """Rows that ``retire`` has left: the latest line is looked up when the query
    runs, and days before it are not read."""
    retired = optional_rows(rows.sparkSession, f"{posixpath.dirname(path)}/retired", schema.RETIRED)
    time = _time_of(layout)
    if retired is None or time is None:
        return rows
    before = retired.agg(F.coalesce(F.max("before"), F.lit("0001-01-01").cast("timestamp")).alias("before")).scalar()
    return rows.where((F.col(layout.fieldNames()[-1]) >= utc_date(before)) & (time >= before))


def table_rows(
    spark: SparkSession, path: str, layout: T.StructType, days: tuple[date, date] | list[date] | None = None
) -> DataFrame:
    """Rows of a table of files, with its partition columns; a table without
    files yet has none. With ``days`` (first and last, or a list) only the folders of those
    dates are listed, which needs the layout with date folders outermost. Where
    batches are marked, only whole ones are seen, and where rows have been
    retired, only later ones."""
    wanted = None
    if days is not None:
        if isinstance(days, tuple):
            days = [days[0] + timedelta(n) for n in range((days[1] - days[0]).days + 1)]
        names = ",".join(map(str, days)) or "none"
        wanted = f"{path}/{layout.fieldNames()[-1]}={{{names}}}"
    marks = batch_marks(spark, path)
    rows = optional_rows(spark, path, layout, wanted)
    if rows is None:
        return spark.createDataFrame([], layout)
    return marked(unretired(rows, path, layout), marks)


def unmarked_rows(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """All rows of a table of files, those of unfinished batches too."""
    rows = optional_rows(spark, path, layout)
    return spark.createDataFrame([], layout) if rows is None else rows


def stored_transactions(spark: SparkSession, path: str, days: tuple[date, date] | None = None) -> DataFrame:
    """The transactions table; ``event_date`` is a partition column."""
    return table_rows(spark, path, schema.TRANSACTIONS_TABLE, days).drop("query_id", "batch_id")


def stored_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The messages that the job could not decode."""
    return table_rows(spark, path, schema.QUARANTINE).select("value", "reject_reason")


def stored_feed(spark: SparkSession, path: str, days: tuple[date, date] | None = None) -> DataFrame:
    """The feed lines that the job wrote; ``alert_date`` is a partition column."""
    return table_rows(spark, path, schema.FEED, days).drop("query_id", "batch_id")


def summed_alerts(parts: DataFrame, cfg: RiskConfig, rules: list[Rule] | None = None) -> DataFrame:
    """Alerts from their parts: counts and sums add up, then are scored."""
    totals = parts.groupBy("user_id", "window_start", "window_end", "alert_date").agg(
        F.sum("transaction_count").alias("transaction_count"),
        F.sum("total_amount").cast(schema.TOTAL).alias("total_amount"),
        F.min("written_at").alias("created_at"),
        F.max("written_at").alias("updated_at"),
    )
    return score(totals, rules or default_rules(cfg))


def ledger_alerts(
    spark: SparkSession,
    path: str,
    cfg: RiskConfig = RiskConfig(),
    rules: list[Rule] | None = None,
    days: tuple[date, date] | None = None,
) -> DataFrame:
    """The alerts of a table of parts, as the job writes them; ``alert_date``
    is a partition column."""
    return summed_alerts(table_rows(spark, path, schema.ALERT_PARTS, days), cfg, rules)


def closed_alerts(spark: SparkSession, path: str, days: tuple[date, date] | None = None) -> DataFrame:
    """The alerts of closed windows as the job emitted them: each once, or as its
    last correction has it; ``alert_date`` is a partition column."""
    emitted = table_rows(spark, path, schema.CLOSED_ALERTS, days)
    values = F.struct("transaction_count", "total_amount", "is_fraud", "alert_reason", "correction")
    last = emitted.groupBy("user_id", "window_start", "window_end", "alert_date").agg(
        F.max_by(values, "version").alias("last")
    )
    return last.select("user_id", "window_start", "window_end", "last.*", "alert_date")


def latest_days(
    spark: SparkSession,
    path: str,
    n: int,
    first: date,
    last: date,
    cfg: RiskConfig = RiskConfig(),
    rules: list[Rule] | None = None,
) -> tuple[date, date]:
    """Those of the days from ``first`` to ``last`` that hold the ``n`` latest
    fraudulent alerts of a table of parts. An alert's parts share their date, so
    no alert is missed by going back from the last day until the days so far
    have ``n``; each step doubles their number and opens their folders only."""
    span = 1
    while True:
        start = max(first, last - timedelta(span - 1))
        found = ledger_alerts(spark, path, cfg, rules, (start, last)).where(F.col("is_fraud") == 1)
        if start == first or found.limit(n).count() == n:
            return start, last
        span *= 2


def alerts_log(spark: SparkSession, path: str) -> DataFrame:
    """Every version of every alert; ``alert_date`` is a partition column."""
    return table_rows(spark, path, schema.ALERTS_LOG)


def stored_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The alerts table: the current version of every alert."""
    return current_alerts(alerts_log(spark, path))


def jdbc_properties(job: JobConfig) -> dict[str, str]:
    return {"user": job.jdbc_user, "password": job.jdbc_password, "driver": POSTGRES_DRIVER}


def jdbc_table(
    spark: SparkSession,
    job: JobConfig,
    table: str,
    slices: list[str] | None = None,
) -> DataFrame:
    """A table in the database, read in parallel with one query per predicate
    in ``slices`` (they must cover every row once). Filters are pushed to the
    database. Needs the database's JDBC driver, so the tests do not run it."""
    if slices:
        return spark.read.jdbc(job.jdbc_url, table, predicates=slices, properties=jdbc_properties(job))
    return spark.read.jdbc(job.jdbc_url, table, properties=jdbc_properties(job))
