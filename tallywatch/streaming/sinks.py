"""Writers called once per micro-batch, and their maintenance."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch import schema
from tallywatch.config import JobConfig
from tallywatch.functions.time import AsOf
from tallywatch.operators.tables import current_alerts, retained
from tallywatch.sources.tables import COMPACTED, alerts_log, jdbc_properties, table_rows

BatchWriter = Callable[[DataFrame, int], None]

JDBC_BATCH = {"transactions": 100, "fraud_alerts": 50}
CONFLICT_KEYS = {"transactions": ["transaction_id"], "fraud_alerts": ["user_id", "window_end"]}
INSERT_COLUMNS = {"transactions": schema.TRANSACTION_COLUMNS, "fraud_alerts": schema.ALERT_COLUMNS}
# Columns a second write of the same key replaces; the others keep their first
# value. Where there are none, the second write is ignored.
REPLACED = {
    "transactions": [],
    "fraud_alerts": ["transaction_count", "total_amount", "is_fraud", "alert_reason"],
}


def append_batch(path: str, *partition_by: str) -> BatchWriter:
    """Sink for a table of files. A micro-batch owns the folders named after the
    query (whose id lives in its checkpoint) and the batch, below the date, and
    replaces them when retried: each batch is stored once however often it runs,
    and a query with a new checkpoint never touches what an older one wrote."""

    def write(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if query_id is None:
            raise RuntimeError("append_batch must be called by a streaming query")
        owned = batch.withColumns({"query_id": F.lit(query_id), "batch_id": F.lit(batch_id).cast("long")})
        writer = owned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partition_by, "query_id", "batch_id").parquet(path)

    return write


def merge_batch(table: str) -> BatchWriter:
    """Sink for an alerts table in a format with row-level updates: replaces
    the values of known alerts and keeps their first start and creation time.
    None of the bundled formats supports it, so the tests check only that the
    statement resolves."""

    def write(batch: DataFrame, batch_id: int) -> None:
        same = [F.col(f"{table}.{key}") == F.col(f"new.{key}") for key in CONFLICT_KEYS["fraud_alerts"]]
        values = {name: F.col(f"new.{name}") for name in [*REPLACED["fraud_alerts"], "updated_at"]}
        merge = batch.alias("new").mergeInto(table, reduce(Column.__and__, same))
        merge.whenMatched().update(values).whenNotMatched().insertAll().merge()

    return write


ROW_GROUP = 32 << 20  # bytes
RANKS = 8  # bits for each side of the curve


def _rewrite(
    rows: DataFrame, target: str, date: str, *order: str, curve: Column | None = None, **options: object
) -> None:
    """Stores ``rows`` in a new folder, in files of even size however many rows
    one date holds, sorted so that filters skip row groups. With a ``curve`` rows
    are dealt by its stretches and sorted along it first."""
    place, stretch = "_place", "_stretch"
    keyed = rows if curve is None else rows.withColumn(place, curve).withColumn(stretch, F.shiftright(place, 2 * RANKS - 6))
    dealt = [date] if curve is None else [date, stretch]
    along = list(order) if curve is None else [date, place, *order]
    even = keyed.hint("rebalance", *dealt).sortWithinPartitions(*along).drop(place, stretch)
    owned = even.withColumns({"query_id": F.lit(COMPACTED), "batch_id": F.lit(0).cast("long")})
    writer = owned.write.options(**{"parquet.block.size": ROW_GROUP, **options})
    writer.partitionBy(date, "query_id", "batch_id").parquet(target)


def user_time_curve(rows: DataFrame, user: str = "user_id", instant: str = "timestamp") -> Column:
    """A place on a curve through users and times of day: the bits of the user's
    rank and of the time, taken in turns, so that rows that are near in both lie
    together. Ranks come from 255 quantiles of the users, looked up first."""
    shares = [(n + 1) / (1 << RANKS) for n in range((1 << RANKS) - 1)]
    cuts = rows.agg(F.percentile_approx(user, shares, 10_000).alias("cuts")).first()["cuts"] or []
    bounds = F.array(*(F.lit(cut) for cut in sorted(set(cuts)))) if cuts else F.array(F.lit(0))
    rank = F.size(F.filter(bounds, lambda bound: bound < F.col(user)))
    second = F.pmod(F.unix_seconds(instant), F.lit(86400))
    time = F.floor(second * (1 << RANKS) / 86400).cast("int")
    place = F.lit(0)
    for bit in range(RANKS):
        for side, value in ((1, rank), (0, time)):
            taken = F.shiftright(value, bit).bitwiseAND(F.lit(1))
            place = place.bitwiseOR(F.shiftleft(taken, 2 * bit + side))
    return place


def _committed(rows: DataFrame, upto: dict[str, int] | None) -> DataFrame:
    """Rows of finished batches: up to the given batch of each given query."""
    if upto is None:
        return rows
    done = F.lit(False)
    for query_id, batch_id in upto.items():
        done = done | ((F.col("query_id") == query_id) & (F.col("batch_id") <= batch_id))
    return rows.where(done | (F.col("query_id") == COMPACTED))


def compact_alerts(
    spark: SparkSession,
    source: str,
    target: str,
    keep_days: int | None = None,
    as_of: AsOf = None,
    upto: dict[str, int] | None = None,
) -> None:
    """Folds an alert log into one version per alert under ``target``, a new
    path, leaving out windows that ended more than ``keep_days`` ago. A
    streaming query can go on appending there."""
    rows = current_alerts(_committed(alerts_log(spark, source), upto))
    kept = rows if keep_days is None else retained(rows, "window_end", as_of, keep_days)
    _rewrite(kept, target, "alert_date", "window_end", "user_id")


def compact_parts(
    spark: SparkSession,
    source: str,
    target: str,
    keep_days: int | None = None,
    as_of: AsOf = None,
    upto: dict[str, int] | None = None,
) -> None:
    """Adds up the alert parts under ``target``, a new path, to one part per
    alert and city, leaving out windows that ended more than ``keep_days`` ago."""
    log = _committed(table_rows(spark, source, schema.ALERT_PARTS), upto)
    rows = log.groupBy("user_id", "window_start", "window_end", "city", "alert_date").agg(
        F.sum("transaction_count").alias("transaction_count"),
        F.sum("total_amount").cast(schema.TOTAL).alias("total_amount"),
        F.max("written_at").alias("written_at"),
    )
    kept = rows if keep_days is None else retained(rows, "window_end", as_of, keep_days)
    _rewrite(kept, target, "alert_date", "window_end", "user_id")


def compact_transactions(
    spark: SparkSession,
    source: str,
    target: str,
    keep_days: int | None = None,
    as_of: AsOf = None,
    upto: dict[str, int] | None = None,
    row_group: int = ROW_GROUP,
) -> None:
    """Rewrites the transactions table under ``target``, a new path, leaving
    out transactions older than ``keep_days``. Rows of a date follow a curve
    through users and times, in row groups of ``row_group`` bytes, and ids have
    Bloom filters: look-ups of a user, an hour or an id skip most row groups.

    To compact the tables of a running job: stop it, compact each table with
    ``upto`` (query id and last committed batch), and start it on the new folder
    with the same checkpoint. A batch that was written but not committed is left
    out here and written again by the job."""
    rows = _committed(table_rows(spark, source, schema.TRANSACTIONS_TABLE), upto).drop("query_id", "batch_id")
    kept = rows if keep_days is None else retained(rows, "timestamp", as_of, keep_days)
    blooms = {"parquet.bloom.filter.enabled#transaction_id": "true", "parquet.block.size": row_group}
    _rewrite(kept, target, "event_date", "user_id", "timestamp", curve=user_time_curve(kept), **blooms)


def staging_table(table: str, run: str, batch_id: int) -> str:
    """A name that no other job, run or batch uses."""
    return f"{table}_staging_{run[:12]}_{batch_id}"


def merge_statement(table: str, staging: str) -> str:
    """One SQL statement that moves staged rows into ``table``: insert-ignore
    for transactions, upsert for alerts."""
    columns = ", ".join(INSERT_COLUMNS[table])
    values = columns.replace("transaction_id", "CAST(transaction_id AS UUID)")
    keys = ", ".join(CONFLICT_KEYS[table])
    updates = ", ".join(f"{name} = EXCLUDED.{name}" for name in REPLACED[table])
    action = f"DO UPDATE SET {updates}" if updates else "DO NOTHING"
    return f"INSERT INTO {table} ({columns}) SELECT {values} FROM {staging} ON CONFLICT ({keys}) {action}"


UUID = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
TRIES = 3


def database_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that the database's columns can hold, and the rest with a reason.
    An id that is no UUID is replaced by one made from it."""
    reasons = F.when(~F.col("user_id").between(-(2**31), 2**31 - 1), "user_out_of_range")
    if "transaction_id" in rows.columns:
        digest = F.md5(F.col("transaction_id"))
        parts = [F.substring(digest, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        known = F.rlike(F.col("transaction_id"), F.lit(UUID))
        rows = rows.withColumn("transaction_id", F.when(known, F.col("transaction_id")).otherwise(F.concat_ws("-", *parts)))
        for name in ("city", "merchant_category", "currency"):
            reasons = reasons.when(F.contains(F.col(name), F.lit("\0")), f"nul_in_{name}")
    else:
        reasons = reasons.when(F.col("total_amount") >= 10**8, "total_out_of_range")
        reasons = reasons.when(F.col("transaction_count") >= 2**31, "count_out_of_range")
    judged = rows.withColumn("reject_reason", reasons)
    fine = judged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return fine, judged.where(F.col("reject_reason").isNotNull())


# Classes of SQL states that may pass: connection, rolled back, out of resources, operator's doing.
PASSING_STATES = ("08", "40", "53", "57")


def may_pass(error: BaseException) -> bool:
    """Whether an action that failed so is worth another try: lost connections
    and the like, but no statement that the database refuses."""
    if isinstance(error, OSError):
        return True
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        kind = cause.getClass()
        names = []
        while kind is not None:
            names.append(kind.getName())
            kind = kind.getSuperclass()
        if {"java.sql.SQLTransientException", "java.sql.SQLRecoverableException", "java.io.IOException"} & set(names):
            return True
        if "java.sql.SQLException" in names:
            return (cause.getSQLState() or "").startswith(PASSING_STATES)
        cause = cause.getCause()
    return False


def retried(action: Callable[[], None], tries: int = TRIES, wait: float = 1.0) -> None:
    """Runs a repeatable action until it succeeds, ``tries`` times at most, with
    growing pauses. Errors that another try can't mend are raised at once."""
    for attempt in range(1, tries + 1):
        try:
            return action()
        except Exception as error:
            if attempt == tries or not may_pass(error):
                raise
            time.sleep(wait * attempt)


def _execute(spark: SparkSession, job: JobConfig, statement: str) -> None:
    properties = jdbc_properties(job)
    jvm = spark.sparkContext._jvm
    jvm.java.lang.Class.forName(properties["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(
        job.jdbc_url, properties["user"], properties["password"]
    )
    try:
        connection.createStatement().execute(statement)
    finally:
        connection.close()


def jdbc_merge(job: JobConfig, table: str, rejects: str | None = None) -> BatchWriter:
    """Sink for a database table: executors write the batch to a staging table of
    its own with batched inserts, then one statement merges it and the staging
    table goes. The steps can be repeated, and are tried three times. Rows that the database can't hold go
    to the folder ``rejects``. Needs the database's JDBC driver, so the tests cover only the
    statement."""

    def write(batch: DataFrame, batch_id: int) -> None:
        staging = staging_table(table, uuid.uuid4().hex, batch_id)
        fine, odd = database_rows(batch.select(*INSERT_COLUMNS[table]))
        writer = fine.write.mode("overwrite").options(batchsize=JDBC_BATCH[table], truncate=True)
        retried(lambda: writer.jdbc(job.jdbc_url, staging, properties=jdbc_properties(job)))
        retried(lambda: _execute(batch.sparkSession, job, merge_statement(table, staging)))
        retried(lambda: _execute(batch.sparkSession, job, f"DROP TABLE IF EXISTS {staging}"))
        if rejects:
            owned = odd.withColumn("batch_id", F.lit(batch_id).cast("long"))
            dynamic = owned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            dynamic.partitionBy("batch_id").parquet(rejects)

    return write
