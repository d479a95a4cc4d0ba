"""Insert-ignore, upsert, retention and the constraint report."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywatch.config import RiskConfig
from tallywatch.operators.profile import alerts
from tallywatch.operators.quality import constraint_report
from tallywatch.operators.tables import current_alerts, insert_ignore, retained, transactions_rows

from .conftest import rows_of


def test_insert_ignore_keeps_what_is_stored(transactions):
    stored = transactions([(1, 0, 1), (2, 0, 2)])
    incoming = transactions([(1, 0, 100), (2, 0, 200), (3, 0, 3), (4, 0, 4)])
    assert rows_of(insert_ignore(stored, incoming), "transaction_id", "amount") == [
        ("2", Decimal("3.00")),
        ("3", Decimal("4.00")),
    ]
    assert insert_ignore(stored, stored).count() == 0


def test_insert_ignore_takes_the_first_of_a_hot_id(transactions):
    incoming = transactions([(1, 100 - number / 10, number) for number in range(500)])
    same_id = incoming.withColumn("transaction_id", F.lit("same"))
    assert rows_of(insert_ignore(incoming.limit(0), same_id), "amount") == [(Decimal("499.00"),)]


def test_rows_as_stored_have_defaults(transactions):
    bare = transactions([(1, 0, 1)]).withColumns(
        {"transaction_id": F.lit(None).cast("string"), "currency": F.lit(None).cast("string")}
    )
    (row,) = transactions_rows(bare).collect()
    assert row.currency == "USD" and len(row.transaction_id) == 36


@pytest.fixture
def log(spark):
    columns = (
        "user_id, window_start, window_end, transaction_count, total_amount, is_fraud, alert_reason,"
        " created_at, updated_at"
    )
    versions = [
        # user, start, end, count, total, flag, reason, created, updated
        (1, "10:00", "10:01", 1, 5, 0, "Normal activity", "11:00", "11:00"),
        (1, "10:00", "10:01", 7, 9, 1, "High", "11:02", "11:02"),
        (1, "10:00", "10:01", 3, 7, 0, "Normal activity", "11:01", "11:01"),
        (1, "10:05", "10:06", 2, 2, 0, "Normal activity", "11:01", "11:01"),
        (2, "10:00", "10:01", 4, 4, 0, "Normal activity", "11:00", "11:05"),
        (2, "09:59", "10:01", 8, 8, 1, "High", "11:06", "11:06"),
    ]

    def at(clock):
        return f"2024-01-01 {clock}:00"

    text = spark.createDataFrame(
        [(u, at(a), at(b), n, total, f, r, at(c), at(d)) for u, a, b, n, total, f, r, c, d in versions],
        [name.strip() for name in columns.split(",")],
    )
    times = ("window_start", "window_end", "created_at", "updated_at")
    return text.withColumns({name: F.col(name).cast("timestamp") for name in times})


def test_upsert_replaces_values_and_keeps_first_times(log):
    shown = current_alerts(log).withColumns(
        {n: F.date_format(n, "HH:mm") for n in ("window_start", "window_end", "created_at", "updated_at")}
    )
    assert rows_of(shown, "user_id", "window_start", "window_end", "transaction_count", "is_fraud", "alert_reason",
                   "created_at", "updated_at") == [
        (1, "10:00", "10:01", 7, 1, "High", "11:00", "11:02"),
        (1, "10:05", "10:06", 2, 0, "Normal activity", "11:01", "11:01"),
        (2, "10:00", "10:01", 8, 1, "High", "11:00", "11:06"),
    ]


def test_folding_twice_changes_nothing(log):
    once = current_alerts(log)
    assert rows_of(current_alerts(once), "*") == rows_of(once, "*")


def test_retention_keeps_the_bound(transactions):
    tx = transactions([(1, 0, 1), (1, -1, 2), (1, 10**7, 3)])
    kept = retained(tx, "timestamp", "2024-01-08 12:00:00", days=7)
    assert rows_of(kept, "amount") == [(Decimal("1.00"),), (Decimal("3.00"),)]


def test_constraint_report(transactions):
    tx = transactions([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4)])
    number = F.col("transaction_id")
    dirty = tx.unionByName(tx.where(number == "0")).unionByName(tx.where(number == "0")).select(
        F.when(number != "3", number).alias("transaction_id"),
        "user_id",
        "timestamp",
        (F.col("amount").cast("decimal(12,2)") * F.when(number == "2", 10**8).otherwise(1)).alias("amount"),
        F.when(number == "1", "DOLLAR").otherwise("USD").alias("currency"),
        F.when(number == "1", F.repeat(F.lit("x"), F.lit(256))).when(number != "2", "Here").alias("city"),
        F.repeat(F.lit("y"), F.lit(100)).alias("merchant_category"),
    )
    scored = alerts(tx, RiskConfig())
    odd = scored.unionByName(scored).withColumn(
        "is_fraud", F.when(F.col("user_id") == 1, 2).when(F.col("user_id") == 2, None).otherwise(0)
    )
    report = {row[:2]: row[2] for row in rows_of(constraint_report(dirty, odd), "*")}
    assert {key: value for key, value in report.items() if value} == {
        ("transactions", "transaction_id not null"): 1,
        ("transactions", "unique (transaction_id)"): 2,
        ("transactions", "amount range"): 1,
        ("transactions", "currency length"): 1,
        ("transactions", "city length"): 1,
        ("transactions", "city not null"): 1,
        ("fraud_alerts", "is_fraud in (0, 1)"): 2,
        ("fraud_alerts", "is_fraud not null"): 2,
        ("fraud_alerts", "unique (user_id, window_end)"): 4,
    }
    assert len(report) == 22


def test_report_of_empty_tables_is_all_zero(transactions):
    empty = transactions([(1, 0, 1)]).where("false")
    report = constraint_report(empty, alerts(empty, RiskConfig())).collect()
    assert len(report) == 22 and {row.violations for row in report} == {0}
