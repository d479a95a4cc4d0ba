"""Checks of the declared table constraints as one report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch import schema

AMOUNT_LIMIT = 10**8  # DECIMAL(10,2) holds less than this


def _rules_of_transactions() -> dict[str, Column]:
    return {
        **{f"{name} not null": F.col(name).isNull() for name in schema.TRANSACTION_COLUMNS},
        "currency length": F.length("currency") > schema.MAX_CURRENCY,
        "city length": F.length("city") > schema.MAX_CITY,
        "merchant_category length": F.length("merchant_category") > schema.MAX_CATEGORY,
        "amount range": F.abs("amount") >= AMOUNT_LIMIT,
    }


def _rules_of_alerts() -> dict[str, Column]:
    return {
        **{f"{name} not null": F.col(name).isNull() for name in schema.ALERT_COLUMNS},
        "is_fraud in (0, 1)": ~F.col("is_fraud").isin(0, 1),
        "total_amount range": F.abs("total_amount") >= AMOUNT_LIMIT,
    }


def _counts(rows: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """All row rules in one pass over the table."""
    counts = rows.agg(*(F.count_if(broken).alias(rule) for rule, broken in rules.items()))
    return counts.unpivot([], list(rules), "rule", "violations").select(F.lit(table).alias("table_name"), "*")


def _surplus(rows: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Rows beyond the first per key. Keys with a NULL are never equal."""
    complete = rows.dropna(subset=keys)
    return (
        complete.groupBy(*keys)
        .count()
        .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("violations"))
        .select(F.lit(table).alias("table_name"), F.lit(f"unique ({', '.join(keys)})").alias("rule"), "violations")
    )


def constraint_report(transactions: DataFrame, alerts: DataFrame) -> DataFrame:
    """Violations per table and constraint, zero included."""
    return (
        _counts(transactions, "transactions", _rules_of_transactions())
        .unionByName(_surplus(transactions, "transactions", ["transaction_id"]))
        .unionByName(_counts(alerts, "fraud_alerts", _rules_of_alerts()))
        .unionByName(_surplus(alerts, "fraud_alerts", ["user_id", "window_end"]))
    )
