"""Risk rules over window profiles."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.config import RiskConfig

# Fixed texts of the alerts.
HIGH_AMOUNT = "High total amount: $"
HIGH_COUNT = "High transaction count: "
NORMAL = "Normal activity"
FEED_PREFIX = "🚨 FRAUD ALERT: User "


@dataclass(frozen=True)
class Rule:
    """A named condition on a window profile and the text it contributes.
    Both are Columns or SQL expressions over the profile's columns."""

    name: str
    predicate: Column | str
    message: Column | str


def _column(expression: Column | str) -> Column:
    return F.expr(expression) if isinstance(expression, str) else expression


def default_rules(cfg: RiskConfig) -> list[Rule]:
    """High total amount, then high count. Both limits are strict."""
    total = F.col("total_amount").cast("decimal(20,2)")
    return [
        Rule(
            "high_amount",
            F.col("total_amount") > F.lit(cfg.amount_threshold),
            F.concat(F.lit(HIGH_AMOUNT), total.cast("string")),
        ),
        Rule(
            "high_count",
            F.col("transaction_count") > F.lit(cfg.count_threshold),
            F.concat(F.lit(HIGH_COUNT), F.col("transaction_count").cast("string")),
        ),
    ]


def score(profiles: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``is_fraud`` (1 when any rule holds) and ``alert_reason`` (the
    texts of the rules that hold, in rule order)."""
    fired = [F.coalesce(_column(rule.predicate), F.lit(False)) for rule in rules]
    any_fired = reduce(Column.__or__, fired, F.lit(False))
    texts = [F.when(hit, _column(rule.message)) for hit, rule in zip(fired, rules)]
    return profiles.withColumns(
        {
            "is_fraud": any_fired.cast("int"),
            "alert_reason": F.when(any_fired, F.concat_ws("; ", *texts)).otherwise(F.lit(NORMAL)),
        }
    )


def alert_feed(alerts: DataFrame) -> DataFrame:
    """One line per fraudulent window."""
    line = F.concat(F.lit(FEED_PREFIX), F.col("user_id").cast("string"), F.lit(" - "), F.col("alert_reason"))
    return alerts.where(F.col("is_fraud") == 1).select("user_id", "window_end", line.alias("message"))
