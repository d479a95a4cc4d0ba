"""Reports from the job's rollups against the same reports from the tables."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tallywatch.config import RiskConfig
from tallywatch.plans import views
from tallywatch.sources.tables import ledger_alerts, stored_transactions
from tallywatch.streaming import rollups, sinks
from tallywatch.streaming.ledger import Tables

from .conftest import T0, message, rows_of
from .test_ledger import CFG, run  # noqa: F401
from .test_streaming import topic, traffic  # noqa: F401


def reports(spark, tables, as_of, cfg=CFG):
    """Each report from the rollups and from the tables."""
    tx, found = stored_transactions(spark, tables.transactions), ledger_alerts(spark, tables.alert_parts, cfg)
    minute = as_of.replace(second=0, microsecond=0)
    return [
        (rollups.per_minute(spark, tables.minutes, as_of), views.per_minute(tx, minute)),
        (rollups.fraud_by_city(spark, tables.alert_parts, cfg, as_of), views.fraud_by_city(tx, found, as_of)),
        (
            rollups.fraud_stats(spark, tables.stats, tables.users, tables.alert_parts, as_of),
            views.fraud_stats(found, as_of, zero_fill=True),
        ),
        (rollups.table_counts(spark, tables.minutes, tables.stats), views.table_counts(tx, found)),
    ]


def same(spark, tables, as_of):
    for rolled, direct in reports(spark, tables, as_of):
        assert rows_of(rolled, *direct.columns) == rows_of(direct, *direct.columns)
        assert not any("/transactions/" in file for file in rolled.inputFiles())


def test_reports_equal_direct_ones(spark, topic, run):  # noqa: F811
    """Late and repeated rows, alerts that turn fraudulent later, users far apart,
    hours and days that the reports cut."""
    traffic(topic)
    lines = [row.value for row in topic.batch().collect() if row.value != "{bad"]
    topic.send(lines[:60] + [message(5000 + n, 1 + n % 3, T0, 900) for n in range(12)])
    odd = [-5, 0, 1, 32767, 32768, 32769, 2**40, -(2**40)]
    topic.send([message(6000 + n, user, T0 - timedelta(hours=n), 4000, city=f"c{n % 3}") for n, user in enumerate(odd * 4)])
    tables = run()
    for hours, seconds in ((1, 0), (0.5, 30), (24, 0), (23.99, 0), (26, 1), (300, 0)):
        same(spark, tables, T0 + timedelta(hours=hours, seconds=seconds))
    stats = rollups.fraud_stats(spark, tables.stats, tables.users, tables.alert_parts, T0 + timedelta(hours=1)).first()
    assert stats.fraud_count > 10 and stats.unique_users_flagged > 20


def test_tables_without_rollups_are_taken_in(spark, topic, run, tmp_path):  # noqa: F811
    traffic(topic)
    tables = run()
    compact = Tables(str(tmp_path / "compact"))
    sinks.compact_transactions(spark, tables.transactions, compact.transactions)
    sinks.compact_parts(spark, tables.alert_parts, compact.alert_parts)
    topic.send([message(7000 + n, 3, T0 + timedelta(minutes=2), 950, city="Elsewhere") for n in range(4)])
    run(tables="compact")
    same(spark, compact, T0 + timedelta(minutes=40))


@pytest.mark.parametrize("as_of", [T0])
def test_empty_tables(spark, topic, run, as_of):  # noqa: F811
    topic.send(["{bad"])
    same(spark, run(), as_of)


def test_custom_rules_and_windows(spark, topic, run):  # noqa: F811
    from tallywatch.functions.rules import Rule

    traffic(topic)
    rules = [Rule("many", "transaction_count >= 2", "'many'")]
    tables = run(rules=rules)
    found = ledger_alerts(spark, tables.alert_parts, RiskConfig(), rules)
    stats = rollups.fraud_stats(spark, tables.stats, tables.users, tables.alert_parts, T0).first()
    assert stats.fraud_count == found.where(F.col("is_fraud") == 1).count() > 0
