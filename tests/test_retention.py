"""Retention beside the running job, against the same rows filtered."""

from datetime import timedelta

from pyspark.sql import functions as F

from tallywatch.functions.parse import parse_transactions
from tallywatch.operators.profile import alerts
from tallywatch.sources.tables import closed_alerts, ledger_alerts, stored_transactions
from tallywatch.streaming import rollups
from tallywatch.streaming.retention import purge, retire

from .conftest import T0, message, rows_of
from .test_ledger import CFG, run  # noqa: F401
from .test_plans import files_read
from .test_streaming import VALUES, topic  # noqa: F401

NOW = T0 + timedelta(days=40)


def lines(first, last):
    return [message(n, n % 3, T0 + timedelta(hours=7 * n, seconds=n), 1700) for n in range(first, last)]


def test_readers_see_whole_days_or_the_line(spark, topic, run):  # noqa: F811
    topic.send(lines(0, 60))
    tables = run()
    before = (NOW - timedelta(days=30)).replace(second=0)
    retire(spark, tables, NOW)
    retire(spark, tables, NOW - timedelta(days=5))  # an older line changes nothing

    def check():
        tx, _ = parse_transactions(topic.batch().distinct())
        kept = tx.where(F.col("timestamp") >= F.lit(before))
        found = alerts(tx, CFG).where(F.col("window_end") >= F.lit(before))
        assert rows_of(stored_transactions(spark, tables.transactions), "transaction_id") == rows_of(kept, "transaction_id")
        assert rows_of(ledger_alerts(spark, tables.alert_parts), *VALUES) == rows_of(found, *VALUES) != []
        assert closed_alerts(spark, tables.closed_alerts).where(F.col("window_end") < F.lit(before)).count() == 0
        counts = dict(map(tuple, rollups.table_counts(spark, tables.minutes, tables.stats).collect()))
        assert counts == {"transactions": kept.count(), "fraud_alerts": found.where("is_fraud = 1").count()}

    check()
    every = stored_transactions(spark, tables.transactions)
    assert max(files_read(every)) < len(every.inputFiles())
    # The job goes on, and so do rows that are too late, unseen.
    topic.send(lines(55, 90) + [message(900, 1, T0, 1)])
    run()
    check()
    assert purge(spark, tables) == []  # readers of before may still be at it
    gone = purge(spark, tables, grace="0 seconds")
    assert gone and all(name.split("=")[1] < str(before.date()) for name in gone)
    assert {name.split("/")[-2] for name in gone} >= {"transactions", "alert_parts", "minutes", "stats", "users"}
    check()
    topic.send(lines(85, 100))
    run(checkpoint="other")
    check()


def test_nothing_to_purge(spark, topic, run):  # noqa: F811
    topic.send(lines(0, 3))
    tables = run()
    assert purge(spark, tables, grace="0 seconds") == []
    retire(spark, tables, T0, days=1)
    assert purge(spark, tables, grace="0 seconds") == []
    assert stored_transactions(spark, tables.transactions).count() == 3
