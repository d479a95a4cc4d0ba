"""Windows of the wall clock on a stream that falls silent."""

import time
from decimal import Decimal

import pytest

from tallywatch.config import RiskConfig
from tallywatch.sources.tables import stored_alerts
from tallywatch.streaming.idle import clock_windows, start_clock_alerts_query

from .conftest import T0, message, rows_of
from .test_streaming import topic  # noqa: F401

VALUES = ["user_id", "transaction_count", "total_amount", "is_fraud"]


def until(condition, seconds=60):
    end = time.time() + seconds
    while not condition() and time.time() < end:
        time.sleep(0.3)
    assert condition()


def sums(spark, path):
    found = {}
    for user, count, total, fraud in rows_of(stored_alerts(spark, path), *VALUES):
        known = found.get(user, (0, 0, 0))
        found[user] = (known[0] + count, known[1] + total, max(known[2], fraud))
    return found


def test_the_last_window_closes_on_an_idle_stream(spark, topic):  # noqa: F811
    cfg = RiskConfig(window="2 seconds", time_basis="processing")
    path, checkpoint = topic.place("alerts")
    query = start_clock_alerts_query(topic.stream(), path, checkpoint, cfg)
    try:
        topic.send([message(n, n % 2, T0, 700.25) for n in range(12)] + ["{bad"])
        # Nothing is sent any more.
        until(lambda: len(sums(spark, path)) == 2)
        assert sums(spark, path) == {0: (6, Decimal("4201.50"), 1), 1: (6, Decimal("4201.50"), 1)}
        rows = stored_alerts(spark, path).collect()
        assert all((row.window_end - row.window_start).total_seconds() == 2 for row in rows)
        assert all(row.window_end <= row.created_at for row in rows)
    finally:
        query.stop()


def test_a_restart_keeps_timers_and_sums(spark, topic):  # noqa: F811
    cfg = RiskConfig(window="12 seconds", time_basis="processing")
    path, checkpoint = topic.place("alerts")
    topic.send([message(n, 5, T0, 10) for n in range(3)])
    query = start_clock_alerts_query(topic.stream(), path, checkpoint, cfg)
    until(lambda: any(progress.numInputRows for progress in query.recentProgress))
    query.stop()
    before = sums(spark, path)
    topic.send([message(n, 5, T0, 10) for n in range(3, 5)])
    query = start_clock_alerts_query(topic.stream(), path, checkpoint, cfg)
    try:
        until(lambda: sums(spark, path).get(5, (0,))[0] == 5)
    finally:
        query.stop()
    assert before.get(5, (0,))[0] in (0, 3)


def test_other_clocks_are_refused(transactions):
    with pytest.raises(ValueError, match="processing"):
        clock_windows(transactions([(1, 0, 1)]), RiskConfig())
    with pytest.raises(ValueError, match="milliseconds"):
        clock_windows(transactions([(1, 0, 1)]), RiskConfig(window="1 microsecond", time_basis="processing"))
