"""Windows the job closes, corrections, and lateness."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tallywatch.config import RiskConfig
from tallywatch.functions.parse import parse_transactions
from tallywatch.operators.profile import alerts
from tallywatch.schema import CLOSED_ALERTS
from tallywatch.sources.tables import closed_alerts, ledger_alerts, table_rows
from tallywatch.streaming.ledger import Tables, start_ledger_query
from tallywatch.streaming.progress import lateness

from .conftest import T0, message, rows_of
from .test_streaming import ONCE, VALUES, topic  # noqa: F401

CFG = RiskConfig(watermark="10 seconds")


@pytest.fixture
def run(topic, tmp_path):  # noqa: F811
    def go(checkpoint="checkpoint", cfg=CFG, partitions=False):
        stream = topic.stream()
        if partitions:
            part = F.get_json_object("value", "$.merchant_category")
            stream = stream.withColumn("position", F.concat(F.lit("topic/"), part, F.lit("/7")))
        tables = Tables(str(tmp_path / "tables"))
        start_ledger_query(stream, tables, str(tmp_path / checkpoint), cfg, ONCE).awaitTermination()
        return tables

    return go


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def emitted(spark, tables):
    rows = table_rows(spark, tables.closed_alerts, CLOSED_ALERTS).orderBy("version", "user_id", "window_end").collect()
    return [(row.version, row.user_id, row.transaction_count, row.correction) for row in rows]


def test_windows_are_emitted_once_and_corrected(spark, topic, run):  # noqa: F811
    topic.send([message(1, 1, at(0), 10), message(2, 2, at(59), 10)])
    topic.send([message(3, 3, at(69), 10)])
    assert emitted(spark, run()) == []
    topic.send([message(4, 3, at(70), 10)])  # 12:01:10 less ten seconds: the first minute is over
    topic.send([message(5, 1, at(30), 10), message(6, 4, at(31), 10), message(3, 3, at(69), 10)])
    tables = run()
    assert emitted(spark, tables) == [(3, 1, 1, False), (3, 2, 1, False), (4, 1, 2, True), (4, 4, 1, True)]
    # Neither a restart nor a new checkpoint emits anything again.
    run()
    run(checkpoint="other")
    assert len(emitted(spark, tables)) == 4
    topic.send([message(7, 1, at(140), 10)])
    run(checkpoint="other")
    assert emitted(spark, tables)[4:] == [(emitted(spark, tables)[-1][0], 3, 2, False)]
    found = closed_alerts(spark, tables.closed_alerts)
    whole = ledger_alerts(spark, tables.alert_parts).where(F.col("window_end") <= at(120))
    assert rows_of(found, *VALUES) == rows_of(whole, *VALUES) != []


def test_a_wrong_clock_closes_nothing_and_holds_nothing_open(spark, topic, run):  # noqa: F811
    topic.send([message(1, 1, at(0), 10), message(2, 9, at(0).replace(year=2100), 10), message(3, 8, at(0).replace(year=1980), 10)])
    topic.send([message(4, 1, at(10), 10)])
    tables = run()
    assert [row[1] for row in emitted(spark, tables)] == [8]
    topic.send([message(5, 2, at(80), 10), message(6, 9, at(1).replace(year=2100), 10)])
    assert emitted(spark, run())[1:] == [(3, 1, 2, False)]


def test_the_slowest_partition_counts_until_it_falls_silent(spark, topic, run):  # noqa: F811
    def sent(number, seconds, part):
        return message(number, 1, at(seconds), 10, merchant_category=part)

    topic.send([sent(1, 0, "a"), sent(2, 5, "b")])
    topic.send([sent(3, 500, "a")])
    cfg = RiskConfig(watermark="10 seconds", idle="2 seconds")
    assert emitted(spark, run(cfg=cfg, partitions=True)) == []
    # The files that follow arrive later than that: partition b is idle.
    for number in range(4, 8):
        topic.send([sent(number, 500 + number, "a")])
    tables = run(cfg=cfg, partitions=True)
    assert emitted(spark, tables) == [(3, 1, 2, False)]
    topic.send([sent(9, 20, "b")])
    assert emitted(spark, run(cfg=cfg, partitions=True))[1:] == [(7, 1, 3, True)]


@pytest.mark.parametrize("basis", ["ingest", "processing"])
def test_other_clocks_close_windows_too(spark, topic, run, basis):  # noqa: F811
    topic.send([message(1, 1, at(0), 10), message(2, 1, at(86400), 10)])
    cfg = RiskConfig(time_basis=basis, window="1 second", watermark="0 seconds")
    run(cfg=cfg)
    topic.send([message(3, 2, at(0), 10)])
    topic.files += 5
    topic.send([message(4, 3, at(0), 10)])
    tables = run(cfg=cfg)
    assert {(row[1], row[2]) for row in emitted(spark, tables)} >= {(1, 2)}
    assert all(not row[3] for row in emitted(spark, tables))


def test_random_traffic_ends_like_batch(spark, topic, run):  # noqa: F811
    """Emitted windows equal batch ones, and the late count equals brute force,
    over many small batches with late and repeated messages."""
    draw = random.Random(12)
    sent, batches = [], []
    for part in range(12):
        seconds = [part * 40 + draw.choice([draw.uniform(0, 40), draw.uniform(-200, 40)]) for _ in range(30)]
        times = [at(round(max(0, second), 3)) for second in seconds]
        lines = [message(len(sent) + n, draw.randint(1, 3), when, 10) for n, when in enumerate(times)]
        topic.send(lines + draw.sample(sent, min(5, len(sent))))
        sent += lines
        batches.append(times)
    tables = run()

    late, behind, high, low = 0, [], None, None
    for times in batches:
        for when in times:
            late += low is not None and when.replace(second=0, microsecond=0) + timedelta(minutes=1) <= low
            behind.append(0 if high is None else max(0, (high - when) // timedelta(milliseconds=1)))
        high = max([*times, *([high] if high else [])])
        low = high - timedelta(seconds=10)
    (row,) = lateness(spark, tables.progress).collect()
    assert (row.rows, row.late) == (len(sent), late) and late > 20
    behind.sort()
    assert behind[int(0.95 * len(sent))] <= row.delay_ms <= behind[-1]

    tx, _ = parse_transactions(topic.batch().distinct())
    expected = alerts(tx, CFG).where(F.col("window_end") <= F.lit(low))
    assert rows_of(closed_alerts(spark, tables.closed_alerts), *VALUES) == rows_of(expected, *VALUES)
    log = table_rows(spark, tables.closed_alerts, CLOSED_ALERTS)
    firsts = log.where("not correction")
    assert firsts.count() == firsts.select("user_id", "window_end").distinct().count()
    assert log.where("correction").count() > 0


def test_no_rows_no_lateness(spark, topic, run):  # noqa: F811
    topic.send(["{bad"])
    (row,) = lateness(spark, run().progress).collect()
    assert (row.rows, row.late, row.delay_ms) == (0, 0, None)
