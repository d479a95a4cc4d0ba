"""Streaming jobs against batch: several files, late and repeated messages,
restarts, and both output modes."""

import os
import random
import time
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywatch import schema
from tallywatch.config import RiskConfig
from tallywatch.functions.parse import COUNTERS, parse_transactions
from tallywatch.operators.profile import alerts, enrich
from tallywatch.session import configure
from tallywatch.sources.messages import file_messages
from tallywatch.sources.tables import alerts_log, stored_alerts, stored_transactions
from tallywatch.streaming import jobs, sinks

from .conftest import T0, message, rows_of

ONCE = {"availableNow": True}
CFG = RiskConfig(watermark="0 seconds")
VALUES = ["user_id", "window_start", "window_end", "transaction_count", "total_amount", "is_fraud", "alert_reason"]


@pytest.fixture
def topic(spark, tmp_path):
    """A folder of message files read one file per micro-batch."""
    configure(spark, streaming=True)
    folder = tmp_path / "topic"
    folder.mkdir()

    class Topic:
        def __init__(self):
            self.files = 0

        def send(self, lines):
            self.files += 1
            file = folder / f"{self.files:04}.txt"
            file.write_text("".join(line + "\n" for line in lines))
            # Files are taken in order of modification time.
            arrival = time.time() - 3600 + self.files
            os.utime(file, (arrival, arrival))

        def stream(self):
            return file_messages(spark, str(folder), max_files_per_trigger=1)

        def batch(self):
            return spark.read.text(str(folder))

        def place(self, name):
            return str(tmp_path / name), str(tmp_path / f"{name}-checkpoint")

    return Topic()


def run(start, topic, name, checkpoint=None, **options):
    path, own_checkpoint = topic.place(name)
    query = start(topic.stream(), path, checkpoint or own_checkpoint, trigger=ONCE, **options)
    query.awaitTermination()
    return path, query


def traffic(topic, files=4, bad=True):
    """Users spend over some minutes, one of them most; files in time order."""
    draw = random.Random(2)
    number = 0
    for part in range(files):
        lines = []
        for _ in range(80):
            user = 1 if draw.random() < 0.4 else draw.randint(2, 20)
            when = T0 + timedelta(seconds=part * 90 + draw.uniform(0, 89))
            lines.append(message(number, user, when, draw.randint(100, 90000) / 100))
            number += 1
        lines.sort(key=lambda line: line.split('"timestamp"')[1])
        topic.send([*lines, "{bad"] if bad else lines)
    return number


def closed(frame, seen):
    return frame.where(F.col("window_end") <= seen.agg(F.max("timestamp")).first()[0])


@pytest.fixture
def in_order(topic):
    traffic(topic)
    return topic


def test_append_equals_closed_batch_windows(spark, in_order):
    path, query = run(jobs.start_alerts_query, in_order, "alerts", cfg=RiskConfig(watermark="2 minutes"))
    tx, _ = parse_transactions(in_order.batch())
    expected = alerts(tx, CFG).where(
        F.col("window_end") <= tx.agg(F.max("timestamp") - F.expr("INTERVAL 2 MINUTES")).scalar()
    )
    assert rows_of(stored_alerts(spark, path), *VALUES) == rows_of(expected, *VALUES)
    assert jobs.late_rows(query) == 0
    # One version each: a window is emitted once.
    assert alerts_log(spark, path).count() == expected.count() > 0


def test_update_equals_full_batch(spark, in_order):
    cfg = RiskConfig(watermark="10 minutes")
    path, _ = run(jobs.start_alerts_query, in_order, "alerts", cfg=cfg, mode="update")
    tx, _ = parse_transactions(in_order.batch())
    current = stored_alerts(spark, path)
    assert rows_of(current, *VALUES) == rows_of(alerts(tx, CFG), *VALUES)
    assert alerts_log(spark, path).count() > current.count()
    assert current.where("created_at < updated_at").count() > 0


def test_custom_rules_reach_the_stream(spark, in_order):
    from tallywatch.functions.rules import Rule

    rules = [Rule("any", "transaction_count >= 1", "'seen'")]
    path, _ = run(jobs.start_alerts_query, in_order, "alerts", cfg=CFG, mode="update", rules=rules)
    assert {row.alert_reason for row in stored_alerts(spark, path).collect()} == {"seen"}


def test_late_rows_miss_windows_but_are_stored(spark, topic):
    topic.send([message(1, 1, T0, 10), message(2, 1, T0 + timedelta(minutes=5), 10)])
    # A watermark filters late rows from the batch after the one it closes windows in.
    topic.send([message(3, 1, T0 + timedelta(minutes=6), 10)])
    topic.send([message(4, 1, T0 + timedelta(seconds=1), 10), message(5, 1, T0 + timedelta(minutes=9), 10)])
    path, query = run(jobs.start_alerts_query, topic, "alerts", cfg=CFG)
    assert jobs.late_rows(query) == 1
    first = stored_alerts(spark, path).orderBy("window_end").first()
    assert (first.window_start, first.transaction_count) == (T0, 1)
    path, _ = run(jobs.start_transactions_query, topic, "transactions", cfg=CFG)
    assert rows_of(stored_transactions(spark, path), "transaction_id") == [(f"id-{n}",) for n in range(1, 6)]


def test_out_of_order_files_within_the_watermark(spark, topic):
    late = [message(number, number % 3, T0 + timedelta(seconds=number), 700) for number in range(0, 200, 7)]
    rest = [message(number, number % 3, T0 + timedelta(seconds=number), 700) for number in range(200) if number % 7]
    topic.send(rest)
    topic.send(late)
    cfg = RiskConfig(watermark="1 hour")
    path, query = run(jobs.start_alerts_query, topic, "alerts", cfg=cfg, mode="update")
    tx, _ = parse_transactions(topic.batch())
    assert rows_of(stored_alerts(spark, path), *VALUES) == rows_of(alerts(tx, CFG), *VALUES)
    assert jobs.late_rows(query) == 0


def test_enriched_equals_batch(spark, in_order):
    path, _ = run(jobs.start_enriched_query, in_order, "enriched", cfg=RiskConfig(watermark="2 minutes"))
    tx, _ = parse_transactions(in_order.batch())
    expected = enrich(tx, CFG).where(
        F.col("window_end") <= tx.agg(F.max("timestamp") - F.expr("INTERVAL 2 MINUTES")).scalar()
    )
    stored = spark.read.parquet(path)
    assert rows_of(stored, *schema.ENRICHED_COLUMNS) == rows_of(expected, *schema.ENRICHED_COLUMNS) != []
    assert stored.select("transaction_id").distinct().count() == stored.count()


def test_enriched_rows_cost_few_state_calls(in_order):
    """Each row is looked up, put and removed at most once until its window closes."""
    _, query = run(jobs.start_enriched_query, in_order, "enriched", cfg=CFG)
    states = [state for progress in query.recentProgress for state in progress.stateOperators]
    calls = sum(state.customMetrics[f"rocksdb{kind}Count"] for state in states for kind in ("Get", "Put"))
    assert 0 < calls <= 3 * in_order.batch().where("value != '{bad'").count()


def test_enriched_keeps_equal_rows(spark, topic):
    """Messages that are equal, in one batch or in two, and such without an id."""
    twice = [message(1, 1, T0, 10), message(1, 1, T0, 10), message(2, 2, T0, 10, transaction_id=None)]
    topic.send([*twice, *twice[2:]])
    topic.send(twice[:1])
    topic.send([message(3, 1, T0 + timedelta(minutes=2), 10)])
    path, _ = run(jobs.start_enriched_query, topic, "enriched", cfg=RiskConfig(watermark="30 seconds"))
    tx, _ = parse_transactions(topic.batch())
    expected = enrich(tx, CFG).where(F.col("window_end") <= T0 + timedelta(minutes=1))
    found = rows_of(spark.read.parquet(path), *schema.ENRICHED_COLUMNS)
    assert found == rows_of(expected, *schema.ENRICHED_COLUMNS) and len(found) == 5


@pytest.mark.parametrize("basis", ["ingest", "processing"])
def test_enriched_by_other_clocks(spark, topic, basis):
    """A file is a window of the arrival clock, closed by the next file."""
    topic.send([message(n, 1, T0 + timedelta(days=n), 10) for n in range(3)])
    topic.send([message(3, 1, T0, 10)])
    cfg = RiskConfig(window="1 millisecond", time_basis=basis, watermark="0 seconds")
    path, _ = run(jobs.start_enriched_query, topic, "enriched", cfg=cfg)
    found = rows_of(spark.read.parquet(path), "transaction_id", "timestamp", "transaction_count")
    assert found[:3] == [(f"id-{n}", T0 + timedelta(days=n), 3) for n in range(3)]
    assert {row[2] for row in found[3:]} <= {1}


def test_join_of_streams_equals_batch(spark, in_order):
    """``enrich`` of a stream, which the job for enriched rows does not use."""
    cfg = RiskConfig(watermark="2 minutes")

    def start(messages, path, checkpoint, trigger):
        rows = enrich(jobs._accepted(messages, cfg), cfg).withColumn("event_date", F.to_date("timestamp"))
        return jobs._start(rows, sinks.append_batch(path, "event_date"), checkpoint, trigger)

    path, _ = run(start, in_order, "joined")
    again, _ = run(jobs.start_enriched_query, in_order, "enriched", cfg=cfg)
    columns = schema.ENRICHED_COLUMNS
    assert rows_of(spark.read.parquet(path), *columns) == rows_of(spark.read.parquet(again), *columns) != []


def test_redelivered_messages_are_stored_once(spark, in_order):
    lines = [row.value for row in in_order.batch().collect()]
    in_order.send(lines[:100] + lines[:50])
    path, _ = run(jobs.start_transactions_query, in_order, "transactions")
    tx, _ = parse_transactions(in_order.batch())
    columns = schema.TRANSACTION_COLUMNS
    assert rows_of(stored_transactions(spark, path), *columns) == rows_of(tx.distinct(), *columns)


def test_bounded_memory_of_ids(spark, in_order):
    lines = [row.value for row in in_order.batch().collect() if row.value != "{bad"]
    in_order.send(lines)
    path, _ = run(jobs.start_transactions_query, in_order, "transactions", within="1 hour")
    assert stored_transactions(spark, path).count() == len(lines)


def test_restart_goes_on_where_it_stopped(spark, topic):
    topic.send([message(1, 1, T0, 2000)])
    path, _ = run(jobs.start_alerts_query, topic, "alerts", mode="update")
    run(jobs.start_transactions_query, topic, "transactions")
    topic.send([message(2, 1, T0 + timedelta(seconds=5), 2000), message(1, 1, T0, 2000)])
    run(jobs.start_alerts_query, topic, "alerts", mode="update")
    stored, _ = run(jobs.start_transactions_query, topic, "transactions")
    (row,) = stored_alerts(spark, path).collect()
    # The alert job counts messages; only the transactions table is keyed by id.
    assert (row.transaction_count, row.total_amount) == (3, Decimal("6000.00"))
    assert rows_of(stored_transactions(spark, stored), "transaction_id") == [("id-1",), ("id-2",)]
    run(jobs.start_transactions_query, topic, "transactions")
    assert stored_transactions(spark, stored).count() == 2


def test_new_checkpoint_keeps_older_batches(spark, topic):
    topic.send([message(1, 1, T0, 10)])
    path, _ = run(jobs.start_alerts_query, topic, "alerts", mode="update")
    before = rows_of(alerts_log(spark, path), "*")
    topic.send([message(2, 2, T0, 10)])
    _, fresh = topic.place("other")
    run(jobs.start_alerts_query, topic, "alerts", checkpoint=fresh, mode="update")
    assert set(before) < set(rows_of(alerts_log(spark, path), "*"))
    assert rows_of(stored_alerts(spark, path), "user_id", "transaction_count") == [(1, 1), (2, 1)]


def test_retried_batch_replaces_itself(spark, topic, tmp_path):
    """The same batch written twice, as after a failure before the commit."""
    topic.send([message(1, 1, T0, 10)])
    path = str(tmp_path / "twice")
    write = sinks.append_batch(path, "alert_date")

    def twice(batch, batch_id):
        write(batch, batch_id)
        write(batch, batch_id)

    run(jobs.start_alerts_query, topic, "unused", mode="update", writer=twice)
    assert alerts_log(spark, path).count() == 1


def test_writer_needs_a_stream(spark, tmp_path):
    with pytest.raises(RuntimeError):
        sinks.append_batch(str(tmp_path / "t"))(spark.range(1), 0)


def test_merge_resolves_against_a_table(spark, transactions, tmp_path):
    from pyspark.errors import PySparkException

    now = F.current_timestamp()
    found = alerts(transactions([(1, 0, 1)]), CFG).withColumns({"created_at": now, "updated_at": now})
    found.write.option("path", str(tmp_path / "merged")).saveAsTable("merged")
    with pytest.raises(PySparkException, match="does not support MERGE INTO"):
        sinks.merge_batch("merged")(found, 0)
    spark.sql("DROP TABLE merged")


def test_quarantine_keeps_bad_messages(spark, in_order):
    path, _ = run(jobs.start_quarantine_query, in_order, "quarantine")
    assert rows_of(spark.read.parquet(path), "value", "reject_reason") == [("{bad", "bad_json")] * 4


def test_progress_reports_message_counts(in_order):
    _, query = run(jobs.start_alerts_query, in_order, "alerts", mode="update")
    metrics = [progress.observedMetrics.get(COUNTERS) for progress in query.recentProgress]
    assert sum(m.messages for m in metrics if m) == 324 and sum(m.rejected for m in metrics if m) == 4


@pytest.mark.parametrize("basis", ["ingest", "processing"])
def test_other_clocks(spark, topic, basis):
    """Event times a day apart share a window of the arrival clock."""
    topic.send([message(1, 1, T0, 10), message(2, 1, T0 + timedelta(days=1), 10)])
    cfg = RiskConfig(window="1 day", time_basis=basis)
    path, _ = run(jobs.start_alerts_query, topic, "alerts", cfg=cfg, mode="update")
    (row,) = stored_alerts(spark, path).collect()
    assert row.transaction_count == 2 and row.window_end > datetime(2025, 1, 1)


def test_compaction(spark, in_order, tmp_path):
    path, _ = run(jobs.start_alerts_query, in_order, "alerts", mode="update")
    target = str(tmp_path / "compact")
    sinks.compact_alerts(spark, path, target)
    assert rows_of(stored_alerts(spark, target), "*") == rows_of(stored_alerts(spark, path), "*")
    assert alerts_log(spark, target).count() == stored_alerts(spark, path).count()
    # A later version still wins, and the first times survive.
    in_order.send([message(9000, 1, T0, 5), message(9001, 1, T0 + timedelta(hours=1), 5)])
    _, fresh = in_order.place("late")
    query = jobs.start_alerts_query(
        in_order.stream(), target, fresh, cfg=RiskConfig(watermark="1 day"), trigger=ONCE, mode="update"
    )
    query.awaitTermination()
    again = stored_alerts(spark, target)
    tx, _ = parse_transactions(in_order.batch())
    assert rows_of(again, *VALUES) == rows_of(alerts(tx, CFG), *VALUES)
    created = again.join(stored_alerts(spark, path), ["user_id", "window_end", "created_at"])
    assert created.count() == stored_alerts(spark, path).count()

    path, _ = run(jobs.start_transactions_query, in_order, "transactions")
    sinks.compact_transactions(spark, path, str(tmp_path / "tx"))
    assert rows_of(stored_transactions(spark, str(tmp_path / "tx")), "*") == rows_of(stored_transactions(spark, path), "*")


def test_whole_job(spark, in_order, tmp_path, monkeypatch):
    """The job's one query, with files in place of the topic."""
    from tallywatch import __main__ as job_main
    from tallywatch.config import JobConfig
    from tallywatch.sources.tables import ledger_alerts

    monkeypatch.setattr(job_main, "kafka_messages", lambda session, job: in_order.stream())
    job = JobConfig(
        output_root=str(tmp_path / "tables"), checkpoint_root=str(tmp_path / "checkpoints"), trigger_interval="0 seconds"
    )
    query = job_main.start(spark, job, RiskConfig())
    assert spark.streams.active == [query] or len(spark.streams.active) == 1
    query.processAllAvailable()
    query.stop()
    tx, bad = parse_transactions(in_order.batch())
    assert rows_of(stored_transactions(spark, f"{tmp_path}/tables/transactions"), "transaction_id") == rows_of(
        tx, "transaction_id"
    )
    found = ledger_alerts(spark, f"{tmp_path}/tables/alert_parts")
    assert rows_of(found, *VALUES) == rows_of(alerts(tx, CFG), *VALUES)
    assert spark.read.parquet(f"{tmp_path}/tables/quarantine").count() == bad.count()
