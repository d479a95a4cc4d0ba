"""The job's single query against batch results: wrong clocks, late and repeated
messages, missing ids, restarts, new checkpoints and compaction."""

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywatch import schema
from tallywatch.config import JobConfig, RiskConfig
from tallywatch.functions.parse import parse_transactions
from tallywatch.operators.profile import alerts, enrich, enrich_from_alerts
from tallywatch.operators.tables import current_alerts, insert_ignore
from tallywatch.sources.tables import (
    latest_days,
    ledger_alerts,
    stored_feed,
    stored_quarantine,
    stored_transactions,
    table_rows,
    unmarked_rows,
)
from tallywatch.streaming import ledger, sinks
from tallywatch.streaming.ledger import Tables, committed_batches, start_ledger_query

from .conftest import T0, message, rows_of
from .test_plans import files_read
from .test_streaming import ONCE, VALUES, topic, traffic  # noqa: F401

CFG = RiskConfig()


@pytest.fixture
def run(topic, tmp_path):  # noqa: F811
    def go(checkpoint="checkpoint", tables="tables", **options):
        found = Tables(str(tmp_path / tables))
        start_ledger_query(topic.stream(), found, str(tmp_path / checkpoint), CFG, ONCE, **options).awaitTermination()
        return found

    return go


def expected(topic):  # noqa: F811
    """Alerts of the distinct messages."""
    tx, _ = parse_transactions(topic.batch().distinct())
    return rows_of(alerts(tx, CFG), *VALUES)


def found(spark, tables, **options):
    return rows_of(ledger_alerts(spark, tables.alert_parts, CFG, **options), *VALUES)


def test_a_wrong_clock_stops_nothing(spark, topic, run):  # noqa: F811
    for part in range(6):
        lines = [message(10 * part + n, part + 1, T0 + timedelta(minutes=part), 700) for n in range(6)]
        if part == 1:
            lines.append(message(999, 99, T0.replace(year=2100), 1))
        topic.send(lines)
    topic.send([message(500 + n, 1, T0 - timedelta(hours=1), 10) for n in range(3)])
    tables = run()
    assert found(spark, tables) == expected(topic)
    assert {row.user_id for row in ledger_alerts(spark, tables.alert_parts).collect()} == {1, 2, 3, 4, 5, 6, 99}
    assert stored_transactions(spark, tables.transactions).count() == 40


def test_traffic_with_late_and_repeated_messages(spark, topic, run):  # noqa: F811
    count = traffic(topic)
    lines = [row.value for row in topic.batch().collect()]
    topic.send(lines[:100] + lines[50:120] + [message(9000, 1, T0, 9999)])
    tables = run()
    assert found(spark, tables) == expected(topic)
    assert stored_transactions(spark, tables.transactions).count() == count + 1
    assert table_rows(spark, tables.alert_parts, schema.ALERT_PARTS).count() > len(expected(topic))
    assert spark.read.parquet(tables.quarantine).where("reject_reason = 'bad_json'").count() >= 4


def test_restart_and_redelivery(spark, topic, run):  # noqa: F811
    topic.send([message(1, 1, T0, 2000)])
    run()
    topic.send([message(2, 1, T0 + timedelta(seconds=5), 2000), message(1, 1, T0, 2000)])
    tables = run()
    (row,) = ledger_alerts(spark, tables.alert_parts).collect()
    assert (row.transaction_count, row.total_amount) == (2, Decimal("4000.00"))
    assert rows_of(stored_transactions(spark, tables.transactions), "transaction_id") == [("id-1",), ("id-2",)]
    run()
    assert stored_transactions(spark, tables.transactions).count() == 2


def test_a_new_checkpoint_stores_nothing_twice(spark, topic, run):  # noqa: F811
    count = traffic(topic)
    before = found(spark, run())
    tables = run(checkpoint="other")
    assert stored_transactions(spark, tables.transactions).count() == count
    assert found(spark, tables) == before == expected(topic)


def test_blank_ids_are_no_ids(spark, topic, run):  # noqa: F811
    topic.send([message(n, 1, T0, 1, transaction_id="" if n % 2 else "  ") for n in range(50)])
    tables = run()
    stored = stored_transactions(spark, tables.transactions)
    assert stored.count() == 50 == stored.select("transaction_id").distinct().count()
    assert ledger_alerts(spark, tables.alert_parts).first().transaction_count == 50


def test_insert_ignore_keeps_rows_without_an_id(transactions):
    rows = transactions([(1, 0, n) for n in range(20)]).withColumn(
        "transaction_id", F.when(F.col("amount") < 10, F.lit(None)).when(F.col("amount") < 15, "").otherwise("same")
    )
    kept = insert_ignore(rows.limit(0), rows.withColumn("transaction_id", F.col("transaction_id").cast("string")))
    assert kept.count() == 16


def test_feed_and_follower_see_whole_alerts(spark, topic, run):  # noqa: F811
    topic.send([message(n, 7, T0, 1000) for n in range(2)])
    topic.send([message(n, 7, T0, 1000) for n in range(2, 4)])
    sent = []

    def follower(fresh, touched, batch_id):
        sent.append((batch_id, fresh.count(), touched.first().transaction_count, touched.first().is_fraud))

    tables = run(feed=True, follower=follower)
    assert sent == [(0, 2, 2, 0), (1, 2, 4, 1)]
    (line,) = spark.read.parquet(tables.feed).collect()
    assert line.message.endswith("User 7 - High total amount: $4000.00")


WRITES = ["quarantine", "ids/new", "transactions", "alert_parts", "progress", "closed_alerts", "alert_feed", "batches"]


@pytest.fixture
def killed(monkeypatch):
    """Makes the job fail for once, before or after it writes one of its tables."""
    from tallywatch.streaming import ledger

    def at(table, after):
        append, mark = ledger._append, ledger._mark

        def fails(write, path_of):
            def writes(*args):
                meant = path_of(args).endswith(table) and -1 not in args
                if meant and not after:
                    raise OSError("lost")
                write(*args)
                if meant:
                    raise OSError("lost")

            return writes

        monkeypatch.setattr(ledger, "_append", fails(append, lambda args: args[1]))
        monkeypatch.setattr(ledger, "_mark", fails(mark, lambda args: args[1].batches))
        return monkeypatch.undo

    return at


@pytest.mark.parametrize(
    "table, after, checkpoint",
    [
        *((table, False, "checkpoint" if at % 2 else "other") for at, table in enumerate(WRITES)),
        ("transactions", True, "other"),
        ("batches", True, "checkpoint"),
        ("batches", True, "other"),
    ],
)
def test_a_killed_batch_reaches_all_tables_or_none(spark, topic, run, killed, table, after, checkpoint):  # noqa: F811
    lines = [message(n, n % 4, T0 + timedelta(days=n % 2), 1700) for n in range(30)]
    topic.send(lines[:9] + ["{bad"])
    run(feed=True)
    topic.send(lines[6:] + ["{worse"])
    undo = killed(table, after)
    with pytest.raises(Exception, match="lost"):
        run(feed=True)
    undo()
    # What the batch that was cut short left behind is not seen ...
    tables = Tables(str(topic.place("tables")[0]))
    whole = 30 if (table, after) == ("batches", True) else 9
    assert stored_transactions(spark, tables.transactions).count() == whole
    assert ledger_alerts(spark, tables.alert_parts).agg(F.sum("transaction_count")).first()[0] == whole
    # ... and comes whole with the next run, with the old checkpoint or a new one.
    sent = []
    run(checkpoint=checkpoint, feed=True, follower=lambda fresh, touched, batch: sent.append((batch, fresh.count())))
    assert stored_transactions(spark, tables.transactions).count() == 30
    assert found(spark, tables) == expected(topic)
    bad = stored_quarantine(spark, tables.quarantine).groupBy("value").count().collect()
    assert {row.value for row in bad} == {"{bad", "{worse"}
    if checkpoint == "checkpoint":
        assert all(row["count"] == 1 for row in bad)
        assert sent == [(1, 21)]
    fraud = ledger_alerts(spark, tables.alert_parts, CFG).where("is_fraud = 1")
    fed = stored_feed(spark, tables.feed)
    assert set(rows_of(fraud, "user_id", "window_end")) == set(rows_of(fed, "user_id", "window_end")) != set()


def test_a_table_without_any_mark_shows_nothing(spark, topic, run, killed):  # noqa: F811
    """The very first batch is cut short as well."""
    topic.send([message(n, n % 3, T0, 700) for n in range(9)])
    undo = killed("alert_parts", False)
    with pytest.raises(Exception, match="lost"):
        run()
    undo()
    tables = Tables(str(topic.place("tables")[0]))
    assert unmarked_rows(spark, tables.transactions, schema.TRANSACTIONS_TABLE).count() == 9
    assert stored_transactions(spark, tables.transactions).count() == 0
    run(checkpoint="other")
    assert stored_transactions(spark, tables.transactions).count() == 9
    assert found(spark, tables) == expected(topic)


def test_compaction_leaves_uncommitted_batches_to_the_job(spark, topic, run, tmp_path):  # noqa: F811
    traffic(topic)
    tables = run()
    checkpoint = str(tmp_path / "checkpoint")
    assert committed_batches(spark, checkpoint) == 3
    log = table_rows(spark, tables.transactions, schema.TRANSACTIONS_TABLE)
    (query_id,) = [row[0] for row in log.select("query_id").distinct().collect()]
    compact = Tables(str(tmp_path / "compact"))
    for upto, missing in (({query_id: 3}, 0), ({query_id: 2}, 80)):
        target = Tables(f"{compact.root}-{missing}")
        sinks.compact_transactions(spark, tables.transactions, target.transactions, upto=upto)
        sinks.compact_parts(spark, tables.alert_parts, target.alert_parts, upto=upto)
        assert stored_transactions(spark, target.transactions).count() == log.count() - missing
        total = ledger_alerts(spark, target.alert_parts).agg(F.sum("transaction_count")).first()[0]
        assert total == log.count() - missing
    # The job goes on in the compacted folder, and rows that came meanwhile are added.
    topic.send([message(7000, 3, T0, 50)])
    after = run(tables="compact-0")
    assert found(spark, after) == expected(topic)
    assert table_rows(spark, after.alert_parts, schema.ALERT_PARTS).where("query_id = 'compacted'").count() > 0


def test_enriched_from_storage(spark, topic, run):  # noqa: F811
    traffic(topic)
    tables = run()
    rows = enrich_from_alerts(
        stored_transactions(spark, tables.transactions), ledger_alerts(spark, tables.alert_parts), CFG
    )
    tx, _ = parse_transactions(topic.batch())
    assert rows_of(rows, "*") == rows_of(enrich(tx, CFG), "*") != []


@pytest.fixture
def thirty_days(spark, transactions, tmp_path):
    """Alerts of thirty days, written by fifty batches."""
    tx = transactions([(user, day * 86400 + user, 4000) for day in range(30) for user in range(10)])
    batch = F.pmod(F.col("user_id") * 7 + F.dayofmonth("window_end"), F.lit(50)).cast("long")
    parts = alerts(tx, CFG).select(*schema.PROFILE_COLUMNS).withColumns(
        {
            "written_at": F.current_timestamp(),
            "alert_date": F.to_date("window_end"),
            "query_id": F.lit("q"),
            "batch_id": batch,
        }
    )
    path = str(tmp_path / "parts")
    parts.write.partitionBy("alert_date", "query_id", "batch_id").parquet(path)
    return path


def test_reports_list_the_days_they_need(spark, thirty_days):
    last = date(2024, 1, 30)
    one = table_rows(spark, thirty_days, schema.ALERT_PARTS, (last, last))
    assert one.count() == 10 and {"2024-01-30" in file for file in one.inputFiles()} == {True}
    assert table_rows(spark, thirty_days, schema.ALERT_PARTS, (date(2030, 1, 1), date(2030, 1, 2))).count() == 0
    days = latest_days(spark, thirty_days, 25, date(2024, 1, 1), date(2024, 2, 5))
    assert days == (date(2024, 1, 21), date(2024, 2, 5))
    top = ledger_alerts(spark, thirty_days, days=days).orderBy(F.desc("window_end"), "user_id").limit(25)
    every = ledger_alerts(spark, thirty_days).orderBy(F.desc("window_end"), "user_id").limit(25)
    assert rows_of(top, *VALUES) == rows_of(every, *VALUES)
    assert max(files_read(top)) == 100 < 300 == max(files_read(every))


def test_versions_follow_batches_not_clocks(spark):
    def version(query, batch, count, clock):
        when = f"2024-01-01 11:00:{clock:02}"
        return (1, "2024-01-01 10:00:00", "2024-01-01 10:01:00", count, Decimal(count), 0, "r", when, when, query, batch)

    columns = [*schema.ALERTS_LOG.fieldNames()[:9], "query_id", "batch_id"]
    log = spark.createDataFrame(
        [version("q", 0, 1, 30), version("q", 1, 9, 25), version("p", 4, 5, 10)], columns
    ).withColumns({name: F.col(name).cast("timestamp") for name in ("window_start", "window_end", "created_at", "updated_at")})
    (row,) = current_alerts(log).collect()
    assert row.transaction_count == 9


def test_rows_for_the_database(transactions):
    rows = transactions([(1, 0, 1), (2, 0, 2), (3, 0, 3)]).withColumns(
        {
            "transaction_id": F.when(F.col("user_id") == 1, "6b1f0000-0000-0000-0000-000000000001").otherwise("abc"),
            "city": F.when(F.col("user_id") == 3, F.lit("a\0b")).otherwise("Here"),
        }
    )
    far = rows.limit(1).withColumn("user_id", F.lit(99999999999))
    fine, odd = sinks.database_rows(rows.unionByName(far))
    assert {len(row.transaction_id) for row in fine.collect()} == {36} and fine.count() == 2
    assert {row.reject_reason for row in odd.collect()} == {"nul_in_city", "user_out_of_range"}
    fine, odd = sinks.database_rows(alerts(rows, CFG).withColumn("total_amount", F.lit(Decimal("123456789.00"))))
    assert (fine.count(), odd.count()) == (0, 3)


def test_the_merge_is_tried_three_times():
    tried = []

    def fails(times):
        def action():
            tried.append(1)
            if len(tried) < times:
                raise OSError("down")

        return action

    sinks.retried(fails(3), wait=0)
    assert len(tried) == 3
    tried.clear()
    with pytest.raises(OSError):
        sinks.retried(fails(4), wait=0)


def test_only_errors_that_may_pass_are_tried_again(spark):
    sql, tried = spark._jvm.java.sql, []

    class Failed(Exception):
        def __init__(self, cause):
            self.java_exception = spark._jvm.java.lang.RuntimeException("job", cause)

    def fails(cause):
        tried.clear()

        def action():
            tried.append(1)
            raise Failed(cause)

        with pytest.raises(Failed):
            sinks.retried(action, wait=0)
        return len(tried)

    assert fails(sql.SQLException("connection lost", "08006")) == 3
    assert fails(sql.SQLException("deadlock", "40P01")) == 3
    assert fails(sql.SQLTransientConnectionException("again")) == 3
    assert fails(sql.SQLException("syntax", "42601")) == 1
    assert fails(sql.SQLException("no state")) == 1
    assert fails(spark._jvm.java.lang.IllegalStateException("bug")) == 1


def test_staging_tables_are_never_shared():
    names = {sinks.staging_table("transactions", run, batch) for run in ("a" * 32, "b" * 32) for batch in (1, 2)}
    assert len(names) == 4 and all(len(name) <= 63 for name in names)


def test_settings_of_the_rules():
    assert RiskConfig.from_env({}) == RiskConfig()
    cfg = RiskConfig.from_env({"RISK_WINDOW": "5 minutes", "RISK_AMOUNT": "10.5", "RISK_COUNT": "2", "RISK_TIME_BASIS": "processing"})
    assert (cfg.window, cfg.amount_threshold, cfg.count_threshold, cfg.time_basis) == ("5 minutes", Decimal("10.5"), 2, "processing")
    assert JobConfig.from_env({"ALERT_FEED": "true"}).feed


def test_the_job_needs_its_folders(spark):
    from tallywatch import __main__ as job_main

    with pytest.raises(ValueError, match="OUTPUT_ROOT"):
        job_main.start(spark, JobConfig(), CFG)


def test_stored_ids_are_written_when_a_batch_needs_its_cached_rows_no_more(spark, topic, run, monkeypatch):  # noqa: F811
    """Writing them drops the cached new rows, which were looked up among them."""
    written, append = [], ledger._append

    def noted(rows, path, *partition_by):
        written.append(path.rsplit("/", 1)[1])
        append(rows, path, *partition_by)

    monkeypatch.setattr(ledger, "_append", noted)
    for part in range(3):
        topic.send([message(10 * part + n, 1, T0 + timedelta(minutes=part), 700) for n in range(12)])
    tables = run()
    assert stored_transactions(spark, tables.transactions).count() == 32
    batches = written.count("new")
    assert batches == written.count("transactions") == 3
    for batch in range(batches):
        ids = [place for place, name in enumerate(written) if name == "new"][batch]
        for name in ("transactions", "alert_parts", "minutes", "progress"):
            assert [place for place, other in enumerate(written) if other == name][batch] < ids


def test_only_rejected_texts_are_cached(spark, topic, run, monkeypatch):  # noqa: F811
    seen, quarantined = [], ledger.quarantined

    def noted(decoded):
        seen.append([tuple(row) for row in decoded.select("value", "reject_reason").collect()])
        return quarantined(decoded)

    monkeypatch.setattr(ledger, "quarantined", noted)
    topic.send([message(1, 1, T0, 700), message(2, 1, T0, 5), "nonsense"])
    tables = run()
    assert sorted(seen[0], key=str) == [("nonsense", "bad_json"), (None, None), (None, None)]
    assert [row.value for row in stored_quarantine(spark, tables.quarantine).collect()] == ["nonsense"]


def test_stored_ids_are_cut_to_arriving_ones_once(spark, topic, run, monkeypatch):  # noqa: F811
    """``insert_ignore`` does it; the index names candidates only."""
    monkeypatch.setattr(ledger.IdIndex, "known", None)
    for _ in range(2):
        topic.send([message(n, 1, T0, 700) for n in range(12)])
    assert stored_transactions(spark, run().transactions).count() == 12
