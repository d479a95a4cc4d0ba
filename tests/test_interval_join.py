"""The interval join against brute force, for any windows and bins."""

import random
from datetime import timedelta

import pytest

from tallywatch.plans import views
from tallywatch.operators.interval_join import dyadic_join, flagged_transactions, interval_join

from .conftest import T0, rows_of


@pytest.fixture
def windows(spark):
    """Overlapping windows of any length, aligned to nothing."""
    draw = random.Random(3)
    rows = []
    for _ in range(160):
        start = draw.uniform(-100, 3000)
        rows.append((draw.randint(1, 4), start, start + draw.choice([0.001, 1, 59, 60, 61, 900])))
    rows += [(1, 60, 60), (1, 120, 60), (2, 0, 60), (2, 60, 120)]
    text = [(u, str(T0 + timedelta(seconds=a)), str(T0 + timedelta(seconds=b))) for u, a, b in rows]
    frame = spark.createDataFrame(text, "user_id long, s string, e string")
    return rows, frame.selectExpr("user_id", "cast(s as timestamp) window_start", "cast(e as timestamp) window_end")


@pytest.fixture
def clicks():
    draw = random.Random(4)
    # User 1 holds most rows; some fall exactly on bounds.
    rows = [(1 if draw.random() < 0.7 else draw.randint(2, 5), draw.uniform(-200, 4000), 1) for _ in range(400)]
    return rows + [(2, 0, 1), (2, 60, 1), (2, 120, 1), (1, 60, 1), (1, 59.999999, 1)]


def brute_force(clicks, windows):
    micro = timedelta(microseconds=1)

    def at(seconds):
        return timedelta(seconds=seconds) // micro

    return sorted(
        (
            (str(number), user, at(start), at(end))
            for number, (user, second, _) in enumerate(clicks)
            for owner, start, end in windows
            if owner == user and at(start) <= at(second) < at(end)
        ),
        key=str,
    )


def found(frame):
    micro = timedelta(microseconds=1)
    rows = frame.select("transaction_id", "user_id", "window_start", "window_end").collect()
    return sorted(((i, u, (s - T0) // micro, (e - T0) // micro) for i, u, s, e in rows), key=str)


@pytest.mark.parametrize("bin_width", ["1 second", "1 minute", "7 minutes", "1 day"])
def test_matches_brute_force(transactions, clicks, windows, bin_width):
    rows, frame = windows
    expected = brute_force(clicks, rows)
    assert len(expected) > 300
    assert found(interval_join(transactions(clicks), frame, bin_width)) == expected
    assert found(flagged_transactions(transactions(clicks), frame, bin_width)) == expected


def test_dyadic_cells_match_brute_force(transactions, clicks, windows):
    rows, frame = windows
    expected = brute_force(clicks, rows)
    assert found(dyadic_join(transactions(clicks), frame)) == expected
    assert found(flagged_transactions(transactions(clicks), frame)) == expected


def test_dyadic_cells_of_every_width(spark, transactions):
    """Windows from a microsecond to centuries, at bounds of cells and beside them."""
    micro = timedelta(microseconds=1)
    draw = random.Random(9)
    lengths = [1, 2, 3, 4, 5, 15, 16, 17, 4**13 - 1, 4**13, 4**13 + 1, 4**20, 4**26]
    rows = [(1, start, start + length) for length in lengths for start in (0, -1, draw.randrange(-(10**7), 10**7))]
    text = [(user, str(T0 + a * micro), str(T0 + b * micro)) for user, a, b in rows]
    frame = spark.createDataFrame(text, "user_id long, s string, e string").selectExpr(
        "user_id", "cast(s as timestamp) window_start", "cast(e as timestamp) window_end"
    )
    instants = sorted({edge + near for _, a, b in rows for edge in (a, b) if abs(edge) < 10**9 for near in (-1, 0, 1)})
    tx = spark.createDataFrame(
        [(str(n), 1, str(T0 + instant * micro)) for n, instant in enumerate(instants)],
        "transaction_id string, user_id long, t string",
    ).selectExpr("transaction_id", "user_id", "cast(t as timestamp) timestamp")
    expected = sorted(
        ((str(n), 1, a, b) for n, instant in enumerate(instants) for _, a, b in rows if a <= instant < b), key=str
    )
    assert found(dyadic_join(tx, frame)) == expected


@pytest.fixture
def live(spark, tmp_path):
    """Two empty tables of the catalog, and a function that stores an alert of a
    given length and two transactions, at its start and at its end."""
    spark.sql(f"CREATE DATABASE live LOCATION '{tmp_path / 'live'}'")
    spark.sql(
        "CREATE TABLE live.tx (transaction_id STRING, user_id LONG, timestamp TIMESTAMP, amount DECIMAL(10,2),"
        " currency STRING, city STRING, merchant_category STRING) USING parquet"
    )
    spark.sql(
        "CREATE TABLE live.al (user_id LONG, window_start TIMESTAMP, window_end TIMESTAMP, transaction_count LONG,"
        " total_amount DECIMAL(20,2), is_fraud INT, alert_reason STRING) USING parquet"
    )

    def store(city, user, minutes):
        end = T0 + timedelta(seconds=user)
        start = end - timedelta(minutes=minutes)
        for name, at in ((city, start), (f"{city} late", end)):
            spark.sql(f"INSERT INTO live.tx VALUES ('{name}', {user}, TIMESTAMP'{at}', 5, 'USD', '{name}', 'x')")
        spark.sql(f"INSERT INTO live.al VALUES ({user}, TIMESTAMP'{start}', TIMESTAMP'{end}', 9, 5, 1, 'many')")

    yield store
    spark.sql("DROP DATABASE live CASCADE")
    for name in ("transactions", "fraud_alerts", "transactions_per_minute", "fraud_by_city", "fraud_stats_24h"):
        spark.catalog.dropTempView(name)


CITIES = [("Rome", 1, 1), ("Oslo", 2, 60), ("Bern", 3, 7 * 24 * 60), ("Wien", 4, 1), ("Bonn", 5, 0.001)]


def cities(frame):
    return [tuple(row) for row in frame.select("city", "fraud_count").collect()]


def test_views_of_named_tables_follow_them(spark, live):
    """Alerts of any width stored after the views were made show in all of them."""
    views.register_views(spark, "live.tx", "live.al", T0)
    assert cities(spark.table("fraud_by_city")) == []
    for number, (city, user, minutes) in enumerate(CITIES, 1):
        live(city, user, minutes)
        assert cities(spark.table("fraud_by_city")) == sorted((name, 1) for name, *_ in CITIES[:number])
        assert spark.table("fraud_stats_24h").first().total_alerts == number
        assert spark.table("fraud_alerts").count() == number
    tx, al = spark.table("live.tx"), spark.table("live.al")
    for name, frame in {
        "fraud_by_city": views.fraud_by_city(tx, al, T0),
        "fraud_stats_24h": views.fraud_stats(al, T0),
        "transactions_per_minute": views.transactions_per_minute(tx, T0),
    }.items():
        assert spark.table(name).schema == frame.schema and spark.table(name).collect() == frame.collect()
    with pytest.raises(ValueError):
        views.register_views(spark, "live.tx", "live.al", T0, bin_width="1 day")


def test_view_of_frames_sees_rows_of_the_files_it_lists(spark, live):
    """No width is fixed when the view is made: an alert of a new width shows."""
    live("Rome", 1, 1)
    live("Oslo", 2, 60)
    tx, al = spark.table("live.tx"), spark.table("live.al")
    views.register_views(spark, tx, al, T0)
    assert cities(spark.table("fraud_by_city")) == [("Oslo", 1), ("Rome", 1)]
    live("Bern", 3, 7 * 24 * 60)
    assert spark.table("fraud_by_city").count() == spark.table("fraud_stats_24h").first().total_alerts


def test_planning_runs_no_job_and_reads_transactions_once(spark, transactions, windows, tmp_path):
    transactions([(1, second, 1) for second in range(500)]).write.parquet(str(tmp_path / "tx"))
    windows[1].write.parquet(str(tmp_path / "al"))
    tx, al = (spark.read.parquet(str(tmp_path / name)) for name in ("tx", "al"))
    spark.sparkContext.setJobGroup("planning", "")
    try:
        joined = flagged_transactions(tx, al)
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("planning") == []
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    scans = [line for line in joined._jdf.queryExecution().sparkPlan().toString().splitlines() if "FileScan" in line]
    assert sum("merchant_category" in line for line in scans) == 1


def test_agrees_with_the_plain_join(transactions, clicks, windows):
    tx, frame = transactions(clicks), windows[1]
    on = (
        (tx["user_id"] == frame["user_id"])
        & (tx["timestamp"] >= frame["window_start"])
        & (tx["timestamp"] < frame["window_end"])
    )
    plain = tx.join(frame, on).select(tx["transaction_id"], "window_start", "window_end")
    binned = interval_join(tx, frame, "1 minute")
    assert rows_of(plain, "*") == rows_of(binned, "transaction_id", "window_start", "window_end")


def test_before_1970(spark):
    tx = spark.sql("select '0' transaction_id, 1L user_id, timestamp'1969-12-31 23:59:59.5' timestamp")
    window = spark.sql(
        "select 1L user_id, timestamp'1969-12-31 23:59:00' window_start, timestamp'1970-01-01 00:00:00' window_end"
    )
    assert interval_join(tx, window, "1 minute").count() == 1


def test_no_windows_no_rows(transactions, windows):
    for width in ("1 minute", None):
        assert flagged_transactions(transactions([(1, 0, 1)]), windows[1].where("false"), width).count() == 0
