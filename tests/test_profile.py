"""Window profiles and enrichment: boundaries, properties and skew."""

import random
from collections import defaultdict
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywatch.config import RiskConfig
from tallywatch.functions.rules import default_rules
from tallywatch.operators.profile import _salted, alerts, enrich, window_profile

from .conftest import T0, rows_of

CFG = RiskConfig()


@pytest.fixture
def skewed():
    """400 of 600 rows fall into one user's single minute; 100 of those are
    copies that differ in nothing but the id."""
    draw = random.Random(5)
    rows = [(1, 5, 10.00)] * 100 + [(1, draw.uniform(0, 59.9), draw.randint(1, 900) / 100) for _ in range(300)]
    rows += [(draw.randint(2, 30), draw.uniform(0, 600), draw.randint(1, 200000) / 100) for _ in range(200)]
    draw.shuffle(rows)
    return rows


def expected_profiles(rows, width=60):
    totals = defaultdict(lambda: [0, Decimal(0)])
    for user, seconds, amount, *_ in rows:
        start = T0 + timedelta(seconds=seconds // width * width)
        totals[user, start, start + timedelta(seconds=width)][0] += 1
        totals[user, start, start + timedelta(seconds=width)][1] += Decimal(str(amount))
    return sorted(((*key, count, total) for key, (count, total) in totals.items()), key=str)


def test_window_is_half_open(transactions):
    rows = rows_of(window_profile(transactions([(1, 0, 1), (1, 59.999, 1), (1, 60, 1)]), CFG), "transaction_count")
    assert rows == [(1,), (2,)]


def test_profiles_match_brute_force(transactions, skewed):
    assert rows_of(window_profile(transactions(skewed), CFG), "*") == expected_profiles(skewed)


def test_order_of_events_does_not_matter(transactions, skewed):
    shuffled = random.Random(9).sample(skewed, len(skewed))
    assert rows_of(alerts(transactions(skewed), CFG), "*") == rows_of(alerts(transactions(shuffled), CFG), "*")


@pytest.mark.parametrize("salts, hot_rows", [(1, 3), (7, 0), (63, 3), (32, 100_000)])
def test_each_transaction_is_enriched_once(transactions, skewed, salts, hot_rows):
    tx = transactions(skewed)
    enriched = enrich(tx, RiskConfig(salts=salts, hot_rows=hot_rows))
    totals = {row[:3]: row[3:] for row in expected_profiles(skewed)}
    seen = enriched.collect()
    assert sorted(int(row.transaction_id) for row in seen) == list(range(len(skewed)))
    for row in seen:
        user, seconds, amount, *_ = skewed[int(row.transaction_id)]
        assert (row.user_id, row.amount) == (user, Decimal(str(amount)).quantize(Decimal("0.01")))
        assert row.window_start <= row.timestamp < row.window_end
        assert (row.transaction_count, row.total_amount) == totals[user, row.window_start, row.window_end]


def test_a_transaction_without_id_is_enriched_too(transactions):
    tx = transactions([(1, 0, 1), (1, 1, 2)]).withColumn("transaction_id", F.lit(None).cast("string"))
    assert rows_of(enrich(tx, CFG), "amount", "transaction_count") == [(Decimal("1.00"), 2), (Decimal("2.00"), 2)]


def test_a_hot_window_is_spread_over_join_keys(transactions):
    """Distinct join keys of one window: its transactions land on many tasks."""
    tx = transactions([(1, number / 100, 1) for number in range(2000)])
    salt = F.pmod(F.xxhash64("transaction_id", "timestamp", "amount", "city"), F.lit(CFG.salts))
    per_salt = [row["count"] for row in tx.groupBy(salt).count().collect()]
    assert len(per_salt) == CFG.salts and max(per_salt) < 3 * 2000 / CFG.salts


def test_only_hot_windows_are_copied(transactions):
    """Measured when the query runs: 300 rows in one window, one in each of 40."""
    rows = [(1, number / 10, 1) for number in range(300)] + [(2, 60 * number, 1) for number in range(40)]
    cfg = RiskConfig(salts=8, hot_rows=100)
    salted, copies = _salted(transactions(rows), cfg, default_rules(cfg))
    found = {row.user_id: row["count"] for row in copies.groupBy("user_id").count().collect()}
    assert found == {1: 8, 2: 40}
    assert salted.where("user_id = 1").select("salt").distinct().count() == 8
    assert salted.where("user_id = 2").agg(F.max("salt")).first()[0] == 0


def test_ingest_time_windows(transactions):
    tx = transactions([(1, 0, 1), (1, 3600, 2)]).withColumn("ingest_time", F.lit(T0.isoformat()).cast("timestamp"))
    rows = rows_of(window_profile(tx, RiskConfig(time_basis="ingest")), "window_start", "transaction_count")
    assert rows == [(T0, 2)]


def test_config_is_checked():
    with pytest.raises(ValueError):
        RiskConfig(time_basis="lunar")
    with pytest.raises(ValueError):
        RiskConfig(salts=64)
