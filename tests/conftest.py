import json
import os
import sys
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallywatch import schema  # noqa: E402

TESTDATA = "/root/testdata"
T0 = datetime(2024, 1, 1, 12, 0, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Sets session options for one test."""
    before = {}

    def set_(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield set_
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def transactions(spark):
    """Transactions from (user, seconds after T0, amount[, city]) tuples."""

    def make(rows):
        full = []
        for number, (user, seconds, amount, *city) in enumerate(rows):
            when = T0 + timedelta(seconds=seconds)
            full.append(
                (str(number), user, when.isoformat(sep=" "), Decimal(str(amount)), "USD", *(city or ["Here"]), "retail")
            )
        text = spark.createDataFrame(
            full,
            "transaction_id string, user_id long, timestamp string, amount decimal(10,2),"
            " currency string, city string, merchant_category string",
        )
        return text.withColumn("timestamp", text["timestamp"].cast("timestamp")).select(*schema.TRANSACTION_COLUMNS)

    return make


def message(number, user, when, amount, **more):
    """One message text."""
    body = {
        "transaction_id": f"id-{number}",
        "user_id": user,
        "timestamp": int((when - datetime(1970, 1, 1)).total_seconds() * 1000),
        "amount": amount,
        "currency": "USD",
        "city": "Here",
        "merchant_category": "retail",
    }
    return json.dumps({**body, **more})


def rows_of(frame, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(row) for row in frame.select(*columns).collect()), key=str)
