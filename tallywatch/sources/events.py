"""Transactions and messages derived from the ``events`` and ``nation`` tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch import schema


def _placed_events(events: DataFrame, nation: DataFrame) -> DataFrame:
    # Nations are 25 rows at every scale; shuffling events on 25 keys would skew.
    home = F.broadcast(nation.select("n_nationkey", "n_name", "n_regionkey"))
    return events.join(home, F.pmod(events["user_id"], F.lit(25)) == home["n_nationkey"])


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{sf_dir}/events.parquet"), spark.read.parquet(f"{sf_dir}/nation.parquet")


def _transaction(placed: DataFrame, *more: str) -> DataFrame:
    return placed.select(
        *more,
        F.col("event_id").cast("string").alias("transaction_id"),
        "user_id",
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").cast(schema.AMOUNT).alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("n_name").alias("city"),
        F.col("event_type").alias("merchant_category"),
    )


def from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a transaction."""
    return _transaction(_placed_events(*_tables(spark, sf_dir)))


def _message(placed: DataFrame, *more: str) -> DataFrame:
    """Each event as a message text. The kinds of event differ in form: views
    leave out amount and city, signups send numbers as text, and errors are
    broken in a way that depends on the user's region."""
    kind = F.col("event_type")
    user = F.col("user_id").cast("string")
    amount = F.col("value").cast(schema.AMOUNT)
    common = [
        F.col("event_id").cast("string").alias("transaction_id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.lit("EUR").alias("currency"),
        F.when(kind != "view", F.col("n_name")).alias("city"),
        kind.alias("merchant_category"),
    ]
    plain = F.to_json(F.struct(F.col("user_id"), F.when(kind != "view", amount).alias("amount"), *common))
    texts = F.to_json(F.struct(user.alias("user_id"), amount.cast("string").alias("amount"), *common))
    broken = (
        F.when(F.col("n_regionkey") == 0, F.concat(F.lit('{"user_id":'), user))
        .when(F.col("n_regionkey") == 1, F.concat(F.lit("["), user, F.lit("]")))
        .when(F.col("n_regionkey") == 2, F.concat(F.lit('{"amount":'), user, F.lit("}")))
        .when(F.col("n_regionkey") == 3, F.concat(F.lit('{"user_id":'), user, F.lit(',"amount":null}')))
        .otherwise(F.concat(F.lit('{"user_id":'), user, F.lit(',"amount":"abc"}')))
    )
    text = F.when(kind == "error", broken).when(kind == "signup", texts).otherwise(plain)
    return placed.select(*more, text.alias("value"))


def messages_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a message, well formed or not."""
    return _message(_placed_events(*_tables(spark, sf_dir)))


def event_files(spark: SparkSession, sf_dir: str, folder: str, well_formed: bool = True) -> None:
    """Writes every event as a message, all well formed or the same as
    ``messages_from_events``, to text files of five arrivals: four in order of
    time; some rows come in the last one only, some a second time, and one is
    dated far ahead for a user of its own (-1)."""
    events, nation = _tables(spark, sf_dir)
    number = F.col("event_id")
    late = number % 97 == 0
    turn = F.least(F.lit(3), F.floor((F.dayofmonth("ts") - 1) / 8)).cast("int")
    turns = F.array(F.when(late, 4).otherwise(turn), F.when((number % 10 == 0) & ~late, 4))
    placed = _placed_events(events.withColumn("arrival", F.explode(F.array_compact(turns))), nation)
    if well_formed:
        rows = _transaction(placed)
        fields = [name for name in rows.columns if name != "timestamp"]
        text = F.to_json(F.struct(*fields, F.unix_millis("timestamp").alias("timestamp")))
        sent = _transaction(placed, "arrival").select(text.alias("value"), "arrival")
        ahead = spark.range(1).select(
            F.lit('{"transaction_id":"ahead","user_id":-1,"timestamp":4102444800000,"amount":1}').alias("value"),
            F.lit(1).alias("arrival"),
        )
        sent = sent.unionByName(ahead)
    else:
        sent = _message(placed.where(F.col("arrival") < 4).unionByName(placed.where(late)), "arrival")
    spread = sent.repartition(20, "arrival", F.pmod(F.xxhash64("value"), F.lit(4)))
    spread.write.partitionBy("arrival").text(folder)


def message_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Writes every event once as a well-formed message."""
    rows = _transaction(_placed_events(*_tables(spark, sf_dir)))
    fields = [name for name in rows.columns if name != "timestamp"]
    rows.select(F.to_json(F.struct(*fields, F.unix_millis("timestamp").alias("timestamp")))).write.text(folder)
