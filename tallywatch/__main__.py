"""The streaming job. Reads the topic and keeps the transactions, alerts and
quarantine tables up to date until stopped.

Start ``job.py`` with ``spark-submit``, with the Kafka connector among the
packages (and the database's JDBC driver, with ``--jars``, when TABLE_SINK is
``jdbc``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallywatch.config import JobConfig, RiskConfig
from tallywatch.session import configure
from tallywatch.sources.messages import kafka_messages
from tallywatch.streaming.ledger import Tables, start_ledger_query
from tallywatch.streaming.sinks import jdbc_merge


def start(spark: SparkSession, job: JobConfig, cfg: RiskConfig) -> StreamingQuery:
    """Starts the job: one query, so every message is read once and reaches all
    tables or none."""
    if not job.output_root or not job.checkpoint_root:
        raise ValueError("set OUTPUT_ROOT and CHECKPOINT_ROOT to folders that all executors share")
    tables = Tables(job.output_root)
    follower = _database(job, tables) if job.sink == "jdbc" else None
    return start_ledger_query(
        kafka_messages(spark, job),
        tables,
        f"{job.checkpoint_root}/ledger",
        cfg,
        {"processingTime": job.trigger_interval},
        feed=job.feed,
        follower=follower,
    )


def _database(job: JobConfig, tables: Tables):
    """Sends a batch's new transactions and the alerts they touch, with the
    sums of all their parts, so that sending them twice does no harm."""
    writers = {name: jdbc_merge(job, name, f"{tables.root}/rejects/{name}") for name in ("transactions", "fraud_alerts")}

    def send(fresh: DataFrame, touched: DataFrame, batch_id: int) -> None:
        writers["transactions"](fresh, batch_id)
        writers["fraud_alerts"](touched, batch_id)

    return send


def main() -> None:
    spark = configure(SparkSession.builder.appName("tallywatch").getOrCreate(), streaming=True)
    start(spark, JobConfig.from_env(), RiskConfig.from_env()).awaitTermination()


if __name__ == "__main__":
    main()
