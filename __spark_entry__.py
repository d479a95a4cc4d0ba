"""Entry points for checking and timing: the flagship query, every query on
the given tables, and the SQL each one must equal.

``events`` joined with ``nation`` plays the transactions table. Its amounts
are small, so rule-dependent queries use one-day windows and a limit of 300."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch import schema
from tallywatch.config import RiskConfig
from tallywatch.functions import rules
from tallywatch.functions.parse import parse_transactions
from tallywatch.functions.time import utc_date
from tallywatch.operators import interval_join, profile, quality, tables
from tallywatch.plans import reports, views
from tallywatch.session import configure, shared_folder
from tallywatch.sources import events, tables as stored
from tallywatch.sources.messages import file_messages
from tallywatch.streaming import jobs, rollups, sinks
from tallywatch.streaming.ledger import Tables, start_ledger_query

try:
    # The optional subpackage, with the packages that it needs, and the pipeline built on it.
    import corpus_pipeline
    from tallywatch.llm import queries as llm
except ImportError as error:
    if (error.name or "").startswith("tallywatch.") and not (error.name or "").startswith("tallywatch.llm"):
        raise
    corpus_pipeline = llm = None

AS_OF = "2024-01-31 00:00:00"
DAILY = RiskConfig(window="1 day", amount_threshold=Decimal("300"), watermark="0 seconds")
MINUTELY = RiskConfig()
CUT = "2024-01-16 12:00:00"
ONCE = {"availableNow": True}

Query = Callable[[SparkSession, str], DataFrame]


def _plain(rows: DataFrame) -> DataFrame:
    """Zone-less timestamps and doubles, for comparison with other engines."""

    def shown(field: T.StructField):
        if isinstance(field.dataType, T.TimestampType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        return F.col(field.name)

    return rows.select(*(shown(field) for field in rows.schema.fields))


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.from_events(configure(spark), sf_dir)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.messages_from_events(configure(spark), sf_dir)


def _on_transactions(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _plain(build(_transactions(spark, sf_dir)))


def _on_alerts(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_transactions(lambda tx: build(profile.alerts(tx, DAILY)))


def _on_both(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return _on_transactions(lambda tx: build(tx, profile.alerts(tx, DAILY)))


def _custom_rules() -> list[rules.Rule]:
    return [
        rules.Rule(
            "large_average",
            "total_amount > 100 * transaction_count",
            F.concat(F.lit("High average over "), F.col("transaction_count").cast("string")),
        ),
        rules.Rule("busy", F.col("transaction_count") >= 4, "'Busy window'"),
    ]


def _rows_with_defaults(tx: DataFrame) -> DataFrame:
    no_currency_on_views = F.when(F.col("merchant_category") != "view", F.col("currency"))
    return tables.transactions_rows(tx.withColumn("currency", no_currency_on_views))


def _insert_ignore(tx: DataFrame) -> DataFrame:
    """Purchases are stored already; everything then arrives twice, doubled."""
    stored_rows = tx.where(F.col("merchant_category") == "purchase")
    again = tx.withColumn("amount", (F.col("amount") * 2).cast("decimal(10,2)"))
    incoming = again.unionByName(again)
    return stored_rows.unionByName(tables.insert_ignore(stored_rows, incoming))


def _alert_versions(tx: DataFrame) -> list[DataFrame]:
    """A first batch sees the windows of the cut-off day half filled; a second
    one replaces those and adds the rest."""
    cut = F.lit(CUT).cast("timestamp")
    batches = [
        ("2024-02-01 00:00:00", tx.where(F.col("timestamp") < cut)),
        ("2024-02-02 00:00:00", tx.where(F.col("timestamp") >= F.date_trunc("day", cut))),
    ]
    return [
        profile.alerts(seen, DAILY).withColumns(
            {name: F.lit(written).cast("timestamp") for name in ("created_at", "updated_at")}
        )
        for written, seen in batches
    ]


def _upsert_alerts(tx: DataFrame) -> DataFrame:
    return tables.current_alerts(reduce(DataFrame.unionByName, _alert_versions(tx)))


def _constraint_report(tx: DataFrame, alerts: DataFrame) -> DataFrame:
    """Rows spoiled by kind: no city on errors, long currency on signups, long
    category on views, inflated amounts and a second copy of purchases; flag 2
    for five transactions, no reason for one, and fraud alerts twice."""
    kind = F.col("merchant_category")
    spoiled = tx.unionByName(tx.where(kind == "purchase")).select(
        "transaction_id",
        "user_id",
        "timestamp",
        F.when(kind == "purchase", F.col("amount") * 1_000_000).otherwise(F.col("amount")).alias("amount"),
        F.when(kind == "signup", F.lit("DOLLAR")).otherwise(F.col("currency")).alias("currency"),
        F.when(kind != "error", F.col("city")).alias("city"),
        F.when(kind == "view", F.repeat(kind, F.lit(26))).otherwise(kind).alias("merchant_category"),
    )
    count = F.col("transaction_count")
    spoiled_alerts = alerts.unionByName(alerts.where(F.col("is_fraud") == 1)).withColumns(
        {
            "is_fraud": F.when(count == 5, F.lit(2)).otherwise(F.col("is_fraud")),
            "alert_reason": F.when(count != 1, F.col("alert_reason")),
        }
    )
    return quality.constraint_report(spoiled, spoiled_alerts)


def _snapshot_rows(tx: DataFrame, alerts: DataFrame) -> DataFrame:
    """The snapshot document read back into rows."""
    document = reports.stats_snapshot(tx, alerts, AS_OF).select("document")
    layout = (
        "fraudStats struct<total_alerts:bigint,fraud_count:bigint,fraud_total_amount:decimal(20,2),"
        "unique_users_flagged:bigint>,"
        "transactionsPerMinute array<struct<minute:string,transaction_count:bigint,total_volume:decimal(20,2)>>,"
        "recentAlerts array<struct<user_id:bigint,window_end:string,transaction_count:bigint,"
        "total_amount:decimal(20,2)>>,"
        "timestamp string"
    )
    parsed = document.select(F.from_json("document", layout).alias("d")).select("d.*")

    def entry_of(part: str, label, n, amount):
        return F.struct(
            F.lit(part).alias("part"), label.alias("label"), n.alias("n"), amount.cast("double").alias("amount")
        )

    stats = F.col("fraudStats")
    entries = F.concat(
        F.array(
            entry_of("fraud", F.col("timestamp"), stats["fraud_count"], stats["fraud_total_amount"]),
            entry_of("all", F.col("timestamp"), stats["total_alerts"], stats["unique_users_flagged"]),
        ),
        F.transform(
            "transactionsPerMinute",
            lambda m: entry_of("minute", m["minute"], m["transaction_count"], m["total_volume"]),
        ),
        F.transform(
            "recentAlerts",
            lambda a: entry_of(
                "alert",
                F.concat_ws("#", a["window_end"], a["user_id"].cast("string")),
                a["transaction_count"],
                a["total_amount"],
            ),
        ),
    )
    return parsed.select(F.inline(entries))


def _registered_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = _transactions(spark, sf_dir)
    views.register_views(spark, tx, profile.alerts(tx, DAILY), AS_OF)
    return spark.sql(
        """
        SELECT 'transactions_per_minute' AS view_name, count(*) AS n, CAST(sum(total_volume) AS DOUBLE) AS amount
        FROM transactions_per_minute
        UNION ALL
        SELECT 'fraud_by_city', sum(fraud_count), CAST(sum(total_fraud_amount) AS DOUBLE) FROM fraud_by_city
        UNION ALL
        SELECT 'fraud_stats_24h', total_alerts, CAST(fraud_total_amount AS DOUBLE) FROM fraud_stats_24h
        """
    )


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _compacted_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two batches of the upsert, stored as a log and folded by compaction."""
    folder = _folder(spark, "compaction")
    for batch_id, versions in enumerate(_alert_versions(_transactions(spark, sf_dir))):
        dated = versions.withColumns(
            {
                "alert_date": utc_date(F.col("window_end")),
                "query_id": F.lit("entry"),
                "batch_id": F.lit(batch_id).cast("long"),
            }
        )
        dated.write.mode("append").partitionBy("alert_date", "query_id", "batch_id").parquet(f"{folder}/log")
    sinks.compact_alerts(spark, f"{folder}/log", f"{folder}/compact")
    return _plain(stored.alerts_log(spark, f"{folder}/compact").select(*schema.ALERT_COLUMNS, "created_at"))


def _ledger(spark: SparkSession, sf_dir: str, well_formed: bool = True) -> Tables:
    """Runs the job over all events, which arrive in several batches, some rows
    late, some twice and one dated far ahead; returns the tables it wrote."""
    configure(spark, streaming=True)
    folder = _folder(spark, "ledger")
    events.event_files(spark, sf_dir, f"{folder}/messages", well_formed)
    messages = file_messages(spark, f"{folder}/messages", max_files_per_trigger=7)
    tables = Tables(f"{folder}/tables")
    start_ledger_query(messages, tables, f"{folder}/checkpoint", DAILY, ONCE).awaitTermination()
    return tables


def _sent(rows: DataFrame) -> DataFrame:
    """Without the user of the message that is dated ahead."""
    return rows.where(F.col("user_id") >= 0)


def _streaming_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored.stored_transactions(spark, _ledger(spark, sf_dir).transactions)
    return _plain(_sent(rows).select(*schema.TRANSACTION_COLUMNS))


def _streaming_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored.ledger_alerts(spark, _ledger(spark, sf_dir).alert_parts, DAILY)
    return _plain(_sent(found).select(*schema.ALERT_COLUMNS))


def _streaming_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job emitted as final."""
    return _plain(stored.closed_alerts(spark, _ledger(spark, sf_dir).closed_alerts).select(*schema.ALERT_COLUMNS))


def _streaming_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _ledger(spark, sf_dir)
    rows = stored.stored_transactions(spark, tables.transactions)
    return _plain(profile.enrich_from_alerts(rows, stored.closed_alerts(spark, tables.closed_alerts), DAILY))


def _stream_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions joined with their windows within the stream, emitted when
    their window closes."""
    configure(spark, streaming=True)
    folder = _folder(spark, "stream-join")
    events.message_files(spark, sf_dir, f"{folder}/messages")
    messages = file_messages(spark, f"{folder}/messages")
    jobs.start_enriched_query(messages, f"{folder}/table", f"{folder}/checkpoint", DAILY, ONCE).awaitTermination()
    return _plain(spark.read.parquet(f"{folder}/table").select(*schema.ENRICHED_COLUMNS))


def _rollup_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports as read from the job's rollups, one row for each figure."""
    tables = _ledger(spark, sf_dir)

    def row(report: str, label, n, amount) -> list:
        return [F.lit(report).alias("report"), label.alias("label"), n.alias("n"), amount.cast("double").alias("amount")]

    minutes = rollups.per_minute(spark, tables.minutes, AS_OF)
    cities = rollups.fraud_by_city(spark, tables.alert_parts, DAILY, AS_OF)
    stats = rollups.fraud_stats(spark, tables.stats, tables.users, tables.alert_parts, AS_OF)
    counts = rollups.table_counts(spark, tables.minutes, tables.stats)
    col, none = F.col, F.lit(None)
    return (
        minutes.select(*row("minute", F.date_format("minute", "yyyy-MM-dd HH:mm"), col("transaction_count"), col("total_volume")))
        .unionByName(cities.select(*row("city", col("city"), col("fraud_count"), col("total_fraud_amount"))))
        .unionByName(stats.select(*row("stats", F.lit("fraud"), col("fraud_count"), col("fraud_total_amount"))))
        .unionByName(stats.select(*row("stats", F.lit("all"), col("total_alerts"), col("unique_users_flagged"))))
        .unionByName(counts.select(*row("count", col("table_name"), col("row_count"), none)))
    )


def _streaming_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored.stored_quarantine(spark, _ledger(spark, sf_dir, well_formed=False).quarantine)


def entry(spark: SparkSession) -> DataFrame:
    """Scored windows of every user."""
    return queries()["alerts"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    optional = {**llm.queries(), "pipeline": corpus_pipeline.run} if llm else {}
    return {**core_queries(), **optional}


def oracle_sql() -> dict[str, str]:
    optional = dict(llm.oracle_sql()) if llm else {}
    if llm and corpus_pipeline.ORACLE_SQL:
        optional["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**core_oracle_sql(), **optional}


def core_queries() -> dict[str, Query]:
    return {
        "parse_transactions": lambda spark, sf: _plain(parse_transactions(_messages(spark, sf))[0]),
        "quarantine": lambda spark, sf: _plain(parse_transactions(_messages(spark, sf))[1]),
        "transactions_rows": _on_transactions(_rows_with_defaults),
        "window_profile": _on_transactions(lambda tx: profile.window_profile(tx, MINUTELY)),
        "alerts": _on_transactions(lambda tx: profile.alerts(tx, DAILY)),
        "alerts_custom_rules": _on_transactions(lambda tx: profile.alerts(tx, DAILY, _custom_rules())),
        "alert_feed": _on_alerts(rules.alert_feed),
        "enriched_transactions": _on_transactions(lambda tx: profile.enrich(tx, DAILY)),
        "insert_ignore": _on_transactions(_insert_ignore),
        "upsert_alerts": _on_transactions(lambda tx: _upsert_alerts(tx).drop("updated_at")),
        "compacted_alerts": _compacted_alerts,
        "flagged_transactions": _on_both(
            lambda tx, alerts: interval_join.flagged_transactions(
                tx, alerts.where("is_fraud = 1").select("user_id", "window_start", "window_end")
            ).select("transaction_id", "user_id", "timestamp", "amount", "city", "window_start", "window_end")
        ),
        "transactions_per_minute": _on_transactions(lambda tx: views.transactions_per_minute(tx, AS_OF)),
        "transactions_per_minute_api": _on_transactions(
            lambda tx: views.transactions_per_minute(tx, AS_OF, ascending=True, zero_fill=True)
        ),
        "fraud_by_city": _on_both(
            lambda tx, alerts: views.fraud_by_city(tx, alerts, AS_OF)
        ),
        "fraud_stats": _on_alerts(lambda alerts: views.fraud_stats(alerts, AS_OF)),
        "fraud_stats_api": _on_alerts(lambda alerts: views.fraud_stats(alerts, AS_OF, zero_fill=True)),
        "recent_alerts": _on_alerts(views.recent_alerts),
        "top_fraud_alerts": _on_alerts(lambda alerts: views.recent_alerts(alerts, 10, columns=None)),
        "table_counts": _on_both(views.table_counts),
        "chart_series": _on_transactions(
            lambda tx: reports.chart_series(views.transactions_per_minute(tx, AS_OF, ascending=True, zero_fill=True))
        ),
        "kpi_cards": _on_alerts(lambda alerts: reports.kpi_cards(views.fraud_stats(alerts, AS_OF, zero_fill=True))),
        "recent_alerts_display": _on_alerts(
            lambda alerts: reports.recent_alerts_display(views.recent_alerts(alerts))
        ),
        "stats_snapshot": _on_both(_snapshot_rows),
        "registered_views": _registered_views,
        "constraint_report": _on_both(_constraint_report),
        "retention": _on_transactions(lambda tx: tables.retained(tx, "timestamp", AS_OF, days=7)),
        "retention_alerts": _on_alerts(lambda alerts: tables.retained(alerts, "window_end", AS_OF, days=7)),
        "streaming_transactions": _streaming_transactions,
        "streaming_alerts": _streaming_alerts,
        "streaming_upserts": _streaming_upserts,
        "streaming_enriched": _streaming_enriched,
        "streaming_quarantine": _streaming_quarantine,
        "streaming_join": _stream_join,
        "rollup_reports": _rollup_reports,
    }


# The transactions table and the daily alerts in SQL.
_TX = """
tx AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, user_id, ts AS timestamp,
         CAST(value AS DECIMAL(10,2)) AS amount, 'USD' AS currency, n_name AS city,
         event_type AS merchant_category, n_regionkey
  FROM events JOIN nation ON n_nationkey = user_id % 25
)"""

_PROFILE = """
profile AS (
  SELECT user_id, date_trunc('day', timestamp) AS window_start,
         date_trunc('day', timestamp) + INTERVAL '1 day' AS window_end,
         count(*) AS transaction_count, sum(amount) AS total
  FROM tx GROUP BY ALL
)"""

_ALERTS = """
al AS (
  SELECT user_id, window_start, window_end, transaction_count, total,
         CASE WHEN total > 300 OR transaction_count > 5 THEN 1 ELSE 0 END AS is_fraud,
         CASE WHEN total > 300 AND transaction_count > 5
              THEN 'High total amount: $' || CAST(total AS VARCHAR)
                   || '; High transaction count: ' || CAST(transaction_count AS VARCHAR)
              WHEN total > 300 THEN 'High total amount: $' || CAST(total AS VARCHAR)
              WHEN transaction_count > 5 THEN 'High transaction count: ' || CAST(transaction_count AS VARCHAR)
              ELSE 'Normal activity' END AS alert_reason
  FROM profile
)"""

_WITH_TX = f"WITH {_TX}"
_WITH_ALERTS = f"WITH {_TX}, {_PROFILE}, {_ALERTS}"
_NOW = f"TIMESTAMP '{AS_OF}'"

_ALERT_COLUMNS = """user_id, window_start, window_end, transaction_count,
  CAST(total AS DOUBLE) AS total_amount, is_fraud, alert_reason"""

_TX_COLUMNS = """transaction_id, user_id, timestamp, CAST(amount AS DOUBLE) AS amount, currency, city,
  merchant_category"""

_MINUTES = f"""
minutes AS (
  SELECT date_trunc('minute', timestamp) AS minute, count(*) AS transaction_count, sum(amount) AS total,
         CAST(sum(amount) AS DOUBLE) / count(*) AS avg_amount
  FROM tx WHERE timestamp >= {_NOW} - INTERVAL '1 hour' GROUP BY ALL
)"""

_PER_MINUTE = f"""{_WITH_TX}, {_MINUTES}
SELECT minute, transaction_count, CAST(total AS DOUBLE) AS total_volume, avg_amount FROM minutes ORDER BY minute"""

_STATS = f"""
stats AS (
  SELECT count(*) AS total_alerts, count(*) FILTER (WHERE is_fraud = 1) AS fraud_count,
         sum(total) FILTER (WHERE is_fraud = 1) AS fraud_total,
         count(DISTINCT user_id) AS unique_users_flagged
  FROM al WHERE window_end >= {_NOW} - INTERVAL '24 hours'
)"""

_RECENT = """
recent AS (
  SELECT * FROM al WHERE is_fraud = 1 ORDER BY window_end DESC, user_id LIMIT 20
)"""

_FLAGGED = """
flagged AS (
  SELECT t.*, a.window_start, a.window_end
  FROM tx t JOIN al a ON t.user_id = a.user_id AND t.timestamp >= a.window_start AND t.timestamp < a.window_end
  WHERE a.is_fraud = 1
)"""

_BY_CITY = f"""
by_city AS (
  SELECT city, count(*) AS fraud_count, sum(amount) AS total
  FROM flagged WHERE window_end >= {_NOW} - INTERVAL '1 hour' GROUP BY city
)"""

# What the transactions look like after a trip through a message.
_SENT = """
sent AS (
  SELECT * REPLACE (date_trunc('milliseconds', timestamp) AS timestamp) FROM tx
)"""

_ENRICHED_COLUMNS = """t.transaction_id, t.user_id, CAST(t.amount AS DOUBLE) AS amount, t.city,
  t.merchant_category, t.timestamp, a.window_start, a.window_end, a.transaction_count,
  CAST(a.total AS DOUBLE) AS total_amount, a.is_fraud, a.alert_reason"""

_CLOSED = "window_end <= (SELECT max(date_trunc('milliseconds', ts)) FROM events)"


def _dollars(amount: str) -> str:
    return f"'$' || format('{{:,}}', CAST(round({amount}, 0) AS BIGINT))"


def _constraint_sql() -> str:
    tx_rules = {
        "transaction_id not null": "transaction_id IS NULL",
        "user_id not null": "user_id IS NULL",
        "timestamp not null": "timestamp IS NULL",
        "amount not null": "amount IS NULL",
        "currency not null": "currency IS NULL",
        "city not null": "city IS NULL",
        "merchant_category not null": "merchant_category IS NULL",
        "currency length": "length(currency) > 3",
        "city length": "length(city) > 255",
        "merchant_category length": "length(merchant_category) > 100",
        "amount range": "abs(amount) >= 100000000",
    }
    alert_rules = {
        "user_id not null": "user_id IS NULL",
        "window_start not null": "window_start IS NULL",
        "window_end not null": "window_end IS NULL",
        "transaction_count not null": "transaction_count IS NULL",
        "total_amount not null": "total IS NULL",
        "is_fraud not null": "is_fraud IS NULL",
        "alert_reason not null": "alert_reason IS NULL",
        "is_fraud in (0, 1)": "is_fraud NOT IN (0, 1)",
        "total_amount range": "abs(total) >= 100000000",
    }
    parts = [
        f"SELECT 'transactions' AS table_name, '{rule}' AS rule, count(*) FILTER (WHERE {broken}) AS violations"
        " FROM bad_tx"
        for rule, broken in tx_rules.items()
    ]
    parts += [
        f"SELECT 'fraud_alerts', '{rule}', count(*) FILTER (WHERE {broken}) FROM bad_al"
        for rule, broken in alert_rules.items()
    ]
    parts += [
        "SELECT 'transactions', 'unique (transaction_id)', count(*) - count(DISTINCT transaction_id) FROM bad_tx",
        "SELECT 'fraud_alerts', 'unique (user_id, window_end)', count(*) - count(DISTINCT (user_id, window_end))"
        " FROM bad_al",
    ]
    return f"""{_WITH_ALERTS},
    bad_tx AS (
      SELECT transaction_id, user_id, timestamp,
             CASE WHEN merchant_category = 'purchase' THEN CAST(amount AS DECIMAL(20,2)) * 1000000
                  ELSE amount END AS amount,
             CASE WHEN merchant_category = 'signup' THEN 'DOLLAR' ELSE currency END AS currency,
             CASE WHEN merchant_category <> 'error' THEN city END AS city,
             CASE WHEN merchant_category = 'view' THEN repeat(merchant_category, 26)
                  ELSE merchant_category END AS merchant_category
      FROM (SELECT * FROM tx UNION ALL SELECT * FROM tx WHERE merchant_category = 'purchase')
    ),
    bad_al AS (
      SELECT * REPLACE (CASE WHEN transaction_count = 5 THEN 2 ELSE is_fraud END AS is_fraud,
                        CASE WHEN transaction_count <> 1 THEN alert_reason END AS alert_reason)
      FROM (SELECT * FROM al UNION ALL SELECT * FROM al WHERE is_fraud = 1)
    )
    {' UNION ALL '.join(parts)}"""


_QUARANTINE = f"""{_WITH_TX}
SELECT CASE n_regionkey WHEN 0 THEN '{{"user_id":' || user_id
                        WHEN 1 THEN '[' || user_id || ']'
                        WHEN 2 THEN '{{"amount":' || user_id || '}}'
                        WHEN 3 THEN '{{"user_id":' || user_id || ',"amount":null}}'
                        ELSE '{{"user_id":' || user_id || ',"amount":"abc"}}' END AS value,
       CASE n_regionkey WHEN 0 THEN 'bad_json' WHEN 1 THEN 'not_object' WHEN 2 THEN 'missing_user'
                        WHEN 3 THEN 'null_amount' ELSE 'bad_amount' END AS reject_reason
FROM tx WHERE merchant_category = 'error'"""

_UPSERTED = f"""{_WITH_ALERTS},
early AS (SELECT DISTINCT user_id, date_trunc('day', timestamp) AS window_start
          FROM tx WHERE timestamp < TIMESTAMP '{CUT}')
SELECT {_ALERT_COLUMNS},
       CASE WHEN EXISTS (SELECT 1 FROM early e WHERE e.user_id = al.user_id AND e.window_start = al.window_start)
            THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-02-02' END AS created_at
FROM al"""


def core_oracle_sql() -> dict[str, str]:
    alerts = f"{_WITH_ALERTS} SELECT {_ALERT_COLUMNS} FROM al"
    stats = f"{_WITH_ALERTS}, {_STATS} SELECT total_alerts, fraud_count"
    return {
        "parse_transactions": f"""{_WITH_TX}
            SELECT transaction_id, user_id, date_trunc('milliseconds', timestamp) AS timestamp,
                   CASE WHEN merchant_category = 'view' THEN 0.0 ELSE CAST(amount AS DOUBLE) END AS amount,
                   currency, CASE WHEN merchant_category = 'view' THEN '' ELSE city END AS city, merchant_category
            FROM tx WHERE merchant_category <> 'error'""",
        "quarantine": _QUARANTINE,
        "transactions_rows": f"{_WITH_TX} SELECT {_TX_COLUMNS} FROM tx",
        "window_profile": f"""{_WITH_TX}
            SELECT user_id, date_trunc('minute', timestamp) AS window_start,
                   date_trunc('minute', timestamp) + INTERVAL '1 minute' AS window_end,
                   count(*) AS transaction_count, CAST(sum(amount) AS DOUBLE) AS total_amount
            FROM tx GROUP BY 1, 2, 3""",
        "alerts": alerts,
        "alerts_custom_rules": f"""WITH {_TX}, {_PROFILE}
            SELECT user_id, window_start, window_end, transaction_count, CAST(total AS DOUBLE) AS total_amount,
                   CASE WHEN total > 100 * transaction_count OR transaction_count >= 4 THEN 1 ELSE 0 END AS is_fraud,
                   CASE WHEN total > 100 * transaction_count AND transaction_count >= 4
                        THEN 'High average over ' || transaction_count || '; Busy window'
                        WHEN total > 100 * transaction_count THEN 'High average over ' || transaction_count
                        WHEN transaction_count >= 4 THEN 'Busy window'
                        ELSE 'Normal activity' END AS alert_reason
            FROM profile""",
        "alert_feed": f"""{_WITH_ALERTS}
            SELECT user_id, window_end, '🚨 FRAUD ALERT: User ' || user_id || ' - ' || alert_reason AS message
            FROM al WHERE is_fraud = 1""",
        "enriched_transactions": f"""{_WITH_ALERTS}
            SELECT {_ENRICHED_COLUMNS}
            FROM tx t JOIN al a ON t.user_id = a.user_id AND date_trunc('day', t.timestamp) = a.window_start""",
        "insert_ignore": f"""{_WITH_TX}
            SELECT transaction_id, user_id, timestamp,
                   CAST(CASE WHEN merchant_category = 'purchase' THEN amount ELSE amount * 2 END AS DOUBLE) AS amount,
                   currency, city, merchant_category
            FROM tx""",
        "upsert_alerts": _UPSERTED,
        "compacted_alerts": _UPSERTED,
        "flagged_transactions": f"""{_WITH_ALERTS}, {_FLAGGED}
            SELECT transaction_id, user_id, timestamp, CAST(amount AS DOUBLE) AS amount, city, window_start, window_end
            FROM flagged""",
        "transactions_per_minute": _PER_MINUTE,
        "transactions_per_minute_api": _PER_MINUTE,
        "fraud_by_city": f"""{_WITH_ALERTS}, {_FLAGGED}, {_BY_CITY}
            SELECT city, fraud_count, CAST(total AS DOUBLE) AS total_fraud_amount FROM by_city""",
        "fraud_stats": f"{stats}, CAST(fraud_total AS DOUBLE) AS fraud_total_amount, unique_users_flagged FROM stats",
        "fraud_stats_api": f"""{stats}, CAST(coalesce(fraud_total, 0) AS DOUBLE) AS fraud_total_amount,
            unique_users_flagged FROM stats""",
        "recent_alerts": f"""{_WITH_ALERTS}, {_RECENT}
            SELECT user_id, window_end, transaction_count, CAST(total AS DOUBLE) AS total_amount, alert_reason
            FROM recent""",
        "top_fraud_alerts": f"""{_WITH_ALERTS}, {_RECENT}
            SELECT {_ALERT_COLUMNS} FROM recent ORDER BY window_end DESC, user_id LIMIT 10""",
        "table_counts": f"""{_WITH_ALERTS}
            SELECT 'transactions' AS table_name, count(*) AS row_count FROM tx
            UNION ALL SELECT 'fraud_alerts', count(*) FROM al WHERE is_fraud = 1""",
        "chart_series": f"""{_WITH_TX}, {_MINUTES}
            SELECT minute, strftime(minute, '%I:%M %p') AS time, transaction_count AS transactions,
                   CAST(floor(total + 0.5) AS BIGINT) AS volume
            FROM minutes""",
        "kpi_cards": f"""{_WITH_ALERTS}, {_STATS}
            SELECT fraud_count AS fraud_detected, {_dollars('coalesce(fraud_total, 0)')} AS fraud_amount,
                   total_alerts, unique_users_flagged AS users_flagged,
                   least(CAST(fraud_count AS DOUBLE) / 100 * 100, 100.0::DOUBLE) AS progress
            FROM stats""",
        "recent_alerts_display": f"""{_WITH_ALERTS}, {_RECENT}
            SELECT window_end, '#' || user_id AS "user", {_dollars('total')} AS amount,
                   transaction_count AS transactions, strftime(window_end, '%I:%M %p') AS time
            FROM recent""",
        "stats_snapshot": f"""{_WITH_ALERTS}, {_STATS}, {_RECENT}, {_MINUTES}
            SELECT 'fraud' AS part, strftime({_NOW}, '%Y-%m-%dT%H:%M:%S.000Z') AS label, fraud_count AS n,
                   CAST(coalesce(fraud_total, 0) AS DOUBLE) AS amount FROM stats
            UNION ALL
            SELECT 'all', strftime({_NOW}, '%Y-%m-%dT%H:%M:%S.000Z'), total_alerts,
                   CAST(unique_users_flagged AS DOUBLE) FROM stats
            UNION ALL
            SELECT 'minute', strftime(minute, '%Y-%m-%dT%H:%M:%S.000Z'), transaction_count, CAST(total AS DOUBLE)
            FROM minutes
            UNION ALL
            SELECT 'alert', strftime(window_end, '%Y-%m-%dT%H:%M:%S.000Z') || '#' || user_id, transaction_count,
                   CAST(total AS DOUBLE) FROM recent""",
        "registered_views": f"""{_WITH_ALERTS}, {_STATS}, {_FLAGGED}, {_BY_CITY}, {_MINUTES}
            SELECT 'transactions_per_minute' AS view_name, count(*) AS n, CAST(sum(total) AS DOUBLE) AS amount
            FROM minutes
            UNION ALL SELECT 'fraud_by_city', CAST(sum(fraud_count) AS BIGINT), CAST(sum(total) AS DOUBLE) FROM by_city
            UNION ALL SELECT 'fraud_stats_24h', total_alerts, CAST(fraud_total AS DOUBLE) FROM stats""",
        "constraint_report": _constraint_sql(),
        "retention": f"""{_WITH_TX} SELECT {_TX_COLUMNS} FROM tx WHERE timestamp >= {_NOW} - INTERVAL '7 days'""",
        "retention_alerts": f"{alerts} WHERE window_end >= {_NOW} - INTERVAL '7 days'",
        "streaming_transactions": f"{_WITH_TX}, {_SENT} SELECT {_TX_COLUMNS} FROM sent",
        "streaming_alerts": f"{alerts} WHERE {_CLOSED}",
        "streaming_upserts": alerts,
        "streaming_enriched": f"""{_WITH_ALERTS}, {_SENT}
            SELECT {_ENRICHED_COLUMNS}
            FROM sent t JOIN al a ON t.user_id = a.user_id AND date_trunc('day', t.timestamp) = a.window_start
            WHERE a.{_CLOSED}""",
        "streaming_quarantine": _QUARANTINE,
        "streaming_join": f"""{_WITH_ALERTS}, {_SENT}
            SELECT {_ENRICHED_COLUMNS}
            FROM sent t JOIN al a ON t.user_id = a.user_id AND date_trunc('day', t.timestamp) = a.window_start
            WHERE a.{_CLOSED}""",
        # The message that is dated ahead is one more transaction, minute, alert and user.
        "rollup_reports": f"""{_WITH_ALERTS}, {_STATS}, {_FLAGGED}, {_BY_CITY}, {_MINUTES}
            SELECT 'minute' AS report, strftime(minute, '%Y-%m-%d %H:%M') AS label, transaction_count AS n,
                   CAST(total AS DOUBLE) AS amount FROM minutes
            UNION ALL SELECT 'minute', '2100-01-01 00:00', 1, 1.0
            UNION ALL SELECT 'city', city, fraud_count, CAST(total AS DOUBLE) FROM by_city
            UNION ALL SELECT 'stats', 'fraud', fraud_count, CAST(coalesce(fraud_total, 0) AS DOUBLE) FROM stats
            UNION ALL SELECT 'stats', 'all', total_alerts + 1, CAST(unique_users_flagged + 1 AS DOUBLE) FROM stats
            UNION ALL SELECT 'count', 'transactions', count(*) + 1, NULL FROM tx
            UNION ALL SELECT 'count', 'fraud_alerts', count(*) FILTER (WHERE is_fraud = 1), NULL FROM al""",
    }
