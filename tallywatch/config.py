"""Settings, each with the documented default."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal

TIME_BASES = ("event", "ingest", "processing")


@dataclass(frozen=True)
class RiskConfig:
    """What a window is and when it counts as risky.

    ``time_basis`` picks the clock that assigns a transaction to its window:
    ``event`` (the transaction's own timestamp), ``ingest`` (the broker's
    record time) or ``processing`` (the wall clock of the micro-batch).
    Windows close ``watermark`` after the slowest source's clock; a source that
    has been silent for ``idle`` no longer holds the others back.
    ``salts`` is how many ways the rows of one window are spread when each row
    is joined with its window's totals (in batch only windows of more than
    ``hot_rows`` rows); a stream carries it as a bit mask, so <= 63.
    """

    window: str = "1 minute"
    amount_threshold: Decimal = Decimal("3000")
    count_threshold: int = 5
    time_basis: str = "event"
    watermark: str = "10 seconds"
    idle: str = "10 minutes"
    salts: int = 32
    hot_rows: int = 100_000
    keep_currency: bool = False

    def __post_init__(self):
        if self.time_basis not in TIME_BASES:
            raise ValueError(f"time_basis must be one of {TIME_BASES}, got {self.time_basis!r}")
        if not 1 <= self.salts <= 63:
            raise ValueError(f"salts must be between 1 and 63, got {self.salts}")

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> RiskConfig:
        return cls(
            window=env.get("RISK_WINDOW", cls.window),
            amount_threshold=Decimal(env.get("RISK_AMOUNT", str(cls.amount_threshold))),
            count_threshold=int(env.get("RISK_COUNT", cls.count_threshold)),
            time_basis=env.get("RISK_TIME_BASIS", cls.time_basis),
            watermark=env.get("RISK_WATERMARK", cls.watermark),
            idle=env.get("RISK_IDLE", cls.idle),
            keep_currency=env.get("KEEP_CURRENCY", "").lower() in ("1", "true", "yes"),
        )


@dataclass(frozen=True)
class JobConfig:
    """Where a job reads and writes."""

    brokers: str = "localhost:9092"
    topic: str = "financial_transactions"
    group_id: str = "tallywatch"
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int | None = None
    jdbc_url: str = "jdbc:postgresql://localhost:5432/postgres"
    jdbc_user: str = "postgres"
    jdbc_password: str = ""
    output_root: str | None = None
    checkpoint_root: str | None = None
    trigger_interval: str = "60 seconds"
    sink: str = "files"  # or "jdbc", which gets what the files get as well
    feed: bool = False

    def __post_init__(self):
        if self.sink not in ("files", "jdbc"):
            raise ValueError(f"sink must be 'files' or 'jdbc', got {self.sink!r}")

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> JobConfig:
        per_trigger = env.get("MAX_OFFSETS_PER_TRIGGER")
        return cls(
            brokers=env.get("KAFKA_BOOTSTRAP_SERVERS", cls.brokers),
            topic=env.get("INPUT_TOPIC", cls.topic),
            group_id=env.get("KAFKA_GROUP_ID", cls.group_id),
            starting_offsets=env.get("STARTING_OFFSETS", cls.starting_offsets),
            max_offsets_per_trigger=int(per_trigger) if per_trigger else None,
            jdbc_url=env.get("JDBC_URL", cls.jdbc_url),
            jdbc_user=env.get("POSTGRES_USER", cls.jdbc_user),
            jdbc_password=env.get("POSTGRES_PASSWORD", cls.jdbc_password),
            output_root=env.get("OUTPUT_ROOT"),
            checkpoint_root=env.get("CHECKPOINT_ROOT"),
            trigger_interval=env.get("TRIGGER_INTERVAL", cls.trigger_interval),
            sink=env.get("TABLE_SINK", cls.sink),
            feed=env.get("ALERT_FEED", "").lower() in ("1", "true", "yes"),
        )
