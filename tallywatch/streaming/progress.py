"""How far the sources have come: which windows are final, and how late rows are.

Each source partition has a clock, the highest time among its rows; a row dated
after the broker received it says nothing about the time and is left out, so a
wrong clock neither closes windows nor holds them open. Time has passed up to the
lowest clock of the partitions that still deliver, less the allowed delay."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch import schema
from tallywatch.config import RiskConfig
from tallywatch.functions.time import micros
from tallywatch.operators.profile import TIME_COLUMN, window_column
from tallywatch.sources.tables import batch_marks, table_rows

SKEW = "1 second"  # how far a sender's clock may run ahead of the broker's


@dataclass
class Progress:
    """The clocks at a batch's start. ``low`` is the time up to which windows have
    been closed; ``version`` counts batches; ``late`` is how many rows of the last
    batch fell into closed windows."""

    high: dict[str, datetime] = field(default_factory=dict)
    seen: dict[str, datetime] = field(default_factory=dict)
    low: datetime | None = None
    version: int = 0
    late: int = 0

    @classmethod
    def stored(cls, spark: SparkSession, progress: str) -> Progress:
        """As whole batches have left it."""
        marks = batch_marks(spark, progress)
        if marks is None:
            return cls()
        clocks = table_rows(spark, progress, schema.PROGRESS).groupBy("source")
        rows = clocks.agg(F.max("high").alias("high"), F.max("seen").alias("seen")).collect()
        last = marks.agg(F.max("low").alias("low"), F.max("version").alias("version")).first()
        state = cls(low=last["low"], version=last["version"] or 0)
        state._take(rows)
        return state

    def _take(self, rows: list) -> None:
        for row in rows:
            for clocks, value in ((self.high, row["high"]), (self.seen, row["seen"])):
                if value is not None:
                    clocks[row["source"]] = max(value, clocks.get(row["source"], value))

    def after(self, rows: list, cfg: RiskConfig) -> Progress:
        """The clocks after a batch with these rows of ``source_progress``."""
        state = Progress(dict(self.high), dict(self.seen), self.low, self.version + 1, sum(row["late"] for row in rows))
        state._take(rows)
        idle = timedelta(microseconds=micros(cfg.idle))
        newest = max(state.seen.values(), default=None)
        active = [high for source, high in state.high.items() if newest - state.seen[source] <= idle]
        if active:
            low = min(active) - timedelta(microseconds=micros(cfg.watermark))
            state.low = low if state.low is None else max(low, state.low)
        return state


    def days_until(self, later: Progress) -> tuple[date, date] | None:
        """The days in UTC that windows closed since then ended on; None where
        there are too many to name."""
        if self.low is None or later.low - self.low > timedelta(days=400):
            return None
        return self.low.astimezone(timezone.utc).date(), later.low.astimezone(timezone.utc).date()


def _source(rows: DataFrame) -> Column:
    """The topic's partition a row comes from; a source without positions is one."""
    if "position" in rows.columns:
        return F.regexp_extract("position", r"^(.*)/[^/]*$", 1)
    return F.lit("")


def source_progress(fresh: DataFrame, before: Progress, cfg: RiskConfig) -> DataFrame:
    """A batch's clocks for each source partition, the number of its rows, of
    those whose window was closed already, and a sketch of how many milliseconds
    rows lie behind their partition's clock."""
    clock = F.col(TIME_COLUMN[cfg.time_basis])
    by_broker = "ingest_time" in fresh.columns and cfg.time_basis != "processing"
    received = F.col("ingest_time" if by_broker else "processing_time")
    sane = clock <= received + F.expr(f"INTERVAL {SKEW}")
    known = F.lit(None).cast("timestamp")
    if before.high:
        entries = [F.lit(part) for pair in before.high.items() for part in pair]
        known = F.create_map(*entries)[F.col("_source")]
    behind = F.greatest(F.lit(0), F.coalesce(F.unix_millis(known) - F.unix_millis(clock), F.lit(0)))
    late = F.lit(False) if before.low is None else F.col("_window.end") <= F.lit(before.low)
    rows = fresh.withColumns({"_source": _source(fresh), "_window": window_column(cfg)})
    return rows.groupBy(F.col("_source").alias("source")).agg(
        F.max(F.when(sane, clock)).alias("high"),
        F.max(received).alias("seen"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(late).alias("late"),
        F.kll_sketch_agg_bigint(behind).alias("behind"),
    )


def lateness(spark: SparkSession, progress: str, quantile: float = 0.99) -> DataFrame:
    """One row over all whole batches: ``rows``, ``late`` (exactly how many came
    after their window had closed), and ``delay_ms``, the delay that would have
    been enough for that share of rows (approximate): a value for ``watermark``."""
    stored = table_rows(spark, progress, schema.PROGRESS)
    merged = stored.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("late"), F.lit(0)).alias("late"),
        F.kll_merge_agg_bigint("behind").alias("behind"),
    )
    delay = F.kll_sketch_get_quantile_bigint("behind", F.lit(quantile))
    return merged.select("rows", "late", F.when(F.col("rows") > 0, delay).alias("delay_ms"))
