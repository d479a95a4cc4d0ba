"""Which transaction ids are stored, without reading them all.

Ids lie in segments, dealt into buckets by hash. Beside each segment stands a
Bloom filter in two halves, each a table of bitmaps of 32,768 bits: an id sets
one bit in each half. An arriving id is looked up in the filters first, and only
the buckets of those that hit are opened, so a batch of new ids reads a few bits
for each stored one and next to no ids.

The ids of the latest batches lie by themselves. Every ``FAN`` batches they
become a segment, and every ``FAN`` segments of a level one of the next level,
so there are few segments and each id is rewritten a few times only."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch import schema
from tallywatch.sources.tables import COMPACTED, batch_marks, exists, optional_rows, remove, table_rows

FAN = 16
BITMAP = 1 << 15  # bits of Spark's bitmaps
BITS_PER_ID = 32  # in each half: one in 32 * 32 unknown ids hits both
BUCKET_IDS = 20_000
MOST_BUCKETS = 1024

IDS = T.StructType([T.StructField("transaction_id", T.StringType())])
FILTERS = T.StructType(
    [T.StructField("half", T.IntegerType()), T.StructField("word", T.LongType()), T.StructField("bits", T.BinaryType())]
)
_BATCH = T.StructType([T.StructField("query_id", T.StringType()), T.StructField("batch_id", T.LongType())])
LOG = T.StructType(
    [
        T.StructField("segment", T.StringType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("buckets", T.LongType()),
        T.StructField("slots", T.LongType()),
        T.StructField("covers", T.ArrayType(_BATCH)),
        T.StructField("replaces", T.ArrayType(T.StringType())),
    ]
)

Batch = tuple[str, int]


@dataclass(frozen=True)
class Segment:
    name: str
    level: int
    buckets: int
    slots: int


def _bucket(buckets: Column | int) -> Column:
    return F.pmod(F.xxhash64("transaction_id"), buckets if isinstance(buckets, Column) else F.lit(buckets))


def _slots(slots: Column | int) -> Column:
    """The id's place in each half, as ``half, word, bit``."""
    size = slots if isinstance(slots, Column) else F.lit(slots)

    def place(half: int) -> Column:
        slot = F.pmod(F.xxhash64("transaction_id", F.lit(half)), size)
        return F.struct(
            F.lit(half).alias("half"),
            F.floor(slot / BITMAP).cast("long").alias("word"),
            (slot % BITMAP).cast("int").alias("bit"),
        )

    return F.inline(F.array(place(0), place(1)))


def _power(least: int) -> int:
    return 1 << max(0, (least - 1).bit_length())


class IdIndex:
    """The ids of one transactions table; meant for its single writer."""

    def __init__(self, spark: SparkSession, root: str, transactions: str):
        self.spark, self.root, self.transactions = spark, root, transactions
        self.segments, self.pending = self._read_log()

    def _read_log(self) -> tuple[list[Segment], list[Batch]]:
        """Segments in use, and whole batches that none of them covers."""
        log = optional_rows(self.spark, f"{self.root}/log", LOG)
        rows = log.collect() if log is not None else []
        replaced = {name for row in rows for name in row["replaces"]}
        covered = {(batch["query_id"], batch["batch_id"]) for row in rows for batch in row["covers"]}
        segments = [
            Segment(row["segment"], row["level"], row["buckets"], row["slots"])
            for row in rows
            if row["segment"] not in replaced
        ]
        marks = batch_marks(self.spark, self.transactions)
        whole = marks.select("query_id", "batch_id").distinct().collect() if marks is not None else []
        pending = [(row["query_id"], row["batch_id"]) for row in whole if row["batch_id"] >= 0]
        return segments, [batch for batch in pending if batch not in covered]

    def catch_up(self) -> None:
        """Takes in a table that was written without an index, by compaction for
        instance."""
        if self.segments or optional_rows(self.spark, f"{self.root}/new", IDS) is not None:
            return
        rows = table_rows(self.spark, self.transactions, schema.TRANSACTIONS_TABLE)
        if not rows.isEmpty():
            self._build(rows.select("transaction_id"), self.pending + [(COMPACTED, 0)], level=2, replaces=[])
            self.pending = []

    def marked(self, query_id: str, batch_id: int) -> None:
        """Takes note that a batch is whole, and makes segments when it's time."""
        self.pending.append((query_id, batch_id))
        if len(self.pending) >= FAN:
            self._build(self._ids_of(self.pending), self.pending, level=1, replaces=[])
            for query_id, batch_id in self.pending:
                remove(self.spark, f"{self.root}/new/query_id={query_id}/batch_id={batch_id}")
            self.pending = []
        for level in range(1, 64):
            alike = [segment for segment in self.segments if segment.level == level]
            if len(alike) < FAN:
                break
            folders = [f"{self.root}/segments/segment={segment.name}" for segment in alike]
            self._build(self._read(folders), [], level + 1, alike)
            for folder in folders:
                remove(self.spark, folder)
                remove(self.spark, folder.replace("/segments/", "/filters/"))

    def known(self, arriving: DataFrame) -> DataFrame:
        """Those of the arriving ids (``transaction_id``) that are stored."""
        ids = arriving.select("transaction_id").distinct()
        return self.candidates(ids).join(ids, "transaction_id", "left_semi")

    def candidates(self, arriving: DataFrame) -> DataFrame:
        """Stored ids, all of the arriving ones that are stored among them: those of
        the latest batches and of the buckets that the filters name."""
        stored = self._ids_of(self.pending)
        if folders := self.folders(arriving.select("transaction_id").distinct()):
            stored = stored.unionByName(self._read(folders))
        return stored

    def _hits(self, ids: DataFrame) -> DataFrame:
        """``transaction_id, segment, bucket`` of the ids that some segment's
        filter holds in both halves."""
        each = F.array(
            *(
                F.struct(
                    F.lit(segment.name).alias("segment"),
                    F.lit(segment.buckets).alias("buckets"),
                    F.lit(segment.slots).alias("slots"),
                )
                for segment in self.segments
            )
        )
        asked = ids.select("transaction_id", F.inline(each))
        asked = asked.select("transaction_id", "segment", _bucket(F.col("buckets")).alias("bucket"), _slots(F.col("slots")))
        paths = [f"{self.root}/filters/segment={segment.name}" for segment in self.segments]
        layout = T.StructType(FILTERS.fields + [T.StructField("segment", T.StringType())])
        filters = optional_rows(self.spark, f"{self.root}/filters", layout, paths)
        byte = F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))
        number = F.conv(F.hex(byte), 16, 10).cast("int")
        held = F.getbit(number, F.col("bit") % 8) == 1
        return (
            asked.join(filters, ["segment", "half", "word"])
            .where(held)
            .groupBy("transaction_id", "segment", "bucket")
            .agg(F.count(F.lit(1)).alias("halves"))
            .where(F.col("halves") == 2)
            .drop("halves")
        )

    def folders(self, ids: DataFrame) -> list[str]:
        """The buckets that may hold some of the ids: a bounded number for each
        segment, and of those few unless ids come again."""
        if not self.segments:
            return []
        rows = self._hits(ids).select("segment", "bucket").distinct().collect()
        return sorted(f"{self.root}/segments/segment={row['segment']}/bucket={row['bucket']}" for row in rows)

    def _read(self, folders: list[str]) -> DataFrame:
        rows = optional_rows(self.spark, self.root, IDS, folders)
        if rows is None:
            # Some bucket has no ids, its filter's hit was false.
            folders = [folder for folder in folders if exists(self.spark, folder)]
            rows = optional_rows(self.spark, self.root, IDS, folders) if folders else None
        return self.spark.createDataFrame([], IDS) if rows is None else rows.select("transaction_id")

    def _ids_of(self, batches: list[Batch]) -> DataFrame:
        layout = T.StructType(IDS.fields + _BATCH.fields)
        rows = optional_rows(self.spark, f"{self.root}/new", layout)
        if rows is None or not batches:
            return self.spark.createDataFrame([], IDS)
        by_query: dict[str, list[int]] = {}
        for query_id, batch_id in batches:
            by_query.setdefault(query_id, []).append(batch_id)
        wanted = F.lit(False)
        for query_id, numbers in by_query.items():
            wanted = wanted | ((F.col("query_id") == query_id) & F.col("batch_id").isin(numbers))
        return rows.where(wanted).select("transaction_id")

    def _build(self, ids: DataFrame, covers: list[Batch], level: int, replaces: list[Segment]) -> None:
        """Writes a segment; it counts from its line in the log, written last."""
        count = ids.count()
        name = uuid.uuid4().hex
        segment = Segment(
            name, level, min(MOST_BUCKETS, _power(-(-count // BUCKET_IDS) or 1)), max(BITMAP, _power(BITS_PER_ID * count))
        )
        dealt = ids.withColumn("bucket", _bucket(segment.buckets)).hint("rebalance", "bucket")
        dealt.sortWithinPartitions("bucket", "transaction_id").write.partitionBy("bucket").parquet(
            f"{self.root}/segments/segment={name}"
        )
        filters = ids.select(_slots(segment.slots)).groupBy("half", "word").agg(F.bitmap_construct_agg("bit").alias("bits"))
        filters.write.option("compression", "zstd").parquet(f"{self.root}/filters/segment={name}")
        gone = [old.name for old in replaces]
        row = (name, level, segment.buckets, segment.slots, covers, gone)
        self.spark.createDataFrame([row], LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        self.segments = [old for old in self.segments if old.name not in gone] + [segment]
