"""Small Spark helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.session import shared_folder
from tallywatch.sources.tables import remove


_made: list[str] = []


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh folder that the driver and all executors can reach."""
    _made.append(f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}")
    return _made[-1]


def clear(spark: SparkSession) -> None:
    """Deletes the folders that this process has made so far. For the caller, once
    the results that read them are written."""
    while _made:
        remove(spark, _made.pop())


def stored(rows: DataFrame, kind: str, *partition_by: str) -> DataFrame:
    """``rows`` written once as Parquet to the shared folder and read back: cuts
    the lineage, survives lost executors, and is computed only once."""
    spark = rows.sparkSession
    folder = new_folder(spark, kind)
    rows.write.option("compression", "zstd").partitionBy(*partition_by).parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def parquet_tables(folder: str, filters: list | None = None) -> list[pa.Table]:
    """The files of a Parquet folder, read within a task from shared storage;
    with ``filters`` only the row groups that may hold such rows."""
    files, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
    found = sorted(one.path for one in files.get_file_info(fs.FileSelector(root)) if one.path.endswith(".parquet"))
    if filters:
        return [pq.read_table(path, filesystem=files, filters=filters, partitioning=None) for path in found]
    return [pq.ParquetFile(files.open_input_file(path)).read() for path in found]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns, ``doc_id long`` and ``text string``; null text is empty."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def joined_evenly(rows: DataFrame, found: DataFrame, key: str, total: int, how: str = "left") -> DataFrame:
    """``rows`` joined with ``found``, which has each ``key`` once and says in
    ``members`` how many rows hold it (that column is dropped). Keys with more
    than a ten-thousandth of the ``total`` rows, and more than two hundred, are
    broadcast: there are at most ten thousand of them. Only the others are
    shuffled, so that no task gets a large share; rows without a key pass by.
    ``rows`` is read three times and should come from a table."""
    hot = F.col("members") > max(200, total // 10_000)
    values = [name for name in found.columns if name not in (key, "members")]
    heavy = found.where(hot).select(key, *values, F.lit(True).alias("_met"))
    met = rows.join(F.broadcast(heavy), key, "left")
    rest = met.where(F.col("_met").isNull()).drop("_met", *values)
    cold = rest.where(F.col(key).isNotNull()).join(found.where(~hot).drop("members"), key, how)
    parts = met.where("_met").drop("_met").unionByName(cold)
    if how == "left":
        none = [F.lit(None).cast(found.schema[name].dataType).alias(name) for name in values]
        parts = parts.unionByName(rest.where(F.col(key).isNull()).select("*", *none))
    return parts


def free_name(rows: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``rows`` has it."""
    taken = {column.lower() for column in rows.columns}
    while name in taken:
        name += "_"
    return name


def crc_part(doc_id: str | Column, parts: int) -> Column:
    """crc32 of an id's decimal text, modulo ``parts``; null ids count as empty."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % parts


def label_sample(labels: DataFrame, name: str, parts: int, held_out: int, per_class: int) -> DataFrame:
    """At most ``per_class`` labelled training rows of each class, drawn by a hash
    of the id: ``doc_id, label, weight``, the weight being how many rows of its
    class a drawn row stands for. Rows whose label is null or whose id falls
    into the held-out part are left out; an id labelled twice keeps its larger
    label."""
    known = (
        labels.where(F.col(name).isin(0, 1) & F.col("doc_id").isNotNull() & (crc_part("doc_id", parts) != held_out))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col(name).cast("int")).alias("label"))
    )
    drawn = [
        known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        for label in (0, 1)
    ]
    count = F.count("*")
    weights = known.groupBy("label").agg((count / F.least(count, F.lit(per_class))).alias("weight"))
    sample = drawn[0].unionByName(drawn[1]).join(F.broadcast(weights), "label")
    return sample.select("doc_id", "label", "weight")


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The texts of a sample, one for each id however many rows have it: the
    first by a hash of the text. The sample is joined by broadcast, which its
    bound allows."""
    rows = texts(docs).join(F.broadcast(sample), "doc_id")
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first")
    return rows.groupBy("doc_id", "label", "weight").agg(first).select("doc_id", "label", "weight", "first.text")
