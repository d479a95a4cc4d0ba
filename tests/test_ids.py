"""The index of stored ids: exact, cheap for new ids, and the same after a restart."""

import os

import pytest
from pyspark.sql import functions as F

from tallywatch import schema
from tallywatch.streaming import ids as ids_module
from tallywatch.streaming.ids import IDS, IdIndex
from tallywatch.streaming.ledger import Tables, _append, _mark, _owned


def some_ids(spark, first, last):
    return spark.range(first, last).select(F.concat(F.lit("id-"), F.md5(F.col("id").cast("string"))).alias("transaction_id"))


@pytest.fixture
def store(spark, tmp_path):
    """Stores batches of ids as the job does."""
    tables = Tables(str(tmp_path / "tables"))
    _mark(spark, tables, "", "run", -1)
    index = IdIndex(spark, tables.ids, tables.transactions)

    class Store:
        def __init__(self):
            self.index, self.tables = index, tables

        def batch(self, number, first, last, mark=True):
            if last > first:
                _append(_owned(some_ids(spark, first, last), "q", number), f"{tables.ids}/new")
            if mark:
                _mark(spark, tables, "s", "q", number)
                self.index.marked("q", number)

        def reopened(self):
            return IdIndex(spark, tables.ids, tables.transactions)

    return Store()


def asked(spark, index, first, last):
    return {row[0] for row in index.known(some_ids(spark, first, last)).collect()}


def names(spark, first, last):
    return {row[0] for row in some_ids(spark, first, last).collect()}


def size(folder):
    return sum(os.path.getsize(os.path.join(at, file)) for at, _, files in os.walk(folder) for file in files)


def test_known_ids_through_segments_and_restarts(spark, store, monkeypatch):
    monkeypatch.setattr(ids_module, "FAN", 3)
    monkeypatch.setattr(ids_module, "BUCKET_IDS", 50)
    assert asked(spark, store.index, 0, 100) == set()
    for number in range(11):
        # Batch 4 brings nothing new; batch 7 is never marked.
        store.batch(number, 100 * number, 100 * number + (0 if number == 4 else 100), mark=number != 7)
        for index in (store.index, store.reopened()):
            stored = {name for n in range(number + 1) if n not in (4, 7) for name in names(spark, 100 * n, 100 * n + 100)}
            assert asked(spark, index, 50, 1300) == stored & names(spark, 50, 1300)
    assert [segment.level for segment in store.index.segments] == [2] and len(store.index.pending) == 1
    assert store.reopened().segments == store.index.segments and store.reopened().pending == store.index.pending
    assert store.index.segments[0].buckets > 4
    # What segments have replaced is gone.
    assert sum(name.startswith("segment=") for name in os.listdir(f"{store.tables.ids}/segments")) == 1


def test_a_build_that_is_cut_short_counts_for_nothing(spark, store, monkeypatch):
    monkeypatch.setattr(ids_module, "FAN", 2)
    store.batch(0, 0, 100)
    monkeypatch.setattr(ids_module.F, "bitmap_construct_agg", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.batch(1, 100, 200)
    monkeypatch.undo()
    index = store.reopened()
    assert index.segments == [] and asked(spark, index, 50, 250) == names(spark, 50, 200)


def test_only_buckets_whose_filter_hits_are_read(spark, store, monkeypatch):
    monkeypatch.setattr(ids_module, "FAN", 2)
    monkeypatch.setattr(ids_module, "BUCKET_IDS", 1000)
    store.batch(0, 0, 200_000)
    store.batch(1, 200_000, 400_000)
    (segment,) = store.index.segments
    assert segment.buckets == 512
    every = size(f"{store.tables.ids}/segments")
    # Five of two thousand ids come again.
    again = some_ids(spark, 1000, 1005).unionByName(some_ids(spark, 10**6, 10**6 + 1995))
    folders = store.index.folders(again)
    assert 1 <= len(folders) <= 15
    assert sum(map(size, folders)) < every / 25 and size(f"{store.tables.ids}/filters") < every / 4
    known = store.index.known(again)
    assert {row[0] for row in known.collect()} == names(spark, 1000, 1005)
    opened = {os.path.dirname(file.removeprefix("file://")) for file in known.inputFiles()}
    assert {folder for folder in opened if "/segments/" in folder} == set(folders)
    assert asked(spark, store.index, 399_990, 400_010) == names(spark, 399_990, 400_000)


def test_false_hits_in_empty_buckets(spark, store):
    assert store.index._read([f"{store.tables.ids}/segments/segment=none/bucket=0"]).collect() == []


def test_tables_without_an_index_are_taken_in(spark, store, tmp_path):
    rows = some_ids(spark, 0, 300).withColumns(
        {name: F.lit(None) for name in schema.TRANSACTIONS_TABLE.fieldNames()[1:8]}
        | {"query_id": F.lit("compacted"), "batch_id": F.lit(0), "event_date": F.lit("2024-01-01")}
    )
    tables = Tables(str(tmp_path / "old"))
    layout = schema.TRANSACTIONS_TABLE
    rows = rows.select(*(F.col(field.name).cast(field.dataType) for field in layout.fields))
    rows.write.partitionBy("event_date", "query_id", "batch_id").parquet(tables.transactions)
    index = IdIndex(spark, tables.ids, tables.transactions)
    index.catch_up()
    assert asked(spark, index, 290, 400) == names(spark, 290, 300)
    again = IdIndex(spark, tables.ids, tables.transactions)
    again.catch_up()
    assert again.segments == index.segments and len(again.segments) == 1
    assert IDS.fieldNames() == ["transaction_id"]
