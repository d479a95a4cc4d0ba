"""Ranked lexical search in reverse: the items are the index, the documents are
streamed through it.

The items' terms make a small inverted index that every task holds. A first pass
cuts each document down to the counts of the items' terms, from which the
corpus's statistics are summed. A second pass sends these counts through the
index, adds up scores for a few documents at a time, and keeps each item's best
in a bounded heap; the heaps of all tasks are merged."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored, texts
from .tokens import slices

# ASCII letters in small form, ASCII digits and all bytes beyond ASCII make terms.
_TERM_BYTES = bytes(
    byte if byte >= 0x80 or chr(byte).isalnum() else 0x20 for byte in bytes(range(256)).lower()
)
COUNTED = "doc_id long, size long, term array<int>, tf array<int>"
BEST = "item_id long, doc_id long, score long"


@dataclass(frozen=True)
class Index:
    """The items' terms, numbered, and for each term the items (by place in
    ``items``) that hold it and how often."""

    items: np.ndarray
    numbers: dict[bytes, int]
    holders: list[np.ndarray]
    repeats: list[np.ndarray]


@dataclass(frozen=True)
class Corpus:
    documents: int
    terms: int


def terms_of(text: str) -> list[bytes]:
    """Terms of a whole text, with repeats: runs of ASCII letters and digits and
    of characters beyond ASCII, only A-Z in small letters."""
    return text.encode().translate(_TERM_BYTES).split()


def build_index(items: list[tuple[int, str]]) -> Index:
    numbers: dict[bytes, int] = {}
    holders: list[list[int]] = []
    repeats: list[list[int]] = []
    for place, (_, text) in enumerate(items):
        for term, times in Counter(terms_of(text)).items():
            if (number := numbers.setdefault(term, len(numbers))) == len(holders):
                holders.append([])
                repeats.append([])
            holders[number].append(place)
            repeats[number].append(times)
    return Index(
        np.array([item_id for item_id, _ in items], np.int64),
        numbers,
        [np.array(places) for places in holders],
        [np.array(times, np.int64) for times in repeats],
    )


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    block_bytes: int = 1 << 23,
) -> DataFrame:
    """``item_id, rank, doc_id, score long``: each item's ``k`` highest-scoring
    documents with a score above 0, equal scores by ascending id.

    A document with ``n`` terms scores, for each term of the item (repeats
    included) that it holds ``tf`` times, ``w * (10**9*tf div (1000*tf + 12*m))``
    with ``m = 75 + 25*n*N div L``, where N is the number of documents with
    terms, L all their terms, and ``w = floor(1000*ln((2N+2)/(2df+1)))``.

    Null and empty texts have no terms. Repeated rows are documents of their own.
    Rows without an id count in the statistics but are not returned. Items without
    an id take no part; of several rows with one item id the smallest text counts.
    Empty tables give no rows; other columns are ignored. Whole texts are read,
    however long.

    Items are searched in blocks of about ``block_bytes`` of text, one pass over
    the documents for each block, so the index that tasks hold is bounded."""
    rows = texts(docs, id_col, text_col)
    asked = items.where(F.col(item_col).isNotNull()).groupBy(F.col(item_col).cast("long").alias("item_id"))
    asked = asked.agg(F.min(F.col("text").cast("string")).alias("text")).where(F.col("text").isNotNull())
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks))), "items")
    found = None
    for number in range(blocks):
        block = asked.where(F.col("block") == number).orderBy("item_id").select("item_id", "text").collect()
        best = _search(rows, build_index([tuple(row) for row in block]), k)
        found = best if found is None else found.unionByName(best)
    return found


def _search(rows: DataFrame, index: Index, k: int) -> DataFrame:
    counts = stored(counted(rows, index), "term-counts")
    corpus, weights = statistics(counts, len(index.numbers))
    heaps = counts.mapInArrow(lambda batches: _heaps(batches, index, corpus, weights, k), BEST)
    # Heaps are merged in two steps, so that no task meets those of all others.
    heaps = heaps.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(128)))
    order = (F.desc("score"), "doc_id")
    for keys in (["item_id", "part"], ["item_id"]):
        ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        heaps = heaps.withColumn("rank", ranked).where(F.col("rank") <= k)
    return heaps.select("item_id", "rank", "doc_id", "score")


def counted(rows: DataFrame, index: Index) -> DataFrame:
    """Each document's number of terms and its counts of the items' terms."""
    numbers = index.numbers

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, ends, hits = [], [], []
            for text in batch["text"]:
                terms = terms_of(text.as_py())
                sizes.append(len(terms))
                hits += [number for number in map(numbers.get, terms) if number is not None]
                ends.append(len(hits))
            row = np.repeat(np.arange(len(sizes)), np.diff(ends, prepend=0))
            # Terms of each row in ascending order, equal ones together.
            key, tf = np.unique(row * max(1, len(numbers)) + np.array(hits, np.int64), return_counts=True)
            row, term = np.divmod(key, max(1, len(numbers)))
            offsets = pa.array(np.searchsorted(row, np.arange(len(sizes) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int32())),
                ],
                ["doc_id", "size", "term", "tf"],
            )

    return rows.mapInArrow(count, COUNTED)


def statistics(counts: DataFrame, terms: int) -> tuple[Corpus, np.ndarray]:
    """The corpus's size, and the weight of each of the index's terms."""
    filled = F.col("size") > 0
    total = counts.agg(F.count_if(filled).alias("documents"), F.coalesce(F.sum("size"), F.lit(0)).alias("terms")).first()

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(terms, np.int64)
        for batch in batches:
            seen += np.bincount(batch["term"].flatten().to_numpy(zero_copy_only=False), minlength=terms)[:terms]
        term = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(term, pa.int32()), pa.array(seen[term], pa.int64())], ["term", "documents"]
        )

    summed = counts.select("term").mapInArrow(frequencies, "term int, documents long")
    weights = np.zeros(terms, np.int64)
    for row in summed.groupBy("term").agg(F.sum("documents").alias("df")).collect():
        weights[row["term"]] = math.floor(1000 * math.log((2 * total["documents"] + 2) / (2 * row["df"] + 1)))
    return Corpus(total["documents"], total["terms"]), weights


def _heaps(
    batches: Iterator[pa.RecordBatch], index: Index, corpus: Corpus, weights: np.ndarray, k: int, cells: int = 1 << 21
) -> Iterator[pa.RecordBatch]:
    """Each item's ``k`` best documents of a task."""
    width = len(index.items)
    best = np.empty((3, 0), np.int64)  # item's place, score, document
    least = np.ones(width, np.int64)  # the score a newcomer needs
    step = max(1, cells // max(1, width))
    for batch in batches:
        batch = batch.filter(batch["doc_id"].is_valid())
        for first in range(0, len(batch), step):
            some = batch.slice(first, step)
            scores = batch_scores(some, index, corpus, weights)
            row, item = np.nonzero(scores >= least)
            if not len(row):
                continue
            ids = some["doc_id"].to_numpy(zero_copy_only=False)
            best = np.concatenate([best, [item, scores[row, item], ids[row]]], axis=1)
            best = best[:, np.lexsort((best[2], -best[1], best[0]))]
            # Place of each entry within its item's.
            starts = np.searchsorted(best[0], np.arange(width + 1))
            place = np.arange(best.shape[1]) - starts[best[0]]
            best = best[:, place < k]
            last = best[:, place[place < k] == k - 1]
            least[last[0]] = last[1]
    yield pa.RecordBatch.from_arrays(
        [pa.array(index.items[best[0]]), pa.array(best[2]), pa.array(best[1])], ["item_id", "doc_id", "score"]
    )


def batch_scores(some: pa.RecordBatch, index: Index, corpus: Corpus, weights: np.ndarray) -> np.ndarray:
    """Scores of a few documents for all items, in 64-bit integers."""
    scores = np.zeros((len(some), len(index.items)), np.int64)
    term = some["term"].flatten().to_numpy(zero_copy_only=False)
    tf = some["tf"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = some["size"].to_numpy()
    row = np.repeat(np.arange(len(some)), some["term"].value_lengths().to_numpy(zero_copy_only=False))
    norm = 75 + 25 * size * corpus.documents // max(1, corpus.terms)
    worth = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * norm[row]))
    order = np.argsort(term, kind="stable")
    term, row, worth = term[order], row[order], worth[order]
    cuts = np.flatnonzero(np.diff(term)) + 1
    for first, last in zip([0, *cuts], [*cuts, len(term)]):
        if first < last:
            number = term[first]
            scores[row[first:last, None], index.holders[number]] += worth[first:last, None] * index.repeats[number]
    return scores
