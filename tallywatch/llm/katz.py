"""Language-model scores of whole texts: a Katz backoff model of runs of words
with Good-Turing discounts and exactly normalised backoff weights.

Texts are taken in chunks of half a million words or more. Each chunk asks for the counts
of the words, pairs and longer runs it holds, as packed lists of hashes dealt out by key; the
counts come back in tables partitioned by the part of the input. With them the chunk evaluates
its texts word by word: a run that was seen has its discounted share, any other
the backoff weight of its context times what the run without its first word has. Weights come
from sums per context to which each run contributes once, through the chunk
that owns it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import LOWER, bytes_of, combine, rows_of_words, word_bounds, word_hashes
from .tables import crc_part, new_folder, parquet_tables, stored, texts
from .tokens import slices

END = np.uint64(0x45A1D2C37F6B9E85)  # the token after the last word, and the context of the first
CHUNK = 500_000
LARGEST = 5  # counts up to here are discounted by Good-Turing


def packed(values: np.ndarray) -> bytes:
    """Numbers as planes of their bytes, which compress well where high bytes
    are mostly zero."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unpacked(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(width, -1).T.copy().view(kind).ravel()


def _steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


class Chunk:
    """Tokens of consecutive texts: their distinct runs of 1 to ``order`` tokens
    (levels 0 to ``order - 1``), ascending, with counts in training texts. The
    first token of a text has the end token as its context; longer runs begin
    there at the earliest."""

    def __init__(self, order: int, ids: list, hashes: list[np.ndarray], sizes: list[np.ndarray], train: list[np.ndarray]):
        self.ids = pa.concat_arrays(ids)
        self.sizes = np.concatenate(sizes)
        tokens = np.concatenate(hashes)
        first = np.cumsum(self.sizes) - self.sizes
        place = np.arange(len(tokens)) - np.repeat(first, self.sizes)
        weight = np.repeat(np.concatenate(train), self.sizes)
        # By level: distinct keys, their training counts, each token's run among them (-1: none), and
        # each run's context and its rest without the first token, both among the level below.
        self.keys, self.counts, self.of, self.context, self.rest = [], [], [], [], []
        for level in range(order):
            at = np.flatnonzero(place >= level - 1)
            before = [np.where(place[at] >= back, tokens[at - back], END) for back in range(level, 0, -1)]
            runs = combine(*before, tokens[at]) if level else tokens
            keys, one, of = np.unique(runs, return_index=True, return_inverse=True)
            self.keys.append(keys)
            self.counts.append(np.bincount(of, weight[at], len(keys)).astype("<u4"))
            every = np.full(len(tokens), -1, np.int32)
            every[at] = of
            self.of.append(every)
            if level:
                one = at[one]
                end = np.searchsorted(self.keys[0], END)
                known = self.of[level - 1]
                self.context.append(np.where(place[one] > 0, known[one - 1], end) if level == 1 else known[one - 1])
                self.rest.append(known[one])

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of the tokens' values for each text, each of one token at least."""
        return np.add.reduceat(values, np.cumsum(self.sizes) - self.sizes)


def chunks(batches: Iterator[pa.RecordBatch], order: int, limit: int = CHUNK) -> Iterator[tuple[int, Chunk]]:
    """The chunks of a partition with numbers that repeat when it is read again."""
    partition, number = TaskContext.get().partitionId(), 0
    parts: tuple[list, ...] = ([], [], [], [])
    held = 0
    for batch in slices(batches):
        data, offsets = bytes_of(batch["text"])
        lower = LOWER[data]
        starts, ends = word_bounds(lower, offsets)
        first = rows_of_words(starts, offsets)
        sizes = np.diff(first) + 1
        tokens = np.insert(word_hashes(lower, starts, ends), first[1:], END)
        train = batch["train"].to_numpy(zero_copy_only=False).astype(np.float64)
        for part, value in zip(parts, (batch["doc_id"], tokens, sizes, train)):
            part.append(value)
        held += len(tokens)
        if held >= limit:
            yield (partition << PART) + number, Chunk(order, *parts)
            parts, held, number = ([], [], [], []), 0, number + 1
    if held:
        yield (partition << PART) + number, Chunk(order, *parts)


PART = 20  # a chunk's number has its partition before these bits
ASK = "bucket int, chunk long, keys array<binary>, counts array<binary>"
REPLY = "part int, chunk long, bucket int, check long, counts array<binary>, owned array<binary>, stats array<long>"


def _check(keys: list[np.ndarray]) -> int:
    """A number that other keys would hardly give."""
    total = np.zeros(1, np.uint64)
    for part in keys:
        total += part.sum(dtype=np.uint64) ^ np.uint64(len(part))
    return int(total.view(np.int64)[0])


def _cuts(keys: np.ndarray, bits: int) -> list[int]:
    bounds = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return [0, *np.searchsorted(keys, bounds), len(keys)]


def _asked(rows: DataFrame, bits: int, order: int) -> DataFrame:
    """What every chunk asks for, cut by the keys' first bits."""
    kind = pa.list_(pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in chunks(batches, order):
            cuts = [_cuts(keys, bits) for keys in chunk.keys]
            parts = [[slice(*cut[bucket : bucket + 2]) for cut in cuts] for bucket in range(1 << bits)]
            keys = [[packed(_steps(held[at])) for held, at in zip(chunk.keys, part)] for part in parts]
            counts = [[packed(held[at]) for held, at in zip(chunk.counts, part)] for part in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(1 << bits), pa.int32()),
                    pa.array([number] * (1 << bits), pa.int64()),
                    pa.array(keys, kind),
                    pa.array(counts, kind),
                ],
                names=["bucket", "chunk", "keys", "counts"],
            )

    return rows.mapInArrow(run, ASK)


def _counted(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Total training counts of all asked keys, in order; which of them owns its
    key; and the totals of the distinct ones."""
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    asked = np.concatenate(counts)
    total = np.bincount(place, asked).astype(np.int64) if len(place) else np.zeros(0, np.int64)
    trained = np.flatnonzero(asked)[::-1]
    owner = np.full(len(total), -1)
    owner[place[trained]] = trained
    owned = np.zeros(len(asked), bool)
    owned[owner[owner >= 0]] = True
    return total[place], owned, total


def _replied(group: pa.Table) -> pa.Table:
    """Answers one bucket; the last row has its statistics: tokens, distinct
    words, and by level how many runs were met 1, 2, ... times."""
    group = group.sort_by("chunk")
    numbers, bucket = group["chunk"].to_pylist(), group["bucket"][0].as_py()
    asked, told = group["keys"].to_pylist(), group["counts"].to_pylist()
    checks = [0] * len(numbers)
    counts, owned, stats = [[] for _ in numbers], [[] for _ in numbers], []
    for level in range(len(asked[0])):
        keys = [np.cumsum(unpacked(row[level], "<u8"), dtype=np.uint64) for row in asked]
        total, mine, distinct = _counted(keys, [unpacked(row[level], "<u4") for row in told])
        cuts = np.cumsum([len(part) for part in keys])[:-1]
        for place, (part, own) in enumerate(zip(np.split(total, cuts), np.split(mine, cuts))):
            counts[place].append(packed(part.astype("<u4")))
            owned[place].append(np.packbits(own).tobytes())
            checks[place] = _check([np.array([checks[place]], np.int64).view(np.uint64), keys[place]])
        if level == 0:
            stats += [int(distinct.sum()), int((distinct > 0).sum())]
        stats += np.bincount(np.minimum(distinct, LARGEST + 2), minlength=LARGEST + 3)[1 : LARGEST + 2].tolist()
    kind = pa.list_(pa.binary())
    return pa.table(
        {
            "part": pa.array([*(number >> PART for number in numbers), None], pa.int32()),
            "chunk": pa.array([*numbers, None], pa.int64()),
            "bucket": pa.array([bucket] * (len(numbers) + 1), pa.int32()),
            "check": pa.array([*checks, None], pa.int64()),
            "counts": pa.array([*counts, None], kind),
            "owned": pa.array([*owned, None], kind),
            "stats": pa.array([None] * len(numbers) + [stats], pa.list_(pa.int64())),
        }
    )


def discounts(met: np.ndarray) -> np.ndarray:
    """Share of a count that is kept, for counts 0 to LARGEST, from how many
    keys were met 1, 2, ... times; the last entry stands for larger counts and is
    not used. Where the numbers give no share between 0 and 1, and for larger
    counts, half a count is taken off, so that every context keeps something
    back."""
    r = np.arange(1, LARGEST + 1)
    kept = 1 - 0.5 / r
    if met[0] > 0:
        common = (LARGEST + 1) * met[LARGEST] / met[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            good_turing = ((r + 1) * met[1:] / met[:-1] / r - common) / (1 - common)
        fine = np.isfinite(good_turing) & (good_turing > 0) & (good_turing < 1)
        kept = np.where(fine, good_turing, kept)
    return np.concatenate([[0.0], kept])


@dataclass
class Model:
    """What every chunk needs besides the counts of its own runs."""

    tokens: int
    vocabulary: int
    kept: list[np.ndarray]  # by level
    unseen: float  # share of all words that were never met

    @classmethod
    def of(cls, stats: np.ndarray, order: int) -> Model:
        tokens, vocabulary = int(stats[0]), int(stats[1])
        met = np.split(stats[2:].astype(float), order)
        model = cls(tokens, vocabulary, [discounts(level) for level in met], 1.0)
        if tokens:
            r, words = np.arange(1, LARGEST + 1), met[0]
            lost = (words[:LARGEST] * r * (1 - model.kept[0][1:])).sum() + (vocabulary - words[:LARGEST].sum()) / 2
            model.unseen = float(lost / tokens)
        return model

    def left(self, level: int, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        small = counts <= LARGEST
        return np.where(small, counts * self.kept[level][np.where(small, counts, 0)], counts - 0.5)

    def shares(self, chunk: Chunk, counts: list[np.ndarray]) -> list[np.ndarray]:
        """By level the share of each seen run among those of its context (0:
        unseen); every word has one."""
        words = np.where(counts[0] > 0, self.left(0, counts[0]) / max(self.tokens, 1), self.unseen)
        found = [words]
        for level in range(1, len(counts)):
            context = counts[level - 1][chunk.context[level - 1]]
            found.append(self.left(level, counts[level]) / np.maximum(context, 1))
        return found


OUT = (
    "row long, doc_id long, n_tokens long, n_known long, base_score double, score double, "
    "context long, times long, context_count long, kept double, shares double"
)


def _named(chunk: Chunk, level: int, places: np.ndarray) -> np.ndarray:
    """Contexts of runs of a level, as numbers that differ between levels."""
    return (chunk.keys[level - 1][places] + np.uint64(level)).view(np.int64)


def _evaluated(rows: DataFrame, folder: str, model: Model, order: int) -> DataFrame:
    """Per chunk: a row per text with what is certain of its score; for each
    level a row per text and context of unseen runs (``times``); and a row per
    context of owned runs (``kept``, their discounted counts, and ``shares``,
    what the same tokens have one level below)."""
    kinds = {name: pa.float64() if kind == "double" else pa.int64() for name, kind in (x.split() for x in OUT.split(", "))}

    def batch(**columns: np.ndarray) -> pa.RecordBatch:
        count = len(next(iter(columns.values())))
        arrays = [pa.array(columns[n], k) if n in columns else pa.nulls(count, k) for n, k in kinds.items()]
        return pa.RecordBatch.from_arrays(arrays, names=list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in chunks(batches, order):
            counts, owned = _answers(folder, number, chunk)
            shares = model.shares(chunk, counts)
            word = chunk.of[0]
            found = np.log10(shares[0])[word]
            for level in range(1, order):
                held = np.flatnonzero(chunk.of[level] >= 0)
                held = held[counts[level][chunk.of[level][held]] > 0]
                found[held] = np.log10(shares[level][chunk.of[level][held]])
            base = np.log10((counts[0] + 1) / (model.tokens + model.vocabulary + 1))
            row = (number << 22) + np.arange(len(chunk.sizes))
            yield batch(
                row=row,
                doc_id=chunk.ids,
                n_tokens=chunk.sizes,
                n_known=chunk.per_text((counts[0] > 0).astype(np.int64)[word]),
                base_score=chunk.per_text(base[word]),
                score=chunk.per_text(found),
            )
            text_of = np.repeat(np.arange(len(chunk.sizes)), chunk.sizes)
            for level in range(1, order):
                of, context = chunk.of[level], chunk.context[level - 1]
                known = counts[level - 1][context] > 0
                size = len(chunk.keys[level - 1])
                missing = np.flatnonzero(of >= 0)
                missing = missing[((counts[level] == 0) & known)[of[missing]]]
                key, times = np.unique(text_of[missing] * size + context[of[missing]], return_counts=True)
                yield batch(row=row[key // size], context=_named(chunk, level, key % size), times=times)
                mine = np.flatnonzero(owned[level])
                held, at = np.unique(context[mine], return_inverse=True)
                yield batch(
                    context=_named(chunk, level, held),
                    context_count=counts[level - 1][held],
                    kept=np.bincount(at, model.left(level, counts[level][mine]), len(held)),
                    shares=np.bincount(at, shares[level - 1][chunk.rest[level - 1][mine]], len(held)),
                )

    return rows.mapInArrow(run, OUT)


def _answers(folder: str, number: int, chunk: Chunk) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """By level the counts of a chunk's runs, and which of them it owns."""
    found = parquet_tables(f"{folder}/part={number >> PART}", [("chunk", "=", number)])
    table = pa.concat_tables(found).sort_by("bucket").to_pydict()
    counts, owned, levels = [], [], len(chunk.keys)
    parts = [[unpacked(row[level], "<u4") for row in table["counts"]] for level in range(levels)]
    bits = max(0, len(table["bucket"]) - 1).bit_length()
    for bucket, check in enumerate(table["check"]):
        expected = 0
        for keys in chunk.keys:
            cut = _cuts(keys, bits)
            held = keys[cut[bucket] : cut[bucket + 1]]
            expected = _check([np.array([expected], np.int64).view(np.uint64), held])
        if expected != check:
            raise RuntimeError("the texts were read in other partitions than before")
    for level in range(levels):
        flags = [
            np.unpackbits(np.frombuffer(row[level], np.uint8), count=len(part))
            for row, part in zip(table["owned"], parts[level])
        ]
        counts.append(np.concatenate(parts[level]).astype(np.int64))
        owned.append(np.concatenate(flags).astype(bool))
    return counts, owned


def language_scores(docs: DataFrame, parts: int = 7, held_out: int = 2, order: int = 2) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    for every row of ``docs``, a table as read, since its partitions are read
    twice.

    Tokens are the words that ASCII white space leaves, A-Z lower-cased, and one
    end. Counts come from all rows outside the held-out part. ``base_score`` is
    the add-one unigram score, ``score`` the backoff model's, both log10 of the
    text's probability. ``order`` is the length of the longest runs of words, two
    at least; three take some three times the disk (figures in the README). Words never met share one class. A null or empty text is
    an end alone; rows with equal or null ids are scored one by one; without
    training rows every score is 0; an empty table gives no rows; other columns
    are ignored."""
    if order < 2:
        raise ValueError("order must be 2 at least")
    rows = texts(docs).withColumn("train", crc_part("doc_id", parts) != held_out)
    bits = max(7, (2 * order * rows.rdd.getNumPartitions() - 1).bit_length())
    replies = _asked(rows, bits, order).groupBy("bucket").applyInArrow(_replied, REPLY)
    folder = new_folder(docs.sparkSession, "counts")
    # A folder per part of the input, its chunks in row groups of their own, statistics apart (part is null there).
    dealt = replies.repartition("part", "chunk").sortWithinPartitions("part", "chunk", "bucket")
    options = {"compression": "zstd", "parquet.block.size": 1 << 22}
    dealt.write.options(**options).partitionBy("part").parquet(folder)
    told = docs.sparkSession.read.schema(REPLY).parquet(folder).where(F.col("part").isNull())
    sums = told.select(F.posexplode("stats")).groupBy("pos").agg(F.sum("col").alias("n")).orderBy("pos").collect()
    model = Model.of(np.array([row["n"] for row in sums] or [0] * (2 + order * (LARGEST + 1))), order)

    found = stored(_evaluated(rows, folder, model, order), "scores")
    weights = (
        found.where(F.col("kept").isNotNull())
        .groupBy("context")
        .agg(F.max("context_count").alias("count"), F.sum("kept").alias("kept"), F.sum("shares").alias("shares"))
        .select("context", F.log10((1 - F.col("kept") / F.col("count")) / (1 - F.col("shares"))).alias("weight"))
    )
    backed = (
        found.where(F.col("times").isNotNull())
        .select("row", "context", "times")
        .join(weights, "context")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("weight")).alias("backed"))
    )
    scored = found.where(F.col("n_tokens").isNotNull()).join(backed, "row", "left")
    return scored.select(
        "doc_id",
        (crc_part("doc_id", parts) == held_out).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        (F.col("score") + F.coalesce("backed", F.lit(0.0))).alias("score"),
    )
