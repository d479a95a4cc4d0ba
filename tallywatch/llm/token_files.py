"""Token ids in binary files of fixed-width bit-packed blocks.

A file holds, in order: blocks of ids, each id in the fewest bits that the
vocabulary needs, 64 ids to as many 64-bit words as an id has bits; the blocks'
byte offsets; the documents' ids, null marks and first positions; and a footer
of fixed size with the counts. Blocks are read and unpacked one by one, so any
range of ids can be had without the rest."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import new_folder, stored, texts
from .tokens import encoder, slices

MAGIC = 0x3153444954494231
FOOTER = 8  # 64-bit numbers
BLOCK = 1 << 16


def pack_bits(ids: np.ndarray, width: int) -> np.ndarray:
    """Ids in ``width`` bits each, as 64-bit words; the last 64 are filled up
    with zeros."""
    ids = ids.astype(np.uint64)
    if len(ids) % 64:
        ids = np.concatenate([ids, np.zeros(64 - len(ids) % 64, np.uint64)])
    ids = ids.reshape(-1, 64)
    words = np.zeros((len(ids), width), np.uint64)
    for place in range(64):
        word, shift = divmod(place * width, 64)
        words[:, word] |= ids[:, place] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= ids[:, place] >> np.uint64(64 - shift)
    return words.ravel()


def unpack_bits(words: np.ndarray, width: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed words."""
    words = words.reshape(-1, width)
    ids = np.empty((len(words), 64), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for place in range(64):
        word, shift = divmod(place * width, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value |= words[:, word + 1] << np.uint64(64 - shift)
        ids[:, place] = value & mask
    return ids.ravel()[:count].astype(np.uint32)


class _Writer:
    """Writes one file under a name of its own, then moves it into place, so a
    task that runs twice leaves one whole file."""

    def __init__(self, folder: str, name: str, width: int):
        self.fs, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        self.fs.create_dir(root, recursive=True)
        self.final = posixpath.join(root, name)
        self.draft = posixpath.join(root, f".{name}.{uuid.uuid4().hex}")
        self.out = self.fs.open_output_stream(self.draft)
        self.width, self.offsets, self.at = width, [0], 0
        self.waiting: list[np.ndarray] = []
        self.held = self.ids = 0
        self.docs: list[tuple[int | None, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, self.ids))
        self.ids += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK:
            self._blocks(False)

    def _blocks(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        end = len(ids) if last else len(ids) // BLOCK * BLOCK
        for first in range(0, end, BLOCK):
            words = pack_bits(ids[first : min(first + BLOCK, end)], self.width).astype("<u8").tobytes()
            self.out.write(words)
            self.at += len(words)
            self.offsets.append(self.at)
        self.waiting, self.held = [ids[end:]], len(ids) - end

    def close(self) -> None:
        self._blocks(True)
        null = np.array([doc_id is None for doc_id, _ in self.docs], "<i8")
        names = np.array([doc_id or 0 for doc_id, _ in self.docs], "<i8")
        starts = np.array([start for _, start in self.docs] + [self.ids], "<i8")
        for part in (np.array(self.offsets, "<i8"), names, null, starts):
            self.out.write(part.tobytes())
        footer = [MAGIC, self.width, BLOCK, len(self.offsets) - 1, len(self.docs), self.ids, self.at, 0]
        self.out.write(np.array(footer, "<i8").tobytes())
        self.out.close()
        self.fs.move(self.draft, self.final)


class TokenFile:
    """Random access to one file."""

    def __init__(self, path: str):
        files, place = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        self.file = files.open_input_file(place)
        footer = np.frombuffer(self.file.read_at(8 * FOOTER, self.file.size() - 8 * FOOTER), "<i8")
        if footer[0] != MAGIC:
            raise ValueError(f"not a token file: {path}")
        _, self.width, self.block, blocks, docs, self.count, index, _ = footer.tolist()
        sizes = [blocks + 1, docs, docs, docs + 1]
        data = np.frombuffer(self.file.read_at(8 * sum(sizes), index), "<i8")
        self.offsets, self.doc_ids, self.null, self.starts = np.split(data, np.cumsum(sizes)[:-1])

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end``, reading only their blocks."""
        if end <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block + 1
        low, high = int(self.offsets[first]), int(self.offsets[last])
        words = np.frombuffer(self.file.read_at(high - low, low), "<u8")
        found = unpack_bits(words, self.width, min(last * self.block, self.count) - first * self.block)
        return found[start - first * self.block : end - first * self.block]

    def document(self, number: int) -> np.ndarray:
        return self.ids(int(self.starts[number]), int(self.starts[number + 1]))


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int, folder: str | None = None) -> DataFrame:
    """Writes the ids of every document and ``end_id`` in ascending order of
    ``doc_id`` (null first, equal ids by a hash of their text); returns one row
    per file: ``file, number, docs, ids, first_id long``, where ``first_id``
    counts the ids in the files before.

    A null or empty text is the end id alone; an empty table writes no file;
    other columns are ignored."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-files")
    width = max(1, (vocabulary - 1).bit_length())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, writer = TaskContext.get().partitionId(), None
        name = f"part-{number:06d}.ids"
        for batch in slices(batches):
            encoded = encoder(tokenizer).encode(batch["text"].to_pylist())
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encoded):
                writer = writer or _Writer(folder, name, width)
                writer.add(doc_id, np.append(np.frombuffer(ids, "<u4"), np.uint32(end_id)))
        if writer:
            writer.close()
            found = {"file": [f"{folder}/{name}"], "number": [number], "docs": [len(writer.docs)], "ids": [writer.ids]}
            yield pa.RecordBatch.from_pydict(found)

    tie = F.xxhash64("text")
    # The position splits even a third of all rows that are the same.
    ordered = texts(docs).withColumns({"tie": tie, "place": F.monotonically_increasing_id()})
    ordered = ordered.repartitionByRange("doc_id", "tie", "place").sortWithinPartitions("doc_id", "tie", "place")
    files = ordered.select("doc_id", "text").mapInArrow(write, "file string, number long, docs long, ids long")
    files = stored(files, "token-file-list")
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first_id", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_token_files(files: DataFrame, batch_ids: int = 1 << 20) -> DataFrame:
    """``doc_id, start, ids binary`` of every document in the files: ``start``
    counts the ids of all documents before it, ``ids`` are little-endian unsigned
    32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch["file"].to_pylist(), batch["first_id"].to_pylist()):
                yield from _documents(TokenFile(path), base, batch_ids)

    spread = files.select("file", "first_id").repartition(max(1, files.count()))
    return spread.mapInArrow(run, "doc_id long, start long, ids binary")


def _documents(file: TokenFile, base: int, batch_ids: int) -> Iterator[pa.RecordBatch]:
    first, count = 0, len(file.doc_ids)
    while first < count:
        last = max(first + 1, int(np.searchsorted(file.starts, file.starts[first] + batch_ids, "right")) - 1)
        bounds = file.starts[first : last + 1]
        data = file.ids(int(bounds[0]), int(bounds[-1])).astype("<u4").tobytes()
        at = (bounds - bounds[0]) * 4
        doc_ids = pa.array(file.doc_ids[first:last], pa.int64(), mask=file.null[first:last].astype(bool))
        ids = pa.array([data[a:b] for a, b in zip(at[:-1], at[1:])], pa.binary())
        yield pa.RecordBatch.from_pydict({"doc_id": doc_ids, "start": pa.array(base + bounds[:-1], pa.int64()), "ids": ids})
        first = last

