"""Best-fit packing of documents into sequences of fixed length, improved by a
local search that exchanges documents between underfull sequences."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import free_name, stored, texts
from .tokens import encoder, slices


_NAMES = ["doc_id", "piece", "start", "length", "ids"]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]


def pieces(docs: DataFrame, tokenizer: str, end_id: int, limit: int = 1024) -> DataFrame:
    """``doc_id, piece, start, length, ids binary``: every document's ids and
    ``end_id``, cut where longer than ``limit``; only the first piece may be
    shorter. A null or empty text is the end id alone; rows with equal or null
    ids are separate documents; an empty table gives no rows; other columns are
    ignored."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encoder(tokenizer).encode(batch["text"].to_pylist())):
                ids += end
                count = len(ids) // 4
                bounds = [0, *range(count % limit or limit, count + 1, limit)]
                rows += [
                    (doc_id, piece, start, stop - start, ids[4 * start : 4 * stop])
                    for piece, (start, stop) in enumerate(zip(bounds, bounds[1:]))
                ]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), _TYPES)]
            yield pa.RecordBatch.from_arrays(columns, names=_NAMES)

    return texts(docs).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary")


def place(rows: DataFrame, limit: int = 1024, group_rows: int = 8192) -> DataFrame:
    """``rows`` (with a column ``length`` of 1 to ``limit``) and their places:
    ``sequence_id, offset``. A sequence's rows follow one another without gaps
    from 0 and hold at most ``limit`` together.

    Rows are dealt evenly into groups of about ``group_rows``, by position
    rather than by key, so that no key makes a group large; each group is packed
    by itself and wastes at most a sequence or so. All columns pass through,
    those named ``sequence_id`` and ``offset`` excepted, which are replaced. An
    empty table gives no rows."""
    rows = stored(rows.drop("sequence_id", "offset"), "pieces")
    groups = max(1, -(-rows.count() // group_rows))
    name = free_name(rows, "_group")
    dealt = rows.withColumn(name, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    schema = rows.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def packed(group: pa.Table) -> pa.Table:
        number = group[name][0].as_py()
        sequence, offset = pack(group["length"].to_numpy(), limit)
        group = group.drop_columns([name]).append_column("sequence_id", pa.array(sequence + (number << 32)))
        return group.append_column("offset", pa.array(offset))

    return dealt.groupBy(name).applyInArrow(packed, schema)


def pack(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length."""
    bins = best_fit(lengths, limit)
    empty_bins(bins, lengths, limit)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for number, items in enumerate(bins):
        sizes = lengths[items]
        sequence[items] = number
        offset[items] = np.cumsum(sizes) - sizes
    return sequence, offset


def best_fit(lengths: np.ndarray, limit: int) -> list[list[int]]:
    """Longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(limit + 1)]
    open_rooms = 0  # bit r: some bin has room r
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        enough = open_rooms >> size
        if enough:
            room = size + (enough & -enough).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
            bins[number].append(item)
        else:
            room, number = limit, len(bins)
            bins.append([item])
        left = room - size
        if left:
            by_room[left].append(number)
            open_rooms |= 1 << left
    return bins


def empty_bins(bins: list[list[int]], lengths: np.ndarray, limit: int) -> None:
    """Local search in place. The emptiest bin gives to fuller ones: it moves one
    or two documents into another's room, or exchanges one or two for one, or one
    for two, that are smaller together. Each step makes the fuller bin fuller
    still, so the sum of squared fills rises, until the giving bin is empty and
    goes. Ends when the bins are as few as their sum allows, or no step is left."""
    least = -(-int(lengths.sum()) // limit)
    left = len(bins)
    search = _Exchanges(bins, lengths, limit)
    moved = True
    while moved and left > least:
        moved = False
        givers = {number for number, held in enumerate(bins) if held and search.fill[number] < limit}
        while givers and left > least:
            giver = min(givers, key=lambda number: (search.fill[number], number))
            givers.remove(giver)
            while bins[giver] and search.step(giver):
                moved = True
            left -= not bins[giver]
    bins[:] = [held for held in bins if held]


def _parts(held: list[int], lengths: np.ndarray) -> dict[int, tuple[int, ...]]:
    """No, one or two of a bin's documents for every size they can have together,
    one rather than two. A bin of ``n`` tokens has at most ``n`` such sizes, and
    equal documents are interchangeable, so nothing is left out."""
    alike: dict[int, list[int]] = {}
    for item in held:
        alike.setdefault(int(lengths[item]), []).append(item)
    parts = {0: (), **{size: (items[0],) for size, items in alike.items()}}
    for (size, items), (other, others) in combinations(alike.items(), 2):
        parts.setdefault(size + other, (items[0], others[0]))
    for size, items in alike.items():
        if len(items) > 1:
            parts.setdefault(2 * size, (items[0], items[1]))
    return parts


class _Exchanges:
    """What underfull bins could hand over, in arrays that grow as bins change."""

    def __init__(self, bins: list[list[int]], lengths: np.ndarray, limit: int):
        self.bins, self.lengths, self.limit = bins, lengths, limit
        self.fill = [int(lengths[items].sum()) for items in bins]
        self._build()

    def _build(self) -> None:
        self.items: list[tuple[int, ...]] = []
        self.where: dict[int, range] = {}
        # Size of a part, its number of documents, the largest size that fits in its stead, and its bin.
        self.table, self.used, self.dead = np.zeros((4, 1024), np.int64), 0, 0
        for number, held in enumerate(self.bins):
            if held:
                self._add(number)

    def _add(self, number: int) -> None:
        if self.fill[number] == self.limit:
            return
        parts = _parts(self.bins[number], self.lengths)
        while self.used + len(parts) > self.table.shape[1]:
            self.table = np.concatenate([self.table, np.zeros_like(self.table)], axis=1)
        self.where[number] = range(self.used, self.used + len(parts))
        sizes = np.fromiter(parts, np.int64, len(parts))
        self.table[0, self.used : self.used + len(parts)] = sizes
        self.table[1, self.used : self.used + len(parts)] = [len(items) for items in parts.values()]
        self.table[2, self.used : self.used + len(parts)] = sizes + self.limit - self.fill[number]
        self.table[3, self.used : self.used + len(parts)] = number
        self.items += parts.values()
        self.used += len(parts)

    def _renew(self, number: int) -> None:
        gone = self.where.pop(number, range(0))
        self.table[2, gone.start : gone.stop] = -1
        self.dead += len(gone)
        if self.bins[number]:
            self._add(number)
        if 2 * self.dead > max(1024, self.used):
            self._build()

    def step(self, giver: int) -> bool:
        """The exchange that takes most out of the giving bin; False if none is left."""
        size, count, reach, bin_ = self.table[:, : self.used]
        fuller = np.array(self.fill)[bin_] >= self.fill[giver]
        at = np.flatnonzero(fuller & (reach > size) & (bin_ != giver))
        size, count, reach = size[at], count[at], reach[at]
        best, chosen = 0, None
        for given, items in _parts(self.bins[giver], self.lengths).items():
            # Two for two is left out: that is for smaller steps.
            fits = np.flatnonzero((reach >= given) & (size < given) & (count + len(items) < 4))
            if len(fits):
                place = fits[np.argmin(size[fits])]
                if (gain := given - int(size[place])) > best:
                    best, chosen = gain, (items, int(at[place]))
        if chosen is None:
            return False
        items, place = chosen
        taken, taker = self.items[place], int(self.table[3, place])
        self.bins[giver] = [item for item in self.bins[giver] if item not in items] + list(taken)
        self.bins[taker] = [item for item in self.bins[taker] if item not in taken] + list(items)
        self.fill[giver] -= best
        self.fill[taker] += best
        self._renew(giver)
        self._renew(taker)
        return True
