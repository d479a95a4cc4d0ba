"""Periodic runs of words, found on a grammar of each text.

Re-Pair replaces the most frequent pair of neighbouring symbols by a new one
until no pair occurs twice; what is left is paired up into a balanced tree. A
run lies across the inner boundary of exactly one node of the derivation that
holds all of it, so runs are looked for once at each node's boundary, copied to
all places where the node was put, and joined where they belong together."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Hashable, Iterator, Sequence
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import texts
from .tokens import slices

Run = tuple[int, int, int]
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(
    docs: DataFrame, least: int = 6, times: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document ``doc_id, n_words, runs, collapsed``.

    Words are what ASCII white space separates, numbered from 0. A run is a
    stretch of at least ``least`` words and at least ``times`` (4 or more) of its
    smallest period that neither neighbour extends. ``runs`` are sorted by
    start, then period; ``collapsed`` is the text's words, joined by one space,
    without those that lie in a run after its first period.

    Null and empty texts have no words, no runs and an empty ``collapsed``;
    texts of any length are taken whole; repeated rows and null ids are rows
    like others; an empty table gives no rows; other columns are ignored."""
    if times < 4 or least < 1:
        raise ValueError("times must be 4 at least and least 1")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, offsets, found, collapsed = [], [0], [], []
            for text in batch["text"]:
                words = text.as_py().encode().split()
                runs = find_runs(words, least, times)
                found += runs
                sizes.append(len(words))
                offsets.append(len(found))
                collapsed.append(b" ".join(_first_periods(words, runs) if runs else words).decode())
            columns = np.array(found, np.int64).reshape(-1, 3).T
            entries = pa.StructArray.from_arrays([pa.array(column) for column in columns], fields=list(_RUN))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries),
                    pa.array(collapsed, pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return texts(docs, id_col, text_col).mapInArrow(search, SCHEMA)


def strongest(runs: str = "runs"):
    """The run with the greatest length for its period, the first of equals."""
    better = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.reduce(runs, none, lambda best, run: F.when(better(best, run), run).otherwise(best))


def _first_periods(words: list, runs: list[Run]) -> list:
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[place] for place in np.flatnonzero(keep)]


def find_runs(words: Sequence[Hashable], least: int = 6, times: int = 4) -> list[Run]:
    """``(start, length, period)`` of all runs, by start, then period.

    Each word of a run occurs ``times`` times in it, and each pair of neighbours
    at least once less; the grammar is built on the stretches where that holds."""
    stretches = _stretches(words, least, times)
    if not stretches:
        return []
    ids: dict = {}
    text, origin = [], []
    for first, last in stretches:
        text += [ids.setdefault(word, len(ids)) for word in words[first:last]]
        text.append(-1)  # nothing reaches across
        origin += range(first, last + 1)
    mirrored, size = text[::-1], len(text)

    found = defaultdict(list)
    for (start, middle, end), places in _nodes(text, least):
        here = _squares(text, start, middle, end, least, times)
        there = _squares(mirrored, size - end, size - middle, size - start, least, times)
        here += [(size - last, size - first, period) for first, last, period in there]
        for first, last, period in here:
            found[period] += [(place + first - start, place + last - start) for place in places]
    runs = [
        (origin[first], last - first, period)
        for period, intervals in found.items()
        for first, last in _joined(intervals, period)
    ]
    return sorted(runs, key=lambda run: (run[0], run[2]))


def _stretches(words: Sequence[Hashable], least: int, times: int) -> list[tuple[int, int]]:
    """Where runs can lie: no rare words, no rare pairs of neighbours."""
    counts = Counter(words)
    common = np.fromiter(map(counts.__getitem__, words), np.int64, len(words)) >= times
    if np.count_nonzero(common) < least:
        return []
    linked = np.flatnonzero(common[:-1] & common[1:])
    pairs = [(words[place], words[place + 1]) for place in linked]
    counts = Counter(pairs)
    linked = linked[np.fromiter(map(counts.__getitem__, pairs), np.int64, len(pairs)) >= times - 1]
    if not len(linked):
        return []
    cuts = np.flatnonzero(np.diff(linked) > 1) + 1
    firsts, lasts = linked[np.r_[0, cuts]], linked[np.r_[cuts, len(linked)] - 1] + 2
    return [(a, b) for a, b in zip(firsts.tolist(), lasts.tolist()) if b - a >= least]


def _nodes(text: list[int], least: int) -> Iterator[tuple[tuple[int, int, int], list[int]]]:
    """``(start, middle, end)`` of each node's first place, and all its places:
    the rules of the grammar, then the tree over the symbols that are left."""
    rules, symbols = _repair(text)
    for node, places in rules:
        if node[2] - node[0] >= least:
            yield node, places
    stack = []
    first = 0
    for place, text_id in enumerate(text):
        if text_id < 0:
            cuts = [*(at for at in range(first, place) if symbols[at] >= 0), place]
            stack.append((cuts, 0, len(cuts) - 1))
            first = place + 1
    while stack:
        cuts, low, high = stack.pop()
        if high - low > 1 and cuts[high] - cuts[low] >= least:
            middle = (low + high) // 2
            yield (cuts[low], cuts[middle], cuts[high]), [cuts[low]]
            stack += [(cuts, low, middle), (cuts, middle, high)]


def _repair(text: list[int]) -> tuple[list[tuple[tuple[int, int, int], list[int]]], list[int]]:
    """The rules, each as its first place's ``(start, middle, end)`` and the starts
    of all its places, and the final symbols, at the places where they start
    (negative elsewhere). Of equally frequent pairs the one met first goes first."""
    size = len(text)
    symbols = text + [-1]
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    places = defaultdict(list)
    for place, pair in enumerate(pairwise(text)):
        if pair[0] >= 0 and pair[1] >= 0:
            places[pair].append(place)
    queue = [(-len(at), at[0], pair) for pair, at in places.items() if len(at) > 1]
    heapify(queue)
    rules, fresh = [], max(text) + 1
    while queue:
        count, _, pair = heappop(queue)
        left, right = pair
        alive = [at for at in places.pop(pair) if symbols[at] == left and symbols[after[at]] == right]
        apart, taken = [], -1
        for at in alive:
            if at != taken:
                apart.append(at)
                taken = after[at]
        if len(apart) < 2:
            continue
        if len(apart) < -count:
            places[pair] = alive
            heappush(queue, (-len(apart), alive[0], pair))
            continue
        middle = after[apart[0]]
        rules.append(((apart[0], middle, after[middle]), apart))
        for at in apart:
            second = after[at]
            symbols[at], symbols[second] = fresh, -2
            after[at] = after[second]
            before[after[at]] = at
        born = set()
        for at in apart:
            ahead, behind = before[at], after[at]
            if ahead >= 0 and 0 <= symbols[ahead] != fresh:
                places[symbols[ahead], fresh].append(ahead)
                born.add((symbols[ahead], fresh))
            if symbols[behind] >= 0:
                places[fresh, symbols[behind]].append(at)
                born.add((fresh, symbols[behind]))
        for pair in born:
            if len(places[pair]) > 1:
                heappush(queue, (-len(places[pair]), places[pair][0], pair))
        fresh += 1
    return rules, symbols


def _squares(text: list[int], start: int, middle: int, end: int, least: int, times: int) -> list[Run]:
    """``(first, last, period)`` of the runs inside ``text[start:end]`` that reach
    across ``middle`` and go on for two periods behind it. A run of four periods
    does so behind its boundary or, mirrored, before it."""
    out, reach = [], 0
    for period, same in _prefix_lengths(text, middle, end):
        # Within a shorter period's reach a square only repeats that period.
        if same < period or 2 * period <= reach:
            continue
        reach = max(reach, period + same)
        first, last = middle, middle + period + same
        while first > start and text[first - 1] == text[first - 1 + period]:
            first -= 1
        if first < middle and last - first >= max(least, times * period):
            out.append((first, last, period))
    return out


def _prefix_lengths(text: list[int], start: int, end: int) -> Iterator[tuple[int, int]]:
    """For each shift up to half of ``text[start:end]`` that gives a match, how
    many words from the start on equal those that many places further on."""
    part = text[start:end]
    size, half, head = len(part), len(part) // 2, part[0]
    lengths = [0] * (half + 1)
    low = high = 0
    for shift in range(1, half + 1):
        if shift < high:
            same = lengths[shift - low]
            if same < high - shift:
                if same:
                    lengths[shift] = same
                    yield shift, same
                continue
            same = high - shift
        elif part[shift] != head:
            continue
        else:
            same = 1
        while shift + same < size and part[same] == part[shift + same]:
            same += 1
        lengths[shift] = same
        low, high = shift, shift + same
        if same:
            yield shift, same


def _joined(intervals: list[tuple[int, int]], period: int) -> list[tuple[int, int]]:
    """Maximal intervals: those that share a period's length are parts of one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(intervals):
        if out and first <= out[-1][1] - period:
            out[-1] = out[-1][0], max(out[-1][1], last)
        else:
            out.append((first, last))
    return out
