"""Vectorised work on the texts of one Arrow batch: bytes, words and hashes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_RANDOM = np.random.default_rng(20240917)
_MULTIPLIERS = _RANDOM.integers(1, 2**63, 16, np.uint64) * np.uint64(2) + np.uint64(1)
_LOW_BYTES = np.array([(1 << (8 * count)) - 1 for count in range(9)], np.uint64)
_LONG = 512


def bytes_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and the offsets of its rows;
    null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(bounds) or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes outside ``space``; runs stop at the
    rows' bounds."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = space[data]
    after = np.empty(len(data), bool)
    after[0], after[1:] = True, gap[:-1]
    after[offsets[:-1][offsets[:-1] < len(data)]] = True
    before = np.empty(len(data), bool)
    before[-1], before[:-1] = True, gap[1:]
    before[offsets[1:][offsets[1:] > 0] - 1] = True
    return np.flatnonzero(~gap & after), np.flatnonzero(~gap & before) + 1


def rows_of_words(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First word of each row, and one past the last: len(offsets) numbers."""
    return np.searchsorted(starts, offsets)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, taken eight at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, "<u8", padded.data, strides=(1,))
    lengths = ends - starts
    found = lengths.astype(np.uint64) * _MULTIPLIERS[15]
    at, left, words = starts, np.minimum(lengths, _LONG), slice(None)
    while len(at):
        part = eights[at] & _LOW_BYTES[np.minimum(left, 8)]
        found[words] = mix((found[words] ^ part) * _MULTIPLIERS[14])
        more = np.flatnonzero(left > 8)
        words = more if isinstance(words, slice) else words[more]
        at, left = at[more] + 8, left[more] - 8
    for word in np.flatnonzero(lengths > _LONG):
        digest = hashlib.blake2b(data[starts[word] : ends[word]].tobytes(), digest_size=8).digest()
        found[word] = np.frombuffer(digest, np.uint64)[0]
    return found


def combine(*parts: np.ndarray) -> np.ndarray:
    """One hash of several aligned arrays of hashes; order matters."""
    total = np.zeros(len(parts[0]), np.uint64)
    for part, factor in zip(parts, _MULTIPLIERS):
        total += part * factor
    return mix(total)
