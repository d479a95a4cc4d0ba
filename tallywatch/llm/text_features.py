"""Dense features of whole texts, counted over the bytes and words of an Arrow
batch at once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from .arrays import LOWER, bytes_of, rows_of_words, word_bounds, word_hashes


def _class(characters: str) -> np.ndarray:
    members = np.zeros(256, bool)
    members[[ord(character) for character in characters]] = True
    return members


UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LOWER_CASE = _class("abcdefghijklmnopqrstuvwxyz")
DIGIT = _class("0123456789")
MARK = _class("!?")
STOP = _class(".,;:")
SYMBOL = _class("#$%&*+<=>@[]^_`{|}~\\/")
NEWLINE = _class("\n")
WIDE = np.zeros(256, bool)
WIDE[0x80:] = True
LETTER = UPPER | LOWER_CASE | WIDE
CLASSES = {"upper": UPPER, "lower": LOWER_CASE, "digit": DIGIT, "mark": MARK, "symbol": SYMBOL, "wide": WIDE}
_BITS = sum((members.astype(np.uint8) << place for place, members in enumerate(CLASSES.values())), np.uint8(0))


class Texts:
    """One batch of texts with its words."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = bytes_of(column)
        self.starts, self.ends = word_bounds(self.data, self.offsets)
        self.first = rows_of_words(self.starts, self.offsets)
        self.lower = LOWER[self.data]
        self.hashes = word_hashes(self.lower, self.starts, self.ends)
        self.bytes = np.diff(self.offsets)
        self.words = np.diff(self.first)
        self.row_of_word = np.repeat(np.arange(len(self.words)), self.words)

        self.histogram = np.zeros((len(self.bytes), 256), np.int64)
        for row, (start, end) in enumerate(zip(self.offsets[:-1], self.offsets[1:])):
            self.histogram[row] = np.bincount(self.data[start:end], minlength=256)
        # Which classes each word holds; the bytes up to the next word are spaces, of no class.
        self.held = np.bitwise_or.reduceat(_BITS[self.data], self.starts) if len(self.starts) else np.zeros(0, np.uint8)

    def count(self, members: np.ndarray) -> np.ndarray:
        """Bytes of a class in each row."""
        return self.histogram[:, members].sum(1)

    @staticmethod
    def per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[bounds[1:]] - total[bounds[:-1]]

    def per_words(self, flags: np.ndarray) -> np.ndarray:
        """Flagged words in each row."""
        return self.per_row(flags, self.first)

    def distinct_words(self) -> np.ndarray:
        """Distinct words in each row."""
        # Row above hash in one number: 40 bits of hash tell a row's words apart.
        keys = np.sort((self.row_of_word.astype(np.uint64) << np.uint64(40)) | (self.hashes >> np.uint64(24)))
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        return np.bincount((keys[new] >> np.uint64(40)).astype(np.int64), minlength=len(self.words))

    def repeats(self) -> np.ndarray:
        """Words equal to the one before them, in each row."""
        same = np.zeros(len(self.hashes), bool)
        same[1:] = (self.hashes[1:] == self.hashes[:-1]) & (self.row_of_word[1:] == self.row_of_word[:-1])
        return self.per_words(same)

    def words_with(self, *names: str) -> np.ndarray:
        """Flags of the words that hold a byte of one of the classes."""
        wanted = sum(1 << place for place, name in enumerate(CLASSES) if name in names)
        return self.held & np.uint8(wanted) != 0

    def upper_words(self) -> np.ndarray:
        """Flags of the words of three bytes or more whose letters are capitals."""
        return (self.ends - self.starts >= 3) & self.words_with("upper") & ~self.words_with("lower")


def in_slices(column: pa.Array, measure: Callable[[pa.Array], np.ndarray], limit: int = 1 << 20) -> np.ndarray:
    """``measure`` over runs of rows of about ``limit`` bytes, which stay in the
    processor's cache; at least one row at a time."""
    _, offsets = bytes_of(column)
    found, first = [], 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        found.append(measure(column.slice(first, last - first)))
        first = last
    return np.concatenate(found) if found else measure(column)


def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)
