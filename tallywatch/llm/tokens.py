"""Texts to token ids with a ready-made tokenizer file, word by word.

Both kinds of files split a text at white space before they merge, so equal
stretches of text always give equal ids; each worker keeps those it has met."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import lru_cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

LONGEST = 64
_token_id = attrgetter("id")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = r"!-&(-/:-@\[-`{-~"


class Known(dict):
    """Results of a function by text, in about ``room`` bytes.

    A result is kept when its text is met again, so that the many words met once
    take no room (texts share marks, so some are kept at once), or ``at_once``,
    where working it out is dear. Once half the room is taken, results not asked
    for since the last time go."""

    ENTRY = 200  # bytes that an entry takes beside its text and its value
    MARKS = bytearray(1 << 22)  # shared by all of a worker's

    def __init__(self, function: Callable[[str], bytes], room: int, at_once: bool = False):
        self.function, self.room, self.at_once = function, room, at_once
        self.older: dict[str, bytes] = {}
        self.used = self.marked = 0

    def __missing__(self, text: str) -> bytes:
        value = self.older.get(text)
        if value is None:
            value = self.function(text)
            if len(text) > LONGEST or not (self.at_once or self._met(text)):
                return value
        self.used += self.ENTRY + len(text) + len(value)
        if 2 * self.used > self.room:
            self.older = dict(self)
            self.clear()
            self.used = 0
        self[text] = value
        return value

    def _met(self, text: str) -> bool:
        place = hash(text) & (len(self.MARKS) - 1)
        if self.MARKS[place]:
            return True
        self.MARKS[place] = 1
        self.marked += 1
        if 2 * self.marked > len(self.MARKS):
            self.MARKS[:] = bytes(len(self.MARKS))
            self.marked = 0
        return False


class WordEncoder:
    """Ids of whole texts, as little-endian 32-bit numbers.

    Rows are split at their spaces, each of which belongs to the word after it,
    and equal words are worked out together. Words of plain letters, digits and
    marks are split as the tokenizer file says, and each part goes to the file's
    merges; words that aren't plain go to the tokenizer as they are. Where a
    space stands beside other white space, the whole text does, since a split
    there would change what the file's pattern matches, unless its parts make it
    up all the same.

    With ``added``, the file's added tokens are found in texts as the library
    finds them by default, and texts that hold any go to it whole; otherwise
    they are taken for ordinary text."""

    def __init__(self, path: str, room: int = 80_000_000, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        tokens = self.tokenizer.get_added_tokens_decoder().values() if added else ()
        self.added = [token.content for token in tokens]
        if self.tokenizer.normalizer is not None and any(token.normalized for token in tokens):
            self.added = [""]  # they may show only in the normalised text
        self.lower, self.parts_of, self.plain = _splitter(self.tokenizer)
        self.merged = self.tokenizer.model.tokenize
        self.mapped = str.maketrans({byte: symbol for byte, symbol in enumerate(_byte_symbols())})
        self.words = Known(self._spaced, room // 10)
        self.starts = Known(self._word, room // 10)
        self.parts = Known(self._part, room * 8 // 10, at_once=True)

    def _spaced(self, word: str) -> bytes:
        return self._word(" " + word)

    def _ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _plain(self, text: str) -> bytes | None:
        """Ids by parts, if the parts make up the text."""
        parts = self.parts_of.findall(text) if self.parts_of else []
        if len("".join(parts)) == len(text):
            return b"".join(map(self.parts.__getitem__, parts))
        return None

    def _word(self, word: str) -> bytes:
        if word.isspace() or word[-1].isspace() or word[1:2].isspace():
            raise _Whole
        ids = self._plain(word)
        return self._ids(word) if ids is None else ids

    def _part(self, part: str) -> bytes:
        if self.lower:
            part = part.strip(" \n").lower()
            if not part:
                return b""
        if part.isascii():
            symbols = part.replace(" ", self.mapped[0x20]).replace("\n", self.mapped[0x0A])
        else:
            symbols = part.encode().decode("latin-1").translate(self.mapped)
        return array("I", map(_token_id, self.merged(symbols))).tobytes()

    def _start(self, word: str) -> bytes:
        """Ids of a row's first word, which has no space before it."""
        return self._plain(word) if self.plain and self.plain.fullmatch(word) else self.starts[word]

    def _different(self, words: pa.StringArray) -> tuple[pa.LargeListArray, np.ndarray, np.ndarray]:
        """Ids of different words, each with a space before it; which of them
        aren't plain; and which stand in texts that can't be split there."""
        if self.plain:
            plain = pc.match_substring_regex(words, f"^(?:{self.plain.pattern})$").to_numpy(zero_copy_only=False)
        else:
            plain = np.zeros(len(words), bool)
        at = np.flatnonzero(plain)
        parts = []
        if len(at):
            every = pa.ListArray.from_arrays([0, len(at)], words.filter(pa.array(plain)))
            parts = self.parts_of.findall(" " + pc.binary_join(every, " ")[0].as_py())
        found = list(map(self.parts.__getitem__, parts))
        begins = np.flatnonzero(np.fromiter((part[0] == " " for part in parts), bool, len(parts)))
        sizes = np.zeros(len(words) + 1, np.int64)  # of the plain words first, then of the others
        if len(at):
            sizes[1 : len(at) + 1] = np.add.reduceat(np.fromiter(map(len, found), np.int64, len(found)), begins)
        others, whole = np.flatnonzero(~plain), np.zeros(len(words), bool)
        for place, word in enumerate(words.take(pa.array(others)).to_pylist()):
            try:
                found.append(self.words[word])
                sizes[len(at) + place + 1] = len(found[-1])
            except _Whole:
                whole[others[place]] = True
        lists = pa.LargeListArray.from_arrays(np.cumsum(sizes) // 4, np.frombuffer(b"".join(found), "<u4"))
        return lists.take(pa.array(np.argsort(np.concatenate([at, others])))), ~plain, whole

    def encode(self, rows: list[str]) -> list[bytes]:
        words = pc.split_pattern(pa.array(rows, pa.string()), " ")
        first = np.zeros(len(words.values), bool)
        first[words.offsets.to_numpy()[:-1]] = True
        starts = words.values.filter(pa.array(first)).to_pylist()
        coded = words.values.filter(pa.array(~first)).dictionary_encode()
        lists, odd, whole = self._different(coded.dictionary)
        places = coded.indices.to_numpy()
        lists = lists.take(coded.indices)
        flat, offsets = memoryview(lists.flatten().to_numpy()).cast("B"), 4 * lists.offsets.to_numpy()
        bounds = words.offsets.to_numpy() - np.arange(len(rows) + 1)
        odds, wholes = (np.append(0, np.cumsum(found[places]))[bounds] for found in (odd, whole))

        out = []
        for n, (row, start) in enumerate(zip(rows, starts)):
            if any(token in row for token in self.added):
                out.append(self._ids(row))
                continue
            ids = None
            if wholes[n] == wholes[n + 1] and (start or odds[n] == odds[n + 1]):
                with suppress(_Whole):
                    ids = (self._start(start) if start else b"") + flat[offsets[bounds[n]] : offsets[bounds[n + 1]]]
            if ids is None:
                ids = self._plain(row)
            out.append(self._ids(row) if ids is None else ids)
        return out


class _Whole(Exception):
    """The text can't be split at its spaces."""


def _splitter(tokenizer: Tokenizer) -> tuple[bool, re.Pattern | None, re.Pattern | None]:
    """Whether words are lower-cased, the pattern of their parts, and that of the
    words that such parts make up wherever they stand, for the two known kinds
    of files; no patterns for any other kind, whose words are never split here."""
    before = json.loads(tokenizer.pre_tokenizer.__getstate__()) if tokenizer.pre_tokenizer else {}
    steps = before.get("pretokenizers", [])
    known = f"{_LETTERS}0-9{_MARKS}"
    if tokenizer.normalizer is None and before.get("type") == "ByteLevel":
        if before.get("use_regex") and not before.get("add_prefix_space"):
            parts = rf" ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|\n(?!\s)"
            return False, re.compile(parts), re.compile(rf"[{known}]+(?:\n[{known}]+)*")
    split = [step.get("pattern", {}).get("Regex") for step in steps]
    if split == [r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+", None]:
        parts = rf" ?[{_LETTERS}]+| ?[0-9]| ?[{_MARKS}]+|[ \n]"
        return True, re.compile(parts), re.compile(rf"[{known}\n]*")
    return False, None, None


def _byte_symbols() -> list[str]:
    """The printable symbol of each byte in byte-level files: printable bytes
    stand for themselves, the others for the characters from 256 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(byte) if byte in plain else chr(next(others)) for byte in range(256)]


@lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path, added=True)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows of about ``limit`` bytes of text, at least a
    row each, so that what a task holds at once is bounded."""
    for batch in batches:
        sizes = np.cumsum([0, *(len(value.as_buffer() or b"") if value.is_valid else 0 for value in batch[column])])
        first = 0
        while first < len(batch):
            last = max(first + 1, int(np.searchsorted(sizes, sizes[first] + limit, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last
