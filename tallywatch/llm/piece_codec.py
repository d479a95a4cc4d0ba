"""Encoding and decoding with a SentencePiece model of the merge type.

Encoding finds the merges' result without merging: it walks over the text with
the longest vocabulary pieces, falls back to shorter ones, and steps back where
two neighbours could not have come about side by side. A bitfield keeps the
positions from which no way leads on."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import texts
from .tokens import Known, slices

SPACE = "▁"
CACHE = 300_000
ROOM = 160_000_000
_NEVER = float("-inf")
_RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class PieceCodec:
    """A model's pieces and scores; models that normalise texts are refused."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.pieces = [model.id_to_piece(number) for number in range(self.size)]
        special = [model.is_byte(n) or model.is_control(n) or model.is_unknown(n) or model.is_unused(n) for n in range(self.size)]
        for probe in ("a  b ", "ﬁ ①", "Å", "Ａ"):
            if model.normalize(probe).replace(SPACE, " ") != " " + probe:
                raise ValueError(f"only models without normalisation are supported: {path}")
        self.ids = {piece: number for number, piece in enumerate(self.pieces) if not special[number]}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            raise ValueError(f"pieces may hold spaces at their start only: {path}")
        # Merges go by score, highest first.
        self.score = {piece: model.get_score(number) for piece, number in self.ids.items()}
        self.bytes = {int(p[3:5], 16): n for n, p in enumerate(self.pieces) if model.is_byte(n)}
        self.unknown = model.unk_id()
        self.characters = frozenset(piece for piece in self.ids if len(piece) == 1)
        self.automaton = ahocorasick.Automaton()
        for piece, number in self.ids.items():
            self.automaton.add_word(piece, (len(piece), number))
        self.automaton.make_automaton()
        self.shorter = {n: self._next_shorter(p) for p, n in self.ids.items()}
        self.compatible_pairs: dict[tuple[int, int], bool] = {}
        self.neighbours = {piece[at : at + 2] for piece in self.ids for at in range(len(piece) - 1)}
        self.words, self.runs = Known(self._word, ROOM // 3), Known(self._run, ROOM * 2 // 3, at_once=True)
        self.raw_byte = [int(p[3:5], 16) if model.is_byte(n) else None for n, p in enumerate(self.pieces)]
        self.surface = [
            piece.replace(SPACE, " ").encode() if byte is None else bytes([byte])
            for piece, byte in zip(self.pieces, self.raw_byte)
        ]
        self.spaced = np.array([piece.startswith(SPACE) for piece in self.pieces])
        self.lengths = np.array([len(part) for part in self.surface])
        self.places = np.cumsum(self.lengths) - self.lengths
        self.surfaces = np.frombuffer(b"".join(self.surface), np.uint8)

    def _next_shorter(self, piece: str) -> int | None:
        """The longest piece that is a proper prefix."""
        for end in range(len(piece) - 1, 0, -1):
            if piece[:end] in self.ids:
                return self.ids[piece[:end]]
        return None

    def merged(self, text: str, boundary: int = -1) -> list[str] | None:
        """The merges' result on a short text; None as soon as a merge crosses
        ``boundary``."""
        parts, score = list(text), self.score.get
        values = [score(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
        while values:
            best = max(values)
            if best == _NEVER:
                break
            at = values.index(best)  # the leftmost of equal ones
            whole = parts[at] + parts[at + 1]
            if boundary >= 0:
                start = sum(map(len, parts[:at]))
                if start < boundary < start + len(whole):
                    return None
            parts[at : at + 2] = [whole]
            del values[at]
            if at < len(values):
                values[at] = score(whole + parts[at + 1], _NEVER)
            if at:
                values[at - 1] = score(parts[at - 1] + whole, _NEVER)
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the two pieces' text gives these two pieces again."""
        found = self.compatible_pairs.get((left, right))
        if found is None:
            a, b = self.pieces[left], self.pieces[right]
            found = self.merged(a + b, len(a)) == [a, b]
            if len(self.compatible_pairs) > CACHE:
                self.compatible_pairs.clear()
            self.compatible_pairs[left, right] = found
        return found

    def _backtrack(self, text: str) -> list[int]:
        """Pieces of a text whose characters are all in the vocabulary."""
        longest = [0] * len(text)
        for end, (length, number) in self.automaton.iter(text):
            longest[end + 1 - length] = number  # ends rise, so the last one is the longest
        tokens: list[int] = []
        position, failed, token = 0, 0, longest[0]
        while True:
            while token is not None:
                end = position + len(self.pieces[token])
                if not failed >> end & 1:
                    if tokens:
                        if self.compatible(tokens[-1], token):
                            break
                    elif end < len(text) or self.merged(text) == [text]:
                        break
                token = self.shorter[token]
            if token is not None:
                tokens.append(token)
                position = end
                if position == len(text):
                    return tokens
                token = longest[position]
            else:
                failed |= 1 << position
                last = tokens.pop()
                position -= len(self.pieces[last])
                token = self.shorter[last]

    def _word(self, word: str) -> bytes:
        """Ids of a word with its space, cut where no piece holds both
        neighbours: no merge ever crosses there."""
        run, near = SPACE + word, self.neighbours
        cuts = [at for at in range(1, len(run)) if run[at - 1 : at + 1] not in near]
        if not cuts:
            return self.runs[run]
        return b"".join([self.runs[run[a:b]] for a, b in zip([0, *cuts], [*cuts, len(run)])])

    def _run(self, run: str) -> bytes:
        return array("i", self._encode_run(run)).tobytes()

    def _encode_run(self, run: str) -> list[int]:
        """Ids of a stretch of text; characters outside the vocabulary never
        merge and become their bytes."""
        if self.characters.issuperset(run):
            return self._backtrack(run)
        ids: list[int] = []
        start = 0
        for place, character in enumerate(run):
            if character not in self.characters:
                if start < place:
                    ids += self._backtrack(run[start:place])
                ids += [self.bytes.get(byte, self.unknown) for byte in character.encode()]
                start = place + 1
        if start < len(run):
            ids += self._backtrack(run[start:])
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers. Pieces hold no space after
        another character, so every run of spaces starts a stretch of its own."""
        if not text:
            return b""
        if text[0] == " " or "  " in text or SPACE in text:
            marked = SPACE + text.replace(" ", SPACE)
            words = [run[1:] for run in _RUNS.findall(marked)]
        else:
            words = text.split(" ")
        return b"".join(map(self.words.__getitem__, words))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces without the leading space, runs of byte
        pieces read as UTF-8, where a byte that fits nowhere becomes U+FFFD."""
        if not len(ids):
            return ""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(self.places[ids] - ends + lengths, lengths)
        data = self.surfaces[at].tobytes()
        try:
            text = data.decode()
        except UnicodeDecodeError:
            text = self._decode_damaged(ids.tolist())
        return text[1:] if self.spaced[ids[0]] else text

    def _decode_damaged(self, ids: list[int]) -> str:
        parts, held = [], b""
        for number in [*ids, None]:
            if number is not None and self.raw_byte[number] is not None:
                held += self.surface[number]
                continue
            while held:
                try:
                    part, held = held.decode(), b""
                except UnicodeDecodeError as error:
                    part, held = held[: error.start].decode() + "\ufffd", held[error.start + 1 :]
                parts.append(part)
            if number is not None:
                parts.append(self.surface[number].decode())
        return "".join(parts)


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, ids array<int>`` for every row, exactly as the model's library
    encodes whole texts, without begin and end ids. A null or empty text has no
    ids; rows with equal or null ids are all encoded; an empty table gives no
    rows; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [codec(model).encode(text) for text in batch["text"].to_pylist()]
            bounds = np.cumsum([0, *(len(row) // 4 for row in rows)])
            values = pa.array(np.frombuffer(b"".join(rows), "<i4"), pa.int32())
            ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "ids": ids})

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, model: str) -> DataFrame:
    """``rows`` (``doc_id, ids``) with the ids' text as ``decoded``; null ids
    count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 256):
                part = batch.slice(first, 256)
                decoded = [
                    codec(model).decode(ids.values.to_numpy() if ids.is_valid else np.zeros(0, np.int32))
                    for ids in part["ids"]
                ]
                yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"], "ids": part["ids"], "decoded": decoded})

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")
