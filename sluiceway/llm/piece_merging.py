"""Exact encoding and decoding with a merge-type piece vocabulary, by backtracking over longest matches.

The encoding of a text is the one sequence of vocabulary strings in which every neighbouring pair is compatible: merging the
characters of the two again, best score first, gives these two. So a text is cut into longest matches, found with an
Aho-Corasick automaton; a match that is not compatible with the token before it is replaced by the next shorter one, and where
none is left, the position is marked in a bitfield as failed and the token before it is taken back. No position is left twice
for the same reason, so the work is linear in the text.

A run of space marks with what follows up to the next mark is encoded by itself, since no vocabulary string holds a mark after
another character; ``Vocabulary`` refuses files for which that, or anything else assumed here, is not so. Characters outside the
vocabulary become their bytes and join nothing.
"""

from __future__ import annotations

import functools
import itertools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import bytes_of, steps

#: Fixed values of the file format: the space mark, the kinds of pieces, the kind of model, and what an unknown id reads as.
MARK = "▁"
USUAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGES = 2
UNREADABLE = " ⁇ "
#: Pre-tokens (in each of two halves) and pairs that a worker remembers, and characters of a text that are cut into pre-tokens at a time.
REMEMBERED, STRETCH = 400_000, 1 << 20


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of every field of a serialized message; numbers as unsigned, all else as bytes."""

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    at = 0
    while at < len(message):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or number()
        yield tag >> 3, message[at : at + size]
        at += size


class Vocabulary:
    """The pieces of a model file with the automaton over them."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, "rb") as file:
            model = list(fields(file.read()))
        pieces = [dict(fields(value)) for n, value in model if n == 1]
        trainer, normalizer = (dict(fields(next((v for n, v in model if n == number), b""))) for number in (2, 3))
        names = [p[1].decode() for p in pieces]
        kinds = [p.get(3, USUAL) for p in pieces]
        if trainer.get(3, 1) != MERGES or trainer.get(24, 0):
            raise ValueError("not a vocabulary of merges with marks before words")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(3, 1) or not normalizer.get(5, 1):
            raise ValueError("the model changes texts by more than space marks")
        if set(kinds) - {USUAL, UNKNOWN, CONTROL, BYTE} or kinds.count(BYTE) != 256:
            raise ValueError("the model has user-defined or unused pieces, or no bytes")
        if any(re.search(f"[^{MARK}]{MARK}", s) for s, kind in zip(names, kinds) if kind == USUAL):
            raise ValueError("a vocabulary string holds a space mark after another character")
        self.names, self.kinds = names, kinds
        self.score = {s: struct.unpack("<f", p.get(2, b"\0\0\0\0"))[0] for s, kind, p in zip(names, kinds, pieces) if kind == USUAL}
        self.of_byte = {int(s[3:5], 16): i for i, (s, kind) in enumerate(zip(names, kinds)) if kind == BYTE}
        self.begin, self.end = (next(i for i, (s, k) in enumerate(zip(names, kinds)) if k == CONTROL and s == mark) for mark in ("<s>", "</s>"))
        own = {s: [i] for i, (s, kind) in enumerate(zip(names, kinds)) if kind == USUAL}
        alphabet = {c for s in own for c in s}
        #: What each string is written as; a character that only occurs inside pieces is written as its bytes.
        self.ids = {c: [self.of_byte[b] for b in c.encode()] for c in alphabet} | own
        self.alphabet = alphabet
        self.shorter = {s: next((s[:n] for n in range(len(s) - 1, 0, -1) if s[:n] in self.ids), None) for s in self.ids}
        #: The longest piece at the start of every beginning of a piece.
        self.within: dict[str, str] = {}
        for start in sorted({s[:n] for s in self.ids for n in range(1, len(s) + 1)}, key=len):
            self.within[start] = start if start in self.ids else self.within[start[:-1]]
        self.longest = max(map(len, self.ids))
        self.automaton = ahocorasick.Automaton()
        for s in self.ids:
            self.automaton.add_word(s, s)
        self.automaton.make_automaton()
        self.known_pairs: dict[tuple[str | None, str], bool] = {}
        self.known = _Known(self)
        self.text_of = [
            s.replace(MARK, " ") if kind == USUAL else UNREADABLE if kind == UNKNOWN else "" for s, kind in zip(names, kinds)
        ]
        self.is_byte = np.array([kind == BYTE for kind in kinds])
        self.byte_of = {i: b for b, i in self.of_byte.items()}

    def merge(self, text: str) -> list[str]:
        """Merge characters pair by pair: the best score first, of equal scores the leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, before: str | None, token: str) -> bool:
        """Whether merging both again gives both; without a token before it, whether merging gives the token."""
        pair = (before, token)
        found = self.known_pairs.get(pair)
        if found is None:
            if len(self.known_pairs) >= REMEMBERED:
                self.known_pairs.clear()
            found = self.merge(token) == [token] if before is None else self.merge(before + token) == [before, token]
            self.known_pairs[pair] = found
        return found

    def match(self, text: str, at: int) -> str:
        """The longest piece at a position that the automaton's run over the text did not stop at."""
        ahead = text[at : at + self.longest]
        return self.within[ahead[: self.automaton.longest_prefix(ahead)]]

    def backtrack(self, text: str) -> list[str]:
        """The tokens of a text of known characters."""
        longest = {last + 1 - len(piece): piece for last, piece in self.automaton.iter_long(text)}
        known_pairs, shorter, size = self.known_pairs, self.shorter, len(text)
        failed: bytearray | None = None  # a bitfield, made when the first position fails
        tokens: list[str] = []
        at, before = 0, None
        token = longest[0]
        while True:
            while token is not None:
                stop = at + len(token)
                if failed is None or not failed[stop >> 3] >> (stop & 7) & 1:
                    fits = known_pairs.get((before, token))
                    if self.compatible(before, token) if fits is None else fits:
                        break
                token = shorter[token]
            if token is not None:
                tokens.append(token)
                if stop == size:
                    return tokens
                at, before = stop, token
                token = longest.get(at) or self.match(text, at)
                continue
            if not tokens:
                raise AssertionError("merging gave no tokens for a known text")
            if failed is None:
                failed = bytearray((size >> 3) + 1)
            failed[at >> 3] |= 1 << (at & 7)
            token = tokens.pop()
            before = tokens[-1] if tokens else None
            at -= len(token)

    def encode_part(self, text: str) -> list[int]:
        """The ids of one pre-token of any length."""
        if self.alphabet.issuperset(text):
            return [i for token in self.backtrack(text) for i in self.ids[token]]
        ids: list[int] = []
        for known, run in itertools.groupby(text, self.alphabet.__contains__):
            run = "".join(run)
            ids += [i for token in self.backtrack(run) for i in self.ids[token]] if known else [self.of_byte[b] for b in run.encode()]
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text, begin and end included, as little-endian unsigned 32-bit integers."""
        out = [struct.pack("<I", self.begin)]
        if text:
            marked = MARK + text.replace(" ", MARK)
            at, size = 0, len(marked)
            while at < size:
                border = _BORDER.search(marked, at + STRETCH)
                stop = border.end() - 1 if border else size
                out += map(self.known.__getitem__, _PART.findall(marked, at, stop))
                at = stop
        out.append(struct.pack("<I", self.end))
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        """The text of packed ids. A first space is the one put before the text; broken bytes read as U+FFFD, one each."""
        ids = np.frombuffer(packed, "<u4")
        size = len(self.names)
        out: list[str] = []
        if not self.is_byte[np.minimum(ids, size - 1)].any():
            out = [self.text_of[i] if i < size else UNREADABLE for i in ids.tolist()]
            spaced = [i for i in ids.tolist() if i < size and self.text_of[i] or i >= size][:1]
            joined = "".join(out)
            return joined[1:] if spaced and spaced[0] < size and self.kinds[spaced[0]] == USUAL and joined.startswith(" ") else joined
        run = bytearray()
        started = False
        for i in [*ids.tolist(), self.end]:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                started = True
                continue
            if run:
                out.append(_readable(bytes(run)))
                run.clear()
            piece = self.text_of[i] if i < size else UNREADABLE
            if piece and not started:
                started = True
                if i < size and self.kinds[i] == USUAL:
                    piece = piece.removeprefix(" ")
            out.append(piece)
        return "".join(out)


_PART = re.compile(f"{MARK}+[^{MARK}]*")
_BORDER = re.compile(f"[^{MARK}]{MARK}")


def _readable(run: bytes) -> str:
    try:
        return run.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at : at + size].decode())
            except UnicodeDecodeError:
                continue
            at += size
            break
        else:
            out.append("�")
            at += 1
    return "".join(out)


class _Known(dict):
    """Packed ids by pre-token. Long pre-tokens are not kept; what is full becomes the older half, and what is found there returns."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.older: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        packed = self.older.get(part)
        if packed is None:
            ids = self.vocabulary.encode_part(part)
            packed = struct.pack(f"<{len(ids)}I", *ids)
            if len(part) > 64:
                return packed
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[part] = packed
        return packed


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary for each worker process and model."""
    return Vocabulary(path)


def _encoded(path: str, decoding: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "_bytes"):
            pieces = vocabulary(path)
            packed = [pieces.encode(t.decode()) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(packed, pa.binary()), pa.array([len(p) // 4 for p in packed], pa.int64())]
            if decoding:
                columns.append(pa.array([pieces.decode(p) for p in packed], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["key", "ids", "n_tokens", "decoded"][: len(columns)])

    return run


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "_ids"):
            texts = [None if p is None else vocabulary(path).decode(p[: len(p) // 4 * 4]) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["key", "decoded"])

    return run


def encode(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids, n_tokens`` of every whole text; ids are packed little-endian unsigned 32-bit integers.

    Begin and end ids are included, so null and empty texts have these two. Each row is encoded on its own: keys may be null
    or repeat, other columns are ignored. Special strings inside a text are ordinary text. ``model_path`` must be readable on
    the executors; each worker loads it once. Nothing is shuffled.
    """
    kind = docs.select(f"`{key}`").schema[0].dataType.simpleString()
    taken = docs.select(F.col(f"`{key}`").alias("key"), bytes_of(f"`{text}`").alias("_bytes"))
    return taken.mapInArrow(_encoded(model_path, False), f"key {kind}, ids binary, n_tokens long").withColumnRenamed("key", key)


def decode(encoded: DataFrame, model_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, decoded`` of every row of packed ids. Null ids give null; ids outside the vocabulary read as unknown."""
    kind = encoded.select(f"`{key}`").schema[0].dataType.simpleString()
    taken = encoded.select(F.col(f"`{key}`").alias("key"), F.col(f"`{ids}`").alias("_ids"))
    return taken.mapInArrow(_decoded(model_path), f"key {kind}, decoded string").withColumnRenamed("key", key)


def round_trip(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids, n_tokens, decoded``: ``encode`` and ``decode`` in one pass over the texts, with the same results."""
    kind = docs.select(f"`{key}`").schema[0].dataType.simpleString()
    taken = docs.select(F.col(f"`{key}`").alias("key"), bytes_of(f"`{text}`").alias("_bytes"))
    schema = f"key {kind}, ids binary, n_tokens long, decoded string"
    return taken.mapInArrow(_encoded(model_path, True), schema).withColumnRenamed("key", key)
