"""Splitting text into the pieces that are encoded one by one, with results remembered."""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# A pattern that never joins a space with what stands before it, unless that is white space too. Fixed value.
SPACE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A space amid white space, or at the end after white space: only there does a run go over a space.
CROSSED = re.compile(r"\s (?:\s|\Z)")
# Rows whose words are looked up together, and whose ids are gathered together.
ROWS = 1024
# Bytes of the texts whose different words are split together.
BLOCK_BYTES = 1 << 23
MAX_PIECES = 100_000
MAX_WORDS = 500_000


class Remembered(dict):
    """Results of a function for the keys asked for last: the current generation and, of the one before, what is asked for
    again. A generation ends when it has `limit` keys."""

    def __init__(self, make: Callable[[str], Any], limit: int):
        super().__init__()
        self.make, self.limit, self.before = make, limit, {}

    def __missing__(self, key: str) -> Any:
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class Splitter:
    """What `make` gives for the pieces of a text, in order; `combine` joins several results to one.

    With `SPACE_PATTERN` a text can be cut before each space, as long as no run of white space goes over one. So
    a word with the marks around it is looked up at once, and only new ones are split by the pattern.
    """

    def __init__(self, pattern: str, make: Callable[[str], Any], combine: Callable[[Iterable], Any]):
        self.find = regex.compile(pattern).findall
        self.at_spaces = pattern == SPACE_PATTERN
        self.combine = combine
        self.pieces = Remembered(make, MAX_PIECES)
        self.words = Remembered(lambda word: self._whole(f" {word}"), MAX_PIECES)

    def _whole(self, text: str) -> Any:
        return self.combine(map(self.pieces.__getitem__, self.find(text)))

    def results(self, text: str) -> Iterable:
        if not self.at_spaces or CROSSED.search(text):
            return map(self.pieces.__getitem__, self.find(text))
        first, *words = text.split(" ")
        return itertools.chain([self._whole(first)], map(self.words.__getitem__, words))


def runs(lengths: np.ndarray) -> np.ndarray:
    """0 and the ends of consecutive runs of these lengths."""
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths, dtype=np.int64)])


class Runs:
    """Sequences one behind the other in an array, looked up by number."""

    def __init__(self, kind: type):
        self.kind = np.dtype(kind)
        self.values, self.ends = np.zeros(0, self.kind), np.zeros(1, np.int64)

    def add(self, sequences: Sequence[bytes]) -> None:
        """Append sequences, given by their bytes."""
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences)) // self.kind.itemsize
        self.values = np.concatenate([self.values, np.frombuffer(b"".join(sequences), self.kind)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])

    def __len__(self) -> int:
        return len(self.ends) - 1

    def joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sequences of these numbers one behind the other, and where each begins, with the end of the last."""
        starts = self.ends[numbers]
        lengths = self.ends[numbers + 1] - starts
        places = runs(lengths)
        at = np.repeat(starts - places[:-1], lengths)
        at += np.arange(places[-1])
        return self.values[at], places


class WordTable:
    """Ids of whole texts, by numbers for their words.

    The different words of a slice of texts are looked up once, and the ids gathered by number; only words that are new are
    split and encoded. The table is emptied when it is full, between two slices.
    """

    def __init__(self, splitter: Splitter, kind: type, packed: Callable[[Any], bytes], limit: int | None = None):
        self.splitter, self.kind, self.packed, self.limit = splitter, kind, packed, limit or MAX_WORDS
        self._empty()

    def _empty(self) -> None:
        self.numbers: dict[str, int] = {}
        self.table = Runs(self.kind)

    def _word(self, word: str) -> bytes:
        """Ids of a word and the space before it."""
        return self.packed(self.splitter._whole(f" {word}"))

    def _several(self, keys: list[str]) -> list[bytes]:
        return [self._word(word) for word in keys]

    def _learn(self, keys: Iterable[str]) -> None:
        """Different keys; those that are new get a number and their ids."""
        new = [key for key in keys if key not in self.numbers]
        if new:
            start = len(self.table)
            self.table.add(self._several(new))
            self.numbers.update(zip(new, range(start, len(self.table)), strict=True))

    def _numbers_of(self, keys: list[str]) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, keys), np.int64, len(keys))

    def _looked_up(self, words: pa.Array) -> tuple[Runs, np.ndarray]:
        """A table, and the numbers that these different words have in it."""
        different = words.to_pylist()
        self._learn(different)
        return self.table, self._numbers_of(different)

    def _blocks(self, texts: pa.Array) -> Iterator[pa.Array]:
        """Texts whose words are looked up together."""
        for start in range(0, len(texts), ROWS):
            yield texts.slice(start, ROWS)

    def encoded(self, texts: pa.Array, apart: Callable[[str], bytes | None] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """In slices of `ROWS`: all ids of a slice, and the positions where its texts begin, with the end of the last.

        Nulls are empty. `apart` gives the ids of a text that is not to be split, or None.
        """
        splitter = self.splitter
        for block in self._blocks(texts):
            if len(self.numbers) > self.limit:
                self._empty()
            part = block.cast(pa.large_string()).fill_null("")
            plain = part.to_pylist()
            own: list[bytes | None] = [apart(text) if apart else None for text in plain]
            for row, text in enumerate(plain):
                if own[row] is None and (not splitter.at_spaces or CROSSED.search(text)):
                    own[row] = self.packed(splitter.combine(splitter.results(text)))
            # Texts that were looked up as a whole have no words; their ids stand for their first one.
            alone = pa.array([ids is not None for ids in own])
            split = pc.split_pattern(pc.if_else(alone, pa.scalar("", pa.large_string()), part), " ")
            offsets = np.asarray(split.offsets, np.int64)
            offsets -= offsets[0]
            words = split.flatten().dictionary_encode()
            table, numbers = self._looked_up(words.dictionary)
            indices = words.indices.to_numpy(zero_copy_only=False)
            # The first word of a text has no space before it: its ids are not those of the table.
            firsts = [self.packed(splitter._whole(text.partition(" ")[0])) if found is None else found for text, found in zip(plain, own, strict=True)]
            for start in range(0, len(part), ROWS):
                within = offsets[start : start + ROWS + 1]
                ids, places = table.joined(numbers[indices[within[0] : within[-1]]])
                yield _with_firsts(ids, places, within - within[0], firsts[start : start + ROWS], self.kind)


class PieceTable(WordTable):
    """Ids of whole texts, by numbers for the pieces of their words.

    Of a block of texts the different words are split together, and their ids are put together from those of the pieces:
    words that differ only in the marks around them share one. Only pieces are kept from block to block; `several` gives
    the ids of new ones.
    """

    def __init__(self, splitter: Splitter, kind: type, packed: Callable[[Any], bytes], several: Callable[[list[str]], list[bytes]], limit: int | None = None):
        super().__init__(splitter, kind, packed, limit)
        self._several = several

    def _blocks(self, texts: pa.Array) -> Iterator[pa.Array]:
        """Consecutive texts of `BLOCK_BYTES` at most, or a longer one."""
        ends, start = runs(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)), 0
        while start < len(texts):
            stop = max(int(np.searchsorted(ends, ends[start] + BLOCK_BYTES, "right")) - 1, start + 1)
            yield texts.slice(start, stop - start)
            start = stop

    def _looked_up(self, words: pa.Array) -> tuple[Runs, np.ndarray]:
        # One behind the other, with a space before each, words are split as they are alone, as no run of white space
        # goes over a space between them.
        inner = pc.and_(pc.not_equal(words, ""), pc.equal(pc.utf8_trim_whitespace(words), words))
        joined = words.filter(inner).cast(pa.string())
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(joined)], pa.int32()), joined), " ")[0].as_py()
        pieces = self.splitter.find(f" {text}") if len(joined) else []
        self._learn(dict.fromkeys(pieces))
        ids, places = self.table.joined(self._numbers_of(pieces))
        begins = np.flatnonzero(np.fromiter((piece[0] == " " for piece in pieces), bool, len(pieces)))
        table = Runs(self.kind)
        table.values, table.ends = ids, np.append(places[begins], places[-1])
        numbers, edges = np.empty(len(words), np.int64), pc.invert(inner)
        numbers[inner.to_numpy(zero_copy_only=False)] = np.arange(len(begins))
        table.add([self._word(word) for word in words.filter(edges).to_pylist()])
        numbers[edges.to_numpy(zero_copy_only=False)] = np.arange(len(begins), len(table))
        return table, numbers


def _with_firsts(ids: np.ndarray, places: np.ndarray, offsets: np.ndarray, firsts: list[bytes], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts whose first words are replaced."""
    parts, begins = [], [0]
    for row, first in enumerate(firsts):
        found = np.frombuffer(first, kind)
        rest = ids[places[offsets[row] + 1] : places[offsets[row + 1]]]
        parts += [found, rest]
        begins.append(begins[-1] + len(found) + len(rest))
    return np.concatenate([*parts, np.zeros(0, kind)]), np.array(begins, np.int64)
