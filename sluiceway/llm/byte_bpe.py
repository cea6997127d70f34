"""Byte-level BPE by backtracking from longest matches.

A sequence of tokens is what the merges give exactly if each two neighbours are: encoding the bytes of both gives them
back. So a piece of text is covered from the left by the longest token that fits its left neighbour, going
back when none does. Tokens come from an Aho-Corasick automaton over the vocabulary, whose bytes are mapped to Latin-1
characters; verdicts on neighbours are remembered, as are dead ends, so the work per piece is linear in its length.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from sluiceway.llm.common import as_text, kept, mapped
from sluiceway.llm.pieces import Runs, Splitter, WordTable

MAX_PAIRS = 300_000
# Words whose ids a worker keeps: it also holds what other stages of a pipeline keep.
MAX_WORDS = 200_000


@dataclass(frozen=True)
class Vocabulary:
    """Lines of a rank file (base64 of the bytes, rank), and the pattern whose matches are encoded one by one."""

    ranks: bytes
    pattern: str

    @property
    def name(self) -> str:
        return hashlib.sha256(self.ranks + self.pattern.encode()).hexdigest()


def read_vocabulary(path: str, pattern: str) -> Vocabulary:
    """Read on the driver and sent along with the work, so that executors need not have the file."""
    with open(path, "rb") as file:
        return Vocabulary(file.read(), pattern)


class BytePairEncoder:
    def __init__(self, vocabulary: Vocabulary):
        lines = (line.split() for line in vocabulary.ranks.splitlines() if line)
        self.ids = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.bytes = {rank: token for token, rank in self.ids.items()}
        self.splitter = Splitter(vocabulary.pattern, self.encode_piece, lambda found: tuple(chain.from_iterable(found)))
        self.table = WordTable(self.splitter, np.int32, lambda ids: array("i", ids).tobytes(), limit=MAX_WORDS)
        self.automaton = ahocorasick.Automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.sizes = {rank: len(token) for rank, token in self.bytes.items()}
        self.shorter: dict[int, int | None] = {}  # of each token the longest one that begins it
        self._learn_merges()

    def _learn_merges(self) -> None:
        """How each token came about: the two older tokens that were merged last.

        Tokens are taken in the order of their ranks, so everything that can precede a merge is known. A token
        that the merges never reach is left out of the automaton; it is only used for a piece that equals it.
        """
        usable: set[bytes] = set()
        for rank in sorted(self.bytes):
            token = self.bytes[rank]
            if len(token) > 1:
                parts = self._split_before(token, rank)
                if len(parts) != 2:
                    continue
                self.halves[rank] = (parts[0], parts[1])
            self.automaton.add_word(token.decode("latin-1"), rank)
            usable.add(token)
        self.automaton.make_automaton()
        for token in usable:
            beginnings = (token[:n] for n in range(len(token) - 1, 0, -1))
            self.shorter[self.ids[token]] = next((self.ids[x] for x in beginnings if x in usable), None)

    def _split_before(self, token: bytes, limit: int) -> list[int]:
        """The token's bytes after all merges with a rank below `limit`."""
        ids, parts = self.ids, [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            rank, at = min((ids.get(parts[i] + parts[i + 1], limit), i) for i in range(len(parts) - 1))
            if rank >= limit:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ids[part] for part in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of two tokens gives these two tokens.

        The merges beside the border are undone from the youngest on, of equal ones the right one first. Had a merge
        across the border been possible before one that is undone, with a lower rank or an equal one further left, it
        would have come first.
        """
        known = self.pairs.get((left, right))
        if known is not None:
            return known
        if len(self.pairs) >= MAX_PAIRS:
            self.pairs.clear()
        ids, content, halves = self.ids, self.bytes, self.halves
        a, b, limit, verdict = left, right, 1 << 60, True
        while verdict:
            across = ids.get(content[a] + content[b], limit)
            if across < limit:
                verdict = False
            elif b in halves and (b >= a or a not in halves):
                limit, b = b + 1, halves[b][0]
            elif a in halves:
                limit, a = a, halves[a][1]
            else:
                break
        self.pairs[left, right] = verdict
        return verdict

    def _cover(self, piece: bytes) -> tuple[int, ...]:
        n, sizes, shorter, compatible = len(piece), self.sizes, self.shorter, self.compatible
        longest: list[int | None] = [None] * n
        for end, rank in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - sizes[rank]] = rank  # matches come by rising end: the last of a start stays
        path: list[int] = []
        dead: set[int] = set()
        at, token = 0, longest[0]
        while True:
            while token is not None:
                if at + sizes[token] not in dead and (not path or compatible(path[-1], token)):
                    break
                token = shorter[token]
            if token is None:
                # Nothing goes on from here, so no sequence of tokens ends here.
                if not path:
                    raise ValueError("a byte is missing from the vocabulary")
                dead.add(at)
                token = path.pop()
                at -= sizes[token]
                token = shorter[token]
                continue
            path.append(token)
            at += sizes[token]
            if at == n:
                return tuple(path)
            token = longest[at]

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode()
        whole = self.ids.get(raw)
        return (whole,) if whole is not None else self._cover(raw)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.splitter.results(text)))

    def encode_all(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of whole texts in slices, and where each text begins and ends."""
        return self.table.encoded(texts)

    @functools.cached_property
    def numbers(self) -> np.ndarray:
        """The number of each id in `raw` and `decimals`."""
        numbers = np.zeros(max(self.bytes, default=0) + 1, np.int64)
        numbers[list(self.bytes)] = np.arange(len(self.bytes))
        return numbers

    @functools.cached_property
    def raw(self) -> Runs:
        """The bytes of all ids."""
        return self._runs(self.bytes.values())

    @functools.cached_property
    def decimals(self) -> Runs:
        """All ids as decimal numbers, each with a comma behind it."""
        return self._runs(f"{rank},".encode() for rank in self.bytes)

    @staticmethod
    def _runs(sequences: Iterable[bytes]) -> Runs:
        found = Runs(np.uint8)
        found.add(list(sequences))
        return found

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


def encoder_of(vocabulary: Vocabulary) -> BytePairEncoder:
    """The encoder of a vocabulary, built once in each Python worker."""
    return kept(__name__, vocabulary.name, lambda: BytePairEncoder(vocabulary))


def _encode(vocabulary: Vocabulary, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder = encoder_of(vocabulary)
    for batch in batches:
        at = 0
        for ids, places in encoder.encode_all(batch.column("text")):
            part = batch.slice(at, len(places) - 1)
            at += len(places) - 1
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(ids))], ["doc_id", "ids"])


def _decode(vocabulary: Vocabulary, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder = encoder_of(vocabulary)
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            texts = [encoder.decode(ids or []) for ids in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "bytes"])


def _round_trip(vocabulary: Vocabulary, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Encodes, and decodes the ids: both from one pass, without a table of ids in between."""
    encoder = encoder_of(vocabulary)
    for batch in batches:
        sizes, ids_digests, decoded_digests = [], [], []
        for ids, places in encoder.encode_all(batch.column("text")):
            sizes += np.diff(places).tolist()
            for runs, cut, digests in ((encoder.decimals, 1, ids_digests), (encoder.raw, 0, decoded_digests)):
                # By parts, so that the bytes of few texts are there at a time.
                for first in range(0, len(places) - 1, 128):
                    ends = places[first : first + 129]
                    found, at = runs.joined(encoder.numbers[ids[ends[0] : ends[-1]]])
                    joined, stops = found.tobytes(), at[ends - ends[0]].tolist()
                    digests += [hashlib.sha256(joined[start : max(start, stop - cut)]).hexdigest() for start, stop in itertools.pairwise(stops)]
        columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(decoded_digests, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """`(doc_id, ids)`: the token ids of each whole text. Null and empty texts have no ids; rows come out as often as they
    go in, whatever their id; other columns are not looked at."""
    return mapped(as_text(docs), functools.partial(_encode, vocabulary), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """`(doc_id, bytes)` from `(doc_id, ids)`. Null and empty lists of ids are no bytes; an unknown id is an error."""
    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return mapped(rows, functools.partial(_decode, vocabulary), "doc_id long, bytes binary")


def round_trip(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """`(doc_id, n_tokens, ids_sha256, decoded_sha256)`: digests of the decimal ids, joined by commas, and of the bytes they
    decode to. Rows as for `encode`."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return mapped(as_text(docs), functools.partial(_round_trip, vocabulary), schema)


def _texts_and_ids(vocabulary: Vocabulary, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder = encoder_of(vocabulary)
    for batch in batches:
        column, start = batch.schema.get_field_index("text"), 0
        for ids, places in encoder.encode_all(batch.column(column)):
            part = batch.slice(start, len(places) - 1)
            start += len(places) - 1
            found, at = encoder.raw.joined(encoder.numbers[ids])
            joined, stops = found.tobytes(), at[places].tolist()
            decoded = pa.array([joined[a:b].decode() for a, b in itertools.pairwise(stops)], part.schema.field(column).type)
            lists = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(ids))
            columns = [*part.set_column(column, "text", decoded).columns, lists, pa.array(np.diff(places))]
            yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "ids", "n_tokens"])


def tokenized(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """`docs` with `ids` and `n_tokens`, and `text` as decoded from the ids; columns of these names are replaced. A null text
    becomes an empty one without ids; rows come out as often as they go in; no rows give no rows."""
    rows = docs.drop("ids", "n_tokens")
    schema = StructType([*rows.schema.fields, StructField("ids", ArrayType(IntegerType())), StructField("n_tokens", LongType())])
    return mapped(rows, functools.partial(_texts_and_ids, vocabulary), schema)
