"""Token files with random access: directly addressable codes.

Ids are split into chunks of eight bits, the low one first. Level k holds the k-th chunks of all ids that have as many;
a bitmap per level says which ids go on in the next, and a rank directory counts its ones before each block of bits, so a
token is found by one rank per level, without decoding its neighbours.

A token file is a directory of Parquet files written by Spark. A row is a segment: consecutive documents in ascending
order of doc_id, their ends, and the code of their ids. `part` and `offset` place it; `starts` beside it holds the first
position of each part. Codes are stored uncompressed: a token is read from its segment's bytes as they are.
"""

from __future__ import annotations

import functools
import hashlib
import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluiceway.llm.common import as_text, mapped
from sluiceway.llm.pieces import PieceTable, Splitter

# A task has its core; the library's own threads would share those of others.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

MAGIC = b"DAC1"
RANK_BITS = 512
SEGMENT_TOKENS = 400_000
END_ID = 0
# Pieces whose ids a worker keeps.
MAX_PIECES = 600_000


class Codes:
    """Directly addressable codes of unsigned 32-bit integers."""

    def __init__(self, size: int, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.size = size
        self.levels = levels  # chunks, bitmap bytes, ranks

    @classmethod
    def of(cls, ids: np.ndarray) -> Codes:
        values, levels, size = ids.astype(np.uint32), [], len(ids)
        while len(values):
            more = values > 0xFF
            bitmap = np.packbits(more, bitorder="little")
            padded = np.pad(more, (0, -len(more) % RANK_BITS)).reshape(-1, RANK_BITS)
            ranks = np.concatenate([[0], np.cumsum(padded.sum(axis=1))]).astype(np.uint32)
            levels.append((values.astype(np.uint8), bitmap, ranks))
            values = values[more] >> np.uint32(8)
        return cls(size, levels)

    def to_bytes(self) -> bytes:
        sizes = [len(chunks) for chunks, _, _ in self.levels]
        head = MAGIC + struct.pack(f"<QB{len(sizes)}Q", self.size, len(sizes), *sizes)
        return head + b"".join(part.tobytes() for level in self.levels for part in level)

    @classmethod
    def from_bytes(cls, raw: bytes) -> Codes:
        if raw[:4] != MAGIC:
            raise ValueError("not a token segment")
        size, n_levels = struct.unpack_from("<QB", raw, 4)
        sizes, at, levels = struct.unpack_from(f"<{n_levels}Q", raw, 13), 13 + 8 * n_levels, []
        for n in sizes:
            parts = []
            for count, kind in ((n, np.uint8), (-(-n // 8), np.uint8), (-(-n // RANK_BITS) + 1, np.uint32)):
                parts.append(np.frombuffer(raw, kind, count, at))
                at += count * np.dtype(kind).itemsize
            levels.append(tuple(parts))
        return cls(size, levels)

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, position: int) -> int:
        if not 0 <= position < self.size:
            raise IndexError(position)
        value, at = 0, position
        for level, (chunks, bitmap, ranks) in enumerate(self.levels):
            value |= int(chunks[at]) << (8 * level)
            if not bitmap[at >> 3] >> (at & 7) & 1:
                break
            block = at // RANK_BITS
            before = np.unpackbits(bitmap[block * RANK_BITS // 8 : (at >> 3) + 1], bitorder="little")[: at - block * RANK_BITS]
            at = int(ranks[block]) + int(before.sum())
        return value

    def all(self) -> np.ndarray:
        """All ids, level by level from the last."""
        above = np.zeros(0, np.uint32)
        for chunks, bitmap, _ in reversed(self.levels):
            values = chunks.astype(np.uint32)
            values[np.unpackbits(bitmap, count=len(chunks), bitorder="little").view(bool)] += above << np.uint32(8)
            above = values
        return above


@dataclass(frozen=True)
class Encoding:
    """A tokenizer file of the tokenizers library, the pattern it splits text by first, and the id at a document's end."""

    definition: str
    pattern: str
    end_id: int = END_ID

    @property
    def name(self) -> str:
        return hashlib.sha256((self.definition + self.pattern).encode()).hexdigest()


def read_encoding(path: str, pattern: str, end_id: int = END_ID) -> Encoding:
    """Read on the driver and sent along with the work, so that executors need not have the file."""
    with open(path, encoding="utf-8") as file:
        return Encoding(file.read(), pattern, end_id)


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies use for each byte: itself where Latin-1 prints it, else the next from 256 on."""
    hidden = [byte for byte in range(256) if not (33 <= byte <= 126 or byte >= 161) or byte == 173]
    return {byte: chr(byte) for byte in range(256)} | {byte: chr(256 + number) for number, byte in enumerate(hidden)}


class PieceEncoder:
    """Ids of whole texts by a byte-level tokenizer; pieces that come again are not encoded again.

    The tokenizer encodes the pieces that its pattern splits a text into one by one, so their ids can be kept. Texts that
    hold the string of a special token are encoded as a whole, as the tokenizer takes those out before it splits.
    """

    def __init__(self, encoding: Encoding):
        self.tokenizer = Tokenizer.from_str(encoding.definition)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.end = struct.pack("<I", encoding.end_id)
        self.model, letters = self.tokenizer.model, byte_letters()
        self.letters = np.array([ord(letters[byte]) for byte in range(256)], "<u4")
        self.splitter = Splitter(encoding.pattern, self._piece, b"".join)
        self.table = PieceTable(self.splitter, np.dtype("<u4"), bytes, self._several, MAX_PIECES)

    def _piece(self, piece: str) -> bytes:
        return self._several([piece])[0]

    def _several(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, each by the tokenizer's merges; they work on a letter for each byte."""
        raw = [piece.encode() for piece in pieces]
        letters, at, packed = self.letters[np.frombuffer(b"".join(raw), np.uint8)].tobytes().decode("utf-32-le"), 0, []
        for piece in raw:
            found = self.model.tokenize(letters[at : (at := at + len(piece))])
            packed.append(struct.pack(f"<{len(found)}I", *[token.id for token in found]))
        return packed

    def _ids(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _apart(self, text: str) -> bytes | None:
        return self._ids(text) if any(mark in text for mark in self.special) else None

    def encode(self, text: str) -> bytes:
        """Ids and the end id as little-endian unsigned 32-bit integers."""
        whole = self._apart(text)
        return (b"".join(self.splitter.results(text)) if whole is None else whole) + self.end

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, without the end id."""
        for ids, places in self.table.encoded(texts, self._apart):
            for start, end in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
                yield ids[start:end]


_encoders: dict[str, PieceEncoder] = {}


def encoder_of(encoding: Encoding) -> PieceEncoder:
    """The encoder of a tokenizer, built once in each Python worker."""
    if encoding.name not in _encoders:
        _encoders.clear()
        _encoders[encoding.name] = PieceEncoder(encoding)
    return _encoders[encoding.name]


def _segments(encoding: Encoding, segment_tokens: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder = encoder_of(encoding)
    part, offset, size = TaskContext.get().partitionId(), 0, 0
    doc_ids: list[int | None] = []
    pieces: list[np.ndarray] = []
    last = np.array([encoding.end_id], "<u4")

    def segment() -> pa.RecordBatch:
        codes = Codes.of(np.concatenate([part for piece in pieces for part in (piece, last)]))
        ends = np.cumsum([len(piece) + 1 for piece in pieces])
        rows = [[part], [offset], [len(codes)], [doc_ids], [ends], [codes.to_bytes()]]
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(rows, kinds, strict=True)], NAMES)

    for batch in batches:
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode_all(batch.column("text")), strict=True):
            doc_ids.append(doc_id)
            pieces.append(ids)
            size += len(ids) + 1
            if size >= segment_tokens:
                yield segment()
                offset, size, doc_ids, pieces = offset + size, 0, [], []
    if pieces:
        yield segment()


NAMES = ["part", "offset", "n_tokens", "doc_ids", "ends", "codes"]
SCHEMA = "part int, offset long, n_tokens long, doc_ids array<long>, ends array<long>, codes binary"


def write(docs: DataFrame, encoding: Encoding, path: str, segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Write the ids of all documents, each with the end id, in ascending order of doc_id to a token file.

    Null texts are empty; null ids come first; rows with one id follow each other in some fixed order. Other columns are
    not looked at; no rows give an empty file. `segment_tokens` bounds a segment up to the size of its last document.
    """
    spark = docs.sparkSession
    # Equal ids may be many rows: the rest of the key lets them spread over neighbouring parts.
    ordered = as_text(docs).withColumns({"rest": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = ordered.repartitionByRange("doc_id", "rest", "row").sortWithinPartitions("doc_id", "rest", "row").select("doc_id", "text")
    mapped(ordered, functools.partial(_segments, encoding, segment_tokens), SCHEMA).write.option("compression", "uncompressed").parquet(f"{path}/segments")
    # One row per part; a running sum over them.
    totals = spark.read.schema(SCHEMA).parquet(f"{path}/segments").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    totals.select("part", F.coalesce(before, F.lit(0)).cast("long").alias("start")).write.parquet(f"{path}/starts")


def segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments of a token file with `first`, the position of their first token."""
    starts = spark.read.schema("part int, start long").parquet(f"{path}/starts")
    rows = spark.read.schema(SCHEMA).parquet(f"{path}/segments")
    # As many rows as the file has parts: a number of tasks, whatever the size of the data.
    return rows.join(F.broadcast(starts), "part").withColumn("first", F.col("start") + F.col("offset"))


def token(spark: SparkSession, path: str, position: int) -> int:
    """The id at a position of a token file: only the segment that holds it is read."""
    within = (F.col("first") <= position) & (F.col("first") + F.col("n_tokens") > position)
    row = segments(spark, path).where(within).select("first", "codes").first()
    if row is None:
        raise IndexError(position)
    return Codes.from_bytes(row["codes"])[position - row["first"]]


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, doc_ids, ends, raw in zip(*(batch.column(x) for x in ("first", "doc_ids", "ends", "codes")), strict=True):
            ids = Codes.from_bytes(raw.as_py()).all()
            stops = np.array(ends.as_py(), np.int64)
            starts = np.concatenate([[0], stops[:-1]])
            sums = [zlib.crc32(ids[start:stop].astype("<u4").tobytes()) for start, stop in zip(starts, stops, strict=True)]
            columns = [pa.array(doc_ids.as_py(), pa.int64()), pa.array(starts + first.as_py()), pa.array(stops - starts), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])


def documents(spark: SparkSession, path: str) -> DataFrame:
    """`(doc_id, start, n_tokens, ids_crc32)` of each document of a token file, from its decoded ids."""
    return mapped(segments(spark, path).select("first", "doc_ids", "ends", "codes"), _documents, "doc_id long, start long, n_tokens long, ids_crc32 long")
