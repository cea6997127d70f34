"""Digest expressions over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

from sluiceway.functions.json_text import JSON_WRITE_OPTIONS

# Accepted algorithm names.
ALGORITHMS = ("md5", "sha1", "sha2", "crc32", "murmur3")


def check_algorithm(algo: str) -> str:
    lowered = algo.lower()
    if lowered not in ALGORITHMS:
        raise ValueError(f"digest algorithm {algo!r} is not supported, use one of {ALGORITHMS}")
    return lowered


def _hashable(column: Column, data_type: DataType) -> Column:
    if isinstance(data_type, (StringType, BinaryType)):
        return column
    if isinstance(data_type, (StructType, ArrayType, MapType)):
        return F.to_json(column, JSON_WRITE_OPTIONS)
    return column.cast("string")


def digest(column: Column, data_type: DataType, algo: str = "md5") -> Column:
    """Digest of a column: hex text for md5, sha1 and sha2 (512 bits), bigint for crc32, int for murmur3.

    The byte digests take text or bytes; other types are hashed by their text (JSON for
    nested types). murmur3 hashes the typed value. A null stays null, except that
    murmur3 gives its seed, 42.
    """
    algo = check_algorithm(algo)
    if algo == "murmur3":
        return F.hash(column)
    text = _hashable(column, data_type)
    if algo == "md5":
        return F.md5(text)
    if algo == "sha1":
        return F.sha1(text)
    if algo == "sha2":
        return F.sha2(text, 512)
    return F.crc32(text)
