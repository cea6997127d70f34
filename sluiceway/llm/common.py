"""Helpers shared by the corpus operators: words, batches, staging."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import sys
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluiceway.sources import storage

ROOT = str(Path(__file__).resolve().parents[2])
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
UTF8 = "UTF-8"
# Tasks in a row without use, after which a Python worker gives up what it keeps.
UNUSED_TASKS = 3


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package also where the caller found it only through sys.path."""
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known and ROOT in map(os.path.abspath, sys.path):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])


# Of each owner: the name of what is kept, the thing itself, and the tasks since it was asked for.
_kept: dict[str, list] = {}


def kept(owner: str, name: str, make: Callable[[], Any]) -> Any:
    """What `make` gives, built once in each Python worker. It is kept, one per owner, as long as tasks ask for it: a worker serves the stages of
    a pipeline one after another, and what an earlier one needed would add to the memory of the later ones."""
    if owner not in _kept or _kept[owner][0] != name:
        _kept.pop(owner, None)
        _kept[owner] = [name, make(), 0]
    _kept[owner][2] = 0
    return _kept[owner][1]


def _forget_unused() -> None:
    for entry in _kept.values():
        entry[2] += 1
    unused = [owner for owner, entry in _kept.items() if entry[2] > UNUSED_TASKS]
    for owner in unused:
        del _kept[owner]
    if unused:
        gc.collect()


@functools.cache
def _trim() -> Callable[[int], int]:
    """The C library's function that gives free memory back to the system; where there is none, one that does nothing."""
    return getattr(ctypes.CDLL(None) if sys.platform == "linux" else None, "malloc_trim", lambda _: 0)


def _task(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task of `function`. The worker stays for later tasks, so the memory it no longer needs goes back to the system."""
    _forget_unused()
    try:
        yield from function(batches)
    finally:
        pa.default_memory_pool().release_unused()
        _trim()(0)


def mapped(df: DataFrame, function, schema: StructType | str) -> DataFrame:
    """`mapInArrow` with a function of this package."""
    importable(df.sparkSession)
    return df.mapInArrow(functools.partial(_task, function), schema)


_paths: ContextVar[list[str] | None] = ContextVar("paths", default=None)


def staged(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared scratch folder and read from there: later steps do not depend on executors."""
    path = storage.scratch_dir(df.sparkSession, label)
    if (paths := _paths.get()) is not None:
        paths.append(path)
    return storage.staged(df, path)


@contextmanager
def intermediate(spark: SparkSession) -> Iterator:
    """What is staged within is deleted at the end; `keep`, which the block is given, stages what is to stay, for as long as
    a block around this one lasts."""
    paths: list[str] = []
    token = _paths.set(paths)

    def keep(df: DataFrame, label: str) -> DataFrame:
        inner = _paths.set(token.old_value if token.old_value is not token.MISSING else None)
        try:
            return staged(df, label)
        finally:
            _paths.reset(inner)

    try:
        yield keep
    finally:
        _paths.reset(token)
        for path in paths:
            storage.release(spark, path)


def words(text: bytes | None) -> list[bytes]:
    """Words of UTF-8 bytes: maximal runs without space, tab, newline, vertical tab, form feed, carriage return."""
    return text.split() if text else []


def hashes(parts: Iterable[bytes], seed: int = 0) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(part, seed) for part in parts], dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finalizer of SplitMix64)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    """The texts of a batch as UTF-8 bytes; a null is an empty text."""
    for value in batch.column(column).cast(pa.binary()):
        yield value.as_py() or b""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_text(df: DataFrame, column: str = "text") -> DataFrame:
    """The id and the text, whatever other columns there are."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("string").alias("text"))
