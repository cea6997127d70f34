"""File tables that can be updated by key. One writer per table.

A table whose partition columns belong to the key is updated in place: only partitions
that have changes are read, their new files are written aside, and a journal replaces the
old directories by the new ones, all or nothing.

A table laid out in hash buckets of its key is updated by bucket, see `sluiceway.sources.buckets`.

Any other table is rewritten as a new version next to the old one. `<path>/v=00000003` is
a complete table; Spark's own commit marker (_SUCCESS) makes it count, so a job that dies
half-way leaves the version before it in effect. A path without versions is a plain
dataset, version 0.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.structs import root, struct_type
from sluiceway.operators.counts import RowCounts
from sluiceway.operators.snapshot import latest_changes
from sluiceway.operators.update import apply_latest, same_key
from sluiceway.sources import buckets as bucketed
from sluiceway.sources import journal, storage
from sluiceway.sources.formats import OVERWRITE, PARQUET, FileFormat

# How long a replaced version stays for readers that have begun, in seconds.
KEPT_SECONDS = 24 * 3600
# Spark's file sources: they commit by marker and overwrite single partitions.
UPDATABLE = {"parquet", "orc", "json", "csv", "avro"}


def _directory(path: str, version: int) -> str:
    return f"{path}/v={version:08d}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first."""
    numbers = sorted(int(n[2:]) for n in storage.children(spark, path, "v=*") if n[2:].isdigit())
    return [v for v in numbers if storage.exists(spark, f"{_directory(path, v)}/_SUCCESS")]


def current_path(spark: SparkSession, path: str) -> str:
    """Where the current rows of a table are: its newest version, or the path itself."""
    path = path.rstrip("/")
    known = versions(spark, path)
    return _directory(path, known[-1]) if known else path


def is_bucketed(spark: SparkSession, path: str) -> bool:
    return bool(bucketed.numbers(spark, path))


def buckets_of(spark: SparkSession, path: str) -> int:
    """The number of buckets a table has, or is to have if it gets some."""
    state = bucketed.manifest(spark, path)
    return state.buckets if state else bucketed.DEFAULT_BUCKETS


def is_updated(spark: SparkSession, path: str) -> bool:
    """Whether the current rows are in versions or buckets, not in the directory itself."""
    return bool(versions(spark, path)) or is_bucketed(spark, path)


def read_table(
    spark: SparkSession,
    path: str,
    fmt: FileFormat = PARQUET,
    schema=None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    path = path.rstrip("/")
    state = bucketed.manifest(spark, path)
    if state is not None:
        rows = bucketed.read(spark, path, fmt, state, options)
        return rows if schema is None else fmt.typed(rows, schema)
    waiting = [j for j in journal.pending(spark, path) if j.replaced or j.removed]
    if waiting:
        return _as_if_carried_out(spark, path, fmt, schema, options, waiting[0])
    return fmt.read(spark, current_path(spark, path), schema, options)


def _as_if_carried_out(
    spark: SparkSession, path: str, fmt: FileFormat, schema, options: Mapping[str, str] | None, change: journal.Journal
) -> DataFrame:
    """Rows of a table whose last update counts but died before all directories were in place."""
    depth = max(name.count("/") for name in [*change.replaced, *change.removed]) + 1
    there = storage.matches(spark, path, "/".join(["*=*"] * depth))
    data = journal.staging(path, change.name)
    new = [name for name in change.replaced if storage.exists(spark, f"{data}/{name}")]
    old = [name for name in there if name not in change.removed and name not in new]
    parts = []
    for base, names in ((path, old), (data, new)):
        if names:
            parts.append(fmt.read(spark, [f"{base}/{name}" for name in names], schema, {**(options or {}), "basePath": base}))
    if not parts:
        return fmt.read(spark, path, schema, options)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows arranged for even files per partition value; Spark splits values that hold much of the data."""
    return df.hint("rebalance", *partition_by)


def update_table(
    changes: DataFrame,
    path: str,
    fmt: FileFormat = PARQUET,
    partition_by: Sequence[str] = (),
    order_by: str | Sequence[str] | None = None,
    schema=None,
    options: Mapping[str, str] | None = None,
    rebalance: bool = False,
    buckets: int | None = None,
) -> int:
    """Apply a change log to the table at `path`; returns the number of rows written.

    `buckets` lays the table out in that many hash buckets of the key, if it is not yet. The last change per key is written to scratch first: it is used more than once, and its
    size is then known to Spark, which broadcasts it if it is below the session's threshold
    and joins by shuffle if not. Applying the same changes again gives the same table, so a
    retried micro-batch does no harm.
    """
    if fmt.name not in UPDATABLE:
        raise ValueError(f"a table in format {fmt.name!r} cannot be updated, only {sorted(UPDATABLE)}")
    spark = changes.sparkSession
    path = path.rstrip("/")
    staged = storage.scratch_dir(spark, "latest-changes")
    try:
        latest = storage.staged(latest_changes(changes, order_by), staged)
        inner = struct_type(latest, "key")
        if inner is None:
            raise ValueError("an update needs changes with a decoded 'key' struct")
        known = versions(spark, path)
        if partition_by and not known and set(partition_by) <= set(inner.names):
            return _update_partitions(latest, path, fmt, list(partition_by), schema, options, rebalance)
        if buckets or bucketed.numbers(spark, path):
            existing = None
            if bucketed.manifest(spark, path) is None and _has_data(spark, path):
                existing = _existing(latest, path, fmt, _target_schema(latest, path, fmt, schema, options), options)
            rows = bucketed.update(latest, storage.size(spark, staged), path, fmt, buckets, existing, options)
            expire_versions(spark, path)
            return rows
        return _update_version(latest, path, fmt, partition_by, known, schema, options, rebalance)
    finally:
        storage.release(spark, staged)


def _has_data(spark: SparkSession, path: str) -> bool:
    return any(not name.startswith((".", "_")) for name in storage.children(spark, path))


def _target_schema(latest: DataFrame, path: str, fmt: FileFormat, schema, options: Mapping[str, str] | None):
    """The schema to read a target with: formats that would guess types from text get those of the changes."""
    if schema is not None or not fmt.infer:
        return schema
    schema = latest.schema["value"].dataType
    _check_stored_columns(latest.sparkSession, current_path(latest.sparkSession, path), fmt, schema.names, options)
    return schema


def _existing(
    latest: DataFrame, path: str, fmt: FileFormat, schema=None, options: Mapping[str, str] | None = None
) -> DataFrame:
    spark = latest.sparkSession
    if storage.exists(spark, path):
        return read_table(spark, path, fmt, schema, options)
    return spark.createDataFrame([], latest.schema["value"].dataType)


def _update_version(
    latest: DataFrame,
    path: str,
    fmt: FileFormat,
    partition_by: Sequence[str],
    known: Sequence[int],
    schema,
    options: Mapping[str, str] | None,
    rebalance: bool,
) -> int:
    counts = RowCounts()
    schema = _target_schema(latest, path, fmt, schema, options)
    result = apply_latest(_existing(latest, path, fmt, schema, options), latest)
    result = counts.register(balanced(result, partition_by) if rebalance else result)
    new = (known[-1] if known else 0) + 1
    fmt.write(result, _directory(path, new), OVERWRITE, partition_by, options)
    expire_versions(latest.sparkSession, path)
    return counts.value()


def expire_versions(spark: SparkSession, path: str, kept_seconds: float = KEPT_SECONDS) -> list[int]:
    """Delete versions that were replaced longer ago than `kept_seconds`; returns their numbers.

    A reader that began before the replacement can so go on for that time. A version is replaced when the next one
    is committed. Version 0 is the plain dataset at the path. Of a table in buckets these are the updates whose
    replaced buckets go.
    """
    path = path.rstrip("/")
    if bucketed.numbers(spark, path):
        return bucketed.expire(spark, path, kept_seconds, lambda: _delete_versions(spark, path, None))
    known = versions(spark, path)
    if not known:
        return []
    limit = time.time() - kept_seconds
    replaced_by = dict(zip([0, *known], known, strict=False))
    old = [v for v, next_one in replaced_by.items() if storage.modified(spark, f"{_directory(path, next_one)}/_SUCCESS") < limit]
    _delete_versions(spark, path, old)
    return old


def _delete_versions(spark: SparkSession, path: str, old: Sequence[int] | None) -> None:
    """Delete these versions, or all of them, 0 among them."""
    for name in storage.children(spark, path):
        if name.startswith("v=") and name[2:].isdigit():
            number = int(name[2:])
        elif name.startswith("part-") or "=" in name or name == "_SUCCESS":
            number = 0
        else:
            # Not Spark's: none of our business.
            continue
        if old is None or number in old:
            storage.delete(spark, f"{path}/{name}")


def _in_changed_partitions(target: DataFrame, latest: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of partitions that have changes: by tuples of partition values, however many there are."""
    values = latest.select(*[F.col("key").getField(name).alias(name) for name in partition_by]).distinct()
    # Spark prunes the partitions of a scan by a join if the other side has a filter; this one holds for all rows.
    values = values.where(F.xxhash64(*partition_by) >= F.lit(-(2**63)))
    return target.alias("t").join(values.alias("p"), same_key("t", "p", partition_by), "left_semi")


def _changed_directories(target: DataFrame, latest: DataFrame, path: str, partition_by: Sequence[str]) -> set[str]:
    """Directories below `path` of the partitions that have changes, as far as they are there. No column of the files is read."""
    spark = latest.sparkSession
    stored = target.select(*[root(c) for c in partition_by], F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("_directory"))
    found = _in_changed_partitions(stored, latest, partition_by).select("_directory").distinct()
    base = len(storage.qualified(spark, path)) + 1
    return {storage.qualified(spark, storage.decoded(spark, row["_directory"]))[base:] for row in found.toLocalIterator()}


def _check_stored_columns(
    spark: SparkSession, path: str, fmt: FileFormat, names: Sequence[str], options: Mapping[str, str] | None
) -> None:
    """Raise if the stored rows have a column the changes lack: rewriting would lose it."""
    if not storage.exists(spark, path):
        return
    try:
        stored = fmt.read(spark, path, None, {**(options or {}), "inferSchema": "false"}).columns
    except AnalysisException:
        # No file is left to tell.
        return
    lost = [n for n in stored if n not in names]
    if lost:
        raise ValueError(f"changes and target differ in columns {lost}")


def _update_partitions(
    latest: DataFrame,
    path: str,
    fmt: FileFormat,
    partition_by: list[str],
    schema,
    options: Mapping[str, str] | None,
    rebalance: bool,
) -> int:
    spark = latest.sparkSession
    if schema is None:
        # The types come from the changes: those of partition columns are not stored.
        schema = latest.schema["value"].dataType
        _check_stored_columns(spark, path, fmt, schema.names, options)
    journal.recover(spark, path)
    target = _existing(latest, path, fmt, schema, options)
    before = _changed_directories(target, latest, path, partition_by) if storage.exists(spark, path) else set()
    touched = _in_changed_partitions(target, latest, partition_by)
    counts = RowCounts()
    result = apply_latest(touched, latest)
    result = counts.register(balanced(result, partition_by) if rebalance else result)
    name = f"update-{uuid.uuid4().hex}"
    data = journal.staging(path, name)
    fmt.write(result, data, OVERWRITE, partition_by, options)
    rows = counts.value()
    new = storage.matches(spark, data, "/".join(["*=*"] * len(partition_by)))
    change = journal.Journal(name, replaced=new, removed=sorted(before - set(new)))
    journal.commit(spark, path, change)
    journal.carry_out(spark, path, change)
    return rows


def append_files(
    df: DataFrame, path: str, fmt: FileFormat, partition_by: Sequence[str], options: Mapping[str, str] | None, tag: str | None
) -> int:
    """Append rows to a directory of files unless the change `tag` was made before; returns the number of rows written.

    The files are written aside and moved in by a journal, so that a micro-batch that is tried again has its rows there once.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    journal.recover(spark, path)
    if tag is not None and journal.is_done(spark, path, tag):
        return 0
    fmt.check_append(spark, path)
    name = f"append-{uuid.uuid4().hex}"
    data = journal.staging(path, name)
    counts = RowCounts()
    fmt.write(counts.register(df), data, OVERWRITE, partition_by, options)
    change = journal.Journal(name, added=storage.files(spark, data), tag=tag)
    journal.commit(spark, path, change)
    journal.carry_out(spark, path, change)
    return counts.value()
