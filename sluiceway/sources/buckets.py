"""Tables laid out in hash buckets of their key, so that an update reads and writes only the buckets that have changes.

`<path>/_buckets/<number>/key_bucket=<b>` holds the rows that update `number` wrote of bucket `b`. A manifest per update,
`manifest-<number>.json`, says which update each bucket's rows are in: an update writes new files beside the old ones and
then its manifest, which is the one switch. Readers open the newest manifest; those that began before go on with the
files they know, which stay until `expire`. One writer per table.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluiceway.functions.structs import root, struct_type
from sluiceway.operators.counts import RowCounts
from sluiceway.operators.update import checked_upserts, same_key
from sluiceway.sources import storage
from sluiceway.sources.formats import OVERWRITE, FileFormat

FOLDER = "_buckets"
BUCKET = "key_bucket"
DEFAULT_BUCKETS = 16
# Files a bucket may have before an update brings its rows together.
MANY_FILES = 4


@dataclass(frozen=True)
class Manifest:
    """State of a table after update `number`: `places` has the update that holds the rows of each bucket with rows;
    `replaced` are the directories this update took out of use; 0 stands for the files that were there before."""

    number: int
    buckets: int
    keys: Sequence[str]
    schema: str
    places: Mapping[str, int]
    replaced: Sequence[str] = field(default=())

    @property
    def type(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


def _file(path: str, number: int) -> str:
    return f"{path}/{FOLDER}/manifest-{number:08d}.json"


def _directory(path: str, number: int) -> str:
    return f"{path}/{FOLDER}/{number:08d}"


def numbers(spark: SparkSession, path: str) -> list[int]:
    """Updates whose manifests are still there, oldest first."""
    names = storage.children(spark, f"{path.rstrip('/')}/{FOLDER}", "manifest-*.json")
    return sorted(int(name[9:-5]) for name in names)


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The current state of a table; None if it is not laid out in buckets."""
    known = numbers(spark, path)
    return Manifest(**json.loads(storage.read_text(spark, _file(path.rstrip("/"), known[-1])))) if known else None


def bucket_of(columns: Sequence[Column], buckets: int) -> Column:
    return F.pmod(F.hash(*columns), F.lit(buckets))


def _places(path: str, state: Manifest, wanted: Sequence[str] | None = None) -> list[str]:
    places = state.places if wanted is None else {b: state.places[b] for b in wanted if b in state.places}
    return [f"{_directory(path, number)}/{BUCKET}={b}" for b, number in sorted(places.items())]


def read(spark: SparkSession, path: str, fmt: FileFormat, state: Manifest, options: Mapping[str, str] | None = None, wanted: Sequence[str] | None = None) -> DataFrame:
    """All rows, or those of some buckets. The directories are read one by one, so none of their names becomes a column."""
    directories = _places(path.rstrip("/"), state, wanted)
    if not directories:
        return spark.createDataFrame([], state.type)
    return fmt.read(spark, directories, state.type, options)


def _typed_keys(latest: DataFrame, target: StructType, keys: Sequence[str]) -> list[Column]:
    """The fields of the key as the table has them: hashes of other types are others."""
    return [F.col("key").getField(k).cast(target[k].dataType).alias(k) for k in keys]


def update(
    latest: DataFrame,
    latest_bytes: int,
    path: str,
    fmt: FileFormat,
    buckets: int | None,
    existing: DataFrame | None,
    options: Mapping[str, str] | None = None,
) -> int:
    """Apply one change per key to a table in buckets; returns the number of rows written.

    `existing` has the rows of a table that has no buckets yet, or None if there is none; these, and a table that is to have
    another number of buckets, are written anew as a whole. Below the broadcast threshold the changes go to the table's
    rows, which are then neither shuffled for the join nor for writing, unless a bucket has come to have many small files;
    above it both sides are shuffled once, by bucket, which serves the join and the files alike.
    """
    spark = latest.sparkSession
    state = manifest(spark, path)
    keys = list(struct_type(latest, "key").names)
    if state is not None:
        if list(state.keys) != keys:
            raise ValueError(f"the table is laid out by {list(state.keys)}, the changes have the key {keys}")
        schema = state.type
    else:
        schema = latest.schema["value"].dataType if existing is None else existing.schema
    n = buckets or (state.buckets if state else DEFAULT_BUCKETS)
    if BUCKET in schema.names:
        raise ValueError(f"a table in buckets cannot have a column {BUCKET!r}")

    whole = state is None or state.buckets != n
    latest = latest.withColumn(BUCKET, bucket_of(_typed_keys(latest, schema, key_fields_of(schema, keys)), n))
    if whole:
        touched = None
        target = existing if state is None else read(spark, path, fmt, state, options)
    else:
        touched = sorted(str(row[0]) for row in latest.select(BUCKET).distinct().collect())
        target = read(spark, path, fmt, state, options, touched)
    if target is None:
        target = spark.createDataFrame([], schema)

    upserts = checked_upserts(latest, target).withColumn(BUCKET, bucket_of([root(k) for k in keys], n))
    rows = target.withColumn(BUCKET, bucket_of([root(k) for k in keys], n))
    changed = latest.select(BUCKET, *_typed_keys(latest, schema, keys))
    if latest_bytes <= broadcast_threshold(spark):
        kept = rows.alias("t").join(F.broadcast(changed).alias("c"), same_key("t", "c", keys), "left_anti")
        result = kept.unionByName(upserts.repartition(BUCKET))
        if whole or _many_files(spark, path, state, touched):
            result = result.hint("rebalance", BUCKET)
    else:
        kept = rows.repartition(BUCKET).alias("t").join(changed.repartition(BUCKET).alias("c"), same_key("t", "c", [BUCKET, *keys]), "left_anti")
        result = kept.unionByName(upserts.repartition(BUCKET))

    known = numbers(spark, path)
    number = (known[-1] if known else 0) + 1
    counts = RowCounts()
    directory = _directory(path, number)
    fmt.write(counts.register(result), directory, OVERWRITE, [BUCKET], options)
    written = {name.partition("=")[2]: number for name in storage.children(spark, directory, f"{BUCKET}=*")}
    before = dict(state.places) if state else {}
    gone = before if touched is None else {b: before[b] for b in touched if b in before}
    replaced = [f"{FOLDER}/{v:08d}/{BUCKET}={b}" for b, v in gone.items()]
    if state is None and existing is not None:
        replaced.append(".")
    after = Manifest(number, n, keys, schema.json(), {**{b: v for b, v in before.items() if b not in gone}, **written}, replaced)
    storage.publish_text(spark, _file(path, number), json.dumps(asdict(after)))
    return counts.value()


def key_fields_of(schema: StructType, keys: Sequence[str]) -> list[str]:
    missing = [k for k in keys if k not in schema.names]
    if missing:
        raise ValueError(f"key columns {missing} are not in the target table")
    return list(keys)


def broadcast_threshold(spark: SparkSession) -> int:
    """Bytes up to which Spark broadcasts one side of a join."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)) if not text.startswith("-") else -1


def _many_files(spark: SparkSession, path: str, state: Manifest, touched: Sequence[str]) -> bool:
    directories = _places(path, state, touched)
    return sum(len(storage.files(spark, d)) for d in directories) > MANY_FILES * len(directories)


def expire(spark: SparkSession, path: str, kept_seconds: float, plain) -> list[int]:
    """Delete what was replaced longer ago than `kept_seconds`; returns the updates whose replacements are gone.
    `plain` deletes the files that were there before the first update."""
    path, limit, done = path.rstrip("/"), time.time() - kept_seconds, []
    known = numbers(spark, path)
    for number in known:
        file = _file(path, number)
        if storage.modified(spark, file) >= limit:
            break
        for name in Manifest(**json.loads(storage.read_text(spark, file))).replaced:
            if name == ".":
                plain()
            else:
                storage.delete(spark, f"{path}/{name}")
        # The newest one stays, as it is the table.
        if number != known[-1]:
            storage.delete(spark, file)
        done.append(number)
    return done

