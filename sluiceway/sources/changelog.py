"""Change logs in files: rows in the columns of a topic, for data that comes without a broker.

A log is a directory of Parquet files in the envelope's columns, so any tool can write one. Rows keep the offsets they
bring; rows without get dense ones per partition, behind those that are stored. What is appended comes in by a journal:
a batch that is tried again has its rows there once. One writer per log.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.operators.envelope import ENVELOPE
from sluiceway.operators.numbering import numbered
from sluiceway.sources import journal, storage, tables
from sluiceway.sources.formats import PARQUET

DEFAULT_PARTITIONS = 8
CREATE_TIME = 0
SETTINGS = "_log.json"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a log as the seven envelope columns; those a file lacks are null."""
    if not storage.exists(spark, path):
        raise ValueError(f"there is no change log at {path}")
    return PARQUET.read(spark, path, ENVELOPE).select(*ENVELOPE.names)


def stream_log(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream over a log from its first row. Without `max_files` a micro-batch takes all files that are there, so the
    order of offsets holds across micro-batches."""
    storage.make_directory(spark, path)
    options = {"maxFilesPerTrigger": str(max_files or 2**31 - 1)}
    return PARQUET.read_stream(spark, path, ENVELOPE, options).select(*ENVELOPE.names)


def _partitions(spark: SparkSession, path: str, wanted: int | None) -> int:
    """The number of partitions of a log, fixed by its first append."""
    file = f"{path}/{SETTINGS}"
    if storage.exists(spark, file):
        known = json.loads(storage.read_text(spark, file))["partitions"]
        if wanted is not None and wanted != known:
            raise ValueError(f"the log has {known} partitions, not {wanted}")
        return known
    storage.make_directory(spark, path)
    storage.publish_text(spark, file, json.dumps({"partitions": wanted or DEFAULT_PARTITIONS}))
    return wanted or DEFAULT_PARTITIONS


def _partition_of(df: DataFrame, partitions: int):
    if "partition" in df.columns:
        return F.col("partition").cast("int")
    by_value = F.pmod(F.xxhash64("value"), F.lit(partitions))
    if "key" not in df.columns:
        return by_value.cast("int")
    return F.when(F.col("key").isNotNull(), F.pmod(F.hash("key"), F.lit(partitions))).otherwise(by_value).cast("int")



def append_log(
    df: DataFrame,
    path: str,
    partitions: int | None = None,
    order_by: str | Sequence[str] | None = None,
    tag: str | None = None,
    number: bool | None = None,
) -> int:
    """Append serialized `key` (optional) and `value` rows; returns their number.

    Rows go to the partition in column `partition`, else by the hash of the key, and keep their `offset`. Without that
    column, or with `number`, offsets are dense per partition, along `order_by` where given, else in the order of the input.
    An append whose `tag` was made before adds nothing, which makes a micro-batch safe that is tried again.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    # What an append that died left behind belongs to the log before it is looked at.
    journal.recover(spark, path)
    if tag is not None and journal.is_done(spark, path, tag):
        return 0
    partitions = _partitions(spark, path, partitions)
    order = [order_by] if isinstance(order_by, str) else list(order_by or [])
    key = F.col("key") if "key" in df.columns else F.lit(None)
    rows = df.withColumn("partition", _partition_of(df, partitions))
    rows = rows.withColumns({"key": key.cast("binary"), "value": F.col("value").cast("binary"), "timestamp": F.current_timestamp()})
    scratch: list[str] = []

    def stage(part: DataFrame, label: str) -> DataFrame:
        scratch.append(storage.scratch_dir(spark, label))
        return storage.staged(part, scratch[-1])

    try:
        if number or (number is None and "offset" not in df.columns):
            ends = None
            if storage.files(spark, path):
                ends = read_log(spark, path).groupBy("partition").agg((F.max("offset") + 1).alias("start"))
            names = list(dict.fromkeys(["key", "value", "partition", "timestamp", *order]))
            rows = numbered(rows.select(*names), "partition", stage, order, "_offset", ends)
            rows = rows.withColumn("offset", F.col("_offset"))
        final = rows.select(
            "key",
            "value",
            F.lit(path.rsplit("/", 1)[1]).alias("topic"),
            "partition",
            F.col("offset").cast("long").alias("offset"),
            "timestamp",
            F.lit(CREATE_TIME).alias("timestampType"),
        )
        return tables.append_files(final, path, PARQUET, (), None, tag)
    finally:
        for place in scratch:
            storage.release(spark, place)
