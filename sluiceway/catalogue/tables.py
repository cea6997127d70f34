"""The given tables, and the change log made from them."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.operators.codec import encode_json
from sluiceway.sources import storage
from sluiceway.sources.changelog import append_log

KEY_SCHEMA = "user_id bigint"
VALUE_SCHEMA = "user_id bigint, event_type string, value double"
TOPIC_PARTITIONS = 4

# The rows of the change log's last state, for the oracles.
SNAPSHOT_SQL = """
    SELECT user_id, event_type, value
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS latest FROM events)
    WHERE latest = 1 AND event_type <> 'error'
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as changes per user; an error event deletes the user."""
    value = F.struct("user_id", "event_type", "value")
    return table(spark, sf_dir, "events").select(
        F.struct("user_id").alias("key"),
        F.when(F.col("event_type") != "error", value).alias("value"),
        F.col("event_id").alias("offset"),
    )


def topic_of_changes(spark: SparkSession, sf_dir: str) -> str:
    """The change log in files in scratch space, with the offsets it has; returns its path."""
    path = storage.scratch_dir(spark, "topic")
    append_log(encode_json(change_log(spark, sf_dir), keep=["offset"]), path, TOPIC_PARTITIONS)
    return path


def directory_of(spark: SparkSession, sf_dir: str, name: str) -> dict[str, Any]:
    """Store settings that stream over a table, be it one file or a directory of files."""
    path = f"{sf_dir}/{name}.parquet"
    if storage.is_directory(spark, path):
        return {"path": path, "dataFormat": "parquet"}
    return {"path": sf_dir, "dataFormat": "parquet", "options": {"pathGlobFilter": f"{name}.parquet"}}


def drain(spark: SparkSession, flow: dict[str, Any], checkpoint: str | None = None) -> None:
    """Run a stream flow over all data present, from the start or from where a checkpoint is."""
    from sluiceway import run

    checkpoint = checkpoint or storage.scratch_dir(spark, "checkpoint")
    run(spark, {**flow, "flowType": "stream", "triggerInterval": "once", "checkpointLocation": checkpoint}).awaitTermination()
