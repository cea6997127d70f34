"""Snapshots: the last value per key of a change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.structs import root
from sluiceway.operators.envelope import unwrap

# Offsets order one partition only; this decides equal offsets the same way every time.
TIE_BREAKER = "partition"


def change_order(df: DataFrame, order_by: str | Sequence[str] | None = None) -> Column:
    """What makes one change later than another: `order_by`, or the offset."""
    if order_by is not None:
        names = [order_by] if isinstance(order_by, str) else list(order_by)
        return F.struct(*[root(n) for n in names]) if len(names) > 1 else root(names[0])
    if "offset" not in df.columns:
        raise ValueError("change data needs an 'offset' column, or order_by")
    offset = F.coalesce(F.col("offset"), F.raise_error(F.lit("change without an offset")).cast("bigint"))
    negative = F.raise_error(F.concat(F.lit("change with the negative offset "), F.col("offset").cast("string"))).cast("bigint")
    offset = F.when(F.col("offset") < 0, negative).otherwise(offset)
    return F.struct(offset.alias("offset"), TIE_BREAKER) if TIE_BREAKER in df.columns else offset


def latest_changes(df: DataFrame, order_by: str | Sequence[str] | None = None) -> DataFrame:
    """(key, value) of the last change per key, delete markers included.

    max_by aggregates before the shuffle: each task sends one row per key, so a key that
    holds much of the log costs no more than any other. Spark sorts by the key to do so;
    with a hash in front, most comparisons are of one number instead of whole keys.
    """
    metadata = df.schema["value"].metadata
    last = F.max_by(F.col("value"), change_order(df, order_by)).alias("value", metadata=metadata)
    grouped = df.groupBy(F.xxhash64("key").alias("_hash"), F.col("key"))
    return grouped.agg(last).select("key", "value")


def snapshot(df: DataFrame, order_by: str | Sequence[str] | None = None) -> DataFrame:
    """Rows of the table a change log describes: last values, deleted keys left out.

    Null keys form one group, as in any SQL grouping.
    """
    return unwrap(latest_changes(df, order_by), drop_tombstones=True)


def snapshot_binary(df: DataFrame, order_by: str | Sequence[str] | None = None) -> DataFrame:
    """As `snapshot` for values that are not decoded: one column, `value`."""
    return latest_changes(df, order_by).filter(F.col("value").isNotNull()).select("value")
