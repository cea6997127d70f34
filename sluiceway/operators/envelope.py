"""The change-log envelope: wrapping tables into key and value structs, and back."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from sluiceway.functions.structs import matching, root, struct_type
from sluiceway.operators.lineage import field_stamps

# The columns of a topic, as Spark's Kafka source gives them.
ENVELOPE = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("timestampType", IntegerType()),
    ]
)


def wrap(df: DataFrame, key_columns: Iterable[str] = ()) -> DataFrame:
    """All columns as struct `value`, and `key_columns` as struct `key` if there are any.

    One projection, so a source column that is itself called `key` or `value` is safe.
    """
    keys = list(key_columns)
    missing = set(keys) - set(matching(keys, df.columns, "wrap"))
    if missing:
        raise ValueError(f"key columns {sorted(missing)} are not in the data")
    value = F.struct(*[root(c) for c in df.columns]).alias("value")
    if not keys:
        return df.select(value)
    return df.select(F.struct(*[root(c) for c in keys]).alias("key"), value)


def unwrap(df: DataFrame, drop_tombstones: bool = False) -> DataFrame:
    """Fields of `value` as root columns.

    A delete marker becomes a row of nulls unless `drop_tombstones` is set.
    """
    inner = struct_type(df, "value")
    if inner is None:
        raise ValueError("the data has no struct column 'value'")
    if drop_tombstones:
        df = df.filter(F.col("value").isNotNull())
    stamps = field_stamps(df, "value")
    columns = []
    for f in inner.fields:
        column = F.col("value").getField(f.name)
        metadata = {**f.metadata, **stamps.get(f.name, {})}
        columns.append(column.alias(f.name, metadata=metadata) if metadata else column.alias(f.name))
    return df.select(*columns)


def change_pair(df: DataFrame) -> DataFrame:
    """Key and value alone."""
    missing = {"key", "value"} - set(df.columns)
    if missing:
        raise ValueError(f"change data needs the columns key and value, {sorted(missing)} missing")
    return df.select("key", "value")
