"""Declare columns non-null without an extra pass."""

from __future__ import annotations

import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from sluiceway.functions.structs import field_type, ident, replace_column, root


def _placeholder(data_type: DataType) -> Column:
    # A non-null value of the type. It is never emitted: raise_error comes before it.
    if isinstance(data_type, StructType):
        return F.struct(*[_placeholder(f.dataType).alias(f.name) for f in data_type.fields])
    if isinstance(data_type, DecimalType):
        return F.lit(Decimal((0, (0,), -data_type.scale)))
    if isinstance(data_type, NumericType):
        return F.lit(0).cast(data_type)
    if isinstance(data_type, StringType):
        return F.lit("")
    if isinstance(data_type, BinaryType):
        return F.lit(bytearray())
    if isinstance(data_type, BooleanType):
        return F.lit(False)
    if isinstance(data_type, DateType):
        return F.lit(datetime.date(1970, 1, 1))
    if isinstance(data_type, TimestampType):
        return F.timestamp_micros(F.lit(0))
    if isinstance(data_type, TimestampNTZType):
        return F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    raise ValueError(f"cannot declare a column of type {data_type.simpleString()} non-null")


def require_not_null(df: DataFrame, path: str) -> DataFrame:
    """Make `column` or `struct.column` non-null in the schema; a null row fails the job."""
    data_type = field_type(df, path)
    failure = F.raise_error(F.lit(f"null in non-null column {path}")).cast(data_type)
    if path in df.columns:
        checked = F.coalesce(root(path), F.coalesce(failure, _placeholder(data_type)))
        return replace_column(df, path, checked.alias(path, metadata=df.schema[path].metadata))
    parent, _, child = path.partition(".")
    checked = F.coalesce(root(parent).getField(child), F.coalesce(failure, _placeholder(data_type)))
    rebuilt = root(parent).withField(ident(child), checked)
    return replace_column(df, parent, rebuilt.alias(parent, metadata=df.schema[parent].metadata))
