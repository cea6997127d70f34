"""The 5-byte frame (magic byte 0, big-endian schema id) before a registered payload."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FRAME_LENGTH = 5
NO_SCHEMA = -1


def schema_id(column: Column) -> Column:
    """Schema id of a framed binary; -1 without a valid frame, null for null."""
    framed = (F.length(column) >= FRAME_LENGTH) & (F.hex(F.substring(column, 1, 1)) == "00")
    unsigned = F.conv(F.hex(F.substring(column, 2, 4)), 16, 10).cast("bigint")
    signed = F.when(unsigned >= 2**31, unsigned - 2**32).otherwise(unsigned).cast("int")
    return F.when(column.isNull(), None).when(framed, signed).otherwise(NO_SCHEMA)


def payload(column: Column) -> Column:
    """Bytes after the frame, or the whole column where there is no frame."""
    rest = F.substring(column, FRAME_LENGTH + 1, 2**31 - 1)
    return F.when(schema_id(column) != NO_SCHEMA, rest).otherwise(column)


def frame(column: Column, identifier: int) -> Column:
    """Put the frame before a binary; null stays null, so delete markers survive."""
    head = F.unhex(F.lit("00" + format(identifier & 0xFFFFFFFF, "08X")))
    return F.concat(head, column)
