"""Applying a change set to a table: insert, replace, delete by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.structs import ident, root, struct_type
from sluiceway.operators.snapshot import latest_changes


def key_fields(changes: DataFrame, target: DataFrame) -> list[str]:
    """Fields of the change key; all must be columns of the target."""
    inner = struct_type(changes, "key")
    if inner is None:
        raise ValueError("an update needs changes with a decoded 'key' struct")
    missing = [n for n in inner.names if n not in target.columns]
    if missing:
        raise ValueError(f"key columns {missing} are not in the target table")
    return list(inner.names)


def same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    """Join condition on key columns of two aliased tables; null keys are keys too."""
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.{ident(k)}").eqNullSafe(F.col(f"{right}.{ident(k)}")) for k in keys],
    )


def apply_latest(target: DataFrame, latest: DataFrame) -> DataFrame:
    """`target` with one change per key applied; a null value deletes.

    Rows without a change stay (anti join), upserts are added by a union, so the target is
    shuffled at most once, and not at all when the change set is small enough for Spark to
    broadcast its keys.
    """
    keys = key_fields(latest, target)
    changed = latest.select(*[F.col("key").getField(k).alias(k) for k in keys])
    kept = target.alias("t").join(changed.alias("c"), same_key("t", "c", keys), "left_anti")
    return kept.unionByName(checked_upserts(latest, target)).select(*[root(c) for c in target.columns])


def checked_upserts(latest: DataFrame, target: DataFrame) -> DataFrame:
    """The values of `latest` as rows of the target. A value whose key columns are not those of its key is an error: it would
    be stored beside the row it is meant to replace."""
    keys = key_fields(latest, target)
    names = latest.schema["value"].dataType.names
    different = set(names) ^ set(target.columns)
    if different:
        raise ValueError(f"changes and target differ in columns {sorted(different)}")
    value = lambda n: F.col("value").getField(n)
    agree = reduce(lambda a, b: a & b, [F.col("key").getField(k).eqNullSafe(value(k)) for k in keys])
    wrong = F.raise_error(F.concat(F.lit("key and value of a change disagree: key "), F.to_json("key")))
    columns = [F.when(agree, value(n)).otherwise(wrong).alias(n) if n == keys[0] else value(n).alias(n) for n in names]
    return latest.where(F.col("value").isNotNull()).select(*columns)


def apply_changes(
    target: DataFrame, changes: DataFrame, order_by: str | Sequence[str] | None = None
) -> DataFrame:
    """`target` with a change log applied: the last change per key counts."""
    return apply_latest(target, latest_changes(changes, order_by))
