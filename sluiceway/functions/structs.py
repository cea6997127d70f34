"""Schema lookups and null-preserving rewrites of one-level structs."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

log = logging.getLogger(__name__)


def ident(name: str) -> str:
    """Quote a column name, so that dots and spaces in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def root(name: str) -> Column:
    return F.col(ident(name))


def struct_type(df: DataFrame, name: str) -> StructType | None:
    """Type of struct column `name`, or None if it is absent or not a struct."""
    if name not in df.columns:
        return None
    data_type = df.schema[name].dataType
    return data_type if isinstance(data_type, StructType) else None


def field(df: DataFrame, path: str) -> StructField:
    """Field at `column` or `struct.column`."""
    if path in df.columns:
        return df.schema[path]
    parent, _, child = path.partition(".")
    inner = struct_type(df, parent)
    if inner is None or child not in inner.names:
        raise KeyError(f"no column {path!r}")
    return inner[child]


def field_type(df: DataFrame, path: str) -> DataType:
    return field(df, path).dataType


def column_names(df: DataFrame, struct: str | None = None) -> list[str]:
    """Names at the root, or inside `struct`, in source order."""
    if struct is None:
        return list(df.columns)
    inner = struct_type(df, struct)
    return [] if inner is None else list(inner.names)


def matching(requested: Iterable[str], present: Iterable[str], step: str) -> list[str]:
    """Requested names that are present, by exact case.

    A name that differs from a present one by case alone raises: Spark would resolve
    it, so skipping it would leave a column readable that was meant to be hidden.
    """
    present = list(present)
    folded = {p.lower(): p for p in present}
    found = []
    for name in dict.fromkeys(requested):
        if name in present:
            found.append(name)
        elif name.lower() in folded:
            raise ValueError(f"{step}: column {name!r} differs only by case from {folded[name.lower()]!r}")
    return found


def report_missing(requested: Iterable[str], found: Iterable[str], step: str, strict: bool) -> None:
    found = set(found)
    missing = [name for name in dict.fromkeys(requested) if name not in found]
    if missing and strict:
        raise ValueError(f"{step}: columns {missing} are not in the data")
    if missing:
        log.warning("%s: columns %s are not in the data, ignored", step, missing)


def replace_column(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Swap one root column in place; unlike withColumn it keeps the alias metadata."""
    return df.select(*[column if c == name else root(c) for c in df.columns])


def rewrite_struct(
    df: DataFrame,
    struct: str,
    replace: Mapping[str, Column] | None = None,
    drop: Iterable[str] = (),
    metadata: dict | None = None,
) -> DataFrame:
    """Replace or drop fields of a struct; a null struct stays null.

    withField/dropFields are used because Catalyst looks through them: a later filter on
    an untouched field still reaches the scan, which it does not through a rebuilt struct.
    """
    drop = list(drop)
    column = root(struct)
    for name, value in (replace or {}).items():
        column = column.withField(ident(name), value)
    if drop:
        if set(drop) >= set(column_names(df, struct)):
            raise ValueError(f"removing {drop} would leave no field in {struct!r}")
        column = column.dropFields(*[ident(name) for name in drop])
    kept = df.schema[struct].metadata if metadata is None else metadata
    return replace_column(df, struct, column.alias(struct, metadata=kept))
