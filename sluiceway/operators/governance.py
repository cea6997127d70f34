"""Governance steps: remove, redact, digest, filter, sample.

Each takes `form`: `"log"` works on root columns, `"change"` on the fields of the
`key` struct and then of the `value` struct. All but the filter and the sample are
plain projections, so Catalyst prunes the columns they hide from the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from sluiceway.functions.digests import check_algorithm, digest
from sluiceway.functions.structs import (
    column_names,
    matching,
    report_missing,
    rewrite_struct,
    root,
    struct_type,
)
from sluiceway.operators.lineage import FIELD_STAMPS, field_stamps, stamp

LOG = "log"
CHANGE = "change"
CHANGE_STRUCTS = ("key", "value")
DEFAULT_REDACTION = "X" * 10
DEFAULT_FRACTION = 0.25
DRAWS = 2**52


def _structs(df: DataFrame, form: str) -> list[str | None]:
    """Places to work on; an undecoded key or value is not a struct and is left alone."""
    if form == LOG:
        return [None]
    if form == CHANGE:
        return [s for s in CHANGE_STRUCTS if struct_type(df, s) is not None]
    raise ValueError(f"unknown form {form!r}")


def _locate(df: DataFrame, columns: Iterable[str], form: str, step: str, strict: bool) -> dict[str | None, list[str]]:
    columns = list(columns)
    places = {place: matching(columns, column_names(df, place), step) for place in _structs(df, form)}
    report_missing(columns, [c for found in places.values() for c in found], step, strict)
    return places


def _rewrite(
    df: DataFrame,
    places: dict[str | None, list[str]],
    action: str,
    name: str,
    expression: Callable[[Column, DataType], Column],
) -> DataFrame:
    for place, found in places.items():
        if not found:
            continue
        if place is None:
            columns = []
            for f in df.schema.fields:
                if f.name in found:
                    changed = expression(root(f.name), f.dataType)
                    columns.append(changed.alias(f.name, metadata=stamp(f, action, name)))
                else:
                    columns.append(root(f.name))
            df = df.select(*columns)
            continue
        inner = struct_type(df, place)
        stamps = field_stamps(df, place)
        replaced = {}
        for child in found:
            f = inner[child]
            replaced[child] = expression(root(place).getField(child), f.dataType)
            stamps[child] = stamp(f, action, name, {**f.metadata, **stamps.get(child, {})})
        outer = {**df.schema[place].metadata, FIELD_STAMPS: stamps}
        df = rewrite_struct(df, place, replace=replaced, metadata=outer)
    return df


def remove_columns(
    df: DataFrame, columns: Iterable[str], form: str = LOG, name: str = "remove", strict: bool = False
) -> DataFrame:
    """Drop columns; names not in the data are reported and ignored (`strict` raises)."""
    places = _locate(df, columns, form, name, strict)
    for place, found in places.items():
        if not found:
            continue
        if place is None:
            kept = [c for c in df.columns if c not in found]
            if not kept:
                raise ValueError(f"{name}: no column would be left")
            df = df.select(*[root(c) for c in kept])
            continue
        stamps = {c: s for c, s in field_stamps(df, place).items() if c not in found}
        outer = {k: v for k, v in df.schema[place].metadata.items() if k != FIELD_STAMPS}
        if stamps:
            outer[FIELD_STAMPS] = stamps
        df = rewrite_struct(df, place, drop=found, metadata=outer)
    return df


def redact_columns(
    df: DataFrame,
    columns: Iterable[str],
    redact_value: str = DEFAULT_REDACTION,
    form: str = LOG,
    name: str = "redact",
    strict: bool = False,
) -> DataFrame:
    """Replace columns by one constant text; null cells are replaced too."""
    places = _locate(df, columns, form, name, strict)
    return _rewrite(df, places, "Redact", name, lambda column, data_type: F.lit(redact_value))


def digest_columns(
    df: DataFrame,
    columns: Iterable[str],
    algo: str = "md5",
    form: str = LOG,
    name: str = "digest",
    strict: bool = False,
) -> DataFrame:
    """Replace columns by their digest, see `sluiceway.functions.digests`."""
    algo = check_algorithm(algo)
    places = _locate(df, columns, form, name, strict)
    return _rewrite(df, places, f"Digest {algo}", name, lambda column, data_type: digest(column, data_type, algo))


def filter_rows(df: DataFrame, clause: str) -> DataFrame:
    """Keep the rows for which a Spark SQL condition holds; change data names `key.x`, `value.x`."""
    return df.filter(clause)


def sample_rows(df: DataFrame, fraction: float = DEFAULT_FRACTION, seed: int | None = None) -> DataFrame:
    """Keep each row with probability `fraction`, without replacement."""
    if df.isStreaming:
        # Spark samples static data only. rand() restarts with every micro-batch, whose time,
        # the same when a batch is retried, makes the choice another one in each.
        draw = F.xxhash64(F.rand() if seed is None else F.rand(seed), F.current_timestamp())
        return df.filter(F.pmod(draw, F.lit(DRAWS)) < fraction * DRAWS)
    if seed is None:
        return df.sample(fraction=fraction)
    return df.sample(fraction=fraction, seed=seed)


def keep_all(df: DataFrame) -> DataFrame:
    """The identity step."""
    return df


__all__ = [
    "CHANGE",
    "LOG",
    "digest_columns",
    "filter_rows",
    "keep_all",
    "redact_columns",
    "remove_columns",
    "sample_rows",
]
