"""Column metadata: type descriptions and the record of governance steps."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from sluiceway.functions.avro_types import avro_type, unions
from sluiceway.functions.structs import root, struct_type

# Metadata property names.
ACTION = "TransformationAction"
NAME = "TransformationName"
HISTORY = "TransformationHistory"
# Stamps of struct fields wait here, on the struct column, until `seal_stamps`.
FIELD_STAMPS = "fieldStamps"


def stamp(field: StructField, action: str, name: str, previous: dict | None = None) -> dict:
    """Metadata for a changed column: its source type, this step, and all steps so far."""
    before = dict(field.metadata if previous is None else previous)
    history = [*before.get(HISTORY, []), {"action": action, "name": name}]
    described = avro_type(field.dataType, field.name)
    if HISTORY in before:
        # A second step: the source type was recorded by the first.
        described = {}
    return {**before, **described, ACTION: action, NAME: name, HISTORY: history}


def field_stamps(df: DataFrame, struct: str) -> dict:
    return dict(df.schema[struct].metadata.get(FIELD_STAMPS, {}))


def seal_stamps(df: DataFrame) -> DataFrame:
    """Move waiting stamps onto the struct fields themselves; to be done last, before a write."""
    columns, changed = [], False
    for field in df.schema.fields:
        stamps = field.metadata.get(FIELD_STAMPS)
        inner = struct_type(df, field.name)
        if not stamps or inner is None:
            columns.append(root(field.name))
            continue
        changed = True
        parts = [
            root(field.name).getField(f.name).alias(f.name, metadata={**f.metadata, **stamps.get(f.name, {})})
            for f in inner.fields
        ]
        outer = {k: v for k, v in field.metadata.items() if k != FIELD_STAMPS}
        rebuilt = F.when(root(field.name).isNotNull(), F.struct(*parts))
        columns.append(rebuilt.alias(field.name, metadata=outer))
    return df.select(*columns) if changed else df


def lineage(df: DataFrame) -> dict[str, list[dict]]:
    """Steps recorded per column, `struct.column` for fields of a struct."""
    found: dict[str, list[dict]] = {}
    for field in df.schema.fields:
        if HISTORY in field.metadata:
            found[field.name] = field.metadata[HISTORY]
        inner = struct_type(df, field.name)
        if inner is None:
            continue
        waiting = field.metadata.get(FIELD_STAMPS, {})
        for child in inner.fields:
            history = {**child.metadata, **waiting.get(child.name, {})}.get(HISTORY)
            if history:
                found[f"{field.name}.{child.name}"] = history
    return found


def augment_metadata(df: DataFrame) -> DataFrame:
    """Give every column without metadata its type description."""
    return df.select(
        *[
            root(f.name).alias(f.name, metadata=f.metadata or avro_type(f.dataType, f.name))
            for f in df.schema.fields
        ]
    )


def record_schema(df: DataFrame, name: str) -> str:
    """Avro record schema (JSON) from the column metadata; columns without one become `null`."""
    fields = []
    for f in df.schema.fields:
        described = unions(f.metadata) if "type" in f.metadata else "null"
        if described != "null" and f.nullable:
            described = [described, "null"]
        fields.append({"name": f.name, "type": described})
    return json.dumps({"type": "record", "name": name, "fields": fields})
