"""Avro descriptions of Spark columns, as plain JSON values."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    MapType,
    StructField,
    StructType,
)

# Avro type and logical type per Spark type name.
ATOMIC = {
    "boolean": {"type": "boolean", "logicalType": "BOOLEAN"},
    "tinyint": {"type": "int", "logicalType": "TINYINT"},
    "smallint": {"type": "int", "logicalType": "SMALLINT"},
    "int": {"type": "int"},
    "bigint": {"type": "long"},
    "float": {"type": "float"},
    "double": {"type": "double"},
    "string": {"type": "string"},
    "binary": {"type": "bytes"},
    "timestamp": {"type": "long", "logicalType": "timestamp-micros"},
    "timestamp_ntz": {"type": "long", "logicalType": "local-timestamp-micros"},
    "date": {"type": "int", "logicalType": "date"},
}


def avro_type(data_type: DataType, name: str = "record") -> dict:
    """Avro schema of a Spark type; a type without a counterpart is described as a string."""
    if isinstance(data_type, DecimalType):
        return {
            "type": "bytes",
            "logicalType": "decimal",
            "precision": data_type.precision,
            "scale": data_type.scale,
        }
    if isinstance(data_type, ArrayType):
        return {"type": "array", "items": avro_type(data_type.elementType, name)}
    if isinstance(data_type, MapType):
        return {"type": "map", "values": avro_type(data_type.valueType, name)}
    if isinstance(data_type, StructType):
        return {"type": "record", "name": name, "fields": [avro_field(f) for f in data_type.fields]}
    simple = data_type.simpleString()
    return dict(ATOMIC.get(simple, {"type": "string", "sparkType": simple}))


def avro_field(field: StructField) -> dict:
    """A field of a record. Column metadata cannot hold a union of a type and null, so that is a mark here; see `unions`."""
    described = {"name": field.name, "type": avro_type(field.dataType, field.name)}
    return {**described, "nullable": True} if field.nullable else described


def unions(described: dict) -> dict:
    """An Avro schema in which fields that may be null are unions, at any depth."""
    found = dict(described)
    for part in ("items", "values"):
        if isinstance(found.get(part), dict):
            found[part] = unions(found[part])
    if "fields" in found:
        kinds = [(f, unions(f["type"])) for f in found["fields"]]
        found["fields"] = [{"name": f["name"], "type": [kind, "null"] if f.get("nullable") else kind} for f, kind in kinds]
    return found
