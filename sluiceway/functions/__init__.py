"""Column expressions and schema helpers."""

from sluiceway.functions.avro_types import avro_type
from sluiceway.functions.digests import ALGORITHMS, digest
from sluiceway.functions.framing import frame, payload, schema_id
from sluiceway.functions.nullability import require_not_null
from sluiceway.functions.structs import column_names, field, field_type, struct_type

__all__ = [
    "ALGORITHMS",
    "avro_type",
    "column_names",
    "digest",
    "field",
    "field_type",
    "frame",
    "payload",
    "require_not_null",
    "schema_id",
    "struct_type",
]
