"""DataFrame to DataFrame operators."""

from sluiceway.operators.codec import (
    ConnectorMissing,
    choose_format,
    decode,
    decode_avro,
    decode_json,
    decode_json_inferred,
    encode,
    encode_avro,
    encode_json,
    infer_json_schemas,
    inspect_raw,
)
from sluiceway.operators.counts import RowCounts, StreamRowCounts
from sluiceway.operators.envelope import ENVELOPE, change_pair, unwrap, wrap
from sluiceway.operators.governance import (
    CHANGE,
    LOG,
    digest_columns,
    filter_rows,
    keep_all,
    redact_columns,
    remove_columns,
    sample_rows,
)
from sluiceway.operators.lineage import augment_metadata, lineage, record_schema, seal_stamps
from sluiceway.operators.snapshot import latest_changes, snapshot, snapshot_binary
from sluiceway.operators.steps import Step, apply_steps, load_steps, merge_steps
from sluiceway.operators.update import apply_changes

__all__ = [
    "CHANGE",
    "ENVELOPE",
    "LOG",
    "ConnectorMissing",
    "RowCounts",
    "StreamRowCounts",
    "Step",
    "apply_changes",
    "apply_steps",
    "augment_metadata",
    "change_pair",
    "choose_format",
    "decode",
    "decode_avro",
    "decode_json",
    "decode_json_inferred",
    "digest_columns",
    "encode",
    "encode_avro",
    "encode_json",
    "filter_rows",
    "infer_json_schemas",
    "inspect_raw",
    "keep_all",
    "latest_changes",
    "lineage",
    "load_steps",
    "merge_steps",
    "record_schema",
    "redact_columns",
    "remove_columns",
    "sample_rows",
    "seal_stamps",
    "snapshot",
    "snapshot_binary",
    "unwrap",
    "wrap",
]
