"""Stream flows on Structured Streaming."""

from __future__ import annotations

import hashlib
import json
import logging
import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

from sluiceway.operators.codec import decode_json, infer_json_schemas
from sluiceway.plans.flow import open_stores, shape
from sluiceway.plans.spec import ONCE, FlowSpec
from sluiceway.sources import kafka, storage
from sluiceway.sources.stores import BATCH, STREAM, EnvelopeStore, Store

log = logging.getLogger(__name__)

PINNED = "inferred-schema.json"
SESSION_CHECKPOINT = "spark.sql.streaming.checkpointLocation"


# Settings that may change without making it another flow: whoever has another password reads the same data.
SECRET = re.compile(r"(?i)password|passwd|secret|token|credential|api_?key|access_?key|jaas|truststore|keystore")


def _places(setting: Any) -> Any:
    """Settings of a store without secrets."""
    if isinstance(setting, Mapping):
        return {name: _places(value) for name, value in setting.items() if not SECRET.search(str(name))}
    return [_places(value) for value in setting] if isinstance(setting, (list, tuple)) else setting


def _shape(spec: FlowSpec) -> list[Any]:
    """What a flow does with its rows; own functions count by name."""
    own = [getattr(step.custom, "__qualname__", type(step.custom).__name__) for step in spec.steps]
    steps = [[step.name, step.action, list(step.columns), dict(step.options), name] for step, name in zip(spec.steps, own, strict=True)]
    return [spec.source_type, spec.target_type, spec.operation, spec.order_by, spec.drop_tombstones, steps]


def checkpoint_of(spark: SparkSession, spec: FlowSpec) -> str:
    """Where the stream keeps its progress; the same flow finds it again after a restart.

    A flow is known by its stores without secrets, its data types, its operation and its steps.
    """
    if spec.checkpoint:
        return spec.checkpoint.rstrip("/")
    base = spark.conf.get(SESSION_CHECKPOINT, None)
    if not base:
        raise ValueError(f"a stream needs checkpoint_location, or {SESSION_CHECKPOINT} in the session")
    try:
        identity = json.dumps([_places(spec.source), _places(spec.destination), *_shape(spec)], sort_keys=True)
    except TypeError as error:
        raise ValueError("a stream between stores made by hand needs checkpoint_location") from error
    return f"{base.rstrip('/')}/{hashlib.sha256(identity.encode()).hexdigest()[:16]}"


def set_trigger(writer: DataStreamWriter, trigger: str) -> DataStreamWriter:
    """An interval such as `5 seconds`; `once` takes all data present and stops."""
    if trigger == ONCE:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def _load_pin(spark: SparkSession, checkpoint: str) -> dict | None:
    path = f"{checkpoint}/{PINNED}"
    return json.loads(storage.read_text(spark, path)) if storage.exists(spark, path) else None


def _save_pin(spark: SparkSession, checkpoint: str, pin: dict) -> dict:
    storage.write_text(spark, f"{checkpoint}/{PINNED}", json.dumps(pin))
    return pin


def _decoded(df: DataFrame, pin: dict) -> DataFrame:
    """Rows by the pinned schema. A field that came later fails the stream: it would be lost without a word."""
    kinds = {c: DataType.fromDDL(pin[c]) for c in ("key", "value") if pin[c] is not None}
    fields = {c: kind.names for c, kind in kinds.items() if isinstance(kind, StructType)}
    return decode_json(df, pin["value"], pin["key"], fields=fields, long_numbers=True)


def _infer(df: DataFrame) -> dict | None:
    schemas = infer_json_schemas(df)
    return None if schemas is None else {"key": schemas[0], "value": schemas[1]}


VERSION = "inferred-schema-{:06d}.json"


def _grown(known: DataType, found: DataType) -> DataType:
    """`known` with the fields that only `found` has, at any depth; types that are known stay."""
    if isinstance(known, StructType) and isinstance(found, StructType):
        other = {f.name: f for f in found.fields}
        fields = [StructField(f.name, _grown(f.dataType, other[f.name].dataType) if f.name in other else f.dataType) for f in known.fields]
        return StructType([*fields, *[f for f in found.fields if f.name not in known.names]])
    if isinstance(known, ArrayType) and isinstance(found, ArrayType):
        return ArrayType(_grown(known.elementType, found.elementType))
    return known


def schema_versions(spark: SparkSession, checkpoint: str) -> list[dict]:
    """The inferred schemas of a stream, oldest first: each has the fields of the one before, and more."""
    names = storage.children(spark, checkpoint, "inferred-schema-*.json")
    return [json.loads(storage.read_text(spark, f"{checkpoint}/{name}")) for name in names]


def _grown_pin(spark: SparkSession, checkpoint: str, batch: DataFrame) -> dict | None:
    """The newest schema, as a new version if the batch has fields it lacks; None before any batch has a value."""
    versions, found = schema_versions(spark, checkpoint), _infer(batch)
    if found is None:
        return versions[-1] if versions else None
    grown = found
    if versions:
        grown = dict(versions[-1])
        for part in ("key", "value"):
            if found[part] is not None:
                grown[part] = _printed(_grown(DataType.fromDDL(grown[part]), DataType.fromDDL(found[part]))) if grown[part] else found[part]
        if grown == versions[-1]:
            return grown
    storage.publish_text(spark, f"{checkpoint}/{VERSION.format(len(versions) + 1)}", json.dumps(grown))
    return grown


def _printed(kind: DataType) -> str:
    return kind.toDDL() if isinstance(kind, StructType) else kind.simpleString()


def _growing(rows: DataFrame, spec: FlowSpec, target: Store, job: str, checkpoint: str) -> DataStreamWriter:
    """Writer that decodes each micro-batch by the schema of all rows up to it."""

    def process(batch: DataFrame, batch_id: int) -> None:
        pin = _grown_pin(batch.sparkSession, checkpoint, batch)
        if pin is not None:
            df = shape(_decoded(batch, pin), spec, target.append_only)
            target.write(df, spec.operation, spec.target_type, tag=f"{job}#{batch_id}")

    return rows.writeStream.foreachBatch(process)


def _per_batch(rows: DataFrame, spec: FlowSpec, target: Store, job: str, pin_at: str | None) -> DataStreamWriter:
    """Writer that shapes each micro-batch as static data.

    With `pin_at` the rows are still to be decoded: the first batch that has a value fixes
    the schema, and batches before it have nothing to write.
    """

    def write(batch: DataFrame, batch_id: int, pin: dict | None) -> None:
        df = shape(batch if pin is None else _decoded(batch, pin), spec, target.append_only)
        target.write(df, spec.operation, spec.target_type, tag=f"{job}#{batch_id}")

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        pin = None if pin_at is None else _load_pin(spark, pin_at)
        if pin is None or "value" in pin:
            if not batch.isEmpty():
                write(batch, batch_id, pin)
            return
        found = _infer(batch)
        if found is not None:
            write(batch, batch_id, _save_pin(spark, pin_at, {**pin, **found}))

    return rows.writeStream.foreachBatch(process)


def _writer(
    spark: SparkSession, spec: FlowSpec, source: Store, target: Store, checkpoint: str, job: str
) -> DataStreamWriter:
    rows = source.read(spark, STREAM)
    inferred = isinstance(source, EnvelopeStore) and source.needs_inference
    if spec.growing_schema and not inferred:
        raise ValueError("only an inferred schema can grow")
    if not inferred:
        if spec.per_batch:
            return _per_batch(rows, spec, target, job, None)
        return target.write_stream(shape(rows, spec, target.append_only), spec.operation, job, spec.target_type)

    if spec.growing_schema:
        return _growing(rows, spec, target, job, checkpoint)
    # The schema is fixed once per checkpoint, so the target's schema cannot drift. With data
    # present it is known before the start and the stream is one plan; a restart keeps the way
    # that was taken first.
    pin = _load_pin(spark, checkpoint)
    if pin is None:
        found = _infer(source.envelope(spark, BATCH))
        pin = _save_pin(spark, checkpoint, {"per_batch": spec.per_batch or found is None, **(found or {})})
    if pin["per_batch"]:
        return _per_batch(rows, spec, target, job, checkpoint)
    return target.write_stream(shape(_decoded(rows, pin), spec, target.append_only), spec.operation, job, spec.target_type)


def start_stream(spark: SparkSession, spec: FlowSpec) -> StreamingQuery:
    """Start a stream flow and return its query; `awaitTermination()` blocks until it ends."""
    source, target = open_stores(spark, spec)
    checkpoint = checkpoint_of(spark, spec)
    job = storage.qualified(spark, checkpoint)
    writer = _writer(spark, spec, source, target, checkpoint, job)
    # A connector is looked for only now.
    return kafka.guarded(lambda: set_trigger(writer, spec.trigger).option("checkpointLocation", checkpoint).start())
