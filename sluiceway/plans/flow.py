"""Running a flow: read, take a snapshot where due, govern, project, write."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sluiceway.operators.envelope import change_pair, unwrap
from sluiceway.operators.governance import CHANGE, LOG
from sluiceway.operators.lineage import seal_stamps
from sluiceway.operators.snapshot import snapshot
from sluiceway.operators.steps import apply_steps
from sluiceway.plans.spec import FlowSpec
from sluiceway.sources.formats import UPDATE
from sluiceway.sources.stores import BATCH, STREAM, FileStore, Store, build_store

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class FlowReport:
    """What a batch flow did. `rows` is the number of rows written, -1 if the target does not know."""

    rows: int


def open_stores(spark: SparkSession, spec: FlowSpec) -> tuple[Store, Store]:
    """Source and target of a flow, after all checks that need no data."""
    source = build_store(spec.source, "source")
    target = build_store(spec.destination, "destination")
    spec.check(target.append_only)
    if spec.order_by:
        target.order_by = spec.order_by
    if spec.takes_snapshot and isinstance(target, FileStore) and target.rebalance is None:
        target.rebalance = bool(target.partition_by)
    if spec.flow_type == STREAM and spec.operation == UPDATE and not source.in_order:
        raise ValueError("an update needs all changes in order: a source bounded by files per trigger may give a later one first")
    here, there = source.location(spark), target.location(spark)
    if here and there and (here == there or here.startswith(there + "/") or there.startswith(here + "/")):
        raise ValueError(f"source {here} and target {there} overlap")
    return source, target


def shape(df: DataFrame, spec: FlowSpec, append_only_target: bool = False) -> DataFrame:
    """The rows to write for the rows read: one lazy plan, the same for batch and stream.

    The governance steps come after the snapshot: a filter before it would bring earlier
    values of a key back. A topic takes key and value itself, and the order of the rows from
    the columns besides them.
    """
    if spec.takes_snapshot:
        return apply_steps(snapshot(df, spec.order_by), spec.steps, LOG)
    df = apply_steps(df, spec.steps, CHANGE if spec.source_type == CHANGE else LOG)
    if spec.operation == UPDATE or spec.source_type == LOG:
        return seal_stamps(df)
    if spec.flow_type == STREAM and spec.target_type == LOG:
        log.warning("a stream takes no snapshot: keys may repeat, and deletes are not applied")
        return unwrap(df, spec.drop_tombstones)
    if spec.flow_type == STREAM and not append_only_target:
        df = change_pair(df)
    return seal_stamps(df)


def run_batch(spark: SparkSession, spec: FlowSpec) -> FlowReport:
    source, target = open_stores(spark, spec)
    written = target.write(shape(source.read(spark, BATCH), spec, target.append_only), spec.operation, spec.target_type)
    rows = -1 if written is None else written
    log.info("wrote %d rows", rows)
    return FlowReport(rows)


def run(spark: SparkSession, spec: FlowSpec | Mapping[str, Any]) -> FlowReport | StreamingQuery:
    """Run a flow. A batch flow is finished on return; a stream is running."""
    from sluiceway.streaming.runner import start_stream

    if not isinstance(spec, FlowSpec):
        spec = FlowSpec.from_dict(spec)
    return start_stream(spark, spec) if spec.flow_type == STREAM else run_batch(spark, spec)


def delete_target(spark: SparkSession, spec: FlowSpec | Mapping[str, Any]) -> bool:
    """Delete all data at a flow's target, also what other flows wrote there."""
    if not isinstance(spec, FlowSpec):
        spec = FlowSpec.from_dict(spec)
    return build_store(spec.destination, "destination").delete(spark)
