"""Queries that move whole tables: formats, batch flows and stream flows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway import run
from sluiceway.catalogue.change_data import EVENTS_SCHEMA, ORDERS_SCHEMA
from sluiceway.catalogue.registry import query
from sluiceway.catalogue.tables import (
    KEY_SCHEMA,
    SNAPSHOT_SQL,
    VALUE_SCHEMA,
    change_log,
    directory_of,
    drain,
    table,
    topic_of_changes,
)
from sluiceway.operators import StreamRowCounts, decode_json, encode_json, filter_rows, snapshot, unwrap
from sluiceway.sources import storage
from sluiceway.sources.changelog import append_log, read_log
from sluiceway.sources.formats import APPEND, FileFormat, find_format, register_format, unregister_format
from sluiceway.sources.stores import FileStore
from sluiceway.sources.tables import read_table


def _stored(spark: SparkSession, sf_dir: str, name: str, fmt: str, schema: str | None = None) -> DataFrame:
    path = storage.scratch_dir(spark, fmt)
    store = find_format(fmt)
    store.write(table(spark, sf_dir, name), path)
    return store.read(spark, path, schema)


@query("SELECT * FROM lineitem")
def format_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "lineitem", "parquet")


@query("SELECT * FROM documents")
def format_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "documents", "ORC")


@query("SELECT * FROM events")
def format_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "events", "json", EVENTS_SCHEMA)


@query("SELECT * FROM events")
def format_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "events", "csv", EVENTS_SCHEMA)


@query("SELECT * FROM documents")
def format_csv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with line breaks and quotes, by default options."""
    return _stored(spark, sf_dir, "documents", "csv", "doc_id bigint, text string, lang string, source string, n_chars bigint")


@query(
    """SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer"""
)
def format_json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    return _stored(spark, sf_dir, "customer", "json").select(*names)


@query(
    """SELECT p_partkey::INTEGER AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"""
)
def format_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "part", "csv")


@query("SELECT * FROM supplier")
def format_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A format of the user's own: compressed JSON."""
    register_format(FileFormat("json", write_options={"compression": "gzip"}), "packed")
    try:
        schema = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
        return _stored(spark, sf_dir, "supplier", "packed", schema)
    finally:
        unregister_format("packed")


@query("SELECT * FROM documents UNION ALL SELECT * FROM documents WHERE doc_id % 3 = 0")
def format_own_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A format that is a Python data source, named by its class: written, appended to, overwritten, read by its own schema."""
    path, fmt = storage.scratch_dir(spark, "arrow"), find_format("sluiceway.sources.arrow_files.ArrowFiles")
    documents = table(spark, sf_dir, "documents")
    fmt.write(documents.where("doc_id < 0"), path)
    fmt.write(documents, path)
    fmt.write(documents.where("doc_id % 3 = 0"), path, APPEND)
    return fmt.read(spark, path)


@query("SELECT * FROM lineitem")
def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = storage.scratch_dir(spark, "partitioned")
    names = table(spark, sf_dir, "lineitem").columns
    flow = {
        "source": {"local": {"path": f"{sf_dir}/lineitem.parquet", "dataFormat": "parquet"}},
        "destination": {
            "local": {
                "path": path,
                "dataFormat": "parquet",
                "partitionBy": ["l_returnflag", "l_linestatus"],
                "rebalance": True,
            }
        },
    }
    run(spark, flow)
    return find_format("parquet").read(spark, path).select(*names)


@query("SELECT * FROM customer UNION ALL SELECT * FROM customer")
def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = storage.scratch_dir(spark, "appended")
    store = find_format("parquet")
    store.write(table(spark, sf_dir, "customer"), path)
    store.write(table(spark, sf_dir, "customer"), path, APPEND)
    return store.read(spark, path)


@query("SELECT 'XXXXXXXXXX' AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def flow_batch_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = storage.scratch_dir(spark, "copy")
    run(
        spark,
        {
            "source": {"local": {"path": f"{sf_dir}/customer.parquet", "dataFormat": "parquet"}},
            "destination": {"local": {"path": path, "dataFormat": "parquet"}},
            "transformation": [
                {"name": "hide name", "columns": ["c_name"], "action": "RedactColumns"},
                {"name": "no key", "columns": ["c_custkey"], "action": "RemoveColumns"},
            ],
            "flowType": "batch",
            "readDataType": "logdata",
            "writeDataType": "logdata",
            "writeOperation": "overwrite",
        },
    )
    return find_format("parquet").read(spark, path)


@query(f"SELECT * FROM ({SNAPSHOT_SQL}) WHERE event_type <> 'view'")
def flow_batch_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic to files, change data to log data, without a given schema."""
    path = storage.scratch_dir(spark, "snapshot")
    run(
        spark,
        {
            "source": {"topic": {"path": topic_of_changes(spark, sf_dir), "dataFormat": "json"}},
            "destination": {"files": {"path": path, "dataFormat": "orc"}},
            "transformation": [{"name": "f", "action": "FilterRows", "options": {"clause": "event_type <> 'view'"}}],
            "readDataType": "cdc",
            "writeDataType": "log",
        },
    )
    return find_format("orc").read(spark, path).select("user_id", "event_type", "value")


@query("SELECT * FROM orders")
def flow_table_to_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log data into a topic: rows are wrapped on the way."""
    path = storage.scratch_dir(spark, "orders-topic")
    run(
        spark,
        {
            "source": {"local": {"path": f"{sf_dir}/orders.parquet", "dataFormat": "parquet"}},
            "destination": {"topic": {"path": path}},
        },
    )
    return unwrap(decode_json(read_log(spark, path), ORDERS_SCHEMA))


@query(SNAPSHOT_SQL)
def flow_batch_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = storage.scratch_dir(spark, "updated")
    run(
        spark,
        {
            "source": {
                "topic": {"path": topic_of_changes(spark, sf_dir), "valueSchema": VALUE_SCHEMA, "keySchema": KEY_SCHEMA}
            },
            "destination": {"files": {"path": path, "dataFormat": "parquet"}},
            "readDataType": "change",
            "writeDataType": "log",
            "writeOperation": "update",
        },
    )
    return read_table(spark, path)


@query(
    """SELECT event_id, ts, user_id, md5(event_type) AS event_type, value FROM events WHERE value > 1"""
)
def stream_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = storage.scratch_dir(spark, "stream")
    drain(
        spark,
        {
            "source": {"local": directory_of(spark, sf_dir, "events")},
            "destination": {"local": {"path": path, "dataFormat": "parquet"}},
            "transformation": [
                {"name": "f", "action": "filterrows", "options": {"clause": "value > 1"}},
                {"name": "d", "action": "digestcolumns", "columns": ["event_type"]},
                {"name": "r", "action": "removecolumns", "columns": ["props"]},
            ],
        },
    )
    return find_format("parquet").read(spark, path)


@query("SELECT count(*) AS source_rows, true AS within_bounds, 0::BIGINT AS foreign_rows FROM events")
def stream_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = storage.scratch_dir(spark, "sampled")
    drain(
        spark,
        {
            "source": {"local": directory_of(spark, sf_dir, "events")},
            "destination": {"local": {"path": path, "dataFormat": "parquet"}},
            "transformation": [{"name": "s", "action": "SampleRows", "options": {"fraction": 0.5, "seed": 11}}],
        },
    )
    given = table(spark, sf_dir, "events").select("event_id", F.lit(1).alias("given"), F.lit(0).alias("kept"))
    kept = find_format("parquet").read(spark, path).select("event_id", F.lit(0).alias("given"), F.lit(1).alias("kept"))
    per_row = given.unionByName(kept).groupBy("event_id").agg(F.sum("given").alias("given"), F.sum("kept").alias("kept"))
    return per_row.agg(
        F.sum("given").alias("source_rows"),
        (F.sum("kept") / F.sum("given")).between(0.4, 0.6).alias("within_bounds"),
        F.count(F.when(F.col("kept") > F.col("given"), 1)).alias("foreign_rows"),
    )


@query(SNAPSHOT_SQL)
def flow_partitioned_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic to files partitioned by a value column."""
    path = storage.scratch_dir(spark, "partitioned-snapshot")
    run(
        spark,
        {
            "source": {
                "topic": {"path": topic_of_changes(spark, sf_dir), "valueSchema": VALUE_SCHEMA, "keySchema": KEY_SCHEMA}
            },
            "destination": {"files": {"path": path, "dataFormat": "parquet", "partitionBy": ["event_type"]}},
            "readDataType": "cdc",
            "writeDataType": "log",
        },
    )
    return find_format("parquet").read(spark, path).select("user_id", "event_type", "value")


def _through_stream(spark: SparkSession, sf_dir: str, name: str, fmt: str, schema: str) -> DataFrame:
    """A table streamed into a format and from there back into Parquet."""
    first, second = storage.scratch_dir(spark, fmt), storage.scratch_dir(spark, "parquet")
    drain(
        spark,
        {
            "source": {"local": directory_of(spark, sf_dir, name)},
            "destination": {"local": {"path": first, "dataFormat": fmt}},
        },
    )
    drain(
        spark,
        {
            "source": {"local": {"path": first, "dataFormat": fmt, "schema": schema}},
            "destination": {"local": {"path": second, "dataFormat": "parquet"}},
        },
    )
    return find_format("parquet").read(spark, second)


@query("SELECT * FROM orders")
def stream_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_stream(spark, sf_dir, "orders", "json", ORDERS_SCHEMA)


@query("SELECT * FROM orders")
def stream_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_stream(spark, sf_dir, "orders", "csv", ORDERS_SCHEMA)


@query("SELECT * FROM orders")
def stream_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_stream(spark, sf_dir, "orders", "orc", ORDERS_SCHEMA)


@query("SELECT * FROM orders")
def stream_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = storage.scratch_dir(spark, "stream")
    orders = table(spark, sf_dir, "orders")
    drain(
        spark,
        {
            "source": {"local": directory_of(spark, sf_dir, "orders")},
            "destination": {"local": {"path": path, "dataFormat": "parquet", "partitionBy": ["o_orderstatus"]}},
        },
    )
    return find_format("parquet").read(spark, path).select(*orders.columns)


@query(
    """SELECT CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
       CASE WHEN event_type <> 'error' THEN 'XXXXXXXXXX' END AS event_type,
       CASE WHEN event_type <> 'error' THEN value END AS value FROM events"""
)
def stream_change_to_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values alone, without a snapshot; a delete becomes a row of nulls. The schema is inferred."""
    path = storage.scratch_dir(spark, "values")
    drain(
        spark,
        {
            "source": {"topic": {"path": topic_of_changes(spark, sf_dir)}},
            "destination": {"local": {"path": path, "dataFormat": "parquet"}},
            "transformation": [{"name": "r", "action": "redactcolumns", "columns": ["event_type"]}],
            "readDataType": "cdc",
            "writeDataType": "log",
        },
    )
    return find_format("parquet").read(spark, path).select("user_id", "event_type", "value")


@query(f"SELECT md5(user_id::VARCHAR) AS user_id, event_type, value FROM ({SNAPSHOT_SQL})")
def stream_change_to_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic to topic; the copy has the same last values, deletes included."""
    path = storage.scratch_dir(spark, "copied-topic")
    drain(
        spark,
        {
            "source": {
                "topic": {"path": topic_of_changes(spark, sf_dir), "valueSchema": VALUE_SCHEMA, "keySchema": KEY_SCHEMA}
            },
            "destination": {"topic": {"path": path}},
            "transformation": [{"name": "d", "action": "digestcolumns", "columns": ["user_id"]}],
            "readDataType": "cdc",
        },
    )
    schema = "user_id string, event_type string, value double"
    return snapshot(decode_json(read_log(spark, path), schema, "user_id string"))


@query(
    """SELECT user_id AS key_user_id, CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
       CASE WHEN event_type <> 'error' THEN event_type END AS event_type, CASE WHEN event_type <> 'error' THEN value END AS value,
       event_type <> 'error' AS alive, event_id AS "offset", 0 AS "timestampType" FROM events"""
)
def stream_log_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log read as log data keeps its whole envelope."""
    path = storage.scratch_dir(spark, "envelope")
    drain(
        spark,
        {
            "source": {
                "topic": {"path": topic_of_changes(spark, sf_dir), "valueSchema": VALUE_SCHEMA, "keySchema": KEY_SCHEMA}
            },
            "destination": {"local": {"path": path, "dataFormat": "parquet"}},
        },
    )
    rows = find_format("parquet").read(spark, path)
    return rows.select(
        F.col("key.user_id").alias("key_user_id"), "value.*", F.col("value").isNotNull().alias("alive"), "offset", "timestampType"
    )


@query(SNAPSHOT_SQL)
def stream_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = storage.scratch_dir(spark, "stream-updated")
    drain(
        spark,
        {
            "source": {
                "topic": {"path": topic_of_changes(spark, sf_dir), "valueSchema": VALUE_SCHEMA, "keySchema": KEY_SCHEMA}
            },
            "destination": {"local": {"path": path, "dataFormat": "parquet"}},
            "readDataType": "cdc",
            "writeDataType": "log",
            "writeOperation": "update",
        },
    )
    return read_table(spark, path)


@query(SNAPSHOT_SQL)
def stream_update_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that grows by three appends, each one micro-batch into a table in buckets."""
    path, log, checkpoint = (storage.scratch_dir(spark, x) for x in ("stream-buckets", "log", "checkpoint"))
    rows = encode_json(change_log(spark, sf_dir), keep=["offset"])
    flow = {
        "source": {"changelog": {"path": log, "valueSchema": VALUE_SCHEMA, "keySchema": KEY_SCHEMA}},
        "destination": {"local": {"path": path, "dataFormat": "parquet", "buckets": 4}},
        "readDataType": "cdc",
        "writeDataType": "log",
        "writeOperation": "update",
    }
    most = rows.agg(F.max("offset")).first()[0] or 0
    for third in range(3):
        append_log(rows.where(F.floor(F.col("offset") * 3 / (most + 1)) == third), log)
        drain(spark, flow, checkpoint)
    return read_table(spark, path)


@query("SELECT * FROM orders")
def stream_per_batch_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches as static data into files; each is written a second time, as after a failure, and counts once."""
    path = storage.scratch_dir(spark, "per-batch")
    target = FileStore(path, "parquet", partition_by=["o_orderstatus"])

    class Twice(FileStore):
        def write(self, df, operation, data_type="log", tag=None):
            target.write(df, operation, data_type, tag)
            return target.write(df, operation, data_type, tag)

    drain(spark, {"source": {"local": directory_of(spark, sf_dir, "orders")}, "destination": Twice(path, "parquet"), "perBatch": True})
    return find_format("parquet").read(spark, path, table(spark, sf_dir, "orders").schema).select(*table(spark, sf_dir, "orders").columns)


@query("SELECT * FROM events")
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run twice with one checkpoint and an interval trigger: the second run adds the new rows only."""
    path, source, checkpoint = (storage.scratch_dir(spark, x) for x in ("restarted", "growing", "checkpoint"))
    events = table(spark, sf_dir, "events")
    flow = {
        "source": {"local": {"path": source, "dataFormat": "parquet"}},
        "destination": {"local": {"path": path, "dataFormat": "parquet"}},
        "triggerInterval": "100 milliseconds",
        "flowType": "stream",
        "checkpointLocation": checkpoint,
    }
    for half in (0, 1):
        events.where(F.col("event_id") % 2 == half).write.mode("append").parquet(source)
        query = run(spark, flow)
        query.processAllAvailable()
        query.stop()
    return find_format("parquet").read(spark, path)


@query(
    """SELECT event_id, user_id, event_type, CASE WHEN event_id % 2 = 1 THEN value END AS value,
       CASE WHEN event_id % 2 = 1 THEN event_type END AS inner_kind FROM events"""
)
def stream_infer_growing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that come with the second micro-batch, at the root and in a struct: rows before it have nulls there."""
    path, log, checkpoint = (storage.scratch_dir(spark, x) for x in ("growing", "log", "checkpoint"))
    events = table(spark, sf_dir, "events")
    early = F.struct("event_id", "user_id", "event_type", F.struct("user_id").alias("inner"))
    late = F.struct("event_id", "user_id", "event_type", "value", F.struct("user_id", F.col("event_type").alias("kind")).alias("inner"))
    flow = {
        "source": {"changelog": {"path": log}},
        "destination": {"local": {"path": path, "dataFormat": "parquet"}},
        "readDataType": "cdc",
        "writeDataType": "log",
        "growingSchema": True,
    }
    for half, value in enumerate((early, late)):
        rows = events.where(F.col("event_id") % 2 == half).select(value.alias("value"), F.col("event_id").alias("offset"))
        append_log(encode_json(rows, keep=["offset"]), log)
        drain(spark, flow, checkpoint)
    rows = find_format("parquet").read(spark, path, None, {"mergeSchema": "true"})
    return rows.select("event_id", "user_id", "event_type", "value", F.col("inner.kind").alias("inner_kind"))


@query(
    """SELECT count(*) AS read_rows, count(*) FILTER (WHERE event_type <> 'error') AS written_rows,
       count(*) FILTER (WHERE event_type <> 'error') AS stored_rows, true AS several_batches FROM events"""
)
def stream_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read and written by a stream of several micro-batches, as counted while it ran, beside those stored."""
    path, source, checkpoint = (storage.scratch_dir(spark, x) for x in ("counted", "parts", "checkpoint"))
    events = table(spark, sf_dir, "events")
    events.repartition(4, "event_id").write.parquet(source)
    with StreamRowCounts(spark) as counts:
        rows = find_format("parquet").read_stream(spark, source, events.schema, {"maxFilesPerTrigger": "1"})
        rows = counts.register(filter_rows(counts.register(rows, "read"), "event_type <> 'error'"), "written")
        writer = find_format("parquet").write_stream(rows, path).option("checkpointLocation", checkpoint)
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        totals, several = counts.totals(query), counts.batches(query) > 1
    stored = find_format("parquet").read(spark, path).agg(F.count("*").alias("stored_rows"))
    return stored.select(
        F.lit(totals["read"]).cast("long").alias("read_rows"), F.lit(totals["written"]).cast("long").alias("written_rows"), "stored_rows", F.lit(several).alias("several_batches")
    )
