"""Queries over envelopes, serialization, snapshots and updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.catalogue.registry import query
from sluiceway.catalogue.tables import (
    KEY_SCHEMA,
    SNAPSHOT_SQL,
    TOPIC_PARTITIONS,
    VALUE_SCHEMA,
    change_log,
    table,
    topic_of_changes,
)
from sluiceway.functions.framing import schema_id
from sluiceway.operators import (
    apply_changes,
    apply_steps,
    change_pair,
    decode_json,
    decode_json_inferred,
    encode_json,
    inspect_raw,
    load_steps,
    snapshot,
    snapshot_binary,
    unwrap,
    wrap,
)
from sluiceway.sources import storage
from sluiceway.sources.formats import find_format
from sluiceway.sources.tables import read_table, update_table
from sluiceway.sources.changelog import append_log, read_log

ORDERS_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)
EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@query("SELECT * FROM orders")
def wrap_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unwrap(wrap(table(spark, sf_dir, "orders")))


@query("SELECT o_orderkey AS key_orderkey, o_custkey AS key_custkey, o_totalprice AS value_totalprice FROM orders")
def wrap_with_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrapped = wrap(table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey"])
    return wrapped.select(
        F.col("key.o_orderkey").alias("key_orderkey"),
        F.col("key.o_custkey").alias("key_custkey"),
        F.col("value.o_totalprice").alias("value_totalprice"),
    )


@query("SELECT user_id AS key_user_id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type FROM events")
def change_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = change_pair(change_log(spark, sf_dir))
    return pairs.select(F.col("key.user_id").alias("key_user_id"), "value.event_type")


@query("SELECT * FROM events")
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_json(wrap(table(spark, sf_dir, "events"), ["event_id"]))
    return unwrap(decode_json(encoded, EVENTS_SCHEMA, "event_id bigint"))


@query("SELECT * FROM orders")
def json_value_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unwrap(decode_json(encode_json(wrap(table(spark, sf_dir, "orders"))), ORDERS_SCHEMA))


@query("SELECT * FROM documents")
def json_whole_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    encoded = encode_json(wrap(documents, ["doc_id"]))
    return unwrap(decode_json(encoded, documents.schema, "doc_id bigint"))


@query("SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events")
def json_given_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("value"))
    return decode_json(events, "k bigint").select("event_id", "value.k")


@query("SELECT json_extract(props, '$.k')::BIGINT AS k FROM events")
def json_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.lit(None).cast("binary").alias("key"), F.col("props").alias("value"))
    return unwrap(decode_json_inferred(events))


@query(
    """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN event_id + 0.5 ELSE event_id END::DOUBLE AS amount,
       CASE WHEN event_id % 5 = 0 THEN event_type END AS event_type FROM events"""
)
def json_infer_drifting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most rows lack a field, and a number is fractional in some."""
    amount = F.when(F.col("event_id") % 7 == 0, F.concat("event_id", F.lit(".5"))).otherwise(F.col("event_id").cast("string"))
    kind = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit(', "event_type": "'), "event_type", F.lit('"'))).otherwise("")
    text = F.concat(F.lit('{"event_id": '), "event_id", F.lit(', "amount": '), amount, kind, F.lit("}"))
    rows = table(spark, sf_dir, "events").select(text.alias("value"))
    return unwrap(decode_json_inferred(rows)).select("event_id", "amount", "event_type")


@query(
    """SELECT o_orderkey, (9223372036854775000 + o_orderkey % 800)::VARCHAR || CASE WHEN o_orderkey % 2 = 0 THEN '.5' ELSE '.0' END AS wide,
       (o_orderkey % 1000 + CASE WHEN o_orderkey % 3 = 0 THEN 0.25 ELSE 0 END)::DOUBLE AS narrow,
       repeat('7', 30) || printf('%015d', o_orderkey) AS long FROM orders"""
)
def json_infer_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers at the end of a bigint beside fractions, plain numbers beside fractions, and 45 digits."""
    key = F.col("o_orderkey")
    wide = F.concat((F.lit(9223372036854775000) + key % 800).cast("string"), F.when(key % 2 == 0, ".5").otherwise(""))
    narrow = F.concat((key % 1000).cast("string"), F.when(key % 3 == 0, ".25").otherwise(""))
    long = F.concat(F.lit("7" * 30), F.lpad(key.cast("string"), 15, "0"))
    text = F.concat(F.lit('{"o_orderkey": '), key, F.lit(', "wide": '), wide, F.lit(', "narrow": '), narrow, F.lit(', "long": '), long, F.lit("}"))
    rows = unwrap(decode_json_inferred(table(spark, sf_dir, "orders").select(text.alias("value"))))
    return rows.select("o_orderkey", F.col("wide").cast("string").alias("wide"), "narrow", "long")


@query(
    """SELECT event_id, CASE WHEN event_id % 11 > 1 THEN user_id END AS user_id,
       CASE event_id % 11 WHEN 0 THEN '{broken' WHEN 1 THEN '' END AS malformed FROM events"""
)
def json_malformed_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed and empty texts are neither rows of nulls nor deletes."""
    broken = F.when(F.col("event_id") % 11 == 0, "{broken").when(F.col("event_id") % 11 == 1, "")
    text = F.coalesce(broken, F.concat(F.lit('{"user_id": '), "user_id", F.lit("}")))
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("value"))
    decoded = decode_json(rows, "user_id bigint", malformed="keep")
    return decoded.where("value IS NOT NULL").select("event_id", "value.user_id", "malformed")


@query("SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_custkey AS key_custkey FROM customer")
def json_infer_key_and_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    decoded = decode_json_inferred(encode_json(wrap(customer, ["c_custkey"])))
    return decoded.select("value.*", F.col("key.c_custkey").alias("key_custkey")).select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "key_custkey"
    )


@query(
    """SELECT user_id AS key_user_id, event_type IS DISTINCT FROM 'error' AS alive,
       CASE WHEN event_type <> 'error' THEN value END AS value FROM events"""
)
def json_keeps_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_json(encode_json(change_log(spark, sf_dir)), VALUE_SCHEMA, KEY_SCHEMA)
    return decoded.select(
        F.col("key.user_id").alias("key_user_id"), F.col("value").isNotNull().alias("alive"), "value.value"
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 IN (1, 2) THEN -1
       ELSE (o_custkey * 65537 % 4294967296)::BIGINT
            - CASE WHEN o_custkey * 65537 % 4294967296 >= 2147483648 THEN 4294967296 ELSE 0 END END::INTEGER AS schema_id
       FROM orders""",
    name="schema_id",
)
def schema_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames made from orders: missing, too short, with a wrong first byte, and valid."""
    identifier = F.lpad(F.hex(F.expr("o_custkey * 65537 % 4294967296")), 8, "0")
    valid = F.unhex(F.concat(F.lit("00"), identifier, F.hex("o_orderpriority")))
    kind = F.col("o_orderkey") % 5
    framed = (
        F.when(kind == 0, F.lit(None).cast("binary"))
        .when(kind == 1, F.substring(valid, 1, 4))
        .when(kind == 2, F.concat(F.unhex(F.lit("01")), F.substring(valid, 2, 100)))
        .otherwise(valid)
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", schema_id(framed).alias("schema_id"))


@query(
    """SELECT user_id AS key_user_id, 7 AS key_schema_id, CASE WHEN event_type <> 'error' THEN 9 END AS value_schema_id,
       CASE WHEN event_type <> 'error' THEN event_type END AS event_type FROM events"""
)
def raw_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The debug view of framed JSON."""
    encoded = encode_json(change_log(spark, sf_dir))
    framed = encoded.select(
        F.concat(F.unhex(F.lit("0000000007")), F.col("key").cast("binary")).alias("key"),
        F.concat(F.unhex(F.lit("0000000009")), F.col("value").cast("binary")).alias("value"),
    )
    raw = inspect_raw(framed, VALUE_SCHEMA, KEY_SCHEMA)
    return raw.select(
        F.col("data_key.user_id").alias("key_user_id"), "key_schema_id", "value_schema_id", "data_value.event_type"
    )


@query(SNAPSHOT_SQL, name="snapshot")
def snapshot_of_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot(change_log(spark, sf_dir))


@query(
    """SELECT hex(encode(user_id::VARCHAR || '/' || event_type)) AS value
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS latest FROM events)
       WHERE latest = 1 AND event_type <> 'error'""",
    name="snapshot_binary",
)
def snapshot_of_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undecoded values; shown as hex, which compares the same everywhere."""
    text = F.concat(F.col("user_id").cast("string"), F.lit("/"), F.col("event_type"))
    log = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.when(F.col("event_type") != "error", text.cast("binary")).alias("value"),
        F.col("event_id").alias("offset"),
    )
    return snapshot_binary(log).select(F.hex("value").alias("value"))


@query(
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS latest FROM orders)
       WHERE latest = 1"""
)
def snapshot_by_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last order of each customer: an order other than by offset."""
    orders = table(spark, sf_dir, "orders")
    log = orders.select(
        F.struct("o_custkey").alias("key"),
        F.struct("o_custkey", "o_orderkey", "o_totalprice").alias("value"),
        "o_orderdate",
        "o_orderkey",
    )
    return snapshot(log, order_by=["o_orderdate", "o_orderkey"])


@query(
    f"""SELECT md5(user_id::VARCHAR) AS user_id, 'XXXXXXXXXX' AS event_type, value
        FROM ({SNAPSHOT_SQL}) WHERE value > 10"""
)
def snapshot_then_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter after the snapshot must not bring earlier values back."""
    steps = load_steps(
        [
            {"name": "valuable", "action": "filterrows", "options": {"clause": "value > 10"}},
            {"name": "hide type", "action": "redactcolumns", "columns": ["event_type"]},
            {"name": "digest user", "action": "digestcolumns", "columns": ["user_id"]},
        ]
    )
    return apply_steps(snapshot(change_log(spark, sf_dir)), steps)


CUSTOMER_CHANGES_SQL = """
    WITH latest AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM orders) WHERE n = 1)
    SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM latest)
    UNION ALL
    SELECT o_custkey, o_orderpriority, (o_orderkey % 25)::INTEGER, o_totalprice, o_orderstatus FROM latest WHERE o_orderstatus <> 'F'
"""


def _customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changes of whole customers: the last one counts, a finished one deletes."""
    value = F.struct(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderpriority").alias("c_name"),
        (F.col("o_orderkey") % 25).cast("int").alias("c_nationkey"),
        F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderstatus").alias("c_mktsegment"),
    )
    return table(spark, sf_dir, "orders").select(
        F.struct(F.col("o_custkey").alias("c_custkey")).alias("key"),
        F.when(F.col("o_orderstatus") != "F", value).alias("value"),
        F.col("o_orderkey").alias("offset"),
    )


@query(CUSTOMER_CHANGES_SQL, name="apply_changes")
def apply_changes_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_changes(table(spark, sf_dir, "customer"), _customer_changes(spark, sf_dir))


@query(CUSTOMER_CHANGES_SQL)
def update_file_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same change set applied to a stored table, twice: the second time changes nothing."""
    path = storage.scratch_dir(spark, "customers")
    table(spark, sf_dir, "customer").write.parquet(path)
    for _ in range(2):
        update_table(_customer_changes(spark, sf_dir), path)
    return read_table(spark, path)


PRIORITY_CHANGES_SQL = """
    WITH latest AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 2, o_orderkey DESC) AS n FROM orders) WHERE n = 1)
    SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM latest)
    UNION ALL
    SELECT o_custkey, o_orderpriority, (o_orderkey % 25)::INTEGER, o_totalprice, o_orderstatus FROM latest WHERE o_orderstatus <> 'F'
"""


@query(PRIORITY_CHANGES_SQL)
def update_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two change sets applied to a table in buckets of its key; even orders come last."""
    path = storage.scratch_dir(spark, "customers-in-buckets")
    table(spark, sf_dir, "customer").write.parquet(path)
    for parity in (1, 0):
        update_table(_customer_changes(spark, sf_dir).where(F.col("offset") % 2 == parity), path, buckets=8)
    return read_table(spark, path)


@query(
    """SELECT printf('%08d', p_partkey) AS code, p_name,
       CASE WHEN p_size % 3 = 0 THEN printf('%03d', p_size) ELSE p_brand END AS p_brand, p_type,
       CASE WHEN p_size % 3 = 0 THEN '1e' || p_size ELSE printf('%04d', p_size) END AS size
       FROM part WHERE p_size % 3 <> 1"""
)
def update_csv_keeps_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that look like numbers, in a CSV table of which an update rewrites all rows."""
    path, fmt = storage.scratch_dir(spark, "parts"), find_format("csv")
    part = table(spark, sf_dir, "part")
    code, size = F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("code"), F.col("p_size").cast("string")
    fmt.write(part.select(code, "p_name", "p_brand", "p_type", F.lpad(size, 4, "0").alias("size")), path)
    value = F.struct(code, "p_name", F.lpad(size, 3, "0").alias("p_brand"), "p_type", F.concat(F.lit("1e"), size).alias("size"))
    changes = part.where("p_size % 3 < 2").select(
        F.struct(code).alias("key"), F.when(F.col("p_size") % 3 == 0, value).alias("value"), F.col("p_partkey").cast("long").alias("offset")
    )
    update_table(changes, path, fmt)
    return read_table(spark, path, fmt, "code string, p_name string, p_brand string, p_type string, size string")


LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"]


@query(
    f"""WITH latest AS (
          SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_linestatus, l_orderkey
                         ORDER BY {", ".join(c + " DESC" for c in LINE_ORDER)}) AS n FROM lineitem) WHERE n = 1)
        SELECT o_orderstatus, o_orderkey, o_totalprice FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM latest WHERE l_linestatus = o_orderstatus AND l_orderkey = o_orderkey)
        UNION ALL
        SELECT l_linestatus, l_orderkey, l_extendedprice FROM latest WHERE l_returnflag <> 'R'"""
)
def update_partitioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as changes of orders, in a table partitioned by a part of the key; one partition has none."""
    path = storage.scratch_dir(spark, "orders")
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    orders.write.partitionBy("o_orderstatus").parquet(path)
    key = [F.col("l_linestatus").alias("o_orderstatus"), F.col("l_orderkey").alias("o_orderkey")]
    value = F.struct(*key, F.col("l_extendedprice").alias("o_totalprice"))
    changes = table(spark, sf_dir, "lineitem").select(
        F.struct(*key).alias("key"), F.when(F.col("l_returnflag") != "R", value).alias("value"), *LINE_ORDER
    )
    update_table(changes, path, partition_by=["o_orderstatus"], order_by=LINE_ORDER, rebalance=True)
    return read_table(spark, path, schema=orders.schema).select(*orders.columns)


@query(
    f"""SELECT event_id, (user_id % {TOPIC_PARTITIONS})::INTEGER AS "partition",
        row_number() OVER (PARTITION BY user_id % {TOPIC_PARTITIONS} ORDER BY event_id) - 1 AS "offset" FROM events"""
)
def topic_append_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's partition and offset, with the partition given by the data."""
    events = table(spark, sf_dir, "events").withColumn("partition", F.col("user_id") % TOPIC_PARTITIONS)
    rows = events.select(F.col("event_id").cast("string").alias("value"), "partition", "event_id")
    path = storage.scratch_dir(spark, "topic")
    append_log(rows, path, TOPIC_PARTITIONS, "event_id")
    stored = read_log(spark, path)
    return stored.select(F.col("value").cast("string").cast("bigint").alias("event_id"), "partition", "offset")


@query(
    """SELECT count(*) * 2 AS row_count, count(DISTINCT user_id) AS keys, 0::BIGINT AS split_keys,
       0::BIGINT AS missing_offsets, 0::BIGINT AS repeated_offsets FROM events"""
)
def topic_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions by key: no key is split, and offsets run on without a gap."""
    path = storage.scratch_dir(spark, "topic")
    for partitions in (TOPIC_PARTITIONS, None):
        append_log(encode_json(change_log(spark, sf_dir), keep=["offset"]), path, partitions, "offset", number=True)
    per_key = read_log(spark, path).groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("partition").alias("first"),
        F.max("partition").alias("last"),
    )
    keys = per_key.select(
        F.col("n").alias("row_count"),
        F.lit(1).alias("keys"),
        F.when(F.col("first") != F.col("last"), 1).otherwise(0).alias("split_keys"),
        F.lit(0).alias("missing_offsets"),
        F.lit(0).alias("repeated_offsets"),
    )
    offsets = read_log(spark, path).groupBy("partition", "offset").agg(F.count(F.lit(1)).alias("n"))
    per_partition = offsets.groupBy("partition").agg(
        (F.max("offset") + 1 - F.count(F.lit(1))).alias("missing"), F.sum(F.col("n") - 1).alias("repeated")
    )
    partitions = per_partition.select(
        F.lit(0).alias("row_count"),
        F.lit(0).alias("keys"),
        F.lit(0).alias("split_keys"),
        F.col("missing").alias("missing_offsets"),
        F.col("repeated").alias("repeated_offsets"),
    )
    both = keys.unionByName(partitions)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


@query(SNAPSHOT_SQL)
def topic_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through a change log in files and its offsets."""
    rows = read_log(spark, topic_of_changes(spark, sf_dir))
    return snapshot(decode_json(rows, VALUE_SCHEMA, KEY_SCHEMA))
