"""Queries over the governance steps."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.catalogue.oracles import (
    EVENT_TYPES,
    PRIORITIES,
    crc32_of,
    murmur3_of_bigint,
    murmur3_of_text,
    sha512_of,
)
from sluiceway.catalogue.registry import query
from sluiceway.catalogue.tables import KEY_SCHEMA, VALUE_SCHEMA, change_log, table
from sluiceway.functions import column_names, field_type
from sluiceway.functions.nullability import require_not_null
from sluiceway.operators import (
    CHANGE,
    RowCounts,
    Step,
    apply_steps,
    augment_metadata,
    decode,
    digest_columns,
    encode_json,
    filter_rows,
    keep_all,
    lineage,
    load_steps,
    record_schema,
    redact_columns,
    remove_columns,
    sample_rows,
    unwrap,
    wrap,
)
from sluiceway.sources import storage
from sluiceway.sources.formats import PARQUET

FLAT_CHANGE = "CASE WHEN event_type <> 'error' THEN {} END"


def _flat(df: DataFrame) -> DataFrame:
    """Change data as plain columns, with a mark for delete markers."""
    inner = df.schema["value"].dataType.names
    fields = [F.col("value").getField(n).alias(f"value_{n}") for n in inner]
    return df.select(
        F.col("key.user_id").alias("key_user_id"), *fields, F.col("value").isNull().alias("deleted"), "offset"
    )


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders", name="remove_columns")
def remove_columns_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_columns(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority", "not_there"])


@query(
    f"""SELECT user_id AS key_user_id, {FLAT_CHANGE.format('user_id')} AS value_user_id,
        {FLAT_CHANGE.format('value')} AS value_value,
        coalesce(event_type = 'error', true) AS deleted, event_id AS "offset" FROM events"""
)
def remove_columns_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(remove_columns(change_log(spark, sf_dir), ["event_type"], form=CHANGE))


@query(
    """SELECT c_custkey, 'XXXXXXXXXX' AS c_name, c_nationkey, 'XXXXXXXXXX' AS c_acctbal, c_mktsegment
       FROM customer""",
    name="redact_columns",
)
def redact_columns_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redact_columns(table(spark, sf_dir, "customer"), ["c_name", "c_acctbal"])


@query("SELECT s_suppkey, '***' AS s_name, s_nationkey, s_acctbal FROM supplier")
def redact_custom_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redact_columns(table(spark, sf_dir, "supplier"), ["s_name"], "***")


@query(
    f"""SELECT user_id AS key_user_id, {FLAT_CHANGE.format('user_id')} AS value_user_id,
        {FLAT_CHANGE.format("'XXXXXXXXXX'")} AS value_event_type, {FLAT_CHANGE.format('value')} AS value_value,
        coalesce(event_type = 'error', true) AS deleted, event_id AS "offset" FROM events"""
)
def redact_change_keeps_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(redact_columns(change_log(spark, sf_dir), ["event_type"], form=CHANGE))


@query(
    f"""SELECT 'hidden' AS key_user_id, {FLAT_CHANGE.format("'hidden'")} AS value_user_id,
        {FLAT_CHANGE.format('event_type')} AS value_event_type, {FLAT_CHANGE.format('value')} AS value_value,
        coalesce(event_type = 'error', true) AS deleted, event_id AS "offset" FROM events"""
)
def redact_key_and_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(redact_columns(change_log(spark, sf_dir), ["user_id"], "hidden", form=CHANGE))


@query("SELECT doc_id, md5(text) AS text, lang, source, n_chars FROM documents")
def digest_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_columns(table(spark, sf_dir, "documents"), ["text"])


@query("SELECT conv_id, turn, role, sha1(text) AS text FROM conversations")
def digest_sha1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_columns(table(spark, sf_dir, "conversations"), ["text"], "sha1")


@query(
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
        {sha512_of('o_orderpriority', PRIORITIES)} AS o_orderpriority FROM orders"""
)
def digest_sha2_512(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_columns(table(spark, sf_dir, "orders"), ["o_orderpriority"], "sha2")


@query(f"SELECT p_partkey, {crc32_of('p_name')} AS p_name, {crc32_of('p_brand')} AS p_brand FROM part")
def digest_crc32(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return digest_columns(part, ["p_name", "p_brand"], "crc32")


@query(
    f"SELECT c_custkey AS id, {murmur3_of_bigint('c_custkey')} AS c_custkey, {murmur3_of_text('c_name')} AS c_name FROM customer"
)
def digest_murmur3(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_custkey", "c_name")
    return digest_columns(customer, ["c_custkey", "c_name"], "murmur3")


@query(
    f"""SELECT event_id, CASE WHEN event_type = 'error' THEN 42 ELSE {murmur3_of_text('event_type')} END AS event_type
        FROM events"""
)
def digest_murmur3_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", F.expr("nullif(event_type, 'error')").alias("event_type"))
    return digest_columns(events, ["event_type"], "murmur3")


@query("SELECT md5(o_orderkey::VARCHAR) AS o_orderkey, o_totalprice FROM orders")
def digest_of_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_columns(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])


@query(
    f"""SELECT md5(user_id::VARCHAR) AS key_user_id, {FLAT_CHANGE.format('md5(user_id::VARCHAR)')} AS value_user_id,
        {FLAT_CHANGE.format('md5(event_type)')} AS value_event_type, {FLAT_CHANGE.format('value')} AS value_value,
        coalesce(event_type = 'error', true) AS deleted, event_id AS "offset" FROM events"""
)
def digest_change_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(digest_columns(change_log(spark, sf_dir), ["user_id", "event_type"], form=CHANGE))


@query(
    f"""SELECT user_id AS key_user_id, {FLAT_CHANGE.format('user_id')} AS value_user_id,
        {FLAT_CHANGE.format(sha512_of('event_type', EVENT_TYPES))} AS value_event_type,
        {FLAT_CHANGE.format('value')} AS value_value,
        coalesce(event_type = 'error', true) AS deleted, event_id AS "offset" FROM events"""
)
def digest_change_sha2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(digest_columns(change_log(spark, sf_dir), ["event_type"], "sha2", form=CHANGE))


@query("SELECT * FROM lineitem WHERE l_quantity > 25 AND l_returnflag = 'R'", name="filter_rows")
def filter_rows_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_rows(table(spark, sf_dir, "lineitem"), "l_quantity > 25 AND l_returnflag = 'R'")


@query(
    """SELECT user_id AS key_user_id, user_id AS value_user_id, event_type AS value_event_type, value AS value_value,
       false AS deleted, event_id AS "offset" FROM events
       WHERE event_type <> 'error' AND user_id % 3 = 1 AND value > 10"""
)
def filter_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(filter_rows(change_log(spark, sf_dir), "key.user_id % 3 = 1 AND value.value > 10"))


@query(
    """SELECT event_id, user_id, event_type FROM events
       WHERE event_type LIKE '%i%' AND hour(ts) < 12 AND json_extract(props, '$.k')::BIGINT > 40 AND abs(value - 20) < 15"""
)
def filter_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    clause = (
        "event_type LIKE '%i%' AND hour(ts) < 12 "
        "AND CAST(get_json_object(props, '$.k') AS BIGINT) > 40 AND abs(value - 20) < 15"
    )
    return filter_rows(table(spark, sf_dir, "events"), clause).select("event_id", "user_id", "event_type")


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')"""
)
def filter_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "customer").createOrReplaceTempView("governed_customer")
    clause = "o_custkey IN (SELECT c_custkey FROM governed_customer WHERE c_mktsegment = 'MACHINERY')"
    return filter_rows(table(spark, sf_dir, "orders"), clause).select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT count(*) AS source_rows, true AS within_bounds, 0::BIGINT AS repeated, 0::BIGINT AS foreign_rows FROM events", name="sample_rows")
def sample_rows_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id")
    kept = sample_rows(events, fraction=0.25, seed=7)
    both = events.withColumn("kept", F.lit(0)).unionByName(kept.withColumn("kept", F.lit(1)))
    per_row = both.groupBy("event_id").agg(F.sum("kept").alias("kept"), F.sum(1 - F.col("kept")).alias("given"))
    return per_row.agg(
        F.sum("given").alias("source_rows"),
        (F.sum("kept") / F.sum("given")).between(0.2, 0.3).alias("within_bounds"),
        F.count(F.when((F.col("kept") > F.col("given")) & (F.col("given") > 0), 1)).alias("repeated"),
        F.count(F.when(F.col("given") == 0, 1)).alias("foreign_rows"),
    )


@query("SELECT * FROM pages")
def noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_all(table(spark, sf_dir, "pages"))


def large_orders(df: DataFrame) -> DataFrame:
    """A user's own step."""
    return df.filter(F.col("o_totalprice") > 100000).withColumn("large", F.lit(True))


@query("SELECT o_orderkey, o_totalprice, true AS large FROM orders WHERE o_totalprice > 100000")
def custom_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = load_steps([{"name": "own", "action": "class", "class": f"{__name__}:large_orders"}])
    return apply_steps(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), steps)


@query(
    """SELECT event_id, user_id, md5(event_type) AS event_type, 'XXXXXXXXXX' AS props FROM events
       WHERE event_type <> 'error' AND value > 5"""
)
def transform_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = load_steps(
        [
            {"name": "hide time", "action": "RemoveColumns", "columns": ["ts"]},
            {"name": "no errors", "action": "FilterRows", "options": {"clause": "event_type <> 'error'"}},
            {"name": "digest type", "action": "DigestColumns", "columns": ["event_type"]},
            {"name": "hide props", "action": "RedactColumns", "columns": ["props"]},
            {"name": "valuable", "action": "filterrows", "options": {"clause": "value > 5"}},
            {"name": "hide value", "action": "removecolumns", "columns": ["value"]},
        ]
    )
    return apply_steps(table(spark, sf_dir, "events"), steps)


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_tax > 0.02")
def merge_adjacent_removes(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = load_steps(
        [
            Step("a", "removecolumns", ("l_partkey", "l_suppkey")),
            Step("b", "removecolumns", ("l_extendedprice", "l_discount", "l_shipdate")),
            Step("c", "filterrows", options={"clause": "l_tax > 0.02"}),
            Step("d", "removecolumns", ("l_tax",)),
            Step("e", "removecolumns", ("l_returnflag", "l_linestatus")),
        ]
    )
    return apply_steps(table(spark, sf_dir, "lineitem"), steps)


@query(
    """SELECT 'c_name' AS column_name, 'Redact' AS action, 'hide name' AS step, 1 AS steps, count(*) AS filled FROM customer
       UNION ALL
       SELECT 'c_mktsegment', 'Digest sha1', 'digest segment', 2, count(*) FROM customer"""
)
def metadata_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamps read back from Parquet, with the filled cells of each stamped column."""
    steps = load_steps(
        [
            {"name": "hide name", "action": "redactcolumns", "columns": ["c_name"]},
            {"name": "hide segment", "action": "redactcolumns", "columns": ["c_mktsegment"]},
            {"name": "digest segment", "action": "digestcolumns", "columns": ["c_mktsegment"], "options": {"algo": "sha1"}},
        ]
    )
    path = storage.scratch_dir(spark, "stamped")
    PARQUET.write(apply_steps(table(spark, sf_dir, "customer"), steps), path)
    stored = PARQUET.read(spark, path)
    found = lineage(stored)
    counted = stored.agg(*[F.count(c).alias(c) for c in found])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(history[-1]["action"]).alias("action"),
            F.lit(history[-1]["name"]).alias("step"),
            F.lit(len(history)).alias("steps"),
            F.col(c).alias("filled"),
        )
        for c, history in found.items()
    ]
    return counted.select(F.inline(F.array(*rows)))


@query(
    """SELECT 'l_orderkey' AS column_name, 'long' AS avro_type, count(l_orderkey) AS filled FROM lineitem
       UNION ALL SELECT 'l_linenumber', 'int', count(l_linenumber) FROM lineitem
       UNION ALL SELECT 'l_tax', 'double', count(l_tax) FROM lineitem
       UNION ALL SELECT 'l_returnflag', 'string', count(l_returnflag) FROM lineitem
       UNION ALL SELECT 'l_shipdate', 'long:local-timestamp-micros', count(l_shipdate) FROM lineitem"""
)
def metadata_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type descriptions given to columns, with the filled cells of each."""
    names = ["l_orderkey", "l_linenumber", "l_tax", "l_returnflag", "l_shipdate"]
    described = augment_metadata(table(spark, sf_dir, "lineitem").select(*names))
    counted = described.agg(*[F.count(c).alias(c) for c in names])
    rows = []
    for f in described.schema.fields:
        kind = ":".join(f.metadata[k] for k in ("type", "logicalType") if k in f.metadata)
        rows.append(
            F.struct(F.lit(f.name).alias("column_name"), F.lit(kind).alias("avro_type"), F.col(f.name).alias("filled"))
        )
    return counted.select(F.inline(F.array(*rows)))


@query("SELECT count(*) AS row_count, count(*) FILTER (WHERE l_quantity > 25) AS kept FROM lineitem")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows counted while they are written, per registered DataFrame."""
    counts = RowCounts()
    lineitem = counts.register(table(spark, sf_dir, "lineitem"), "row_count")
    kept = counts.register(filter_rows(lineitem, "l_quantity > 25"), "kept")
    path = storage.scratch_dir(spark, "counted")
    PARQUET.write(kept, path)
    found = counts.counts()
    return spark.range(1).select(*[F.lit(found[n]).cast("bigint").alias(n) for n in ("row_count", "kept")])


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def not_null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    wrapped = wrap(require_not_null(orders, "o_totalprice"), ["o_orderkey"])
    checked = require_not_null(require_not_null(wrapped, "key.o_orderkey"), "value.o_custkey")
    return unwrap(checked)


def _values_per_column(df: DataFrame, described: dict[str, tuple]) -> DataFrame:
    """One row per column name: what is said of it, and how many values it has."""
    counted = df.agg(*[F.count(path).alias(f"n{k}") for k, path in enumerate(described)])
    rows = [F.struct(F.lit(path).alias("column"), *[F.lit(x).alias(f"c{i}") for i, x in enumerate(said)], F.col(f"n{k}").alias("n_values")) for k, (path, said) in enumerate(described.items())]
    return counted.select(F.inline(F.array(*rows)))


@query(
    """SELECT * FROM (SELECT 'o_orderkey' AS "column", 'long' AS type, count(o_orderkey) AS n_values FROM orders
       UNION ALL SELECT 'o_custkey', 'long', count(o_custkey) FROM orders
       UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
       UNION ALL SELECT 'o_totalprice', 'double', count(o_totalprice) FROM orders
       UNION ALL SELECT 'o_orderdate', 'long', count(o_orderdate) FROM orders
       UNION ALL SELECT 'o_orderpriority', 'string', count(o_orderpriority) FROM orders)"""
)
def metadata_record_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of a table's record schema, with the number of values each has."""
    orders = augment_metadata(table(spark, sf_dir, "orders"))
    fields = json.loads(record_schema(orders, "orders"))["fields"]
    kinds = {f["name"]: f["type"][0] if isinstance(f["type"], list) else f["type"] for f in fields}
    return _values_per_column(orders, {name: (kind["type"],) for name, kind in kinds.items()}).withColumnRenamed("c0", "type")


@query(
    """SELECT 'key.user_id' AS "column", 'bigint' AS type, 1 AS siblings, count(user_id) AS n_values FROM events
       UNION ALL SELECT 'value.event_type', 'string', 3, count(CASE WHEN event_type <> 'error' THEN event_type END) FROM events
       UNION ALL SELECT 'value.value', 'double', 3, count(CASE WHEN event_type <> 'error' THEN value END) FROM events
       UNION ALL SELECT 'offset', 'bigint', 3, count(event_id) FROM events"""
)
def metadata_accessors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types and neighbours of columns at the root and in structs of a change log."""
    changes = change_log(spark, sf_dir)
    said = {}
    for path in ("key.user_id", "value.event_type", "value.value", "offset"):
        parent = path.rpartition(".")[0] or None
        said[path] = (field_type(changes, path).simpleString(), len(column_names(changes, parent)))
    return _values_per_column(changes, said).withColumnsRenamed({"c0": "type", "c1": "siblings"})


@query(
    """SELECT 'value' AS given, true AS accepted, count(*) AS decoded FROM events
       UNION ALL SELECT 'key and value', true, count(*) FROM events
       UNION ALL SELECT 'nothing', true, count(*) FROM events
       UNION ALL SELECT 'key', false, 0
       UNION ALL SELECT 'value and registry', false, 0
       UNION ALL SELECT 'key, value and registry', false, 0"""
)
def schema_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which ways of giving schemas are accepted, and how many changes each decodes."""
    rows = encode_json(change_log(spark, sf_dir), keep=["offset"])
    known = {"value": {1: "{}"}}
    given = {
        "value": {"value_schema": VALUE_SCHEMA},
        "key and value": {"value_schema": VALUE_SCHEMA, "key_schema": KEY_SCHEMA},
        "nothing": {},
        "key": {"key_schema": KEY_SCHEMA},
        "value and registry": {"fmt": "avro", "value_schema": "{}", "registry": known},
        "key, value and registry": {"fmt": "avro", "value_schema": "{}", "key_schema": "{}", "registry": known},
    }
    found = []
    for name, settings in given.items():
        try:
            decoded = decode(rows, **settings)
        except ValueError:
            found.append(spark.range(1).select(F.lit(name).alias("given"), F.lit(False).alias("accepted"), F.lit(0).cast("long").alias("decoded")))
            continue
        # Every change is decoded for its count, deletes as well.
        seen = decoded.agg(F.count("*").alias("decoded"), F.count("value.user_id").alias("values"))
        found.append(seen.select(F.lit(name).alias("given"), F.lit(True).alias("accepted"), "decoded"))
    return reduce(DataFrame.union, found)
