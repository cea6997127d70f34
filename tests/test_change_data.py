from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from helpers import CHANGE_ROWS, LAST_ROWS, LIVE_ROWS, LOG_ROWS, VALUE_DDL, change_data, last_of, log_data, plan_of, rows_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from sluiceway.functions import frame, payload, schema_id
from sluiceway.functions import digest
from sluiceway.operators import (
    ConnectorMissing,
    apply_changes,
    change_pair,
    choose_format,
    decode,
    decode_avro,
    decode_json,
    decode_json_inferred,
    encode,
    encode_avro,
    encode_json,
    inspect_raw,
    latest_changes,
    snapshot,
    snapshot_binary,
    unwrap,
    wrap,
)

KEY_DDL = "i int"


def test_wrap(spark):
    wrapped = wrap(log_data(spark), ["i"])
    assert wrapped.columns == ["key", "value"]
    assert not wrapped.schema["key"].nullable and not wrapped.schema["value"].nullable
    assert rows_of(unwrap(wrapped)) == LOG_ROWS
    assert wrap(log_data(spark)).columns == ["value"]
    with pytest.raises(ValueError):
        wrap(log_data(spark), ["nope"])


def test_wrap_of_columns_called_key_and_value(spark):
    odd = spark.createDataFrame([(1, 2)], ["key", "value"])
    assert rows_of(unwrap(wrap(odd, ["key"]))) == [(1, 2)]
    assert rows_of(wrap(odd, ["key"]).select("key.key")) == [(1,)]


def test_unwrap_of_deletes(spark):
    assert unwrap(change_data(spark)).filter("i IS NULL AND s IS NULL").count() == len(CHANGE_ROWS) - len(LIVE_ROWS)
    assert unwrap(change_data(spark), drop_tombstones=True).count() == len(LIVE_ROWS)
    with pytest.raises(ValueError):
        unwrap(spark.range(1))


def test_change_pair(spark):
    assert change_pair(change_data(spark)).columns == ["key", "value"]
    with pytest.raises(ValueError):
        change_pair(spark.range(1))


def test_json_given_schemas(spark):
    encoded = encode_json(change_data(spark))
    assert [f.dataType.simpleString() for f in encoded.schema] == ["string", "string"]
    both = decode_json(encoded, VALUE_DDL, KEY_DDL)
    expected = sorted(((v or (None,) * 3) for _, v in CHANGE_ROWS), key=repr)
    assert rows_of(both.select("value.*")) == expected
    assert both.filter("value IS NULL").count() == len(CHANGE_ROWS) - len(LIVE_ROWS)
    value_only = decode_json(encoded.withColumn("key", F.col("key").cast("binary")), VALUE_DDL)
    assert value_only.schema["key"].dataType.simpleString() == "binary"


def test_json_schema_spellings(spark):
    encoded = encode_json(wrap(log_data(spark)))
    spark_json = log_data(spark).schema.json()
    for schema in (VALUE_DDL, spark_json, StructType.fromJson(json.loads(spark_json))):
        assert rows_of(unwrap(decode_json(encoded, schema))) == LOG_ROWS


def test_json_inferred(spark):
    encoded = encode_json(wrap(log_data(spark), ["i"]))
    decoded = decode_json_inferred(encoded)
    assert decoded.schema["value"].dataType.simpleString() == "struct<d:double,i:bigint,s:string>"
    assert decoded.schema["key"].dataType.simpleString() == "struct<i:bigint>"
    assert rows_of(decoded.select("value.i", "value.s", "value.d")) == LOG_ROWS


@pytest.mark.parametrize("key", ["CAST(NULL AS BINARY)", "NULL"])
def test_json_inferred_without_key(spark, key):
    encoded = encode_json(wrap(log_data(spark))).select(F.expr(key).alias("key"), "value")
    decoded = decode_json_inferred(encoded)
    assert not isinstance(decoded.schema["key"].dataType, StructType)
    assert rows_of(decoded.select("value.i", "value.s", "value.d")) == LOG_ROWS


def test_json_inference_skips_deletes_and_needs_data(spark):
    only_deleted = encode_json(change_data(spark)).filter("value IS NULL")
    with pytest.raises(ValueError, match="infer"):
        decode_json_inferred(only_deleted)
    first_deleted = only_deleted.unionByName(encode_json(change_data(spark)))
    assert decode_json_inferred(first_deleted).filter("value IS NULL").count() == 2 * (len(CHANGE_ROWS) - len(LIVE_ROWS))


def test_json_inferred_from_all_rows(spark):
    texts = ['{"a":1}', '{"a":1.5,"b":"x"}', None, '{"a":2,"c":{"d e":[1]},"f":1}', '{"f":"text","g":null}', '{"n":123456789012345678901}']
    rows = [(str(i), t) for i, t in enumerate(texts)]
    decoded = decode_json_inferred(spark.createDataFrame(rows, "key string, value string").withColumn("key", F.concat(F.lit('{"k":'), "key", F.lit("}"))))
    kinds = {f.name: f.dataType.simpleString() for f in decoded.schema["value"].dataType.fields}
    assert kinds == {"a": "double", "b": "string", "c": "struct<d e:array<bigint>>", "f": "string", "g": "string", "n": "decimal(21,0)"}
    found = {r["key"]["k"]: r["value"] for r in decoded.collect()}
    assert found[2] is None and found[0]["a"] == 1.0 and found[1]["b"] == "x" and found[3]["f"] == "1" and found[4]["f"] == "text"


@pytest.mark.parametrize("text", ["{broken", "", " ", '{"i":"x"}', '{"i":1.5}'])
def test_malformed_json(spark, text):
    rows = spark.createDataFrame([("1", '{"i":1}'), ("2", text), ("3", None)], "key string, value string")
    with pytest.raises(Exception, match="MALFORMED|no JSON"):
        decode_json(rows, "i bigint").collect()
    kept = {r["key"]: r for r in decode_json(rows, "i bigint", malformed="keep").collect()}
    assert kept["2"]["malformed"] == text and kept["2"]["value"] is not None and kept["2"]["value"]["i"] is None
    assert kept["3"]["value"] is None and kept["3"]["malformed"] is None
    assert kept["1"]["value"]["i"] == 1 and kept["1"]["malformed"] is None


def test_fields_beyond_the_listed_ones_fail(spark):
    rows = spark.createDataFrame([('{"i":1,"j":2}',)], "value string")
    assert decode_json(rows, "i bigint", fields={"value": ["i", "j"]}).count() == 1
    with pytest.raises(PySparkException, match="lacks: j"):
        decode_json(rows, "i bigint", fields={"value": ["i"]}).collect()


def test_nested_digests_see_microseconds(spark):
    rows = spark.sql("SELECT struct(t) AS s FROM VALUES (timestamp'2024-01-02 03:04:05.678901'), (timestamp'2024-01-02 03:04:05.678902') AS v(t)")
    assert rows.select(digest(F.col("s"), rows.schema["s"].dataType)).distinct().count() == 2


def test_json_keeps_microseconds(spark):
    times = spark.sql("SELECT timestamp_ntz'2024-01-02 03:04:05.678901' AS n, timestamp'2024-01-02 03:04:05.678901' AS t")
    encoded = encode_json(wrap(times))
    assert rows_of(unwrap(decode_json(encoded, "n timestamp_ntz, t timestamp"))) == rows_of(times)
    plain = spark.sql("""SELECT '{"n": "2024-01-02T03:04:05", "t": "2024-01-02T03:04:05Z"}' AS value""")
    row = unwrap(decode_json(plain, "n timestamp_ntz, t timestamp")).head(1)[0]
    assert row["n"].second == 5 and row["t"] is not None


def test_bytes_pass_unchanged(spark):
    raw = spark.sql("SELECT CAST('k' AS BINARY) AS key, CAST('v' AS BINARY) AS value")
    assert rows_of(encode(raw)) == [(bytearray(b"k"), bytearray(b"v"))]


def test_invalid_schema_combinations(spark):
    data = encode_json(change_data(spark))
    with pytest.raises(ValueError):
        decode(data, key_schema=KEY_DDL)
    registered = {"value": {1: "{}"}}
    with pytest.raises(ValueError):
        decode(data, "avro", value_schema="{}", registry=registered)
    with pytest.raises(ValueError):
        decode(data, "avro")
    with pytest.raises(ValueError):
        encode(change_data(spark), "avro", value_schema="{}")


def avro_present(spark):
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst")
        return True
    except Exception:
        return False


def test_avro_is_guarded(spark):
    schema = '{"type": "record", "name": "v", "fields": [{"name": "i", "type": ["int", "null"]}]}'
    data = wrap(log_data(spark).select("i"))
    if avro_present(spark):
        encoded = encode_avro(data, schema)
        assert rows_of(unwrap(decode_avro(encoded, schema))) == [(1,), (2,), (3,)]
        registered = {"value": {7: schema}}
        framed = encode_avro(data, registry=registered)
        assert rows_of(unwrap(decode_avro(framed, registry=registered))) == [(1,), (2,), (3,)]
        return
    with pytest.raises(ConnectorMissing):
        encode_avro(data, schema).collect()
    with pytest.raises(ConnectorMissing):
        decode_avro(encode_json(data), schema).collect()


def test_choose_format():
    json_class = "io.confluent.kafka.serializers.json.KafkaJsonSchemaDeserializer"
    avro_class = "io.confluent.kafka.serializers.KafkaAvroDeserializer"
    assert choose_format() == "json"
    assert choose_format("AVRO", "json") == "avro"
    assert choose_format(None, "avro") == "avro"
    assert choose_format(key_deserializer=json_class, value_deserializer=json_class) == "json"
    assert choose_format(key_deserializer=avro_class) == "avro"
    with pytest.raises(ValueError):
        choose_format(key_deserializer=json_class)
    with pytest.raises(ValueError):
        choose_format("xml")


def test_schema_id(spark):
    cases = [
        (b"\x00\x00\x00\x00\x01", 1),
        (b"\x01\x00\x00\x00\x01", -1),
        (b"\x00\x01", -1),
        (b"", -1),
        (None, None),
        (b"\x00\x7f\xff\xff\xff rest", 2**31 - 1),
        (b"\x00\xff\xff\xff\xff", -1),
        (b"\x00\x80\x00\x00\x00", -(2**31)),
    ]
    data = spark.createDataFrame([(bytearray(b) if b is not None else None, e) for b, e in cases], "b binary, e int")
    for row in data.select(schema_id(F.col("b")).alias("id"), "e").collect():
        assert row["id"] == row["e"]


def test_frame_and_payload(spark):
    data = spark.createDataFrame([(bytearray(b"abc"),), (None,)], "b binary")
    framed = data.select(frame(F.col("b"), 258).alias("b"))
    assert rows_of(framed.select(schema_id(F.col("b")))) == [(258,), (None,)]
    assert rows_of(framed.select(payload(F.col("b")))) == rows_of(data)
    assert rows_of(data.select(payload(F.col("b")))) == rows_of(data)


def test_raw_view(spark):
    encoded = encode_json(change_data(spark)).withColumn("value", frame(F.col("value").cast("binary"), 5))
    raw = inspect_raw(encoded.withColumn("key", F.col("key").cast("binary")), VALUE_DDL, KEY_DDL)
    assert raw.columns == ["key", "value", "data_key", "data_value", "key_schema_id", "value_schema_id"]
    live = raw.filter("value IS NOT NULL")
    assert rows_of(live.select("key_schema_id", "value_schema_id").distinct()) == [(-1, 5)]
    assert sorted(r["s"] for r in live.select("data_value.s").collect()) == sorted(s for _, s, _ in LIVE_ROWS)


def test_snapshot(spark):
    assert rows_of(snapshot(change_data(spark))) == LAST_ROWS


def test_snapshot_binary(spark):
    values = [(1, b"123"), (2, b"456"), (3, b"789"), (2, b"546"), (1, b"213"), (3, None), (1, b"321"), (4, b"abc")]
    data = spark.createDataFrame(
        [(bytearray([k]), None if v is None else bytearray(v), o) for o, (k, v) in enumerate(values)],
        "key binary, value binary, offset bigint",
    )
    result = snapshot_binary(data)
    assert result.columns == ["value"]
    assert sorted(bytes(r["value"]) for r in result.collect()) == [b"321", b"546", b"abc"]


def test_snapshot_edges(spark):
    rows = [((None,), (1, "x", 1.0)), ((None,), (2, "y", 2.0))]
    assert rows_of(snapshot(change_data(spark, rows))) == [(2, "y", 2.0)]
    negative = change_data(spark).withColumn("offset", F.lit(-1).cast("bigint"))
    with pytest.raises(PySparkException, match="negative offset"):
        snapshot(negative).collect()
    with pytest.raises(PySparkException, match="without an offset"):
        snapshot(change_data(spark).withColumn("offset", F.lit(None).cast("bigint"))).collect()
    with pytest.raises(ValueError, match="order_by"):
        snapshot(change_data(spark).drop("offset"))


def test_snapshot_ties_and_other_orders(spark):
    tied = change_data(spark, CHANGE_ROWS[:6]).withColumn("partition", F.col("offset").cast("int"))
    tied = tied.withColumn("offset", F.lit(5).cast("bigint"))
    assert rows_of(snapshot(tied)) == last_of(CHANGE_ROWS[:6])
    renamed = change_data(spark).withColumnsRenamed({"offset": "seq"})
    assert rows_of(snapshot(renamed, order_by="seq")) == LAST_ROWS
    assert rows_of(snapshot(renamed.withColumn("day", F.lit(1)), order_by=["day", "seq"])) == LAST_ROWS


def test_keys_that_are_equal_but_not_identical(spark):
    data = spark.sql(
        """SELECT struct(k) AS key, struct(n) AS value, n AS offset FROM VALUES
           (0.0D, 1L), (-0.0D, 2L), (double('NaN'), 3L), (double('NaN') * -1, 4L) AS t(k, n)"""
    )
    assert rows_of(snapshot(data)) == [(2,), (4,)]


def test_null_key_is_not_a_key_of_nulls(spark):
    rows = [(None, (1, "x", 1.0)), ((None,), (2, "y", 2.0)), (None, (3, "z", 3.0))]
    assert rows_of(snapshot(change_data(spark, rows))) == [(2, "y", 2.0), (3, "z", 3.0)]


def test_snapshot_aggregates_before_its_only_shuffle(spark, tmp_path):
    change_data(spark).write.parquet(str(tmp_path / "c"))
    plan = plan_of(snapshot(spark.read.parquet(str(tmp_path / "c"))))
    assert plan.count("Exchange") == 1
    assert plan.index("partial_max_by") > plan.index("Exchange")
    assert "Python" not in plan


def test_apply_changes(spark):
    target = spark.createDataFrame([(1, "old", 0.0), (3, "gone", 0.0), (9, "kept", 9.0)], VALUE_DDL)
    assert rows_of(apply_changes(target, change_data(spark))) == sorted([*LAST_ROWS, (9, "kept", 9.0)])
    assert latest_changes(change_data(spark)).filter("value IS NULL").count() == 1


def test_apply_changes_rejects(spark):
    with pytest.raises(ValueError, match="key columns"):
        apply_changes(log_data(spark).drop("i"), change_data(spark))
    with pytest.raises(ValueError, match="differ"):
        apply_changes(log_data(spark).withColumn("more", F.lit(1)), change_data(spark))
    binary_key = change_data(spark).withColumn("key", F.lit(bytearray(b"k")))
    with pytest.raises(ValueError, match="decoded"):
        apply_changes(log_data(spark), binary_key)


keys = st.tuples(st.one_of(st.none(), st.integers(0, 3)))
values = st.one_of(st.none(), st.tuples(st.text("ab", max_size=2), st.floats(0, 9)))
logs = st.lists(st.tuples(keys, values), max_size=25)


def replay(rows, state=None):
    state = dict(state or {})
    for key, value in rows:
        state.pop(key, None)
        if value is not None:
            state[key] = value
    return state


def with_key(rows):
    return [(k, None if v is None else (k[0], *v)) for k, v in rows]


@settings(max_examples=12, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(logs, logs)
def test_snapshot_and_update_replay_the_log(spark, before, after):
    table = snapshot(change_data(spark, with_key(before)))
    state = replay(with_key(before))
    assert rows_of(table) == sorted(state.values(), key=repr)
    updated = apply_changes(table, change_data(spark, with_key(after)))
    assert rows_of(updated) == sorted(replay(with_key(after), state).values(), key=repr)
