"""Schemas inferred from JSON: no digit is lost, and a stream's schema may grow."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest

from helpers import rows_of
from sluiceway import run
from sluiceway.operators import decode_json_inferred
from sluiceway.operators.codec import infer_json_schemas


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.mark.parametrize(
    ("values", "kind"),
    [
        (["1", "2"], "bigint"),
        (["1", "2.5"], "double"),
        (["1.0", "7.25e3"], "double"),
        (["999999999999999", "0"], "bigint"),
        (["99999999999999", "0.5"], "double"),
        (["9223372036854775807", "1.5"], "decimal(20,1)"),
        (["-9223372036854775807", "0.001"], "decimal(22,3)"),
        (["12345678901234567890", "1"], "decimal(20,0)"),
        (["0.1234567890123456789", "null"], "decimal(20,19)"),
        (["1" * 38, "1"], "decimal(38,0)"),
        (["1" * 39, "1"], "string"),
        (["0." + "1" * 45, "2.5"], "string"),
        (['"1"', "2.5"], "string"),
        (["null", "null"], "string"),
    ],
)
def test_numbers_keep_their_digits(spark, values, kind):
    rows = texts(spark, *[f'{{"n": {v}, "inner": {{"of": [{v}]}}}}' for v in values])
    decoded = decode_json_inferred(rows)
    found = {f.name: f.dataType.simpleString() for f in decoded.schema["value"].dataType.fields}
    assert found == {"n": kind, "inner": f"struct<of:array<{kind}>>"}
    kept = [r["value"]["n"] for r in decoded.collect()]
    wanted = [None if v == "null" else v for v in values]
    if kind == "string":
        assert [None if v is None else v.strip('"') for v in kept] == [None if v is None else v.strip('"') for v in wanted]
    else:
        assert [None if v is None else Decimal(repr(v) if isinstance(v, float) else str(v)) for v in kept] == [None if v is None else Decimal(v) for v in wanted]


def test_texts_that_look_like_long_numbers(spark):
    value = json.dumps({"t": "a: " + "1" * 50 + ", b", "n": 1})
    assert infer_json_schemas(texts(spark, value, '{"t": "x", "n": 2.5}')) is not None
    assert rows_of(decode_json_inferred(texts(spark, '{"t": "' + "7" * 60 + '"}')).select("value.t")) == [("7" * 60,)]


def log_flow(source, target, checkpoint, **more):
    return {
        "flowType": "stream",
        "triggerInterval": "once",
        "source": {"changelog": {"path": str(source)}},
        "destination": {"local": {"path": str(target), "dataFormat": "parquet"}},
        "readDataType": "cdc",
        "writeDataType": "log",
        "checkpointLocation": str(checkpoint),
        **more,
    }


def test_a_schema_that_grows(spark, tmp_path):
    from sluiceway.sources import append_log

    flow = log_flow(tmp_path / "in", tmp_path / "out", tmp_path / "c", growingSchema=True)
    for number, value in enumerate(['{"a": 1, "s": {"x": 1}}', '{"a": 2, "late": "b", "s": {"x": 2, "y": [1.5]}}', '{"a": 3}', '{"more": true}']):
        append_log(texts(spark, value), str(tmp_path / "in"))
        run(spark, flow).awaitTermination()
        versions = sorted((tmp_path / "c").glob("inferred-schema-*.json"))
        assert len(versions) == (1, 2, 2, 3)[number]
    rows = spark.read.option("mergeSchema", "true").parquet(str(tmp_path / "out"))
    assert set(rows.columns) == {"a", "s", "late", "more"}
    got = sorted(((r["a"], r["late"], r["more"], r["s"] and r["s"]["x"], r["s"] and r["s"]["y"]) for r in rows.collect()), key=repr)
    assert got == sorted([(1, None, None, 1, None), (2, "b", None, 2, [1.5]), (3, None, None, None, None), (None, None, True, None, None)], key=repr)


def test_a_type_may_not_change_while_it_grows(spark, tmp_path):
    from sluiceway.sources import append_log

    flow = log_flow(tmp_path / "in", tmp_path / "out", tmp_path / "c", growingSchema=True)
    append_log(texts(spark, '{"a": 1}'), str(tmp_path / "in"))
    run(spark, flow).awaitTermination()
    append_log(texts(spark, '{"a": "text", "b": 1}'), str(tmp_path / "in"))
    with pytest.raises(Exception, match="(?i)malformed|failfast|cannot"):
        run(spark, flow).awaitTermination()


def test_rows_of_a_stream_are_counted(spark, tmp_path):
    from sluiceway.operators import StreamRowCounts

    for _ in range(3):
        spark.range(40).write.mode("append").parquet(str(tmp_path / "in"))
    with StreamRowCounts(spark) as counts:
        rows = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        rows = counts.register(counts.register(rows, "read").where("id % 4 = 0"), "written")
        writer = rows.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        assert counts.totals(query) == {"read": 120, "written": 30}
        assert counts.batches(query) > 1
