from __future__ import annotations

import json

import pytest

from helpers import CHANGE_ROWS, LIVE_ROWS, change_data, log_data, rows_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType
from sluiceway.functions import column_names, field, field_type, require_not_null, struct_type
from sluiceway.operators import (
    CHANGE,
    RowCounts,
    augment_metadata,
    digest_columns,
    lineage,
    record_schema,
    redact_columns,
    seal_stamps,
    snapshot,
    unwrap,
)

# DDL of a column and its description.
DESCRIBED = {
    "open": ("boolean", {"type": "boolean", "logicalType": "BOOLEAN"}),
    "since": ("timestamp_ntz", {"type": "long", "logicalType": "local-timestamp-micros"}),
    "span": ("interval day to second", {"type": "string", "sparkType": "interval day to second"}),
    "months": ("interval year to month", {"type": "string", "sparkType": "interval year to month"}),
    "tags": ("array<smallint>", {"type": "array", "items": {"type": "int", "logicalType": "SMALLINT"}}),
    "prices": ("map<string, decimal(9,2)>", {"type": "map", "values": {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 2}}),
    "place": (
        "struct<lat: double not null, seen: date>",
        {
            "type": "record",
            "name": "place",
            "fields": [{"name": "lat", "type": {"type": "double"}}, {"name": "seen", "type": {"type": "int", "logicalType": "date"}, "nullable": True}],
        },
    ),
    "scan": ("binary", {"type": "bytes"}),
    "level": ("tinyint", {"type": "int", "logicalType": "TINYINT"}),
    "at": ("timestamp", {"type": "long", "logicalType": "timestamp-micros"}),
    "rate": ("float", {"type": "float"}),
}


def test_augment_and_record_schema(spark):
    ddl = ", ".join(f"{name} {kind}" for name, (kind, _) in DESCRIBED.items())
    wide = augment_metadata(spark.createDataFrame([], f"{ddl}, id bigint not null"))
    assert {f.name: f.metadata for f in wide.schema.fields} == {name: said for name, (_, said) in DESCRIBED.items()} | {"id": {"type": "long"}}
    described = json.loads(record_schema(wide, "wide"))
    assert (described["type"], described["name"]) == ("record", "wide")
    by_name = {f["name"]: f["type"] for f in described["fields"]}
    seen = [{"type": "int", "logicalType": "date"}, "null"]
    place = {"type": "record", "name": "place", "fields": [{"name": "lat", "type": {"type": "double"}}, {"name": "seen", "type": seen}]}
    assert by_name == {name: [said, "null"] for name, (_, said) in DESCRIBED.items()} | {"id": {"type": "long"}, "place": [place, "null"]}
    plain = json.loads(record_schema(log_data(spark), "plain"))
    assert {f["type"] for f in plain["fields"]} == {"null"}


def test_augment_keeps_metadata(spark):
    noted = log_data(spark).select(F.col("i").alias("i", metadata={"comment": "c"}), "s")
    result = augment_metadata(noted)
    assert result.schema["i"].metadata == {"comment": "c"}
    assert result.schema["s"].metadata == {"type": "string"}


def test_nested_and_unknown_types(spark):
    data = spark.sql("SELECT array(1) AS a, map('k', 1.5D) AS m, named_struct('x', 1) AS s, INTERVAL 1 DAY AS i")
    found = {f.name: f.metadata for f in augment_metadata(data).schema.fields}
    assert found["a"] == {"type": "array", "items": {"type": "int"}}
    assert found["m"] == {"type": "map", "values": {"type": "double"}}
    assert found["s"]["fields"] == [{"name": "x", "type": {"type": "int"}}]
    assert found["i"]["sparkType"].startswith("interval")


def test_stamps(spark, tmp_path):
    data = redact_columns(log_data(spark), ["i"], name="first")
    data = digest_columns(data, ["i", "s"], "sha1", name="second")
    stamped = data.schema["i"].metadata
    assert stamped["type"] == "int"
    assert (stamped["TransformationAction"], stamped["TransformationName"]) == ("Digest sha1", "second")
    data.write.parquet(str(tmp_path / "t"))
    assert lineage(spark.read.parquet(str(tmp_path / "t"))) == {
        "i": [{"action": "Redact", "name": "first"}, {"action": "Digest sha1", "name": "second"}],
        "s": [{"action": "Digest sha1", "name": "second"}],
    }


def test_stamps_of_struct_fields(spark):
    data = redact_columns(change_data(spark), ["s"], form=CHANGE, name="r")
    expected = [{"action": "Redact", "name": "r"}]
    assert lineage(data) == {"value.s": expected}
    sealed = seal_stamps(data)
    assert sealed.schema["value"].dataType["s"].metadata["TransformationAction"] == "Redact"
    assert sealed.schema["value"].metadata == {}
    assert sealed.filter("value IS NULL").count() == len(CHANGE_ROWS) - len(LIVE_ROWS)
    for flat in (unwrap(data), unwrap(sealed), snapshot(data), snapshot(sealed)):
        assert lineage(flat) == {"s": expected}
    twice = seal_stamps(digest_columns(sealed, ["s"], form=CHANGE, name="d"))
    assert lineage(twice) == {"value.s": [*expected, {"action": "Digest md5", "name": "d"}]}


def test_require_not_null(spark):
    data = require_not_null(log_data(spark), "i")
    assert not data.schema["i"].nullable and data.schema["s"].nullable
    assert rows_of(data) == rows_of(log_data(spark))
    nested = require_not_null(change_data(spark).filter("value IS NOT NULL"), "value.i")
    assert not field(nested, "value.i").nullable
    assert nested.count() == len(LIVE_ROWS)
    key = require_not_null(change_data(spark), "key")
    assert not key.schema["key"].nullable
    with pytest.raises(PySparkException, match="null in non-null column value"):
        require_not_null(change_data(spark), "value").collect()


def test_require_not_null_of_every_type(spark):
    values = "CAST(1 AS {0})"
    for data_type in map(DataType.fromDDL, ["boolean", "bigint", "float", "decimal(9,2)", "string", "binary", "timestamp", "timestamp_ntz", "date"]):
        simple = data_type.simpleString()
        text = {"timestamp": "timestamp'2020-01-01'", "timestamp_ntz": "timestamp_ntz'2020-01-01'", "date": "date'2020-01-01'", "binary": "X'01'"}.get(
            simple, values.format(simple)
        )
        data = spark.sql(f"SELECT if(id < 5, {text}, NULL) AS c FROM range(2)")
        checked = require_not_null(data, "c")
        assert checked.schema["c"].dataType == data.schema["c"].dataType
        assert not checked.schema["c"].nullable
        assert rows_of(checked) == rows_of(data)
    with pytest.raises(ValueError, match="array"):
        require_not_null(spark.sql("SELECT array(1) AS a"), "a")


def test_schema_lookups(spark):
    data = change_data(spark)
    assert column_names(data) == ["key", "value", "offset"]
    assert column_names(data, "value") == ["i", "s", "d"]
    assert column_names(data, "offset") == []
    assert struct_type(data, "offset") is None
    assert field_type(data, "value.d") == DoubleType()
    with pytest.raises(KeyError):
        field(data, "value.x")


def test_row_counts(spark, tmp_path):
    counts = RowCounts()
    data = counts.register(counts.register(log_data(spark), "read").filter("i > 1"), "written")
    data.write.parquet(str(tmp_path / "t"))
    assert counts.counts() == {"read": 3, "written": 2}
    with pytest.raises(ValueError):
        counts.register(data, "read")
