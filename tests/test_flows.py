from __future__ import annotations

import hashlib
import itertools
import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

from helpers import CHANGE_ROWS, LAST_ROWS, LOG_ROWS, VALUE_DDL, change_data, log_data, rows_of
from sluiceway import FlowSpec, delete_target, run
from sluiceway.__main__ import main
from sluiceway.operators import decode_json, encode_json, snapshot, wrap
from sluiceway.sources import append_log, read_log, storage
from sluiceway.sources.stores import Store


def ends(source="/s", target="/t"):
    return {
        "source": {"local": {"path": str(source), "dataFormat": "parquet"}},
        "destination": {"local": {"path": str(target), "dataFormat": "parquet"}},
    }


def test_defaults():
    spec = FlowSpec.from_dict(ends())
    assert (spec.flow_type, spec.source_type, spec.target_type, spec.operation, spec.trigger) == (
        "batch", "log", "log", "overwrite", "5 seconds",
    )
    spec = FlowSpec.from_dict({**ends(), "flowType": "stream", "readDataType": "cdc"})
    assert (spec.operation, spec.target_type) == ("append", "change")


@pytest.mark.parametrize("spelling", ["logdata", "LOG", "changedata", "Change", "CDC"])
def test_data_type_spellings(spelling):
    spec = FlowSpec.from_dict({**ends(), "read_data_type": spelling})
    assert spec.source_type == ("log" if spelling.lower().startswith("log") else "change")


def test_other_spellings():
    spec = FlowSpec.from_dict({**ends(), "flowType": "STREAM", "writeOperation": "Update", "triggerInterval": "once"})
    assert (spec.flow_type, spec.operation, spec.trigger) == ("stream", "update", "once")


@pytest.mark.parametrize(
    "config",
    [
        {"flowType": "lambda"},
        {"readDataType": "table"},
        {"writeOperation": "merge"},
        {"transformations": []},
        {"transformation": [{"name": "r", "action": "RemoveColumn"}]},
    ],
)
def test_unknown_settings(config):
    with pytest.raises(ValueError):
        FlowSpec.from_dict({**ends(), **config})


def test_ends_are_needed():
    with pytest.raises(ValueError, match="destination"):
        FlowSpec.from_dict({"source": {}})


def test_text_forms():
    assert FlowSpec.from_text(json.dumps(ends())).operation == "overwrite"
    yaml = pytest.importorskip("yaml")
    assert FlowSpec.from_text(yaml.safe_dump({**ends(), "writeOperation": "append"})).operation == "append"
    with pytest.raises(ValueError):
        FlowSpec.from_text("[1, 2]")


# Flow type, source type, target type, operation: what makes sense.
ALLOWED = {
    ("batch", "log", "log", "overwrite"),
    ("batch", "log", "log", "append"),
    ("batch", "log", "change", "overwrite"),
    ("batch", "log", "change", "append"),
    ("batch", "change", "log", "overwrite"),
    ("batch", "change", "log", "update"),
    ("batch", "change", "change", "overwrite"),
    ("batch", "change", "change", "append"),
    ("batch", "change", "change", "update"),
    ("stream", "log", "log", "append"),
    ("stream", "change", "log", "append"),
    ("stream", "change", "change", "append"),
    ("stream", "change", "log", "update"),
}


@pytest.mark.parametrize(
    "cell",
    list(itertools.product(("batch", "stream"), ("log", "change"), ("log", "change"), ("overwrite", "append", "update"))),
    ids="-".join,
)
def test_matrix(cell):
    flow, source, target, operation = cell
    spec = FlowSpec({}, {}, flow, source, target, operation)
    if cell in ALLOWED:
        spec.check()
    else:
        with pytest.raises(ValueError):
            spec.check()


def test_topics_cannot_be_updated_in_place():
    FlowSpec({}, {}, "batch", "change", "change", "update").check(append_only_target=True)
    with pytest.raises(ValueError):
        FlowSpec({}, {}, "batch", "change", "log", "update").check(append_only_target=True)


STATIONS = [
    "station,height,remark",
    '"Pass, upper",2410.5,"two',
    'lines"',
    "Harbour,3.25,",
    '"Old ""Mill""",118,closed',
]


def csv_flow(tmp_path):
    """High stations, by the digest of their names."""
    (tmp_path / "stations.csv").write_text("\n".join(STATIONS) + "\n")
    return {
        "source": {"local": {"path": str(tmp_path / "stations.csv"), "dataFormat": "csv"}},
        "destination": {"local": {"path": str(tmp_path / "high"), "dataFormat": "orc"}},
        "transformation": [
            {"name": "high ones", "action": "FilterRows", "options": {"clause": "height >= 100"}},
            {"name": "who", "columns": ["station"], "action": "DigestColumns", "options": {"algo": "sha1"}},
        ],
    }


def test_csv_to_orc(spark, tmp_path):
    assert run(spark, csv_flow(tmp_path)).rows == 2
    result = spark.read.orc(str(tmp_path / "high"))
    names = [hashlib.sha1(name.encode()).hexdigest() for name in ("Pass, upper", 'Old "Mill"')]
    assert rows_of(result) == sorted([(names[0], 2410.5, "two\nlines"), (names[1], 118.0, "closed")], key=repr)


def test_command_line_usage(capsys):
    assert main([]) == 2
    assert "usage" in capsys.readouterr().err


def test_command_line(tmp_path):
    (tmp_path / "flow.json").write_text(json.dumps(csv_flow(tmp_path)))
    here = Path(__file__).resolve().parent.parent
    command = [sys.executable, "-m", "sluiceway", str(tmp_path / "flow.json")]
    settings = {**os.environ, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell"}
    done = subprocess.run(command, cwd=here, env=settings, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "wrote 2 rows" in done.stdout
    assert (tmp_path / "high" / "_SUCCESS").exists()


def topic_with_changes(spark, tmp_path, name="topic"):
    path = str(tmp_path / name)
    append_log(encode_json(change_data(spark), keep=["offset"]), path, partitions=2, order_by="offset")
    return path


def test_topic_to_files_takes_a_snapshot(spark, tmp_path):
    flow = {
        "source": {"topic": {"path": topic_with_changes(spark, tmp_path), "dataFormat": "json"}},
        "destination": {"local": {"path": str(tmp_path / "out"), "dataFormat": "parquet"}},
        "readDataType": "cdc",
        "writeDataType": "logdata",
        "writeOperation": "overwrite",
    }
    assert run(spark, flow).rows == len(LAST_ROWS)
    result = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(result.columns) == ["d", "i", "s"]
    assert rows_of(result.select("i", "s", "d")) == LAST_ROWS


def test_topic_as_log_keeps_the_envelope(spark, tmp_path):
    flow = {
        "source": {"topic": {"path": topic_with_changes(spark, tmp_path), "valueSchema": VALUE_DDL, "keySchema": "i int"}},
        "destination": {"local": {"path": str(tmp_path / "out"), "dataFormat": "parquet"}},
    }
    run(spark, flow)
    result = spark.read.parquet(str(tmp_path / "out"))
    assert result.columns == ["key", "value", "topic", "partition", "offset", "timestamp", "timestampType"]
    assert result.count() == len(CHANGE_ROWS)


def test_raw_topic(spark, tmp_path):
    flow = {
        "source": {"topic": {"path": topic_with_changes(spark, tmp_path), "raw": "true", "valueSchema": VALUE_DDL}},
        "destination": {"local": {"path": str(tmp_path / "out"), "dataFormat": "parquet"}},
    }
    run(spark, flow)
    assert spark.read.parquet(str(tmp_path / "out")).columns[-4:] == [
        "data_key", "data_value", "key_schema_id", "value_schema_id",
    ]


def test_change_files_verbatim(spark, tmp_path):
    change_data(spark).write.parquet(str(tmp_path / "in"))
    steps = [{"name": "r", "action": "redactcolumns", "columns": ["s"]}]
    run(spark, {**ends(tmp_path / "in", tmp_path / "out"), "readDataType": "change", "transformation": steps})
    result = spark.read.parquet(str(tmp_path / "out"))
    assert result.columns == ["key", "value", "offset"]
    assert result.filter("value IS NULL").count() == sum(value is None for _, value in CHANGE_ROWS)
    assert result.schema["value"].dataType["s"].metadata["TransformationAction"] == "Redact"
    assert "fieldStamps" not in result.schema["value"].metadata


def test_update_flow(spark, tmp_path):
    spark.createDataFrame([(1, "old", 0.0), (3, "gone", 0.0), (9, "kept", 9.0)], VALUE_DDL).write.parquet(str(tmp_path / "t"))
    flow = {
        "source": {"topic": {"path": topic_with_changes(spark, tmp_path), "valueSchema": VALUE_DDL, "keySchema": "i int"}},
        "destination": {"local": {"path": str(tmp_path / "t"), "dataFormat": "parquet"}},
        "readDataType": "change",
        "writeDataType": "log",
        "writeOperation": "update",
    }
    assert run(spark, flow).rows == len(LAST_ROWS) + 1
    copy = {**ends(tmp_path / "t", tmp_path / "copy")}
    run(spark, copy)
    assert rows_of(spark.read.parquet(str(tmp_path / "copy"))) == sorted([*LAST_ROWS, (9, "kept", 9.0)])


def test_changes_in_an_order_of_their_own(spark, tmp_path):
    change_data(spark).withColumnRenamed("offset", "seq").write.parquet(str(tmp_path / "in"))
    flow = {**ends(tmp_path / "in", tmp_path / "out"), "readDataType": "cdc", "writeDataType": "log"}
    with pytest.raises(ValueError, match="order_by"):
        run(spark, flow)
    assert run(spark, {**flow, "orderBy": "seq"}).rows == len(LAST_ROWS)
    assert rows_of(spark.read.parquet(str(tmp_path / "out"))) == LAST_ROWS
    update = {**flow, **ends(tmp_path / "in", tmp_path / "out2"), "orderBy": ["seq"], "writeOperation": "update"}
    assert run(spark, update).rows == len(LAST_ROWS)
    topic = {**flow, "writeDataType": "cdc", "orderBy": "seq", "destination": {"topic": {"path": str(tmp_path / "topic")}}}
    assert run(spark, topic).rows == len(CHANGE_ROWS)
    copied = decode_json(read_log(spark, str(tmp_path / "topic")), VALUE_DDL, "i int")
    assert rows_of(snapshot(copied)) == LAST_ROWS


@pytest.mark.parametrize("setting, files", [({}, 3), ({"rebalance": False}, None)], ids=["left open", "off"])
def test_partitioned_snapshot(spark, tmp_path, setting, files):
    rows = [((n,), (n, "abc"[n % 3], float(n))) for n in range(60)]
    change_data(spark, rows).write.parquet(str(tmp_path / "in"))
    flow = {**ends(tmp_path / "in", tmp_path / "out"), "readDataType": "cdc", "writeDataType": "log"}
    flow["destination"]["local"].update({"partitionBy": ["s"], **setting})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(spark, flow).rows == 60
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    written = [f for d in (tmp_path / "out").glob("s=*") for f in d.glob("*.parquet")]
    assert len(written) == files if files else len(written) > 3
    assert rows_of(spark.read.parquet(str(tmp_path / "out")).select("i", "s", "d")) == sorted((v for _, v in rows), key=repr)


def test_partitioned_update_can_rebalance(spark, tmp_path):
    change_data(spark).write.parquet(str(tmp_path / "in"))
    flow = {**ends(tmp_path / "in", tmp_path / "out"), "readDataType": "cdc", "writeDataType": "log", "writeOperation": "update"}
    flow["destination"]["local"].update({"partitionBy": ["i"], "rebalance": True})
    assert run(spark, flow).rows == len(LAST_ROWS)
    assert run(spark, flow).rows == len(LAST_ROWS)
    assert rows_of(spark.read.parquet(str(tmp_path / "out")).select("i", "s", "d")) == LAST_ROWS


def test_log_data_into_a_topic(spark, tmp_path, caplog):
    log_data(spark).write.parquet(str(tmp_path / "in"))
    flow = {**ends(tmp_path / "in"), "destination": {"topic": {"path": str(tmp_path / "topic")}}}
    assert run(spark, flow).rows == 3
    assert "only grows" in caplog.text
    run(spark, flow)
    assert read_log(spark, str(tmp_path / "topic")).count() == 6


def test_overlapping_ends(spark, tmp_path):
    log_data(spark).write.parquet(str(tmp_path / "in"))
    for target in (tmp_path / "in", tmp_path / "in" / "below", tmp_path):
        with pytest.raises(ValueError, match="overlap"):
            run(spark, ends(tmp_path / "in", target))
    run(spark, ends(tmp_path / "in", tmp_path / "in2"))
    assert rows_of(spark.read.parquet(str(tmp_path / "in2"))) == LOG_ROWS


def test_senseless_flow_leaves_the_target(spark, tmp_path):
    change_data(spark).write.parquet(str(tmp_path / "in"))
    log_data(spark).write.parquet(str(tmp_path / "out"))
    flow = {**ends(tmp_path / "in", tmp_path / "out"), "readDataType": "cdc", "writeDataType": "log", "writeOperation": "append"}
    with pytest.raises(ValueError, match="snapshot"):
        run(spark, flow)
    assert rows_of(spark.read.parquet(str(tmp_path / "out"))) == LOG_ROWS


class Collected(Store):
    def __init__(self):
        self.rows = None

    def write(self, df, operation, data_type="log", tag=None):
        self.rows = rows_of(df)


def test_own_store(spark, tmp_path):
    log_data(spark).write.parquet(str(tmp_path / "in"))
    target = Collected()
    report = run(spark, {**ends(tmp_path / "in"), "destination": target})
    assert target.rows == LOG_ROWS and report.rows == -1


def test_rebalanced_write_counts_exactly(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id % 3 AS p").write.parquet(str(tmp_path / "in"))
    flow = ends(tmp_path / "in", tmp_path / "out")
    flow["destination"]["local"].update({"partitionBy": ["p"], "rebalance": True})
    assert run(spark, flow).rows == 1000
    files = [f for d in (tmp_path / "out").glob("p=*") for f in d.glob("*.parquet")]
    assert len(files) == 3


def test_delete_target(spark, tmp_path):
    run(spark, csv_flow(tmp_path))
    assert delete_target(spark, csv_flow(tmp_path))
    assert not (tmp_path / "high").exists()
    assert not delete_target(spark, csv_flow(tmp_path))


def test_json_wrap_round_trip_through_flow(spark, tmp_path):
    append_log(encode_json(wrap(log_data(spark), ["i"])), str(tmp_path / "in"))
    flow = {
        "source": {"topic": {"path": str(tmp_path / "in")}},
        "destination": {"topic": {"path": str(tmp_path / "out")}},
        "readDataType": "cdc",
    }
    assert run(spark, flow).rows == 3
    assert read_log(spark, str(tmp_path / "out")).count() == 3
