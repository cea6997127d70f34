from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from helpers import CHANGE_ROWS, LAST_ROWS, LOG_ROWS, VALUE_DDL, change_data, last_of, log_data, rows_of
from pyspark.sql import functions as F
from sluiceway import run
from sluiceway.operators import decode_json, encode_json, snapshot
from sluiceway.sources import append_log, buckets, read_log, read_table, storage
from sluiceway.streaming import checkpoint_of

SCHEMAS = {"valueSchema": VALUE_DDL, "keySchema": "i int"}


def stream(source, target, **settings):
    return {"flowType": "stream", "triggerInterval": "once", "source": source, "destination": target, **settings}


def files(path, fmt="parquet", **more):
    return {"local": {"path": str(path), "dataFormat": fmt, **more}}


def topic(path, **more):
    return {"topic": {"path": str(path), **more}}


def finish(spark, flow):
    query = run(spark, flow)
    query.awaitTermination()
    assert query.exception() is None
    return query


def append_changes(spark, path, rows=CHANGE_ROWS):
    append_log(encode_json(change_data(spark, rows), keep=["offset"]), str(path), order_by="offset")


def test_file_stream_resumes(spark, tmp_path):
    flow = stream(
        files(tmp_path / "in"),
        files(tmp_path / "out"),
        checkpointLocation=str(tmp_path / "c"),
        transformation=[
            {"name": "f", "action": "filterrows", "options": {"clause": "i > 1"}},
            {"name": "r", "action": "redactcolumns", "columns": ["s"]},
        ],
    )
    log_data(spark).write.parquet(str(tmp_path / "in"))
    finish(spark, flow)
    expected = [(2, "X" * 10, 2.0), (3, "X" * 10, 3.0)]
    assert rows_of(spark.read.parquet(str(tmp_path / "out"))) == expected
    finish(spark, flow)
    assert rows_of(spark.read.parquet(str(tmp_path / "out"))) == expected
    spark.createDataFrame([(5, "e", 5.0)], VALUE_DDL).write.mode("append").parquet(str(tmp_path / "in"))
    finish(spark, flow)
    assert rows_of(spark.read.parquet(str(tmp_path / "out"))) == [*expected, (5, "X" * 10, 5.0)]


def test_checkpoint_is_needed(spark, tmp_path):
    log_data(spark).write.parquet(str(tmp_path / "in"))
    flow = stream(files(tmp_path / "in"), files(tmp_path / "out"))
    with pytest.raises(ValueError, match="checkpoint"):
        run(spark, flow)
    spark.conf.set("spark.sql.streaming.checkpointLocation", str(tmp_path / "base"))
    try:
        finish(spark, flow)
        finish(spark, flow)
        assert rows_of(spark.read.parquet(str(tmp_path / "out"))) == LOG_ROWS
        from sluiceway import FlowSpec

        assert checkpoint_of(spark, FlowSpec.from_dict(flow)) == checkpoint_of(spark, FlowSpec.from_dict(flow))
    finally:
        spark.conf.unset("spark.sql.streaming.checkpointLocation")


def test_interval_trigger(spark, tmp_path):
    log_data(spark).write.parquet(str(tmp_path / "in"))
    flow = stream(files(tmp_path / "in"), files(tmp_path / "out"), checkpointLocation=str(tmp_path / "c"))
    query = run(spark, {**flow, "triggerInterval": "1 seconds"})
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert rows_of(spark.read.parquet(str(tmp_path / "out"))) == LOG_ROWS


def test_senseless_streams(spark, tmp_path):
    source, target = files(tmp_path / "in"), files(tmp_path / "out")
    for settings in (
        {"writeOperation": "overwrite"},
        {"writeOperation": "update"},
        {"writeDataType": "cdc"},
        {"readDataType": "cdc", "writeOperation": "update"},
    ):
        with pytest.raises(ValueError):
            run(spark, stream(source, target, checkpointLocation=str(tmp_path / "c"), **settings))


@pytest.mark.parametrize("schemas", [SCHEMAS, {}], ids=["given", "inferred"])
def test_change_to_log(spark, tmp_path, schemas):
    append_changes(spark, tmp_path / "topic")
    flow = stream(
        topic(tmp_path / "topic", **schemas),
        files(tmp_path / "out"),
        readDataType="cdc",
        writeDataType="log",
        checkpointLocation=str(tmp_path / "c"),
    )
    finish(spark, flow)
    out = spark.read.parquet(str(tmp_path / "out")).select("i", "s", "d")
    assert rows_of(out) == sorted(((v or (None,) * 3) for _, v in CHANGE_ROWS), key=repr)
    append_changes(spark, tmp_path / "topic", [((8,), (8, "z", 8.0))])
    finish(spark, flow)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(CHANGE_ROWS) + 1


def test_deletes_can_be_left_out(spark, tmp_path):
    append_changes(spark, tmp_path / "topic")
    flow = stream(
        topic(tmp_path / "topic", **SCHEMAS),
        files(tmp_path / "out"),
        readDataType="cdc",
        writeDataType="log",
        dropTombstones=True,
        checkpointLocation=str(tmp_path / "c"),
    )
    finish(spark, flow)
    assert rows_of(spark.read.parquet(str(tmp_path / "out"))) == sorted(v for _, v in CHANGE_ROWS if v)


def test_inferred_schema_is_pinned(spark, tmp_path):
    append_changes(spark, tmp_path / "topic")
    flow = stream(
        topic(tmp_path / "topic"),
        files(tmp_path / "out"),
        readDataType="cdc",
        writeDataType="log",
        checkpointLocation=str(tmp_path / "c"),
    )
    finish(spark, flow)
    drifted = spark.createDataFrame([('{"i":7}', '{"i":7,"other":1}')], "key string, value string")
    append_log(drifted, str(tmp_path / "topic"))
    # A field that came later would be lost: the stream says so.
    with pytest.raises(PySparkException, match="lacks: other"):
        finish(spark, flow)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(out.columns) == ["d", "i", "s"]


def test_checkpoint_of_a_flow(spark, tmp_path):
    from sluiceway.plans.spec import FlowSpec
    from sluiceway.streaming.runner import checkpoint_of

    def place(source, **more):
        spec = FlowSpec.from_dict({"source": {"files": source}, "destination": {"files": {"path": "/o"}}, "flowType": "stream", **more})
        return checkpoint_of(spark, spec)

    spark.conf.set("spark.sql.streaming.checkpointLocation", str(tmp_path))
    try:
        one = place({"path": "/i", "options": {"secret.key": "a", "password": "b"}})
        assert one == place({"path": "/i", "options": {"secret.key": "x", "password": "y"}})
        assert one != place({"path": "/other"})
        steps = [{"name": "s", "action": "RemoveColumns", "columns": ["a"]}]
        assert one != place({"path": "/i"}, transformation=steps)
        assert place({"path": "/i"}, transformation=steps) != place({"path": "/i"}, transformation=[{**steps[0], "columns": ["b"]}])
    finally:
        spark.conf.unset("spark.sql.streaming.checkpointLocation")


def test_inference_waits_for_data(spark, tmp_path):
    flow = stream(
        topic(tmp_path / "topic"),
        files(tmp_path / "out"),
        readDataType="cdc",
        writeDataType="log",
        checkpointLocation=str(tmp_path / "c"),
    )
    finish(spark, flow)
    append_changes(spark, tmp_path / "topic", [((3,), None)])
    finish(spark, flow)
    append_changes(spark, tmp_path / "topic")
    finish(spark, flow)
    finish(spark, flow)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(CHANGE_ROWS)


def test_change_to_change(spark, tmp_path):
    append_changes(spark, tmp_path / "first")
    flow = stream(
        topic(tmp_path / "first", **SCHEMAS),
        topic(tmp_path / "second", partitions=3),
        readDataType="cdc",
        checkpointLocation=str(tmp_path / "c"),
        transformation=[{"name": "r", "action": "redactcolumns", "columns": ["s"]}],
    )
    finish(spark, flow)
    finish(spark, flow)
    copied = decode_json(read_log(spark, str(tmp_path / "second")), VALUE_DDL, "i int")
    assert copied.count() == len(CHANGE_ROWS)
    assert copied.filter("value IS NULL").count() == sum(v is None for _, v in CHANGE_ROWS)
    assert rows_of(snapshot(copied)) == [(i, "X" * 10, d) for i, _, d in LAST_ROWS]


def test_topic_copy_keeps_the_order_over_many_files(spark, tmp_path):
    rows = [((n * 7 % 5,), None if n % 11 == 0 else (n * 7 % 5, str(n), float(n))) for n in range(3000)]
    data = change_data(spark, rows).repartition(16)
    append_log(encode_json(data, keep=["offset"]), str(tmp_path / "first"), partitions=2, order_by="offset")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        flow = stream(
            topic(tmp_path / "first", **SCHEMAS),
            topic(tmp_path / "second", partitions=3),
            readDataType="cdc",
            checkpointLocation=str(tmp_path / "c"),
        )
        finish(spark, flow)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    copied = decode_json(read_log(spark, str(tmp_path / "second")), VALUE_DDL, "i int")
    last = dict(rows)
    assert rows_of(snapshot(copied)) == sorted((v for v in last.values() if v), key=repr)


def test_change_files_to_files(spark, tmp_path):
    change_data(spark).drop("offset").write.parquet(str(tmp_path / "in"))
    flow = stream(
        files(tmp_path / "in"),
        files(tmp_path / "out"),
        readDataType="cdc",
        checkpointLocation=str(tmp_path / "c"),
        transformation=[{"name": "d", "action": "digestcolumns", "columns": ["i"], "options": {"algo": "sha1"}}],
    )
    finish(spark, flow)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.columns == ["key", "value"]
    assert out.filter("value IS NULL").count() == sum(v is None for _, v in CHANGE_ROWS)
    assert out.schema["key"].dataType["i"].metadata["TransformationAction"] == "Digest sha1"


def test_log_envelope(spark, tmp_path):
    append_changes(spark, tmp_path / "topic")
    flow = stream(topic(tmp_path / "topic", **SCHEMAS), files(tmp_path / "out"), checkpointLocation=str(tmp_path / "c"))
    finish(spark, flow)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.columns == ["key", "value", "topic", "partition", "offset", "timestamp", "timestampType"]


def test_update_over_several_batches(spark, tmp_path):
    flow = stream(
        topic(tmp_path / "topic", **SCHEMAS),
        files(tmp_path / "out"),
        readDataType="cdc",
        writeDataType="log",
        writeOperation="update",
        checkpointLocation=str(tmp_path / "c"),
    )
    append_changes(spark, tmp_path / "topic", CHANGE_ROWS[:5])
    finish(spark, flow)
    assert rows_of(read_table(spark, str(tmp_path / "out"))) == last_of(CHANGE_ROWS[:5])
    append_changes(spark, tmp_path / "topic", CHANGE_ROWS[5:])
    finish(spark, flow)
    assert rows_of(read_table(spark, str(tmp_path / "out"))) == LAST_ROWS
    finish(spark, flow)
    assert buckets.numbers(spark, str(tmp_path / "out")) == [1, 2]
    with pytest.raises(ValueError, match="versions"):
        run(spark, stream(files(tmp_path / "out"), files(tmp_path / "more"), checkpointLocation=str(tmp_path / "c2")))


def test_update_of_a_partitioned_table(spark, tmp_path):
    flow = stream(
        topic(tmp_path / "topic", **SCHEMAS),
        files(tmp_path / "out", partitionBy=["i"]),
        readDataType="cdc",
        writeDataType="log",
        writeOperation="update",
        checkpointLocation=str(tmp_path / "c"),
    )
    for part in (CHANGE_ROWS[:5], CHANGE_ROWS[5:]):
        append_changes(spark, tmp_path / "topic", part)
        finish(spark, flow)
    assert rows_of(read_table(spark, str(tmp_path / "out")).select("i", "s", "d")) == LAST_ROWS
    assert [n for n in storage.children(spark, str(tmp_path / "out")) if "=" in n] == [f"i={i}" for i, _, _ in LAST_ROWS]


def test_raw_is_for_batch(spark, tmp_path):
    append_changes(spark, tmp_path / "topic")
    flow = stream(
        topic(tmp_path / "topic", raw=True, **SCHEMAS), files(tmp_path / "out"), checkpointLocation=str(tmp_path / "c")
    )
    with pytest.raises(ValueError, match="batch"):
        run(spark, flow)


def test_samples_differ_between_small_batches(spark, tmp_path):
    spark.range(0, 24, 1, 24).write.parquet(str(tmp_path / "in"))
    flow = stream(
        files(tmp_path / "in", options={"maxFilesPerTrigger": "1"}),
        files(tmp_path / "out"),
        checkpointLocation=str(tmp_path / "c"),
        transformation=[{"name": "s", "action": "samplerows", "options": {"fraction": 0.5, "seed": 1}}],
    )
    finish(spark, flow)
    assert 0 < spark.read.parquet(str(tmp_path / "out")).count() < 24


def largest(df):
    return df.orderBy(F.desc("d")).limit(1)


def test_static_steps_per_batch(spark, tmp_path):
    log_data(spark).write.parquet(str(tmp_path / "in"))
    flow = stream(
        files(tmp_path / "in"),
        files(tmp_path / "out"),
        checkpointLocation=str(tmp_path / "c"),
        transformation=[{"name": "l", "action": "class", "class": "test_streams.largest"}],
    )
    finish(spark, {**flow, "perBatch": True})
    assert rows_of(spark.read.parquet(str(tmp_path / "out"))) == [LOG_ROWS[-1]]


def test_static_steps_per_batch_of_an_inferred_topic(spark, tmp_path):
    append_changes(spark, tmp_path / "topic")
    flow = stream(
        topic(tmp_path / "topic"),
        topic(tmp_path / "out"),
        readDataType="cdc",
        perBatch="true",
        checkpointLocation=str(tmp_path / "c"),
    )
    finish(spark, flow)
    finish(spark, flow)
    copied = decode_json(read_log(spark, str(tmp_path / "out")), VALUE_DDL, "i int")
    assert rows_of(snapshot(copied)) == LAST_ROWS


def test_sampled_stream(spark, tmp_path):
    spark.range(2000).withColumn("x", F.col("id") * 2).write.parquet(str(tmp_path / "in"))
    flow = stream(
        files(tmp_path / "in"),
        files(tmp_path / "out", "json"),
        checkpointLocation=str(tmp_path / "c"),
        transformation=[{"name": "s", "action": "samplerows", "options": {"fraction": 0.5, "seed": 1}}],
    )
    finish(spark, flow)
    out = spark.read.json(str(tmp_path / "out"))
    assert 850 < out.count() < 1150
    assert out.filter("x <> id * 2").count() == 0
