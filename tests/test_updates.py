"""Tables in buckets, replacements that survive a crash, and micro-batches that are tried again."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException

from helpers import change_data, plan_of, rows_of
from sluiceway import run
from sluiceway.operators.update import apply_changes
from sluiceway.sources import FileStore, buckets, find_format, journal, read_table, storage, tables, update_table

VALUE = "id bigint, name string, amount double"


def changes(spark, rows):
    """(id, name) rows in their order; a null name deletes."""
    data = [((i,), None if name is None else (i, name, i / 2), n) for n, (i, name) in enumerate(rows)]
    return spark.createDataFrame(data, f"key struct<id: bigint>, value struct<{VALUE}>, offset bigint")


def replay(*batches):
    state = {}
    for batch in batches:
        for i, name in batch:
            state.pop(i, None)
            if name is not None:
                state[i] = (i, name, i / 2)
    return sorted(state.values(), key=repr)


def bucket_files(path):
    return {str(f): f.stat().st_mtime_ns for f in path.glob("_buckets/*/key_bucket=*/*.parquet")}


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("name", ["parquet", "csv", "json", "orc"])
def test_updates_in_buckets_replay_the_log(spark, tmp_path, threshold, name):
    """With changes that are broadcast, and with both sides dealt by bucket."""
    rng, path, fmt, done = random.Random(5), str(tmp_path / "t"), find_format(name), []
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for size in (60, 5, 40):
            batch = [(rng.randint(-20, 60), rng.choice([None, "007", "x, y", 'a "b"'])) for _ in range(size)]
            done.append(batch)
            update_table(changes(spark, batch), path, fmt, buckets=7)
            assert rows_of(read_table(spark, path, fmt)) == replay(*done)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert buckets.manifest(spark, path).buckets == 7


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = tmp_path / "t"
    update_table(changes(spark, [(i, "a") for i in range(200)]), str(path), buckets=16)
    first, state = bucket_files(path), buckets.manifest(spark, str(path))
    assert len(state.places) == 16
    rows = update_table(changes(spark, [(3, "b"), (4, None)]), str(path))
    after, now = bucket_files(path), buckets.manifest(spark, str(path))
    moved = {b for b in state.places if now.places.get(b) != state.places[b]}
    assert 1 <= len(moved) <= 2 and {f: t for f, t in after.items() if f in first} == first
    assert all(f"key_bucket={f}/" in "".join(after.keys() - first.keys()) for f in moved)
    assert rows < 60 and rows_of(read_table(spark, str(path))) == replay([(i, "a") for i in range(200)], [(3, "b"), (4, None)])


def test_a_target_is_not_shuffled_for_few_changes(spark, tmp_path, monkeypatch):
    path, plans = str(tmp_path / "t"), []
    update_table(changes(spark, [(i, "a") for i in range(200)]), path, buckets=4)
    fmt = find_format("parquet")
    write = type(fmt).write
    monkeypatch.setattr(type(fmt), "write", lambda self, df, *a, **k: (plans.append(plan_of(df)), write(self, df, *a, **k))[1])
    update_table(changes(spark, [(3, "b")]), path)
    scans = [part for part in plans[-1].split("Union")[-1].split("FileScan")[:1]]
    assert "BroadcastHashJoin" in plans[-1] and "SortMergeJoin" not in plans[-1] and "Exchange hashpartitioning" not in scans[0].split("BroadcastExchange")[0]


def test_readers_go_on_and_old_buckets_expire(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "plain", 0.5), (2, "plain", 1.0)], VALUE).write.parquet(path)
    update_table(changes(spark, [(2, "new"), (3, "new")]), path, buckets=4)
    reader = read_table(spark, path)
    for i in range(3):
        update_table(changes(spark, [(2, f"v{i}")]), path)
    assert rows_of(reader) == [(1, "plain", 0.5), (2, "new", 1.0), (3, "new", 1.5)]
    assert tables.expire_versions(spark, path) == []
    assert tables.expire_versions(spark, path, -60) == [1, 2, 3, 4]
    assert not list((tmp_path / "t").glob("part-*")) and len(bucket_files(tmp_path / "t")) == len(buckets.manifest(spark, path).places)
    assert rows_of(read_table(spark, path)) == [(1, "plain", 0.5), (2, "v2", 1.0), (3, "new", 1.5)]
    assert tables.expire_versions(spark, path, -60) == [4] and rows_of(read_table(spark, path, schema="id bigint, name string")) == [(1, "plain"), (2, "v2"), (3, "new")]


def test_versions_become_buckets_and_more_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    update_table(changes(spark, [(i, "a") for i in range(20)]), path)
    assert tables.versions(spark, path) == [1]
    update_table(changes(spark, [(0, None)]), path, buckets=3)
    update_table(changes(spark, [(1, None)]), path, buckets=9)
    assert buckets.manifest(spark, path).buckets == 9
    assert rows_of(read_table(spark, path)) == replay([(i, "a") for i in range(2, 20)])
    with pytest.raises(ValueError, match="buckets of its key"):
        FileStore(path, "parquet").write(read_table(spark, path), "append")
    with pytest.raises(ValueError, match="stream"):
        FileStore(path, "parquet").read(spark, "stream")
    with pytest.raises(ValueError, match="not both"):
        FileStore(path, "parquet", partition_by=["id"], buckets=4)
    FileStore(path, "parquet").write(spark.createDataFrame([(1, "z", 0.5)], VALUE), "overwrite")
    assert read_table(spark, path).count() == 1


def test_an_update_that_dies_before_its_manifest_does_not_count(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    update_table(changes(spark, [(i, "a") for i in range(20)]), path, buckets=4)

    def die(*args):
        raise RuntimeError("died")

    with monkeypatch.context() as patch:
        patch.setattr(storage, "publish_text", die)
        with pytest.raises(RuntimeError, match="died"):
            update_table(changes(spark, [(1, "b")]), path)
    assert rows_of(read_table(spark, path)) == replay([(i, "a") for i in range(20)])
    update_table(changes(spark, [(2, "c")]), path)
    assert rows_of(read_table(spark, path)) == replay([(i, "a") for i in range(20)], [(2, "c")])


REGIONS = "key struct<r: string, id: bigint>, value struct<r: string, id: bigint, name: string>, offset bigint"


def regional(spark, rows):
    return spark.createDataFrame([((r, i), None if s is None else (r, i, s), n) for n, (r, i, s) in enumerate(rows)], REGIONS)


@pytest.mark.parametrize("step", range(6))
def test_a_partitioned_update_that_dies_loses_no_row(spark, tmp_path, monkeypatch, step):
    """At each deletion and renaming after the switch: readers see the new rows at once, and the next update goes on."""
    path, schema = str(tmp_path / "t"), "r string, id bigint, name string"
    update_table(regional(spark, [("a", 1, "x"), ("b", 2, "x"), ("c y", 3, "x"), ("d", 4, "x")]), path, partition_by=["r"])
    left, delete, rename = [step], storage.delete, storage.rename

    def counted(function, own):
        def call(session, first, *more):
            if str(first).startswith(path) and (own in first or more):
                if left[0] == 0:
                    raise RuntimeError("died")
                left[0] -= 1
            return function(session, first, *more)

        return call

    with monkeypatch.context() as patch:
        patch.setattr(storage, "delete", counted(delete, "/r="))
        patch.setattr(storage, "rename", counted(rename, "never"))
        try:
            update_table(regional(spark, [("a", 1, "new"), ("b", 2, None), ("c y", 3, "new")]), path, partition_by=["r"])
            died = False
        except RuntimeError:
            died = True
    new = [("a", 1, "new"), ("c y", 3, "new"), ("d", 4, "x")]
    old = [("a", 1, "x"), ("b", 2, "x"), ("c y", 3, "x"), ("d", 4, "x")]
    seen = rows_of(read_table(spark, path, schema=schema).select("r", "id", "name"))
    assert seen == (old if died and step == 0 else new)
    update_table(regional(spark, [("d", 4, "end")]), path, partition_by=["r"])
    now = [row for row in (old if died and step == 0 else new) if row[0] != "d"] + [("d", 4, "end")]
    assert rows_of(read_table(spark, path, schema=schema).select("r", "id", "name")) == now
    assert journal.pending(spark, path) == []


def test_key_and_value_have_to_agree(spark, tmp_path):
    target = spark.createDataFrame([(1, "a", 0.5)], VALUE)
    wrong = spark.createDataFrame([((5,), (1, "b", 0.5), 0)], f"key struct<id: bigint>, value struct<{VALUE}>, offset bigint")
    with pytest.raises(PySparkException, match="disagree"):
        apply_changes(target, wrong).collect()
    for more in ({}, {"buckets": 4}):
        with pytest.raises(PySparkException, match="disagree"):
            update_table(wrong, str(tmp_path / f"t{len(more)}"), **more)


def test_texts_of_csv_targets_stay_as_they_are(spark, tmp_path):
    for more in ({}, {"buckets": 2}):
        path, fmt = str(tmp_path / f"t{len(more)}"), find_format("csv")
        fmt.write(spark.createDataFrame([("007", "1e3"), ("009", "true")], "code string, note string"), path)
        change = spark.createDataFrame([(("011",), ("011", "0x"), 0)], "key struct<code: string>, value struct<code: string, note: string>, offset bigint")
        update_table(change, path, fmt, **more)
        assert rows_of(read_table(spark, path, fmt, "code string, note string")) == [("007", "1e3"), ("009", "true"), ("011", "0x")]


@pytest.mark.parametrize("partition_by", [(), ("p",)])
def test_a_batch_with_a_tag_is_appended_once(spark, tmp_path, monkeypatch, partition_by):
    path = str(tmp_path / "t")
    store, rows = FileStore(path, "parquet", partition_by), spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "i int, p string")
    assert store.write(rows, "append", tag="job#0") == 3
    assert store.write(rows, "append", tag="job#0") == 0
    store.write(rows, "append", tag="other#0")
    assert store.write(rows, "append") == 3
    assert spark.read.parquet(path).count() == 9

    real, calls = storage.rename, []

    def die(session, source, target):
        if "/part-" in source:
            calls.append(source)
            if len(calls) == 2:
                raise RuntimeError("died")
        return real(session, source, target)

    with monkeypatch.context() as patch:
        patch.setattr(storage, "rename", die)
        with pytest.raises(RuntimeError, match="died"):
            store.write(rows.repartition(3), "append", tag="job#1")
    store.write(rows, "append", tag="job#1")
    assert spark.read.parquet(path).count() == 12
    assert sorted(r["i"] for r in spark.read.parquet(path).collect()) == sorted([1, 2, 3] * 4)


def test_a_stream_by_batches_that_is_tried_again(spark, tmp_path, monkeypatch):
    """The first try dies after its rows were written: the second one does not write them again."""
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    change_data(spark).selectExpr("key.i AS i").write.parquet(source)
    flow = {
        "flowType": "stream",
        "triggerInterval": "once",
        "perBatch": True,
        "source": {"local": {"path": source, "dataFormat": "parquet"}},
        "destination": {"local": {"path": path, "dataFormat": "parquet"}},
        "checkpointLocation": str(tmp_path / "c"),
    }
    real = tables.append_files

    def die(*args):
        real(*args)
        raise RuntimeError("died")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "append_files", die)
        query = run(spark, flow)
        with pytest.raises(Exception, match="died"):
            query.awaitTermination()
    run(spark, flow).awaitTermination()
    assert sorted(r["i"] for r in spark.read.parquet(path).collect()) == sorted(r["i"] for r in spark.read.parquet(source).collect())


def test_a_file_system_that_only_the_flow_knows(spark, tmp_path):
    """A mount table in the options of a store: every call on its directories needs it."""
    (tmp_path / "data").mkdir()
    options = {"fs.viewfs.mounttable.flow.link./data": f"file://{tmp_path}/data", "fs.viewfs.impl": "org.apache.hadoop.fs.viewfs.ViewFileSystem"}
    store = FileStore("viewfs://flow/data/t", "parquet", options=options, buckets=2)
    store.write(spark.createDataFrame([(1, "a", 0.5)], VALUE), "overwrite")
    store.write(changes(spark, [(2, "b")]), "update")
    assert store.location(spark) == "viewfs://flow/data/t"
    assert rows_of(store.read(spark, "batch")) == [(1, "a", 0.5), (2, "b", 1.0)]
    try:
        known = storage.exists(spark, "viewfs://flow/data/t")
    except Exception:
        known = False
    assert not known
    assert store.delete(spark) and not (tmp_path / "data" / "t").exists()
