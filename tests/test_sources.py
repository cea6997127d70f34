from __future__ import annotations

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

import sluiceway.sources.tables as tables
from helpers import CHANGE_ROWS, LAST_ROWS, LOG_ROWS, VALUE_DDL, change_data, log_data, plan_of, rows_of
from pyspark.sql import functions as F
from sluiceway.operators import ConnectorMissing, decode_json, encode_json, snapshot, unwrap, wrap
from sluiceway.sources import (
    FileFormat,
    FileStore,
    append_log,
    build_store,
    find_format,
    read_kafka,
    read_table,
    read_log,
    register_format,
    register_store,
    storage,
    unregister_format,
    unregister_store,
    update_table,
)
from sluiceway.sources.stores import BrokerStore, ChangeLogStore, object_url

FORMATS = ["parquet", "orc", "csv", "json"]


@pytest.mark.parametrize("name", FORMATS)
def test_overwrite_and_append(spark, tmp_path, name):
    path, fmt = str(tmp_path / "t"), find_format(name.upper())
    fmt.write(log_data(spark), path)
    fmt.write(log_data(spark), path)
    assert rows_of(fmt.read(spark, path).select("i", "s", "d")) == LOG_ROWS
    fmt.write(log_data(spark), path, "append")
    assert rows_of(fmt.read(spark, path, VALUE_DDL)) == sorted(LOG_ROWS * 2)
    with pytest.raises(ValueError, match="update"):
        fmt.write(log_data(spark), path, "update")


@pytest.mark.parametrize("name", FORMATS)
def test_stream_append(spark, tmp_path, name):
    source, target, fmt = str(tmp_path / "s"), str(tmp_path / "t"), find_format(name)
    fmt.write(log_data(spark), source)
    stream = fmt.read_stream(spark, source)
    writer = fmt.write_stream(stream, target).option("checkpointLocation", str(tmp_path / "c"))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert rows_of(fmt.read(spark, target).select("i", "s", "d")) == LOG_ROWS
    for operation in ("update", "overwrite"):
        with pytest.raises(ValueError, match=operation):
            fmt.write_stream(stream, target, operation)


@pytest.mark.parametrize("name", FORMATS)
def test_partitioned(spark, tmp_path, name):
    path, fmt = str(tmp_path / "t"), find_format(name)
    fmt.write(log_data(spark), path, partition_by=["s"])
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {"s=a", "s=b", "s=c"}
    assert rows_of(fmt.read(spark, path).select("i", "s", "d")) == LOG_ROWS


def test_csv_refuses_nested_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="nested"):
        find_format("csv").write(change_data(spark), str(tmp_path / "t"))


def test_text_formats_keep_microseconds(spark, tmp_path):
    times = spark.sql("SELECT timestamp_ntz'2024-01-02 03:04:05.678901' AS n, timestamp'2024-01-02 03:04:05.678901' AS t")
    for name in ("csv", "json"):
        fmt, path = find_format(name), str(tmp_path / name)
        fmt.write(times, path)
        assert rows_of(fmt.read(spark, path, "n timestamp_ntz, t timestamp")) == rows_of(times)


def test_format_registry():
    register_format(FileFormat("json", write_options={"compression": "gzip"}), "Packed")
    assert find_format("PACKED").name == "json"
    unregister_format("packed")
    for unknown in ("packed", "no.such.Format", "sluiceway.sources.storage.exists"):
        with pytest.raises((ValueError, TypeError)):
            find_format(unknown)
    assert find_format("sluiceway.sources.formats.ORC").name == "orc"


def test_python_data_source_as_format(spark):
    from pyspark.sql.datasource import DataSource, DataSourceReader

    class Reader(DataSourceReader):
        def read(self, partition):
            yield (1, "a")

    class Letters(DataSource):
        @classmethod
        def name(cls):
            return "letters"

        def schema(self):
            return "n int, s string"

        def reader(self, schema):
            return Reader()

    spark.dataSource.register(Letters)
    register_format(FileFormat("letters"))
    try:
        assert rows_of(find_format("letters").read(spark, "anywhere")) == [(1, "a")]
    finally:
        unregister_format("letters")


def test_update_in_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    log_data(spark).write.parquet(path)
    assert update_table(change_data(spark), path) == len(LAST_ROWS)
    assert rows_of(read_table(spark, path)) == LAST_ROWS
    more = change_data(spark, [((1,), None), ((7,), (7, "n", 7.0))])
    update_table(more, path)
    assert rows_of(read_table(spark, path)) == sorted([*LAST_ROWS[1:], (7, "n", 7.0)], key=repr)
    reader = read_table(spark, path)
    update_table(more, path)
    update_table(more, path)
    # Versions that were replaced just now stay for their readers, until they are asked to go.
    assert rows_of(reader) == sorted([*LAST_ROWS[1:], (7, "n", 7.0)], key=repr)
    assert [v for v in storage.children(spark, path) if v.startswith("v=")] == [f"v=0000000{i}" for i in (1, 2, 3, 4)]
    assert tables.expire_versions(spark, path) == []
    assert tables.expire_versions(spark, path, -60) == [0, 1, 2, 3]
    assert storage.children(spark, path) == ["v=00000004"]


def test_update_of_a_new_table(spark, tmp_path):
    path = str(tmp_path / "new")
    update_table(change_data(spark), path, find_format("orc"))
    assert rows_of(read_table(spark, path, find_format("orc"))) == LAST_ROWS


def test_failed_update_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    update_table(change_data(spark), path)
    broken = change_data(spark).withColumn(
        "value", F.when(F.col("key.i") == 8, F.raise_error(F.lit("broken"))).otherwise(F.col("value"))
    )
    with pytest.raises(Exception, match="broken"):
        update_table(broken, path)
    (tmp_path / "t" / "v=00000002").mkdir()
    assert rows_of(read_table(spark, path)) == LAST_ROWS
    update_table(change_data(spark), path)
    assert tables.versions(spark, path) == [1, 2]


def regional_changes(spark, rows):
    data = [((r, i), None if s is None else (r, i, s), n) for n, (r, i, s) in enumerate(rows)]
    return spark.createDataFrame(
        data, "key struct<r: string, i: int>, value struct<r: string, i: int, s: string>, offset bigint"
    )


def test_update_touches_changed_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [("01", 1, "a"), ("01", 2, "b"), ("02", 1, "c"), ("03", 1, "d"), (None, 1, "e")]
    update_table(regional_changes(spark, first), path, partition_by=["r"])
    untouched = sorted(p.name for p in (tmp_path / "t" / "r=02").iterdir())
    second = [("01", 1, "A"), ("01", 2, None), ("03", 1, None), ("04", 9, "f"), (None, 1, "E"), ("05", 5, None)]
    rows = update_table(regional_changes(spark, second), path, partition_by=["r"])
    expected = [("01", 1, "A"), ("02", 1, "c"), ("04", 9, "f"), (None, 1, "E")]
    schema = "r string, i int, s string"
    assert rows == 3
    assert rows_of(read_table(spark, path, schema=schema).select("r", "i", "s")) == sorted(expected, key=repr)
    assert sorted(p.name for p in (tmp_path / "t" / "r=02").iterdir()) == untouched
    assert not (tmp_path / "t" / "r=03").exists()


@pytest.mark.parametrize("name", ["orc", "json", "csv"])
def test_partitioned_update_of_other_formats(spark, tmp_path, name):
    path, fmt, schema = str(tmp_path / "t"), find_format(name), "r string, i int, s string"
    update_table(regional_changes(spark, [("01", 1, "a"), ("02", 2, "b")]), path, fmt, ["r"])
    update_table(regional_changes(spark, [("01", 1, None), ("02", 3, "c"), ("03", 4, "d")]), path, fmt, ["r"])
    stored = read_table(spark, path, fmt, schema).select("r", "i", "s")
    assert rows_of(stored) == [("02", 2, "b"), ("02", 3, "c"), ("03", 4, "d")]
    update_table(regional_changes(spark, [("02", 2, None), ("02", 3, None), ("03", 4, None)]), path, fmt, ["r"])
    update_table(regional_changes(spark, [("04", 1, "e")]), path, fmt, ["r"])
    assert rows_of(read_table(spark, path, fmt, schema).select("r", "i", "s")) == [("04", 1, "e")]


def test_update_needs_a_file_format(spark, tmp_path):
    with pytest.raises(ValueError, match="cannot be updated"):
        update_table(change_data(spark), str(tmp_path / "t"), FileFormat("letters"))


def test_update_leaves_other_files_alone(spark, tmp_path):
    path = tmp_path / "t"
    log_data(spark).write.parquet(str(path))
    (path / "_note.txt").write_text("mine")
    for _ in range(3):
        update_table(change_data(spark), str(path))
    tables.expire_versions(spark, str(path), -60)
    assert sorted(p.name for p in path.iterdir() if not p.name.startswith(".")) == ["_note.txt", "v=00000003"]


def test_update_never_drops_a_column(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("01", 1, "a", 5)], "r string, i int, s string, more int").write.partitionBy("r").parquet(path)
    with pytest.raises(ValueError, match="more"):
        update_table(regional_changes(spark, [("01", 1, "b")]), path, partition_by=["r"])
    with pytest.raises(ValueError, match="more"):
        update_table(regional_changes(spark, [("01", 1, "b")]), path)


partition_rows = st.lists(
    st.tuples(st.sampled_from([None, "01", "02", "x y"]), st.integers(0, 2), st.one_of(st.none(), st.text("ab", min_size=1, max_size=2))),
    max_size=12,
)


@settings(max_examples=6, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(partition_rows, min_size=1, max_size=3))
def test_partitioned_update_replays_the_log(spark, tmp_path, batches):
    path = storage.scratch_dir(spark, "partitioned")
    state = {}
    for batch in batches:
        update_table(regional_changes(spark, batch), path, partition_by=["r"])
        for r, i, s in batch:
            state.pop((r, i), None)
            if s is not None:
                state[r, i] = s
    stored = read_table(spark, path, schema="r string, i int, s string").select("r", "i", "s")
    assert rows_of(stored) == sorted(((r, i, s) for (r, i), s in state.items()), key=repr)


def test_only_changed_pairs_of_partition_values_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(9).selectExpr("id div 3 AS p", "id % 3 AS q", "id AS i", "'old' AS s")
    update_table(rows.selectExpr("struct(p, q, i) AS key", "struct(p, q, i, s) AS value", "i AS offset"), path, partition_by=["p", "q"])
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("p=*/q=*/*.parquet")}
    changes = rows.where("p = q").selectExpr("struct(p, q, i) AS key", "struct(p, q, i, 'new' AS s) AS value", "i AS offset")
    update_table(changes, path, partition_by=["p", "q"])
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("p=*/q=*/*.parquet")}
    kept = {f for f in before if after.get(f) == before[f]}
    assert len(before) == 9 and len(kept) == 6 and len(after) == 9
    assert read_table(spark, path).where("s = 'new' AND p = q OR s = 'old' AND p <> q").count() == 9


def test_overwrite_replaces_all_partitions(spark, tmp_path):
    path, fmt = str(tmp_path / "t"), find_format("parquet")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        fmt.write(spark.createDataFrame([(1, "a"), (2, "b")], "i int, p string"), path, "overwrite", ["p"])
        fmt.write(spark.createDataFrame([(3, "b")], "i int, p string"), path, "overwrite", ["p"])
        assert rows_of(spark.read.parquet(path).select("i", "p")) == [(3, "b")]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_csv_keeps_texts(spark, tmp_path):
    texts = ['plain', 'two\nlines', 'a "quoted" word', ' blanks ', 'comma, semicolon;', 'back\\slash"', "tab\t", "", None, "carriage\r\nreturn", "007"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    fmt, path = find_format("csv"), str(tmp_path / "t")
    fmt.write(df, path)
    # Spark's CSV does not tell an empty text from a null.
    assert rows_of(fmt.read(spark, path, "i int, s string")) == rows_of(df.replace({"": None}, subset=["s"]))


def test_batch_and_stream_do_not_share_a_directory(spark, tmp_path):
    fmt, source = find_format("parquet"), str(tmp_path / "in")
    fmt.write(spark.range(3).selectExpr("id"), source)
    fmt.write(spark.range(2).selectExpr("id"), str(tmp_path / "batch"))
    with pytest.raises(ValueError, match="batch"):
        fmt.write_stream(fmt.read_stream(spark, source), str(tmp_path / "batch"))
    writer = fmt.write_stream(fmt.read_stream(spark, source), str(tmp_path / "out"))
    writer.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    with pytest.raises(ValueError, match="stream"):
        fmt.write(spark.range(1), str(tmp_path / "out"), "append")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_small_change_sets_do_not_shuffle_the_target(spark, tmp_path):
    from sluiceway.operators.update import apply_latest

    target, staged = str(tmp_path / "t"), str(tmp_path / "s")
    log_data(spark).write.parquet(target)
    change_data(spark).select("key", "value").write.parquet(staged)
    plan = plan_of(apply_latest(spark.read.parquet(target), spark.read.parquet(staged)))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(apply_latest(spark.read.parquet(target), spark.read.parquet(staged)))
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def offsets(spark, path):
    return {
        r["partition"]: sorted(r["o"])
        for r in read_log(spark, path).groupBy("partition").agg(F.collect_list("offset").alias("o")).collect()
    }


def skewed(spark, n=5000):
    # A third of the rows have one key.
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string"))
    return spark.range(0, n, 1, 7).select(key.alias("key"), F.col("id").cast("string").alias("value"), "id")


def test_topic_offsets_are_dense_and_ordered(spark, tmp_path):
    path = str(tmp_path / "topic")
    assert append_log(skewed(spark), path, partitions=3, order_by="id") == 5000
    append_log(skewed(spark), path, order_by=["id"])
    found = offsets(spark, path)
    assert set(found) <= {0, 1, 2}
    assert all(o == list(range(len(o))) for o in found.values())
    rows = read_log(spark, path).filter("offset < 100").collect()
    for partition in found:
        ordered = sorted((r["offset"], int(r["value"])) for r in rows if r["partition"] == partition)
        assert [v for _, v in ordered] == sorted(v for _, v in ordered)
    assert read_log(spark, path).schema.names == [
        "key", "value", "topic", "partition", "offset", "timestamp", "timestampType",
    ]
    assert {r["topic"] for r in rows} == {"topic"}


def test_topic_without_order_keeps_the_input_order(spark, tmp_path):
    path = str(tmp_path / "topic")
    append_log(skewed(spark).drop("id"), path, partitions=1)
    rows = sorted(read_log(spark, path).collect(), key=lambda r: r["offset"])
    assert [int(r["value"]) for r in rows] == list(range(5000))


def test_topic_splits_runs_of_one_order_value(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 4).select(F.col("id").cast("string").alias("value"), F.lit(1).alias("same"))
    path = str(tmp_path / "topic")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        append_log(rows, path, partitions=1, order_by="same")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert offsets(spark, path) == {0: list(range(4000))}
    files = [f for f in (tmp_path / "topic").iterdir() if f.name.endswith(".parquet")]
    assert len(files) > 1


def test_topic_tags_and_limits(spark, tmp_path):
    path = str(tmp_path / "topic")
    rows = skewed(spark, 10).drop("id")
    append_log(rows, path, tag="job#1")
    assert append_log(rows, path, tag="job#1") == 0
    append_log(rows, path, tag="job#2")
    assert read_log(spark, path).count() == 20
    append_log(rows.limit(0), path)
    append_log(rows, path)
    assert all(o == list(range(len(o))) for o in offsets(spark, path).values())
    with pytest.raises(ValueError, match="8 partitions"):
        append_log(rows, path, partitions=4)
    with pytest.raises(ValueError, match="no change log"):
        read_log(spark, str(tmp_path / "nowhere"))


def test_topic_null_keys_and_given_partitions(spark, tmp_path):
    path = str(tmp_path / "nulls")
    rows = spark.range(200).select(F.lit(None).cast("string").alias("key"), F.col("id").cast("string").alias("value"))
    append_log(rows, path, partitions=4)
    assert len(offsets(spark, path)) == 4
    given_path = str(tmp_path / "given")
    append_log(rows.withColumn("partition", F.col("value").cast("int") % 2), given_path)
    assert {p: len(o) for p, o in offsets(spark, given_path).items()} == {0: 100, 1: 100}


def test_topic_copy_keeps_the_order_of_changes(spark, tmp_path):
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    append_log(encode_json(change_data(spark), keep=["offset"]), first, partitions=2, order_by="offset")
    store = ChangeLogStore(second, partitions=3)
    assert store.write(read_log(spark, first), "append") == len(CHANGE_ROWS)
    decoded = decode_json(read_log(spark, second), VALUE_DDL, "i int")
    assert rows_of(snapshot(decoded)) == LAST_ROWS


def test_tables_with_a_value_column_are_wrapped(spark, tmp_path):
    table = spark.createDataFrame([("k", 1.5, "more")], "key string, value double, other string")
    ChangeLogStore(str(tmp_path / "t")).write(table, "overwrite")
    back = unwrap(decode_json(read_log(spark, str(tmp_path / "t")), "key string, value double, other string"))
    assert rows_of(back) == rows_of(table)


def test_kafka_is_guarded(spark):
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
    except Exception:
        with pytest.raises(ConnectorMissing):
            read_kafka(spark, "localhost:9092", "t")
        with pytest.raises(ConnectorMissing):
            BrokerStore("localhost:9092", "t").write(wrap(log_data(spark)), "append")


def test_build_stores():
    files = build_store({"local": {"path": "/x/", "dataFormat": "ORC", "partitionBy": ["a"]}}, "source")
    assert (files.path, files.format.name, files.partition_by) == ("/x", "orc", ("a",))
    bucket = {"endpoint": "http://e", "bucket": "b", "objectKey": "k/o", "dataFormat": "parquet", "access_key": "A", "secretKey": "S"}
    objects = build_store({"cos": {**bucket, "bucket": "other"}, "s3": bucket}, "source")
    assert objects.path == object_url("b", "k/o") == "s3a://b/k/o"
    assert objects.options["fs.s3a.bucket.b.access.key"] == "A"
    assert objects.options["fs.s3a.bucket.b.secret.key"] == "S"
    broker = build_store(
        {"kafka": {"kafkaBrokers": "h:1", "kafkaTopic": "t", "valueSchema": "a int", "kafka.security.protocol": "SASL_SSL"}},
        "source",
    )
    assert (broker.topic, broker.format, broker.needs_inference) == ("t", "json", False)
    assert broker.options == {"kafka.security.protocol": "SASL_SSL"}


def test_broker_login():
    base = {"kafkaBrokers": "h:1", "kafkaTopic": "t", "user": "u", "password": 'p"w'}
    options = build_store({"kafka": {**base, "sslTruststoreLocation": "/t"}}, "source").options
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert options["kafka.sasl.mechanism"] == "SCRAM-SHA-512"
    assert options["kafka.sasl.jaas.config"].endswith('ScramLoginModule required username="u" password="p\\"w";')
    assert options["kafka.ssl.truststore.location"] == "/t"
    plain = build_store({"kafka": {**base, "saslMechanism": "plain", "securityProtocol": "sasl_plaintext"}}, "source")
    assert "PlainLoginModule" in plain.options["kafka.sasl.jaas.config"]
    assert plain.options["kafka.security.protocol"] == "SASL_PLAINTEXT"
    with pytest.raises(ValueError, match="gssapi"):
        build_store({"kafka": {**base, "saslMechanism": "gssapi"}}, "source")
    assert build_store({"kafka": {**base, "user": ""}}, "source").options == {}


def test_registered_schema_ids_are_numbers():
    store = build_store({"topic": {"path": "/t", "dataFormat": "avro", "schemas": {"value": {"9": "a", "10": "b"}}}}, "source")
    assert store.schemas["registry"] == {"value": {9: "a", 10: "b"}}


@pytest.mark.parametrize(
    "config",
    [
        {},
        {"unknown": {}},
        {"local": {"path": "/x"}},
        {"local": {"path": "/x", "dataFormat": "parquet", "pathh": 1}},
        {"local": {"path": "/x", "dataFormat": "nope"}},
        {"kafka": {"kafkaBrokers": "h:1"}},
        {"kafka": {"kafkaBrokers": "h:1", "kafkaTopic": "t", "keySchema": "a int"}},
        {"kafka": {"kafkaBrokers": "h:1", "kafkaTopic": "t", "keyDeserializer": "a", "valueDeserializer": "b"}},
        {"s3": {"endpoint": "e", "bucket": "b", "objectKey": "k"}},
        {"class": "no.such.Builder"},
    ],
)
def test_stores_that_cannot_be_built(config):
    with pytest.raises(ValueError):
        build_store(config, "source")


def build_elsewhere(config, role):
    return FileStore(config["where"], "parquet")


def test_store_registry_and_class():
    register_store("mine", build_elsewhere)
    assert build_store({"mine": {"where": "/m"}}, "source").path == "/m"
    unregister_store("mine")
    with pytest.raises(ValueError):
        build_store({"mine": {"where": "/m"}}, "source")
    assert build_store({"class": "test_sources.build_elsewhere", "where": "/c"}, "destination").path == "/c"


def test_scratch_needs_a_shared_folder(spark):
    assert storage.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_broker_settings_that_are_not_used(spark, caplog):
    store = build_store({"kafka": {"kafkaBrokers": "b:1", "kafkaTopic": "t", "schemaRegistryURL": "http://r", "sslTruststore": "AAAA"}}, "source")
    assert "schemas" in caplog.text and "sslTruststoreLocation" in caplog.text
    with pytest.raises(ValueError, match="broker"):
        store.delete(spark)


def test_a_stream_into_a_broker_says_what_is_missing(spark, tmp_path):
    from sluiceway import run

    log_data(spark).write.parquet(str(tmp_path / "in"))
    flow = {
        "flowType": "stream",
        "source": {"local": {"path": str(tmp_path / "in"), "dataFormat": "parquet"}},
        "destination": {"kafka": {"kafkaBrokers": "b:1", "kafkaTopic": "t"}},
        "checkpointLocation": str(tmp_path / "c"),
    }
    with pytest.raises(ConnectorMissing, match="spark-sql-kafka"):
        run(spark, flow)
