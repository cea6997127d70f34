from __future__ import annotations

import hashlib
import zlib

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from helpers import CHANGE_ROWS, LIVE_ROWS, LOG_ROWS, change_data, log_data, plan_of, rows_of
from pyspark.sql import functions as F
from sluiceway.functions import ALGORITHMS
from sluiceway.operators import (
    CHANGE,
    Step,
    apply_steps,
    digest_columns,
    filter_rows,
    load_steps,
    merge_steps,
    redact_columns,
    remove_columns,
    sample_rows,
)

ALPHABET = "abcdefghijklmnopqrstuvwxyz"
TEXTS = [ALPHABET[n:] + ALPHABET[:n] for n in range(3)]
# murmur3 (seed 42) of the three texts.
MURMUR3 = [-1990933474, 108557723, 2056360226]
GOLDEN = {
    "md5": [hashlib.md5(t.encode()).hexdigest() for t in TEXTS],
    "sha1": [hashlib.sha1(t.encode()).hexdigest() for t in TEXTS],
    "sha2": [hashlib.sha512(t.encode()).hexdigest() for t in TEXTS],
    "crc32": [zlib.crc32(t.encode()) for t in TEXTS],
    "murmur3": MURMUR3,
}
DIGEST_TYPE = {"md5": "string", "sha1": "string", "sha2": "string", "crc32": "bigint", "murmur3": "int"}


def test_remove_log(spark):
    result = remove_columns(log_data(spark), ["i"])
    assert result.columns == ["s", "d"]
    assert result.count() == 3


def test_remove_change(spark):
    result = remove_columns(change_data(spark), ["s"], form=CHANGE)
    assert result.schema["key"].dataType.names == ["i"]
    assert result.schema["value"].dataType.names == ["i", "d"]
    assert result.count() == len(CHANGE_ROWS)
    assert result.filter("value IS NULL").count() == len(CHANGE_ROWS) - len(LIVE_ROWS)


def test_remove_refuses_to_leave_nothing(spark):
    with pytest.raises(ValueError):
        remove_columns(log_data(spark), ["i", "s", "d"])
    with pytest.raises(ValueError):
        remove_columns(change_data(spark), ["i"], form=CHANGE)


def test_source_order_is_kept_with_many_columns(spark):
    wide = spark.range(1).select(*[F.col("id").alias(f"c{n}") for n in range(9, 0, -1)])
    assert remove_columns(wide, ["c5"]).columns == ["c9", "c8", "c7", "c6", "c4", "c3", "c2", "c1"]
    assert redact_columns(wide, ["c5"]).columns == wide.columns


def test_names_with_dots_and_spaces(spark):
    odd = spark.createDataFrame([(1, 2)], ["a.b", "c d"])
    assert rows_of(redact_columns(odd, ["a.b"], "x")) == [("x", 2)]
    assert remove_columns(odd, ["c d"]).columns == ["a.b"]
    nested = odd.select(F.struct("`a.b`", "`c d`").alias("value"))
    assert rows_of(redact_columns(nested, ["a.b"], "x", form=CHANGE).select("value.*")) == [("x", 2)]


def test_missing_columns(spark, caplog):
    assert remove_columns(log_data(spark), ["nope"]).columns == ["i", "s", "d"]
    assert "nope" in caplog.text
    for step in (remove_columns, redact_columns, digest_columns):
        with pytest.raises(ValueError, match="nope"):
            step(log_data(spark), ["nope"], strict=True)


def test_case_mismatch_raises(spark):
    for step in (remove_columns, redact_columns, digest_columns):
        with pytest.raises(ValueError, match="case"):
            step(log_data(spark), ["S"])
        with pytest.raises(ValueError, match="case"):
            step(change_data(spark), ["S"], form=CHANGE)


def test_redact(spark):
    assert {r["s"] for r in redact_columns(log_data(spark), ["s"]).collect()} == {"XXXXXXXXXX"}
    numbers = redact_columns(log_data(spark), ["i", "d"], "-")
    assert rows_of(numbers) == [("-", "a", "-"), ("-", "b", "-"), ("-", "c", "-")]
    nulls = spark.createDataFrame([(None,), ("x",)], "s string")
    assert rows_of(redact_columns(nulls, ["s"], "r")) == [("r",), ("r",)]


def test_redact_change(spark):
    result = redact_columns(change_data(spark), ["s"], form=CHANGE)
    assert result.schema["value"].dataType.names == ["i", "s", "d"]
    live = result.filter("value IS NOT NULL").select("value.s").distinct().collect()
    assert [r["s"] for r in live] == ["XXXXXXXXXX"]
    assert result.filter("value IS NULL").count() == len(CHANGE_ROWS) - len(LIVE_ROWS)


def test_undecoded_key_is_left_alone(spark):
    binary = change_data(spark).withColumn("key", F.encode(F.col("key.i").cast("string"), "UTF-8"))
    result = redact_columns(binary, ["i"], form=CHANGE)
    assert result.schema["key"].dataType.simpleString() == "binary"
    assert result.schema["value"].dataType["i"].dataType.simpleString() == "string"


@pytest.mark.parametrize("algo", ALGORITHMS)
def test_digest_golden(spark, algo):
    texts = spark.createDataFrame([(n, t) for n, t in enumerate(TEXTS)], "n int, s string")
    result = digest_columns(texts, ["s"], algo.upper())
    assert result.schema["s"].dataType.simpleString() == DIGEST_TYPE[algo]
    assert [r["s"] for r in result.orderBy("n").collect()] == GOLDEN[algo]
    change = texts.select(F.struct("n").alias("key"), F.struct("n", "s").alias("value"))
    result = digest_columns(change, ["s"], algo, form=CHANGE)
    assert [r["s"] for r in result.select("value.*").orderBy("n").collect()] == GOLDEN[algo]


def test_digest_of_null_and_nested(spark):
    data = spark.sql("SELECT CAST(NULL AS STRING) AS s, array(1, 2) AS a, named_struct('x', 1) AS n, date'2020-01-02' AS d")
    row = digest_columns(data, ["s", "a", "n", "d"]).head(1)[0]
    expected = [hashlib.md5(t).hexdigest() for t in (b"[1,2]", b'{"x":1}', b"2020-01-02")]
    assert [row["s"], row["a"], row["n"], row["d"]] == [None, *expected]
    assert digest_columns(data.select("s"), ["s"], "murmur3").head(1)[0]["s"] == 42


def test_unknown_algorithm(spark):
    with pytest.raises(ValueError, match="md5000"):
        digest_columns(log_data(spark), ["s"], "md5000")
    with pytest.raises(ValueError, match="md5000"):
        load_steps([{"name": "d", "action": "digestcolumns", "columns": ["s"], "options": {"algo": "md5000"}}])


def test_filter(spark):
    assert rows_of(filter_rows(log_data(spark), "i == 1")) == [LOG_ROWS[0]]
    assert filter_rows(change_data(spark), "key.i == 1").count() == 3
    assert filter_rows(change_data(spark), "value.d > 2").count() == sum(d > 2 for _, _, d in LIVE_ROWS)
    with pytest.raises(ValueError, match="clause"):
        load_steps([{"name": "f", "action": "filterrows"}])


def test_sample(spark):
    data = spark.range(20000)
    default = sample_rows(data, seed=1)
    assert 4500 < default.count() < 5500
    assert default.count() == sample_rows(data, seed=1).count()
    assert default.distinct().count() == default.count()
    assert sample_rows(data, 1.0).count() == 20000
    step = load_steps([{"name": "s", "action": "SampleRows", "options": {"fraction": "0.5", "seed": "3"}}])
    assert 9500 < apply_steps(data, step).count() < 10500


class Doubling:
    def __init__(self, name, columns, options):
        self.columns, self.factor = columns, int(options.get("factor", 2))

    def log(self, df):
        return df.withColumns({c: F.col(c) * self.factor for c in self.columns})

    def change(self, df):
        return df.withColumn("value", F.col("value").withField("d", F.col("value.d") * self.factor))


def test_custom_class(spark):
    config = {"name": "c", "action": "class", "class": "test_governance.Doubling", "columns": ["d"], "options": {"factor": 3}}
    steps = load_steps([config])
    assert rows_of(apply_steps(log_data(spark), steps)) == [(i, s, d * 3) for i, s, d in LOG_ROWS]
    assert apply_steps(change_data(spark), steps, CHANGE).filter("value.d > 11").count() == 1
    with pytest.raises(ValueError, match="nowhere"):
        load_steps([{"name": "c", "action": "class", "class": "nowhere.Thing"}])


def test_loading_rejects():
    with pytest.raises(ValueError, match="unknown action"):
        load_steps([{"name": "x", "action": "RemoveColumn"}])
    with pytest.raises(ValueError, match="unknown keys"):
        load_steps([{"name": "x", "action": "noop", "colums": ["a"]}])
    with pytest.raises(ValueError, match="name"):
        load_steps([{"action": "noop"}])
    assert load_steps(None) == []


def test_merge_fuses_neighbours_only():
    remove = [Step(n, "removecolumns", (n,)) for n in "abc"]
    keep = Step("f", "filterrows", options={"clause": "c > 1"})
    assert [s.columns for s in merge_steps(remove)] == [("a", "b", "c")]
    merged = merge_steps([remove[0], remove[1], keep, remove[2]])
    assert [(s.action, s.columns) for s in merged] == [
        ("removecolumns", ("a", "b")),
        ("filterrows", ()),
        ("removecolumns", ("c",)),
    ]


def test_filter_between_removals_sees_its_column(spark):
    steps = load_steps(
        [
            {"name": "a", "action": "removecolumns", "columns": ["i"]},
            {"name": "f", "action": "filterrows", "options": {"clause": "d > 1"}},
            {"name": "b", "action": "removecolumns", "columns": ["d"]},
        ]
    )
    assert rows_of(apply_steps(log_data(spark), steps)) == [("b",), ("c",)]


def test_plans_prune_and_push(spark, tmp_path):
    path = str(tmp_path / "log")
    log_data(spark).write.parquet(path)
    steps = load_steps(
        [
            {"name": "r", "action": "redactcolumns", "columns": ["s"]},
            {"name": "m", "action": "removecolumns", "columns": ["d"]},
            {"name": "f", "action": "filterrows", "options": {"clause": "i > 1"}},
        ]
    )
    plan = plan_of(apply_steps(spark.read.parquet(path), steps))
    assert "ReadSchema: struct<i:int>" in plan
    assert "PushedFilters: [IsNotNull(i), GreaterThan(i,1)]" in plan


def test_plans_push_into_structs(spark, tmp_path):
    path = str(tmp_path / "change")
    change_data(spark).write.parquet(path)
    steps = load_steps(
        [
            {"name": "r", "action": "redactcolumns", "columns": ["s"]},
            {"name": "d", "action": "digestcolumns", "columns": ["d"]},
            {"name": "f", "action": "filterrows", "options": {"clause": "value.i > 1"}},
        ]
    )
    plan = plan_of(apply_steps(spark.read.parquet(path), steps, CHANGE))
    assert "GreaterThan(value.i,1)" in plan
    assert "Python" not in plan


cells = st.one_of(st.none(), st.tuples(st.integers(0, 3), st.text(ALPHABET, max_size=3), st.floats(0, 9)))


@settings(max_examples=8, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.tuples(st.integers(0, 3)), cells), min_size=1, max_size=20))
def test_deletes_survive_every_step(spark, rows):
    data = change_data(spark, rows)
    steps = load_steps(
        [
            {"name": "r", "action": "redactcolumns", "columns": ["s"]},
            {"name": "d", "action": "digestcolumns", "columns": ["i"]},
            {"name": "m", "action": "removecolumns", "columns": ["d"]},
        ]
    )
    result = apply_steps(data, steps, CHANGE)
    deleted = sorted(o for o, (_, v) in enumerate(rows) if v is None)
    assert sorted(r["offset"] for r in result.filter("value IS NULL").collect()) == deleted
