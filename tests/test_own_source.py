"""Formats that are Python data sources."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import log_data, rows_of
from sluiceway import run
from sluiceway.sources import find_format
from sluiceway.sources.arrow_files import ArrowFiles

NESTED = "i int, s string, at timestamp_ntz, amount decimal(20,3), inner struct<x: bigint, of: array<string>>"


def nested(spark, n=50):
    return spark.range(n).selectExpr(
        "cast(id AS int) AS i",
        "nullif(concat('t', id), 't3') AS s",
        "timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) AS at",
        "cast(id / 7 AS decimal(20, 3)) AS amount",
        "named_struct('x', id, 'of', array(string(id), null)) AS inner",
    )


@pytest.mark.parametrize("name", ["arrow", "ARROW", "sluiceway.sources.arrow_files.ArrowFiles", ArrowFiles])
def test_round_trip(spark, tmp_path, name):
    path, fmt = str(tmp_path / "t"), find_format(name)
    fmt.write(nested(spark).repartition(3), path)
    assert fmt.read(spark, path).schema.simpleString() == nested(spark).schema.simpleString()
    assert rows_of(fmt.read(spark, path)) == rows_of(nested(spark))
    fmt.write(nested(spark, 5), path, "append")
    assert fmt.read(spark, path).count() == 55
    fmt.write(nested(spark, 7), f"file:{path}")
    assert rows_of(fmt.read(spark, path, NESTED)) == rows_of(nested(spark, 7))
    assert rows_of(fmt.read(spark, path, "s string, other double").where("s = 't5'")) == [("t5", None)]


def test_a_write_that_fails_leaves_nothing(spark, tmp_path):
    path, fmt = tmp_path / "t", find_format("arrow")
    fmt.write(nested(spark, 10), str(path))
    before = sorted(p.name for p in path.iterdir())
    # A task that ends after the abort may leave a file aside, where no reader looks.
    seen = lambda: sorted(p.name for p in path.iterdir() if p.name != "_temporary")
    broken = nested(spark, 40).repartition(4).withColumn("i", F.when(F.col("i") == 33, F.raise_error(F.lit("broken"))).otherwise(F.col("i")))
    for operation in ("overwrite", "append"):
        with pytest.raises(Exception, match="broken"):
            fmt.write(broken, str(path), operation)
        assert seen() == before and fmt.read(spark, str(path)).count() == 10


def test_no_rows_and_no_files(spark, tmp_path):
    fmt = find_format("arrow")
    fmt.write(nested(spark, 0), str(tmp_path / "empty"))
    assert fmt.read(spark, str(tmp_path / "empty")).collect() == []
    with pytest.raises(Exception, match="no Arrow files"):
        fmt.read(spark, str(tmp_path / "nowhere")).collect()
    with pytest.raises(ValueError, match="partitioned"):
        fmt.write(nested(spark), str(tmp_path / "p"), partition_by=["i"])


def test_in_flows(spark, tmp_path):
    log_data(spark).write.parquet(str(tmp_path / "in"))
    middle = {"local": {"path": str(tmp_path / "middle"), "dataFormat": "arrow"}}
    assert run(spark, {"source": {"local": {"path": str(tmp_path / "in"), "dataFormat": "parquet"}}, "destination": middle}).rows == 3
    run(spark, {"source": middle, "destination": {"local": {"path": str(tmp_path / "out"), "dataFormat": "orc"}}})
    assert rows_of(spark.read.orc(str(tmp_path / "out"))) == rows_of(log_data(spark))
