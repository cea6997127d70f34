from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pytest
from corpus_helpers import EXTRA

from sluiceway.llm import whitening

NAMES = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def vectors(spark, rows, extra=False):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    for name in EXTRA + ["id", "vector", "n", "component"] if extra else []:
        df = df.withColumn(name, df["vec_id"] * 0) if name not in df.columns else df
    return df


def check(df, kept, components=8):
    """Against a dense decomposition; signs are free."""
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in kept], dtype=object)
    n, d = x.shape
    sums = x.sum(axis=0)
    away = np.array((n * x - sums), dtype=float) / n
    values, axes = np.linalg.eigh(away.T @ away / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, d)
    found = df.select(NAMES).collect()
    assert len(found) == n * k
    by_key = {}
    for row in found:
        by_key.setdefault((row["id"], row["component"]), []).append(row)
    deviations = sorted(int(y) for y in ((n * x - sums) ** 2).sum(axis=1))
    assert sorted(int(r["deviation"]) for r in found if r["component"] == 1) == deviations
    assert {r["n"] for r in found} == {n} and len({r["identity_error"] for r in found}) == 1
    assert found[0]["identity_error"] < 1e-6
    for c in range(k):
        explained = {r["explained"] for r in found if r["component"] == c + 1}
        assert len(explained) == 1
        positive = values[c] > d * 1e-14 * max(values[0], 1e-300) and values[c] > 0
        if values.sum() > 0:
            assert abs(explained.pop() - (values[c] / values.sum() if positive else 0)) < 1e-9
        want = (away @ axes[:, c]) / math.sqrt(values[c]) if positive else None
        got = [by_key[i, c + 1][0]["whitened"] for i, _ in kept]
        if want is None:
            assert got == [None] * n
        else:
            alone = min(abs(values[c] - values[e]) for e in range(d) if e != c) > 1e-6 * values[0] if d > 1 else True
            if alone:
                assert min(np.abs(np.array(got) - want).max(), np.abs(np.array(got) + want).max()) < 1e-6


@pytest.mark.parametrize("kind", ["spread", "low rank", "copies", "constant", "one", "two dimensions"])
def test_against_a_dense_decomposition(spark, kind):
    rng = np.random.default_rng(len(kind))
    if kind == "low rank":
        data = rng.normal(size=(90, 3)) @ rng.integers(-3, 4, (3, 12)) * 0
        data += rng.integers(-9, 9, (90, 3)) @ rng.integers(-3, 4, (3, 12))
    elif kind == "copies":
        data = rng.normal(size=(7, 10))[np.concatenate([np.zeros(60, int), rng.integers(0, 7, 60)])]
    elif kind == "constant":
        data = np.full((20, 9), 0.25)
    elif kind == "one":
        data = rng.normal(size=(1, 9))
    else:
        data = rng.normal(size=(150, 2 if kind == "two dimensions" else 16)) * np.arange(1, 3 if kind == "two dimensions" else 17)
    rows = list(enumerate(data.tolist()))
    df = vectors(spark, rows, extra=True).repartition(5)
    check(whitening.whitened(df), rows)


def test_many_tasks_are_combined_in_small_groups(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    rows = list(enumerate(np.random.default_rng(8).normal(size=(120, 9)).tolist()))
    check(whitening.whitened(vectors(spark, rows).repartition(20), components=3), rows, 3)


def test_vectors_that_take_no_part(spark):
    rng = np.random.default_rng(3)
    kept = [(i % 20, v) for i, v in enumerate(rng.normal(size=(40, 4)).tolist())]
    odd = [(50, None), (51, []), (52, [1, None, 2, 3]), (53, [1, math.nan, 2, 3]), (54, [1, 2, math.inf, 3]), (55, [1, 2, 3]), (56, [-math.inf, 1, 2, 3])]
    found = whitening.whitened(vectors(spark, kept + odd, extra=True)).collect()
    assert len(found) == 160 and {r["id"] for r in found} == set(range(20)) and {r["n"] for r in found} == {40}


def test_deviations_beyond_64_bits_are_exact(spark):
    rows = [(i, [x, 0.0]) for i, x in enumerate([1e13, -1e13, 5.0, None])][:3]
    found = {r["id"]: r["deviation"] for r in whitening.whitened(vectors(spark, rows)).collect()}
    x = [math.floor(1024 * v[0]) + 100000 for _, v in rows]
    assert found == {i: Decimal((3 * x[i] - sum(x)) ** 2) for i in range(3)}
    with pytest.raises(Exception, match="64-bit"):
        whitening.whitened(vectors(spark, [(1, [1e30]), (2, [1.0])])).collect()


def test_no_rows(spark):
    for rows in ([], [(1, None)], [(1, [])]):
        df = whitening.whitened(vectors(spark, rows))
        assert df.columns == NAMES and df.collect() == []


def test_updates_keep_the_spectrum():
    """Directly, after every kind of update: the basis stays orthogonal and gives the scatter back."""
    rng = np.random.default_rng(6)
    data = np.concatenate([rng.integers(-5, 6, (40, 8)), np.repeat(rng.integers(-500, 501, (3, 8)), 9, axis=0), rng.integers(-1, 2, (30, 2)) @ rng.integers(-9, 9, (2, 8))])
    halves = []
    for part in (data[:50], data[50:]):
        spectrum = None
        for row in part:
            spectrum = whitening.with_vector(spectrum, row)
        halves.append(spectrum)
    for got, rows in ((halves[0], data[:50]), (halves[1], data[50:]), (whitening.combined(*halves), data), (whitening.combined(*halves[::-1]), data)):
        away = rows - rows.mean(axis=0)
        scatter = away.T @ away
        assert got.n == len(rows) and got.sums == rows.sum(axis=0).tolist()
        assert np.abs(got.axes.T @ got.axes - np.eye(8)).max() < 1e-12
        assert np.abs(got.axes * got.values @ got.axes.T - scatter).max() < 1e-11 * scatter.max()
    assert whitening.with_vector(whitening.with_vector(None, data[0]), data[1], 3).values[-1] == pytest.approx(np.linalg.eigvalsh(np.cov(data[[0, 1, 1, 1]].T, bias=True) * 4)[-1])
