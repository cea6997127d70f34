from __future__ import annotations

import math
import random

import numpy as np
import pytest

from sluiceway.llm import mtree, sharding


def plain_top(rows, k, step):
    whole = {}
    for i, (vec_id, vector) in enumerate(rows):
        if vec_id is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            whole[i] = (vec_id, [math.floor(256 * x) for x in vector])
    out = set()
    for vec_id, query in whole.values():
        if vec_id % step:
            continue
        scores = sorted((-sum(a * b for a, b in zip(query, v, strict=True)), i) for i, v in whole.values() if i != vec_id and len(v) == len(query))
        out |= {(vec_id, rank, i, -score) for rank, (score, i) in enumerate(scores[:k], 1)}
    return out


def vectors():
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) + 3 * (i % 4 == d) for d in range(8)]) for i in range(400)]
    rows += [(500 + i, [0.5] * 8) for i in range(150)] + [(700, [0.0] * 8), (750, [0.0] * 8)]
    rows += [(None, [1.0] * 8), (800, None), (850, []), (900, [1.0, None]), (901, [float("nan")] * 8), (902, [float("inf")] * 8), (950, [1.0, 2.0]), (951, [1.0, -2.0])]
    return rows


def result(df):
    return {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect()}


def vector_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS block", "2 AS dims", "3 AS vector", "4 AS rank")


@pytest.mark.parametrize(("block_rows", "query_rows"), [(4096, 1024), (60, 3)])
def test_against_all_pairs(spark, block_rows, query_rows):
    found = mtree.top_k(vector_frame(spark, vectors()), k=5, step=50, block_rows=block_rows, query_rows=query_rows)
    assert result(found) == plain_top(vectors(), 5, 50)


def test_long_vectors_have_exact_scores(spark):
    """Lengths far beyond what floating point adds up exactly; only the best scores have to fit 64 bits."""
    rows = [(0, [1e6, 0.0]), (50, [3e7, 1.0]), (1, [1e6, 1e6]), (2, [1e6 + 1 / 256, -7.0]), (3, [-1.0, 5.0]), (4, [2.0**20, 2.0**20 + 1]), (100, [0.0, 1e-3])]
    assert result(mtree.top_k(vector_frame(spark, rows), k=3)) == plain_top(rows, 3, 50)
    with pytest.raises(Exception, match="64|large|overflow|too"):
        mtree.top_k(vector_frame(spark, [(0, [1e17]), (1, [1e17])])).collect()


def test_trees_and_queries_are_not_copied_for_each_pair(spark, monkeypatch):
    """What goes from tasks to other tasks: no tree, and of each shard of queries the best rows of each task. Before, every pair of a tree and a block
    of queries was a row that held both."""
    monkeypatch.setattr(mtree, "SHARD_ROWS", 40)
    sizes, staged = [], mtree.staged

    def counted(df, label):
        sizes.append((label, staged(df, label).count()))
        return staged(df, label)

    monkeypatch.setattr(mtree, "staged", counted)
    rng = random.Random(7)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(2000)]
    found = mtree.top_k(vector_frame(spark, rows), k=3, step=20, block_rows=50, query_rows=10)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and "Join" not in plan
    assert dict(sizes) == {"vectors": 2000, "trees": 40, "queries": 100}
    assert result(found) == plain_top(rows, 3, 20)


def test_many_queries_at_once_in_a_tree():
    """Clusters, so pages are ruled out; equal rows and equal ids; several trees one after the other."""
    rng = np.random.default_rng(5)
    points = np.floor(256 * (rng.normal(size=(4000, 6)) * 0.05 + rng.integers(-3, 4, (4000, 1)) * rng.normal(size=(1, 6))))
    points[1000:1400] = points[1000]
    ids = np.arange(4000) % 3500
    bound = float((points**2).sum(axis=1).max())
    own = np.arange(0, 3500, 25)
    scores, best = np.full((len(own), 5), -np.inf), np.full((len(own), 5), mtree.NONE)
    for part in np.array_split(rng.permutation(4000), 3):
        mtree.MTree.from_bytes(mtree.MTree(ids[part], points[part], bound).to_bytes()).search_all(points[own], own, scores, best)
    for i, query in enumerate(own.tolist()):
        products = (points @ points[query]).tolist()
        expected = sorted((-int(s), int(row_id)) for s, row_id in zip(products, ids.tolist(), strict=True) if row_id != query)[:5]
        assert [(-int(s), int(row_id)) for s, row_id in zip(scores[i], best[i], strict=True)] == expected


def test_fewer_rows_than_asked_for(spark):
    rows = [(0, [1.0, 2.0]), (50, [2.0, 1.0]), (7, [0.1, 0.1])]
    assert result(mtree.top_k(vector_frame(spark, rows))) == plain_top(rows, 5, 50)
    assert result(mtree.top_k(vector_frame(spark, rows[:1]))) == set()
    assert result(mtree.top_k(vector_frame(spark, []))) == set()


def test_repeated_rows(spark):
    rows = [(0, [1.0]), (0, [1.0]), (1, [3.0]), (1, [3.0])]
    assert sorted(tuple(r) for r in mtree.top_k(vector_frame(spark, rows)).collect()) == [(0, 1, 1, 196608), (0, 2, 1, 196608)]


def test_tree_prunes_and_reads_back():
    rng = np.random.default_rng(3)
    points = np.floor(256 * (rng.normal(size=(3000, 6)) * 0.05 + rng.integers(-3, 4, (3000, 1)) * rng.normal(size=(1, 6))))
    bound = float((points**2).sum(axis=1).max())
    tree = mtree.MTree.from_bytes(mtree.MTree(np.arange(3000), points, bound).to_bytes())
    for i in range(0, 3000, 300):
        scores = points @ points[i]
        best = sorted(((-int(scores[j]), j) for j in range(3000) if j != i))[:5]
        assert tree.search(points[i], i, 5) == [(-s, j) for s, j in best]


def test_fill_takes_turns():
    shards = [f"s{i}" for i in range(7)]
    table = sharding.fill(shards, 101)
    counts = [table.count(i) for i in range(7)]
    assert sum(counts) == 101 and max(counts) - min(counts) <= 1
    moved = sum(shards[a] != shards[:6][b] for a, b in zip(table, sharding.fill(shards[:6], 101), strict=True) if a < 6)
    assert moved < 101 // 4


@pytest.mark.parametrize(("shards", "size"), [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2), (["a"], 65_539)])
def test_bad_tables(shards, size):
    with pytest.raises(ValueError):
        sharding.fill(shards, size)


def test_place(spark):
    rows = [(i % 90 if i % 10 else None, f"t{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS slot", "'y' AS number")
    placed = sharding.place(df)
    assert placed.count() == 1000 and sorted(placed.columns) == ["doc_id", "number", "shard", "slot", "text"]
    table = sharding.fill(sharding.SHARDS)
    for row in placed.select("doc_id", "slot", "shard").distinct().collect():
        slot = sharding.name_hash("" if row["doc_id"] is None else str(row["doc_id"])) % sharding.TABLE_SIZE
        assert (row["slot"], row["shard"]) == (slot, sharding.SHARDS[table[slot]])
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan
    assert sharding.place(df.where("false")).collect() == []


def test_write(spark, tmp_path):
    df = spark.range(500).withColumnRenamed("id", "doc_id")
    sharding.write(df, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 500
    assert {(r["doc_id"], r["shard"]) for r in back.collect()} == {(r["doc_id"], r["shard"]) for r in sharding.place(df).collect()}
