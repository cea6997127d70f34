"""Every query of the corpus operators and the pipeline, on the given tables."""

from __future__ import annotations

import base64
import itertools
import os
import re
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken
from corpus_helpers import messy_rows

import corpus_pipeline
from sluiceway.llm.common import table
from sluiceway.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ROWS = {f"op{n}_": name for n in (1, 3, 6, 7, 9, 10, 12) for name in ["documents"]} | {"op4_": "pages", "op5_": "pages"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    rows = Counter(map(tuple, result.collect()))
    source = next((ROWS[x] for x in ROWS if name.startswith(x)), None)
    if source:
        assert sum(rows.values()) == table(spark, SF_DIR, source).count()
    if name in ORACLES:
        connection = duckdb.connect()
        for view in ("documents", "embeddings"):
            connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{SF_DIR}/{view}.parquet'")
        expected = connection.execute(ORACLES[name])
        names = [d[0] for d in expected.description]
        assert sorted(names) == sorted(result.columns)
        assert Counter(map(tuple, result.select(*names).collect())) == Counter(expected.fetchall())
        connection.close()


def test_all_operators_and_the_pipeline():
    from __spark_entry__ import queries

    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert queries()["pipeline"] is corpus_pipeline.run


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_shingles(text, size=5):
    words = plain_words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def plain_near_copies(rows):
    """Of each group of similar texts the row with the smallest id, by comparing all pairs."""
    sets = {i: plain_shingles(text) for i, text in rows}
    group = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        if group[a] != group[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
            low, high = sorted((group[a], group[b]))
            group = {i: low if g == high else g for i, g in group.items()}
    return [(i, text) for i, text in rows if group[i] == i]


def plain_cut(rows, window=35):
    """Texts without the words of windows that stand anywhere else."""
    times = Counter(tuple(words[i : i + window]) for _, text in rows for words in [plain_words(text)] for i in range(len(words) - window + 1))
    out = []
    for i, text in rows:
        words = plain_words(text)
        cut = {at + k for at in range(len(words) - window + 1) if times[tuple(words[at : at + window])] > 1 for k in range(window)}
        out.append((i, " ".join(w for at, w in enumerate(words) if at not in cut) if cut else text))
    return out


def triples(text):
    words = re.findall(r"\w+", (text or "").lower())
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def test_pipeline_against_plain_code(spark):
    """All stages behind the first one, whose scores have tests of their own, against code that shares nothing with them."""
    result = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "text", "ids", "n_tokens").collect()
    docs = [tuple(r) for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    scores = {r["doc_id"]: r["predicted"] for r in QUERIES["op1_toxicity"](spark, SF_DIR).collect()}
    left = plain_cut(plain_near_copies([(i, t) for i, t in docs if not scores[i]]))
    items = [triples(r["text"]) for r in table(spark, SF_DIR, "benchmark").select("text").collect()]
    left = [(i, t) for i, t in left if not any(item and len(item & triples(t)) >= 0.6 * len(item) for item in items)]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = {i: (t or "", library.encode_ordinary(t or "")) for i, t in left}
    assert len(result) == len(expected) < len(docs)
    assert {r["doc_id"]: (r["text"], r["ids"]) for r in result} == expected
    assert all(r["n_tokens"] == len(r["ids"]) for r in result)


def test_pipeline_with_awkward_rows(spark, tmp_path):
    rows = [(i, t, None, None, None if t is None else len(t)) for i, t in messy_rows()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    # The four empty texts are one group, the three copies another; the long and the short ones are alone.
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert result.count() == 8 and result.where("text IS NULL OR n_tokens <> size(ids)").count() == 0


def test_pipeline_without_rows(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
