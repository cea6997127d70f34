from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from corpus_helpers import frame, messy_rows, prose

from sluiceway.llm import decontamination as D


def index_of(items):
    """BM25 impacts computed plainly."""
    parts = [(i, text, at // D.PART, D.tokens(text)[at : at + D.PART]) for i, text in items for at in range(0, len(D.tokens(text)), D.PART)]
    df = Counter(term for part in parts for term in set(part[3]))
    average = sum(len(part[3]) for part in parts) / len(parts)
    rows = []
    for item_id, text, part, words in parts:
        raw = {
            term: math.log1p((len(parts) - df[term] + 0.5) / (df[term] + 0.5)) * n * (D.K1 + 1) / (n + D.K1 * (1 - D.B + D.B * len(words) / average))
            for term, n in Counter(words).items()
        }
        postings = [{"term": t, "impact": x / sum(raw.values()), "common": df[t] > D.COMMON * len(parts)} for t, x in raw.items()]
        rows.append({"item_id": item_id, "text": text, "part": part, "postings": postings})
    return rows


def items_and_texts():
    items = [(i, prose(500 + i, 12 + 5 * i % 50)) for i in range(60)] + [(60, prose(900, 200)), (61, "Which river? The silver one"), (62, "word"), (63, None), (64, ""), (65, "...")]
    texts = [(1000 + i, f"{prose(i, 40 * i)} {items[i][1]} {prose(90 + i, 30)}") for i in range(20)]
    texts += [(2000, prose(901, 100) + " " + items[60][1]), (2001, " ".join(items[5][1].split()[:4])), (2002, "so which RIVER, the silver one!")]
    texts += [(2003, prose(40, 40 * 600) + " " + items[3][1])]
    return items, messy_rows() + texts


@pytest.mark.parametrize("threshold", [0.3, 0.6])
def test_wand_finds_all_above_the_threshold(threshold):
    items, texts = items_and_texts()
    rows = index_of([(i, t) for i, t in items if t])
    index = D.build_index(rows, threshold)
    by_unit = {}
    for unit in range(len(index.parts)):
        by_unit[unit] = {t: float(index.scores[n][index.units[n].tolist().index(unit)]) for t, n in index.terms.items() if unit in index.units[n].tolist()}
    for _, text in texts:
        found = D.tokens(text)
        if len(found) > 3000:
            continue
        codes = np.array([index.terms.get(x, -1) for x in found], np.int64)
        passed = set(D.promising(index, codes).tolist()) if len(codes) else set()
        for at in range(max(1, -(-len(found) // D.PART) - 1)):
            query = set(found[at * D.PART : (at + 2) * D.PART])
            scores = {unit: sum(x for t, x in postings.items() if t in query) for unit, postings in by_unit.items()}
            best = {unit for unit, score in scores.items() if score >= threshold}
            assert {unit for unit, _ in D.wand(index, {index.terms[t] for t in query if t in index.terms}, threshold)} == best
            assert not best or at in passed


def test_matches(spark):
    items, texts = items_and_texts()
    benchmark = spark.createDataFrame([*items, items[0]], "item_id long, text string").selectExpr("*", "1 AS part", "2 AS term")
    docs = frame(spark, texts, extra=True)
    found = {(r["doc_id"], r["item_id"]) for r in D.matches(docs, benchmark).collect()}
    expected = {(1000 + i, i) for i in range(20)} | {(2000, 60), (2002, 61), (2003, 3)}
    assert expected <= found
    assert {pair for pair in found - expected if pair[1] != 62} == set()
    kept = D.clean(docs, benchmark)
    assert kept.schema == docs.schema
    dirty = {doc for doc, _ in found}
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(row for row in texts if row[0] not in dirty)


def test_shards_give_the_same(spark, monkeypatch):
    items, texts = items_and_texts()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = {(r["doc_id"], r["item_id"], round(r["score"], 9)) for r in D.matches(frame(spark, texts), benchmark).collect()}
    monkeypatch.setattr(D, "MAX_POSTINGS", 600)
    assert len(D.shards_of(benchmark, D.THRESHOLD)) > 2
    assert {(r["doc_id"], r["item_id"], round(r["score"], 9)) for r in D.matches(frame(spark, texts), benchmark).collect()} == whole


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert D.matches(frame(spark, messy_rows()), items).collect() == []
    assert D.clean(frame(spark, messy_rows()), items).count() == len(messy_rows())
    assert D.matches(frame(spark, []), spark.createDataFrame([(1, "a b c")], "item_id long, text string")).collect() == []


def test_question_and_answer():
    assert D.question_and_answer("What is it? A river") == (["what", "is", "it"], ["a", "river"])
    assert D.question_and_answer("a b c d e f g h") == (list("abcdef"), list("gh"))
    assert D.question_and_answer("a") == (["a"], [])


def test_changed_words_in_items_without_a_marked_answer(spark):
    """Copies with one word or two changed, at every position, against the triples of the whole item."""
    items = [(i, prose(500 + i, n)) for i, n in enumerate([15, 16, 22, 38, 59])]
    docs, expected = [], set()
    for item_id, text in items:
        words = text.split()
        triples = {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
        for at in range(len(words)):
            for others in [(), (at + 1,), (len(words) - 1 - at,)]:
                copy = ["changed" if i in (at, *others) else word for i, word in enumerate(words)]
                docs.append((len(docs), f"{prose(700, 30)} {' '.join(copy)} {prose(701, 30)}"))
                if 10 * len(triples & {tuple(copy[i : i + 3]) for i in range(len(copy) - 2)}) >= 6 * len(triples):
                    expected.add((docs[-1][0], item_id))
                assert others or (docs[-1][0], item_id) in expected
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert expected <= {(r["doc_id"], r["item_id"]) for r in D.matches(frame(spark, docs), benchmark).collect()}
    assert {r["doc_id"] for r in D.clean(frame(spark, docs), benchmark).collect()}.isdisjoint(doc for doc, _ in expected)


def test_a_marked_answer_has_to_be_there(spark):
    benchmark = spark.createDataFrame([(1, prose(900, 30) + "? " + prose(901, 6)), (2, prose(902, 30) + "?")], "item_id long, text string")
    docs = [(1, prose(900, 30)), (2, prose(902, 30)), (3, prose(900, 30) + " " + prose(901, 6))]
    assert {(r["doc_id"], r["item_id"]) for r in D.matches(frame(spark, docs), benchmark).collect()} == {(2, 2), (3, 1)}
