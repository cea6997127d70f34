"""Stages of the pipeline against plain versions that share no code with them."""

from __future__ import annotations

from collections import Counter

from corpus_helpers import frame, prose

import corpus_pipeline


def windows(words):
    return [tuple(words[i : i + 35]) for i in range(len(words) - 34)]


def test_repeated_passages_against_all_windows(spark):
    shared, other = prose(950, 60), prose(951, 35)
    rows = [(i, f"{prose(960 + i, 20 + 7 * i)} {shared} {prose(970 + i, 30)}") for i in range(4)]
    rows += [(10, f"{prose(980, 50)} {other}"), (11, f"{other} {prose(981, 50)}"), (12, prose(982, 90)), (13, " ".join(other.split()[:34])), (14, f"{shared} {prose(983, 9)} {shared}")]
    times = Counter(window for _, text in rows for window in windows(text.split()))
    expected = {}
    for doc_id, text in rows:
        words = text.split()
        cut = {at + i for at, window in enumerate(windows(words)) if times[window] > 1 for i in range(35)}
        expected[doc_id] = [word for i, word in enumerate(words) if i not in cut]
    docs = frame(spark, rows).selectExpr("*", "length(text) AS n_chars")
    assert {r["doc_id"]: r["text"].split() for r in corpus_pipeline.cut_repeated_passages(spark, docs, "").collect()} == expected
