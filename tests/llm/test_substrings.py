from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from corpus_helpers import frame, messy_rows, prose

from sluiceway.llm import substrings


def plain(rows, window):
    texts = [(text or "").encode().split() for _, text in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), words in zip(rows, texts, strict=True):
        drop = set()
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                drop.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
        out.append((doc_id, len(words), len(drop), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def shared_passages():
    """Passages of 34 to 80 words in several texts, at their ends and inside, one twice in a text, one overlapping itself."""
    rows = []
    for i, size in enumerate([34, 35, 36, 50, 80]):
        passage = prose(1000 + i, size)
        rows += [(20 + 10 * i + j, f"{prose(40 * i + j, 10 * j)} {passage} {prose(70 * i + j, 30 - 10 * j)}") for j in range(4)]
    passage = prose(2000, 40)
    rows.append((90, f"{passage} {prose(2001, 5)} {passage}"))
    rows.append((91, "la " * 100))
    rows.append((92, "la  la\tla\n" * 20))
    rows += [(93 + i, " ".join([passage, prose(3000 + i, 60), prose(1004, 80)])) for i in range(12)]
    return rows


@pytest.mark.parametrize(("window", "max_kinds"), [(35, 512), (35, 2), (10, 512)])
def test_against_all_windows(spark, window, max_kinds):
    rows = messy_rows() + shared_passages()
    found = substrings.Repeats(frame(spark, rows, extra=True), window, max_kinds).without()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["digest"]) for r in found.collect()), key=repr) == plain(rows, window)


def test_removed_from_keeps_columns_and_other_texts(spark):
    rows = messy_rows() + shared_passages()
    docs = frame(spark, rows, extra=True)
    cut = substrings.Repeats(docs).removed_from(docs)
    assert cut.schema == docs.schema
    found = Counter((r["doc_id"], r["text"]) for r in cut.collect())
    removed = {(doc_id, digest): n for doc_id, _, n, digest in plain(rows, 35)}
    assert sum(found.values()) == len(rows)
    for (doc_id, text), n in found.items():
        digest = hashlib.sha256(b" ".join((text or "").encode().split())).hexdigest()
        assert (doc_id, digest) in removed
        if not removed[doc_id, digest]:
            assert (doc_id, text) in rows, n


def test_no_rows(spark):
    docs = frame(spark, [])
    assert substrings.Repeats(docs).without().collect() == []
    assert substrings.Repeats(docs).removed_from(docs).collect() == []


def test_longest_matches():
    values = np.array([5, 1, 2, 3, 9, 1, 2, 3, 4, 1, 2, 8])
    plain_matches = []
    for i in range(len(values)):
        best = 0
        for j in range(len(values)):
            n = 0
            while i != j and max(i, j) + n < len(values) and values[i + n] == values[j + n]:
                n += 1
            best = max(best, n)
        plain_matches.append(best)
    assert substrings.longest_matches(values, 4).tolist() == plain_matches


def test_spans_check_the_ends_of_factors():
    # A greedy factor of 4 from 0; the windows of 3 at 2 to 4 cross its end and only the one at 3 stands elsewhere.
    assert substrings.spans([4, 3, 2, 3, 2, 1, 1], 3) == [(0, 6)]
    assert substrings.spans([2, 1, 1], 3) == []
