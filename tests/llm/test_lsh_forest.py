from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from corpus_helpers import frame, messy_rows, prose

from sluiceway.llm import lsh_forest


def plain_set(text, shingle=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))} if words else set()


def plain(rows, percent=85):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = [plain_set(text) for _, text in rows]
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            group = [group[a] if g == group[b] else g for g in group]
    out = []
    for (doc_id, _), s, g in zip(rows, sets, group, strict=True):
        ids = [i for (i, _), h in zip(rows, group, strict=True) if h == g and i is not None]
        least = (min(ids) if ids else None) if s else doc_id
        out.append((doc_id, len(s), least, doc_id == least))
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def edited(seed, lengths, copies):
    """Copies of texts with more and more words changed: pairs on both sides of the threshold."""
    rng, rows = random.Random(seed), []
    for source, length in enumerate(lengths):
        words = prose(10_000 * seed + source, length).split()
        for _ in range(copies):
            copy = list(words)
            for at in rng.sample(range(length), rng.randint(0, max(1, length // 25))):
                copy[at] = f"other{rng.randint(0, 99)}"
            rows.append((len(rows) + 100, " ".join(copy)))
    return rows


@pytest.mark.parametrize("rows_per_partition", [200_000, 500])
def test_against_all_pairs(spark, monkeypatch, rows_per_partition):
    """The second time the orders are dealt over many partitions."""
    monkeypatch.setattr(lsh_forest, "ROWS_PER_PARTITION", rows_per_partition)
    rows = messy_rows() + edited(3, [1, 2, 3, 4, 9, 40, 100, 250, 250, 600, 600], 9)
    assert result(lsh_forest.near_copies(frame(spark, rows, extra=True))) == plain(rows)


def test_crowded_regions(spark, monkeypatch):
    """A group of close copies that fills the window, and texts at the threshold to one of them each."""
    monkeypatch.setattr(lsh_forest, "WINDOW", 8)
    base, rows = prose(77, 220).split(), []
    for i in range(120):
        copy = list(base)
        copy[(7 * i) % 220] = f"own{i}"
        rows.append((i, " ".join(copy)))
    for i in range(20):
        copy = list(base)
        for at in range(i, 220, 40):
            copy[at] = f"far{i}"
        rows.append((500 + i, " ".join(copy)))
    assert result(lsh_forest.near_copies(frame(spark, rows))) == plain(rows)


def star(n, seed, length=220, edits=5):
    """A text and copies of it with other words in random places: all similar to it, no two to each other but by chance."""
    rng, base = random.Random(seed), prose(seed, length).split()
    rows = [(0, " ".join(base))]
    for i in range(1, n + 1):
        copy = list(base)
        for k, at in enumerate(rng.sample(range(2, length - 2), edits)):
            copy[at] = f"own{i}x{k}"
        rows.append((i, " ".join(copy)))
    return rows


@pytest.mark.parametrize(("n", "chunk"), [(1500, 4096), (300, 40)])
def test_a_large_group_that_only_one_text_ties(spark, monkeypatch, n, chunk):
    """Each copy has a link to the first text alone, which stands somewhere among hundreds that share its labels."""
    monkeypatch.setattr(lsh_forest, "CROWD_ROWS", chunk)
    monkeypatch.setattr(lsh_forest, "PIECE", 64)
    # Six words more: similar to the copies by 0.84 and less, and to the first text by 0.847.
    rows = star(n, 91) + [(10_000 + i, text) for i, text in star(60, 91, edits=6)[1:]]
    found = {r["doc_id"]: r["component_id"] for r in lsh_forest.near_copies(frame(spark, rows)).collect()}
    sets = {i: plain_set(text) for i, text in rows}
    similar = {i for i, s in sets.items() if 100 * len(s & sets[0]) >= 85 * len(s | sets[0])}
    assert len(similar) > n and {i for i, c in found.items() if c == 0} == similar


def test_texts_with_a_common_line_make_few_pairs(spark):
    """2,000 short texts that share a line and are not similar: candidates stay in proportion to the texts."""
    line = prose(5, 14)
    docs = frame(spark, [(i, f"{line} {prose(20_000 + i, 16)}") for i in range(2000)])
    texts = lsh_forest.keyed(docs)
    signed = lsh_forest.mapped(texts, lsh_forest.functools.partial(lsh_forest._signatures, 3, lsh_forest.TREES), "doc_id long, text_key long, node long, n_shingles long, labels array<long>")
    nodes = lsh_forest.staged(signed.select("node", "labels").withColumn("component", lsh_forest.F.col("node")), "nodes")
    pairs = lsh_forest.neighbours(nodes, 2000, lsh_forest.WINDOW)
    # All pairs are 1,999,000.
    assert pairs.count() < 2000 * lsh_forest.TREES * 8
    assert lsh_forest.alike(pairs, nodes, 85).count() < 100
    assert result(lsh_forest.near_copies(docs)) == sorted(((i, 28, i, True) for i in range(2000)), key=repr)


def test_labels_tell_the_similarity():
    rng = np.random.default_rng(4)
    common = rng.integers(0, 1 << 63, 850).astype(np.uint64)
    agree = []
    for _ in range(40):
        a, b = (np.sort(np.concatenate([common, rng.integers(0, 1 << 63, 75).astype(np.uint64)])) for _ in range(2))
        x, y = lsh_forest.labels_of(a), lsh_forest.labels_of(b)
        agree.append((x.view(np.uint8) == y.view(np.uint8)).mean())
    assert abs(np.mean(agree) - 0.85) < 0.01 and min(agree) * 256 >= lsh_forest.least_matches(85, 32)


def test_one_representative_of_each_group(spark):
    rows = messy_rows() + edited(5, [40, 100], 6)
    unique = list(dict.fromkeys(rows))  # a row that is repeated is one row
    expected = sorted((i for i, n, _, keeps in plain(unique) if keeps and n), key=repr)
    found = lsh_forest.representatives(frame(spark, rows, extra=True)).collect()
    with_words = [r["doc_id"] for r in found if (r["text"] or "").split()]
    assert sorted(with_words, key=repr) == expected
    assert len(found) - len(with_words) == 1


def test_no_rows(spark):
    assert lsh_forest.near_copies(frame(spark, [])).collect() == []
    assert lsh_forest.near_copies(frame(spark, [(None, None), (4, "")])).count() == 2
