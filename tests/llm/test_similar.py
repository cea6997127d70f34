from __future__ import annotations

import itertools
import random

import xxhash
from corpus_helpers import frame, messy_rows, prose

import corpus_pipeline
from sluiceway.llm import lsh_forest


def plain_set(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()
    words = lowered.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_groups(rows):
    """Number of the group of each row, by comparing all pairs."""
    sets = [plain_set(text) for _, text in rows]
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if 10 * both >= 8 * either:
            group = [group[a] if g == group[b] else g for g in group]
    return group


def smallest(rows):
    found = plain_groups(rows)
    ids = [[i for (i, _), g in zip(rows, found, strict=True) if g == group and i is not None] for group in found]
    return sorted(((row[0], min(x) if x else None) for row, x in zip(rows, ids, strict=True)), key=repr)


def edited_copies():
    """Copies of texts of several lengths with more and more words changed, chains of copies, a group around a common line."""
    rng, rows = random.Random(7), []
    for source, length in enumerate([1, 4, 5, 6, 9, 20, 60, 150, 400]):
        words = prose(700 + source, length).split()
        for changes in [0, 1, 1, 2, 3, 4, 6, 8, 12]:
            copy = list(words)
            for at in rng.sample(range(length), min(changes, length)):
                copy[at] = f"changed{rng.randint(0, 99)}"
            rows.append((len(rows) + 100, " ".join(copy)))
    chain = prose(800, 200).split()
    for step in range(12):
        chain[step * 16 % 200] = f"step{step}"
        rows.append((len(rows) + 100, " ".join(chain)))
    line = prose(801, 25)
    rows += [(len(rows) + 100 + i, f"{line} {prose(810 + i, 4 + i % 5)}") for i in range(25)]
    return rows


def test_all_pairs_of_the_similarity(spark):
    rows = messy_rows() + edited_copies()
    kept = lsh_forest.representatives(frame(spark, rows, extra=True), 5, 80).collect()
    expected = {}
    for group, row in zip(plain_groups(rows), rows, strict=True):
        expected.setdefault(group, []).append(row)
    least = [min((i for i, _ in group if i is not None), default=None) for group in expected.values()]
    assert sorted((r["doc_id"] for r in kept), key=repr) == sorted(least, key=repr)


def test_stage_keeps_one_of_copies_far_apart_in_simhash(spark):
    rows = [row for row in edited_copies() if row[0] is not None]
    kept = corpus_pipeline.drop_near_copies(spark, frame(spark, rows, extra=True), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({least for _, least in smallest(rows)})


def test_no_rows(spark):
    assert lsh_forest.representatives(frame(spark, [], extra=True), 5, 80).collect() == []


def plain_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode().split()
    found = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in found) > len(found))


def test_stage_ties_close_fingerprints_without_trees(spark, monkeypatch):
    """Golay keys alone find all similar texts whose fingerprints differ in four bits at most; dissimilar ones are not tied."""
    monkeypatch.setattr(lsh_forest, "neighbours", lambda nodes, *_: nodes.selectExpr("node AS low", "node AS high").limit(0))
    words = prose(5, 300).split()
    rows = [(1000 + i, " ".join([*words[: 3 * i], "changed", *words[3 * i + 1 :]])) for i in range(40)]
    line = "one line that stands in there so often that it alone makes the fingerprint "
    rows += [(2000 + i, line * 400 + prose(900 + i, 30)) for i in range(4)]
    rows += [(3000, prose(950, 40)), (3001, prose(951, 40)), (3002, ""), (3003, " \n")]
    prints, sets, group = [plain_print(text) for _, text in rows], [plain_set(text) for _, text in rows], list(range(len(rows)))
    close = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if sets[a] == sets[b] or sets[a] and sets[b] and (prints[a] ^ prints[b]).bit_count() <= 4]
    similar = [(a, b) for a, b in close if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    assert len(similar) > 40 and len(close) > len(similar)
    for a, b in similar:
        group = [group[a] if g == group[b] else g for g in group]
    least = {}
    for (doc_id, _), g in zip(rows, group, strict=True):
        least[g] = min(doc_id, least.get(g, doc_id))
    kept = corpus_pipeline.drop_near_copies(spark, frame(spark, rows, extra=True), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(least.values())
