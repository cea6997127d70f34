from __future__ import annotations

import itertools

import numpy as np
import pytest
import xxhash
from corpus_helpers import frame, messy_rows, prose

from sluiceway.llm import simhash
from sluiceway.llm.components import components


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()
    words = lowered.split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    prints = [plain_fingerprint(text) for _, text in rows]
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        out.append((doc_id, f"{prints[i]:016x}", min(ids) if ids else None))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=repr)


def near_copies(n):
    """Texts that differ from one in a few words each."""
    words = prose(5, 300).split()
    return [(100 + i, " ".join(words[: 3 * i % 290] + ["changed"] + words[3 * i % 290 + 1 :])) for i in range(n)]


def test_golay_code_is_perfect():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 500)
    index = simhash.nearest_codeword(words)
    flipped = words ^ (1 << rng.integers(0, 23, 500))
    both = np.stack([simhash.segment_keys(words)[0], simhash.segment_keys(flipped)[0]])
    assert all(set(a[h]) for a, h in zip(*simhash.segment_keys(words), strict=True))
    assert (index < 4096).all() and both.shape == (2, 500, 6)


@pytest.mark.parametrize("errors", [0, 1, 2, 3, 4])
def test_close_fingerprints_share_a_key(errors):
    rng = np.random.default_rng(errors)
    for value in rng.integers(-(2**63), 2**63 - 1, 200, dtype=np.int64):
        other = np.array([value], np.int64).view(np.uint64)
        for bit in rng.choice(64, errors, replace=False):
            other = other ^ (np.uint64(1) << np.uint64(bit))
        a, _ = simhash.bucket_keys(np.array([value]))
        b, _ = simhash.bucket_keys(other.view(np.int64))
        assert np.intersect1d(a, b).size


@pytest.mark.parametrize("limits", [(1024, 64), (3, 64), (1024, 2)])
def test_against_all_pairs(spark, limits):
    rows = messy_rows() + near_copies(40)
    assert result(simhash.near_duplicates(frame(spark, rows, extra=True), *limits)) == plain_components(rows)


def test_no_rows(spark):
    assert simhash.near_duplicates(frame(spark, [])).collect() == []
    assert simhash.representatives(frame(spark, [], extra=True)).collect() == []


def test_one_row_of_each_group_stays(spark):
    rows = messy_rows() + near_copies(10)
    kept = simhash.representatives(frame(spark, rows, extra=True)).collect()
    groups = {}
    for (doc_id, text), (_, _, group) in zip(sorted(rows, key=repr), plain_groups(rows), strict=True):
        groups.setdefault(group, []).append((doc_id, text))
    assert len(kept) == len(groups)
    assert all((row["doc_id"], row["text"]) in rows for row in kept)


def plain_groups(rows):
    rows = sorted(rows, key=repr)
    prints = [plain_fingerprint(text) for _, text in rows]
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            group = [group[a] if g == group[b] else g for g in group]
    return [(rows[i][0], prints[i], group[i]) for i in range(len(rows))]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(201, 200), (200, 201), (7, 7), (300, None)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "low long, high long")).collect()}
    assert found == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 120), 100), 200: 200, 201: 200}
