"""Near-duplicate documents by SimHash, found through Golay-code keys.

The 64 bits of a fingerprint are cut into three segments. The perfect binary Golay code maps every 23-bit word to
one of 4,096 codewords; decoding a segment and all its one-bit neighbours gives one or six codeword indices,
and two segments that differ in at most two bits have an index in common, as they share a midpoint.
Four differing bits are spread over the segments in one of two ways:

- one segment has none, and of the other two one has two at most: the equal segment with an index of the other;
- no segment is free of them, so none has more than two: an index of each of the three segments.

Both kinds of key have 33 bits and more, so that unrelated fingerprints rarely meet. A fingerprint has about 180 keys.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import LOWER, hashes, intermediate, mapped, staged, texts_of, words
from sluiceway.llm.components import components

SHINGLE = 4
SEED = 42
MAX_DISTANCE = 4
WIDTHS = (22, 21, 21)
MAX_BUCKET = 1024
MAX_LOCAL = 64
# Generator polynomial of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1. Fixed value.
GENERATOR = 0b110001110101

# Kinds of rows that reach a bucket.
MEMBER, CROWDED = 0, 1


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of whole text: bit set if it is set in over half of the shingles' hashes; no words: zero."""
    found = words(text.translate(LOWER))
    if not found:
        return 0
    if len(found) < shingle:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(shingle)), strict=False))
    digests = hashes(shingles, SEED)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(digests), 65536):
        part = digests[start : start + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(digests), bitorder="little").view(np.int64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = pa.array([fingerprint(text) for text in texts_of(batch)], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], values], ["doc_id", "text_key", "bits"])


@functools.cache
def _decoder() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits of a word, and the data bits to flip for each syndrome."""

    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    single = [remainder(1 << bit) for bit in range(23)]
    syndromes = np.zeros(1 << 23, np.uint16)
    for bit, value in enumerate(single):
        syndromes[1 << bit : 2 << bit] = syndromes[: 1 << bit] ^ np.uint16(value)
    flips = np.zeros(1 << 11, np.int64)
    for n_errors in range(4):
        for error in itertools.combinations(range(23), n_errors):
            pattern = sum(1 << bit for bit in error)
            flips[syndromes[pattern]] = pattern
    return syndromes, flips


def nearest_codeword(values: np.ndarray) -> np.ndarray:
    """Index (the 12 data bits) of the one Golay codeword within three bits of each 23-bit word."""
    syndromes, flips = _decoder()
    return (values ^ flips[syndromes[values]]) >> 11


def segment_keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices of each word and its one-bit neighbours: an array of six columns, and which of them hold."""
    around = np.concatenate([[0], 1 << np.arange(23)])
    found = np.sort(nearest_codeword(values[:, None] ^ around[None, :]), axis=1)
    first = np.ones_like(found, bool)
    first[:, 1:] = found[:, 1:] != found[:, :-1]
    order = np.argsort(~first, axis=1, kind="stable")[:, :6]  # a word has one index or six
    return np.take_along_axis(found, order, axis=1), np.take_along_axis(first, order, axis=1)


def bucket_keys(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of each fingerprint: `(keys, position)`, one entry per key."""
    raw = bits.view(np.uint64)
    parts, shift = [], 0
    for width in WIDTHS:
        parts.append(((raw >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64))
        shift += width
    codes = [segment_keys(part) for part in parts]
    (a, in_a), (b, in_b), (c, in_c) = codes
    triples = (a[:, :, None, None] << 24) | (b[:, None, :, None] << 12) | c[:, None, None, :]
    holds = in_a[:, :, None, None] & in_b[:, None, :, None] & in_c[:, None, None, :]
    position = np.broadcast_to(np.arange(len(bits))[:, None, None, None], triples.shape)
    keys, rows = [triples[holds]], [position[holds]]
    kind = 0
    for equal in range(3):
        for near in range(3):
            if near != equal:
                kind += 1
                code, holds = codes[near]
                pair = (np.int64(kind) << 40) | (parts[equal][:, None] << 12) | code
                keys.append(pair[holds])
                rows.append(np.broadcast_to(np.arange(len(bits))[:, None], pair.shape)[holds])
    return np.concatenate(keys), np.concatenate(rows)


def _emit_keys(max_local: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, bits, kind). Of a key that is frequent in a batch only one row goes to its bucket, to mark
    it as crowded; its fingerprints come out with a null key instead, for the exact way round."""
    for batch in batches:
        every = batch.column("bits").to_numpy(zero_copy_only=False)
        for start in range(0, len(every), 4096):
            bits = every[start : start + 4096]
            keys, rows = bucket_keys(bits)
            _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
            many = (counts > max_local)[inverse]
            crowded = np.unique(rows[many])
            marks = np.unique(keys[many])
            none = np.zeros(len(crowded), bool)
            mask = np.concatenate([np.ones((~many).sum() + len(marks), bool), none])
            out_keys = np.concatenate([keys[~many], marks, np.zeros(len(crowded), np.int64)])
            out_bits = np.concatenate([bits[rows[~many]], np.zeros(len(marks), np.int64), bits[crowded]])
            kinds = np.concatenate([np.zeros((~many).sum(), np.int8), np.full(len(marks) + len(crowded), CROWDED, np.int8)])
            yield pa.RecordBatch.from_arrays([pa.array(out_keys, mask=~mask), pa.array(out_bits), pa.array(kinds)], ["key", "bits", "kind"])


def spanning_links(bits: np.ndarray, distance: int = MAX_DISTANCE) -> list[tuple[int, int]]:
    """Links of at most `distance` bits among distinct fingerprints, as few as keep them connected."""
    raw, waiting, found = bits.view(np.uint64), list(range(len(bits))), []
    while waiting:
        front = [waiting.pop()]
        while front and waiting:
            at = front.pop()
            left = np.array(waiting)
            near = np.bitwise_count(raw[left] ^ raw[at]) <= distance
            reached = left[near]
            found.extend((int(bits[at]), int(bits[other])) for other in reached)
            front.extend(reached.tolist())
            waiting = left[~near].tolist()
    return found


def _link_buckets(max_bucket: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within the buckets of rows sorted by (key, bits); members of overfull buckets as (bits, null)."""

    def settled(lows, highs):
        return pa.RecordBatch.from_arrays([pa.array(lows, pa.int64()), pa.array(highs, pa.int64())], ["low", "high"])

    key, kept, full = None, [], False  # the bucket that may go on in the next batch

    def close() -> Iterator[tuple[list, list]]:
        if len(kept) > 1 and not full:
            pairs = spanning_links(np.array(kept, np.int64))
            yield [min(p) for p in pairs], [max(p) for p in pairs]

    for batch in batches:
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        bits = batch.column("bits").to_numpy(zero_copy_only=False)
        kinds = batch.column("kind").to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        ends = np.append(starts[1:], len(keys))
        # Buckets of one row are the rule; only the first and the last of a batch may be parts of larger ones.
        wanted = (ends - starts > 1) | (kinds[starts] == CROWDED)
        wanted[[0, -1]] = True
        lows, highs = [], []
        for start, end in zip(starts[wanted].tolist(), ends[wanted].tolist(), strict=True):
            if keys[start] != key:
                for more_lows, more_highs in close():
                    lows += more_lows
                    highs += more_highs
                key, kept, full = keys[start], [], False
            members = bits[start:end][kinds[start:end] == MEMBER].tolist()
            if not full and ((kinds[start:end] == CROWDED).any() or len(kept) + len(members) > max_bucket):
                full, members, kept = True, kept + members, []
            if full:
                lows += members
                highs += [None] * len(members)
            else:
                kept += members
        if lows:
            yield settled(lows, highs)
    lows, highs = [], []
    for more_lows, more_highs in close():
        lows += more_lows
        highs += more_highs
    yield settled(lows, highs)


def _midpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every word within two bits of a fingerprint. Fingerprints with a common one differ in four bits at most, and
    any two that do have one."""
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    a, b = np.triu_indices(64, 1)
    flips = np.concatenate([[np.uint64(0)], one, one[a] | one[b]])
    for batch in batches:
        bits = batch.column("bits").to_numpy(zero_copy_only=False)
        for start in range(0, len(bits), 256):
            part = bits[start : start + 256]
            around = (part.view(np.uint64)[:, None] ^ flips[None, :]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(around.ravel()), pa.array(np.repeat(part, len(flips)))], ["middle", "bits"])


def links(distinct: DataFrame, max_bucket: int = MAX_BUCKET, max_local: int = MAX_LOCAL) -> DataFrame:
    """Links `(low, high)` between `distinct (bits)`, enough of them to connect all that differ in four bits at most."""
    rows = mapped(distinct, functools.partial(_emit_keys, max_local), "key long, bits long, kind byte")
    # The marks and the crowded rows of a batch are few; both outputs come from one pass over the keys.
    placed = rows.repartition(F.coalesce("key", F.xxhash64("bits"))).sortWithinPartitions("key", "bits")
    found = mapped(placed, functools.partial(_split_crowded, max_bucket), "low long, high long")
    found = staged(found.distinct(), "near")
    crowded = found.where("high IS NULL").select(F.col("low").alias("bits"))
    middles = mapped(crowded, _midpoints, "middle long, bits long")
    # At most 2,081 distinct fingerprints lie around a middle.
    starred = middles.groupBy("middle").agg(F.collect_list("bits").alias("near")).where("size(near) > 1")
    starred = starred.select(F.array_min("near").alias("low"), F.explode("near").alias("high")).where("low <> high").distinct()
    return found.where("high IS NOT NULL").union(starred)


def _split_crowded(max_bucket: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passes crowded fingerprints (null key, sorted first) on, and links the buckets of the others."""
    passed: list[pa.RecordBatch] = []

    def keyed() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key")
            if keys.null_count:
                is_null = keys.is_null()
                alone = batch.filter(is_null).column("bits")
                passed.append(pa.RecordBatch.from_arrays([alone, pa.nulls(len(alone), pa.int64())], ["low", "high"]))
                batch = batch.filter(pa.compute.invert(is_null))
            if batch.num_rows:
                yield batch

    for result in _link_buckets(max_bucket, keyed()):
        while passed:
            yield passed.pop()
        yield result
    while passed:
        yield passed.pop()


def keyed(docs: DataFrame) -> DataFrame:
    """Ids, texts and a hash of the text; a null text counts as an empty one."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _prints(docs: DataFrame) -> DataFrame:
    return staged(mapped(keyed(docs), _fingerprints, "doc_id long, text_key long, bits long"), "fingerprints")


def close_texts(docs: DataFrame, max_bucket: int = MAX_BUCKET, max_local: int = MAX_LOCAL) -> tuple[DataFrame, DataFrame]:
    """`(text_key, bits)` of all different texts of `docs`, and links `(low, high)` between their fingerprints, enough of them to
    connect all that differ in four bits at most: for callers that judge the links by more than the fingerprints."""
    spark = docs.sparkSession
    with intermediate(spark) as keep:
        prints = keep(_prints(docs).groupBy("text_key").agg(F.any_value("bits").alias("bits")), "texts")
        distinct = staged(prints.select("bits").distinct(), "distinct")
        return prints, keep(links(distinct, max_bucket, max_local).distinct(), "links")


def _groups(docs: DataFrame, max_bucket: int, max_local: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints `(doc_id, text_key, bits)` of all rows; `(bits, least, group)`, `least` being the first id and text key."""
    prints = _prints(docs)
    # Nulls come last.
    ordered = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    distinct = staged(prints.groupBy("bits").agg(F.min(ordered).alias("least")), "distinct")
    tied = components(links(distinct.select("bits"), max_bucket, max_local))
    named = distinct.join(tied, distinct["bits"] == tied["node"], "left").select("bits", "least", F.coalesce("component", "bits").alias("group"))
    return prints, staged(named, "groups")


def near_duplicates(docs: DataFrame, max_bucket: int = MAX_BUCKET, max_local: int = MAX_LOCAL) -> DataFrame:
    """`(doc_id, fingerprint, component_id)` per row of `docs`.

    Documents whose fingerprints differ in four bits at most are linked; component_id is the smallest doc_id
    that can be reached. Exact copies share a fingerprint and are one node of the search. Null and empty texts
    have fingerprint zero and are linked like any other; a null doc_id is never the smallest unless all are null.
    Repeated rows come out as often as they go in; other columns are not looked at; no rows give no rows.

    Buckets with more than `max_bucket` fingerprints, or `max_local` in one batch, are not compared by pairs: their
    members are tied through the words halfway between them, which is exact and grows with the members only.
    """
    prints, named = _groups(docs, max_bucket, max_local)
    least = named.groupBy("group").agg(F.min("least.doc_id").alias("component_id"))
    of_bits = named.join(least, "group").select("bits", "component_id")
    # One fingerprint may hold a third of all rows: a join whose large partitions Spark can split.
    return prints.join(of_bits, "bits").select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, max_bucket: int = MAX_BUCKET, max_local: int = MAX_LOCAL) -> DataFrame:
    """One row of each group of near copies, with all its columns: that with the smallest doc_id, of these the one with the
    smallest hash of its text. Of rows that agree in both any one stays."""
    return first_rows(docs, _groups(docs, max_bucket, max_local)[1])


def first_rows(docs: DataFrame, named: DataFrame) -> DataFrame:
    """The rows of `docs` that are the least of a group in `named (least, group)`, one of each."""
    first = named.groupBy("group").agg(F.min("least").alias("least")).select(F.col("least.doc_id").alias("doc_id"), F.col("least.text_key").alias("text_key"))
    rows = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"))
    keyed = rows.select("row", F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("row.text").cast("string"), F.lit(""))).alias("text_key"))
    same = keyed["doc_id"].eqNullSafe(first["doc_id"]) & (keyed["text_key"] == first["text_key"])
    return keyed.join(first, same, "left_semi").dropDuplicates(["doc_id", "text_key"]).select("row.*")
