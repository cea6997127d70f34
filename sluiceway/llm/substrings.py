"""Repeated passages by relative Lempel-Ziv parsing.

A passage counts as repeated if `window` words in a row also stand somewhere else. Every window is led by its
smallest k-gram hash (the first of equal ones), its anchor. Equal windows have equal anchors in the same place, so
each run of windows with one anchor, a segment, has to be parsed only against segments with that anchor. These form the
reference blocks: a block is indexed by a suffix array, every segment is factored greedily against the rest of
the block, long factors become duplicate spans, and windows across the end of a factor are looked up on their own.

Segments whose anchor is unique, as most are, go no further than a partial count. Of equal segments one is parsed, in a block
that holds it twice. An anchor with too many different segments for one block is made finer: its windows are told apart by
their second smallest gram as well, then by the third, and so on, which cuts the segments into shorter ones.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import as_text, hashes, intermediate, mapped, mixed, staged, texts_of, words

WINDOW = 35
GRAM = 8
BLOCK_WORDS = 60_000
MAX_KINDS = 512
# Smallest grams that tell windows apart before the whole window does.
MAX_GRAMS = 4
BASE = np.uint64(0x9E3779B97F4A7C15)
TEXT_SEED = 42


def text_key(text: bytes) -> tuple[int, int]:
    """The same as Spark's xxhash64 and crc32 of the text."""
    return int(np.uint64(xxhash.xxh64_intdigest(text, TEXT_SEED)).view(np.int64)), zlib.crc32(text)


def _powers(n: int) -> np.ndarray:
    powers = np.full(n + 1, BASE, np.uint64)
    powers[0] = 1
    return np.cumprod(powers)


INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ranges of `values`, equal for equal content wherever it stands."""
    n = len(values)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(n)[:n])])
    back = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, INVERSE, np.uint64)]))
    return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def segments(values: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """`(anchor, content hash, first word, words)` of the segments of a text given by its word hashes."""
    n = len(values)
    if n < window:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    starts = np.arange(n - gram + 1)
    grams = range_hashes(values, starts, starts + gram)
    width = window - gram + 1
    place = np.concatenate(
        [
            np.lib.stride_tricks.sliding_window_view(grams[at : at + 65536 + width - 1], width).argmin(axis=1) + at
            for at in range(0, n - window + 1, 65536)
        ]
    ) + np.concatenate([np.arange(min(65536, n - window + 1 - at)) for at in range(0, n - window + 1, 65536)])
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.append(first[1:], len(place)) - 1
    contents = range_hashes(values, first, last + window)
    return grams[place[first]].view(np.int64), contents.view(np.int64), first, last + window - first


def _scan(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "key", "check", "n_words", "digest", "anchors", "contents", "starts", "lengths"]
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            keys, checks, sizes, digests = [], [], [], []
            lists: tuple[list, ...] = ([], [], [], [])
            for text in texts_of(part):
                key, check = text_key(text)
                parts = words(text)
                keys.append(key)
                checks.append(check)
                sizes.append(len(parts))
                digests.append(hashlib.sha256(b" ".join(parts)).hexdigest())
                for values, found in zip(lists, segments(hashes(parts), window), strict=True):
                    values.append(found)
            offsets = pa.array(np.cumsum([0, *map(len, lists[0])]), pa.int32())
            arrays = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x), kind)) for x, kind in zip(lists, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)]
            scalars = [pa.array(keys, pa.int64()), pa.array(checks, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *scalars, *arrays], names)


def longest_matches(values: np.ndarray, limit: int) -> np.ndarray:
    """For each position of a block the longest match that begins at another one, up to twice `limit` words and more.

    Suffix array by prefix doubling; the nearest neighbours in it hold the longest matches.
    """
    ranks = [np.unique(values, return_inverse=True)[1].astype(np.int64) + 1]
    length = 1
    while length <= limit:
        shifted = np.zeros_like(ranks[-1])
        shifted[:-length] = ranks[-1][length:]
        ranks.append(np.unique(ranks[-1] * (len(values) + 2) + shifted, return_inverse=True)[1].astype(np.int64) + 1)
        length *= 2
    order = np.argsort(ranks[-1], kind="stable")
    a, b, common = order[:-1].copy(), order[1:].copy(), np.zeros(len(order) - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        padded = np.append(ranks[level], [0, -1])
        same = padded[np.minimum(a, len(values))] == padded[np.minimum(b, len(values))]
        same &= (a < len(values)) & (b < len(values))
        step = same.astype(np.int64) << level
        a, b, common = a + step, b + step, common + step
    longest = np.zeros(len(values), np.int64)
    longest[order[1:]] = common
    longest[order[:-1]] = np.maximum(longest[order[:-1]], common)
    return longest


def spans(matches: list[int], window: int) -> list[tuple[int, int]]:
    """Duplicate spans of one segment, by greedy factors and look-ups of the windows that cross their ends."""
    n, at, found = len(matches), 0, []
    while at < n:
        length = max(1, matches[at])
        if length >= window:
            found.append((at, at + length))
        for across in range(max(at + 1, at + length - window + 1), min(at + length, n - window + 1)):
            if matches[across] >= window:
                found.append((across, across + matches[across]))
        at += length
    merged: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def parse_block(contents: list[np.ndarray], copies: list[int], window: int) -> list[list[tuple[int, int]]]:
    """Duplicate spans of each segment of a block, found against all its others and itself. A segment with copies is there
    twice, so that it has another to refer to."""
    known, coded = np.unique(np.concatenate(contents), return_inverse=True)
    begins = np.cumsum([0, *map(len, contents)])
    order = [*range(len(contents)), *(i for i, n in enumerate(copies) if n > 1)]
    offsets = np.cumsum([0, *(len(contents[i]) + 1 for i in order)])
    values = np.empty(offsets[-1], np.int64)
    for number, i in enumerate(order):
        values[offsets[number] : offsets[number + 1] - 1] = coded[begins[i] : begins[i + 1]]
        values[offsets[number + 1] - 1] = len(known) + number  # ends no match can cross
    matches = longest_matches(values, window).tolist()
    return [spans(matches[offsets[i] : offsets[i + 1] - 1], window) for i in range(len(contents))]


def _parse(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of segments, from rows sorted by anchor."""
    names = ["anchor", "content", "low", "high"]
    waiting: list[tuple[int, int, int, np.ndarray]] = []

    def settle(rows) -> pa.RecordBatch:
        found = parse_block([row[3] for row in rows], [row[2] for row in rows], window) if rows else []
        out = [(row[0], row[1], start, end) for row, spans_of in zip(rows, found, strict=True) for start, end in spans_of]
        columns = list(zip(*out, strict=True)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], names)

    size = 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if size >= BLOCK_WORDS and waiting[-1][0] != row[0]:
                yield settle(waiting)
                waiting, size = [], 0
            content = np.frombuffer(row[3], np.int64)
            waiting.append((*row[:3], content))
            size += len(content)
    yield settle(waiting)


def finer_segments(values: np.ndarray, n_grams: int | None, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """`(key, first word, words)`: the runs of windows of a segment with one and the same `n_grams`-th smallest gram; without a
    number the windows themselves."""
    starts = np.arange(len(values) - window + 1)
    if n_grams is None:
        keys = range_hashes(values, starts, starts + window)
    else:
        at = np.arange(len(values) - gram + 1)
        grams = np.lib.stride_tricks.sliding_window_view(range_hashes(values, at, at + gram), window - gram + 1)
        keys = np.sort(grams, axis=1)[:, n_grams - 1]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if n_grams else starts
    last = np.append(first[1:], len(starts)) - 1
    return keys[first], first, last + window - first


def _finer(n_grams: int | None, window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["of_anchor", "of_content", "low", "copies", "anchor", "content", "words"]
    for batch in batches:
        for anchor, content, copies, raw in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            values = np.frombuffer(raw, np.uint64)
            keys, first, sizes = finer_segments(values, n_grams, window)
            own = mixed(keys ^ mixed(np.array([anchor], np.int64).view(np.uint64) + np.uint64(n_grams or 0))).view(np.int64)
            contents = range_hashes(values, first, first + sizes).view(np.int64)
            same = [pa.array(np.full(len(first), x), pa.int64()) for x in (anchor, content)]
            pieces = [values[a : a + n].tobytes() for a, n in zip(first.tolist(), sizes.tolist(), strict=True)]
            columns = [*same, pa.array(first, pa.int32()), pa.array(np.full(len(first), copies), pa.int64()), pa.array(own), pa.array(contents), pa.array(pieces, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)


def _cut(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The word hashes of the wanted segments of each text."""
    names = ["anchor", "content", "copies", "words"]
    for batch in batches:
        for text, wanted in zip(texts_of(batch), batch.column("wanted").to_pylist(), strict=True):
            values = hashes(words(text))
            places = {(anchor, content): (start, size) for anchor, content, start, size in zip(*(x.tolist() for x in segments(values, window)), strict=True)}
            # Another text may have the same key, but not these segments.
            found = [piece for piece in wanted if (piece["anchor"], piece["content"]) in places]
            columns = [pa.array([piece[name] for piece in found], pa.int64()) for name in names[:-1]]
            cuts = (places[piece["anchor"], piece["content"]] for piece in found)
            pieces = [values[start : start + size].tobytes() for start, size in cuts]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(pieces, pa.binary())], names)


def kept_words(text: bytes, found: list[dict]) -> tuple[list[bytes], int]:
    """The words outside of the spans, and how many there were."""
    parts = words(text)
    keep = np.ones(len(parts), bool)
    for span in found:
        keep[span["start"] : span["end"]] = False
    return [part for part, stays in zip(parts, keep.tolist(), strict=True) if stays], len(parts)


def _shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The row structs as columns, with their texts cut where there are spans."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            rows = pa.RecordBatch.from_struct_array(part.column("row"))
            at = rows.schema.get_field_index("text")
            texts = []
            for text, found in zip(rows.column(at), part.column("spans").to_pylist(), strict=True):
                texts.append(text.as_py() if found is None else b" ".join(kept_words(text.as_py().encode(), found)[0]).decode())
            yield rows.set_column(at, rows.schema.field(at), pa.array(texts, rows.schema.field(at).type))


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kept words, their number and digest, for texts with spans."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            kept_texts, sizes, removed, digests = [], [], [], []
            for text, found in zip(texts_of(part), part.column("spans").to_pylist(), strict=True):
                stay, size = kept_words(text, found)
                kept = b" ".join(stay)
                kept_texts.append(kept)
                sizes.append(size)
                removed.append(size - len(stay))
                digests.append(hashlib.sha256(kept).hexdigest())
            columns = [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(kept_texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", "n_words", "n_removed", "digest", "kept"])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text", F.coalesce("text", F.lit(""))).withColumns({"key": F.xxhash64("text"), "check": F.crc32("text")})


class Repeats:
    """Repeated passages of `docs (doc_id, text)`.

    `scanned` has a row per document: its text key, number of words and the digest of all its words; `spans` has the
    word ranges to remove of each text key that has any. Repeated rows and exact copies are occurrences like any
    other. Null texts have no words. Rows with equal texts share their spans, so ids may be null or repeated.
    """

    def __init__(self, docs: DataFrame, window: int = WINDOW, max_kinds: int = MAX_KINDS):
        self.docs = as_text(docs)
        spark = docs.sparkSession
        with intermediate(spark) as keep:
            # What only leads to the next table goes as soon as that is written.
            with intermediate(spark) as keep_repeated:
                scanned = staged(
                    mapped(
                        self.docs,
                        functools.partial(_scan, window),
                        "doc_id long, key long, check long, n_words long, digest string,"
                        " anchors array<long>, contents array<long>, starts array<int>, lengths array<int>",
                    ),
                    "segments",
                )
                pieces = scanned.select("key", "check", F.explode(F.arrays_zip("anchors", "contents", "starts", "lengths")).alias("piece")).select(
                    "key", "check", F.col("piece.anchors").alias("anchor"), F.col("piece.contents").alias("content"), F.col("piece.starts").alias("start")
                )
                # Counts first: a frequent anchor is one row per task from here on.
                anchors = pieces.groupBy("anchor").agg(F.count("*").alias("total"))
                # Written first, so that the join has a shuffle of its own on either side and Spark can split hot anchors.
                anchors = staged(anchors.where("total > 1").select("anchor"), "anchors")
                repeated = keep_repeated(pieces.join(anchors, "anchor"), "repeated")
                self.scanned = keep(scanned.select("doc_id", "key", "check", "n_words", "digest"), "scanned")
            marks = staged(self._marks(repeated, window, max_kinds), "marks")
            ranges = repeated.join(marks, ["anchor", "content"]).select("key", "check", (F.col("start") + F.col("low")).alias("start"), (F.col("start") + F.col("high")).alias("end"))
            # As many ranges as a text has segments, at most a few times over.
            self.spans = keep(ranges.distinct().groupBy("key", "check").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")

    def _marks(self, pieces: DataFrame, window: int, max_kinds: int) -> DataFrame:
        """Spans `(anchor, content, low, high)` within segments whose anchor is repeated; all of them are factors."""
        kinds = pieces.groupBy("anchor", "content").agg(F.count("*").alias("copies"), F.min("key").alias("key"))
        wanted = kinds.groupBy("key").agg(F.collect_list(F.struct("anchor", "content", "copies")).alias("wanted"))
        sources = _keyed(self.docs).join(wanted, "key").select("text", "wanted")
        cut = mapped(sources, functools.partial(_cut, window), "anchor long, content long, copies long, words binary")
        return self._factors(cut.dropDuplicates(["anchor", "content"]), window, max_kinds, 2)

    def _factors(self, cut: DataFrame, window: int, max_kinds: int, n_grams: int | None) -> DataFrame:
        """Spans of the segments `cut (anchor, content, copies, words)`, which are distinct: of small blocks by parsing, of
        others after they are made finer."""
        with intermediate(cut.sparkSession) as keep:
            cut = staged(cut, "reference")
            kinds = cut.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("copies").alias("total")).where("total > 1")
            sized = keep(cut.join(kinds.select("anchor", "kinds"), "anchor"), "sized")
        columns = ["anchor", "content", "copies", "words"]
        blocks = sized.where(F.col("kinds") <= max_kinds).select(*columns).repartition("anchor").sortWithinPartitions("anchor")
        parsed = mapped(blocks, functools.partial(_parse, window), "anchor long, content long, low int, high int")
        crowded = sized.where(F.col("kinds") > max_kinds).select(*columns)
        if crowded.isEmpty():
            return parsed
        schema = "of_anchor long, of_content long, low int, copies long, anchor long, content long, words binary"
        finer = staged(mapped(crowded, functools.partial(_finer, n_grams, window), schema), "finer")
        again = finer.groupBy("anchor", "content").agg(F.sum("copies").alias("copies"), F.any_value("words").alias("words"))
        following = None if n_grams is None or n_grams >= MAX_GRAMS else n_grams + 1
        found = self._factors(again, window, max_kinds, following).withColumnsRenamed({"low": "from", "high": "to"})
        owners = finer.select("anchor", "content", "of_anchor", "of_content", "low")
        inner = owners.join(found, ["anchor", "content"]).select(
            F.col("of_anchor").alias("anchor"), F.col("of_content").alias("content"), (F.col("low") + F.col("from")).alias("low"), (F.col("low") + F.col("to")).alias("high")
        )
        return parsed.union(inner)

    def without(self) -> DataFrame:
        """`(doc_id, n_words, n_removed, digest)`: sizes before, words removed, SHA-256 of the kept words joined by one space."""
        changed = self.spans.select("key", "check")
        same = self.scanned.join(changed, ["key", "check"], "left_anti")
        same = same.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "digest")
        return same.union(self.kept_texts().drop("kept"))

    def kept_texts(self) -> DataFrame:
        """`(doc_id, n_words, n_removed, digest, kept)` of the documents that lose words."""
        sources = _keyed(self.docs).join(self.spans, ["key", "check"]).select("doc_id", "text", "spans")
        return mapped(sources, _apply, "doc_id long, n_words long, n_removed long, digest string, kept string")

    def removed_from(self, docs: DataFrame) -> DataFrame:
        """`docs` with repeated passages removed from `text`, all other columns as they are. A text that loses words becomes
        its kept words, joined by one space; any other stays as it is, nulls included."""
        rows = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"))
        text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
        keyed = rows.select("row", F.xxhash64(text).alias("key"), F.crc32(text).alias("check"))
        return mapped(keyed.join(self.spans, ["key", "check"], "left").select("row", "spans"), _shorten, docs.schema)
