"""Benchmark items inside training documents: BM25 retrieval with block-max WAND, then a check of question and answer.

Test items are the indexed side: their parts of at most `PART` words, with impacts divided by the score a part has
against itself, so that one threshold fits parts of any length. Every passage of every document is a query. The
bounds of whole blocks of parts are summed for all passages of a document at once, and passages that cannot reach
the threshold in any block end there; the others are evaluated part by part with pivots and block maxima.
"""

from __future__ import annotations

import functools
import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.common import as_text, kept, mapped, staged

PART = 64
BLOCK = 4
# Passages whose bounds are held at a time.
SLICE = 512
K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.6
GRAM = 3
MAX_POSTINGS = 500_000
COMMON = 0.1

TOKENS = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    return TOKENS.findall(text.lower()) if text else []


def has_answer(text: str) -> bool:
    """Whether words stand on both sides of the last question mark."""
    head, mark, tail = text.rpartition("?")
    return bool(mark and tokens(head) and tokens(tail))


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """What stands up to the last question mark, and the rest; without one, the last quarter is the answer."""
    if has_answer(text):
        head, _, tail = text.rpartition("?")
        return tokens(head), tokens(tail)
    found = tokens(text)
    cut = len(found) - max(1, len(found) // 4) if len(found) > 1 else len(found)
    return found[:cut], found[cut:]


def grams(found: list[str]) -> set[tuple[str, ...]]:
    size = min(GRAM, len(found))
    return set(zip(*(found[i:] for i in range(size)), strict=False)) if size else set()


def overlap(part: list[str], document: dict[int, set]) -> float:
    """Share of a part's word triples (or shorter runs, if it has no three words) in a document; an empty part is covered."""
    wanted = grams(part)
    if not wanted:
        return 1.0
    return len(wanted & document[min(GRAM, len(part))]) / len(wanted)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for item_id, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found = tokens(text)
            rows += [(item_id, text, start // PART, found[start : start + PART]) for start in range(0, len(found), PART)]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], ["item_id", "text", "part", "words"])


def impacts(items: DataFrame) -> DataFrame:
    """`(item_id, text, part, postings)`: the BM25 impacts of all parts, relative to a part's score against itself."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    parts = staged(mapped(rows, _parts, "item_id long, text string, part int, words array<string>").withColumn("unit", F.xxhash64("item_id", "text", "part")), "parts")
    totals = parts.agg(F.count("*").alias("n"), F.avg(F.size("words")).alias("average")).first()
    n, average = totals["n"], totals["average"] or 1.0
    counted = parts.select("unit", F.size("words").alias("size"), F.explode("words").alias("term")).groupBy("unit", "size", "term").agg(F.count("*").alias("times"))
    spread = counted.groupBy("term").agg(F.count("*").alias("df"))
    rarity = F.log1p((n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    raw = rarity * F.col("times") * (K1 + 1) / (F.col("times") + K1 * (1 - B + B * F.col("size") / F.lit(average)))
    weighed = counted.join(spread, "term").select("unit", "term", (F.col("df") > COMMON * n).alias("common"), raw.alias("raw"))
    weighed = weighed.withColumn("impact", F.col("raw") / F.sum("raw").over(Window.partitionBy("unit")))
    # A part has PART words at most, so these arrays are short.
    postings = weighed.groupBy("unit").agg(F.collect_list(F.struct("term", "impact", "common")).alias("postings"))
    return parts.join(postings, "unit").select("item_id", "text", "part", "postings")


@dataclass
class Index:
    """Impact-ordered postings of one shard of the parts, with their block maxima."""

    parts: list[tuple[int, str]]  # item_id, text
    terms: dict[str, int]
    units: list[np.ndarray]  # of each term, ascending
    scores: list[np.ndarray]
    tops: np.ndarray  # of each term
    maxima: list[dict[int, float]]  # of each term, by block
    rare_starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    rare_blocks: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    rare_maxima: np.ndarray = field(default_factory=lambda: np.zeros(0))
    needed: np.ndarray = field(default_factory=lambda: np.zeros(0))  # of each block, from rare terms

    @property
    def n_blocks(self) -> int:
        return -(-len(self.parts) // BLOCK)


@dataclass(frozen=True)
class Shard:
    """Parts of some items, as broadcast: a bounded number of postings."""

    name: str
    rows: Broadcast
    threshold: float


def build_index(rows: list, threshold: float) -> Index:
    rows = sorted(rows, key=lambda row: (row["item_id"] is None, row["item_id"], row["text"], row["part"]))
    by_term: dict[str, list[tuple[int, float]]] = {}
    common: set[str] = set()
    rest = np.zeros(len(rows))
    for unit, row in enumerate(rows):
        for posting in row["postings"]:
            by_term.setdefault(posting["term"], []).append((unit, posting["impact"]))
            if posting["common"]:
                common.add(posting["term"])
                rest[unit] += posting["impact"]
    terms = {term: number for number, term in enumerate(by_term)}
    units = [np.array([unit for unit, _ in x], np.int64) for x in by_term.values()]
    scores = [np.array([impact for _, impact in x]) for x in by_term.values()]
    maxima: list[dict[int, float]] = []
    starts, blocks, tops = [0], [], []
    for term, x in by_term.items():
        best: dict[int, float] = {}
        for unit, impact in x:
            best[unit // BLOCK] = max(best.get(unit // BLOCK, 0.0), impact)
        maxima.append(best)
        if term not in common:
            blocks += best
            tops += best.values()
        starts.append(len(blocks))
    index = Index([(row["item_id"], row["text"]) for row in rows], terms, units, scores, np.array([x.max() for x in scores]), maxima)
    index.rare_starts, index.rare_blocks, index.rare_maxima = np.array(starts), np.array(blocks, np.int64), np.array(tops)
    needed = np.full(index.n_blocks, threshold)
    np.minimum.at(needed, np.arange(len(rows)) // BLOCK, threshold - rest)
    index.needed = needed - 1e-9
    return index


def promising(index: Index, codes: np.ndarray) -> np.ndarray:
    """Numbers of the passages (two neighbouring chunks of PART words) whose block bounds reach what is needed.

    Common terms count as if a passage had all of them, which only raises the bounds.
    """
    step = SLICE * PART
    slices = [_promising(index, codes[at : at + step + PART]) + at // PART for at in range(0, max(1, len(codes) - PART), step)]
    return np.concatenate(slices)


def _promising(index: Index, codes: np.ndarray) -> np.ndarray:
    n_passages = max(1, -(-len(codes) // PART) - 1)
    known = np.flatnonzero(codes >= 0)
    sizes = index.rare_starts[codes[known] + 1] - index.rare_starts[codes[known]]
    known = known[sizes > 0]
    # Each chunk belongs to the passage it begins and to the one it ends; a term counts once in a passage.
    chunks = known // PART
    passages = np.concatenate([chunks, chunks - 1])
    both = np.concatenate([codes[known], codes[known]])
    within = (passages >= 0) & (passages < n_passages)
    pairs = np.unique(passages[within] * len(index.terms) + both[within])
    passages, terms = np.divmod(pairs, len(index.terms))
    first = index.rare_starts[terms]
    sizes = index.rare_starts[terms + 1] - first
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(first, sizes)
    cell = np.repeat(passages, sizes) * index.n_blocks + index.rare_blocks[at]
    bounds = np.bincount(cell, index.rare_maxima[at], n_passages * index.n_blocks).reshape(n_passages, index.n_blocks)
    return np.flatnonzero((bounds >= index.needed).any(axis=1))


def wand(index: Index, query: set[int], threshold: float) -> list[tuple[int, float]]:
    """All parts whose score for the terms of a passage reaches the threshold, document at a time."""
    cursors = [[int(index.units[term][0]), 0, term] for term in query]
    found, low = [], threshold - 1e-9
    while cursors:
        cursors.sort()
        bound, pivot = 0.0, -1
        for number, (_, _, term) in enumerate(cursors):
            bound += index.tops[term]
            if bound >= low:
                pivot = number
                break
        if pivot < 0:
            break
        unit = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == unit:
            pivot += 1
        block = unit // BLOCK
        if sum(index.maxima[term].get(block, 0.0) for _, _, term in cursors[: pivot + 1]) < low:
            # No part of this block before the next cursor can do it.
            target = (block + 1) * BLOCK
            if pivot + 1 < len(cursors):
                target = min(target, cursors[pivot + 1][0])
            target = max(target, unit + 1)
            moved = cursors[: pivot + 1]
        elif cursors[0][0] == unit:
            score = sum(float(index.scores[term][at]) for _, at, term in cursors[: pivot + 1])
            if score >= low:
                found.append((unit, score))
            target, moved = unit + 1, cursors[: pivot + 1]
        else:
            target, moved = unit, [cursor for cursor in cursors[:pivot] if cursor[0] < unit]
        for cursor in moved:
            units = index.units[cursor[2]]
            cursor[1] = at = int(np.searchsorted(units, target))
            cursor[0] = int(units[at]) if at < len(units) else -1
        cursors = [cursor for cursor in cursors if cursor[0] >= 0]
    return found


def _index_of(shard: Shard) -> Index:
    """The index of a shard, built once in each Python worker."""
    return kept(__name__, shard.name, lambda: build_index(shard.rows.value, shard.threshold))


def evidence(text: str, overlaps: tuple[float, float], document: dict[int, set]) -> float:
    """The lower overlap of question and answer; of an item without a marked answer the overlap of the whole, if that is
    higher, as few changed words break all triples of a short invented answer."""
    return min(overlaps) if has_answer(text) else max(min(overlaps), overlap(tokens(text), document))


def found_items(index: Index, text: str | None, threshold: float) -> list[tuple[int | None, float, float, float, float]]:
    """`(item_id, score, question overlap, answer overlap, evidence)` of the items that a text may hold."""
    found = tokens(text)
    if not found:
        return []
    code = index.terms.get
    codes = np.fromiter((code(token, -1) for token in found), np.int64, len(found))
    items: dict[tuple, float] = {}
    for passage in promising(index, codes):
        within = codes[passage * PART : (passage + 2) * PART]
        for unit, score in wand(index, set(within[within >= 0].tolist()), threshold):
            items[index.parts[unit]] = max(items.get(index.parts[unit], 0.0), score)
    if not items:
        return []
    document = {size: set(zip(*(found[i:] for i in range(size)), strict=False)) for size in range(1, GRAM + 1)}
    out = []
    for (item_id, item), score in items.items():
        question, answer = (overlap(part, document) for part in question_and_answer(item))
        out.append((item_id, score, question, answer, evidence(item, (question, answer), document)))
    return out


def _search(shard: Shard, min_overlap: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = _index_of(shard)
    names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            rows += [(doc_id, *found[:-1]) for found in found_items(index, text.as_py(), shard.threshold) if found[-1] >= min_overlap]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], names)


def _clean(shard: Shard, min_overlap: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = _index_of(shard)
    for batch in batches:
        held = (found_items(index, text.as_py(), shard.threshold) for text in batch.column("text"))
        yield batch.filter(pa.array([not any(found[-1] >= min_overlap for found in items) for items in held], pa.bool_()))


def shards_of(items: DataFrame, threshold: float) -> list[Shard]:
    """The index in broadcasts of about `MAX_POSTINGS` postings."""
    indexed = staged(impacts(items), "impacts")
    total = indexed.agg(F.sum(F.size("postings"))).first()[0] or 0
    n_shards, out = max(1, math.ceil(total / MAX_POSTINGS)), []
    for number in range(n_shards):
        rows = indexed.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_shards)) == number).collect()
        plain = [{"item_id": r["item_id"], "text": r["text"], "part": r["part"], "postings": [p.asDict() for p in r["postings"]]} for r in rows]
        out.append(Shard(uuid.uuid4().hex, items.sparkSession.sparkContext.broadcast(plain), threshold))
    return out


def matches(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, min_overlap: float = OVERLAP) -> DataFrame:
    """`(doc_id, item_id, score, question_overlap, answer_overlap)`: benchmark items that a document contains.

    `score` is the best BM25 score of a passage against a part of the item, 1 being that of the part itself; retrieved
    are all at or above `threshold`, verified those with `min_overlap` of the word triples of question and answer, or, if
    the item has no marked answer, of the whole item. The
    index is broadcast in shards of bounded size, one after the other, whatever the size of the benchmark; each shard is a
    pass over the documents. Null and empty texts and items match nothing. Equal items of one id count once, repeated
    documents come out each; other columns are not looked at.
    """
    texts = as_text(docs)
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    found = [mapped(texts, functools.partial(_search, shard, min_overlap), schema) for shard in shards_of(items, threshold)]
    return functools.reduce(DataFrame.union, found)


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, min_overlap: float = OVERLAP) -> DataFrame:
    """The rows of `docs` without any match, all columns as they are."""
    for shard in shards_of(items, threshold):
        docs = mapped(docs, functools.partial(_clean, shard, min_overlap), docs.schema)
    return docs
