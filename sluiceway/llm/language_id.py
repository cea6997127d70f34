"""Language of web pages by fused evidence.

Text gives a likelihood per language, from letter triples. The declared markup language and the suffix of the
address give another each, learned from all pages by counting the text's verdicts in groups; so wrong declarations
weigh as little as they deserve. The prior of a page comes from the other pages of its host, smoothed
by those of its domain, and these by all pages. Everything is a sum of logarithms.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import mapped, staged
from sluiceway.llm.url_filter import split_url

TRAINING_ROWS = 1_000
MAX_TRIPLES = 20_000
# A text counts as this many independent letter triples at most: its triples are not independent.
EVIDENCE = 40
SMOOTHING = 0.5
HOST_WEIGHT, DOMAIN_WEIGHT = 5.0, 20.0

LETTERS = re.compile(r"[^\W\d_]+")
HIDDEN = re.compile(r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->")
TAG = re.compile(r"<[^>]*>")
DECLARED = re.compile(r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})(?![a-z])")


def triples(text: str) -> Counter:
    """Letter triples of the words of a text, with a space at either end of a word."""
    found: Counter = Counter()
    for word, n in Counter(LETTERS.findall(text.lower())).items():
        padded = f" {word} "
        for i in range(len(padded) - 2):
            found[padded[i : i + 3]] += n
    return found


@dataclass(frozen=True)
class TextModel:
    """Log probabilities of letter triples per language; the last row is for triples that are not listed."""

    languages: tuple[str, ...]
    numbers: dict[str, int]
    logs: np.ndarray

    def likelihoods(self, text: str) -> list[float]:
        """Log likelihoods, scaled down to `EVIDENCE` triples for longer texts; no words: no evidence."""
        found = triples(text)
        n = sum(found.values())
        if not n:
            return [0.0] * len(self.languages)
        rows = np.fromiter((self.numbers.get(x, len(self.numbers)) for x in found), np.int64, len(found))
        total = np.fromiter(found.values(), np.float64, len(found)) @ self.logs[rows]
        return (total * min(1.0, EVIDENCE / n)).tolist()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            counts.setdefault(lang, Counter()).update(triples(text))
    rows = [(lang, triple, n) for lang, found in counts.items() for triple, n in found.items()]
    columns = list(zip(*rows, strict=True)) or [()] * 3
    kinds = (pa.string(), pa.string(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], ["lang", "triple", "n"])


def train(docs: DataFrame, rows: int = TRAINING_ROWS) -> TextModel:
    """Model from `docs (doc_id, text, lang)`: at most `rows` documents per language, those with the smallest hash of their
    id, and the `MAX_TRIPLES` most frequent triples. Rows without a text or language are left out."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.xxhash64("doc_id").alias("order"))
    languages = [row["lang"] for row in labelled.select("lang").distinct().collect()]
    # A top-n per language: bounded by the number of languages.
    chosen = [labelled.where(F.col("lang") == lang).orderBy("order", "doc_id").limit(rows).select("doc_id", "lang") for lang in sorted(languages)]
    if not chosen:
        return TextModel((), {}, np.zeros((1, 0)))
    ids = F.broadcast(functools.reduce(DataFrame.union, chosen).distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    counted = staged(mapped(texts.join(ids, ["doc_id", "lang"]), _count, "lang string, triple string, n long").groupBy("lang", "triple").agg(F.sum("n").alias("n")), "triples")
    frequent = counted.groupBy("triple").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "triple").limit(MAX_TRIPLES)
    kept = counted.join(F.broadcast(frequent), "triple").select("triple", "lang", "n").collect()
    names = tuple(sorted(languages))
    numbers = {triple: i for i, triple in enumerate(sorted({row["triple"] for row in kept}))}
    counts = np.full((len(numbers) + 1, len(names)), SMOOTHING)
    for row in kept:
        counts[numbers[row["triple"]], names.index(row["lang"])] += row["n"]
    return TextModel(names, numbers, np.log(counts / counts.sum(axis=0)))


def _read_pages(model: TextModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The declared language and the text likelihoods of each page."""
    for batch in batches:
        declared, likelihoods = [], []
        for html in batch.column("html").to_pylist():
            found = DECLARED.search(html) if html else None
            declared.append(found.group(1).lower() if found else "")
            likelihoods.append(model.likelihoods(TAG.sub(" ", HIDDEN.sub(" ", html))) if html else [0.0] * len(model.languages))
        columns = [batch.column("page_id"), batch.column("host"), pa.array(declared, pa.string()), pa.array(likelihoods, pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "declared", "text"])


def _softmax(logs: list[Column]) -> list[Column]:
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    powers = [F.exp(x - top) for x in logs]
    total = functools.reduce(lambda a, b: a + b, powers)
    return [x / total for x in powers]


def identify(pages: DataFrame, model: TextModel) -> DataFrame:
    """`(page_id, lang, probability, text_lang, declared)` per row of `pages (page_id, url, html)`.

    Null pages have no text and declare nothing, null urls share an empty host; what evidence there is decides, in the end the
    frequencies of languages over all pages. Ties go to the language whose name comes first. Rows come out as often
    as they go in; other columns are not looked at; no rows give no rows; without a trained language `lang` is null.
    """
    host, _ = split_url(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), F.col("html").cast("string").alias("html"))
    read = mapped(rows, functools.partial(_read_pages, model), "page_id long, host string, declared string, text array<double>")
    names = model.languages
    if not names:
        return read.select("page_id", *(F.lit(None).cast(kind).alias(x) for x, kind in (("lang", "string"), ("probability", "double"), ("text_lang", "string"))), "declared")
    # Without the port; the suffix is the last label of the host, the domain its last two.
    bare = F.regexp_replace("host", r":[0-9]*$", "")
    read = read.withColumns({"suffix": F.substring_index(bare, ".", -1), "domain": F.substring_index(bare, ".", -2)})
    texts = [F.col("text")[i] for i in range(len(names))]
    first = _softmax(texts)
    read = staged(read.withColumns({f"p{i}": p for i, p in enumerate(first)}), "pages")
    shares = [f"p{i}" for i in range(len(names))]

    def summed(prefix: str) -> list[Column]:
        return [F.count("*").alias(f"{prefix}n"), *(F.sum(p).alias(f"{prefix}{p}") for p in shares)]

    totals = read.agg(*summed("")).first()
    n = totals["n"] or 0
    overall = [((totals[p] or 0.0) + SMOOTHING) / (n + SMOOTHING * len(names)) for p in shares]
    sizes = [(totals[p] or 0.0) for p in shares]
    fused = read
    for column, prefix in (("host", "h_"), ("domain", "d_"), ("declared", "m_"), ("suffix", "s_")):
        # Written first: small ones go to the pages, and of large ones Spark can split what a hot host joins.
        fused = fused.join(staged(read.groupBy(column).agg(*summed(prefix)), column), column)
    kinds = {column: read.select(F.count_distinct(column)).first()[0] for column in ("declared", "suffix")}
    logs = []
    for i, p in enumerate(shares):
        own = F.col(p)
        of_domain = (F.col(f"d_{p}") - own + DOMAIN_WEIGHT * overall[i]) / (F.col("d_n") - 1 + DOMAIN_WEIGHT)
        of_host = (F.col(f"h_{p}") - own + HOST_WEIGHT * of_domain) / (F.col("h_n") - 1 + HOST_WEIGHT)
        log = F.log(F.greatest(of_host, F.lit(1e-12))) + F.col("text")[i]
        for column, prefix in (("declared", "m_"), ("suffix", "s_")):
            log += F.log((F.col(f"{prefix}{p}") + SMOOTHING) / (sizes[i] + SMOOTHING * kinds[column]))
        logs.append(log)
    final = fused.withColumn("final", F.array(*_softmax(logs)))
    listed = F.array(*(F.lit(name) for name in names))
    named = lambda values: F.element_at(listed, F.array_position(values, F.array_max(values)).cast("int"))
    return final.select("page_id", named(F.col("final")).alias("lang"), F.array_max("final").alias("probability"), named(F.col("text")).alias("text_lang"), "declared")
