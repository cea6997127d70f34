"""Toxicity: misspelled and inflected lexicon terms, weighed by the words around them.

The lexicon is learned: beginnings of words that stand in toxic documents and hardly in others. A Levenshtein
automaton runs over the trie of these terms; both are intersected as states are met, and the subset of (trie node,
errors) pairs that a beginning of a word leads to becomes one state of a deterministic automaton, so most
words are dismissed after a few look-ups. A hit weighs what its term, in that spelling, weighs in the
labelled documents; hits close to each other strengthen their window, hits within quotation marks count less.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import as_text, hashes, mapped, staged, texts_of, words

MIN_TERM, MAX_TERM = 4, 12
MAX_TRAINING_ROWS = 20_000
MAX_TERMS = 2_000
MIN_DOCUMENTS = 3
MIN_LIFT = 20.0
SHINGLE = 5
WINDOW = 12
QUOTED = 0.3
THRESHOLD = 0.7
MAX_STATES = 200_000
MAX_WORDS = 300_000

TOKENS = re.compile(r"\w+|[\"«»“”„]")
QUOTES = frozenset("\"«»“”„")


def allowed_errors(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 10 else 2


class TermAutomaton:
    """Finds the terms that begin a word, spelled with few errors: Levenshtein automata intersected with a trie."""

    def __init__(self, terms: Iterable[str]):
        self.terms = list(terms)
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int | None] = [None]
        self.budget = [0]  # the most errors that a term below a node may have
        for number, term in enumerate(self.terms):
            node = 0
            self.budget[0] = max(self.budget[0], allowed_errors(term))
            for char in term:
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.budget.append(0)
                node = self.children[node][char]
                self.budget[node] = max(self.budget[node], allowed_errors(term))
            self.ends[node] = number
        self._reset()

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[tuple[int, int], ...]] = []
        self.words: dict[str, tuple[int, int] | None] = {}
        self.dead = self._state({})
        self.start = self._state(self._with_skipped({0: 0}))

    def _with_skipped(self, errors: dict[int, int]) -> dict[int, int]:
        """Adds the nodes that are reached when letters of a term are left out."""
        todo = list(errors.items())
        while todo:
            node, spent = todo.pop()
            for child in self.children[node].values():
                if spent < self.budget[child] and spent + 1 < errors.get(child, 99):
                    errors[child] = spent + 1
                    todo.append((child, spent + 1))
        return errors

    def _state(self, errors: dict[int, int]) -> int:
        key = frozenset(errors.items())
        if key not in self.states:
            self.states[key] = len(self.members)
            self.members.append(key)
            self.moves.append({})
            ends = ((self.ends[node], spent) for node, spent in key if self.ends[node] is not None)
            self.accepts.append(tuple(sorted((spent, end) for end, spent in ends if spent <= allowed_errors(self.terms[end]))))
        return self.states[key]

    def _move(self, state: int, char: str) -> int:
        errors: dict[int, int] = {}
        for node, spent in self.members[state]:
            if spent < self.budget[node]:
                errors[node] = min(errors.get(node, 99), spent + 1)  # a letter too many
            for letter, child in self.children[node].items():
                cost = spent + (letter != char)
                if cost <= self.budget[child]:
                    errors[child] = min(errors.get(child, 99), cost)
        target = self._state(self._with_skipped(errors))
        self.moves[state][char] = target
        return target

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, errors) of the best hit that begins the word: fewest errors, then the longest term."""
        if word in self.words:
            return self.words[word]
        if len(self.words) >= MAX_WORDS:
            self.words.clear()
        if len(self.members) >= MAX_STATES:
            self._reset()
        state, best, accepts = self.start, None, self.accepts
        for char in word:
            target = self.moves[state].get(char)
            state = self._move(state, char) if target is None else target
            if state == self.dead:
                break
            for spent, end in accepts[state]:
                rank = (spent, -len(self.terms[end]), end)
                best = rank if best is None else min(best, rank)
        self.words[word] = found = best and (best[2], best[0])
        return found

    def hits(self, text: str) -> list[tuple[int, int, int, bool]]:
        """(word number, term, errors, quoted) for each hit of a text, case folded."""
        found, at, marks, known, match = [], 0, 0, self.words, self.match
        for token in TOKENS.findall(text.lower()):
            if token in QUOTES:
                marks += 1
                continue
            hit = known[token] if token in known else match(token)
            if hit is not None:
                found.append((at, *hit, marks % 2 == 1))
            at += 1
        return found


@dataclass(frozen=True)
class ToxicityModel:
    """Terms, their weights as spelled and misspelled, and a logistic function of the evidence in a document."""

    terms: tuple[str, ...]
    weights: tuple[tuple[float, ...], ...]
    coefficients: tuple[float, ...]
    window: int = WINDOW
    quoted: float = QUOTED

    def evidence(self, hits: list[tuple[int, int, int, bool]]) -> list[float]:
        """Logs of the summed weights of different terms, of the strongest window, and of quoted hits."""
        open_terms: dict[int, float] = {}
        quoted_terms: dict[int, float] = {}
        weighed = []
        for at, term, errors, is_quoted in hits:
            weight = self.weights[term][errors]
            if weight > 0:
                side = quoted_terms if is_quoted else open_terms
                side[term] = max(side.get(term, 0.0), weight)
                weighed.append((at, weight * (self.quoted if is_quoted else 1.0)))
        strongest, total, low = 0.0, 0.0, 0
        for at, weight in weighed:
            total += weight
            while weighed[low][0] < at - self.window:
                total -= weighed[low][1]
                low += 1
            strongest = max(strongest, total)
        return [math.log1p(sum(open_terms.values())), math.log1p(strongest), math.log1p(sum(quoted_terms.values()))]

    def probability(self, evidence: list[float]) -> float:
        intercept, *slopes = self.coefficients
        value = intercept + sum(a * b for a, b in zip(slopes, evidence, strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, value))))


@functools.lru_cache(maxsize=2)
def _automaton(terms: tuple[str, ...]) -> TermAutomaton:
    return TermAutomaton(terms)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the smallest hash of a text's shingles, which near copies mostly share."""
    for batch in batches:
        found = []
        for text in texts_of(batch):
            parts = words(text)
            shingles = map(b" ".join, zip(*(parts[i:] for i in range(SHINGLE)), strict=False)) if len(parts) >= SHINGLE else [text]
            found.append(int(hashes(shingles).min().view(np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), batch.column("text"), batch.column("toxic")], ["sketch", "text", "toxic"])


def _beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each task: documents by class that have a word with a given beginning."""
    counts: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            found = {token for token in set(TOKENS.findall(text.lower())) if token[0] not in QUOTES}
            for beginning in {token[:n] for token in found for n in range(MIN_TERM, min(MAX_TERM, len(token)) + 1)}:
                counts[beginning][toxic] += 1
    names = list(counts)
    columns = [pa.array(names, pa.string()), *(pa.array([counts[x][side] for x in names], pa.int64()) for side in (1, 0))]
    yield pa.RecordBatch.from_arrays(columns, ["term", "toxic", "clean"])


def _contexts(terms: frozenset[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different words in front of each of the given beginnings, hashed."""
    found: set[tuple[str, int]] = set()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            before = ""
            for token in TOKENS.findall(text.lower()):
                for n in range(MIN_TERM, min(MAX_TERM, len(token)) + 1):
                    if token[:n] in terms:
                        found.add((token[:n], before))
                before = token
    names, before = zip(*found, strict=True) if found else ((), ())
    contexts = hashes(word.encode() for word in before).view(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contexts, pa.int64())], ["term", "context"])


def _spellings(terms: tuple[str, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each task: documents by class that have a term in a spelling."""
    counts: Counter = Counter()
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            counts.update({(term, errors, toxic) for _, term, errors, _ in _automaton(terms).hits(text)})
    columns = [pa.array([key[i] for key in counts], pa.int32()) for i in range(3)]
    yield pa.RecordBatch.from_arrays([*columns, pa.array(list(counts.values()), pa.int64())], ["term", "errors", "toxic", "n"])


def _evidence(model: ToxicityModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [model.evidence(_automaton(model.terms).hits(text)) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column("toxic").cast(pa.int32())], ["evidence", "toxic"])


def _log_odds(toxic: float, clean: float, n_toxic: int, n_clean: int) -> float:
    return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))


def _likelihood_ratio(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    """G statistic of a term against the classes."""
    total = n_toxic + n_clean
    rest = [(toxic, n_toxic), (clean, n_clean), (n_toxic - toxic, n_toxic), (n_clean - clean, n_clean)]
    margins = [toxic + clean, toxic + clean, total - toxic - clean, total - toxic - clean]
    return 2 * sum(x * math.log(x * total / (side * margin)) for (x, side), margin in zip(rest, margins, strict=True) if x)


def _fit(evidence: np.ndarray, toxic: np.ndarray, rounds: int = 50, penalty: float = 0.05) -> tuple[float, ...]:
    """Logistic regression by Newton's method, with a penalty on slopes."""
    design = np.column_stack([np.ones(len(evidence)), evidence])
    beta = np.zeros(design.shape[1])
    ridge = np.diag([1e-6] + [penalty] * evidence.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (toxic - p) - ridge @ beta
        curvature = design.T @ (design * (p * (1 - p))[:, None]) + ridge
        step = np.linalg.solve(curvature, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(x) for x in beta)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> ToxicityModel:
    """Model from `docs (doc_id, text)` and `labels (doc_id, toxic)`.

    At most `max_rows` labelled documents are used, those with the smallest hash of their id; of near copies one
    counts. Labels without a document, null labels and null ids are left out; several labels of one id count as toxic if one
    is. Without toxic documents the model has no terms and every score is the same.
    """
    clean_labels = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = clean_labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # Ids and labels of a bounded sample: 16 bytes a row.
    sample = as_text(docs).join(F.broadcast(chosen), "doc_id").where("text IS NOT NULL")
    sketched = mapped(sample.select("text", F.col("toxic").cast("int").alias("toxic")), _sketches, "sketch long, text string, toxic int")
    sample = staged(sketched.groupBy("sketch").agg(F.max(F.struct("toxic", "text")).alias("row")).select("row.*"), "training")
    sizes = dict(sample.groupBy("toxic").count().collect())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    base = (math.log((n_toxic + 0.5) / (n_clean + 1.5)), 0.0, 0.0, 0.0)
    if not n_toxic or not n_clean:
        return ToxicityModel((), (), base)
    beginnings = mapped(sample, _beginnings, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    tried = staged(beginnings.where(F.col("toxic") >= MIN_DOCUMENTS), "beginnings")
    # So many terms are tried that some fit by chance; the bar rises with their number.
    bar = 2 * math.log(1 + tried.count())
    lift = (F.col("toxic") + 0.5) / (n_toxic + 1) / ((F.col("clean") + 0.5) / (n_clean + 1))
    strong = tried.where(lift >= MIN_LIFT)
    # The size of the model is bounded: the strongest beginnings only.
    rows = strong.orderBy(F.desc(lift * F.col("toxic")), F.desc(F.length("term")), "term").limit(MAX_TERMS).collect()
    # Copies that were changed here and there repeat their words in the same places: a term has to stand in as many.
    toxic_texts = sample.where("toxic = 1")
    placed = mapped(toxic_texts, functools.partial(_contexts, frozenset(row["term"] for row in rows)), "term string, context long")
    places = dict(placed.groupBy("term").agg(F.countDistinct("context")).collect())
    rated = [(_likelihood_ratio(min(row["toxic"], places[row["term"]]), row["clean"], n_toxic, n_clean), row["term"]) for row in rows]
    terms: list[str] = []
    for rating, term in sorted(rated, key=lambda x: (-round(x[0], 6), -len(x[1]), x[1])):
        if rating >= bar and not any(term.startswith(other) or other.startswith(term) for other in terms):
            terms.append(term)
    if not terms:
        return ToxicityModel((), (), base)
    known = tuple(sorted(terms))
    spelled = mapped(sample, functools.partial(_spellings, known), "term int, errors int, toxic int, n long")
    seen: Counter = Counter()
    for row in spelled.groupBy("term", "errors", "toxic").agg(F.sum("n").alias("n")).collect():
        seen[row["term"], row["errors"], row["toxic"]] = row["n"]
    weights = []
    for number, term in enumerate(known):
        own = _log_odds(seen[number, 0, 1], seen[number, 0, 0], n_toxic, n_clean)
        misspelled = []
        for errors in range(1, allowed_errors(term) + 1):
            toxic, clean = seen[number, errors, 1], seen[number, errors, 0]
            odds = _log_odds(toxic, clean, n_toxic, n_clean) if toxic + clean else own * 0.5**errors
            misspelled.append(max(0.0, min(own, odds)) if odds > math.log(MIN_LIFT) or not toxic + clean else 0.0)
        weights.append((max(0.0, own), *misspelled))
    model = ToxicityModel(known, tuple(weights), base)
    # Four numbers for each row of the bounded sample.
    found = mapped(sample, functools.partial(_evidence, model), "evidence array<double>, toxic int").collect()
    evidence = np.array([row["evidence"] for row in found])
    return ToxicityModel(known, tuple(weights), _fit(evidence, np.array([row["toxic"] for row in found])))


def _scores(model: ToxicityModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = _automaton(model.terms)
    for batch in batches:
        scores, n_hits, n_quoted = [], [], []
        for text in batch.column("text"):
            hits = automaton.hits(text.as_py() or "")
            hits = [hit for hit in hits if model.weights[hit[1]][hit[2]] > 0]
            scores.append(model.probability(model.evidence(hits)))
            n_hits.append(len(hits))
            n_quoted.append(sum(hit[3] for hit in hits))
        columns = [batch.column("doc_id"), pa.array(scores), pa.array(n_hits, pa.int32()), pa.array(n_quoted, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "n_hits", "n_quoted"])


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """`(doc_id, score, predicted, n_hits, n_quoted)` per row of `docs`, from its whole text and nothing else.

    Null and empty texts have no hits and get the score of a text without evidence. Repeated rows come out as often as
    they go in; other columns are not looked at; no rows give no rows.
    """
    scored = mapped(as_text(docs), functools.partial(_scores, model), "doc_id long, score double, n_hits int, n_quoted int")
    return scored.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_hits", "n_quoted")


def _accepted(model: ToxicityModel, threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = _automaton(model.terms)
    for batch in batches:
        scores = (model.probability(model.evidence(automaton.hits(text.as_py() or ""))) for text in batch.column("text"))
        yield batch.filter(pa.array([score < threshold for score in scores], pa.bool_()))


def accepted(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` with a score below the threshold, all columns as they are."""
    return mapped(docs, functools.partial(_accepted, model, threshold), docs.schema)
