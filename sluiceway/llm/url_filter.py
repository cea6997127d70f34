"""URL filter: rules first; other hosts and paths by naive Bayes over the words they are made of.

Host labels often are words written together. A unigram model of the words on the pages themselves splits them: the
Viterbi path of highest probability. Only words that occur in some label matter, so each distinct label meets the
counts of its own substrings and no vocabulary is sent around. Pages that a rule decides are the training data of
the multinomial naive Bayes model, whose scores are sums over the words of a host and of a path.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import mapped, staged

# The rules: verdict, host, beginning of the path. Fixed values.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
MAX_WORD = 24
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty where it is null or has no `://`."""
    rest = F.when(F.contains(url, F.lit("://")), F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits, as struct `(rule, verdict)`, or null. A rule fits its host and all subdomains, and paths
    that begin with its own; of equally long rules the first in the list holds."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(reversed(rules), key=lambda rule: len(rule[1] + rule[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        named = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


def word_counts(pages: DataFrame) -> DataFrame:
    """`(word, n)`: how often the lower-case ASCII words stand in the text of all pages."""
    html = F.regexp_replace(F.coalesce(F.col("html").cast("string"), F.lit("")), r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", " ")
    text = F.lower(F.regexp_replace(html, r"<[^>]*>", " "))
    found = pages.select(F.explode(F.split(text, r"[^\p{L}]+")).alias("word")).where(F.col("word").rlike(f"^[a-z]{{1,{MAX_WORD}}}$"))
    return found.groupBy("word").agg(F.count("*").alias("n"))


def viterbi(label: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable split of a label into words; an unknown word costs ever more with its length."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(label) + 1):
        options = []
        for start in range(max(0, end - MAX_WORD), end):
            word = label[start:end]
            n = counts.get(word)
            score = math.log(n / total) if n else math.log(1 / total) - 2.5 * len(word)
            options.append((best[start][0] + score, start))
        best.append(max(options))
    words, end = [], len(label)
    while end:
        start = best[end][1]
        words.append(label[start:end])
        end = start
    return words[::-1]


def _split_labels(total: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = batch.column("run").to_pylist()
        known = batch.column("known").to_pylist()
        words = [viterbi(label, {x["word"]: x["n"] for x in found or ()}, total) for label, found in zip(labels, known, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(words, pa.list_(pa.string()))], ["run", "words"])


def split_labels(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """`(run, words)` for distinct `runs (run)` of letters."""
    total = max(1, counts.agg(F.sum("n")).first()[0] or 0)
    places = F.sequence(F.lit(1), F.length("run"))
    lengths = lambda at: F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), F.length("run") - at + 1))
    pieces = F.flatten(F.transform(places, lambda at: F.transform(lengths(at), lambda n: F.substring(F.col("run"), at, n))))
    substrings = runs.select("run", F.explode(F.array_distinct(pieces)).alias("word"))
    known = substrings.join(counts, "word").groupBy("run").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    return mapped(runs.join(known, "run", "left"), functools.partial(_split_labels, total), "run string, words array<string>")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """`(page_id, host, path, rule, verdict, score)` per row of `pages (page_id, url, html)`.

    `score` is the log odds of blocking by naive Bayes for every page; `verdict` follows the rule where one fits, else
    the sign of the score: zero, so also a page without any known word when both classes are as frequent, is allowed.
    Without pages that rules decide, all others are allowed. Null urls have an empty host and path; rows come out as
    often as they go in; other columns are not looked at; no rows give no rows.
    """
    host, path = split_url(F.col("url").cast("string"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    parsed = staged(parsed.select("page_id", "host", "path", "found.*"), "urls")
    # Hot hosts and paths are one row each from here on.
    blocked = F.sum(F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("block")
    allowed = F.sum(F.when(F.col("verdict") == "allow", 1).otherwise(0)).alias("allow")
    hosts = staged(parsed.groupBy("host").agg(blocked, allowed), "hosts")
    paths = staged(parsed.groupBy("path").agg(blocked, allowed), "paths")

    runs = F.filter(F.split("host", r"[^a-z]+"), lambda x: x != "")
    host_runs = hosts.select("host", F.explode(runs).alias("run"))
    # Used twice, for the total and for the labels.
    words = staged(word_counts(pages), "words")
    split = staged(split_labels(host_runs.select("run").distinct(), words), "labels")
    host_words = host_runs.join(split, "run").select("host", F.explode("words").alias("word"))
    # Digits and letters beyond a-z are no part of the words on pages: a run of them is a word of its own.
    others = F.filter(F.split("host", r"[a-z.:\-_]+"), lambda x: x != "")
    host_words = host_words.union(hosts.select("host", F.explode(others).alias("word")))
    host_tokens = host_words.select("host", F.concat(F.lit("h:"), "word").alias("token"))
    path_words = F.filter(F.split(F.lower("path"), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    path_tokens = paths.select("path", F.explode(path_words).alias("word")).select("path", F.concat(F.lit("p:"), "word").alias("token"))

    tokens = host_tokens.join(hosts, "host").select("token", "block", "allow").union(path_tokens.join(paths, "path").select("token", "block", "allow"))
    counts = staged(tokens.groupBy("token").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")).where("block + allow > 0"), "tokens")
    sums = counts.agg(F.sum("block"), F.sum("allow"), F.count("*")).first()
    in_block, in_allow, n_tokens = (int(x or 0) for x in sums)
    n_block, n_allow = (int(x or 0) for x in hosts.agg(F.sum("block"), F.sum("allow")).first())
    ratio = F.log((F.col("block") + 1) / (in_block + n_tokens + 1)) - F.log((F.col("allow") + 1) / (in_allow + n_tokens + 1))
    weights = counts.select("token", ratio.alias("weight"))
    prior = math.log((n_block + 1) / (n_allow + 1))
    # Written first: small ones go to the pages, and of large ones Spark can split what a hot host joins.
    of_host = staged(host_tokens.join(weights, "token").groupBy("host").agg(F.sum("weight").alias("host_score")), "of-host")
    of_path = staged(path_tokens.join(weights, "token").groupBy("path").agg(F.sum("weight").alias("path_score")), "of-path")
    scored = parsed.join(of_host, "host", "left").join(of_path, "path", "left")
    score = F.lit(prior) + F.coalesce("host_score", F.lit(0.0)) + F.coalesce("path_score", F.lit(0.0))
    judged = F.when(score > 0, "block").otherwise("allow") if n_block + n_allow else F.lit("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("verdict", judged).alias("verdict"), score.alias("score"))
