"""Spelling variants: words one edit apart, found by asymmetric chunks.

Of two words that are one edit apart the longer one (of equal length: the smaller one) is cut into two disjoint chunks; the
other one gives its positional grams. The edit spoils one chunk at most, so the other one stands in the other word as
well: the first chunk at the same place, the second one shifted by what the lengths differ by, one at most. As the
chunks of a language's words are few and their buckets large, the spoilt half is cut once more in the same way: of its two
parts one is preserved, too, and only words that also share that one meet. Four keys each, one per place of the
edit; what meets is verified in the join itself, so only true pairs leave it.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import as_text, staged

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
MIN_LENGTH = 6
MIN_TIMES = 5
FACTOR = 5
# One occurrence in so many loses a letter, by its checksum.
SLIP = 199


def occurrences(docs: DataFrame, slip: int | None = SLIP) -> DataFrame:
    """`(word)`, one row per run of letters of each whole text, A-Z in lower case; a null text has none.

    With `slip`, a run loses one letter if `slip` divides the CRC-32 of `<doc_id>:<run>`: that at the checksum modulo its
    length. A null id counts as an empty one.
    """
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = as_text(docs).select(doc_id.alias("id"), F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"))
    if slip is None:
        return runs.select(F.col("run").alias("word"))
    check = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = F.pmod(F.col("check"), F.char_length("run").cast("long")).cast("int")
    left = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    return runs.withColumn("check", check).select(F.when(F.col("check") % slip == 0, left).otherwise(F.col("run")).alias("word"))


def counted(words: DataFrame, min_length: int = MIN_LENGTH, min_times: int = MIN_TIMES) -> DataFrame:
    """`(word, n)` of the words that are long and frequent enough."""
    counts = words.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= min_times)


def _keys(size: Column) -> Column:
    """What `word` has in common with a word of `size` letters that differs in one of its four parts only: all before
    that part and all behind it."""
    half = F.ceil(size / 2).cast("int")
    ends = [F.lit(0), F.ceil(half / 2).cast("int"), half, half + F.ceil((size - half) / 2).cast("int"), size]
    word = F.col("word")
    rests = [
        F.struct(
            size.alias("size"),
            F.lit(part).alias("part"),
            F.concat(F.substring(word, F.lit(1), ends[part]), F.lit(" "), F.right(word, size - ends[part + 1])).alias("rest"),
        )
        for part in range(4)
    ]
    return F.array(*rests)


def near_pairs(words: DataFrame) -> DataFrame:
    """`(a, a_n, b, b_n)`: all pairs of `words (word, n)` that differ by one inserted, deleted or replaced letter, once or
    more often. Empty words take no part."""
    length = F.char_length("word")
    words = words.where(length > 0)
    chunks = words.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.explode(_keys(length)).alias("key")).select("a", "a_n", "key.*")
    grams = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.explode(F.concat(_keys(length), _keys(length + 1))).alias("key")).select("b", "b_n", "key.*")
    longer_or_first = (F.char_length("a") > F.char_length("b")) | (F.col("a") < F.col("b"))
    # The bucket is verified where it meets: no pair that is not near is ever a row.
    near = F.levenshtein("a", "b", 1) == 1
    met = chunks.join(grams, (chunks["size"] == grams["size"]) & (chunks["part"] == grams["part"]) & (chunks["rest"] == grams["rest"]) & longer_or_first & near)
    return met.select("a", "a_n", "b", "b_n")


def _roots(forms: DataFrame) -> DataFrame:
    """`(word, root)` of the words in `forms (word, form)`, by doubling the steps: a form is several times as frequent as its
    word, so there are no circles and chains are short."""
    state = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("word").alias("via"), F.col("root").alias("next"))
        moved = state.join(further, state["root"] == further["via"], "left")
        state = staged(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not state.where("moved").limit(1).count():
            return state.select("word", "root")
        state = state.select("word", "root")


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """`(word, form, root, n, n_near, form_n)` per row of `words (word, n)`, which are distinct.

    A word's form is the most frequent word one edit away, of equally frequent ones the first in code-point order, if it is
    at least `factor` times as frequent; its root is what following the forms ends at, the word itself if there is
    none. No words give no rows; null words take no part.
    """
    words = staged(words.where("word IS NOT NULL").select("word", "n"), "words")
    pairs = near_pairs(words)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(pairs.select("b", "a", "a_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    found = both.distinct().groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    wins = -F.col("best.less") >= factor * F.col("n")
    judged = words.join(found, "word", "left").select(
        "word",
        F.when(wins, F.col("best.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(wins, -F.col("best.less")).alias("form_n"),
    )
    judged = staged(judged, "variants")
    roots = _roots(judged.where("form IS NOT NULL").select("word", "form"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def grouped(docs: DataFrame) -> DataFrame:
    """The variants of the words of whole `docs (doc_id, text)`, with the fixed parameters of this module. Repeated rows count
    as often as they stand there; other columns are not looked at; null and empty texts have no words."""
    return variants(counted(occurrences(docs)))
