"""From raw documents to token ids: the stages of the corpus pipeline, in order.

Each stage works on all that the one before it kept, and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm import byte_bpe, decontamination, lsh_forest, simhash, substrings, toxicity
from sluiceway.llm.common import intermediate, table
from sluiceway.llm.queries import held_out
from sluiceway.sources import storage

# Near copies: words of a shingle, least Jaccard similarity in hundredths.
SHINGLE, PERCENT = 5, 80
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the threshold go. Null and empty texts stay; repeated rows are judged alike."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return toxicity.accepted(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose sets of five-word shingles have a Jaccard similarity of 0.8 and more, tied over any number of
    them, the one with the smallest id stays; of those without words, too.

    By SimHash: texts whose fingerprints differ in four bits at most meet through Golay keys, and their sets are compared. At that
    similarity fingerprints differ in 3 to 13 bits, more than Golay keys reach, so the pairs further apart meet in MinHash trees."""
    return lsh_forest.representatives(docs, SHINGLE, PERCENT, simhash.close_texts(docs))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words and more that stand anywhere else are cut out; all documents stay. Null and empty texts stay as they
    are; of rows that are repeated all lose their words."""
    cut = substrings.Repeats(docs).removed_from(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Null and empty texts stay, and hold nothing; so do all without items."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and its text as decoded from them; a null text becomes an empty one without ids."""
    vocabulary = byte_bpe.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_bpe.tokenized(docs, vocabulary)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeated_passages", cut_repeated_passages),
    ("benchmark", drop_benchmark_copies),
    ("tokens", tokenize),
]

# Shingle sets, components, factors and merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the rows of the last one."""
    docs, before = table(spark, sf_dir, "documents").select(*COLUMNS), None
    for name, stage in STAGES:
        # What a stage stages on its way goes with it, and its input when its result is written.
        with intermediate(spark):
            path = storage.scratch_dir(spark, name)
            docs = storage.staged(stage(spark, docs, sf_dir), path)
        if before:
            storage.release(spark, before)
        before = path
    return docs
