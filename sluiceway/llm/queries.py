"""Queries that apply each operator, with its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm import byte_bpe, decontamination, language_id, lsh_forest, mtree, sharding, simhash, spelling, substrings, token_files, toxicity, url_filter, whitening
from sluiceway.llm.common import table
from sluiceway.sources import storage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op3_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def held_out(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string")) % 3 == 1


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~held_out()))
    return toxicity.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted", "n_hits", "n_quoted")


@query
def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.Repeats(table(spark, sf_dir, "documents")).without().withColumnRenamed("digest", "kept_sha256")


@query
def op2_benchmark_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = byte_bpe.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary)


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoding = token_files.read_encoding(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    path = storage.scratch_dir(spark, "tokens")
    token_files.write(table(spark, sf_dir, "documents"), encoding, path)
    return token_files.documents(spark, path)


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query
def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id")).select("doc_id", "slot", "shard")


# The table is filled claim by claim: a shard takes the first slot of its order that is still free (-1 in the list).
ORACLES["op10_shards"] = f"""
WITH RECURSIVE shards AS (
    SELECT list(offs ORDER BY n) AS offs, list(step ORDER BY n) AS step FROM (
        SELECT n, CAST('0x' || substr(md5(printf('shard-%02d/offset', n)), 1, 15) AS BIGINT) % {sharding.TABLE_SIZE} AS offs,
            CAST('0x' || substr(md5(printf('shard-%02d/step', n)), 1, 15) AS BIGINT) % {sharding.TABLE_SIZE - 1} + 1 AS step
        FROM range({len(sharding.SHARDS)}) AS t(n))
), filled AS (
    SELECT 0 AS claim, list_transform(range({sharding.TABLE_SIZE}), lambda x: -1) AS slots, offs, step FROM shards
    UNION ALL
    SELECT claim + 1, slots[:claimed] || [claim % {len(sharding.SHARDS)}] || slots[claimed + 2:], offs, step
    FROM (
        SELECT *, list_filter(
                list_transform(range({sharding.TABLE_SIZE}), lambda j: (first + j * stride) % {sharding.TABLE_SIZE}),
                lambda slot: slots[slot + 1] = -1)[1] AS claimed
        FROM (SELECT *, offs[claim % {len(sharding.SHARDS)} + 1] AS first, step[claim % {len(sharding.SHARDS)} + 1] AS stride
              FROM filled WHERE claim < {sharding.TABLE_SIZE}))
), lookup AS (
    SELECT unnest(range({sharding.TABLE_SIZE})) AS slot, unnest(slots) AS number FROM filled WHERE claim = {sharding.TABLE_SIZE}
)
SELECT doc_id, CAST(slot AS INTEGER) AS slot, printf('shard-%02d', number) AS shard
FROM documents JOIN lookup
    ON slot = CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {sharding.TABLE_SIZE}
"""


@query
def op8_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"))


ORACLES["op8_top_inner_products"] = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "pages"), language_id.train(table(spark, sf_dir, "documents")))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(table(spark, sf_dir, "documents"))


# CRC-32 byte by byte with its table of 256 entries; all letters have one or two bytes. Of words one edit
# apart both lack the same letter, or one of them is the other without a letter.
ORACLES["op13_spelling_variants"] = """
WITH RECURSIVE steps AS (
    SELECT 0 AS step, i, i AS c FROM range(256) AS t(i)
    UNION ALL
    SELECT step + 1, i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE step < 8
), crc AS (
    SELECT list(c ORDER BY i) AS entries FROM steps WHERE step = 8
), runs AS (
    SELECT id, run, count(*) AS times FROM (
        SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS id,
            unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
        FROM documents)
    GROUP BY id, run
), checked AS (
    SELECT run, times, xor(list_reduce(
        flatten(list_transform(string_split(id || run, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)]
            ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] END)),
        lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
    FROM runs, crc
), slipped AS (
    SELECT times, CASE WHEN h % 199 = 0 THEN run[:CAST(h % length(run) AS INTEGER)] || run[CAST(h % length(run) AS INTEGER) + 2:] ELSE run END AS word
    FROM checked
), words AS (
    SELECT word, CAST(sum(times) AS BIGINT) AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), parts AS (
    SELECT word, n, i, word[:i] || word[i + 2:] AS part FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM parts a JOIN parts b ON a.part = b.part AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM parts a JOIN words b ON a.part = b.word
    UNION SELECT b.word, a.word, a.n FROM parts a JOIN words b ON a.part = b.word
), best AS (
    SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS form, max(near_n) AS form_n FROM near GROUP BY word
), judged AS (
    SELECT w.word, CASE WHEN form_n >= 5 * n THEN form END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
    FROM words w LEFT JOIN best USING (word)
), chains AS (
    SELECT word, word AS root, form AS next FROM judged
    UNION ALL
    SELECT c.word, j.word, j.form FROM chains c JOIN judged j ON c.next = j.word
)
SELECT j.word, form, root, n, n_near, form_n FROM judged j JOIN chains c ON j.word = c.word AND c.next IS NULL
"""


@query
def op12_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_copies(table(spark, sf_dir, "documents"))


# All pairs of distinct sets with a common shingle.
ORACLES["op12_minhash_forest"] = """
WITH RECURSIVE parts AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE
        WHEN len(w) >= 3 THEN list_sort(list_distinct(list_transform(range(len(w) - 2), lambda i: w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
    FROM parts
), nodes AS (
    SELECT s, min(doc_id) AS node FROM sets WHERE len(s) > 0 GROUP BY s
), items AS (
    SELECT node, len(s) AS n, unnest(s) AS x FROM nodes
), links AS (
    SELECT a.node AS a, b.node AS b FROM items a JOIN items b ON a.x = b.x AND a.node < b.node
    GROUP BY a.node, b.node, a.n, b.n HAVING 185 * count(*) >= 85 * (a.n + b.n)
), steps AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links UNION ALL SELECT node, node FROM nodes
), reached AS (
    SELECT node AS a, node AS b FROM nodes
    UNION
    SELECT r.a, s.b FROM reached r JOIN steps s ON r.b = s.a
), named AS (
    SELECT a AS node, min(b) AS component_id FROM reached GROUP BY a
)
SELECT d.doc_id, len(d.s) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id, d.doc_id = coalesce(c.component_id, d.doc_id) AS kept
FROM sets d LEFT JOIN nodes ON len(d.s) > 0 AND d.s = nodes.s LEFT JOIN named c ON c.node = nodes.node
"""


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return rows.withColumnRenamed("id", "vec_id").withColumn("deviation", F.col("deviation").cast("long"))
