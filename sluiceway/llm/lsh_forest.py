"""Near-duplicate documents by MinHash in an LSH forest.

A document's signature has a label per tree: eight minima of its shingles' hashes, one byte of each. The labels of a
tree, sorted, are that tree: documents with a common prefix stand side by side, those with the longest one closest. So
a document's candidates are its neighbours in each order: the next ones if they share the first four levels, those further
off if they share more, up to all eight. So the depth adapts: in a crowded region, where many stand between, it is larger.

Two sets of similarity J share four levels of one tree with probability J^4 and of no tree with (1 - J^4)^32: 6e-11 at
0.85, 5e-8 at 0.8; all eight with J^8, and of no tree with 4e-5 and 3e-3, which is what counts amid documents that are all
alike but not similar enough. In each tree a pair also has to share most levels of three more labels, which one of 0.85
does 23 times of 25. The next neighbours of all trees come first and are tied to components; then each document meets,
within a wider window, only those of other components. Candidates are narrowed by their whole signatures, which rule a
link at the very threshold out with probability 3e-5, and confirmed on full sets.

Where more rows than the window share all eight levels, a row's neighbours in the order are any of them: the one text that ties a copy to a large group
of copies may stand anywhere. There the full sets of all are compared that are still of different components, so all eight levels in one tree
are enough, however many share them.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import LOWER, hashes, intermediate, mapped, mixed, staged, texts_of, words
from sluiceway.llm.components import components
from sluiceway.llm.simhash import first_rows, keyed

SHINGLE = 3
# Least Jaccard similarity, in hundredths.
PERCENT = 85
TREES = 32
LEVELS = 8
# Levels that candidates share at least.
LEAST_LEVELS = 4
# Neighbours on either side that a document meets in each order, if they are of another component.
WINDOW = 16
# Labels of other trees that a row has with it, and standard deviations by which their levels may fall short in one tree.
MORE, LOOSE = 3, 1.3
# Standard deviations by which an estimate may fall short of the similarity.
TOLERANCE = 4
# Rows, and shingles of them, of either side that meet at once where a label is crowded.
CROWD_ROWS, CROWD_SHINGLES = 4096, 1 << 21
# Shingles of a set in one row.
PIECE = 512
ROWS_PER_PARTITION = 200_000
SLICE = 1 << 20
SIGN = np.uint64(1 << 63)


def shingles_of(text: bytes, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles, A-Z in lower case; of a shorter text, of all its words; no words: none."""
    values = hashes(words(text.translate(LOWER)))
    size = min(len(values), shingle)
    if not size:
        return values
    factors = mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    n = len(values) - size + 1
    joined = np.full(n, size, np.uint64)
    for i in range(size):
        joined += values[i : i + n] * factors[i]
    return np.unique(mixed(joined))


@functools.cache
def _factors(trees: int) -> np.ndarray:
    drawn = mixed(np.arange(1000, 1000 + trees * LEVELS, dtype=np.uint64))
    return ((drawn >> np.uint64(32)).astype(np.uint32) | np.uint32(1))[:, None]


def labels_of(found: np.ndarray, trees: int = TREES) -> np.ndarray:
    """A set's label in each tree, as signed integers whose order is that of the eight bytes."""
    factors = _factors(trees)
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    low, high = found.astype(np.uint32), (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(found), 2048):
        np.minimum(least, (factors * high[at : at + 2048] + low[at : at + 2048]).min(axis=1), out=least)
    parts = ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
    return (parts.view(">u8").astype(np.uint64) ^ SIGN).view(np.int64)


def _node(found: np.ndarray) -> int:
    return int(hashes([found.tobytes()]).view(np.int64)[0])


def _signatures(shingle: int, trees: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, sizes, labels = [], [], []
        for text in texts_of(batch):
            found = shingles_of(text, shingle)
            sizes.append(len(found))
            nodes.append(_node(found) if len(found) else None)
            labels.append(labels_of(found, trees) if len(found) else np.zeros(0, np.int64))
        offsets = pa.array(np.cumsum([0, *map(len, labels)]), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*labels, np.zeros(0, np.int64)])))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), lists], ["doc_id", "text_key", "node", "n_shingles", "labels"]
        )


def levels_at(step: int) -> int:
    """The levels that neighbours share at least that stand `step` apart: one more for each doubling, up to all."""
    return min(LEVELS, LEAST_LEVELS + (step - 1).bit_length())


COLUMNS = ["place", "tree", "label", "node", "component", *(f"more{k}" for k in range(MORE))]


def _near_in_order(window: int, least: int, edges: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbours in sorted rows that agree in place and tree, share enough levels for their distance, differ in
    component and share `least` levels of the labels from other trees. With `edges` also the first and the last rows of
    the partition, as rows of the places where it joins the one before and the one after."""
    kept = [np.zeros(0, np.int64)] * len(COLUMNS)
    first = None
    part = TaskContext.get().partitionId()

    def out(low, high, others) -> pa.RecordBatch:
        columns = {"low": low, "high": high, **others}
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns.values()], list(columns))

    def edge(rows: list[np.ndarray], place: int) -> pa.RecordBatch:
        others = dict(zip(COLUMNS, rows, strict=True))
        node = others.pop("node")
        return out(node, pa.nulls(len(node), pa.int64()), {**others, "place": np.full(len(node), place)})

    for batch in batches:
        if not batch.num_rows:
            continue
        own = [batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in COLUMNS]
        rows = [np.concatenate(x) for x in zip(kept, own, strict=True)]
        if first is None or len(first[0]) < window:
            first = [x[:window] for x in (own if first is None else [np.concatenate(x) for x in zip(first, own, strict=True)])]
        place, tree, label, node, component, *more = rows
        lows, highs = [], []
        for step in range(1, min(window, len(node) - 1) + 1):
            # A pair of two rows that were kept was met before.
            start = max(0, len(kept[0]) - step)
            here, there = slice(start, len(node) - step), slice(start + step, None)
            prefix = np.int64(8 * (LEVELS - levels_at(step)))
            close = (place[here] == place[there]) & (tree[here] == tree[there]) & (label[here] >> prefix == label[there] >> prefix)
            if not close.any():
                break
            at = np.flatnonzero(close & (component[here] != component[there])) + start
            shared = sum((np.ascontiguousarray(x[at] ^ x[at + step]).view(np.uint8).reshape(-1, 8) == 0).sum(axis=1) for x in more)
            at = at[shared >= least]
            lows.append(np.minimum(node[at], node[at + step]))
            highs.append(np.maximum(node[at], node[at + step]))
        if lows:
            pairs = np.unique(np.stack([np.concatenate(lows), np.concatenate(highs)]), axis=1)
            none = pa.nulls(pairs.shape[1], pa.int64())
            yield out(pairs[0], pairs[1], {name: none for name in COLUMNS if name != "node"})
        kept = [x[-window:] for x in rows]
    if edges and first is not None:
        yield edge(first, part - 1)
        yield edge(kept, part)


def neighbours(nodes: DataFrame, n_nodes: int, window: int, percent: int = PERCENT) -> DataFrame:
    """`(low, high)`: neighbours in the orders of all trees that differ in component, of `nodes (node, labels, component)`."""
    others = [name for name in COLUMNS if name != "node"]
    schema = ", ".join(f"{name} long" for name in ("low", "high", *others))
    rows = nodes.select("node", "component", "labels", F.posexplode("labels").alias("tree", "label"))
    more = [F.get("labels", F.pmod(F.col("tree") + (k + 1) * TREES // (MORE + 1), F.lit(TREES)).cast("int")).alias(f"more{k}") for k in range(MORE)]
    rows = rows.select(F.lit(0).cast("long").alias("place"), F.col("tree").cast("long").alias("tree"), "label", "node", "component", *more)
    least = least_matches(percent, MORE, LOOSE)
    # By range, so that a crowded region is split like any other; where two partitions join comes after.
    n_partitions = max(1, n_nodes * TREES // ROWS_PER_PARTITION)
    sorted_rows = rows.repartitionByRange(n_partitions, "tree", "label", "node").sortWithinPartitions("tree", "label", "node")
    found = staged(mapped(sorted_rows, functools.partial(_near_in_order, window, least, True), schema), "neighbours")
    edges = found.where("high IS NULL").withColumn("node", F.col("low")).select(*COLUMNS)
    joined = edges.repartition("place").sortWithinPartitions("place", "tree", "label", "node")
    across = mapped(joined, functools.partial(_near_in_order, window, least, False), schema)
    return found.where("high IS NOT NULL").select("low", "high").union(across.select("low", "high")).distinct()


def least_matches(percent: int, trees: int, tolerance: float = TOLERANCE) -> int:
    """How many of the levels of so many trees sets of that similarity share at least, but for chance."""
    n, p = trees * LEVELS, percent / 100
    return max(0, math.floor(n * p - tolerance * math.sqrt(n * p * (1 - p))))


def _alike(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = [np.ascontiguousarray(batch.column(name).flatten().to_numpy()).view(np.uint8) for name in ("a", "b")]
        same = (both[0] == both[1]).reshape(batch.num_rows, -1).sum(axis=1) >= least if batch.num_rows else np.zeros(0, bool)
        yield batch.select(["low", "high"]).filter(pa.array(same))


def alike(pairs: DataFrame, nodes: DataFrame, percent: int, trees: int = TREES) -> DataFrame:
    """The `pairs (low, high)` whose signatures do not rule the similarity out."""
    a = nodes.select(F.col("node").alias("low"), F.col("labels").alias("a"))
    b = nodes.select(F.col("node").alias("high"), F.col("labels").alias("b"))
    return mapped(pairs.join(a, "low").join(b, "high").select("low", "high", "a", "b"), functools.partial(_alike, least_matches(percent, trees)), "low long, high long")


def _sets(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text in texts_of(batch):
            found = shingles_of(text, shingle)
            values = pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), pa.array(found.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array([_node(found)], pa.int64()), values], ["node", "shingles"])


def texts_of_nodes(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """`(text)`: one text of each node in `wanted (node)`; as often as a row is repeated."""
    sources = nodes.join(wanted, "node", "left_semi").select(F.col("least.doc_id").alias("doc_id"), F.col("least.text_key").alias("text_key"))
    texts = keyed(docs)
    same = texts["doc_id"].eqNullSafe(sources["doc_id"]) & (texts["text_key"] == sources["text_key"])
    return texts.join(sources, same, "left_semi").select("text")


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The `pairs (low, high)` whose full sets reach the similarity. The sets are made anew, from one text of each node."""
    wanted = pairs.select(F.col("low").alias("node")).union(pairs.select("high")).distinct()
    sets = mapped(texts_of_nodes(wanted, nodes, docs), functools.partial(_sets, shingle), "node long, shingles array<long>")
    sets = staged(sets.dropDuplicates(["node"]), "sets")
    low = sets.select(F.col("node").alias("low"), F.col("shingles").alias("a"))
    high = sets.select(F.col("node").alias("high"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    return pairs.join(low, "low").join(high, "high").where(both * (100 + percent) >= percent * (F.size("a") + F.size("b"))).select("low", "high")


def _pieces(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets in rows of `PIECE` shingles at most, so that a batch of rows is bounded whatever the texts."""
    for batch in batches:
        for text in texts_of(batch):
            found = shingles_of(text, shingle)
            starts = np.arange(0, len(found), PIECE)
            offsets = pa.array(np.append(starts, len(found)), pa.int32())
            columns = [pa.array(np.full(len(starts), _node(found))), pa.array(starts), pa.ListArray.from_arrays(offsets, pa.array(found.view(np.int64)))]
            yield pa.RecordBatch.from_arrays(columns, ["node", "at", "shingles"])


CROWD = ["tree", "label", "seeking", "met"]


def _links_of(rows: pa.Table, percent: int) -> pa.RecordBatch:
    """Links between seekers (side 0) and members (side 1) of different components, as few as tie all components that have any."""
    side, at, node, component = (rows.column(name).to_numpy() for name in ("side", "at", "node", "component"))
    sets = rows.column("shingles").combine_chunks()
    values, flat = np.unique(sets.flatten().to_numpy(), return_inverse=True)
    first = np.flatnonzero(at == 0)
    begin = np.concatenate([[0], np.cumsum(sets.value_lengths().to_numpy())])[np.append(first, len(at))]
    sizes, node, n_seekers = np.diff(begin), node[first], int((side[first] == 0).sum())
    names, of_row = np.unique(component[first], return_inverse=True)
    root, member_of = np.arange(len(names)), of_row[n_seekers:]
    members, their_sizes, starts = flat[begin[n_seekers] :], sizes[n_seekers:], begin[n_seekers:-1] - begin[n_seekers]
    marked, lows, highs = np.zeros(len(values), np.int32), [], []
    for i in range(n_seekers if len(their_sizes) else 0):
        own = root[of_row[i]]
        smaller, larger = np.minimum(their_sizes, sizes[i]), np.maximum(their_sizes, sizes[i])
        others = np.flatnonzero((root[member_of] != own) & (100 * smaller >= percent * larger))
        if not len(others):
            continue
        mine = flat[begin[i] : begin[i + 1]]
        marked[mine] = 1
        if 4 * len(others) < len(starts):
            some = np.concatenate([members[starts[j] : starts[j] + their_sizes[j]] for j in others.tolist()])
            common = np.add.reduceat(marked[some], np.cumsum(their_sizes[others]) - their_sizes[others])
        else:
            common = np.add.reduceat(marked[members], starts)[others]
        marked[mine] = 0
        linked = others[common * (100 + percent) >= percent * (sizes[i] + their_sizes[others])]
        for j in linked.tolist():
            other = root[member_of[j]]
            if other != own:
                root[root == other] = own
                lows.append(min(node[i], node[n_seekers + j]))
                highs.append(max(node[i], node[n_seekers + j]))
    return pa.RecordBatch.from_arrays([pa.array(lows, pa.int64()), pa.array(highs, pa.int64())], ["low", "high"])


def _meet(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links within each meeting, of rows sorted by meeting, side, node and place in the set."""
    key, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(name).to_numpy() for name in CROWD]
        changes = np.flatnonzero(np.any([x[1:] != x[:-1] for x in columns], axis=0)) + 1
        for start, end in zip([0, *changes.tolist()], [*changes.tolist(), batch.num_rows], strict=True):
            here = tuple(int(x[start]) for x in columns)
            if parts and here != key:
                yield _links_of(pa.Table.from_batches(parts), percent)
                parts = []
            key = here
            parts.append(batch.slice(start, end - start))
    if parts:
        yield _links_of(pa.Table.from_batches(parts), percent)


def crowded_links(rows: DataFrame, docs: DataFrame, shingle: int, window: int, percent: int) -> DataFrame | None:
    """`(low, high)`: links between the components of `rows (node, least, labels, n_shingles, component)`, found among the rows of each label that
    more than `window` share; none if there are no such rows.

    In each of them those that are not of its largest component meet all, in chunks of both sides, so that none is one task's."""
    labelled = rows.select("node", "component", "n_shingles", F.posexplode("labels").alias("tree", "label"))
    of_label = labelled.groupBy("tree", "label").agg(F.count("*").alias("n"), F.min("component").alias("a"), F.max("component").alias("b"))
    inside = staged(labelled.join(of_label.where((F.col("n") > window) & (F.col("a") < F.col("b"))), ["tree", "label"], "left_semi"), "crowded")
    if inside.isEmpty():
        return None
    parts = inside.groupBy("tree", "label", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("all"))
    whole = parts.groupBy("tree", "label").agg(F.max(F.struct("n", "component", "all")).alias("main"), F.sum("n").alias("n"), F.sum("all").alias("all"))

    def chunks(n, n_shingles):
        return F.ceil(F.greatest(n / CROWD_ROWS, n_shingles / CROWD_SHINGLES)).cast("int")

    n, n_shingles = F.col("n"), F.col("all")
    seeking = chunks(n - F.col("main.n"), n_shingles - F.col("main.all")).alias("n_seeking")
    placed = inside.drop("n_shingles").join(whole.select("tree", "label", F.col("main.component").alias("main"), seeking, chunks(n, n_shingles).alias("n_met")), ["tree", "label"])
    own = {name: F.pmod(F.xxhash64("node"), F.col(f"n_{name}")).cast("int") for name in ("seeking", "met")}
    every = {name: F.explode(F.sequence(F.lit(0), F.col(f"n_{name}") - 1)) for name in ("seeking", "met")}
    names = ["tree", "label", "node", "component"]
    seekers = placed.where("component <> main").select(*names, F.lit(0).alias("side"), own["seeking"].alias("seeking"), every["met"].alias("met"))
    members = placed.select(*names, F.lit(1).alias("side"), every["seeking"].alias("seeking"), own["met"].alias("met"))
    texts = texts_of_nodes(inside.select("node").distinct(), rows, docs)
    sets = staged(mapped(texts, functools.partial(_pieces, shingle), "node long, at long, shingles array<long>").dropDuplicates(["node", "at"]), "sets")
    meetings = seekers.union(members).join(sets, "node").repartition(*CROWD).sortWithinPartitions(*CROWD, "side", "node", "at")
    return mapped(meetings, functools.partial(_meet, percent), "low long, high long").distinct()


def print_pairs(prints: DataFrame, links: DataFrame) -> DataFrame:
    """`(low, high)`: the nodes that `links (low, high)` between fingerprints stand for, by the first node of each in `prints (bits, first)`."""
    a = prints.select(F.col("bits").alias("low"), F.col("first").alias("a"))
    b = prints.select(F.col("bits").alias("high"), F.col("first").alias("b"))
    return links.join(a, "low").join(b, "high").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))


def untied(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The `pairs (low, high)` of nodes that differ in component, once each."""
    a = rows.select(F.col("node").alias("low"), F.col("component").alias("a"))
    b = rows.select(F.col("node").alias("high"), F.col("component").alias("b"))
    return pairs.distinct().join(a, "low").join(b, "high").where("a <> b").select("low", "high")


def groups(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    window: int = WINDOW,
    link_empty: bool = False,
    close: tuple[DataFrame, DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """`(doc_id, text_key, node, n_shingles)` of all rows; `(node, least, group)`, `least` being the first id and text key. Rows
    without words have no node, or one for all with `link_empty`.

    `close`, of `simhash.close_texts`, comes before the trees: texts of one fingerprint and linked ones are candidates, first
    each fingerprint with the smallest that it is linked with, then all links that are not tied by those."""
    spark = docs.sparkSession
    schema = "doc_id long, text_key long, node long, n_shingles long, labels array<long>"
    with intermediate(spark) as keep:
        signed = mapped(keyed(docs), functools.partial(_signatures, shingle, TREES), schema)
        signed = staged(signed.withColumn("node", F.coalesce("node", F.lit(0 if link_empty else None).cast("long"))), "signatures")
        # Nulls come last.
        least = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
        nodes = staged(signed.where("node IS NOT NULL").groupBy("node").agg(F.min(least).alias("least"), F.any_value("labels").alias("labels"), F.any_value("n_shingles").alias("n_shingles")), "nodes")
        n_nodes = nodes.count()
        finds = [lambda rows, wide=wide: neighbours(rows, n_nodes, wide, percent) for wide in (1, window)]
        if close:
            texts, near = close
            of_text = signed.where("n_shingles > 0").groupBy("text_key").agg(F.any_value("node").alias("node"))
            printed = staged(of_text.join(texts, "text_key").select("bits", "node").distinct(), "printed")
            first = staged(printed.groupBy("bits").agg(F.min("node").alias("first")), "first")
            either = near.union(near.select("high", "low"))
            smallest = either.groupBy("low").agg(F.min("high").alias("high"))
            same = printed.join(first, "bits").where("first <> node").select(F.col("first").alias("low"), F.col("node").alias("high"))
            finds = [lambda rows: untied(same.union(print_pairs(first, smallest)), rows), lambda rows: untied(print_pairs(first, near), rows), *finds]
        rows, links, tied = nodes.withColumn("component", F.col("node")), None, None

        def link(find) -> Callable[[DataFrame], DataFrame]:
            return lambda rows: confirmed(staged(alike(find(rows), nodes, percent), "pairs"), nodes, docs, shingle, percent)

        for find in [*map(link, finds), lambda rows: crowded_links(rows, docs, shingle, window, percent)]:
            with intermediate(spark) as keep_found:
                found = find(rows)
                if found is None:
                    continue
                found = keep_found(found, "links")
            links = found if links is None else links.union(found)
            tied = components(links)
            rows = nodes.join(tied, "node", "left").withColumn("component", F.coalesce("component", "node"))
        named = keep(rows.select("node", "least", F.col("component").alias("group")), "groups")
        return keep(signed.select("doc_id", "text_key", "node", "n_shingles"), "documents"), named


def near_copies(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """`(doc_id, n_shingles, component_id, kept)` per row of `docs`.

    Rows are linked if the sets of their word shingles have a Jaccard similarity of `percent` hundredths and more; component_id
    is the smallest doc_id that can be reached. Rows with equal sets, exact copies and repeated rows among them, are one node of
    the search. Null and empty texts, and those without words, have no shingles and are linked with nothing: their
    component is their own id. A null doc_id is never the smallest unless all are null. `kept` is whether the row's id is its component,
    so rows that share an id are kept together, and a group of null ids is kept. Other columns are not looked at; no rows give no rows.
    """
    signed, named = groups(docs, shingle, percent)
    smallest = named.groupBy("group").agg(F.min("least.doc_id").alias("smallest"))
    # A node may hold a third of all rows: a join whose large partitions Spark can split.
    linked = signed.join(named.join(smallest, "group").select("node", "smallest"), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return linked.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def representatives(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, close: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """One row of each group of near copies, with all its columns, chosen like those of `simhash.representatives`; here all
    rows without words are one group as well. `close` as in `groups`."""
    return first_rows(docs, groups(docs, shingle, percent, link_empty=True, close=close)[1])
