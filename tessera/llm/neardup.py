"""Near-duplicate groups by the exact Jaccard similarity of word shingles.

Texts link when at least 4/5 of the distinct five-word shingles that either has
are shared. MinHash bands only say which texts meet: 32 bands of five minima
miss a pair at similarity 0.8 with probability 3e-6, and a closer one with
less. Texts that chains of shared bands reach form a cluster; inside it every
pair is counted exactly, whatever bands it shares. A cluster with more than
``CELL`` texts is cut into chunks, and each pair of chunks is a cell of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded, shingle_hashes, written
from tessera.llm.components import components
from tessera.llm.simhash import forest

SHINGLE = 5
#: Texts link at this similarity or more (numerator, denominator).
SIMILARITY = (4, 5)
BANDS = 32
ROWS = 5
SEED = 42
#: Texts of a cluster that are compared in one cell, about.
CELL = 256
#: Shingles that are permuted at once.
PERMUTED = 4096

_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64) | np.uint64(1)


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of a text's distinct word shingles. Fewer words than a
    shingle are one shingle; no word: none."""
    parts = [np.unique(np.array(part, np.uint64)) for part in shingle_hashes(text, shingle, SEED)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """A hash of each band's minima; none for no shingle."""
    if not len(shingles):
        return np.zeros(0, np.uint64)
    low = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), PERMUTED):
        np.minimum(low, (_FACTORS * shingles[at : at + PERMUTED]).min(axis=1), out=low)
    return np.array([xxhash.xxh64_intdigest(x.tobytes(), k) for k, x in enumerate(low.reshape(BANDS, ROWS))], np.uint64)


def node_of(shingles: np.ndarray) -> int:
    """Texts with equal shingles are one node, a signed hash of them all."""
    return int(np.array(xxhash.xxh64_intdigest(shingles.tobytes(), SEED), np.uint64).view(np.int64))


def linked(sets: list[np.ndarray], part: np.ndarray) -> np.ndarray:
    """The least index of each set's component. With two parts, only sets of
    different parts are compared: the others meet in a cell of their own."""
    n, (over, under) = len(sets), SIMILARITY
    sizes = np.array([len(s) for s in sets], np.int64)
    every, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    across = len(np.unique(part)) > 1
    root = np.arange(n)
    for i in range(n):
        left, right = np.searchsorted(every, sets[i], "left"), np.searchsorted(every, sets[i], "right")
        width = right - left
        at = np.repeat(left - np.cumsum(width) + width, width) + np.arange(width.sum())
        shared = np.bincount(owner[at], minlength=n)
        near = shared * under >= (sizes + sizes[i] - shared) * over
        near &= (part != part[i]) if across else True
        b = np.flatnonzero(near)
        if (root[b] != root[i]).any():
            root = forest(np.r_[np.arange(n), np.full(len(b), i)], np.r_[root, b], n)
        if not root.any():
            break
    return root


def links(celled: DataFrame) -> DataFrame:
    """Links (a long, b long) of all cells, each cell's as a spanning forest."""

    def run(batches):
        cell, nodes, parts, sets = None, [], [], []

        def out():
            root = linked(sets, np.array(parts)) if len(sets) > 1 else np.zeros(len(sets), np.int64)
            node = np.array(nodes, np.int64)
            child = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([pa.array(node[child]), pa.array(node[root[child]])], ["a", "b"])

        for batch in batches:
            for c, node, part, raw in zip(*(column.to_pylist() for column in batch.columns)):
                if c != cell:
                    if sets:
                        yield out()
                    cell, nodes, parts, sets = c, [], [], []
                nodes.append(node)
                parts.append(part)
                sets.append(np.frombuffer(raw, np.uint64))
        if sets:
            yield out()

    return celled.select("cell", "node", "own", "shingles").repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long")


def cells(clustered: DataFrame, cell: int = CELL) -> DataFrame:
    """(cell, node, own, shingles): the cells in which each node is compared,
    and its chunk, of (root, node, shingles)."""
    large = clustered.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > cell)
    parts = F.ceil(F.coalesce("n", F.lit(1)) / F.lit(cell / 2)).cast("int")
    cut = clustered.join(large, "root", "left").withColumn("parts", F.when(F.col("n").isNull(), 1).otherwise(parts))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("node", F.lit("chunk")), F.col("parts")).cast("int"))
    cut = cut.select("root", "node", "shingles", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    return cut.select(F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "node", "own", "shingles")


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, seen, node, bands) of every row; seen: hash of the text."""

    def run(batches):
        for part in bounded(batches, 2):
            sets = [shingle_set(t) for t in part.column(2).to_pylist()]
            keys = [band_keys(s) for s in sets]
            flat = pa.array(np.concatenate(keys).view(np.int64))
            bands = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, keys)]), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([node_of(s) for s in sets], pa.int64()), bands], ["id", "seen", "node", "bands"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("seen"), text.alias("text")).mapInArrow(run, f"id {kind}, seen long, node long, bands array<long>")


def _shingles(texts: DataFrame) -> DataFrame:
    """(node, shingles binary) of each text, once a node."""

    def run(batches):
        for part in bounded(batches, 0):
            sets = [shingle_set(t) for t in part.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])

    return texts.mapInArrow(run, "node long, shingles binary").groupBy("node").agg(F.first("shingles").alias("shingles"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, cell: int = CELL) -> DataFrame:
    """Each row's id and ``component_id``, the smallest id of all rows that
    chains of links reach, itself included.

    Null, empty and blank texts have no shingle and link to one another only.
    Repeated rows stay, each with the same component. Null ids stay and are
    never a component's smallest id, unless all of its ids are null. Other
    columns of ``docs`` are not read.
    """
    marked = written(_marked(docs, id_col, text_col), "shingled")
    nodes = written(marked.groupBy("node").agg(F.min("id").alias("least"), F.min("seen").alias("seen"), F.first("bands").alias("bands")), "nodes")
    dealt = nodes.select("node", F.explode("bands").alias("key"))
    met = dealt.groupBy("key").agg(F.min("node").alias("m"), F.count("*").alias("n")).where("n > 1")
    clusters = components(dealt.join(met, "key").where("node != m").select(F.col("node").alias("a"), F.col("m").alias("b")))
    clustered = written(clusters.join(nodes.select("node", "seen"), "node"), "clusters")
    texts = docs.select(F.col(text_col).cast("string").alias("text")).join(clustered.select("seen"), F.xxhash64("text") == F.col("seen"), "left_semi")
    found = links(cells(clustered.select("root", "node").join(_shingles(texts), "node"), cell))
    roots = components(found)
    rooted = nodes.select("node", "least").join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    own = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("node", "root").join(own, "root").select("node", "component_id")
    return marked.join(named, "node").select(F.col("id").alias(id_col), "component_id")
