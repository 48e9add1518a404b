"""SimHash fingerprints and near-duplicate groups by pivot distance tables.

Each fingerprint's Hamming distances to ``PIVOTS`` reference fingerprints form
its row of the pivot table. By the triangle inequality two fingerprints within
``r`` bits differ by at most ``r`` in every coordinate, so a pair whose largest
coordinate difference exceeds ``r`` is discarded without comparing the
fingerprints; survivors are verified on all 64 bits.

Which pairs meet at all: fingerprints are dealt to shards by the content of
two of five bit blocks. Three differing bits leave two blocks alike, so each
pair to be linked meets in one of the ten shards of each. A shard with more
than ``SHARD`` fingerprints is cut into chunks, and each pair of chunks is a
cell of its own; a cell's rows are sorted by the first pivot distance, and only
neighbours within ``r`` in it become candidates. A cell gives the spanning
forest of its links, never all of its pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded, shingle_hashes, table, written
from tessera.llm.components import components

#: Fingerprints link at this many differing bits or fewer.
RADIUS = 3
SHINGLE = 3
SEED = 42
PIVOTS = 24
#: Fingerprints of a shard that are compared in one cell, about.
SHARD = 4096
#: Candidate pairs that are filtered at once.
PAIRS = 1 << 20
#: Bit widths of the five blocks.
BLOCKS = (13, 13, 13, 13, 12)


def reference_fingerprints(n: int = PIVOTS) -> np.ndarray:
    """The first n outputs of SplitMix64 from seed 42."""
    out, state, mask = [], 42, (1 << 64) - 1
    for _ in range(n):
        state = (state + 0x9E3779B97F4A7C15) & mask
        z = ((state ^ state >> 30) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ z >> 27) * 0x94D049BB133111EB) & mask
        out.append(z ^ z >> 31)
    return np.array(out, np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text's word shingles, repeats included; no word: 0."""
    ones, n = np.zeros(64, np.int64), 0
    for part in shingle_hashes(text, shingle, SEED):
        for at in range(0, len(part), 1 << 16):
            hashes = np.array(part[at : at + (1 << 16)], "<u8")
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp long) of every row."""

    def run(batches):
        for part in bounded(batches, 1):
            fps = np.array([fingerprint(t, shingle) for t in part.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, fp long")


def _blocks() -> list[int]:
    at, blocks = 0, []
    for width in BLOCKS:
        blocks.append(((1 << width) - 1) << at)
        at += width
    return blocks


def _masks() -> list[int]:
    return [a | b for a, b in combinations(_blocks(), 2)]


def _finer(mask: int) -> list[int]:
    """Masks of the blocks outside ``mask``, each without one of its bits.

    Two fingerprints that agree on ``mask`` and differ in at most three bits
    differ in at most one bit of one of the three other blocks, so they agree
    on that block without this bit."""
    return [block ^ 1 << bit for block in _blocks() if not block & mask for bit in range(64) if block >> bit & 1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def cells(fps: DataFrame, shard: int = SHARD) -> DataFrame:
    """(cell, fp): the cells in which each distinct fingerprint is compared.

    A shard with too many fingerprints is dealt again, by what they have in
    common in a third block but for one bit; only those of them that are still
    too large, fingerprints alike in 38 bits, are cut into chunks, each pair of
    which is a cell."""
    keys = F.array(*(F.struct(F.lit(k).alias("pair"), F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(_signed(m)))).alias("key")) for k, m in enumerate(_masks())))
    dealt = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.pair", "k.key")
    large = dealt.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > shard).select(F.col("key").alias("hot"))
    marked = dealt.join(large, dealt.key == large.hot, "left")
    finer = F.element_at(F.array(*(F.array(*(F.lit(_signed(x)) for x in _finer(m))) for m in _masks())), F.col("pair") + 1)
    again = marked.where("hot is not null").select("fp", "key", F.posexplode(finer).alias("k", "mask"))
    again = again.select("fp", F.xxhash64("key", "k", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"))
    sizes = again.groupBy("key").agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") > shard)
    parts = F.ceil(F.coalesce("n", F.lit(1)) / F.lit(shard / 2)).cast("int")
    cut = again.join(sizes.where("n > 1").select("key"), "key", "left_semi").join(large, "key", "left").withColumn("parts", F.when(F.col("n").isNull(), 1).otherwise(parts))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("fp", F.lit("chunk")), F.col("parts")).cast("int"))
    cut = cut.select("fp", "key", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    cut = cut.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "fp")
    return marked.where("hot is null").select(F.col("key").alias("cell"), "fp").unionByName(cut)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node of each of n nodes' component under the links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            return root


def linked(cell: np.ndarray, fp: np.ndarray, radius: int = RADIUS, pivots: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links (fp, least fp of its component) inside each cell.

    cell must be grouped (equal cells side by side), fp unsigned and distinct
    within a cell; repeats link to one another and are dropped.
    """
    pivots = reference_fingerprints() if pivots is None else pivots
    run = np.cumsum(np.r_[0, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
    first = np.bitwise_count(fp ^ pivots[0]).astype(np.int64)
    order = np.lexsort((fp, first, run))
    fp, place = fp[order], run[order] * 256 + first[order]
    coords = np.stack([np.bitwise_count(fp ^ p) for p in pivots], axis=1).astype(np.int8)
    until = np.searchsorted(place, place + radius, "right")
    width = until - np.arange(len(fp)) - 1
    a_all, b_all, sums = [], [], np.cumsum(width)
    at = 0
    while at < len(fp):
        to = max(at + 1, int(np.searchsorted(sums, (sums[at - 1] if at else 0) + PAIRS, "right")))
        w = width[at:to]
        a = np.repeat(np.arange(at, to), w)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(w) - w, w)
        for k in range(1, coords.shape[1]):
            near = np.abs(coords[a, k] - coords[b, k]) <= radius
            a, b = a[near], b[near]
        same = np.bitwise_count(fp[a] ^ fp[b]) <= radius
        a_all.append(a[same])
        b_all.append(b[same])
        at = to
    if not a_all or not any(map(len, a_all)):
        return fp[:0], fp[:0]
    a, b = np.concatenate(a_all), np.concatenate(b_all)
    root = forest(a, b, len(fp))
    child = np.flatnonzero(root != np.arange(len(fp)))
    return fp[child], fp[root[child]]


def links(celled: DataFrame, radius: int = RADIUS, n_pivots: int = PIVOTS) -> DataFrame:
    """Links (a long, b long) of all cells, each cell's as a spanning forest."""

    def run(batches):
        pivots = reference_fingerprints(n_pivots)
        cell, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def out(c, f):
            a, b = linked(c, f, radius, pivots)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], ["a", "b"])

        for batch in batches:
            cell = np.r_[cell, batch.column(0).to_numpy()]
            fp = np.r_[fp, batch.column(1).to_numpy().view(np.uint64)]
            if len(cell) >= 1 << 16:
                cut = int(np.searchsorted(cell, cell[-1], "left"))  # the last cell may go on
                if cut:
                    yield out(cell[:cut], fp[:cut])
                    cell, fp = cell[cut:], fp[cut:]
        if len(cell):
            yield out(cell, fp)

    return celled.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE, radius: int = RADIUS, n_pivots: int = PIVOTS, shard: int = SHARD) -> DataFrame:
    """Each row's id, ``fp`` (long) and ``component_id``, the smallest id of
    all rows that chains of links reach, itself included.

    Links are pairs of fingerprints at ``radius`` (3 at most) or fewer
    differing bits. Null and empty texts have fingerprint 0 and link like any
    other. Repeated rows stay, each with the same component. Null ids stay and
    are never a component's smallest id, unless all of its ids are null. Other
    columns of ``docs`` are not read.
    """
    if radius > RADIUS:
        raise ValueError("the shards are complete up to three differing bits")
    marked = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    least = written(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = components(links(cells(least.select("fp"), shard), radius, n_pivots))
    rooted = least.join(roots, least.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    own = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(own, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op9_simhash_groups": op9_simhash_groups}
ORACLES: dict[str, str] = {}
