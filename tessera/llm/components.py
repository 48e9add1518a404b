"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written


def _star(edges: DataFrame, u: str, v: str) -> DataFrame:
    """Each u's neighbours v, with the least of them and of u as ``m``."""
    least = edges.groupBy(u).agg(F.min(v).alias("m")).withColumn("m", F.least("m", u))
    return edges.join(least, u)


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").select("a", "b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long); root: the
    smallest node reachable.

    Large-star and small-star rounds (Kiveris et al., 2014) until nothing
    changes. A node's minimum is pre-aggregated before the shuffle and joined
    back: no group collects a hub's edges, and its rows in the join are split by
    adaptive execution (skewed joins). Every round is written to
    the shared folder; no list of edges or nodes reaches the driver.
    """
    edges = written(_distinct(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _distinct(_star(both, "a", "b").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        small = _star(large, "a", "b")
        small = small.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        edges = written(_distinct(small), "edges")
        last, state = state, _state(edges)
        if state == last:
            break
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.unionByName(edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root")))
