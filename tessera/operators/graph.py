"""Edges and bounded reachability."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.store import written


def link_edges(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(src, dst, n): links of pages and how often each occurs."""
    found = pages.select(F.col(id_col).alias("src"), F.explode(F.regexp_extract_all(html_col, F.lit('href="([^"]*)"'), 1)).alias("dst"))
    return found.groupBy("src", "dst").agg(F.count("*").alias("n"))


def callers(edges: DataFrame, targets: DataFrame) -> DataFrame:
    """Edges into the nodes of ``targets`` (dst)."""
    return edges.join(targets, "dst", "left_semi")


def callees(edges: DataFrame, sources: DataFrame) -> DataFrame:
    return edges.join(sources, "src", "left_semi")


def degrees(edges: DataFrame) -> DataFrame:
    """(node, in_degree, out_degree); both ends are strings."""
    out = edges.select(F.col("src").cast("string").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o"))
    into = edges.select(F.col("dst").cast("string").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o"))
    return out.unionAll(into).groupBy("node").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))


def reach(edges: DataFrame, sources: DataFrame, depth: int) -> DataFrame:
    """(source, node, depth): nodes within ``depth`` steps and their distance.

    Breadth first: a level's frontier is joined to the edges, and what was
    reached before is taken out, so cycles end. The number of rounds is bounded
    by ``depth``, a small constant, and each is written to the shared folder.
    """
    seen = frontier = written(sources.select(F.col("node").alias("source"), "node", F.lit(0).alias("depth")))
    for step in range(1, depth + 1):
        found = frontier.join(edges, frontier.node == edges.src).select("source", F.col("dst").alias("node")).distinct()
        frontier = written(found.join(seen, ["source", "node"], "left_anti").withColumn("depth", F.lit(step)))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen


def cross_domain(edges: DataFrame, domains: DataFrame) -> DataFrame:
    """(src_domain, dst_domain, n): edges that leave their domain. domains: node,
    domain."""
    a = domains.select(F.col("node").alias("src"), F.col("domain").alias("src_domain"))
    b = domains.select(F.col("node").alias("dst"), F.col("domain").alias("dst_domain"))
    found = edges.join(a, "src").join(b, "dst").where("src_domain <> dst_domain")
    return found.groupBy("src_domain", "dst_domain").agg(F.count("*").alias("n"))
