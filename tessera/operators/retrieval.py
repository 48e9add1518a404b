"""Lexical and dense retrieval, routing, fusion, reranking and the gate.

Scores are rounded to six decimals before ranking, ties go to the smaller id,
so that plans with other orders of addition rank alike.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.lexical import Index, idf, met, opened, totals

K1, B = 1.5, 0.75
#: Query vectors in one broadcast, about.
QUERY_BLOCK = 2048
#: Share of the cells that an approximate search looks into.
PROBES = 0.5


def ranked(df: DataFrame, by: str, score: str, tie: str, k: int | None, rank: str = "rk") -> DataFrame:
    out = df.withColumn(rank, F.row_number().over(Window.partitionBy(by).orderBy(F.col(score).desc(), F.col(tie).asc())))
    return out.where(F.col(rank) <= k) if k else out


def bm25_scores(questions: DataFrame, corpus: DataFrame | Index, routes: DataFrame | None = None, *, k1: float = K1, b: float = B, qid: str = "item_id") -> DataFrame:
    """(qid, doc_id, score, coverage) of all documents that share a word with a
    question; coverage: the share of its distinct words that the document has.

    routes (qid, domain) restrict what is scored, not the statistics, so scores
    stay comparable: a posting carries its domain, and no list of candidate
    documents is made. Documents without an id count in the statistics only:
    nothing can cite them.
    """
    index = opened(corpus)
    hit = met(questions, index, qid).where(F.col("doc_id").isNotNull())
    if routes is not None:
        hit = hit.join(routes.select("qid", "domain"), ["qid", "domain"], "left_semi")
    hit = hit.crossJoin(F.broadcast(totals(index)))  # one row
    norm = k1 * (1 - b + b * F.col("dl") / F.col("avgdl"))
    part = idf(F.col("df"), F.col("n_docs")) * F.col("tf") * (k1 + 1) / (F.col("tf") + norm)
    share = F.round(F.count("*") / F.first("asked"), 6)
    return hit.groupBy("qid", "doc_id").agg(F.round(F.sum(part), 6).alias("score"), share.alias("coverage"))


def bm25_topk(questions: DataFrame, corpus: DataFrame | Index, k: int = 10, routes: DataFrame | None = None, **options) -> DataFrame:
    """(qid, doc_id, score, coverage, rk)."""
    return ranked(bm25_scores(questions, corpus, routes, **options), "qid", "score", "doc_id", k)


def route(questions: DataFrame, corpus: DataFrame | Index, domains: int = 3, qid: str = "item_id") -> DataFrame:
    """(qid, domain, score, rk): the domains whose words carry most of the
    question's idf. A domain has as many idf as question words it knows, each
    weighted by the share of its documents that have the word."""
    index = opened(corpus)
    per = met(questions, index, qid).groupBy("qid", "domain", "term").agg(F.count("*").alias("n"), F.first("df").alias("df"))
    hit = per.join(index.sizes.select("domain", "docs"), "domain").crossJoin(F.broadcast(totals(index)))
    score = F.round(F.sum(idf(F.col("df"), F.col("n_docs")) * F.col("n") / F.col("docs")), 6)
    return ranked(hit.groupBy("qid", "domain").agg(score.alias("score")), "qid", "score", "domain", domains)


def _nearest(vectors: DataFrame, queries: DataFrame, k: int, id_col: str) -> DataFrame:
    """(qid, id, score): each task's k best for each query of one block.

    queries (qid, q, groups: null, or the groups that the query may see);
    vectors (id, v, group). Rows are taken group by group, so only allowed
    pairs are multiplied: one matrix product for each group of a batch.
    """
    rows = queries.collect()
    ids, matrix = [r["qid"] for r in rows], np.array([r["q"] for r in rows], np.float64)
    sees: dict = {}
    for i, r in enumerate(rows):
        for g in r["groups"] if r["groups"] is not None else [None]:
            sees.setdefault(g, []).append(i)
    shared = vectors.sparkSession.sparkContext.broadcast((ids, matrix, sees))
    kinds = [queries.schema["qid"].dataType.simpleString(), vectors.schema["id"].dataType.simpleString()]

    def run(batches):
        ids, matrix, sees = shared.value
        best: list[list] = [[] for _ in ids]
        for batch in batches:
            names, flat = batch.column(0).to_pylist(), batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            group = np.array(batch.column(2).to_pylist() + [None], object)[:-1]
            for g in set(group.tolist()):
                own, at = sees.get(g, []), np.flatnonzero(group == g)
                for lo in range(0, len(own), 256):
                    some = own[lo : lo + 256]
                    score = np.round(matrix[some] @ flat[at].T.astype(np.float64), 6)
                    cut = np.partition(score, max(0, len(at) - k), axis=1)[:, max(0, len(at) - k)]
                    for i, row, least in zip(some, score, cut):
                        if len(best[i]) == k:
                            least = max(least, -best[i][-1][0])
                        new = np.flatnonzero(row >= least)
                        best[i] = sorted(best[i] + [(-float(row[j]), names[at[j]]) for j in new])[:k]
        out = [(i, name, -score) for i, found in enumerate(best) for score, name in found]
        cols = [pa.array([ids[r[0]] for r in out]), pa.array([r[1] for r in out]), pa.array([r[2] for r in out], pa.float64())]
        if out:
            yield pa.RecordBatch.from_arrays(cols, ["qid", id_col, "score"])

    return vectors.mapInArrow(run, f"qid {kinds[0]}, `{id_col}` {kinds[1]}, score double")


def _in_blocks(q: DataFrame, v: DataFrame, k: int, id_col: str) -> DataFrame:
    blocks = max(1, -(-q.count() // QUERY_BLOCK))
    out = None
    for n in range(blocks):
        found = _nearest(v, q.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == n) if blocks > 1 else q, k, id_col)
        out = found if out is None else out.unionByName(found)
    return ranked(out, "qid", "score", id_col, k)


def dense_topk(queries: DataFrame, vectors: DataFrame, k: int = 10, id_col: str = "vec_id", vector: str = "embedding", routes: DataFrame | None = None, domain: str = "domain") -> DataFrame:
    """(qid, id, score, rk) by exact dot products, in double precision. The
    stated queries meet all vectors in blocks of about ``QUERY_BLOCK``, each
    small enough to broadcast; a task gives its k best for each query. routes
    (qid, domain) restrict what a query sees. Null vectors are passed over."""
    q = queries.where(F.col(vector).isNotNull()).select(F.col(id_col).alias("qid"), F.col(vector).alias("q"))
    group = F.lit(None).cast("string")
    if routes is None:
        q = q.withColumn("groups", F.lit(None).cast("array<string>"))
    else:
        group = F.col(domain).cast("string")
        q = q.join(routes.groupBy("qid").agg(F.collect_set(F.col("domain").cast("string")).alias("groups")), "qid")
    v = vectors.where(F.col(vector).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector).alias("v"), group.alias("group"))
    return _in_blocks(q, v, k, id_col)


def rrf(rankings: list[DataFrame], k: int = 10, constant: int = 60, item: str = "doc_id") -> DataFrame:
    """Reciprocal rank fusion of rankings (qid, item, rk)."""
    parts = rankings[0].select("qid", item, "rk")
    for r in rankings[1:]:
        parts = parts.unionByName(r.select("qid", item, "rk"))
    fused = parts.groupBy("qid", item).agg(F.round(F.sum(1 / (constant + F.col("rk"))), 9).alias("score"))
    return ranked(fused, "qid", "score", item, k)


def rerank(hits: DataFrame, questions: DataFrame, texts: DataFrame, model: Callable | None = None, qid: str = "item_id") -> DataFrame:
    """``hits`` with ``coverage`` replaced by a pair model's score: a function
    over pandas frames of (qid, doc_id, question, text) that gives (qid,
    doc_id, relevance), run in Arrow batches. Without a model, the share of the
    question's words stays, as a stand-in."""
    if model is None:
        return hits
    pairs = hits.select("qid", "doc_id").join(questions.select(F.col(qid).alias("qid"), F.col("text").alias("question")), "qid").join(texts.select("doc_id", "text"), "doc_id")
    kinds = {c: hits.schema[c].dataType.simpleString() for c in ("qid", "doc_id")}
    scored = pairs.select("qid", "doc_id", "question", "text").mapInPandas(model, f"qid {kinds['qid']}, doc_id {kinds['doc_id']}, relevance double")
    return hits.drop("coverage").join(scored, ["qid", "doc_id"]).withColumnRenamed("relevance", "coverage")


def gate(hits: DataFrame, least: float, score: str = "coverage") -> DataFrame:
    return hits.where(F.col(score) >= least)


def ivf_cells(vectors: DataFrame, cells: int | None = None, train_rows: int = 20_000, id_col: str = "vec_id", vector: str = "embedding", seed: int = 7):
    """(vectors with ``cell``, centres as rows): k-means on a sample of about
    ``train_rows`` vectors; every vector is indexed. The number of cells grows
    with the square root of the number of vectors, 16 to 4096."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    n = vectors.count()
    cells = cells or min(4096, max(16, int(n**0.5)))
    sample = vectors.sample(min(1.0, max(train_rows, 20 * cells) / max(n, 1)), seed=seed) if n > train_rows else vectors
    model = KMeans(k=cells, seed=seed, featuresCol="features").fit(sample.select(array_to_vector(F.col(vector)).alias("features")))
    marked = model.transform(vectors.select(id_col, vector, array_to_vector(F.col(vector)).alias("features"))).select(id_col, vector, F.col("prediction").alias("cell"))
    return marked, [[float(x) for x in c] for c in model.clusterCenters()]


def ann_topk(queries: DataFrame, marked: DataFrame, centres: list, k: int = 10, probes: float = PROBES, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Top k within the cells nearest to each query, as many as hold a share
    ``probes`` of all cells. Nothing is joined: a task multiplies its vectors
    with the queries that probe their cell, so a hot cell is spread like any."""
    c = np.array(centres)
    n = max(1, int(np.ceil(probes * len(c))))
    # Each query's nearest cells, by a matrix product in Arrow batches.
    def near(batches):
        for batch in batches:
            q = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float64)
            cells = np.argsort((c * c).sum(axis=1) - 2 * q @ c.T, axis=1, kind="stable")[:, :n]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([[str(x) for x in row] for row in cells.tolist()], pa.list_(pa.string()))], ["qid", "q", "groups"])

    kind = queries.schema[id_col].dataType.simpleString()
    q = queries.where(F.col(vector).isNotNull()).select(F.col(id_col).alias("qid"), F.col(vector).cast("array<double>").alias("q"))
    q = q.mapInArrow(near, f"qid {kind}, q array<double>, groups array<string>")
    v = marked.select(F.col(id_col).alias("id"), F.col(vector).alias("v"), F.col("cell").cast("string").alias("group"))
    return _in_blocks(q, v, k, id_col)
