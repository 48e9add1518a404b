"""The whole path from questions to audited answers, and the rebuild order."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schemas
from tessera.functions.text import CITATION
from tessera.operators import answering, chunking, evaluation, facts, graph, indexing, lexical, retrieval
from tessera.operators.lexical import Index
from tessera.session import Options
from tessera.sources import store

_CITED = "array<struct<file:string,line:int>>"


def search(questions: DataFrame, index: Index, options: Options = Options(), embedder: Callable | None = None, reranker: Callable | None = None) -> tuple[DataFrame, DataFrame]:
    """(hits that pass the gate, routes) of a batch of questions: routed
    lexical search, fused with dense search in the same domains if
    ``options.dense``, reranked and gated if ``options.rerank``."""
    routes = retrieval.route(questions, index, options.routed_domains)
    top = retrieval.bm25_topk(questions, index, options.top_k, routes, k1=options.k1, b=options.b)
    if options.dense:
        if index.vectors is None:
            raise ValueError("the index has no vectors")
        asked = indexing.embed(questions.select(F.col("item_id").alias("doc_id"), "text"), embedder, id_col="doc_id").select("doc_id", "embedding")
        near = retrieval.dense_topk(asked, index.vectors, options.top_k, "doc_id", routes=routes)
        fused = retrieval.rrf([top, near.select("qid", "doc_id", "rk")], options.top_k)
        # A document that only its vector found has no word of the question.
        top = fused.join(top.select("qid", "doc_id", "coverage"), ["qid", "doc_id"], "left").withColumn("coverage", F.coalesce("coverage", F.lit(0.0)))
    if options.rerank:
        top = retrieval.gate(retrieval.rerank(top, questions, index.texts, reranker), options.rerank_min)
    return top, routes


def ask(questions: DataFrame, corpus: DataFrame | Index, options: Options = Options(), facts_named: DataFrame | None = None, model: Callable | None = None, *, embedder: Callable | None = None, reranker: Callable | None = None, judge: Callable | None = None) -> DataFrame:
    """(qid, answer, mode, citations, struck, routed) for a batch of questions:
    look up facts, route, retrieve, rerank, gate, ground, generate, audit.

    questions (item_id, text). corpus: a stored index, or documents (doc_id,
    source, text), which are then indexed for this call alone. facts_named
    (name, answer, file, line, and kind if there are several): exact facts; a
    question that names one is answered from it and not searched. A question
    without a surviving text, or of whose answer no sentence survives the
    audit, is refused. Each hook is a function over pandas frames; see
    ``generate``, ``embed``, ``rerank`` and ``semantic_audit``.
    """
    options.checked(model, judge, embedder)
    spark = questions.sparkSession
    index = corpus if isinstance(corpus, Index) else lexical.write(corpus, store.work_folder(spark))
    direct, rest = None, questions
    if facts_named is not None:
        best = store.written(facts.direct_answers(questions, facts_named))
        direct = best.select(F.col("item_id").alias("qid"), "answer", F.lit("direct").alias("mode"), F.when(F.col("file").isNull(), F.array().cast(_CITED)).otherwise(F.array(F.struct("file", F.col("line").cast("int").alias("line")))).alias("citations"), F.array().cast("array<string>").alias("struck"))
        _, rest = facts.split_direct(questions, best)
    top, routes = search(rest, index, options, embedder, reranker)
    # Two small tables that everything below reads more than once.
    routes = store.written(routes)
    found = store.written(answering.evidence(top, rest, index, options.evidence))
    audited = answering.audit(answering.generate(answering.grounded(found), model), found)
    if options.semantic_audit:
        audited = answering.semantic_audit(audited, found, judge, options.semantic_min)
    done = answering.closed(audited)
    kind = "llm" if model else "extractive"
    pairs = F.zip_with(F.regexp_extract_all("answer", F.lit(CITATION), 1), F.regexp_extract_all("answer", F.lit(CITATION), 2), lambda f, l: F.struct(f.alias("file"), l.cast("int").alias("line")))
    done = done.select("qid", "answer", F.when(F.col("answer") == answering.REFUSAL, "refused").otherwise(kind).alias("mode"), pairs.alias("citations"), "struck")
    none = answering.refused(rest, found).select("qid", "answer", F.lit("refused").alias("mode"), F.array().cast(_CITED).alias("citations"), F.array().cast("array<string>").alias("struck"))
    out = done.unionByName(none)
    if direct is not None:
        out = out.unionByName(direct)
    routed = routes.groupBy("qid").agg(F.sort_array(F.collect_set("domain")).alias("routed"))
    return out.join(routed, "qid", "left").withColumn("routed", F.coalesce("routed", F.array().cast("array<string>")))


class Service:
    """A corpus' tables, opened once and asked many times."""

    def __init__(self, spark: SparkSession, folder: str, options: Options = Options(), **hooks: Callable):
        self.spark, self.options, self.hooks = spark, options, hooks
        self.index = open_index(spark, folder, options)
        self.facts = spark.read.parquet(f"{folder}/facts")

    def ask(self, questions: list[str]) -> list[dict]:
        """Answer records, in the order of the questions."""
        rows = self.spark.createDataFrame(list(enumerate(questions)), "item_id int, text string")
        found = {r["qid"]: r.asDict(True) for r in ask(rows, self.index, self.options, self.facts, **self.hooks).collect()}
        return [{k: v for k, v in found[i].items() if k != "qid"} for i in range(len(questions))]

    def serve(self):
        """An HTTP server on ``options.port`` (0: any) that answers a JSON body
        {"q": question} with its record; run ``serve_forever`` on it."""
        import json
        from http.server import BaseHTTPRequestHandler, HTTPServer

        service = self

        class Handler(BaseHTTPRequestHandler):
            def do_POST(self):
                try:
                    question = json.loads(self.rfile.read(int(self.headers.get("Content-Length") or 0)))["q"]
                    code, body = 200, service.ask([str(question)])[0]
                except (ValueError, KeyError, TypeError):
                    code, body = 400, {"error": 'expected {"q": question}'}
                raw = json.dumps(body).encode()
                self.send_response(code)
                self.send_header("Content-Type", "application/json")
                self.send_header("Content-Length", str(len(raw)))
                self.end_headers()
                self.wfile.write(raw)

            def log_message(self, *args):
                pass

        return HTTPServer(("127.0.0.1", self.options.port), Handler)


# ------------------------------------------------------------------ rebuild


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def ingest(spark: SparkSession, root: str, snapshot: str, folder: str) -> None:
    """Files, symbols, calls, parameters and messages of a pinned corpus, and
    from them the exact facts; one path a table, so steps can run again in any
    order that their inputs allow. Every table carries the snapshot."""
    files = store.read_corpus(spark, root, snapshot, {"*.cpp": "code", "*.h": "code", "*.md": "wiki", "*.rst": "wiki", "*.uavcan": "dsdl"})
    files = _stored(files, f"{folder}/files")
    stamp = F.lit(snapshot).alias("snapshot")
    code = files.where("kind = 'code'")
    symbols = _stored(facts.extract_symbols(code).select(stamp, "*"), f"{folder}/symbols")
    calls = _stored(facts.extract_calls(code, symbols).select(stamp, "*"), f"{folder}/calls")
    # A leaf's group is its file's class, if it has exactly one.
    groups = symbols.where("kind = 'class'").select("path", F.concat("name", F.lit("_")).alias("group")).distinct()
    leaves = facts.extract_params(code).withColumn("leaf", F.element_at(F.split("leaf", r"\s+"), 1))
    full = facts.qualify(leaves, groups, ["path"], "group", "leaf")
    plain = leaves.join(full.select("path", "leaf"), ["path", "leaf"], "left_anti").withColumn("full_name", F.col("leaf"))
    params = _stored(full.drop("group").unionByName(plain).select(stamp, "*"), f"{folder}/params")
    parsed = facts.parse_dsdl(files.where("kind = 'dsdl'")).where("msg_id is not null")
    if store.exists(spark, root, "*.xml"):
        # Definitions in XML come first; others add what they lack.
        xml = facts.extract_messages(spark, root)
        parsed = facts.augment(xml, parsed, ["name"]).drop("origin")
    messages = _stored(parsed.select(stamp, "*"), f"{folder}/messages")
    facts.named_facts(params, symbols, messages, calls).write.mode("overwrite").parquet(f"{folder}/facts")
    _stored(graph.degrees(calls.select("src", "dst").distinct()), f"{folder}/degrees")


def build_index(spark: SparkSession, folder: str, model: Callable | None = None, options: Options = Options()) -> None:
    """Chunks of code and sections; their postings; and vectors, by domain, of
    those not yet embedded."""
    files, symbols = spark.read.parquet(f"{folder}/files"), spark.read.parquet(f"{folder}/symbols")
    code = chunking.code_chunks(files.where("kind = 'code'"), symbols).select(F.lit("code").alias("source_kind"), F.col("path").alias("file"), "line_start", "line_end", "text")
    wiki = chunking.section_chunks(files.where("kind = 'wiki'"), "path", "content").select(F.lit("wiki").alias("source_kind"), F.col("path").alias("file"), "line_start", "line_end", "text")
    chunks = code.unionByName(wiki).withColumn("domain", F.element_at(F.split("file", "/"), -2))
    chunks = chunks.withColumn("chunk_id", F.sha2(F.concat_ws("\n", "file", F.col("line_start").cast("string"), "text"), 256))
    store.write_chunks(chunks.select("chunk_id", "domain", "source_kind", "file", "line_start", "line_end", "text"), f"{folder}/chunks")
    chunks = store.read_chunks(spark, f"{folder}/chunks").dropDuplicates(["chunk_id"])
    lexical.write(chunks, f"{folder}/lexical", "chunk_id", "domain")
    path, name = f"{folder}/vectors", options.embed_model or "hashed words"
    done = spark.read.schema(schemas.VECTORS).parquet(path).where(F.col("model") == name) if store.exists(spark, path) else None
    new = indexing.pending(chunks, done, "chunk_id") if done is not None else chunks
    made = indexing.embed(new.select("chunk_id", "text"), model).select("chunk_id", F.lit(name).alias("model"), "embedding")
    made.write.mode("append").parquet(path)
    vectors = spark.read.schema(schemas.VECTORS).parquet(path).where(F.col("model") == name).dropDuplicates(["chunk_id"])
    # Vectors of chunks that are gone stay in the store, but not in the index.
    store.write_by_domain(indexing.with_domain(vectors, chunks.select("chunk_id", "domain"), "chunk_id"), f"{folder}/vectors_by_domain")


def open_index(spark: SparkSession, folder: str, options: Options = Options()) -> Index:
    """The stored index. Vectors must carry the model's name that is asked for."""
    index = lexical.read(spark, f"{folder}/lexical")
    vectors = spark.read.parquet(f"{folder}/vectors_by_domain").withColumnRenamed("chunk_id", "doc_id").withColumn("domain", F.col("domain").cast("string"))
    name = options.embed_model or "hashed words"
    if options.dense and vectors.where(F.col("model") != name).take(1):
        raise ValueError(f"the index was not embedded by {name}")
    return replace(index, vectors=vectors.select("doc_id", "domain", "embedding"))


def build_all(spark: SparkSession, root: str, snapshot: str, folder: str, model: Callable | None = None, options: Options = Options(), manifest: str | None = None) -> None:
    """The rebuild in order: files, facts, chunks, postings, vectors, and the
    text table rewritten in files of bounded size. With a manifest, snapshot is
    the corpus' name in it."""
    ingest(spark, root, store.snapshot_of(spark, manifest, snapshot) if manifest else snapshot, folder)
    build_index(spark, folder, model, options)
    store.repack(spark, f"{folder}/lexical/texts", f"{folder}/texts_repacked")


def build_gold(questions: DataFrame, docs: DataFrame) -> DataFrame:
    """(qid, split, doc_id or null) from containment."""
    return evaluation.split(questions).join(evaluation.gold_pairs(questions, docs), "qid", "left")


def evaluate(questions: DataFrame, docs: DataFrame, options: Options = Options(), index: Index | None = None, reranker: Callable | None = None) -> DataFrame:
    """Accuracy by type of question and in total."""
    index = index or lexical.of(docs)
    top = retrieval.bm25_topk(questions, index, options.top_k, k1=options.k1, b=options.b)
    kept = retrieval.gate(retrieval.rerank(top, questions, index.texts, reranker), options.rerank_min)
    return evaluation.accuracy(evaluation.outcomes(questions, evaluation.gold_pairs(questions, index), top, kept))
