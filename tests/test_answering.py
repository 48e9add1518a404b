import json
import threading
import urllib.request
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tessera.operators import answering, evaluation, facts, indexing, lexical, retrieval
from tessera.plans.pipeline import Service, ask, build_all, build_gold, evaluate, search
from tessera.session import Options


def evidence(spark):
    return spark.createDataFrame([(1, 1, "a.cpp", 10, "The delay is 250 ms by default"), (1, 2, "b.cpp", 3, "No numbers here")], "qid long, rk int, file string, line int, text string")


def audited(spark, answer):
    found = answering.audit(spark.createDataFrame([(1, answer)], "qid long, answer string"), evidence(spark))
    return {r.sentence: r for r in found.collect()}


def test_each_fault_is_struck(spark):
    rows = audited(spark, "The delay is 250 ms [a.cpp:10]. It is 999 ms [a.cpp:10]. See there [c.cpp:1]. It might be [a.cpp:10]. Nothing cited.")
    flags = {s[:12]: (r.uncited, r.bad_citation, r.speculation, r.bad_number, r.struck) for s, r in rows.items()}
    assert flags["The delay is"] == (False, False, False, False, False)
    assert flags["It is 999 ms"][3] and flags["See there [c"][1] and flags["It might be "][2] and flags["Nothing cite"][0]


def test_line_numbers_are_no_claims(spark):
    assert not next(iter(audited(spark, "The delay is set [a.cpp:10].").values())).struck


def test_audit_fails_closed_and_is_idempotent(spark):
    answers = spark.createDataFrame([(1, "It is 7 [a.cpp:10]. Perhaps."), (2, "Nothing.")], "qid long, answer string")
    closed = answering.closed(answering.audit(answers, evidence(spark)))
    assert {r.answer for r in closed.collect()} == {answering.REFUSAL}
    good = spark.createDataFrame([(1, "The delay is 250 ms [a.cpp:10]. Bad.")], "qid long, answer string")
    once = answering.closed(answering.audit(good, evidence(spark))).select("qid", "answer")
    twice = answering.closed(answering.audit(once, evidence(spark))).select("qid", "answer")
    assert once.collect() == twice.collect() and once.first().answer == "The delay is 250 ms [a.cpp:10]."


def corpus(spark):
    docs = spark.createDataFrame([(1, "x", "alpha beta gamma delta.\nother words stand here."), (2, "y", "alpha epsilon zeta.\nmore of it."), (3, "x", None)], "doc_id long, source string, text string")
    return docs, spark.createDataFrame([(10, "alpha beta gamma delta"), (11, "unknown thing")], "item_id long, text string")


def test_ask_answers_or_refuses(spark):
    docs, questions = corpus(spark)
    got = {r.qid: r for r in ask(questions, docs).collect()}
    assert got[10].mode == "extractive" and got[10].citations[0].file == "x/1" and got[10].citations[0].line == 1
    assert got[11].mode == "refused" and got[11].answer == answering.REFUSAL and got[11].routed == []


def test_direct_answers_are_not_searched(spark):
    docs, questions = corpus(spark)
    facts = spark.createDataFrame([("beta", "Beta is 4.", "p.cpp", 7)], "name string, answer string, file string, line int")
    got = {r.qid: r for r in ask(questions, docs, Options(), facts).collect()}
    assert got[10].mode == "direct" and got[10].answer == "Beta is 4." and got[10].citations[0].line == 7


def test_a_model_is_labelled_as_one(spark):
    docs, questions = corpus(spark)

    def model(frames):
        for f in frames:
            yield f[["qid"]].assign(answer=[f"It says so [{e[0]['file']}:{e[0]['line']}]." for e in f["evidence"]])

    got = {r.qid: r for r in ask(questions, docs, model=model).collect()}
    assert got[10].mode == "llm" and got[10].answer.startswith("It says so")


def test_routing_to_all_domains_changes_nothing(spark):
    docs, questions = corpus(spark)
    routes = retrieval.route(questions, docs, 2)
    routed = retrieval.bm25_topk(questions, docs, 10, routes)
    assert sorted(routed.collect()) == sorted(retrieval.bm25_topk(questions, docs, 10).collect())


def test_gold_needs_words_in_order(spark):
    docs, _ = corpus(spark)
    q = spark.createDataFrame([(1, "BETA  gamma"), (2, "gamma beta"), (3, None), (4, "")], "item_id long, text string")
    assert [tuple(r) for r in evaluation.gold_pairs(q, docs).collect()] == [(1, 1)]


def test_options_from_settings():
    o = Options.from_settings({"KB_RERANK": "0", "KB_RERANK_MIN": "0.5", "KB_PORT": "1"})
    assert not o.rerank and o.rerank_min == 0.5 and o.port == 1 and Options.from_settings({}) == Options()


def test_gold_and_evaluation(spark):
    docs, questions = corpus(spark)
    assert sorted((r.qid, r.split, r.doc_id) for r in build_gold(questions, docs).collect()) == [(10, "tunable", 1), (11, "heldout", None)]
    got = {r.type: (r.n, r.accuracy) for r in evaluate(questions, docs).collect()}
    assert got == {"all": (2, 1.0), "answerable": (1, 1.0), "unanswerable": (1, 1.0)}


def test_dense_search_in_blocks(spark, sf, monkeypatch):
    v = spark.read.parquet(f"{sf}/embeddings.parquet")
    q = v.where("vec_id % 50 = 0")
    whole = sorted(map(tuple, retrieval.dense_topk(q, v).collect()))
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 3)
    assert sorted(map(tuple, retrieval.dense_topk(q, v).collect())) == whole


REFERENCE_QUESTIONS = [
    (1, "What is the default and range of EK3_HGT_DELAY?"), (2, "who calls NavEKF3::healthy?"), (3, "What is the message ID of HEARTBEAT?"), (4, "Which file defines navekf3::HEALTHY"), (5, "What about ekf in general?"),
]


def exact_facts(spark):
    params = spark.createDataFrame([("a/p.cpp", "EK3_HGT_DELAY", "60", 0.0, 250.0, "ms")], "path string, full_name string, dflt string, lo double, hi double, units string")
    symbols = spark.createDataFrame([("a/ekf.cpp", "NavEKF3::healthy", "function", 4, 9)], "path string, name string, kind string, line_start int, line_end int")
    messages = spark.createDataFrame([("xml", 0, "HEARTBEAT")], "protocol string, msg_id int, name string")
    calls = spark.createDataFrame([("run", "NavEKF3::healthy", "a/main.cpp", 12), ("arm", "NavEKF3::healthy", "a/arm.cpp", 3)], "src string, dst string, file string, line int")
    return facts.named_facts(params, symbols, messages, calls)


def test_exact_facts_answer_names_in_any_spelling(spark):
    questions = spark.createDataFrame(REFERENCE_QUESTIONS, "item_id int, text string")
    got = {r.item_id: r.answer for r in facts.direct_answers(questions, exact_facts(spark)).collect()}
    assert got == {
        1: "EK3_HGT_DELAY: default 60; from 0.0; to 250.0; units ms", 2: "NavEKF3::healthy is called by arm, run", 3: "HEARTBEAT has id 0 in xml", 4: "NavEKF3::healthy is a function in a/ekf.cpp:4",
    }
    docs, _ = corpus(spark)
    modes = {r.qid: (r.mode, len(r.citations)) for r in ask(questions, docs, Options(), exact_facts(spark)).collect()}
    assert modes == {1: ("direct", 1), 2: ("direct", 1), 3: ("direct", 0), 4: ("direct", 1), 5: ("refused", 0)}


def test_every_option_changes_the_answer(spark):
    docs, questions = corpus(spark)
    index = lexical.of(docs)
    answers = lambda options=Options(), **hooks: {r.qid: (r.answer, r.mode, tuple(r.struck)) for r in ask(questions, index, options, **hooks).collect()}
    plain = answers()
    assert plain[11][1] == "refused"

    def judge(frames):
        for f in frames:
            assert (f["evidence"].str.len() > 0).all()
            yield f[["qid", "pos"]].assign(support=0.1)

    def reranker(frames):
        for f in frames:
            yield f[["qid", "doc_id"]].assign(relevance=(f["doc_id"] == 2).astype(float))

    struck = answers(Options(semantic_audit=True), judge=judge)
    assert struck[10][1] == "refused" and struck[10][2]
    assert answers(Options(semantic_audit=True, semantic_min=0.05), judge=judge) == plain
    assert "y/2" in answers(reranker=reranker)[10][0] and "x/1" in plain[10][0]
    assert answers(Options(rerank_min=1.1))[10][1] == "refused"
    assert "y/2" in answers(Options(rerank=False))[10][0]
    assert "y/2" not in answers(Options(rerank=False, evidence=1))[10][0]
    assert "y/2" not in answers(Options(rerank=False, top_k=1))[10][0]
    assert "y/2" not in answers(Options(rerank=False, routed_domains=1))[10][0]
    for options in (Options(semantic_audit=True), Options(gen_model="m"), Options(dense=True, embed_model="m"), Options(semantic_judge="x"), Options(dense=True)):
        with pytest.raises(ValueError):
            answers(options)


def test_dense_and_lexical_rankings_are_fused(spark):
    docs, questions = corpus(spark)
    vectors = indexing.hashed_vectors(docs.where("text is not null"), "doc_id").join(docs.select("doc_id", F.col("source").alias("domain")), "doc_id")
    index = replace(lexical.of(docs), vectors=vectors)
    top, _ = search(questions, index, Options(dense=True, rerank=False))
    got = {(r.qid, r.doc_id): r.score for r in top.collect()}
    assert got[10, 1] == round(2 / 61, 9) and got[10, 2] == round(2 / 62, 9)


def test_rebuild_and_service(spark, tmp_path):
    root = tmp_path / "corpus" / "ekf"
    root.mkdir(parents=True)
    (root / "ekf.cpp").write_text('#define LIMIT 3\nclass EK3 {\n  // @Param: HGT_DELAY\n  // @Range: 0 250\n  // @Units: ms\n  // @Default: 60\n};\nbool NavEKF3::healthy() {\n  return ok("}{");  // {\n}\nvoid run() {\n  NavEKF3::healthy();\n}\n')
    (root / "notes.md").write_text("# Filter\nThe height delay compensates late barometer samples in the filter.\n")
    (root / "341.NodeStatus.uavcan").write_text("uint32 uptime\n")
    (root / "defs").mkdir()
    (root / "defs" / "common.xml").write_text('<mavlink><messages><message id="0" name="HEARTBEAT"><field type="uint8_t" name="a"/></message></messages></mavlink>')
    folder = f"file://{tmp_path}/kb"
    (tmp_path / "manifest.json").write_text('{"name": "ekf", "url": "u", "sha": "sha1"}\n{"name": "other", "url": "u", "sha": "sha2"}\n')
    build_all(spark, f"file://{root}", "sha1", folder)
    build_all(spark, f"file://{root}", "ekf", folder, manifest=f"file://{tmp_path}/manifest.json")  # embeds nothing new
    with pytest.raises(ValueError):
        build_all(spark, f"file://{root}", "unknown", folder, manifest=f"file://{tmp_path}/manifest.json")
    t = lambda name: spark.read.parquet(f"{folder}/{name}")
    chunks = spark.read.json(f"{folder}/chunks")
    assert t("vectors").count() == chunks.count() == t("lexical/texts").count() == t("texts_repacked").count()
    assert {r.text for r in chunks.collect()} >= {"#define LIMIT 3"}
    assert {(r.full_name, r.dflt, r.snapshot) for r in t("params").collect()} == {("EK3_HGT_DELAY", "60", "sha1")}
    assert {(r.name, r.msg_id) for r in t("messages").collect()} == {("HEARTBEAT", 0), ("NodeStatus", 341)}
    assert "domain=ekf" in spark.read.parquet(f"{folder}/vectors_by_domain").inputFiles()[0]
    service = Service(spark, folder, Options(rerank_min=0.6, port=0))
    direct, found, none = service.ask(["What is the default of EK3_HGT_DELAY?", "height delay compensates late barometer", "unheard of thing"])
    assert direct["mode"] == "direct" and "default 60" in direct["answer"]
    assert found["mode"] == "extractive" and found["citations"][0]["file"].endswith("notes.md") and found["citations"][0]["line"] == 2 and found["routed"] == ["ekf"]
    assert none["mode"] == "refused"
    server = service.serve()
    threading.Thread(target=server.handle_request, daemon=True).start()
    with urllib.request.urlopen(urllib.request.Request(f"http://127.0.0.1:{server.server_port}", json.dumps({"q": "who calls navekf3::healthy"}).encode())) as r:
        assert json.loads(r.read())["answer"] == "NavEKF3::healthy is called by run"
    server.server_close()
    with pytest.raises(ValueError):
        Service(spark, folder, Options(dense=True, embed_model="other"))


def test_stored_index_equals_its_plan(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    questions = spark.read.parquet(f"{sf}/benchmark.parquet")
    stored, planned = lexical.write(docs, f"file://{tmp_path}/i"), lexical.of(docs)
    routes = [sorted(map(tuple, retrieval.route(questions, i, 2).collect())) for i in (stored, planned)]
    assert routes[0] == routes[1]
    tops = [sorted(map(tuple, retrieval.bm25_topk(questions, i, 5, retrieval.route(questions, i, 2)).collect())) for i in (stored, planned)]
    assert tops[0] == tops[1] and tops[0]


def test_cell_index_recall(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["ann_recall"](spark, "/root/testdata/sf0.01").first().recall >= 0.9
