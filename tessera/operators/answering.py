"""Grounding, extractive answers, refusal, and the deterministic audit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import CITATION, NUMBER, SENTENCE_END, SPECULATION, lines, tokens
from tessera.operators.lexical import Index, opened

#: Fixed text: what is said when the corpus has no answer.
REFUSAL = "Not supported by the indexed corpus."


def evidence(hits: DataFrame, questions: DataFrame, corpus: DataFrame | Index, most: int = 3, qid: str = "item_id") -> DataFrame:
    """(qid, rk, doc_id, file, line, text): of each of the best documents, the
    line with most of the question's words (ties: the first)."""
    best = hits.where(F.col("rk") <= most).select("qid", "rk", "doc_id")
    q = questions.select(F.col(qid).alias("qid"), F.array_distinct(tokens(F.col("text"))).alias("asked"))
    # Only the few texts that were hit are cut into lines.
    both = opened(corpus).texts.join(best, "doc_id").join(q, "qid").withColumn("all", lines(F.col("text")))
    # Inside the row: no shuffle of lines.
    rated = F.transform("all", lambda t, i: F.struct((-F.size(F.array_intersect("asked", F.array_distinct(tokens(t))))).alias("lack"), (i + F.col("line_start")).alias("line"), t.alias("text")))
    top = F.array_min(rated)
    return both.withColumn("top", top).select("qid", "rk", "doc_id", "file", F.col("top.line").alias("line"), F.col("top.text").alias("text"))


def grounded(found: DataFrame) -> DataFrame:
    """One row per question: its evidence in order of rank."""
    return found.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rk", "file", "line", "text"))).alias("evidence"))


def extractive(found: DataFrame) -> DataFrame:
    """(qid, answer): each evidence line as a sentence with its citation.
    Deterministic; no replacement for a language model's synthesis."""
    said = F.concat(F.regexp_replace("text", r"[.!?]+\s*$", ""), F.lit(" ["), "file", F.lit(":"), F.col("line").cast("string"), F.lit("]."))
    rows = found.select("qid", F.struct("rk", said.alias("said")).alias("s"))
    return rows.groupBy("qid").agg(F.array_join(F.transform(F.sort_array(F.collect_list("s")), lambda s: s["said"]), " ").alias("answer"))


def generate(grounds: DataFrame, model: Callable | None = None) -> DataFrame:
    """(qid, answer) by a model over pandas frames of (qid, evidence)."""
    if model is None:
        rows = grounds.select("qid", F.inline("evidence"))
        return extractive(rows)
    return grounds.mapInPandas(model, f"qid {grounds.schema['qid'].dataType.simpleString()}, answer string")


def modes(questions: DataFrame, direct: DataFrame, surviving: DataFrame, generated: str = "extractive", qid: str = "item_id") -> DataFrame:
    """(qid, mode): direct, ``generated`` or refused."""
    d = direct.select(F.col("qid")).distinct().withColumn("is_direct", F.lit(True))
    s = surviving.select("qid").distinct().withColumn("has_chunk", F.lit(True))
    all_q = questions.select(F.col(qid).alias("qid")).join(d, "qid", "left").join(s, "qid", "left")
    return all_q.select("qid", F.when(F.col("is_direct"), "direct").when(F.col("has_chunk"), generated).otherwise("refused").alias("mode"))


def refused(questions: DataFrame, surviving: DataFrame, qid: str = "item_id") -> DataFrame:
    q = questions.select(F.col(qid).alias("qid"))
    return q.join(surviving.select("qid").distinct(), "qid", "left_anti").withColumn("answer", F.lit(REFUSAL))


def sentences(answers: DataFrame) -> DataFrame:
    """(qid, pos from 1, sentence): answers cut after their end marks."""
    parts = F.filter(F.split("answer", SENTENCE_END), lambda s: F.trim(s) != "")
    found = answers.select("qid", F.posexplode(parts).alias("p", "sentence"))
    return found.select("qid", (F.col("p") + 1).alias("pos"), F.regexp_replace("sentence", r"[.!?]+$", "").alias("sentence"))


def audit(answers: DataFrame, found: DataFrame) -> DataFrame:
    """One row per sentence: (qid, pos, sentence, uncited, bad_citation,
    speculation, bad_number, struck).

    A sentence is struck if it has no citation, cites lines that were not
    retrieved, speculates, or has a number that its cited text does not have.
    Citations are taken out before numbers are read, else a line number would
    be a claim.
    """
    s = sentences(answers)
    cites = F.zip_with(F.regexp_extract_all("sentence", F.lit(CITATION), 1), F.regexp_extract_all("sentence", F.lit(CITATION), 2), lambda f, l: F.struct(f.alias("file"), l.cast("int").alias("line")))
    s = s.withColumn("cites", cites)
    numbers = F.array_distinct(F.regexp_extract_all(F.regexp_replace("sentence", CITATION, ""), F.lit(NUMBER), 0))
    held = found.select("qid", F.struct("file", "line", "text").alias("e")).groupBy("qid").agg(F.collect_list("e").alias("evidence"))
    s = s.join(held, "qid", "left").withColumn("evidence", F.coalesce("evidence", F.array().cast("array<struct<file:string,line:int,text:string>>")))
    known = F.transform("evidence", lambda e: F.struct(e["file"], e["line"]))
    bad = F.exists("cites", lambda c: ~F.array_contains(known, c))
    cited = F.filter("evidence", lambda e: F.array_contains(F.col("cites"), F.struct(e["file"].alias("file"), e["line"].alias("line"))))
    have = F.flatten(F.transform(cited, lambda e: F.regexp_extract_all(e["text"], F.lit(NUMBER), F.lit(0))))
    s = s.select(
        "qid", "pos", "sentence", (F.size("cites") == 0).alias("uncited"), bad.alias("bad_citation"), F.regexp_like("sentence", F.lit(SPECULATION)).alias("speculation"),
        (F.size(F.array_except(numbers, have)) > 0).alias("bad_number"),
    )
    return s.withColumn("struck", F.col("uncited") | F.col("bad_citation") | F.col("speculation") | F.col("bad_number"))


def semantic_audit(audited: DataFrame, found: DataFrame, judge: Callable, least: float) -> DataFrame:
    """Also strike sentences that a judge finds unsupported: a function over
    pandas frames of (qid, pos, sentence, evidence), evidence the cited lines'
    text, that gives (qid, pos, support). Struck sentences are not judged."""
    cites = F.zip_with(F.regexp_extract_all("sentence", F.lit(CITATION), 1), F.regexp_extract_all("sentence", F.lit(CITATION), 2), lambda f, l: F.struct(f.alias("file"), l.cast("int").alias("line")))
    claims = audited.where(~F.col("struck")).select("qid", "pos", "sentence", F.explode(F.array_distinct(cites)).alias("c"))
    cited = claims.join(found.select("qid", "file", "line", "text").distinct(), (claims.qid == found.qid) & (F.col("c.file") == F.col("file")) & (F.col("c.line") == F.col("line"))).select(claims.qid, "pos", "sentence", "c", "text")
    pairs = cited.groupBy("qid", "pos", "sentence").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c", "text"))), lambda x: x["text"]), "\n").alias("evidence"))
    kinds = {c: audited.schema[c].dataType.simpleString() for c in ("qid", "pos")}
    judged = pairs.mapInPandas(judge, f"qid {kinds['qid']}, pos {kinds['pos']}, support double")
    return audited.join(judged, ["qid", "pos"], "left").withColumn("struck", F.col("struck") | (F.coalesce("support", F.lit(1.0)) < least))


def closed(audited: DataFrame) -> DataFrame:
    """(qid, answer, struck): what survives, in order, or the refusal."""
    order = F.struct("pos", "sentence")
    keep = lambda flag: F.transform(F.sort_array(F.collect_list(F.when(F.col("struck") == flag, order))), lambda x: x["sentence"])
    out = audited.groupBy("qid").agg(keep(False).alias("kept"), keep(True).alias("struck"))
    text = F.when(F.size("kept") > 0, F.concat(F.array_join("kept", ". "), F.lit("."))).otherwise(REFUSAL)
    return out.select("qid", text.alias("answer"), "struck")
