"""Measures of answers, retrieval and the audit over run tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import normalised, tokens
from tessera.operators.lexical import Index, opened


def gold_pairs(questions: DataFrame, corpus: DataFrame | Index, qid: str = "item_id") -> DataFrame:
    """(qid, doc_id): documents that contain a question's words in order.

    Not a nested loop: each question is met only with documents that have its
    rarest word, then containment is verified."""
    index = opened(corpus)
    q = questions.select(F.col(qid).alias("qid"), normalised(F.col("text")).alias("needle"), F.array_distinct(tokens(F.col("text"))).alias("words"))
    asked = q.select("qid", F.explode("words").alias("term"))
    d = index.postings.select("term", "doc_id").join(asked.select("term").distinct(), "term", "left_semi")
    df = d.groupBy("term").agg(F.count("*").alias("df"))
    rare = asked.join(df, "term", "left").groupBy("qid").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term")).alias("r")).where("r.df > 0")
    near = rare.select("qid", F.col("r.term").alias("term")).join(d, "term").select("qid", "doc_id")
    # Only texts that have a rare word are put in normal form.
    met = near.join(q.select("qid", "needle"), "qid").join(index.texts.select("doc_id", "text"), "doc_id")
    return met.where(F.contains(normalised(F.col("text")), F.col("needle"))).select("qid", "doc_id")


def outcomes(questions: DataFrame, gold: DataFrame, top: DataFrame, answered: DataFrame, qid: str = "item_id") -> DataFrame:
    """(qid, type, correct): an answerable question is right if the best
    document is gold and it was answered, another if it was refused."""
    q = questions.select(F.col(qid).alias("qid"))
    can = gold.select("qid").distinct().withColumn("can", F.lit(True))
    first = top.where("rk = 1").join(gold, ["qid", "doc_id"], "left_semi").select("qid").distinct().withColumn("hit", F.lit(True))
    did = answered.select("qid").distinct().withColumn("did", F.lit(True))
    no = lambda c: F.coalesce(F.col(c), F.lit(False))
    out = q.join(can, "qid", "left").join(first, "qid", "left").join(did, "qid", "left")
    return out.select("qid", F.when(no("can"), "answerable").otherwise("unanswerable").alias("type"), F.when(no("can"), no("hit") & no("did")).otherwise(~no("did")).alias("correct"))


def accuracy(outcome: DataFrame) -> DataFrame:
    """By type, and in total (type ``all``)."""
    share = F.round(F.avg(F.col("correct").cast("double")), 6)
    rolled = outcome.rollup("type").agg(F.count("*").alias("n"), F.count_if("correct").alias("n_correct"), share.alias("accuracy"))
    return rolled.withColumn("type", F.coalesce("type", F.lit("all")))


def recall_at(gold: DataFrame, ranked: DataFrame, ks: tuple[int, ...] = (1, 5, 10)) -> DataFrame:
    """(k, n, hits, recall): questions with a gold document within rank k."""
    best = gold.join(ranked, ["qid", "doc_id"], "left").groupBy("qid").agg(F.min("rk").alias("rk"))
    each = best.select("qid", "rk", F.explode(F.array(*map(F.lit, ks))).alias("k"))
    return each.groupBy("k").agg(F.count("*").alias("n"), F.count_if(F.col("rk") <= F.col("k")).alias("hits"), F.round(F.avg(F.when(F.col("rk") <= F.col("k"), 1.0).otherwise(0.0)), 6).alias("recall"))


def split(questions: DataFrame, qid: str = "item_id") -> DataFrame:
    return questions.select(F.col(qid).alias("qid"), F.when(F.col(qid) % 2 == 0, "tunable").otherwise("heldout").alias("split"))


def delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """(change, n): questions by what a new run did to them."""
    a, b = before.select("qid", F.col("correct").alias("was")), after.select("qid", F.col("correct").alias("now"))
    kind = F.when(F.col("was").eqNullSafe(F.col("now")), "same").when(F.coalesce("now", F.lit(False)), "better").otherwise("worse")
    return a.join(b, "qid", "full").groupBy(kind.alias("change")).agg(F.count("*").alias("n"))


def confusion(audited: DataFrame, planted: DataFrame) -> DataFrame:
    """The auditor against planted faults (qid, pos, fault)."""
    both = audited.join(planted, ["qid", "pos"], "left").withColumn("bad", F.col("fault").isNotNull())
    return both.agg(
        F.count_if(F.col("bad") & F.col("struck")).alias("true_positive"), F.count_if(~F.col("bad") & F.col("struck")).alias("false_positive"),
        F.count_if(F.col("bad") & ~F.col("struck")).alias("false_negative"), F.count_if(~F.col("bad") & ~F.col("struck")).alias("true_negative"),
    )
