"""A lexical index: postings and statistics as tables, made once.

    postings  domain, term, doc_id, tf, dl; in order of term and document, so a
              common word's postings lie in several files and tasks
    sizes     domain, docs, words: one row for each domain
    texts     doc_id, domain, file, line_start, text, and its content id

``of`` gives the tables as plans over a corpus, ``write`` stores them, and
``read`` opens what was stored; everything that searches takes either.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import tokens


@dataclass(frozen=True)
class Index:
    postings: DataFrame
    sizes: DataFrame
    texts: DataFrame
    vectors: DataFrame | None = None


def _named(docs: DataFrame, id_col: str, domain: str, text: str) -> DataFrame:
    have = set(docs.columns)
    source = F.col(domain).cast("string") if domain in have else F.lit(None).cast("string")
    file = F.col("file") if "file" in have else F.concat(source, F.lit("/"), F.col(id_col).cast("string"))
    first = F.col("line_start").cast("int") if "line_start" in have else F.lit(1)
    return docs.select(F.col(id_col).alias("doc_id"), source.alias("domain"), file.alias("file"), first.alias("line_start"), F.col(text).alias("text"))


def of(docs: DataFrame, id_col: str = "doc_id", domain: str = "source", text: str = "text") -> Index:
    """The index of a corpus, not stored. ``file`` and ``line_start`` say where
    a text stands, if the corpus has them; else a text is a file of its own.

    Null and empty texts are documents without words. Rows with equal ids are
    one document in rankings: ids should be unique.
    """
    texts = _named(docs, id_col, domain, text)
    words = texts.select("doc_id", "domain", tokens(F.col("text")).alias("all"))
    each = words.select("doc_id", "domain", F.size("all").cast("long").alias("dl"), F.explode("all").alias("term"))
    # Words are counted in the task that reads them; one row a distinct word is shuffled.
    postings = each.groupBy("term", "doc_id", "domain", "dl").agg(F.count("*").alias("tf"))
    sizes = words.groupBy("domain").agg(F.count("*").alias("docs"), F.sum(F.size("all")).cast("long").alias("words"))
    return Index(postings, sizes, texts)


def write(docs: DataFrame, folder: str, id_col: str = "doc_id", domain: str = "source", text: str = "text") -> Index:
    """Store the index of a corpus under ``folder`` and open it. Texts are cut
    into words once."""
    made = of(docs, id_col, domain, text)
    made.texts.write.mode("overwrite").parquet(f"{folder}/texts")
    made.postings.sortWithinPartitions("term", "doc_id").write.mode("overwrite").parquet(f"{folder}/postings")
    # Words and documents of a domain follow from its postings, but for empty texts.
    spark = docs.sparkSession
    texts, postings = spark.read.parquet(f"{folder}/texts"), spark.read.parquet(f"{folder}/postings")
    words = postings.groupBy("domain").agg(F.sum("tf").alias("words"))
    sizes = texts.groupBy("domain").agg(F.count("*").alias("docs")).withColumnRenamed("domain", "of")
    sizes = sizes.join(words, F.col("of").eqNullSafe(F.col("domain")), "left").select(F.col("of").alias("domain"), "docs", F.coalesce("words", F.lit(0)).alias("words"))
    sizes.coalesce(1).write.mode("overwrite").parquet(f"{folder}/sizes")
    return read(spark, folder)


def read(spark: SparkSession, folder: str, vectors: str | None = None) -> Index:
    """Open a stored index; ``vectors``: a table (doc_id, domain, embedding)."""
    tables = (spark.read.parquet(f"{folder}/{name}") for name in ("postings", "sizes", "texts"))
    return Index(*tables, spark.read.parquet(vectors) if vectors else None)


def opened(corpus: DataFrame | Index) -> Index:
    return corpus if isinstance(corpus, Index) else of(corpus)


def totals(index: Index) -> DataFrame:
    """One row: (n_docs, avgdl)."""
    return index.sizes.agg(F.sum("docs").alias("n_docs"), (F.sum("words") / F.sum("docs")).alias("avgdl"))


def idf(df: Column, n: Column) -> Column:
    return F.ln(1 + (n - df + 0.5) / (df + 0.5))


def met(questions: DataFrame, index: Index, qid: str = "item_id", text: str = "text") -> DataFrame:
    """(qid, asked, term, df, doc_id, domain, tf, dl): a question's words where
    documents have them; asked: distinct words of the question."""
    words = F.array_distinct(tokens(F.col(text)))
    terms = questions.select(F.col(qid).alias("qid"), words.alias("all")).select("qid", F.size("all").alias("asked"), F.explode("all").alias("term"))
    postings = index.postings.join(terms.select("term").distinct(), "term", "left_semi")
    df = postings.groupBy("term").agg(F.count("*").alias("df"))
    return postings.join(terms.join(df, "term"), "term")
