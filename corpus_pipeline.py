"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import langid, mixing, neardup, packing, quality, simhash
from tessera.llm.common import fold, table, work_folder, written
from tessera.llm.components import components

#: Documents whose language is less likely than this are rejected.
LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language: a letter, and one language that is
    likelier than all others together. ``lang`` becomes the one found."""
    model = langid.fit(docs.where(fold(F.col("doc_id"), 5) != 0), "lang", "text", "doc_id")
    found = langid.identify(docs, model, keep=tuple(docs.columns), language="found_lang", score="found_score")
    kept = found.where((F.col("found_lang") != langid.UNKNOWN) & (F.col("found_score") >= LANGUAGE_SCORE))
    return kept.select(*(F.col("found_lang").alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns))


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the line labels find good."""
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0)
    found = quality.classify(docs, quality.fit(docs, labels), keep=tuple(docs.columns), score="found_quality")
    return found.where(F.col("found_quality") >= quality.THRESHOLD).drop("found_quality")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: the one with the
    smallest id (null ids last), then with the least hash of its text. Rows that
    repeat id and text are one document.

    Groups are chains of two kinds of links: SimHash fingerprints at three bits
    or fewer, by pivot distance tables, and texts that share 4/5 of their
    five-word shingles, whose fingerprints mostly lie farther apart."""
    key = {"near_null": F.col("doc_id").isNull(), "near_id": F.coalesce("doc_id", F.lit(0)), "near_text": F.xxhash64("text")}
    marked = docs.withColumns(key)
    rows = docs.select(F.struct(*(c.alias(k) for k, c in key.items())).alias("near_row"), "text")
    found = [groups.near_duplicates(rows, "near_row").select("near_row", "component_id") for groups in (simhash, neardup)]
    # Each document that isn't its group's first, and the first; both kinds of groups meet in their documents.
    later = written(found[0].unionByName(found[1]).where("near_row != component_id").distinct(), "later")
    node = {"a": F.xxhash64("near_row"), "b": F.xxhash64("component_id")}
    roots = components(later.select(*(c.alias(k) for k, c in node.items())))
    ends = later.select(F.explode(F.array("near_row", "component_id")).alias("near_row")).distinct()
    rooted = ends.join(roots, F.xxhash64("near_row") == F.col("node")).select("near_row", "root")
    first = rooted.groupBy("root").agg(F.min("near_row").alias("near_row"))
    dropped = ends.join(first, "near_row", "left_anti").select("near_row.*")  # no join by a large group's root
    # Both by the same key, so the texts are shuffled once.
    return marked.join(dropped, list(key), "left_anti").dropDuplicates(list(key)).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources meet their targets, in
    the order of the curriculum: written, successive files and their rows."""
    return mixing.mix(docs).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of equal cost. A document that the
    mix repeats is packed each time. Of documents as Spark writes a sorted
    table, one file of a number each, sequence ids ascend with the order of
    files and rows (the curriculum), in steps of about half a million tokens;
    other documents have no order."""
    numbers = [re.search(r"/part-(\d+)-[^/]*$", name) for name in docs.inputFiles()]
    if not numbers or not all(numbers) or len({int(m[1]) for m in numbers}) < len(numbers):
        return packing.pack(docs)
    place = docs.metadataColumn("_metadata")
    ordered = docs.withColumns({"pack_file": F.regexp_extract(place["file_name"], r"^part-(\d+)-", 1).cast("long"), "pack_row": place["row_index"]})
    return packing.pack(ordered, order=("pack_file", "pack_row"))


STAGES = [
    ("language", identify_language),
    ("quality", classify_quality),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Learned models and BPE merges can't be put in SQL; tests/llm compares each
#: stage with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``."""
    docs, folder = table(spark, sf_dir, "documents"), work_folder(spark)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
