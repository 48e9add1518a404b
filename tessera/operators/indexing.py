"""Lexical statistics, vectors and domain partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import tokens
from tessera.operators.lexical import Index, opened


def term_statistics(corpus: DataFrame | Index) -> DataFrame:
    """(term, df, cf)."""
    return opened(corpus).postings.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def lengths(docs: DataFrame) -> DataFrame:
    words = tokens(F.col("text"))
    return docs.select("doc_id", F.size(words).cast("long").alias("dl"), F.size(F.array_distinct(words)).cast("long").alias("distinct_terms"))


def domain_statistics(corpus: DataFrame | Index) -> DataFrame:
    """(domain, docs, words, postings, terms) of each domain's lexical index.
    Distinct terms are counted in two steps, so a hot domain is spread by
    term."""
    index = opened(corpus)
    per = index.postings.groupBy("domain", "term").agg(F.count("*").alias("n"))
    terms = per.groupBy("domain").agg(F.sum("n").alias("postings"), F.count("*").alias("terms"))
    return index.sizes.join(terms, "domain", "left")


def hashed_vectors(chunks: DataFrame, id_col: str = "chunk_id", text_col: str = "text", dims: int = 1024) -> DataFrame:
    """A stand-in for an embedding model: signed hashed word counts of unit
    length, computed in Arrow batches."""
    import zlib

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for text in f[text_col]:
                v = np.zeros(dims, np.float32)
                for w in (text or "").lower().split():
                    h = zlib.crc32(w.encode())
                    v[h % dims] += 1.0 if h >> 31 else -1.0
                out.append((v / max(1e-9, float(np.linalg.norm(v)))).tolist())
            yield pd.DataFrame({id_col: f[id_col], "embedding": out})

    return chunks.select(id_col, text_col).mapInPandas(run, f"{id_col} {chunks.schema[id_col].dataType.simpleString()}, embedding array<float>")


def embed(chunks: DataFrame, model: Callable | None = None, id_col: str = "chunk_id", text_col: str = "text", **options) -> DataFrame:
    """(id, embedding) by a model over pandas frames of (id, text), loaded once
    in each worker; without one, ``hashed_vectors``."""
    if model is None:
        return hashed_vectors(chunks, id_col, text_col, **options)
    return chunks.select(id_col, text_col).mapInPandas(model, f"`{id_col}` {chunks.schema[id_col].dataType.simpleString()}, embedding array<float>")


def pending(chunks: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What an interrupted run has still to do; nothing after a full one."""
    return chunks.join(done.select(key), key, "left_anti")


def with_domain(vectors: DataFrame, domains: DataFrame, key: str) -> DataFrame:
    """Vectors by domain, without computing them again."""
    return vectors.join(domains, key)
