"""Language identification by multinomial naive Bayes over hashed n-grams.

A text is lower-cased, every run of characters that are not letters becomes one
space, and its character n-grams (``ORDERS``, with word borders) are hashed to
``BUCKETS``. Training counts them for each language; the model is the matrix of
their log probabilities, broadcast to the workers: ``BUCKETS`` x 4 bytes for
each language, whatever the input's size. More than ``SHARD_LANGUAGES`` go to
several matrices, of which a worker holds one at a time. A batch of texts is
scored together: the rows of the matrix that its n-grams select are summed by
document. A very long text is scored in windows that overlap by an n-gram.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded, fold, released, table, text_runs, written

ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 16
#: Documents of each language that training reads, about, at most.
TRAIN_DOCS = 2000
SMOOTHING = 0.5
UNKNOWN = "und"
#: Languages of one matrix (16 MB).
SHARD_LANGUAGES = 64
#: Up to so many languages their sampling rates are broadcast, else joined.
BROADCAST_LANGUAGES = 10_000
#: Characters that are scored together.
CHARS = 1 << 19

_LETTERS: dict[int, np.ndarray] = {}


def letters() -> np.ndarray:
    """Which code points are letters; built once in each process."""
    if os.getpid() not in _LETTERS:
        _LETTERS[os.getpid()] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS[os.getpid()]


def ngrams(texts: list[str | None], orders: tuple[int, ...] = ORDERS, buckets: int = BUCKETS, before: np.ndarray | None = None, more: bool = False):
    """For each order (text of each n-gram, bucket of each n-gram); which texts
    have a letter; and the last code points.

    before: the last code points of the first text's part that came before,
    whose own n-grams are left out; more: the last text goes on.
    """
    raw = [np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    space = np.full(1, 32, np.uint32)
    heads = [space] * len(raw)
    if before is not None:
        heads[0] = before
    tails = [space] * (len(raw) - more) + [space[:0]] * more
    sizes = np.array([len(h) + len(r) + len(t) for h, r, t in zip(heads, raw, tails)])
    points = np.concatenate([x for h, r, t in zip(heads, raw, tails) for x in (h, r, t)]) if raw else space
    owner = np.repeat(np.arange(len(raw)), sizes)
    letter = letters()[points]
    points = np.where(letter, points, np.uint32(32))
    # Of a run of spaces one stays; each text begins and ends with its own.
    keep = letter | np.r_[True, letter[:-1]] | np.r_[True, owner[1:] != owner[:-1]]
    old = 0 if before is None else len(before)
    keep[:old] = True
    points, owner, letter = points[keep], owner[keep], letter[keep]
    some = np.bincount(owner[letter & (np.arange(len(letter)) >= old)], minlength=len(raw)) > 0
    out, h = [], np.zeros(len(points), np.uint32)
    for n in range(1, max(orders) + 1):
        if n > len(points):
            break
        h = h[: len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1 :]
        if n in orders:
            # Not across texts, and not a space alone or two in a row.
            good = owner[: len(h)] == owner[n - 1 :]
            good &= letter[: len(h)] | letter[min(1, n - 1) : len(h) + min(1, n - 1)]
            good &= letter[n - 1 :] | letter[max(0, n - 2) : len(points) - min(1, n - 1)]
            good[: max(0, old - n + 1)] = False
            mixed = (h[good] ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            out.append((owner[: len(h)][good], ((mixed >> np.uint32(15)) ^ mixed) & np.uint32(buckets - 1)))
    return out, some, points[-(max(orders) - 1) :]


def windows(texts: list[str | None], chars: int, buckets: int):
    """(first text, texts, their n-grams, which have a letter) of runs of texts,
    or of successive parts of one long text."""
    for a, b in text_runs(texts, chars):
        for lo, hi in ((a, b - 1), (b - 1, b)) if len(texts[b - 1] or "") > chars else ((a, b),):
            if hi - lo != 1 or len(texts[lo] or "") <= chars:
                if hi > lo:
                    yield lo, hi - lo, *ngrams(texts[lo:hi], buckets=buckets)[:2]
                continue
            tail = None
            for at in range(0, len(texts[lo]), chars):
                part = texts[lo][at : at + chars]
                grams, some, tail = ngrams([part], buckets=buckets, before=tail, more=at + chars < len(texts[lo]))
                yield lo, 1, grams, some


def fit(labelled: DataFrame, lang_col: str, text_col: str, key_col: str, *, train_docs: int = TRAIN_DOCS, smoothing: float = SMOOTHING, buckets: int = BUCKETS, shard_languages: int = SHARD_LANGUAGES) -> list[tuple[list[str], Broadcast]]:
    """Languages (in code point order) and the broadcast log probabilities
    [bucket, language], for each ``shard_languages`` languages.

    Of a language with more than ``train_docs`` rows, those whose key hashes
    below ``train_docs`` / rows are read, so training costs the same at any
    scale. Rows without text or language are not used. The driver holds the
    languages' names and one matrix at a time.
    """
    spark = labelled.sparkSession
    labelled = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.xxhash64(key_col).alias("key"))
    per = sorted((r[0], r[1]) for r in labelled.groupBy("lang").count().toLocalIterator())
    if not per:
        return []
    rates = spark.createDataFrame([(lang, k, min(1.0, train_docs / n)) for k, (lang, n) in enumerate(per)], "lang string, number int, rate double")
    rates = F.broadcast(rates) if len(per) <= BROADCAST_LANGUAGES else rates
    sample = labelled.join(rates, "lang").where(F.pmod("key", F.lit(1 << 30)) / F.lit(float(1 << 30)) < F.col("rate")).select("number", "text")

    def count(batches):
        counts: dict[int, np.ndarray] = {}
        for batch in bounded(batches, 1):
            number, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for first, n, grams, _ in windows(texts, CHARS, buckets):
                own = number[first : first + n]
                for lang in np.unique(own):
                    total = counts.setdefault(int(lang), np.zeros(buckets, np.int64))
                    for owner, bucket in grams:
                        total += np.bincount(bucket[own[owner] == lang], minlength=buckets)
            if len(counts) > shard_languages:
                yield from out(counts)
                counts = {}
        yield from out(counts)

    def out(counts):
        for lang, total in counts.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), lang, np.int32)), pa.array(used.astype(np.int32)), pa.array(total[used])], ["number", "bucket", "n"])

    def columns(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.column(c).to_numpy().tobytes()], pa.binary()) for c in range(3)], ["number", "bucket", "n"])

    counted = sample.mapInArrow(count, "number int, bucket int, n long").groupBy("number", "bucket").agg(F.sum("n").alias("n"))
    if len(per) > shard_languages:
        counted = written(counted, "ngrams")
    model = []
    for a in range(0, len(per), shard_languages):
        names = [lang for lang, _ in per[a : a + shard_languages]]
        matrix = np.full((buckets, len(names)), smoothing)
        for number, bucket, n in counted.where(F.col("number").between(a, a + len(names) - 1)).mapInArrow(columns, "number binary, bucket binary, n binary").toLocalIterator():
            matrix[np.frombuffer(bucket, np.int32), np.frombuffer(number, np.int32) - a] += np.frombuffer(n, np.int64)
        model.append((names, spark.sparkContext.broadcast(np.log(matrix / matrix.sum(axis=0)).astype(np.float32))))
    return model


def log_likelihoods(texts: list[str | None], matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """([text, language], which texts have a letter)."""
    buckets, k = matrix.shape
    total, letter = np.zeros((len(texts), k)), np.zeros(len(texts), bool)
    for begin, n, grams, some in windows(texts, max(1, CHARS * 4 // max(4, k)), buckets):
        letter[begin : begin + n] |= some
        for owner, bucket in grams:
            if len(owner):
                first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                total[begin + owner[first]] += np.add.reduceat(matrix[bucket], first, axis=0, dtype=np.float64)
    return total / len(ORDERS), letter  # each character is in an n-gram of every order


def score_texts(texts: list[str | None], model: list[tuple[list[str], Broadcast]]) -> tuple[list[str], np.ndarray]:
    """Language and its posterior (equal priors) of each text."""
    best, mass = np.full(len(texts), -np.inf), np.zeros(len(texts))
    names, letter = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts), bool)
    for langs, shared in model:
        total, letter = log_likelihoods(texts, shared.value)
        if len(model) > 1:
            released(shared)
        top = total.argmax(axis=1)
        high = total[np.arange(len(texts)), top]
        more = high > best  # ties: the earlier language
        names[more] = np.array(langs, object)[top[more]]
        new = np.maximum(best, high)
        mass = mass * np.exp(best - new) + np.exp(total - new[:, None]).sum(axis=1)
        best = new
    names[~letter] = UNKNOWN
    return names.tolist(), np.where(letter, 1 / np.maximum(mass, 1), 0.0)


def identify(docs: DataFrame, model: list[tuple[list[str], Broadcast]], text_col: str = "text", keep: tuple[str, ...] = (), *, language: str = "lang_pred", score: str = "score") -> DataFrame:
    """Columns of ``keep`` with the predicted language and its score.

    A null text or one without a letter is ``und`` with score 0. Of equally
    likely languages the first in code point order is taken. Texts are read
    whole. Repeated rows get equal results; an empty table gives no rows.
    """
    chosen = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text_col}`").cast("string").alias("_langid_text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema[:-1]), f"`{language}` string", f"`{score}` double"])
    names = [*chosen.columns[:-1], language, score]

    def run(batches):
        for batch in bounded(batches, len(names) - 2):
            lang, sure = score_texts(batch.column(batch.num_columns - 1).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(sure)], names)

    return chosen.mapInArrow(run, schema)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(fold(F.col("doc_id"), 5) != 0), "lang", "text", "doc_id")
    found = identify(docs, model, keep=("doc_id",))
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


QUERIES = {"op1_language_id": op1_language_id}
ORACLES: dict[str, str] = {}
