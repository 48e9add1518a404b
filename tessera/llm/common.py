"""Helpers shared by the training-data operators: tables, folds, work folder."""

from __future__ import annotations

import ctypes
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What counts as white space between words: the space and U+0009 to U+000D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


_BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes of texts that a Python worker turns into objects at once, about.
BATCH_BYTES = 4 << 20
#: How Spark's text writer must write rows of bytes: as they are, each followed
#: by a line feed. (Bytes are passed as strings, which Spark doesn't validate.)
PLAIN = {"lineSep": "\n", "compression": "none"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (null id: null)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))


def fold_of(doc_id: int, modulus: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % modulus


def word_count(col: Column) -> Column:
    """Words of a text; null and blank texts have none."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def work_folder(spark: SparkSession) -> str:
    """A new folder name under the folder that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a
    local session sets a folder under the warehouse; a cluster's executors
    would not see that, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared work folder and read it again.

    Later stages then start from replicated files, not from shuffle files of
    executors that may be lost.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def trim() -> None:
    """Give freed memory back to the system, where the C library can: workers
    are used again, and what one stage freed would count beside the next's."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def released(shared: Broadcast) -> None:
    """Let a worker forget a broadcast value; it is read from the executor's
    copy again when it is next asked for."""
    shared.__dict__.pop("_value", None)


def free_name(taken: list[str], wanted: str) -> str:
    """``wanted``, or that with underscores, so that it clashes with none."""
    have = {x.lower() for x in taken}
    while wanted.lower() in have:
        wanted = f"_{wanted}"
    return wanted


def shingle_hashes(text: str | None, shingle: int, seed: int, window: int = 1 << 20) -> Iterator[list[int]]:
    """XXH64 of each run of ``shingle`` successive words of a text in lower case
    (A-Z), joined by spaces; of fewer words the whole sequence; no word: none.

    Lists of hashes, one for each window of about ``window`` bytes, so that a
    very long text's words are never all held."""
    raw, digest = (text or "").encode("utf-8", "replace").lower(), xxhash.xxh64_intdigest
    words, at, some = [], 0, False
    while at < len(raw):
        cut = _BLANK.search(raw, at + window)
        end = cut.start() if cut else len(raw)
        words, at = words + raw[at:end].split(), end
        n = len(words) - shingle + 1
        if n < 1 and (some or at < len(raw) or not words):
            continue
        joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
        n, some = max(n, 1), True
        last, first = (ends[len(ends) - n :] - 1).tolist(), [0, *ends[: n - 1].tolist()]
        yield [digest(joined[a:b], seed) for a, b in zip(first, last)]
        words = words[n:]


def size_runs(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs whose sizes add up to about ``most``."""
    start = held = n = 0
    for n, size in enumerate(sizes, 1):
        held += size
        if held >= most:
            yield start, n
            start, held = n, 0
    if start < n:
        yield start, n


def bounded(batches: Iterable[pa.RecordBatch], column: int, most: int = BATCH_BYTES, rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Slices of batches in which a column's values have about ``most`` bytes
    together (one value may have more), and at most ``rows`` rows."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy() + most // rows
        for start, end in size_runs(sizes.tolist(), most):
            yield batch.slice(start, end - start)
        trim()


def text_runs(texts: list[str | None], chars: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts with about ``chars`` characters together."""
    return size_runs((len(t or "") for t in texts), chars)
