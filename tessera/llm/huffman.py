"""Token ids in a compact file format: canonical length-limited Huffman codes.

The ids of all documents, in ascending id order, are one long sequence. Global
counts of ids give one canonical code with lengths of at most ``MAX_BITS``
(package-merge). The sequence is stored in independent blocks; a block holds
whole documents up to ``BLOCK_IDS`` ids, or part of a longer one, and starts at
a byte. Inside it, the bit offset of every ``CHECKPOINT``-th id is stored, so
decoding can begin at any of them; the decoder looks up ``MAX_BITS`` bits at a
time in a table, at all checkpoints of many blocks at once.

File format (little-endian). A file is a row of blocks; each block is

    magic 'HUF1' | u32 bytes that follow | u32 checksum of what follows
    | u32 file number | u64 index of the first id in its file | u32 ids
    | u32 documents | u32 checkpoints | documents x (i64 id, u32 ids here, u8 flags)
    | checkpoints x u32 bit offset | bits, most significant first | line feed

flags: 1 the document began before this block, 2 it goes on in the next, 4 its
id is null. The code lengths (one byte for each id, 0: not used) are a file of
their own. Spark's text writer writes the files, one block a line, under its
commit protocol: a lost executor's half-written files are never read. The
binary-file reader reads them back from any store.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import PLAIN, bounded, table, work_folder, written
from tessera.llm.tokens import encoder, tokenizer_path

MAX_BITS = 16
BLOCK_IDS = 1 << 16
CHECKPOINT = 256
#: Ids in one file and so in one reading task, about.
FILE_IDS = 1 << 22
#: Up to so many files their offsets (16 bytes each) are broadcast, else joined.
BROADCAST_FILES = 1_000_000
MAGIC = b"HUF1"
HEAD = struct.Struct("<4sII")
BODY = struct.Struct("<IQIII")
DOCS = np.dtype([("id", "<i8"), ("n", "<u4"), ("flags", "u1")])


# ------------------------------------------------------------------ the code


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` (package-merge).

    counts[i] is the count of id i; ids that do not occur get length 0. A
    single id gets length 1.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError("more ids than codes of that length")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    n, levels, packages = len(order), [], np.zeros(0)
    for _ in range(max_bits):
        merged = np.concatenate([weights, packages])
        rank = np.argsort(merged, kind="stable")
        levels.append(rank < n)
        merged = merged[rank]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take, depth = 2 * n - 2, np.zeros(n, np.int64)
    for leaf in reversed(levels):
        leaves = int(leaf[:take].sum())
        depth[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[order] = depth
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: by length, then by id, counting upwards."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    code, last = 0, 0
    by_length = np.bincount(lengths, minlength=MAX_BITS + 1)
    at = 0
    for bits in range(1, len(by_length)):
        code <<= bits - last
        last, k = bits, int(by_length[bits])
        codes[order[at : at + k]] = code + np.arange(k)
        code, at = code + k, at + k
    return codes


def decode_table(lengths: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """For every ``max_bits`` bits: the id that they begin with and its length."""
    ids, sizes = np.zeros(1 << max_bits, np.uint32), np.zeros(1 << max_bits, np.uint8)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    spans = 1 << (max_bits - lengths[order].astype(np.int64))
    filled = np.repeat(order, spans)
    ids[: len(filled)] = filled
    sizes[: len(filled)] = lengths[filled]
    return ids, sizes


# ------------------------------------------------------------------ blocks


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes of ids one after another, and the bit at which each begins."""
    size = lengths[ids].astype(np.int64)
    begin = np.cumsum(size) - size
    total = int(size.sum())
    value = codes[ids].astype(np.uint64) << (np.uint64(64) - size.astype(np.uint64) - (begin % 32).astype(np.uint64))
    word = begin // 32
    out = np.zeros(total // 32 + 2, np.uint64)
    # Codes never overlap, so adding their parts of 32-bit words joins them.
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
    if len(word):
        high, low = np.add.reduceat(value >> np.uint64(32), first), np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
        out[word[first]] += high
        out[word[first] + 1] += low
    return out.astype(">u4").tobytes()[: (total + 7) // 8], begin


def block(file: int, first: int, ids: np.ndarray, docs: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> bytes:
    bits, begin = pack_bits(ids, codes, lengths)
    marks = begin[::CHECKPOINT].astype("<u4")
    body = BODY.pack(file, first, len(ids), len(docs), len(marks)) + docs.tobytes() + marks.tobytes() + bits
    return HEAD.pack(MAGIC, len(body), zlib.crc32(body)) + body


def blocks_of(content: bytes) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray, bytes]]:
    """(file, first, ids, documents, checkpoints, bits) of each block."""
    at = 0
    while at < len(content):
        magic, size, check = HEAD.unpack_from(content, at)
        body = content[at + HEAD.size : at + HEAD.size + size]
        if magic != MAGIC or len(body) != size or zlib.crc32(body) != check:
            raise ValueError(f"not a block at byte {at}")
        file, first, n, docs, marks = BODY.unpack_from(body)
        a = BODY.size + docs * DOCS.itemsize
        yield file, first, n, np.frombuffer(body, DOCS, docs, BODY.size), np.frombuffer(body, "<u4", marks, a), body[a + 4 * marks :]
        at += HEAD.size + size + 1


def heads_of(content: bytes) -> Iterator[tuple[int, int, int, int]]:
    """(file, first, ids, documents) of each block, without its contents."""
    at = 0
    while at < len(content):
        yield BODY.unpack_from(content, at + HEAD.size)[:4]
        at += HEAD.size + HEAD.unpack_from(content, at)[1] + 1


def grouped(items: Iterator, n: int) -> Iterator[list]:
    while group := list(islice(items, n)):
        yield group


def unpack(parts: list[tuple[int, np.ndarray, bytes]], ids: np.ndarray, sizes: np.ndarray, max_bits: int = MAX_BITS) -> list[np.ndarray]:
    """Decode several (ids, checkpoints, bits) side by side, each from all of
    its checkpoints at once: one table look-up a step for every checkpoint."""
    base = np.cumsum([0, *(len(bits) for _, _, bits in parts)])
    raw = np.frombuffer(b"".join(bits for _, _, bits in parts) + bytes(4), np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]  # 32 bits from each byte
    pos = np.concatenate([m.astype(np.int64) + 8 * b for (_, m, _), b in zip(parts, base)]) if parts else np.zeros(0, np.int64)
    left = np.concatenate([np.minimum(CHECKPOINT, n - CHECKPOINT * np.arange(len(m))) for n, m, _ in parts]) if parts else pos
    out = np.zeros((CHECKPOINT, len(pos)), np.uint32)
    top, mask = len(window) - 1, (1 << max_bits) - 1
    for step in range(int(left.max(initial=0))):
        look = window[np.minimum(pos >> 3, top)] >> (32 - max_bits - (pos & 7)).astype(np.uint32) & mask
        out[step] = ids[look]
        pos += sizes[look]
    flat, done, col = [], np.ascontiguousarray(out.T), 0
    for n, m, _ in parts:
        flat.append(done[col : col + len(m)].reshape(-1)[:n])
        col += len(m)
    return flat


# ------------------------------------------------------------------ Spark


def token_rows(docs: DataFrame, id_col: str, text_col: str, path: str, end_id: int, size: int) -> DataFrame:
    """(id, n, ids, kind): each row's ids with the end id, as little-endian
    bytes (kind 0), and for each task one row with the ids that it met and
    their counts, 8 bytes each (kind 1)."""

    def run(batches):
        enc = encoder(path)
        end, width = np.array([end_id], enc.dtype).tobytes(), enc.dtype.itemsize
        counts = np.zeros(size, np.int64)

        def out(key, n, ids, kind):
            return pa.RecordBatch.from_arrays([key, pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array([kind] * len(ids), pa.int32())], ["id", "n", "ids", "kind"])

        for batch in bounded(batches, 1):
            ids = [raw + end for raw in enc.encode(batch.column(1).to_pylist())]
            counts += np.bincount(np.frombuffer(b"".join(ids), enc.dtype), minlength=size)
            yield out(batch.column(0), [len(x) // width for x in ids], ids, 0)
        used = np.flatnonzero(counts)
        if len(used):
            yield out(pa.array([None], pa.int64()), [len(used)], [used.tobytes() + counts[used].tobytes()], 1)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, n long, ids binary, kind int")


def id_counts(tokens: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs: one small array, whatever the input's size."""

    def run(batches):
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                used, n = np.frombuffer(raw, np.int64).reshape(2, -1)
                counts[used] += n
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["token", "n"])

    found = tokens.where("kind = 1").select("ids").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size, np.int64)
    counts[found["token"].to_numpy()] = found["n"].to_numpy()
    return counts


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", *, tokenizer: str | None = None, end_id: int = 0, max_bits: int = MAX_BITS) -> None:
    """Encode ``docs`` and write token files and the code under ``folder``.

    Null and empty texts are the end id alone. Ids ascend, null ids first;
    rows with equal ids are ordered by their tokens. Other columns of ``docs``
    are not read. An empty table gives a code file and no block.
    """
    spark = docs.sparkSession
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    enc = encoder(path)
    size, dtype = max(enc.size, end_id + 1), enc.dtype
    made, at = token_rows(docs, id_col, text_col, path, end_id, size), f"{work_folder(spark)}/ids"
    made.write.option("compression", "zstd").partitionBy("kind").parquet(at)
    tokens = spark.read.schema(made.schema).parquet(at)
    counts = id_counts(tokens, size)
    lengths = code_lengths(counts, max(max_bits, (int(np.count_nonzero(counts)) - 1).bit_length()))
    if lengths.max(initial=0) > 25:
        raise ValueError("the decoder reads at most 25 bits at a time")
    tokens = tokens.where("kind = 0")
    spark.createDataFrame([(lengths.tobytes(),)], "value binary").select(F.col("value").cast("string").alias("value")).coalesce(1).write.options(**PLAIN).text(f"{folder}/code")

    total = tokens.agg(F.sum("n")).first()[0] or 0
    files = max(1, -(-int(total) // FILE_IDS))
    order = (F.col("id").asc_nulls_first(), F.crc32("ids"))
    ordered = tokens.repartitionByRange(files, *order).sortWithinPartitions(*order, "ids").select("id", "ids")
    code = spark.sparkContext.broadcast((canonical(lengths), lengths))

    def run(batches):
        codes, sizes = code.value
        file, first = TaskContext.get().partitionId(), 0
        held, held_docs, n_held = [], [], 0

        def out():
            nonlocal first, held, held_docs, n_held
            made = block(file, first, np.concatenate(held), np.array(held_docs, DOCS), codes, sizes)
            first, held, held_docs, n_held = first + n_held, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["block"])

        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(raw, dtype)
                if n_held and n_held + len(ids) > BLOCK_IDS:
                    yield out()
                for at in range(0, len(ids), BLOCK_IDS):
                    piece, more = ids[at : at + BLOCK_IDS], at + BLOCK_IDS < len(ids)
                    held.append(piece)
                    held_docs.append((doc_id or 0, len(piece), (at > 0) | more << 1 | (doc_id is None) << 2))
                    n_held += len(piece)
                    if more:
                        yield out()
        if n_held:
            yield out()

    ordered.mapInArrow(run, "block binary").select(F.col("block").cast("string").alias("value")).write.options(**PLAIN).text(f"{folder}/tokens")


def read_code(spark: SparkSession, folder: str) -> np.ndarray:
    found = spark.read.format("binaryFile").load(f"{folder}/code").where("length > 0").select("content").collect()
    return np.frombuffer(bytes(found[0][0])[:-1], np.uint8)


def read_tokens(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Decode the files: the document's id, ``start`` (ids of all documents
    before it), ``n_tokens`` and ``ids`` (little-endian, 4 bytes each)."""
    code = spark.sparkContext.broadcast(read_code(spark, folder))
    files = spark.read.format("binaryFile").load(f"{folder}/tokens").where("length > 0").select("content")

    def sizes_of(batches):
        for batch in batches:
            for content in batch.column(0):
                heads = [(file, n) for file, _, n, _ in heads_of(content.as_buffer().to_pybytes())]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in heads], pa.int64()) for k in (0, 1)], ["file", "n"])

    def run(batches):
        bits = max(1, int(code.value.max(initial=1)))
        table_ids, table_sizes = decode_table(code.value, bits)
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for group in grouped(blocks_of(content.as_buffer().to_pybytes()), 16):
                    decoded = unpack([(n, marks, raw) for _, _, n, _, marks, raw in group], table_ids, table_sizes, bits)
                    for (file, first, _, docs, _, _), ids in zip(group, decoded):
                        ends = np.cumsum(docs["n"], dtype=np.int64)
                        for doc_id, n, flags, end in zip(docs["id"].tolist(), docs["n"].tolist(), docs["flags"].tolist(), ends.tolist()):
                            raw = ids[end - n : end].astype("<u4").tobytes()
                            if flags & 1:
                                rows[-1][3].append(raw)
                            else:
                                rows.append([None if flags & 4 else doc_id, file, first + end - n, [raw]])
                    cut = rows[:-1]  # the last one may go on in the next block
                    if cut:
                        yield as_batch(cut)
                        rows = rows[-1:]
                if rows:
                    yield as_batch(rows)

    def as_batch(rows):
        ids = [b"".join(r[3]) for r in rows]
        cols = [*(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
        return pa.RecordBatch.from_arrays(cols, ["id", "file", "here", "n_tokens", "ids"])

    totals = files.mapInArrow(sizes_of, "file long, n long").groupBy("file").agg(F.sum("n").alias("n"))
    # One row for each file, not for each document.
    before = written(totals.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before")), "before")
    if before.count() <= BROADCAST_FILES:
        before = F.broadcast(before)
    rows = files.mapInArrow(run, "id long, file long, here long, n_tokens long, ids binary")
    return rows.join(before, "file").select(F.col("id").alias(id_col), (F.col("before") + F.col("here")).alias("start"), "n_tokens", "ids")


def op10_huffman_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark)
    write_tokens(table(spark, sf_dir, "documents"), folder)
    back = read_tokens(spark, folder)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op10_huffman_token_files": op10_huffman_token_files}
ORACLES: dict[str, str] = {}
