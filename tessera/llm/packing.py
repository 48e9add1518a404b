"""Cost-balanced packing of documents into training sequences.

A piece of ``n`` tokens costs ``linear * n + quadratic * n ** 2`` (projections
and attention inside the piece). Pieces are dealt in descending order, each to
the sequence of lowest cost that still has room for it.

One global deal would need one task. Pieces are therefore spread by a hash
over shards of about ``shard_bytes`` of text each, and each shard deals its own
pieces among its own sequences. The number of shards follows the size of the
input, so a shard's task needs the same memory at any scale; a long document's
pieces, a hot source's rows and copies spread over all shards.

Documents that stand in an order (a curriculum's) keep it: their shards are then
runs of successive rows instead, and ascending sequence ids follow the order
from shard to shard; inside a shard pieces are dealt by length.

A shard has exactly as much room as tokens: sequences of ``capacity`` tokens
and, for the remainder, one shorter sequence for each binary digit (a sequence
whose length is a power of two is not padded). Only when no sequence has room
for a piece is the piece cut, to fill the sequence with the most room.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded, table
from tessera.llm.tokens import encoder, tokenizer_path

CAPACITY = 4096
#: UTF-8 bytes of text for each shard; a text has no more tokens than bytes.
SHARD_BYTES = 2 << 20
#: Attention over n tokens against the linear layers: n / (6 * model width).
QUADRATIC = 1 / (6 * 4096)
#: Bits of an ordered sequence id for the row of a file at which its shard
#: begins, and for shards that begin at the same row together with their sequences.
ROW_BITS, LOCAL_BITS = 24, 19


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def deal(lengths: np.ndarray, capacity: int = CAPACITY, linear: float = 1.0, quadratic: float = QUADRATIC) -> Iterator[tuple[int, int, int, int, int]]:
    """Yield (piece, start in it, length, sequence, offset) for descending pieces.

    ``lengths`` must be in descending order, each at most ``capacity``. Every
    token is dealt once and every sequence is filled to its own size.
    """
    total = int(lengths.sum())
    whole, rest = divmod(total, capacity)
    sizes = [capacity] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    size, room, cost = (np.array(sizes, dtype) for dtype in (np.int64, np.int64, np.float64))
    cost[:] = 0
    for k, n in enumerate(map(int, lengths)):
        start = 0
        while n:
            fits = np.flatnonzero(room >= n)
            if len(fits):
                s = int(fits[cost[fits].argmin()])
            else:
                most = np.flatnonzero(room == room.max())
                s = int(most[cost[most].argmin()])
            take = min(n, int(room[s]))
            yield k, start, take, s, int(size[s] - room[s])
            room[s] -= take
            cost[s] += linear * take + quadratic * take * take
            start, n = start + take, n - take


def token_pieces(docs: DataFrame, id_col: str, text_col: str, path: str, end_id: int, capacity: int, order: tuple[str, str] | None = None, run_tokens: int = 0) -> DataFrame:
    """Pieces of at most ``capacity`` ids, cut at multiples of it.

    Columns: the id, ``start``, ``ids`` (little-endian, 2 bytes each if the
    vocabulary allows), ``doc_tokens`` and ``spread``: a number for dealing or,
    with ``order`` (file, row), the first sequence id of the piece's run.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    arrow = pa.schema([("start", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("spread", pa.int64())])

    def run(batches):
        enc, seen = encoder(path), 0
        step, end = capacity * enc.dtype.itemsize, np.array([end_id], enc.dtype).tobytes()
        head = file = None  # first sequence id of the run, and its file
        held = sub = 0  # tokens of the run, runs that begin at the same row
        for batch in bounded(batches, 1, rows=1024):
            places = [batch.column(k).to_pylist() for k in (2, 3)] if order else None
            rows, start, ids, tokens, spread = [], [], [], [], []
            for r, raw in enumerate(enc.encode(batch.column(1).to_pylist())):
                raw += end
                for cut in range(0, len(raw), step):
                    rows.append(r)
                    start.append(cut // enc.dtype.itemsize)
                    ids.append(raw[cut : cut + step])
                    tokens.append(len(raw) // enc.dtype.itemsize)
                    if order:
                        now = places[0][r], places[1][r]
                        if now[0] != file or held >= run_tokens:
                            first = _first_id(*now)
                            sub = sub + 1 if head is not None and head >> LOCAL_BITS == first >> LOCAL_BITS else 0
                            head, file, held = first + sub * _locals(run_tokens, capacity), now[0], 0
                            if head >> LOCAL_BITS != first >> LOCAL_BITS:
                                raise ValueError(f"row {now[1]} of file {now[0]} is too long for an ordered sequence id")
                        held += len(ids[-1]) // enc.dtype.itemsize
                        spread.append(head)
                    else:  # the row's number parts repeated rows with equal ids
                        spread.append(zlib.crc32(b"%d %d" % (start[-1], seen), zlib.crc32(ids[-1])))
                seen += 1
            cols = [pa.array(c, f.type) for c, f in zip((start, ids, tokens, spread), arrow)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *cols], ["id", *arrow.names])

    schema = f"id {kind}, start long, ids binary, doc_tokens long, spread long"
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *(F.col(c).cast("long") for c in order or ()))
    return chosen.mapInArrow(run, schema)


def _first_id(file: int, row: int) -> int:
    if row >> ROW_BITS or file >> 63 - ROW_BITS - LOCAL_BITS:
        raise ValueError(f"file {file} or row {row} is too large for an ordered sequence id")
    return (file << ROW_BITS | row) << LOCAL_BITS


def _locals(run_tokens: int, capacity: int) -> int:
    """Sequences of a run at most: it may exceed its size by one piece, and its
    remainder takes a sequence for each binary digit."""
    return -(-run_tokens // capacity) + 1 + capacity.bit_length()


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tokenizer: str | None = None, end_id: int = 2, capacity: int = CAPACITY, shard_bytes: int = SHARD_BYTES, linear: float = 1.0, quadratic: float = QUADRATIC, order: tuple[str, str] | None = None) -> DataFrame:
    """Pack every document; one row per piece, with its ids.

    Columns: the document's id (under ``id_col``), ``start`` and ``length`` of
    the piece in its document, ``doc_tokens``, ``ids`` (little-endian binary),
    ``ids_crc32``, ``sequence_id``, ``offset`` in the sequence,
    ``sequence_tokens`` and ``sequence_cost``.

    A null or empty text is its end id alone. Null and repeated ids are kept;
    each row is a document of its own. An empty table gives no rows. Other
    columns of ``docs`` are not read. Equal lengths are dealt by id, start and
    content. Which shard a piece goes to, and so ``sequence_id`` and the cuts,
    also depends on how the input is split into tasks.

    order: columns (file, row) of non-negative numbers in which the rows of
    each partition ascend, file by file. Shards are then runs of successive
    rows of about ``shard_bytes`` / 4 tokens, and sequence ids ascend with
    (file, row) from run to run.
    """
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    kind = docs.schema[id_col].dataType.simpleString()
    dtype = encoder(path).dtype
    pieces = token_pieces(docs, id_col, text_col, path, end_id, capacity, order, max(1, shard_bytes // 4))
    if order:
        sharded = pieces.withColumn("shard", F.col("spread"))
    else:
        size = docs.select(F.sum(F.octet_length(F.col(text_col).cast("string")) + 1)).first()[0] or 1
        sharded = pieces.withColumn("shard", F.shiftleft(F.pmod("spread", F.lit(-(-int(size) // shard_bytes))).cast("long"), 24))

    def deal_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows["n"] = rows["ids"].map(len) // dtype.itemsize
        rows = rows.sort_values(["n", "id", "start", "spread"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
        dealt = pd.DataFrame(deal(rows["n"].to_numpy(), capacity, linear, quadratic), columns=["row", "cut", "length", "local", "offset"], dtype="int64")
        src = rows.iloc[dealt["row"].to_numpy()].reset_index(drop=True)
        ids = [b[c * dtype.itemsize : (c + n) * dtype.itemsize] for b, c, n in zip(src["ids"], dealt["cut"], dealt["length"])]
        cost = linear * dealt["length"] + quadratic * dealt["length"] ** 2.0
        return pd.DataFrame({
            "id": src["id"], "start": src["start"] + dealt["cut"], "length": dealt["length"], "doc_tokens": src["doc_tokens"], "ids": ids,
            "ids_crc32": [ids_crc32(np.frombuffer(b, dtype)) for b in ids], "sequence_id": int(key[0]) + dealt["local"], "offset": dealt["offset"],
            "sequence_tokens": dealt["length"].groupby(dealt["local"]).transform("sum"), "sequence_cost": cost.groupby(dealt["local"]).transform("sum"),
        })

    schema = f"id {kind}, start long, length long, doc_tokens long, ids binary, ids_crc32 long, sequence_id long, offset long, sequence_tokens long, sequence_cost double"
    return sharded.groupBy("shard").applyInPandas(deal_shard, schema).withColumnRenamed("id", id_col)


def op2_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "sequence_cost")


QUERIES = {"op2_pack_sequences": op2_pack_sequences}
ORACLES: dict[str, str] = {}
