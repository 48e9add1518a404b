import heapq
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import huffman
from tessera.llm.tokens import TextEncoder, tokenizer_path


def huffman_cost(counts):
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        s = heapq.heappop(heap) + heapq.heappop(heap)
        cost += s
        heapq.heappush(heap, s)
    return cost


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=2, max_size=80))
def test_code_lengths(counts):
    counts = np.array(counts)
    used = np.flatnonzero(counts)
    lengths = huffman.code_lengths(counts, 30)
    if len(used) > 1:
        assert int((lengths * counts).sum()) == huffman_cost(counts)
    short = huffman.code_lengths(counts, 7)
    assert short.max(initial=0) <= 7 and (short[used] > 0).all() and (short[counts == 0] == 0).all()
    assert sum(2.0 ** -int(x) for x in short[used]) <= 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=1500))
def test_blocks_round_trip(ids):
    ids = np.array(ids)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=41))
    docs = np.array([(1, len(ids), 0)], huffman.DOCS)
    made = huffman.block(3, 17, ids, docs, huffman.canonical(lengths), lengths) + b"\n"
    (file, first, n, got, marks, bits), = huffman.blocks_of(made)
    assert (file, first, n) == (3, 17, len(ids)) and got["n"].tolist() == [len(ids)]
    assert [h[:3] for h in huffman.heads_of(made)] == [(3, 17, len(ids))]
    out, = huffman.unpack([(n, marks, bits)], *huffman.decode_table(lengths))
    assert out.tolist() == ids.tolist()


def test_decoding_starts_at_any_checkpoint():
    ids = np.random.default_rng(0).integers(0, 300, 3000)
    lengths = huffman.code_lengths(np.bincount(ids))
    bits, begin = huffman.pack_bits(ids, huffman.canonical(lengths), lengths)
    marks = begin[:: huffman.CHECKPOINT].astype("<u4")
    tail, = huffman.unpack([(3000 - 5 * huffman.CHECKPOINT, marks[5:], bits)], *huffman.decode_table(lengths))
    assert tail.tolist() == ids[5 * huffman.CHECKPOINT :].tolist()


def test_more_ids_than_short_codes():
    n = 1 << 17
    ids = np.random.default_rng(1).permutation(n + 5)
    lengths = huffman.code_lengths(np.ones(n + 5), 18)
    assert lengths.max() == 18
    bits, begin = huffman.pack_bits(ids, huffman.canonical(lengths), lengths)
    out, = huffman.unpack([(len(ids), begin[:: huffman.CHECKPOINT].astype("<u4"), bits)], *huffman.decode_table(lengths, 18), 18)
    assert (out == ids).all()


def test_damaged_block_is_noticed():
    made = bytearray(huffman.block(0, 0, np.array([1, 2, 1]), np.array([(1, 3, 0)], huffman.DOCS), huffman.canonical(np.array([0, 1, 1])), np.array([0, 1, 1])))
    made[-1] ^= 1
    try:
        list(huffman.blocks_of(bytes(made)))
        raise AssertionError
    except ValueError:
        pass


def check(spark, docs, folder):
    huffman.write_tokens(docs, folder)
    got = [(r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in huffman.read_tokens(spark, folder).collect()]
    enc = TextEncoder(tokenizer_path("byte_bpe_50k.json"), engine="tokenizers")
    rows = [(r.doc_id, np.append(np.frombuffer(next(iter(enc.encode([r.text]))), "<u2"), 0).astype("<u4")) for r in docs.collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    want, at = [], 0
    for i, ids in rows:
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want


def test_files(spark, edge, tmp_path):
    check(spark, edge, f"file://{tmp_path}/a")


def test_long_document_spans_blocks(spark, make_docs, tmp_path):
    check(spark, make_docs([(2, "a b c d " * 40000), (1, "x"), (3, "y")]), f"file://{tmp_path}/b")


def test_empty_table(spark, make_docs, tmp_path):
    huffman.write_tokens(make_docs([]), f"file://{tmp_path}/c")
    assert huffman.read_tokens(spark, f"file://{tmp_path}/c").count() == 0
