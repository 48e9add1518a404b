import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import packing
from tessera.llm.tokens import TextEncoder, encoder, tokenizer_path

TEXT = st.text(alphabet=st.sampled_from(list("aAbz E,.!'1 \n\t\r\x0b\x1c\x85 　éÉßΣσİǅ漢😀́|<>")), max_size=60)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_the_library(name):
    fast, library = TextEncoder(tokenizer_path(name)), TextEncoder(tokenizer_path(name), engine="tokenizers")
    assert fast.fast

    @settings(max_examples=300, deadline=None)
    @given(TEXT)
    def same(text):
        assert list(fast.encode([text])) == list(library.encode([text]))

    same()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_every_code_point_gives_the_library_s_ids(name):
    fast, library = TextEncoder(tokenizer_path(name)), TextEncoder(tokenizer_path(name), engine="tokenizers")
    points = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x32400), *range(0xE0000, 0xE0200)]]

    def differ(chars):
        text = "\n".join(f"a{c}1{c} {c}{c}!{c} x {c}b'{c} e{c}\u0301\u0323" for c in chars)
        if next(fast.encode([text])) == next(library.encode([text])):
            return []
        return chars if len(chars) == 1 else differ(chars[: len(chars) // 2]) + differ(chars[len(chars) // 2 :])

    for at in range(0, len(points), 4096):
        assert differ(points[at : at + 4096]) == []


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30))
def test_any_text_gives_the_library_s_ids(text):
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        fast, library = encoder(tokenizer_path(name)), encoder(tokenizer_path(name), "tokenizers")
        assert list(fast.encode([text])) == list(library.encode([text]))


def test_small_cache_gives_the_same():
    a, b = TextEncoder(tokenizer_path("word_bpe_49k.json"), cache_pieces=2), TextEncoder(tokenizer_path("word_bpe_49k.json"))
    texts = ["one two three one two", "three four"]
    assert list(a.encode(texts)) == list(b.encode(texts)) and len(a._one.__closure__) > 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_deal_fills_every_sequence(lengths):
    lengths = np.array(sorted(lengths, reverse=True), np.int64)
    used, got = defaultdict(list), defaultdict(int)
    for k, start, n, s, offset in packing.deal(lengths, 64):
        assert start == got[k]
        got[k] += n
        used[s].append((offset, n))
    assert [got[k] for k in range(len(lengths))] == lengths.tolist()
    for s, parts in used.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 64 or at & (at - 1) == 0


def test_descending_pieces_go_to_the_cheapest():
    dealt = list(packing.deal(np.array([40, 30, 20, 10, 28]), 64))
    assert [(k, s) for k, _, _, s, _ in dealt[:4]] == [(0, 0), (1, 1), (2, 1), (3, 0)]


def test_pack_covers_every_token(edge, spark):
    rows = packing.pack(edge, shard_bytes=20000).collect()
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = sorted((r.doc_id or -1, tuple(tok.encode(r.text or "", add_special_tokens=False).ids) + (2,)) for r in edge.collect())
    total = sum(len(w) for _, w in want)
    assert sum(r.length for r in rows) == total
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u2")
        assert len(ids) == r.length and zlib.crc32(ids.astype("<u4").tobytes()) == r.ids_crc32
    single = {i: w for i, w in want if i not in (5,)}
    for i, w in single.items():
        own = sorted((r.start, np.frombuffer(bytes(r.ids), "<u2").tolist()) for r in rows if (r.doc_id or -1) == i)
        assert sum((p for _, p in own), []) == list(w)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096 and (at == 4096 or at & (at - 1) == 0)


def test_empty_table(make_docs):
    assert packing.pack(make_docs([])).count() == 0
