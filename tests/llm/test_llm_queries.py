"""Registered queries against brute force over whole tables."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__
from tessera.llm import huffman, matroska, packing, simhash
from tessera.llm.tokens import tokenizer_path
from test_simhash import brute_fingerprint, brute_groups


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").toPandas()


def library(name):
    tok = Tokenizer.from_file(tokenizer_path(name))
    tok.encode_special_tokens = True
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op2(spark, sf, docs):
    got = packing.op2_pack_sequences(spark, sf).toPandas()
    encode = library("word_bpe_49k.json")
    ids = {i: [*encode(t), 2] for i, t in zip(docs.doc_id, docs.text)}
    for doc, rows in got.groupby("doc_id"):
        at = 0
        for r in rows.sort_values("start").itertuples():
            assert r.start == at and r.doc_tokens == len(ids[doc]) and r.ids_crc32 == crc(ids[doc][at : at + r.length])
            at += r.length
        assert at == len(ids.pop(doc))
    assert not ids
    for _, rows in got.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert (rows.offset == rows.length.cumsum() - rows.length).all()
        n = int(rows.length.sum())
        assert n <= 4096 and n & (n - 1) == 0


def test_op7(spark, sf, docs):
    got = {r.doc_id: r for r in matroska.op7_matroska_media(spark, sf).collect()}
    assert len(got) == len(docs)
    for i, text in zip(docs.doc_id, docs.text):
        raw, r = (text or "").encode(), got[i]
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        media = matroska.mux(raw)
        x = np.frombuffer(payload, np.uint8).astype(float)
        frames = -(-len(payload) // 512)
        clusters = -(-frames // (8 * 32))
        crossings = sum((a >= 128) != (b >= 128) for a, b in zip(payload, payload[1:]))
        want = f"p{frames}.c{clusters}.q{clusters}.t{(frames - 1) * 64}.m{int(x.sum()) * 1000 // len(x)}.e{int(((x - 128) ** 2).sum() / len(x) * 1000)}.z{crossings * 1000 // len(x)}"
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.media_bytes, r.media_sha256, r.feature) == (len(media), hashlib.sha256(media).hexdigest(), want)


def test_op9(spark, sf, docs):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op9_simhash_groups(spark, sf).collect()}
    docs = docs.sort_values("doc_id")
    fps = [brute_fingerprint(t) for t in docs.text]
    group = defaultdict(list)
    for i, g in zip(docs.doc_id, brute_groups(fps)):
        group[g].append(i)
    least = {i: min(own) for own in group.values() for i in own}
    assert got == {i: (f"{fp:016x}", least[i]) for i, fp in zip(docs.doc_id, fps)}


def test_op10(spark, sf, docs):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in huffman.op10_huffman_token_files(spark, sf).collect()}
    encode, at, want = library("byte_bpe_50k.json"), 0, {}
    for i, t in sorted(zip(docs.doc_id, docs.text)):
        ids = [*encode(t), 0]
        want[i] = (at, len(ids), crc(ids))
        at += len(ids)
    assert got == want


def test_every_operator_has_a_query():
    names = [n for n in __spark_entry__.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
