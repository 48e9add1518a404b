import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__
from oracle import duck, rows
from tessera.llm import bloomlm, matroska, search, warc
from tessera.llm.common import fold_of

# ------------------------------------------------------------------ matroska


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 300_000), st.integers(0, 9))
def test_matroska_round_trip(n, seed):
    content = random.Random(seed).randbytes(n)
    data = matroska.mux(content)
    media = matroska.parse(data)
    payload, real = matroska.samples(data, media)
    assert payload[:real] == content and set(payload[real:]) <= {0} and len(payload) % 64 == 0 and payload
    assert all(data[at : at + 4] == b"\x1f\x43\xb6\x75" for _, _, at in media.cues) and len(media.cues) == len(media.clusters)
    assert [p.timestamp_ns for p in media.packets] == [k * 64_000_000 for k in range(len(media.packets))]


def file_of(*clusters, unknown=False):
    head = matroska.element(matroska.EBML, matroska.element(matroska.DOC_TYPE, b"webm"))
    body = b"".join(clusters)
    segment = matroska.SEGMENT.to_bytes(4, "big") + (b"\x01" + b"\xff" * 7 if unknown else matroska.vint(len(body)))
    return head + segment + body


def test_all_lacings_and_unknown_sizes():
    frames = [b"a" * 300, b"b" * 10, b"c" * 77]
    xiph = b"\x81\x00\x05\x02" + bytes([2, 255, 45, 10]) + b"".join(frames)
    signed = lambda v: (v + 8191 | 1 << 14).to_bytes(2, "big")
    ebml = b"\x81\x00\x06\x06" + bytes([2]) + matroska.vint(300) + signed(-290) + b"".join(frames)
    fixed = b"\x82\xff\xff\x84" + bytes([1]) + b"x" * 8
    inner = matroska.uint(matroska.TIMESTAMP, 100) + matroska.element(matroska.VOID, b"zz") + matroska.element(matroska.SIMPLE_BLOCK, xiph) + matroska.element(matroska.SIMPLE_BLOCK, ebml) + matroska.element(matroska.BLOCK_GROUP, matroska.element(matroska.BLOCK, fixed) + matroska.element(matroska.REFERENCE, b"\x01"))
    known = matroska.element(matroska.CLUSTER, inner)
    open_ = matroska.CLUSTER.to_bytes(4, "big") + b"\xff" + inner
    for data in (file_of(known, known), file_of(open_, open_, unknown=True), file_of(open_, known, unknown=True)):
        media = matroska.parse(data)
        assert len(media.clusters) == 2 and len(media.packets) == 16
        assert [data[p.start : p.start + p.length] for p in media.packets[:6]] == frames * 2
        assert [(p.track, p.timestamp_ns, p.key) for p in media.packets[6:8]] == [(2, 99_000_000, False)] * 2


def test_media_columns(edge, make_docs, spark):
    media = matroska.media_column(edge, keep=("doc_id", "id"))
    got = matroska.features(media, keep=("doc_id",)).collect()
    for r in got:
        text = next(x.text for x in edge.collect() if x.doc_id == r.doc_id)
        raw = (text or "").encode()
        assert r.n_bytes == len(raw) and r.payload_sha256 == hashlib.sha256(raw + bytes(r.payload_bytes - len(raw))).hexdigest()
    table = matroska.packets(media, keep=("doc_id",))
    assert table.where("doc_id = 7").count() == math.ceil(150016 / 512)
    odd = spark.createDataFrame([(1, None), (2, bytearray(b"no media")), (3, bytearray(b""))], "doc_id long, media binary")
    assert [(r.doc_id, r.error is not None) for r in matroska.packets(odd, keep=("doc_id",)).collect()] == [(2, True), (3, True)]
    whole = matroska.mux(b"abc")
    odd = odd.union(spark.createDataFrame([(4, bytearray(whole)), (5, bytearray(whole[:-20])), (6, bytearray(file_of()))], odd.schema))
    found = {r.doc_id: r for r in matroska.features(odd, keep=("doc_id",)).collect()}
    assert sorted(found) == [2, 3, 4, 5, 6] and [i for i in found if found[i].error is None] == [4]
    assert found[4].n_bytes == 3 and found[2].media_bytes == 8 and all(found[i].payload_sha256 is None for i in (2, 3, 5, 6))
    assert matroska.features(matroska.media_column(make_docs([]))).count() == 0


# ------------------------------------------------------------------ warc


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=9000), st.integers(1, 5000))
def test_chunked_framing(payload, size):
    assert warc.dechunked(warc.chunked(payload, size)) == payload


def test_chunk_extensions_and_damage():
    assert warc.dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nabc\r\n0\r\n\r\n")


def pages(spark, items):
    return spark.createDataFrame([(i, "http://x/ y", h, "clash", 1) for i, h in items], "page_id long, url string, html string, block string, payload_bytes int")


def test_archives(spark, tmp_path):
    long = "<p>é\r\n\r\nWARC/1.1\r\n" * 9000
    items = [(4, long), (2, long), (9, "a"), (None, "a"), (9, "a"), (5, None), (6, ""), (8, "\n"), (None, "lone")]
    warc.write_archives(pages(spark, items), f"file://{tmp_path}/w")
    got = warc.read_pages(spark, f"file://{tmp_path}/w").collect()
    assert len(got) == len(items) and all(r.error is None for r in got)
    seen = Counter((r.page_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to) for r in got)
    d = lambda s: (len((s or "").encode()), warc.digest((s or "").encode()))
    want = Counter([("4", "revisit", *d(long), "2"), ("2", "response", *d(long), None), ("9", "response", *d("a"), None), ("9", "response", *d("a"), None), (None, "revisit", *d("a"), "9"), ("5", "response", *d(""), None), ("6", "revisit", *d(""), "5"), ("8", "response", *d("\n"), None), (None, "response", *d("lone"), None)])
    assert seen == want
    first = warc.read_records(spark, f"file://{tmp_path}/w").collect()
    assert sum(r.headers["warc-type"] == "continuation" for r in first) >= 5


def test_segments_in_any_order_and_missing_ones(spark):
    made = [rec for i in (1, 2, 3) for rec in warc.records_for(i, "u", (f"{i}" * 50000).encode(), None)]
    parsed = [next(iter(warc.parse_archive(r))) for r in made]
    random.Random(1).shuffle(parsed)
    drop = next(k for k, (h, _) in enumerate(parsed) if h["x-page-id"] == "3" and h.get("warc-segment-number") == "2")
    parsed.pop(drop)
    records = spark.createDataFrame([(h, bytearray(b)) for h, b in parsed], "headers map<string,string>, block binary")
    got = {r.page_id: r for r in warc.decode(warc.reassemble(records)).collect()}
    assert got["1"].error is None and bytes(got["2"].payload) == b"2" * 50000 and "missing" in got["3"].error


def test_empty_archives(spark, tmp_path):
    warc.write_archives(pages(spark, []), f"file://{tmp_path}/e")
    assert warc.read_pages(spark, f"file://{tmp_path}/e").count() == 0


# ------------------------------------------------------------------ language model


def reference_model(texts, train):
    tok = lambda t: [w.lower() for w in (t or "").encode().split()] + [None]
    uni, pair = Counter(), Counter()
    for t in train:
        w = tok(t)
        uni.update(w)
        uni["start"] += 1
        pair.update(zip(["start", *w], w))
    n, v = sum(c for k, c in uni.items() if k != "start"), len(uni) - ("start" in uni)
    out = []
    for t in texts:
        w = tok(t)
        base = score = 0.0
        for a, b in zip(["start", *w], w):
            p = (uni[b] + 1) / (n + v + 1)
            base += math.log10(p)
            q = bloomlm.expected(bloomlm.quantised(np.array([pair[a, b]]))) [0] if pair[a, b] else 0.0
            q = min(q, uni[a], uni[b])
            score += math.log10((q + bloomlm.PRIOR * p) / (uni[a] + bloomlm.PRIOR))
        out.append((len(w), sum(uni[b] > 0 for b in w), n, base, score))
    return out


def test_scores_equal_a_dictionary_model(make_docs, edge):
    train = [(i, " ".join(random.Random(i).choices("the a cat dog Sat on mat ran".split(), k=30))) for i in range(40)]
    for frame in (make_docs(train + [(100, "The cat zzz sat"), (101, None)]), edge):
        got = sorted(bloomlm.score(frame, make_docs(train)).collect(), key=lambda r: (r.doc_id or -1, r.n_tokens))
        texts = sorted(((r.doc_id or -1, r.text) for r in frame.collect()), key=lambda r: (r[0], len((r[1] or "").split())))
        want = reference_model([t for _, t in texts], [t for _, t in train])
        for r, w in zip(got, want):
            assert (r.n_tokens, r.n_known, r.train_tokens) == w[:3]
            assert math.isclose(r.base_score, w[3], rel_tol=1e-12) and math.isclose(r.score, w[4], rel_tol=0.02)


def test_shards_give_the_same(make_docs, monkeypatch):
    monkeypatch.setattr(bloomlm, "RANGE_KEYS", 512)
    docs = make_docs([(i, " ".join(random.Random(i).choices([f"w{k}" for k in range(500)], k=200))) for i in range(60)] + [(99, None)])
    one = sorted(map(tuple, bloomlm.score(docs, docs).collect()))
    many = sorted(map(tuple, bloomlm.score(docs, docs, shard_bytes=20000, held_tokens=700, step_tokens=90).collect()))
    for a, b in zip(one, many, strict=True):
        assert a[:4] == b[:4] and np.allclose(a[4:], b[4:], rtol=1e-12)


def test_workers_map_the_model(spark):
    """A worker doesn't read a broadcast shard: neither once for each part of
    the texts, nor at all."""
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 3000)) * 2
    rows = [(0, keys.tobytes(), np.arange(len(keys)).tobytes(), bloomlm.make_filter(keys.astype(np.uint64) | np.uint64(1), np.full(len(keys), 3)).tobytes())]
    shared, whole = spark.sparkContext.broadcast(bloomlm.Ranges(rows, 63).packed()), bloomlm.Ranges(rows, 63)

    def run(batches):
        for batch in batches:
            model = bloomlm.opened(shared)
            base = model.words
            while isinstance(base, np.ndarray):
                base = base.base
            mapped = "mmap" in repr(getattr(base, "obj", base)) and model.words.flags.aligned and not hasattr(shared, "_value")
            ask = model.words.view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array([mapped]), pa.array([model.unigram(ask).tolist()]), pa.array([model.level(ask | np.uint64(1)).tolist()])], ["mapped", "counts", "levels"])

    got = spark.range(1).repartition(1).mapInArrow(run, "mapped boolean, counts array<long>, levels array<long>").first()
    assert got.mapped and got.counts == list(range(len(keys)))
    assert got.levels == whole.level(keys.astype(np.uint64) | np.uint64(1)).tolist() and min(got.levels) > 0
    assert bloomlm.Ranges.of(bloomlm.Ranges([], 63).packed()).unigram(keys[:3].view(np.uint64)).tolist() == [0, 0, 0]


def test_the_model_is_read_once(make_docs, spark, monkeypatch):
    """Jobs don't multiply with the shards of the model."""
    monkeypatch.setattr(bloomlm, "RANGE_KEYS", 512)
    docs = make_docs([(i, " ".join(random.Random(i).choices([f"w{k}" for k in range(500)], k=200))) for i in range(60)])
    ranges, shift = bloomlm.count_ranges(docs, "text")
    n, size = ranges.agg({"span": "count"}).first()[0], sum(len(r.words) + len(r.counts) + len(r["filter"]) for r in ranges.collect())
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for shard_bytes in (1 << 30, 1):
        spark.sparkContext.setJobGroup(f"shards {shard_bytes}", "")
        parts, spans = bloomlm.broadcast_shards(ranges, shift, size, shard_bytes)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs.append((len(parts), len(tracker.getJobIdsForGroup(f"shards {shard_bytes}"))))
        assert sorted(np.concatenate(spans).tolist()) == sorted(r.span for r in ranges.collect())
    assert [k for k, _ in jobs] == [1, n] and n > 8 and jobs[0][1] == jobs[1][1]


def test_filter_has_no_false_negatives():
    rng = np.random.default_rng(0)
    keys, counts = rng.integers(0, 1 << 62, 5000).astype(np.uint64) | np.uint64(1), rng.integers(1, 500, 5000)
    keys, at = np.unique(keys, return_index=True)
    counts = counts[at]
    made = bloomlm.Ranges([(0, b"", b"", bloomlm.make_filter(keys, counts).tobytes())], 63)
    assert (made.level(keys) >= bloomlm.quantised(counts)).all()
    other = rng.integers(0, 1 << 62, 5000).astype(np.uint64) | np.uint64(1)
    assert (made.level(other) > 0).mean() < 0.05


def test_quantised_counts_cover_their_middle():
    c = np.arange(1, 2000)
    q = bloomlm.quantised(c)
    assert (np.diff(q) >= 0).all() and (bloomlm.quantised(np.maximum(1, np.round(bloomlm.expected(q)))) == q).mean() > 0.99


def test_nothing_to_learn_from(make_docs, edge):
    got = bloomlm.score(edge, make_docs([])).collect()
    assert len(got) == 8 and {r.train_tokens for r in got} == {0} and {r.base_score for r in got} == {0.0}
    assert bloomlm.score(make_docs([]), edge).count() == 0


def test_model_beats_its_base_on_held_out(spark):
    got = bloomlm.op8_bloom_lm(spark, "/root/testdata/sf0.01").toPandas()
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum() and all(h == (fold_of(i, 7) == 2) for i, h in zip(got.doc_id, got.held_out))


# ------------------------------------------------------------------ search


def brute_bm25(docs, queries, k):
    tok = lambda t: (t or "").encode().lower().split()
    tf = [Counter(tok(t)) for _, t in docs]
    df = Counter(w for c in tf for w in c)
    mean = sum(sum(c.values()) for c in tf) / len(docs)
    out = []
    for qid, text in queries:
        words, scored = sorted(set(tok(text))), []
        for (i, _), c in zip(docs, tf):
            s = sum(math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.5 / (c[w] + 1.5 * (0.25 + 0.75 * sum(c.values()) / mean)) for w in words if c[w])
            if s > 0:
                scored.append((-round(s, 6), i))
        out += [(qid, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def searched(parts, asked, k, mean=None):
    """{query: [(document, score)]} of the shards, and (scored, all) blocks."""
    docs = [d for part in parts for d in part]
    tokens = [search.tokens_of([t for _, t in part]) for part in parts]
    mean = sum(len(keys) - len(sizes) for keys, sizes in tokens) / len(docs)
    shards = [search.build_shard(np.array([i for i, _ in part]), *t, mean) for part, t in zip(parts, tokens)]
    df = Counter()
    for s in shards:
        df.update(dict(zip(s["keys"].tolist(), search.document_counts(s).tolist())))
    held = []
    for i, t in asked:
        keys, _ = search.tokens_of([t])
        keys = np.unique(keys[keys != search.END])
        held.append((i, keys, np.array([df[x] for x in keys.tolist()], np.int64)))
    queries, best = search.gathered(held, len(docs)), search.Best(len(held), k)
    counts = np.sum([search.search_shard(s, queries, best) for s in shards], axis=0)
    got = {}
    for q, doc, score in zip(*best.rows()):
        got.setdefault(int(queries.ids[q]), []).append((int(doc), float(score)))
    return got, counts


@pytest.mark.parametrize("block,cells,long", [(64, 1 << 20, 32), (4, 64, 3), (2, 1, 1)])
def test_search_equals_brute_force(monkeypatch, block, cells, long):
    for name, value in (("BLOCK", block), ("CELLS", cells), ("LONG", long)):
        monkeypatch.setattr(search, name, value)
    rng = random.Random(7)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(3000)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60))).title() or None) for i in range(150)]
    asked = [d for d in docs if d[0] % 10 == 0] + [(999, "unheard words")]
    got, _ = searched((docs[:70], docs[70:71], docs[71:]), asked, 5)
    want = {}
    for q, _, doc, score in brute_bm25(docs, asked, 5):
        want.setdefault(q, []).append((doc, score))
    assert {q: [d for d, _ in v] for q, v in got.items()} == {q: [d for d, _ in v] for q, v in want.items()}
    assert all(math.isclose(a, b, abs_tol=2e-6) for q in want for (_, a), (_, b) in zip(got[q], want[q]))


def test_blocks_below_the_threshold_are_skipped(monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 2)
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choices([f"t{i % 20}w{k}" for k in range(40)] + ["the", "of"], k=50))) for i in range(400)]
    asked = docs[::37]
    got, (scored, seen) = searched((docs[:150], docs[150:]), asked, 3)
    want = {}
    for q, _, doc, _ in brute_bm25(docs, asked, 3):
        want.setdefault(q, []).append(doc)
    assert {q: [d for d, _ in v] for q, v in got.items()} == want
    assert scored < seen / 5


def test_memory_does_not_grow_with_the_queries(monkeypatch):
    """What a shard holds for the terms of a block's queries is bounded, and the
    queries' parts give the same results."""
    import tracemalloc

    r = random.Random(3)
    words = [f"w{k}" for k in range(2000)]
    docs = [(i, " ".join(r.choices(words, k=60))) for i in range(40)]
    keys, sizes = search.tokens_of([t for _, t in docs])
    shard = search.build_shard(np.array([i for i, _ in docs]), keys, sizes, 60.0)
    known = np.unique(keys[keys != search.END])
    rng = np.random.default_rng(4)
    asked = [(i, np.sort(rng.choice(known, rng.integers(300, 1000), replace=False))) for i in range(3000)]
    queries = search.gathered([(i, k, np.full(len(k), 2)) for i, k in asked], len(docs))
    found = []
    for part in (search.PART_TERMS, 5000):
        monkeypatch.setattr(search, "PART_TERMS", part)
        best = search.Best(len(asked), 5)
        tracemalloc.start()
        search.search_shard(shard, queries, best)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 12 * len(queries.term), peak / len(queries.term)
        found.append([x.tolist() for x in best.rows()])
    assert found[0] == found[1] and len(queries.term) > 1_500_000


def test_search_edge_cases(edge, make_docs):
    q = make_docs([(1, "Alpha"), (2, None), (None, "alpha"), (3, "word"), (1, "beta")])
    got = [(r.query_id, r["rank"], r.doc_id) for r in search.top_k(edge, q).collect()]
    assert sorted(got, key=str) == sorted([(1, 1, None), (1, 2, 5), (1, 3, 5), (3, 1, 7)], key=str)
    assert search.top_k(make_docs([]), q).count() == 0 and search.top_k(edge, make_docs([])).count() == 0


# ------------------------------------------------------------------ SQL


@pytest.mark.parametrize("name", ["op3_mix_sources", "op4_bm25_search", "op6_warc_archives"])
def test_sql(spark, sf, name):
    found = __spark_entry__.queries()[name](spark, sf).toPandas()
    want = duck(__spark_entry__.oracle_sql()[name], sf)
    assert sorted(found.columns) == sorted(want.columns) and rows(found) == rows(want)
