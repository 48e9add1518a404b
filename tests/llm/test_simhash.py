import random
import re

import numpy as np
import xxhash

from tessera.llm import simhash
from tessera.llm.components import components


def brute_fingerprint(text):
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())) if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(fps):
    label = list(range(len(fps)))
    for i, a in enumerate(fps):
        for j in range(i):
            if bin(a ^ fps[j]).count("1") <= 3 and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def test_fingerprints(edge):
    for r in edge.collect():
        assert simhash.fingerprint(r.text) == brute_fingerprint(r.text)
    long = " ".join(str(i % 977) for i in range(70000))
    assert simhash.fingerprint(long) == brute_fingerprint(long)


def near_set(n, seed=1):
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        x = rng.choice(out)
        for b in rng.sample(range(64), rng.randint(0, 4)):
            x ^= 1 << b
        out.append(x)
    return sorted(set(out) | {0, 1, (1 << 64) - 1, (1 << 64) - 2})


def check_links(spark, fps, shard):
    frame = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    links = simhash.links(simhash.cells(frame, shard))
    root = {r.node: r.root for r in components(links).collect()}
    groups = {}
    for f in fps:
        groups.setdefault(root.get(simhash._signed(f), simhash._signed(f)), set()).add(f)
    want = {}
    for f, g in zip(fps, brute_groups(fps)):
        want.setdefault(g, set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_links_equal_brute_force(spark):
    check_links(spark, near_set(200), simhash.SHARD)


def test_hot_shards_are_split_without_loss(spark):
    base = random.Random(3).getrandbits(64)
    hot = sorted({base ^ (1 << a) ^ (1 << b) for a in range(26) for b in range(26)})
    check_links(spark, hot, 16)


def test_cells_emit_a_forest_not_all_pairs():
    fp = np.array([1 << b for b in range(60)], np.uint64)
    a, b = simhash.linked(np.zeros(60, np.int64), fp)
    assert len(a) == 59


def test_pivots_discard_only_distant_pairs():
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 1 << 63, (2, 500)).astype(np.uint64)
    d = np.bitwise_count(x ^ y)
    for p in simhash.reference_fingerprints():
        gap = np.abs(np.bitwise_count(x ^ p).astype(int) - np.bitwise_count(y ^ p).astype(int))
        assert (gap <= d).all()


def test_near_duplicates_edge_cases(edge, make_docs):
    got = simhash.near_duplicates(edge).collect()
    assert len(got) == 8
    by = {r.doc_id: r for r in got}
    assert by[1].component_id == by[2].component_id == by[3].component_id == 1 and by[1].fp == 0
    assert by[None].component_id == by[5].component_id == 5
    assert simhash.near_duplicates(make_docs([])).count() == 0
    alone = simhash.near_duplicates(make_docs([(None, "some words of it")])).first()
    assert alone.component_id is None


def test_chain_of_links(spark):
    chain = [0]
    for i in range(20):
        chain.append(chain[-1] ^ (7 << 3 * i))
    check_links(spark, sorted(chain), simhash.SHARD)
