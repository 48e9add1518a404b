import random

import corpus_pipeline
from tessera.llm import neardup, simhash

WORDS = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400)]


def copies(edits, families=12):
    """Texts of 100 words, and copies of them with some words changed."""
    out = []
    for f in range(families):
        r = random.Random(f)
        base = r.choices(WORDS, k=100)
        out.append((len(out), " ".join(base)))
        for n in edits:
            new = list(base)
            for at in r.sample(range(100), n):
                new[at] = f"new{f}x{n}x{at}"
            out.append((len(out), " ".join(new)))
    return out


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def groups(rows):
    """Least id of each row's component, by comparing all pairs."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if (not a and not b) or 5 * len(a & b) >= 4 * len(a | b) > 0:
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    least = {}
    for (i, _), r in zip(rows, root):
        least[r] = min(i, least.get(r, i))
    return sorted((i, least[r]) for (i, _), r in zip(rows, root))


def test_groups_equal_all_pairs(spark):
    rows = copies((1, 2, 2, 3, 3, 4, 5, 6, 8))
    rows += [(900, None), (901, ""), (902, " \t"), (903, "two words"), (904, "Two  WORDS"), (905, "two word"), (906, rows[0][1]), (906, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = groups(rows)
    assert 12 < len({c for _, c in want}) < len(rows) - 24
    for cell in (neardup.CELL, 4):  # 4: clusters are cut into chunk pairs
        assert sorted(map(tuple, neardup.near_duplicates(docs, cell=cell).collect())) == want


def test_stage_drops_near_copies(spark, tmp_path):
    rows = copies((2, 4))
    near = [(a, b) for (i, a), (j, b) in zip(rows, rows[1:]) if i % 3 == 0 and 5 * len(shingles(a) & shingles(b)) >= 4 * len(shingles(a) | shingles(b))]
    assert any(bin(simhash.fingerprint(a) ^ simhash.fingerprint(b)).count("1") > 3 for a, b in near)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, f"file://{tmp_path}")
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in groups(rows)})


def test_stage_links_by_fingerprints_and_by_shingles(spark):
    """One word of a long repetition is new every time: the fingerprints are
    near, the shingles differ. A third text joins by its shingles."""
    base = ["alpha", "beta", "gamma", "delta", "epsilon"] * 200
    first, second = base + WORDS[:60], base + WORDS[100:160]
    rows = [(3, " ".join(first)), (1, " ".join(second)), (2, " ".join(second + WORDS[200:203])), (4, " ".join(WORDS[300:390]))]
    fps = {i: simhash.fingerprint(t) for i, t in rows}
    assert bin(fps[3] ^ fps[1]).count("1") <= 3 and len(shingles(rows[0][1]) & shingles(rows[1][1])) * 5 < 4 * len(shingles(rows[0][1]) | shingles(rows[1][1]))
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()) == [1, 4]
