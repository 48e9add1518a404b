import itertools
import math
import random

import numpy as np
import pytest

from tessera.llm import langid, mixing, quality
from tessera.llm.common import fold_of


def reshared(sizes, weights):
    """Share, stop at twice the size, share again, until none is above."""
    left, target, open_ = 1.5 * sum(sizes), {}, set(range(len(sizes)))
    while open_:
        total = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / total >= 2 * sizes[i]}
        if not over:
            return target | {i: left * weights[i] / total for i in open_}
        for i in over:
            target[i] = 2 * sizes[i]
            left -= 2 * sizes[i]
        open_ -= over
    return target


def test_targets_and_taken(make_docs):
    rng = random.Random(5)
    docs, sizes = [], []
    names = [f"s{i}" for i in range(7)] + [None]
    for name in names:
        n = rng.randint(1, 12)
        docs += [(len(docs) + k, "w " * rng.randint(0, 40), None, name) for k in range(n)]
    rows = mixing.plan(make_docs(docs)).collect()
    order = sorted([n for n in names if n], key=lambda s: s.encode()) + [None]
    sizes = [sum(len(t.split()) for _, t, _, s in docs if s == name) for name in order]
    want = reshared(sizes, [5, 2, 1] * 3)
    by_id = {i: s for i, _, _, s in docs}
    for k, name in enumerate(order):
        own = [r for r in rows if by_id[r.doc_id] == name]
        assert all(math.isclose(r.target, want[k], rel_tol=1e-12) and r.source_size == sizes[k] for r in own)
        assert sum(r.taken for r in own) == int(want[k] + 1e-9)
        assert all(r.taken <= 2 * r.size for r in own)
    again = mixing.plan(make_docs(docs).repartition(7)).collect()
    assert sorted((r.doc_id, r.taken, r.position or -1) for r in again) == sorted((r.doc_id, r.taken, r.position or -1) for r in rows)


def test_time_inverts_the_schedule(spark):
    from pyspark.sql import functions as F

    knots = ((0.0, 1.0), (0.25, 3.0), (1.0, 0.5))
    shares = spark.createDataFrame([(x / 20,) for x in range(21)], "u double")
    got = shares.select("u", mixing.time_of(F.col("u"), F.lit(0), (knots,)).alias("t")).collect()
    grid = np.linspace(0, 1, 200001)
    w = np.interp(grid, [k[0] for k in knots], [k[1] for k in knots])
    area = np.r_[0, np.cumsum((w[1:] + w[:-1]) / 2)]
    area /= area[-1]
    for r in got:
        assert abs(np.interp(r.t, grid, area) - r.u) < 1e-4


def test_mix_repeats_whole_documents(edge):
    got = mixing.mix(edge)
    assert got.columns == [*edge.columns, "mix_position"] and got.count() >= 1
    rows = got.collect()
    assert [r.mix_position for r in rows] == sorted(r.mix_position for r in rows)


def test_mix_edge_cases(edge, make_docs):
    assert mixing.plan(edge).count() == 8 and mixing.plan(make_docs([])).count() == 0
    assert {r.taken for r in mixing.plan(make_docs([(1, None), (2, " ")])).collect()} == {0}


# ------------------------------------------------------------------ language


def test_ngrams_equal_brute_force():
    text = "Ab, cd! É1x"
    grams, some, _ = langid.ngrams([text])
    clean = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    while "  " in clean:
        clean = clean.replace("  ", " ")
    for n, (owner, _) in zip(langid.ORDERS, grams):
        want = [clean[i : i + n] for i in range(len(clean) - n + 1) if clean[i : i + n].strip()]
        assert len(owner) == len(want), (n, want)
    assert some.tolist() == [True]


class Shared:
    """What a worker sees of a broadcast value."""

    def __init__(self, value):
        self.value = value


def clean_of(text):
    return "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()


def grams_of(text):
    """Buckets of all n-grams of a text, from the definition."""
    clean, out = " " + " ".join(clean_of(text)) + " " * bool(clean_of(text)), []
    for n in (1, 2, 3, 4):
        for i in range(len(clean) - n + 1):
            if clean[i : i + n].strip():
                h = 0
                for c in clean[i : i + n]:
                    h = (h * 0x01000193 + ord(c)) % 2**32
                h = (h ^ n * 0x9E3779B1 % 2**32) * 0x85EBCA6B % 2**32
                out.append((h >> 15 ^ h) % 2**16)
    return out


TRAIN = [(1, "The cat sat, on the mat", "x"), (2, "le chat était là", "y"), (3, "der Hund läuft 12 m", "z"), (4, "the dog", "x"), (5, None, "x"), (6, "lost", None), (7, "un chien", "y")]


def brute_bayes(text):
    if not clean_of(text):
        return "und", 0.0
    langs, logs = "xyz", []
    for lang in langs:
        counts = np.full(2**16, 0.5)
        for _, t, own in TRAIN:
            if own == lang and t is not None:
                np.add.at(counts, grams_of(t), 1)
        logs.append(np.log(counts / counts.sum())[grams_of(text)].sum() / 4)
    p = np.exp(np.array(logs) - max(logs))
    return langs[int(np.argmax(logs))], 1 / p.sum()


@pytest.mark.parametrize("languages,chars", [(64, 1 << 19), (1, 5), (2, 16)])
def test_scores_equal_brute_force(spark, make_docs, monkeypatch, languages, chars):
    monkeypatch.setattr(langid, "CHARS", chars)
    model = langid.fit(make_docs(TRAIN), "lang", "text", "doc_id", shard_languages=languages)
    assert [x for names, _ in model for x in names] == ["x", "y", "z"]
    texts = ["The cat", "le chien était perdu", "Hund", "", None, "1 2", "qq xx", "a  b--c the the", "der la the  " * 9]
    names, scores = langid.score_texts(texts, model)
    for t, name, score in zip(texts, names, scores):
        assert (name, pytest.approx(score, rel=1e-4)) == brute_bayes(t)


def test_long_texts_have_the_n_grams_of_their_windows():
    rng = random.Random(4)
    for _ in range(200):
        texts = ["".join(rng.choices("ab É,1 ", k=rng.randint(0, 30))) for _ in range(rng.randint(1, 4))]
        for chars in (1, 3, 8):
            found = {i: [] for i in range(len(texts))}
            for first, _, grams, _ in langid.windows(texts, chars, 1 << 16):
                for owner, bucket in grams:
                    for o, x in zip(owner, bucket):
                        found[first + o].append(int(x))
            for i, t in enumerate(texts):
                want = sorted(grams_of(t)) if clean_of(t) else []
                assert sorted(found[i]) == want, (t, chars)


def test_batches_score_as_single_texts():
    model = [(["a", "b"], Shared(np.log(np.random.default_rng(1).dirichlet(np.ones(langid.BUCKETS), 2).T).astype(np.float32)))]
    texts = ["one two", "", None, "12", "drei, vier", "x"]
    names, scores = langid.score_texts(texts, model)
    for t, n, s in zip(texts, names, scores):
        one = langid.score_texts([t], model)
        assert (n, pytest.approx(s)) == (one[0][0], one[1][0])
    assert [n == "und" for n in names] == [False, True, True, True, False, False]


def test_language_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = langid.op1_language_id(spark, d).toPandas()
    truth = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    held = both[both.held_out]
    assert len(got) == len(truth) and (held.lang == held.lang_pred).mean() > 0.98
    assert all(h == (fold_of(i, 5) == 0) for i, h in zip(both.doc_id, both.held_out)) and got.score.between(0, 1).all()


def test_language_edge_cases(edge, make_docs):
    model = langid.fit(make_docs([(1, "alpha beta", "x"), (2, "gamma", "y"), (3, None, "x"), (4, "t", None)]), "lang", "text", "doc_id")
    assert [names for names, _ in model] == [["x", "y"]]
    got = {r.doc_id: r for r in langid.identify(edge, model, keep=("doc_id", "score"), score="lang_score").collect()}
    assert got[1].lang_pred == got[2].lang_pred == "und" and got[5].lang_pred == "x" and got[5].score == 2.0
    none = langid.fit(make_docs([]), "lang", "text", "doc_id")
    assert {r.lang_pred for r in langid.identify(edge, none).collect()} == {"und"}


# ------------------------------------------------------------------ quality


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    lines = np.array([3, 1, 5, 2])
    emit, trans = rng.normal(size=lines.sum()), rng.normal(size=(2, 2))
    p, pairs, logs = quality.forward_backward(emit, trans, lines)
    at = 0
    for n in lines:
        total, good, joint = 0.0, np.zeros(n), np.zeros((n, 2, 2))
        for y in itertools.product((0, 1), repeat=n):
            w = math.exp(sum(emit[at + i] for i in range(n) if y[i]) + sum(trans[y[i], y[i + 1]] for i in range(n - 1)))
            total += w
            good += np.array(y) * w
            for i in range(n - 1):
                joint[i, y[i], y[i + 1]] += w
        assert np.allclose(p[at : at + n], good / total) and np.allclose(pairs[at : at + n], joint / total)
        assert math.isclose(logs[at : at + n].sum(), math.log(total))
        at += n


def test_gradient_raises_the_likelihood():
    rng = np.random.default_rng(2)
    lines = np.array([4] * 50)
    y = np.repeat(rng.integers(0, 2, 50), 4)
    x = np.c_[y + 0.5 * rng.normal(size=200), np.ones(200)]
    w, trans = quality.fit_chain(x, y, lines, np.ones(50))
    p, _, _ = quality.forward_backward(x @ w, trans, lines)
    assert ((p > 0.5) == y).mean() > 0.95 and trans[0, 0] + trans[1, 1] > trans[0, 1] + trans[1, 0]


def test_line_features_do_not_depend_on_the_batch():
    texts = ["One line.\nTWO!! LINES!!\n", "", None, "a a a b | c\n\nx", "é ### $$$"]
    x, size, lines = quality.line_features(texts)
    assert lines.tolist() == [3, 1, 1, 3, 1]
    at = 0
    for t, n in zip(texts, lines):
        one = quality.line_features([t])
        assert np.allclose(one[0], x[at : at + n]) and np.allclose(one[1], size[at : at + n])
        at += n


def test_long_lines_add_up_over_segments(monkeypatch):
    texts = ["One line!! that is long, and 12 é.\nTWO|TWO #\n", "a" * 40, "b b b b b b b b b\n" + "c" * 30]
    whole = quality.line_features(texts)
    monkeypatch.setattr(quality, "CHARS", 8)
    cut = quality.line_features(texts)
    repeats = {k + 20 * i for k in (10, 11, 16) for i in range(3)}  # not across a cut
    same = [k for k in range(quality.FEATURES) if k not in repeats]
    assert np.allclose(whole[0][:, same], cut[0][:, same]) and (whole[1] == cut[1]).all() and (whole[2] == cut[2]).all()


def brute_line(line, before):
    """A line's own measures, from their definitions."""
    raw = line.encode()
    n, words = max(1, len(raw)), line.encode().split()
    share = lambda chars: sum(c in chars for c in raw) / n
    upper, symbol = share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share(b"#$%&*+/<=>@[\\]^_`{}~")
    pipe, high = share(b"|"), sum(c >= 128 for c in raw) / n
    same = [sum(a == b for a, b in zip(words, words[k:])) for k in (1, 2)]
    w = max(1, len(words))
    return [
        math.log1p(len(raw)) / 8, upper**0.5, upper, share(b"0123456789") ** 0.5, share(b".,;:?'\"()-") ** 0.5, pipe**0.5, share(b"!") ** 0.5, symbol**0.5, symbol, high, same[0] / w, same[1] / w, min(len(raw) / w, 40) / 10,
        line[-1:] in (".", "!", "?"), not raw, bool(raw) and before == line, same[0] > 0.2 * len(words), upper > 0.4, pipe > 0.02, symbol > 0.04,
    ]


def test_line_features_equal_their_definitions():
    texts = ["Some Text, here: 12!\nSome Text, here: 12!\n\n| A | B |\nx x x y x\nÉté #1 $$", "ALL CAPS HERE\nend."]
    x, size, lines = quality.line_features(texts)
    at = 0
    for t in texts:
        own = [brute_line(line, before) for line, before in zip(t.split("\n"), [None, *t.split("\n")])]
        none = [0] * 20
        want = [[*o, *(own[i - 1] if i else none), *(own[i + 1] if i + 1 < len(own) else none), i == 0, i + 1 == len(own), 1] for i, o in enumerate(own)]
        assert np.allclose(x[at : at + len(own)], np.array(want, float), atol=1e-6)
        at += len(own)


def test_document_score_is_the_length_weighted_mean_of_marginals():
    rng = np.random.default_rng(3)
    model = rng.normal(size=quality.FEATURES), rng.normal(size=(2, 2))
    texts = ["first line here\nSECOND!\n\nlast one | x", None]
    scores, _ = quality.score_texts(texts, model)
    for t, s in zip(texts, scores):
        x, size, _ = quality.line_features([t])
        emit, total, good = x @ model[0], 0.0, np.zeros(len(x))
        for y in itertools.product((0, 1), repeat=len(x)):
            w = math.exp(sum(e for e, k in zip(emit, y) if k) + sum(model[1][a, b] for a, b in zip(y, y[1:])))
            total, good = total + w, good + np.array(y) * w
        assert math.isclose(s, (good / total * size).sum() / size.sum(), rel_tol=1e-9)


def test_training_keeps_long_documents_and_one_text_an_id(spark, make_docs):
    long = "\n".join(f"line {i} of it." for i in range(500))
    docs = make_docs([(1, long), (2, "BAD BAD\n!!!! ####"), (2, "other"), *[(3, "Good text here.")] * 50])
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 1)], "doc_id long, quality int")
    w, trans = quality.fit(docs, labels)
    assert np.abs(w).sum() > 0
    assert (quality.fit(docs.repartition(5), labels)[0] == w).all()


def test_quality_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = quality.op5_line_quality(spark, d).toPandas()
    both = got.merge(spark.read.parquet(f"{d}/labels.parquet").toPandas(), on="doc_id")
    held = both[both.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_quality_edge_cases(spark, edge, make_docs):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (5, 0), (7, 1)], "doc_id long, quality int")
    model = quality.fit(edge, labels)
    got = quality.classify(edge, model, keep=("doc_id", "score"), score="q", lines="lines").collect()
    assert len(got) == 8 and all(0 <= r.q <= 1 for r in got) and {len(r.lines) for r in got if r.doc_id in (1, 2)} == {1}
    assert quality.classify(make_docs([]), quality.fit(make_docs([]), labels)).count() == 0
