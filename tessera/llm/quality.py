"""Document quality from a linear-chain CRF over lines.

Every line of a text is labelled good or bad. A line's features are its own
measures and those of the lines before and after it; the chain's transition
weights couple neighbouring labels. Forward-backward gives each line's marginal
probability of being good, and their mean, weighted by line length, is the
document's score.

Labels are for whole documents, lines have none. Training first gives every
line its document's label and fits the chain; then, in bad documents, the lines
that the fitted chain finds good (but never the worst line) are relabelled and
the chain is fitted again, so that a good line in a bad document doesn't count
against its like.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded, fold, size_runs, table, text_runs

#: Labelled documents of each label that training reads, about, at most.
TRAIN_DOCS = 1500
#: Successive lines that training reads of one document, at most. A longer
#: document gives a run of them from a place that its id decides.
TRAIN_LINES = 100
STEPS = 150
#: Training ends early when no part of the gradient is larger.
STILL = 1e-6
RATE = 0.1
RIDGE = 1e-3
THRESHOLD = 0.3
#: Characters whose lines are measured together; longer lines are measured in
#: segments of so many bytes.
CHARS = 1 << 19

_UPPER, _DIGIT, _END, _PIPE, _BANG, _SYMBOL, _SPACE, _HIGH = range(8)


def _classes() -> np.ndarray:
    kind = np.full(256, 255, np.uint8)
    for chars, k in ((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER), (b"0123456789", _DIGIT), (b".,;:?'\"()-", _END), (b"|", _PIPE), (b"!", _BANG), (b"#$%&*+/<=>@[\\]^_`{}~", _SYMBOL), (b" \t\r\x0b\x0c", _SPACE)):
        kind[list(chars)] = k
    kind[128:] = _HIGH
    return kind


_KIND = _classes()
_BASE = np.uint64(0x9E3779B97F4A7C15)
OWN = 20
FEATURES = 3 * OWN + 3


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span's bytes that doesn't depend on its place."""
    if not len(data):
        return np.zeros(len(start), np.uint64)
    powers = np.cumprod(np.full(len(data), _BASE, np.uint64))
    inverse = np.cumprod(np.full(len(data), np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64))
    sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers)]
    return (sums[end] - sums[start]) * inverse[np.minimum(start, len(data) - 1)]


def _measures(data: np.ndarray, start: np.ndarray, end: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sums over each segment of a window's bytes: of each class, words, words
    like the one before and the second before; and each segment's hash.

    inside: the window begins in the middle of a word."""
    kind = _KIND[data]

    def each(what: np.ndarray) -> np.ndarray:
        sums = np.r_[0, np.cumsum(what, dtype=np.int32)]
        return (sums[end] - sums[start]).astype(np.float64)

    counts = [each(kind == k) for k in (_UPPER, _DIGIT, _END, _PIPE, _BANG, _SYMBOL, _HIGH)]
    blank = (kind == _SPACE) | (data == 10)
    w0 = np.flatnonzero(~blank & np.r_[not inside, blank[:-1]])
    w1 = np.flatnonzero(np.r_[blank, True] & np.r_[False, ~blank])
    w1 = w1[len(w1) - len(w0) :]  # a word from before the window only ends in it
    at = np.searchsorted(start, w0, "right") - 1
    words = np.bincount(at, minlength=len(start)).astype(np.float64)
    same = [np.zeros(len(start)), np.zeros(len(start))]
    h = _hashes(data, w0, w1)
    for k in (1, 2):
        if len(w0) > k:
            same[k - 1] = np.bincount(at[k:][(h[k:] == h[:-k]) & (at[k:] == at[:-k])], minlength=len(start))
    return np.stack([*counts, words, *same], axis=1), _hashes(data, start, end)


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features [line, FEATURES], bytes of each line, lines of each text).

    Bytes are measured in windows. A line of more than ``CHARS`` bytes is cut
    into segments, whose measures add up; a word that crosses a cut is no
    repeat."""
    data = np.frombuffer("\n".join(t or "" for t in texts).encode("utf-8", "replace") + b"\n", np.uint8)
    breaks = np.flatnonzero(data == 10)
    start, end = np.r_[0, breaks[:-1] + 1], breaks
    lines = np.array([(t or "").count("\n") + 1 for t in texts])
    size = (end - start).astype(np.float64)
    pieces = np.maximum(1, -(-(end - start) // CHARS))
    line = np.repeat(np.arange(len(start)), pieces)
    place = np.arange(len(line)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    seg0 = start[line] + place * CHARS
    seg1 = np.minimum(seg0 + CHARS, end[line])
    sums, hashes = np.zeros((len(line), 10)), np.zeros(len(line), np.uint64)
    for a, b in size_runs((seg1 - seg0 + 1).tolist(), CHARS):
        lo, hi = int(seg0[a]), int(seg1[b - 1])
        inside = lo > 0 and data[lo - 1] != 10 and _KIND[data[lo - 1]] != _SPACE
        sums[a:b], hashes[a:b] = _measures(data[lo:hi], seg0[a:b] - lo, seg1[a:b] - lo, bool(inside))
    first = np.flatnonzero(place == 0)
    sums, whole = np.add.reduceat(sums, first, axis=0), hashes[first]
    for k in np.flatnonzero(pieces > 1):
        parts = hashes[first[k] : first[k] + pieces[k]].tolist()
        whole[k] = sum(h * pow(int(_BASE), CHARS * i, 1 << 64) for i, h in enumerate(parts)) % (1 << 64)
    counts, words, same1, same2 = sums[:, :7].T, sums[:, 7], sums[:, 8], sums[:, 9]
    again = np.r_[False, (whole[1:] == whole[:-1]) & (size[1:] == size[:-1]) & (size[1:] > 0)]
    full = np.maximum(size, 1)
    per_word = np.maximum(words, 1)
    stop = np.isin(data[np.maximum(end - 1, 0)], list(b".!?")) & (size > 0)
    own = np.stack([
        np.log1p(size) / 8, np.sqrt(counts[0] / full), counts[0] / full, np.sqrt(counts[1] / full), np.sqrt(counts[2] / full), np.sqrt(counts[3] / full), np.sqrt(counts[4] / full),
        np.sqrt(counts[5] / full), counts[5] / full, counts[6] / full, same1 / per_word, same2 / per_word, np.minimum(size / per_word, 40) / 10, stop, size == 0,
        again, same1 > 0.2 * words, counts[0] > 0.4 * full, counts[3] > 0.02 * full, counts[5] > 0.04 * full,
    ], axis=1).astype(np.float32)
    opens = np.zeros(len(start), bool)
    opens[np.cumsum(lines) - lines] = True
    closes = np.r_[opens[1:], True]
    before = np.where(opens[:, None], 0, np.roll(own, 1, axis=0))
    after = np.where(closes[:, None], 0, np.roll(own, -1, axis=0))
    features = np.hstack([own, before, after, opens[:, None], closes[:, None], np.ones((len(start), 1))]).astype(np.float32)
    return features, np.maximum(size, 1), lines


def forward_backward(emit: np.ndarray, trans: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of label 1, of each step's label pair, and log partition.

    emit: weight of label 1 against 0 for each line; trans [2, 2]; lines of each
    chain (at least 1), laid out one after another. All chains advance together.
    """
    order = np.argsort(-lines, kind="stable")
    start = (np.cumsum(lines) - lines)[order]
    sizes, longest = lines[order], int(lines.max(initial=0))
    active = np.searchsorted(-sizes, -np.arange(longest), "left")  # chains longer than t
    e = np.stack([np.zeros(len(emit)), np.clip(emit, -50, 50)], axis=1)
    top = e.max(axis=1)
    e = np.exp(e - top[:, None])
    a = np.exp(trans)
    alpha, scale = np.empty_like(e), np.empty(len(emit))
    for t in range(longest):
        at = start[: active[t]] + t
        f = e[at] if t == 0 else (alpha[at - 1] @ a) * e[at]
        scale[at] = s = f.sum(axis=1)
        alpha[at] = f / s[:, None]
    beta = np.ones_like(e)
    pairs = np.zeros((len(emit), 2, 2))
    for t in range(longest - 2, -1, -1):
        at = start[: active[t + 1]] + t
        back = e[at + 1] * beta[at + 1] / scale[at + 1][:, None]
        pairs[at] = alpha[at][:, :, None] * a * back[:, None, :]
        beta[at] = back @ a.T
    p = alpha * beta
    return (p[:, 1] / p.sum(axis=1)), pairs, np.log(scale) + top


def fit_chain(x: np.ndarray, y: np.ndarray, lines: np.ndarray, weight: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features and transitions: penalised likelihood, Adam.

    weight: of each chain, so that both labels count alike.
    """
    own = np.repeat(weight / lines, lines)
    inner = np.ones(len(y), bool)
    inner[np.cumsum(lines) - 1] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((len(y), 2, 2))
    seen[at, y[at], y[at + 1]] = 1
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, steps + 1):
        w, trans = theta[:-4], theta[-4:].reshape(2, 2)
        p, pairs, _ = forward_backward(x @ w.astype(x.dtype), trans, lines)
        grad = np.r_[(own * (y - p)).astype(x.dtype) @ x, (own[:, None, None] * (seen - pairs)).sum(axis=0).ravel()] / weight.sum() - RIDGE * theta
        if np.abs(grad).max() < STILL:
            break
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def train(x: np.ndarray, lines: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chain from documents' labels (0 or 1)."""
    if not len(label):
        return np.zeros(FEATURES), np.zeros((2, 2))
    share = np.array([max(1, (label == k).sum()) for k in (0, 1)]) / len(label)
    weight = 0.5 / share[label]
    y = np.repeat(label, lines)
    w, trans = fit_chain(x, y, lines, weight)
    if (label == 0).any() and (label == 1).any():
        p, _, _ = forward_backward(x @ w.astype(x.dtype), trans, lines)
        start = np.cumsum(lines) - lines
        worst = np.repeat(np.minimum.reduceat(p, start), lines)
        y = np.where((y == 0) & (p > 0.5) & (p > worst), 1, y)
        w, trans = fit_chain(x, y, lines, weight)
    return w, trans


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", *, train_docs: int = TRAIN_DOCS, train_lines: int = TRAIN_LINES) -> tuple[np.ndarray, np.ndarray]:
    """Train on a sample of labelled rows that is bounded at any scale: of each
    label's ids those that hash below ``train_docs`` / ids, one text of each
    id (the least by hash), and of a text at most ``train_lines`` successive
    lines with their features. Rows with a null label, id or text are not used."""
    labels = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y")).where("_id is not null and _y in (0, 1)").distinct()
    per = {int(r[0]): r[1] for r in labels.groupBy("_y").count().collect()}
    limit = F.when(F.col("_y") == 1, min(1.0, train_docs / per.get(1, 1))).otherwise(min(1.0, train_docs / per.get(0, 1)))
    few = labels.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) / F.lit(float(1 << 30)) < limit)
    # About 2 * train_docs ids, whatever the tables' size.
    texts = docs.where(F.col(text_col).isNotNull()).join(F.broadcast(few), F.col(id_col) == F.col("_id")).select("_y", "_id", F.col(text_col).cast("string").alias("_t"))
    sample = texts.groupBy("_y", "_id").agg(F.min_by("_t", F.struct(F.xxhash64("_t"), "_t")).alias("_t")).select("_y", "_t", F.col("_id").cast("string").alias("_id"))

    def run(batches):
        for batch in bounded(batches, 1):
            rows = []
            for y, text, key in zip(*(batch.column(k).to_pylist() for k in range(3))):
                x = line_features([text])[0]
                at = zlib.crc32(key.encode()) % max(1, len(x) - train_lines + 1)
                rows.append((int(y), key, x[at : at + train_lines].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.binary())], ["y", "id", "x"])

    rows = sorted(map(tuple, sample.mapInArrow(run, "y int, id string, x binary").collect()), key=lambda r: (r[1], r[0]))
    x = [np.frombuffer(r[2], np.float32).reshape(-1, FEATURES) for r in rows]
    flat = np.concatenate(x) if x else np.zeros((0, FEATURES), np.float32)
    return train(flat, np.array([len(k) for k in x], np.int64), np.array([r[0] for r in rows], np.int64))


def score_texts(texts: list[str | None], model: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each text's score and the marginals of its lines."""
    x, size, lines = line_features(texts)
    p, _, _ = forward_backward(x @ model[0], model[1], lines)
    start = np.cumsum(lines) - lines
    score = np.add.reduceat(p * size, start) / np.add.reduceat(size, start)
    return np.clip(score, 0.0, 1.0), np.split(p, start[1:])


def classify(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text_col: str = "text", keep: tuple[str, ...] = (), *, score: str = "score", lines: str | None = None) -> DataFrame:
    """Columns of ``keep`` with each whole text's score; with ``lines``, also
    every line's probability of being good.

    A null or empty text is one empty line. A line ends at a line feed. Repeated
    rows get equal scores; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    chosen = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text_col}`").cast("string").alias("_quality_text"))
    extra = [f"`{score}` double", *([f"`{lines}` array<double>"] if lines else [])]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema[:-1]), *extra])
    names = [*chosen.columns[:-1], score, *([lines] if lines else [])]

    def run(batches):
        for batch in bounded(batches, len(keep)):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for a, b in text_runs(texts, CHARS):
                value, marginals = score_texts(texts[a:b], shared.value)
                more = [pa.array([m.tolist() for m in marginals], pa.list_(pa.float64()))] if lines else []
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns[:-1], pa.array(value), *more], names)

    return chosen.mapInArrow(run, schema)


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(fold(F.col("doc_id"), 5) != 0))
    found = classify(docs, model, keep=("doc_id",))
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op5_line_quality": op5_line_quality}
ORACLES: dict[str, str] = {}
