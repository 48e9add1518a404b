"""Language-model scoring with a log-frequency Bloom filter.

Counting: each task hashes its words to 64 bits and pre-aggregates unigrams and
bigrams before the shuffle. The keys are cut into ranges of about ``RANGE_KEYS``;
each range's exact unigram counts become one sorted table, and its bigram counts
one Bloom filter: a count c is quantised to q = 1 + floor(log c), and the pairs
(key, 1) ... (key, q) are inserted (Talbot and Osborne, 2007).

Scoring: tables and filters are broadcast. A bigram's count is read by probing
for (key, 1), (key, 2), ... until one is missing; a bigram with an unknown word
is not probed, and no count exceeds those of its words. The smoothed
probability of w after v is (count(v w) + K * base(w)) / (count(v) + K).

What is held is bounded: beyond ``SHARD_BYTES`` of tables and filters the ranges
are divided into several broadcasts, so the driver makes one at a time. A worker
maps the files in which its executor keeps them instead of reading them: the
executor's workers share the pages, and only those that are asked for are
touched. Each key is asked of its own shard, so there is one pass over the texts
whatever the number of shards, with the same results, and the model is never
read again for the next texts. Long texts are looked up ``HELD_TOKENS`` and
scored ``STEP_TOKENS`` at a time. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import mmap
import pickle

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.serializers import pickle_protocol
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded, fold, table, text_runs, written

BASE = 1.5
HASHES = 4
BITS_PER_EVENT = 8
#: Weight of the unigram model, in observations of the word before.
PRIOR = 300.0
#: Keys of one range, about.
RANGE_KEYS = 1 << 18
#: Bytes of unigram tables and filters in one broadcast, about.
SHARD_BYTES = 48 << 20
#: Bytes of them that the driver fetches at once, about.
FETCHED = 4 << 20
#: Tokens whose counts are looked up in all shards together.
HELD_TOKENS = 1 << 18
STEP_TOKENS = 1 << 18
#: Bytes hashed at once.
WINDOW = 1 << 20
#: Characters of texts that are taken together, and tokens pre-aggregated together.
CHARS = 1 << 20
TOKENS = 1 << 20

_MULT = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
#: Begins a packed shard. Before it as many bytes as make its arrays lie at
#: multiples of eight in the file of a broadcast, behind the head of a pickle.
_MARK = b"tessera\0ranges\0\0"
_LEAST = 1 << 17
_PAD = bytes(-pickle.dumps(_MARK + bytes(_LEAST), pickle_protocol).find(_MARK) % 8)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


#: Unigram keys are even, bigram keys odd. No word has these two.
END, START = (mixed(np.array([k], np.uint64))[0] & np.uint64(2**64 - 2) for k in (1, 2))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _POWERS:
        inverse = np.uint64(pow(int(_MULT), -1, 1 << 64))
        _POWERS.clear()
        _POWERS[size] = np.cumprod(np.full(size, _MULT)), np.cumprod(np.full(size, inverse))
    return _POWERS[size]


def tokens_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(keys of all tokens, each text's words and then its end; tokens of each).

    Bytes are hashed ``WINDOW`` at a time, wherever that cuts texts or words,
    so that a very long text needs few bytes a word beside its own.
    """
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    begins = np.cumsum([0, *(len(r) + 1 for r in raw)])
    whole = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    del raw
    hashed, owner = [], []
    inside, part, length = False, 0, 0  # of a word that the last window cut
    for at in range(0, len(whole), WINDOW):
        data = _LOWER[whole[at : at + WINDOW]]
        blank = _BLANK[data]
        w0 = np.flatnonzero(~blank & np.r_[not inside, blank[:-1]])
        w1 = np.flatnonzero(blank & np.r_[inside, ~blank[:-1]])
        power, inverse = _powers(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
        if inside:
            n = int(w1[0]) if len(w1) else len(data)
            part = (part + int(sums[n]) * int(inverse[0]) * pow(int(_MULT), length, 1 << 64)) % (1 << 64)
            length += n
            if len(w1):
                hashed.append(np.array([part], np.uint64))
        ends = w1[1:] if inside else w1
        hashed.append((sums[ends] - sums[w0[: len(ends)]]) * inverse[w0[: len(ends)]])
        owner.append(np.searchsorted(begins, at + w1, "right") - 1)
        if len(w0) > len(ends):
            part, length = (int(sums[-1]) - int(sums[w0[-1]])) * int(inverse[w0[-1]]) % (1 << 64), len(data) - int(w0[-1])
        inside = not blank[-1]
    words, own = mixed(np.concatenate(hashed)) & np.uint64(2**64 - 2), np.concatenate(owner)
    sizes = np.bincount(own, minlength=len(texts)) + 1
    keys = np.full(len(words) + len(texts), END)
    keys[np.arange(len(words)) + own] = words
    return keys, sizes


def before(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The key before each token; the start key before a text's first."""
    out = np.r_[START, keys[:-1]]
    out[np.cumsum(sizes) - sizes] = START
    return out


def bigrams(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mixed(v * np.uint64(3) + (w >> np.uint64(1))) | np.uint64(1)


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable") if counts is not None else None
    keys = np.sort(keys) if order is None else keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    if order is None:
        return keys[first], np.diff(np.r_[first, len(keys)])
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


# ------------------------------------------------------------------ the filter


def quantised(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64)


def expected(q: np.ndarray) -> np.ndarray:
    """The middle of the counts that are quantised to q (0: none)."""
    low, high = np.ceil(BASE ** (q - 1.0) - 1e-9), np.maximum(np.ceil(BASE**q - 1e-9) - 1, 1)
    return np.where(q > 0, (low + np.maximum(low, high)) / 2, 0.0)


def positions(keys: np.ndarray, level: np.ndarray | int, bits: np.ndarray | int) -> np.ndarray:
    """[HASHES, keys] bits of the pairs (key, level) in a filter of so many."""
    h = mixed(keys + np.asarray(level, np.uint64) * _MULT)
    step = mixed(h) | np.uint64(1)
    bits = np.asarray(bits, np.uint64)
    return np.stack([((h + np.uint64(i) * step) >> np.uint64(11)) % bits for i in range(HASHES)]).astype(np.int64)


def make_filter(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bit array (bytes) of a range's bigrams; its length is in bytes."""
    q = quantised(counts) if len(counts) else np.zeros(0, np.int64)
    size = max(8, -(-int(q.sum()) * BITS_PER_EVENT // 8))
    bits = np.zeros(size * 8, bool)
    for level in range(1, int(q.max(initial=0)) + 1):
        bits[positions(keys[q >= level], level, size * 8)] = True
    return np.packbits(bits, bitorder="little")


class Ranges:
    """Tables and filters of some ranges, laid end to end."""

    def __init__(self, rows: list[tuple[int, bytes, bytes, bytes]], shift: int):
        self.shift = shift
        rows = sorted(rows)
        self.known = np.array([r[0] for r in rows], np.int64)
        words = [np.frombuffer(r[1], np.uint64) for r in rows]
        # Ranges ascend as signed numbers, and so do the keys inside them.
        self.words = (np.concatenate(words) if rows else np.zeros(0, np.uint64)).view(np.int64)
        self.counts = np.concatenate([np.frombuffer(r[2], np.int64) for r in rows]) if rows else np.zeros(0, np.int64)
        self.bits = np.concatenate([np.frombuffer(r[3], np.uint8) for r in rows]) if rows else np.zeros(0, np.uint8)
        self.size = np.array([len(r[3]) for r in rows], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def packed(self) -> bytes:
        """All arrays in one buffer, for ``of``."""
        arrays = [self.known, self.size, self.words, self.counts, self.bits]
        head = np.array([self.shift, *map(len, arrays)], np.int64)
        return b"".join([_PAD, _MARK, *(x.view(np.uint8).data for x in (head, *arrays)), bytes(_LEAST)])

    @classmethod
    def of(cls, raw) -> Ranges:
        """The ranges of a buffer that holds a packed shard near its beginning,
        as views of it."""
        made, at = cls.__new__(cls), raw.find(_MARK, 0, 1 << 10) + len(_MARK)
        head = np.frombuffer(raw, np.int64, 6, at)
        made.shift, at = int(head[0]), at + head.nbytes
        for name, n in zip(("known", "size", "words", "counts", "bits"), head[1:].tolist()):
            array = np.frombuffer(raw, np.uint8 if name == "bits" else np.int64, n, at)
            setattr(made, name, array)
            at += array.nbytes
        made.start = np.cumsum(made.size) - made.size
        return made

    def unigram(self, keys: np.ndarray) -> np.ndarray:
        """Exact counts; 0 for words of other ranges too. keys ascend (signed)."""
        at = np.minimum(np.searchsorted(self.words, keys.view(np.int64)), max(0, len(self.words) - 1))
        return np.where(self.words[at] == keys.view(np.int64), self.counts[at], 0) if len(self.words) else np.zeros(len(keys), np.int64)

    def level(self, keys: np.ndarray) -> np.ndarray:
        """Quantised counts of bigrams by repeated probes."""
        q = np.zeros(len(keys), np.int64)
        if not len(self.known):
            return q
        span = keys.view(np.int64) >> self.shift
        at = np.minimum(np.searchsorted(self.known, span), len(self.known) - 1)
        left = np.flatnonzero(self.known[at] == span)
        level = 0
        while len(left):
            level += 1
            r = at[left]
            bit = positions(keys[left], level, self.size[r] * 8)
            hit = np.ones(len(left), bool)
            for b in bit:
                b = b + self.start[r] * 8
                hit &= (self.bits[b >> 3] >> (b & 7).astype(np.uint8) & 1).astype(bool)
            left = left[hit]
            q[left] = level
        return q


def opened(shared: Broadcast) -> Ranges:
    """A broadcast packed shard, mapped from the executor's file of it. Without
    such a file (Spark sends broadcasts that it encrypts) it is the value's."""
    if not hasattr(shared, "_path"):
        return Ranges.of(shared.value)
    with open(shared._path, "rb") as f:
        return Ranges.of(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))


# ------------------------------------------------------------------ Spark


def count_ranges(docs: DataFrame, text_col: str) -> tuple[DataFrame, int]:
    """(range, words, counts, filter, types, tokens, texts) of every range, as a
    written table, and the shift that gives a key's range."""
    chosen = docs.select(F.col(text_col).cast("string").alias("text"))
    size = chosen.select(F.sum(F.octet_length("text") + 1)).first()[0] or 1
    # About six bytes a word, and a word and most of a bigram a token.
    wanted = max(1, int(size) // 4 // RANGE_KEYS)
    shift = 63 - min(40, max(0, (wanted - 1).bit_length()))

    def count(batches):
        held, n, texts = [], 0, 0

        def out():
            keys = np.concatenate([k for k, _ in held])
            v = np.concatenate([before(k, s) for k, s in held])
            made = [summed(keys), summed(bigrams(v, keys))]
            if texts:
                made.append((np.array([START]), np.array([texts])))
            key, c = (np.concatenate([m[i] for m in made]) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64) >> shift), pa.array(key.view(np.int64)), pa.array(c.astype(np.int64))], ["span", "key", "n"])

        for batch in bounded(batches, 0):
            values = batch.column(0).to_pylist()
            for a, b in text_runs(values, CHARS):
                held.append(tokens_of(values[a:b]))
                n, texts = n + len(held[-1][0]), texts + b - a
                if n >= TOKENS:
                    yield out()
                    held, n, texts = [], 0, 0
        if held:
            yield out()

    def build(batches):
        span, key, n = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out(sp, k, c):
            k, c = summed(k, c)
            rows = []
            for r in np.unique(k >> shift):
                own = (k >> shift) == r
                key, count = k[own].view(np.uint64), c[own]
                word = (key & np.uint64(1)) == 0
                real = word & (key != START)
                rows.append((int(r), key[word].tobytes(), count[word].tobytes(), make_filter(key[~word], count[~word]).tobytes(), int(real.sum()), int(count[real].sum())))
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["span", "words", "counts", "filter", "types", "tokens"])

        for batch in batches:
            span, key, n = (np.r_[x, batch.column(i).to_numpy()] for i, x in enumerate((span, key, n)))
            if len(span) >= 4 * RANGE_KEYS:
                cut = int(np.searchsorted(span, span[-1], "left"))  # the last range may go on
                if cut:
                    yield out(span[:cut], key[:cut], n[:cut])
                    span, key, n = span[cut:], key[cut:], n[cut:]
        if len(span):
            yield out(span, key, n)

    pairs = chosen.mapInArrow(count, "span long, key long, n long")
    built = pairs.repartition("span").sortWithinPartitions("span").mapInArrow(build, "span long, words binary, counts binary, filter binary, types long, tokens long")
    return written(built, "ranges"), shift


def broadcast_shards(ranges: DataFrame, shift: int, size: int, shard_bytes: int) -> tuple[list[Broadcast], list[np.ndarray]]:
    """Shards of about ``shard_bytes``, and the ranges that each has, from one
    reading of the table of ``size`` bytes: ranges join a shard as they come."""
    parts, spans, held, n = [], [], [], 0

    def share():
        made = Ranges(held, shift)
        held.clear()
        parts.append(ranges.sparkSession.sparkContext.broadcast(made.packed()))
        spans.append(made.known)

    rows = ranges.select("span", "words", "counts", "filter").coalesce(max(1, -(-size // FETCHED)))
    for span, *arrays in rows.toLocalIterator():  # the driver holds one shard at a time
        held.append((span, *map(bytes, arrays)))
        n += sum(map(len, arrays))
        if n >= shard_bytes:
            share()
            n = 0
    if held or not parts:
        share()
    return parts, spans


def score(docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, prior: float = PRIOR, shard_bytes: int = SHARD_BYTES, held_tokens: int = HELD_TOKENS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Score every text of ``docs`` by counts of ``train``.

    Columns: the id, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score`` (log10 probabilities).

    A null or empty text is its end token alone. Repeated rows count and are
    scored each. Nothing to learn from: every token is unknown (base 1 / 1).
    Other columns are not read.
    """
    spark = docs.sparkSession
    ranges, shift = count_ranges(train, text_col)
    n, v, size = (int(x or 0) for x in ranges.agg(F.sum("tokens"), F.sum("types"), F.sum(F.octet_length("words") + F.octet_length("counts") + F.octet_length("filter"))).first())
    parts, spans = broadcast_shards(ranges, shift, size, shard_bytes)
    shards = len(parts)
    owner, half = np.zeros(1 << 64 - shift, np.uint16), 1 << 63 - shift  # two bytes for each range
    for k, own in enumerate(spans):
        owner[own + half] = k
    place = spark.sparkContext.broadcast(owner)
    kind = docs.schema[id_col].dataType.simpleString()

    def dealt(keys: np.ndarray):
        """Each shard and where its own keys are, in their order."""
        if shards == 1:
            return [(0, slice(None))]
        of = place.value[(keys >> shift) + half]
        order = np.argsort(of, kind="stable")
        return enumerate(np.split(order, np.searchsorted(of[order], np.arange(1, shards))))

    def looked_up(models: list[Ranges], keys: np.ndarray, prev: np.ndarray) -> np.ndarray:
        """[3, token]: counts of the token and the one before, level of the pair."""
        distinct, inverse = np.unique(np.r_[keys, prev[:1], START].view(np.int64), return_inverse=True)
        counts = np.zeros(len(distinct), np.int64)
        for k, mine in dealt(distinct):  # each key is asked of its own shard only
            counts[mine] = models[k].unigram(distinct[mine].view(np.uint64))
        word, first, start = counts[inverse[:-2]], *counts[inverse[-2:]]
        last = np.where(prev == START, start, np.r_[first, word[:-1]])  # the one before is the last token, or none
        level = np.zeros(len(keys), np.int64)
        ask = np.flatnonzero((word > 0) & (last > 0))  # other pairs need no probe
        pairs = bigrams(prev[ask], keys[ask])
        for k, mine in dealt(pairs.view(np.int64)):
            level[ask[mine]] = models[k].level(pairs[mine])
        return np.stack([word, last, level])

    def run(batches):
        models = [opened(part) for part in parts]
        for batch in bounded(batches, 1):
            texts = batch.column(1).to_pylist()
            for a, b in text_runs(texts, CHARS):
                keys, sizes = tokens_of(texts[a:b])
                prev, owner = before(keys, sizes), np.repeat(np.arange(b - a, dtype=np.int32), sizes)
                known, totals = np.zeros(b - a, np.int64), np.zeros((2, b - a))
                for at in range(0, len(keys), held_tokens):
                    found = looked_up(models, keys[at : at + held_tokens], prev[at : at + held_tokens])
                    for lo in range(0, found.shape[1], step_tokens):
                        own, (word, last, level) = owner[at + lo : at + lo + step_tokens], found[:, lo : lo + step_tokens]
                        own = own[: len(word)]
                        base = (word + 1.0) / (n + v + 1)
                        pair = np.minimum(expected(level), np.minimum(word, last))
                        for k, p in enumerate((base, (pair + prior * base) / (last + prior))):
                            totals[k] += np.bincount(own, np.log10(p), b - a)
                        known += np.bincount(own[word > 0], minlength=b - a)
                cols = [pa.array(sizes.astype(np.int64)), pa.array(known), pa.array(np.full(b - a, n, np.int64)), *map(pa.array, totals)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *cols], ["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = chosen.mapInArrow(run, f"id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("id", id_col)


def op8_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(fold(F.col("doc_id"), 7) == 2, F.lit(False))
    found = score(docs, docs.where(~held))
    return found.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op8_bloom_lm": op8_bloom_lm}
ORACLES: dict[str, str] = {}
