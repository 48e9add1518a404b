"""Matroska media columns: packet tables from stored bytes, and a writer.

``parse`` walks the variable-length EBML elements of a Matroska file: header,
segment information, tracks, clusters with simple blocks and block groups (all
four kinds of lacing), and cues. It gives a packet table: track, timestamp,
key flag and the byte range of every frame. Sizes may be unknown (live files);
void, checksum and unknown elements are passed over.

``mux`` stores bytes losslessly as one track of unsigned 8-bit samples: laced
frames in clusters, a cue for each cluster, and the padding of the last frame
marked, so that readers know how many samples count.

Element numbers and the lacing rules are fixed values of the Matroska
specification (RFC 9559) and EBML (RFC 8794).
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded, table

EBML, VOID, CRC = 0x1A45DFA3, 0xEC, 0xBF
EBML_VERSION, EBML_READ_VERSION, EBML_MAX_ID, EBML_MAX_SIZE, DOC_TYPE, DOC_VERSION, DOC_READ_VERSION = 0x4286, 0x42F7, 0x42F2, 0x42F3, 0x4282, 0x4287, 0x4285
SEGMENT, INFO, TIMESTAMP_SCALE, DURATION, MUXING_APP, WRITING_APP = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACKS, TRACK, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x86
DEFAULT_DURATION, AUDIO, SAMPLING, CHANNELS, BIT_DEPTH = 0x23E383, 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, REFERENCE, DISCARD_PADDING = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1, 0xFB, 0x75A2
CUES, CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
TOP_LEVEL = {SEGMENT, INFO, TRACKS, CLUSTER, CUES, 0x114D9B74, 0x1254C367, 0x1043A770, 0x1941A469}

RATE = 8000
FRAME = 512
LACE = 8
BLOCKS = 32
PAD = 64


# ------------------------------------------------------------------ reading


@dataclass
class Packet:
    track: int
    timestamp_ns: int
    key: bool
    start: int
    length: int
    cluster: int


@dataclass
class Media:
    doc_type: str = ""
    scale: int = 1_000_000
    duration: float | None = None
    tracks: dict[int, dict] = field(default_factory=dict)
    packets: list[Packet] = field(default_factory=list)
    cues: list[tuple[int, int, int]] = field(default_factory=list)  # time ns, track, cluster's byte
    clusters: list[int] = field(default_factory=list)
    discard_ns: int = 0


def read_id(data: bytes, at: int) -> tuple[int, int]:
    width = 9 - data[at].bit_length()
    if width > 4 or at + width > len(data):
        raise ValueError(f"no element id at byte {at}")
    return int.from_bytes(data[at : at + width], "big"), at + width


def read_size(data: bytes, at: int) -> tuple[int | None, int]:
    """(size, next byte); None: unknown size (all bits set)."""
    if at >= len(data) or not data[at]:
        raise ValueError(f"no element size at byte {at}")
    width = 9 - data[at].bit_length()
    if at + width > len(data):
        raise ValueError(f"cut element size at byte {at}")
    value = int.from_bytes(data[at : at + width], "big") & ((1 << 7 * width) - 1)
    return (None if value == (1 << 7 * width) - 1 else value), at + width


def children(data: bytes, at: int, end: int, unknown: bool = False):
    """(id, start, end, unknown) of each element from ``at`` on. With
    ``unknown``, the parent ends where an element of its own level begins."""
    while at < end:
        begin = at
        kind, at = read_id(data, at)
        if unknown and kind in TOP_LEVEL:
            return begin
        size, at = read_size(data, at)
        if size is not None and at + size > end:
            raise ValueError(f"element at byte {begin} runs past its parent")
        stop = end if size is None else at + size
        jump = yield kind, at, stop, size is None
        at = jump if jump is not None else stop
    return end


def _uint(data: bytes, a: int, b: int) -> int:
    return int.from_bytes(data[a:b], "big")


def _float(data: bytes, a: int, b: int) -> float:
    return struct.unpack(">f" if b - a == 4 else ">d", data[a:b])[0] if b > a else 0.0


def laced(data: bytes, at: int, end: int, lacing: int) -> list[tuple[int, int]]:
    """Byte ranges of a block's frames: 0 none, 1 Xiph, 2 fixed, 3 EBML."""
    if not lacing:
        return [(at, end - at)]
    if at >= end:
        raise ValueError("a laced block without a frame count")
    n, at = data[at] + 1, at + 1
    if lacing == 2:
        size, rest = divmod(end - at, n)
        if rest:
            raise ValueError("frames of unequal size in fixed lacing")
        return [(at + k * size, size) for k in range(n)]
    sizes = []
    for k in range(n - 1):
        if lacing == 1:
            size = 0
            while True:
                size, more, at = size + data[at], data[at] == 255, at + 1
                if not more:
                    break
        else:
            value, then = read_size(data, at)
            value = (1 << 7 * (then - at)) - 1 if value is None else value
            # After the first, sizes are signed differences around the middle.
            size = value if not k else sizes[-1] + value - ((1 << (7 * (then - at) - 1)) - 1)
            at = then
        sizes.append(size)
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("lace sizes exceed their block")
    out = []
    for size in sizes:
        out.append((at, size))
        at += size
    return out


def _block(media: Media, data: bytes, a: int, b: int, base: int, key: bool | None) -> None:
    track, a = read_size(data, a)
    if b - a < 3:
        raise ValueError("a block without a header")
    time, flags = struct.unpack_from(">hB", data, a)
    key = bool(flags & 0x80) if key is None else key
    step = media.tracks.get(track, {}).get("default_duration", 0)
    for k, (start, length) in enumerate(laced(data, a + 3, b, flags >> 1 & 3)):
        media.packets.append(Packet(track, (base + time) * media.scale + k * step, key, start, length, len(media.clusters) - 1))


def _cluster(media: Media, data: bytes, a: int, b: int, unknown: bool) -> int:
    base, walk, jump = 0, children(data, a, b, unknown), None
    while True:
        try:
            kind, s, e, _ = walk.send(jump)
        except StopIteration as stop:
            return stop.value
        if kind == TIMESTAMP:
            base = _uint(data, s, e)
        elif kind == SIMPLE_BLOCK:
            _block(media, data, s, e, base, None)
        elif kind == BLOCK_GROUP:
            inner = {k: (x, y) for k, x, y, _ in children(data, s, e)}
            if BLOCK in inner:
                _block(media, data, *inner[BLOCK], base, REFERENCE not in inner)
            if DISCARD_PADDING in inner:
                x, y = inner[DISCARD_PADDING]
                media.discard_ns += int.from_bytes(data[x:y], "big", signed=True)


def _track(data: bytes, a: int, b: int) -> tuple[int, dict]:
    number, out = 0, {}
    for kind, s, e, _ in children(data, a, b):
        if kind == TRACK_NUMBER:
            number = _uint(data, s, e)
        elif kind == TRACK_TYPE:
            out["type"] = _uint(data, s, e)
        elif kind == CODEC:
            out["codec"] = data[s:e].decode("ascii", "replace").rstrip("\0")
        elif kind == DEFAULT_DURATION:
            out["default_duration"] = _uint(data, s, e)
        elif kind == AUDIO:
            for k, x, y, _ in children(data, s, e):
                if k == SAMPLING:
                    out["rate"] = _float(data, x, y)
                elif k in (CHANNELS, BIT_DEPTH):
                    out["channels" if k == CHANNELS else "bits"] = _uint(data, x, y)
    return number, out


def _cue(media: Media, data: bytes, a: int, b: int, base: int) -> None:
    time = 0
    for kind, s, e, _ in children(data, a, b):
        if kind == CUE_TIME:
            time = _uint(data, s, e) * media.scale
        elif kind == CUE_POSITIONS:
            at = {k: _uint(data, x, y) for k, x, y, _ in children(data, s, e)}
            media.cues.append((time, at.get(CUE_TRACK, 0), base + at.get(CUE_CLUSTER, 0)))


def parse(data: bytes) -> Media:
    """The packet table of a whole file; ValueError if it isn't well formed."""
    media = Media()
    for kind, a, b, _ in children(data, 0, len(data)):
        if kind == EBML:
            for k, s, e, _ in children(data, a, b):
                if k == DOC_TYPE:
                    media.doc_type = data[s:e].decode("ascii", "replace").rstrip("\0")
        elif kind == SEGMENT:
            walk, jump = children(data, a, b), None
            while True:
                try:
                    k, s, e, open_end = walk.send(jump)
                except StopIteration:
                    break
                jump = None
                if k == INFO:
                    for x, p, q, _ in children(data, s, e):
                        if x == TIMESTAMP_SCALE:
                            media.scale = _uint(data, p, q)
                        elif x == DURATION:
                            media.duration = _float(data, p, q)
                elif k == TRACKS:
                    media.tracks |= dict(_track(data, p, q) for x, p, q, _ in children(data, s, e) if x == TRACK)
                elif k == CLUSTER:
                    media.clusters.append(s)
                    jump = _cluster(media, data, s, e, open_end)
                elif k == CUES:
                    for x, p, q, _ in children(data, s, e):
                        if x == CUE_POINT:
                            _cue(media, data, p, q, a)
    if not media.doc_type:
        raise ValueError("no EBML header")
    return media


# ------------------------------------------------------------------ writing


def vint(value: int) -> bytes:
    width = 1
    while value >= (1 << 7 * width) - 1:
        width += 1
    return (value | 1 << 7 * width).to_bytes(width, "big")


def element(kind: int, body: bytes) -> bytes:
    return kind.to_bytes((kind.bit_length() + 7) // 8, "big") + vint(len(body)) + body


def uint(kind: int, value: int) -> bytes:
    return element(kind, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def _lace(frames: list[bytes]) -> tuple[int, bytes]:
    """(lacing flag, count and sizes) for the frames of a block."""
    if len(frames) == 1:
        return 0, b""
    if len({len(f) for f in frames}) == 1:
        return 0x04, bytes([len(frames) - 1])
    sizes = [len(f) for f in frames]
    head = bytes([len(frames) - 1]) + vint(sizes[0])
    for last, size in zip(sizes, sizes[1:-1]):
        step, width = size - last, 1
        while abs(step) > (1 << (7 * width - 1)) - 1:
            width += 1
        head += (step + (1 << (7 * width - 1)) - 1 | 1 << 7 * width).to_bytes(width, "big")
    return 0x06, head


_HEADER = element(EBML, uint(EBML_VERSION, 1) + uint(EBML_READ_VERSION, 1) + uint(EBML_MAX_ID, 4) + uint(EBML_MAX_SIZE, 8) + element(DOC_TYPE, b"matroska") + uint(DOC_VERSION, 4) + uint(DOC_READ_VERSION, 4))
_TRACKS = element(TRACKS, element(TRACK, uint(TRACK_NUMBER, 1) + uint(TRACK_UID, 1) + uint(TRACK_TYPE, 2) + element(CODEC, b"A_PCM/INT/LIT") + uint(DEFAULT_DURATION, FRAME * 1_000_000_000 // RATE) + element(AUDIO, element(SAMPLING, struct.pack(">d", RATE)) + uint(CHANNELS, 1) + uint(BIT_DEPTH, 8))))


def mux(content: bytes, pad: int = PAD) -> bytes:
    """A Matroska file whose only track holds ``content`` as 8-bit samples,
    zeros added up to a positive multiple of ``pad``."""
    payload = content + bytes(-len(content) % pad or (pad if not content else 0))
    extra = len(payload) - len(content)
    info = element(INFO, uint(TIMESTAMP_SCALE, 1_000_000) + element(DURATION, struct.pack(">d", len(payload) * 1000 / RATE)) + element(MUXING_APP, b"tessera") + element(WRITING_APP, b"tessera"))
    body, cues, per_cluster = [info, _TRACKS], [], FRAME * LACE * BLOCKS
    at = len(info) + len(_TRACKS)
    for c in range(0, len(payload), per_cluster):
        time, parts = c * 1000 // RATE, []
        for b in range(c, min(c + per_cluster, len(payload)), FRAME * LACE):
            frames = [payload[i : i + FRAME] for i in range(b, min(b + FRAME * LACE, len(payload)), FRAME)]
            flag, head = _lace(frames)
            block = b"\x81" + struct.pack(">hB", b * 1000 // RATE - time, flag | 0x80) + head + b"".join(frames)
            if b + FRAME * LACE >= len(payload) and extra:
                ns = extra * 1_000_000_000 // RATE
                block = block[:3] + bytes([flag]) + block[4:]
                parts.append(element(BLOCK_GROUP, element(BLOCK, block) + element(DISCARD_PADDING, ns.to_bytes(ns.bit_length() // 8 + 1, "big", signed=True))))
            else:
                parts.append(element(SIMPLE_BLOCK, block))
        cluster = element(CLUSTER, uint(TIMESTAMP, time) + b"".join(parts))
        cues.append(element(CUE_POINT, uint(CUE_TIME, time) + element(CUE_POSITIONS, uint(CUE_TRACK, 1) + uint(CUE_CLUSTER, at))))
        body.append(cluster)
        at += len(cluster)
    return _HEADER + element(SEGMENT, b"".join(body) + element(CUES, b"".join(cues)))


# ------------------------------------------------------------------ columns


def _mapped(df: DataFrame, col: str, keep: tuple[str, ...], fields: list[tuple[str, str, pa.DataType]], make) -> DataFrame:
    """Columns of ``keep`` and the rows that ``make(value)`` yields for each."""
    chosen = df.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{col}`").alias("_media_value"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema[:-1]), *(f"`{n}` {t}" for n, t, _ in fields)])
    names = [*chosen.columns[:-1], *(n for n, _, _ in fields)]

    def run(batches):
        for batch in bounded(batches, len(names) - len(fields), rows=256):
            rows, made = [], []
            for r, value in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                for row in make(value):
                    rows.append(r)
                    made.append(row)
            cols = [pa.array([m[k] for m in made], t) for k, (_, _, t) in enumerate(fields)]
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(rows, pa.int64())) for c in batch.columns[:-1]), *cols], names)

    return chosen.mapInArrow(run, schema)


def media_column(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = (), media: str = "media") -> DataFrame:
    """``keep`` and each text, as UTF-8, in a Matroska file (null: empty)."""
    return _mapped(df, text_col, keep, [(media, "binary", pa.binary())], lambda t: [(mux((t or "").encode("utf-8", "replace")),)])


def packets(df: DataFrame, media_col: str = "media", keep: tuple[str, ...] = ()) -> DataFrame:
    """The packet table of a media column: one row for each frame.

    Columns: ``keep``, ``packet`` (from 0), ``track``, ``timestamp_ns``,
    ``key``, ``start`` and ``length`` (byte range in the file), ``cluster``.
    A null file has no packets; bytes that are no Matroska file give one row
    with null columns and the reason in ``error``.
    """
    fields = [("packet", "int", pa.int32()), ("track", "int", pa.int32()), ("timestamp_ns", "long", pa.int64()), ("key", "boolean", pa.bool_()), ("start", "long", pa.int64()), ("length", "long", pa.int64()), ("cluster", "int", pa.int32()), ("error", "string", pa.string())]

    def rows(data):
        if data is None:
            return []
        try:
            found = parse(data).packets
        except (ValueError, IndexError, struct.error) as e:
            return [(None,) * 7 + (str(e),)]
        return [(k, p.track, p.timestamp_ns, p.key, p.start, p.length, p.cluster, None) for k, p in enumerate(found)]

    return _mapped(df, media_col, keep, fields, rows)


def samples(data: bytes, media: Media | None = None) -> tuple[bytes, int]:
    """(all samples of track 1 in order of their packets, how many count)."""
    media = media or parse(data)
    payload = b"".join(data[p.start : p.start + p.length] for p in media.packets if p.track == 1)
    rate = media.tracks[1]["rate"]
    return payload, len(payload) - round(media.discard_ns * rate / 1e9)


def feature(payload: bytes, media: Media) -> str:
    """Packets, clusters, cues, last timestamp in ms, mean, energy and crossings
    of the middle, in thousandths."""
    x = np.frombuffer(payload, np.uint8)
    high = x >= 128
    crossings = int((high[1:] != high[:-1]).sum())
    energy = np.dot(x.astype(np.float64) - 128, x.astype(np.float64) - 128) / max(1, len(x))
    last = media.packets[-1].timestamp_ns // 1_000_000 if media.packets else 0
    return f"p{len(media.packets)}.c{len(media.clusters)}.q{len(media.cues)}.t{last}.m{int(x.sum(dtype=np.int64)) * 1000 // max(1, len(x))}.e{int(energy * 1000)}.z{crossings * 1000 // max(1, len(x))}"


def features(df: DataFrame, media_col: str = "media", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` and what is read back from each file's packets: ``n_bytes``
    (samples that count), ``payload_bytes``, ``payload_sha256``,
    ``tail_crc32`` (last 64 of those that count with their padding),
    ``media_bytes``, ``media_sha256``, ``feature`` and ``error``. A null file
    gives no row; bytes that are no Matroska file, or have no audio track 1,
    give null columns (but ``media_bytes`` and ``media_sha256``) and the reason
    in ``error``."""
    fields = [("n_bytes", "long", pa.int64()), ("payload_bytes", "long", pa.int64()), ("payload_sha256", "string", pa.string()), ("tail_crc32", "long", pa.int64()), ("media_bytes", "long", pa.int64()), ("media_sha256", "string", pa.string()), ("feature", "string", pa.string()), ("error", "string", pa.string())]

    def rows(data):
        if data is None:
            return []
        whole = len(data), hashlib.sha256(data).hexdigest()
        try:
            media = parse(data)
            payload, n = samples(data, media)
        except (ValueError, IndexError, KeyError, struct.error) as e:
            return [(None, None, None, None, *whole, None, f"{type(e).__name__}: {e}")]
        return [(n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), *whole, feature(payload, media), None)]

    return _mapped(df, media_col, keep, fields, rows)


def op7_matroska_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(media_column(table(spark, sf_dir, "documents"), keep=("doc_id",)), keep=("doc_id",)).drop("error")


QUERIES = {"op7_matroska_media": op7_matroska_media}
ORACLES: dict[str, str] = {}
