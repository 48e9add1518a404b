"""WARC archives: write, read back, and put segmented records together again.

Writing: each page becomes a WARC/1.1 record whose block is an HTTP response
with chunked transfer framing. Of pages with equal payloads (of at least
``revisit_from`` bytes) the one with the smallest id is a ``response``, the
others are ``revisit`` records that refer to it. A block of more than
``segment_bytes`` is cut into segments: the first record has segment number 1,
``continuation`` records name it as their origin, and the last of them states
the total length.

Reading: archives are split into records by their stated lengths. Unsegmented
records are complete where they stand; only segments are shuffled, grouped by
origin identifier, ordered by segment number, and checked to be 1, 2, 3, ...
with the stated total length. Then the chunked framing is decoded and the
payload's digest compared with the header.

Archives hold plain WARC records, in files (``part-*.txt``) of about ``ARCHIVE_BYTES``, written by
Spark's own text writer (one file image a row), so commits are atomic, work in
any store and survive lost executors; they are read with the binary-file
reader.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import PLAIN, bounded, table, work_folder, written

#: A record's block is cut into segments of so many bytes.
SEGMENT_BYTES = 16 << 10
#: Size at which an archive file is closed.
ARCHIVE_BYTES = 8 << 20
CHUNK_BYTES = 4 << 10
#: Up to so many repeated payloads (about 100 bytes each) are broadcast.
BROADCAST_PAYLOADS = 300_000
#: Bytes of payloads or blocks that a Python worker holds as objects, about.
HELD_BYTES = 2 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, row: str = "", segment: int = 1) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'page/{page_id}/{row}/{segment}')}>"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(payload[i : i + size]), payload[i : i + size]) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """Payload of a chunked body; extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0].strip(), 16)
        at = line + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError(f"chunk at byte {at} isn't {size} bytes long")
        out.append(body[at : at + size])
        at += size + 2


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def records_for(page_id, url: str | None, payload: bytes, refers_to, row: str = "", segment_bytes: int = SEGMENT_BYTES) -> list[bytes]:
    """The records of one page: one revisit, or a response and its segments."""
    first = record_id(page_id, row)
    name = "" if page_id is None else str(page_id)
    common = [("WARC-Date", DATE), ("WARC-Target-URI", " ".join((url or "").split()) or None), ("X-Page-ID", name)]
    sha1 = f"sha1:{digest(payload)}"
    if refers_to is not None:
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        head = [("WARC-Type", "revisit"), ("WARC-Record-ID", first), *common, ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page", str(refers_to)), ("WARC-Profile", PROFILE), ("WARC-Payload-Digest", sha1), ("Content-Type", "application/http; msgtype=response")]
        return [record(head, http)]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    segments = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    head = [("WARC-Type", "response"), ("WARC-Record-ID", first), *common, ("WARC-Payload-Digest", sha1), ("Content-Type", "application/http; msgtype=response")]
    if len(segments) == 1:
        return [record(head, block)]
    out = [record([*head, ("WARC-Segment-Number", "1")], segments[0])]
    for k, part in enumerate(segments[1:], 2):
        last = [("WARC-Segment-Total-Length", str(len(block)))] if k == len(segments) else []
        out.append(record([("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(page_id, row, k)), *common, ("WARC-Segment-Origin-ID", first), ("WARC-Segment-Number", str(k)), *last], part))
    return out


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record."""
    at = 0
    while at < len(content):
        if content[at : at + 1] in b"\r\n":  # after a record, or a writer's last line feed
            at += 1
            continue
        end = content.index(b"\r\n\r\n", at)
        version, *lines = content[at:end].decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(headers["content-length"])
        block = content[end + 4 : end + 4 + size]
        if len(block) != size:
            raise ValueError(f"cut record at byte {at}")
        yield headers, block
        at = end + 4 + size


def payload_of(block: bytes) -> tuple[dict[str, str], bytes]:
    """HTTP headers and decoded body of a response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:])}
    return headers, dechunked(body) if "chunked" in headers.get("transfer-encoding", "").lower() else body


# ------------------------------------------------------------------ Spark


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str | None = "url", html_col: str = "html", *, revisit_from: int = 0, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write every row of ``pages``, payload the html in UTF-8 (null: empty).

    Rows with equal payload and the smallest id are all responses if the id
    repeats; null ids are never the smallest unless all are null, and then all
    are responses. Other columns are not read. An empty table writes no record.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), (F.col(url_col).cast("string") if url_col else F.lit(None).cast("string")).alias("url"), html.alias("html"), F.sha2(html.cast("binary"), 256).alias("same"))
    # Only payloads that repeat; a hot one is pre-aggregated to one row a task.
    copies = rows.where(F.octet_length("html") >= revisit_from).groupBy("same", "id").agg(F.count("*").alias("n"))
    first = copies.groupBy("same").agg(F.min("id").alias("first"), F.sum("n").alias("all"), F.min_by("n", "id").alias("twins")).where("all > 1")
    first = written(first.select(F.col("same").alias("known"), "first", "twins"), "first")
    if first.count() <= BROADCAST_PAYLOADS:
        first = F.broadcast(first)  # the html then needs no shuffle
    rows = rows.join(first, F.col("same") == F.col("known"), "left")
    refers = F.when(F.col("id").eqNullSafe(F.col("first")), None).otherwise(F.col("first"))
    rows = rows.select("id", "url", "html", refers.alias("refers_to"), (F.col("id").isNull() | refers.isNotNull() | (F.coalesce("twins", F.lit(1)) > 1)).alias("salted"))

    def run(batches):
        held, size, part = [], 0, TaskContext.get().partitionId()
        for k, batch in enumerate(bounded(batches, 2, HELD_BYTES)):
            for r, (page_id, url, text, refers, salted) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(5)))):
                # A lone response is found by its page; other rows may repeat an id.
                row = f"{part}/{k}/{r}" if salted else ""
                made = records_for(page_id, url, text.encode("utf-8", "replace"), refers, row, segment_bytes)
                held += made
                size += sum(map(len, made))
                if size >= ARCHIVE_BYTES:
                    yield image(held)
                    held, size = [], 0
        if held:
            yield image(held)

    def image(parts):  # the writer adds the line feed that ends the last record
        return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)[:-1]], pa.binary())], ["archive"])

    rows.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value")).write.options(**PLAIN, maxRecordsPerFile=1).text(folder)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of all archives under ``folder``: ``headers`` (map)
    and ``block`` (binary)."""
    files = spark.read.format("binaryFile").load(folder).where("length > 0").select("content")

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for headers, block in parse_archive(content.as_buffer().to_pybytes()):
                    rows.append((list(headers.items()), block))
                    size += len(block)
                    if size >= HELD_BYTES:
                        yield as_batch(rows)
                        rows, size = [], 0
                if rows:
                    yield as_batch(rows)

    def as_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.map_(pa.string(), pa.string())), pa.array([r[1] for r in rows], pa.binary())], ["headers", "block"])

    return files.mapInArrow(run, "headers map<string,string>, block binary")


def reassemble(records: DataFrame) -> DataFrame:
    """Logical records: ``headers`` of the first segment, ``block`` complete,
    ``error`` (null, or why the segments don't make a whole record).

    Segments may stand in any archives and any order. Unsegmented records are
    passed on as they are. Of segments that don't follow one another (a number
    is missing or repeats, the stated total differs) nothing more is held than
    the first error.
    """
    number = F.try_element_at("headers", F.lit("warc-segment-number")).try_cast("int")
    segmented = F.try_element_at("headers", F.lit("warc-segment-number")).isNotNull()
    whole = records.where(~segmented).select("headers", "block", F.lit(None).cast("string").alias("error"))
    cut = records.where(segmented).select(
        F.coalesce(F.try_element_at("headers", F.lit("warc-segment-origin-id")), F.try_element_at("headers", F.lit("warc-record-id"))).alias("origin"),
        number.alias("number"), F.try_element_at("headers", F.lit("warc-segment-total-length")).try_cast("long").alias("total"), F.when(number == 1, F.map_entries("headers")).alias("head"), "block",
    )

    def run(batches):
        origin, head, parts, size, last, total, error, open_ = None, None, [], 0, 0, None, None, False

        def out():
            why = error or ("no total length" if total is None else "the total length differs" if total != size else None)
            pairs = pa.array([[(e["key"], e["value"]) for e in head or []]], pa.map_(pa.string(), pa.string()))
            return pa.RecordBatch.from_arrays([pairs, pa.array([b"".join(parts)], pa.binary()), pa.array([why], pa.string())], ["headers", "block", "error"])

        for batch in batches:
            keys, numbers, totals, heads = (batch.column(c).to_pylist() for c in range(4))
            for r, key in enumerate(keys):
                if not open_ or key != origin:
                    if open_:
                        yield out()
                    origin, head, parts, size, last, total, error, open_ = key, None, [], 0, 0, None, None, True
                if error is None and (numbers[r] != last + 1 or total is not None):
                    error, parts = "segments are missing or repeat", []
                head = head or heads[r]
                if error is None:
                    part = batch.column(4)[r].as_py()
                    parts.append(part)
                    size, last, total = size + len(part), numbers[r], totals[r]
        if open_:
            yield out()

    # Rows of one record stand together, so a task holds one record's block.
    joined = cut.repartition("origin").sortWithinPartitions("origin", F.col("number").asc_nulls_first()).mapInArrow(run, "headers map<string,string>, block binary, error string")
    return whole.unionByName(joined)


def decode(logical: DataFrame) -> DataFrame:
    """One row per page: ``page_id`` string, ``record_type``, ``record_id``,
    ``payload`` (null for revisits), ``payload_bytes``, ``payload_digest``
    (both of the full payload), ``refers_to`` string, ``error``."""

    def run(batches):
        for batch in bounded(batches, 1, HELD_BYTES):
            rows = []
            for headers, block, error in zip(*(batch.column(c).to_pylist() for c in range(3))):
                h = {e["key"]: e["value"] for e in headers or []}
                kind, stated = h.get("warc-type"), h.get("warc-payload-digest", "").removeprefix("sha1:")
                payload, n, sha1 = None, None, stated
                if error is None:
                    try:
                        http, body = payload_of(block)
                        if kind == "revisit":
                            n = int(http["content-length"])
                        else:
                            payload, n, sha1 = body, len(body), digest(body)
                            if stated and sha1 != stated:
                                error = "the payload digest differs"
                    except (ValueError, KeyError) as e:
                        error = f"no whole payload: {e}"
                rows.append((h.get("x-page-id") or None, kind, h.get("warc-record-id"), payload, n, sha1, h.get("x-refers-to-page"), h.get("warc-refers-to"), error))
            kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["page_id", "record_type", "record_id", "payload", "payload_bytes", "payload_digest", "refers_to", "refers_to_record", "error"])

    return logical.select(F.map_entries("headers").alias("headers"), "block", "error").mapInArrow(run, "page_id string, record_type string, record_id string, payload binary, payload_bytes long, payload_digest string, refers_to string, refers_to_record string, error string")


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    return decode(reassemble(read_records(spark, folder)))


def op6_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, folder = table(spark, sf_dir, "pages"), f"{work_folder(spark)}/warc"
    write_archives(pages, folder)
    kind = pages.schema["page_id"].dataType
    back = read_pages(spark, folder).drop("payload")
    return back.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "error")


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
f AS (SELECT b, min(page_id) AS first FROM p GROUP BY b),
h AS (SELECT page_id, b, CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to, sha1(b) AS hex FROM p JOIN f USING (b)),
n AS (SELECT *, list_transform(range(32), lambda i:
        list_reduce(list_transform(range(5), lambda k: list_position(string_split('0123456789abcdef', ''), hex[(i * 5 + k) // 4 + 1]) - 1 >> (3 - (i * 5 + k) % 4) & 1), lambda a, c: a * 2 + c)) AS digits FROM h)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes,
       array_to_string(list_transform(digits, lambda d: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[d::INT + 1]), '') AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to, NULL::VARCHAR AS error
FROM n
"""

QUERIES = {"op6_warc_archives": op6_warc_archives}
ORACLES = {"op6_warc_archives": ORACLE}
