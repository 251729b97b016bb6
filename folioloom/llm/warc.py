"""WARC archives of pages: written segmented and chunked, read back whole.

The engine finds equal payloads by their digests; an Arrow step then frames each page once, in
time linear in its length, and the text sink writes the records.  The line separator is the
blank lines that end a record, so every part is a WARC file (gzip over the whole file) on any
file system that Spark writes.  A block over ``SEGMENT`` bytes becomes a first record and
continuations; payloads carry chunked transfer framing; equal payloads after the first become
revisits.  A file holds at most ``RECORDS`` records of a segment each, so its size has a bound.

Reading parses whole files by content length.  Continuations meet by origin id, are ordered
by segment number and checked against the total length; then the framing is decoded and the
payload held against its digest.

Defined cases: a null html is an empty payload; the least page id of equal payloads is the
response, one row of it where rows repeat; a null page id counts as the least and is kept
null; an empty table gives an archive without records; further columns are not archived; a
page of any length is cut into segments, never in the middle of a character.
"""

from __future__ import annotations

import base64
import gzip
import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.llm import store

#: Bytes of a segment and of a chunk at most, and records of a file.
SEGMENT, CHUNK, RECORDS = 32_768, 16_384, 1000
#: Pages framed at once and bytes of records handed on at once: bounds of a task's memory.
ROWS_AT_ONCE, BYTES_AT_ONCE = 500, 2_000_000
#: Payloads of at least so many bytes are revisited.
LEAST = 0
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of SHA-1: twenty bits at a time."""
    h = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(h, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    return F.translate(F.concat(*groups), digits, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def cut(data: bytes, size: int) -> list[bytes]:
    """Pieces of ``size`` bytes at most, each ending with a whole character; one empty piece of no bytes."""
    out, at, n = [], 0, len(data)
    while n - at > size:
        end = at + size
        while end > at + size - 4 and data[end] & 0xC0 == 0x80:
            end -= 1
        out.append(data[at:end])
        at = end
    out.append(data[at:])
    return out


def chunked(body: bytes) -> bytes:
    """Chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(c), c) for c in cut(body, CHUNK) if c]
    return b"".join([*parts, b"0\r\n\r\n"])


def _name(page: int | None, row: int, k: int) -> bytes:
    return f"<urn:page:{'null' if page is None else page}:{row}:{k}>".encode()


_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def page_records(page: int | None, row: int, url: bytes | None, body: bytes, digest: bytes, first: tuple | None):
    """Records of one page, without the blank lines that end them; ``first`` is the (page, row) that it revisits."""
    block = b"%bContent-Length: %d\r\n\r\n" % (_HTTP, len(body)) if first else b"%bTransfer-Encoding: chunked\r\n\r\n%b" % (_HTTP, chunked(body))
    parts = cut(block, SEGMENT)
    uri = None if url is None else url.replace(b"\r", b"").replace(b"\n", b"")
    for k, part in enumerate(parts):
        lines: list[tuple[bytes, bytes | None]] = [
            (b"WARC-Type", b"continuation" if k else b"revisit" if first else b"response"),
            (b"WARC-Record-ID", _name(page, row, k + 1)),
            (b"WARC-Date", DATE.encode()),
            (b"WARC-Target-URI", uri),
            (b"Content-Length", b"%d" % len(part)),
        ]
        if k:
            lines.append((b"WARC-Segment-Origin-ID", _name(page, row, 1)))
        else:
            lines += [(b"WARC-Payload-Digest", b"sha1:" + digest), (b"Content-Type", b"application/http; msgtype=response")]
            if first:
                lines += [(b"WARC-Profile", _PROFILE), (b"WARC-Refers-To", _name(*first, 1))]
        if len(parts) > 1:
            lines.append((b"WARC-Segment-Number", b"%d" % (k + 1)))
            if k == len(parts) - 1:
                lines.append((b"WARC-Segment-Total-Length", b"%d" % len(block)))
        yield b"WARC/1.1\r\n%b\r\n%b" % (b"".join(b"%b: %b\r\n" % x for x in lines if x[1] is not None), part)


def _frame(batches):
    for batch in (whole.slice(at, ROWS_AT_ONCE) for whole in batches for at in range(0, max(1, whole.num_rows), ROWS_AT_ONCE)):
        raw = {c: pc.cast(batch.column(c), pa.binary()).to_pylist() for c in ("url", "payload", "digest")}
        ids = (batch.column(c).to_pylist() for c in ("page_id", "row", "revisit", "first_id", "first_row"))
        out, size = [], 0
        for page, row, revisit, first_id, first_row, url, body, digest in zip(*ids, raw["url"], raw["payload"], raw["digest"], strict=True):
            for record in page_records(page, row, url, body, digest, (first_id, first_row) if revisit else None):
                out.append(record)
                size += len(record)
                if size >= BYTES_AT_ONCE:
                    yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.binary())})
                    out, size = [], 0
        yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.binary())})


def records(pages: DataFrame) -> DataFrame:
    """One row a record: column ``value``, without the blank lines that end it.

    Digests are grouped without the pages; only those that occur again are joined.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), F.coalesce("html", F.lit("")).alias("payload"))
    p = p.withColumn("row", F.monotonically_increasing_id()).withColumn("digest", base32_sha1(F.col("payload")))
    first = p.where(F.octet_length("payload") >= LEAST).groupBy("digest").agg(F.min(F.struct("page_id", "row")).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    p = p.join(first, "digest", "left")
    revisit = F.col("first").isNotNull() & ((F.col("first.row") != F.col("row")) | F.col("first.row").isNull())
    p = p.select("page_id", "url", "payload", "row", "digest", revisit.alias("revisit"), F.col("first.page_id").alias("first_id"), F.col("first.row").alias("first_row"))
    return p.mapInArrow(_frame, "value binary").select(F.col("value").cast("string").alias("value"))


def write(pages: DataFrame, path: str) -> None:
    with store.arrow_rows(pages.sparkSession, ROWS_AT_ONCE):
        _write(pages, path)


def _write(pages: DataFrame, path: str) -> None:
    records(pages).write.option("lineSep", END).option("maxRecordsPerFile", RECORDS).option("compression", "gzip").text(path)


def parse(data: bytes):
    """(headers, block) of each record of one archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = {k.strip().lower().decode(): v.strip().decode() for k, v in (x.split(b":", 1) for x in lines[1:])}
        n = int(head["content-length"])
        block = data[end + 4 : end + 4 + n]
        if len(block) != n or data[end + 4 + n : end + 8 + n] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut off")
        yield head, block
        at = end + 8 + n


def unchunk(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        n = int(body[at:end].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + n])
        if len(out[-1]) != n or body[end + 2 + n : end + 4 + n] != b"\r\n":
            raise ValueError("a chunk is cut off")
        at = end + 4 + n


def payload(block: bytes) -> tuple[bytes, int]:
    """(payload, its stated length) of an HTTP response; a revisit has the length alone."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, v in (x.split(b":", 1) for x in head.split(b"\r\n")[1:])}
    if fields.get(b"transfer-encoding", b"").lower() == b"chunked":
        body = unchunk(body)
    return body, int(fields.get(b"content-length", len(body)))


def _page(record_id: str | None) -> int | None:
    part = (record_id or "::null").split(":")[2]
    return None if part == "null" else int(part)


def _closed(kind: str, record_id: str, refers: str | None, digest: str, block: bytes) -> tuple:
    body, n = payload(block)
    if kind == "revisit":
        return _page(record_id), n, digest, kind, _page(refers), True, None
    own = base64.b32encode(hashlib.sha1(body).digest()).decode()
    return _page(record_id), len(body), own, kind, None, own == digest, body


_OUT = (("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("verified", pa.bool_()), ("payload", pa.binary()))
_OPEN = (("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("kind", pa.string()), ("refers", pa.string()), ("digest", pa.string()), ("block", pa.binary()))
_SQL = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.bool_(): "boolean", pa.binary(): "binary"}


def _schema(*fields) -> str:
    return ", ".join(f"{name} {_SQL[kind]}" for name, kind in fields)


def _batch(rows: list[tuple], fields) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_pydict({name: pa.array(c, kind) for c, (name, kind) in zip(cols, fields, strict=True)})


def _read_files(with_payload: bool):
    def work(batches):
        for batch in batches:
            for content in batch.column("content").to_pylist():
                rows = []
                for head, block in parse(gzip.decompress(content)):
                    rid, number = head["warc-record-id"].strip("<>"), head.get("warc-segment-number")
                    kind, refers = head["warc-type"], head.get("warc-refers-to", "").strip("<>") or None
                    digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
                    if number is None:
                        row = _closed(kind, rid, refers, digest, block)
                        rows.append((*row[:-1], row[-1] if with_payload else None, *[None] * len(_OPEN)))
                    else:
                        origin = head.get("warc-segment-origin-id", rid).strip("<>")
                        total = head.get("warc-segment-total-length")
                        rows.append((*[None] * len(_OUT), origin, int(number), total and int(total), kind, refers, digest, block))
                    if len(rows) >= 500:
                        yield _batch(rows, _OUT + _OPEN)
                        rows = []
                yield _batch(rows, _OUT + _OPEN)

    return work


def _join_segments(with_payload: bool):
    def work(batches):
        for batch in batches:
            rows = []
            for origin, parts in zip(batch.column("origin").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)) or parts[0]["kind"] == "continuation":
                    raise ValueError(f"segments of {origin} are missing")
                block = b"".join(p["block"] for p in parts)
                if len(block) != parts[-1]["total"]:
                    raise ValueError(f"{origin} has {len(block)} bytes, not {parts[-1]['total']}")
                row = _closed(parts[0]["kind"], origin, parts[0]["refers"], parts[0]["digest"], block)
                rows.append((*row[:-1], row[-1] if with_payload else None))
            yield _batch(rows, _OUT)

    return work


def read(spark, path: str, with_payload: bool = True) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, verified, payload."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    rows = store.materialize(files.mapInArrow(_read_files(with_payload), _schema(*_OUT, *_OPEN)), "records")
    names = [name for name, _ in _OUT]
    segment = F.struct("segment", "total", "kind", "refers", "digest", "block")
    # a group holds one record's segments, no more than the record itself
    groups = rows.where("segment IS NOT NULL").groupBy("origin").agg(F.sort_array(F.collect_list(segment)).alias("parts"))
    return rows.where("segment IS NULL").select(*names).unionByName(groups.mapInArrow(_join_segments(with_payload), _schema(*_OUT)))


def op4_warc_round_trip(spark, sf_dir: str) -> DataFrame:
    path = store.fresh_path(spark, "warc")
    write(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), path)
    return read(spark, path, with_payload=False).drop("payload")


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
d AS (
  SELECT page_id, octet_length(encode(h)) AS n, x,
         list_aggregate(list_transform(range(0, 8), lambda k: list_aggregate(list_transform([15, 10, 5, 0],
           lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(x, 5 * k + 1, 5) AS INTEGER) >> s) & 31), 1)), 'string_agg', '')), 'string_agg', '') AS digest
  FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first_id FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to, true AS verified
FROM f
"""
