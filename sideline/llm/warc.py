"""WARC archives: writing with revisits and segments, reading back by reassembly.

The writer makes one record for each page.  Of pages with equal payloads the
one with the largest id is a ``response``, the others are ``revisit`` records
that refer to it.  The HTTP block is in chunked transfer framing; a block
longer than a segment goes on in ``continuation`` records.  Archives are
written by Spark's text sink (its line separator is the blank line that ends
a WARC record), so a lost task leaves no half archive.

The reader takes whole records as they are, and groups continuation records
by the identifier of their origin, orders them by segment number, verifies
that none is missing and that the total length is as stated, joins them, and
decodes the chunked framing.  Only segments are shuffled, keyed by one
record's identifier, so a group is never more than one payload.  Revisits
find their response by an equi-join on the record identifier.

Defined results: a null or empty html is an empty payload; a null ``page_id``
stays null and counts as the smallest; equal rows are equal records, and if
they have the largest id, each is a response; a record whose segments are
missing, doubled with other content or of the wrong length is not complete
and has no payload; an empty table gives no records; further columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sideline.llm.batches import as_binary, table_batch
from sideline.llm.common import new_path, staged
from sideline.llm.repeats import _packed, unpack

#: Payloads from this many bytes on are written once.
REVISIT_BYTES = 1000
#: Bytes of a block in one record.
SEGMENT_BYTES = 16 * 1024
#: Bytes of one transfer chunk.
CHUNK_BYTES = 4 * 1024
DATE = "2024-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_HTTP_REVISIT = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_BLANK = b"\r\n\r\n"
_LINE_ENDS = re.compile(rb"[\r\n]*")


def _letters(data: bytes, limit: int) -> Iterator[bytes]:
    """Parts of at most ``limit`` bytes that cut no UTF-8 letter."""
    at = 0
    while at < len(data):
        end = min(at + limit, len(data))
        while end < len(data) and end > at + 1 and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


def chunked(payload: bytes, limit: int = CHUNK_BYTES) -> bytes:
    """A payload in chunked transfer framing."""
    return b"".join(b"%x\r\n%b\r\n" % (len(x), x) for x in _letters(payload, limit)) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        try:
            size = int(body[at:line].split(b";")[0], 16) if line > at else -1
        except ValueError:
            size = -1
        if size < 0:
            return None
        if size == 0:
            return b"".join(out)
        if body[line + 2 + size: line + 4 + size] != b"\r\n":
            return None
        out.append(body[line + 2: line + 2 + size])
        at = line + 4 + size


def payload_of(block: bytes) -> bytes | None:
    """The payload of an HTTP response block."""
    head, blank, body = block.partition(_BLANK)
    if not blank:
        return None
    framed = any(line.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for line in head.split(b"\r\n"))
    return unchunked(body) if framed else body


def record(kind: str, record_id: str, block: bytes, **fields) -> bytes:
    """One record without the blank line after its block; empty fields are left out."""
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    for name, value in fields.items():
        if value is not None:
            clean = str(value).replace("\r", "%0D").replace("\n", "%0A")
            head.append(f"{name.replace('_', '-')}: {clean}")
    return "\r\n".join(["WARC/1.1", *head, f"Content-Length: {len(block)}"]).encode() + _BLANK + block


def records_of(page_id, url, record_id: str, digest: str, refers: str | None, payload: bytes) -> Iterator[bytes]:
    """The records of one page: one, or the first segment and its continuations."""
    fields = {"WARC_Target_URI": url, "WARC_Page_ID": page_id,
              "WARC_Payload_Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()}
    if refers is not None:
        yield record("revisit", record_id, _HTTP_REVISIT, **fields, WARC_Refers_To=f"<{refers}>",
                     WARC_Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", Content_Type="application/http;msgtype=response")
        return
    block = _HTTP + chunked(payload)
    fields["Content_Type"] = "application/http;msgtype=response"
    if len(block) <= SEGMENT_BYTES:
        yield record("response", record_id, block, **fields)
        return
    parts = list(_letters(block, SEGMENT_BYTES))
    yield record("response", record_id, parts[0], **fields, WARC_Segment_Number=1)
    for k, part in enumerate(parts[1:], 2):
        total = len(block) if k == len(parts) else None
        own = f"urn:uuid:{hashlib.md5(f'{record_id} {k}'.encode()).hexdigest()}"
        yield record("continuation", own, part, WARC_Segment_Number=k, WARC_Segment_Origin_ID=f"<{record_id}>", WARC_Segment_Total_Length=total)


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "record_id", "digest", "refers")), unpack(batch.column("text")), strict=True)
        out, size = [], 0
        for row in rows:
            for r in records_of(*row):
                out.append(r)
                size += len(r)
            if size > 1 << 23:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], names=["value"])
                out, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], names=["value"])


def write_archives(pages: DataFrame, path: str) -> None:
    """Write ``pages`` (page_id, url, html) as gzip-compressed archives below ``path``."""
    digest = F.sha1(F.col("text").cast("binary"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("text"))
    rows = rows.withColumn("digest", digest).withColumn("record_id", F.concat(F.lit("urn:uuid:"), F.md5(F.concat_ws(
        "\n", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.coalesce(F.concat(F.lit("u"), "url"), F.lit("-")), "digest"))))
    keyed = rows.where(F.octet_length("text") >= REVISIT_BYTES).select("page_id", "record_id", "digest")
    equal = (keyed.groupBy("digest").agg(F.count("*").alias("c"), F.max(F.struct("page_id", "record_id")).alias("top"))
             .where("c > 1").select("digest", F.col("top.record_id").alias("refers")))
    again = keyed.join(equal, "digest").where("record_id <> refers").select("record_id", "refers").distinct()
    out = _packed(rows).join(again, "record_id", "left")
    out.select("page_id", "url", "record_id", "digest", "refers", "text").mapInArrow(_write, "value string") \
        .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def _inflated(data: memoryview, step: int = 1 << 18) -> Iterator[bytes]:
    """The content of a plain file or of a gzip file of any number of members."""
    if bytes(data[:2]) != b"\x1f\x8b":
        yield from (bytes(data[k: k + step]) for k in range(0, len(data), step))
        return
    at, left = 0, b""
    tool = zlib.decompressobj(31)
    while at < len(data) or left:
        piece = left or bytes(data[at: at + step])
        at += 0 if left else step
        yield tool.decompress(piece)
        left = b""
        if tool.eof:
            left, tool = tool.unused_data, zlib.decompressobj(31)


def parse(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields in lower case, block) of each record of an archive, by the stated lengths; a cut-off last record is left out.

    What is held is walked by position and cut only where a part is added, so
    a record's cost is its own length, however long the parts are.
    """
    held, at, more = b"", 0, iter(parts)
    while True:
        at = _LINE_ENDS.match(held, at).end()
        end = held.find(_BLANK, at)
        while end < 0:
            part = next(more, None)
            if part is None:
                return
            held, at = held[at:] + part, 0
            at = _LINE_ENDS.match(held).end()
            end = held.find(_BLANK, at)
        lines = held[at:end].decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(fields.get("content-length", 0))
        need = end + 4 + size
        if len(held) < need:
            gathered = [held]
            have = len(held)
            while have < need:
                part = next(more, None)
                if part is None:
                    return
                gathered.append(part)
                have += len(part)
            held = b"".join(gathered)
        yield fields, held[end + 4: need]
        at = need


_RAW = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("refers", pa.string()),
                  ("stated", pa.string()), ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("block", pa.binary())])


def _read(segments: bool | None):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in as_binary(batch.column("content")):
                rows: list[list] = [[] for _ in _RAW]
                size = 0
                for f, block in parse(_inflated(memoryview(content.as_buffer()))):
                    number = int(f["warc-segment-number"]) if "warc-segment-number" in f else None
                    if segments is not None and segments != (number is not None):
                        continue
                    own = f.get("warc-record-id", "").strip("<>")
                    digest = f.get("warc-payload-digest", "")
                    row = (own, f.get("warc-type"), int(f["warc-page-id"]) if "warc-page-id" in f else None, f.get("warc-target-uri"),
                           f["warc-refers-to"].strip("<>") if "warc-refers-to" in f else None,
                           base64.b32decode(digest[5:]).hex() if digest.startswith("sha1:") else None,
                           f.get("warc-segment-origin-id", own).strip("<>") if number else None, number,
                           int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None, block)
                    for column, value in zip(rows, row, strict=True):
                        column.append(value)
                    size += len(block)
                    if size > 1 << 22:
                        yield table_batch(_RAW, rows)
                        rows, size = [[] for _ in _RAW], 0
                yield table_batch(_RAW, rows)

    return read


def read_records(spark: SparkSession, path: str, segments: bool | None = None) -> DataFrame:
    """The raw records of all archives below ``path``, plain or gzip; an archive is read by one task, as a stream of blocks.

    ``segments`` gives only the records that are segments of others (True) or only those that are whole (False).
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(_read(segments), "record_id string, type string, page_id long, url string, refers string, stated string, origin string, number int, total long, block binary")


def join_segments(parts: list[dict]) -> tuple[bytes | None, int]:
    """(block, copies) of one record's segments in order; the block is None if they are not complete."""
    by_number: dict[int, dict] = {}
    sound = True
    for p in parts:
        held = by_number.setdefault(p["number"], p)
        sound &= held["block"] == p["block"]
    copies = max(1, sum(p["number"] == 1 for p in parts))
    numbers = sorted(by_number)
    block = b"".join(by_number[k]["block"] for k in numbers)
    sound &= numbers == list(range(1, len(numbers) + 1)) and by_number[numbers[-1]]["total"] == len(block)
    return (block if sound else None), copies


_WHOLE = "record_id string, type string, page_id long, url string, refers string, stated string, complete boolean, payload binary, payload_digest string"


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("refers", pa.string()),
                        ("stated", pa.string()), ("complete", pa.bool_()), ("payload", pa.binary()), ("payload_digest", pa.string())])
    names = schema.names[:6]
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            rows = []
            for row in batch.slice(first, 256).to_pylist():
                block, copies = join_segments(row["segments"])  if row["segments"] is not None else (row["block"], 1)
                payload = payload_of(block) if block is not None and row["type"] == "response" else None
                digest = hashlib.sha1(payload).hexdigest() if payload is not None else None
                complete = row["type"] == "revisit" or digest is not None and row["stated"] in (None, digest)
                rows += [{n: row[n] for n in names} | {"complete": complete, "payload": payload if complete else None, "payload_digest": digest if complete else None}] * copies
            yield table_batch(schema, [[r[n] for r in rows] for n in schema.names])


def reassemble(records: DataFrame, segments: DataFrame | None = None) -> DataFrame:
    """One row for each response and revisit: record_id, type, page_id, url, refers, stated, complete, payload, payload_digest.

    The segments may be a frame of their own, so that neither reading hands on the other's blocks.
    """
    segments = records if segments is None else segments
    kinds = F.col("type").isin("response", "revisit")
    head = ["record_id", "type", "page_id", "url", "refers", "stated"]
    whole = records.where(F.col("number").isNull() & kinds).select(*head, "block", F.lit(None).cast("array<struct<number:int,total:bigint,block:binary>>").alias("segments"))
    first = F.struct(*(F.col(c) for c in head))
    parts = (segments.where("number is not null").groupBy("origin")
             .agg(F.collect_list(F.struct("number", "total", "block")).alias("segments"), F.max(F.when(F.col("number") == 1, first)).alias("h"))
             .where("h is not null").select(*(F.col(f"h.{c}").alias(c) for c in head), F.lit(None).cast("binary").alias("block"), "segments"))
    return whole.union(parts).mapInArrow(_decode, _WHOLE)


def op3_warc_reassembly(spark, sf_dir: str) -> DataFrame:
    """Contract query: write a record for each page, read the archives back, say what each page's record is."""
    from sideline.llm.common import table

    path = new_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    found = staged(reassemble(read_records(spark, path, False), read_records(spark, path, True)).select("record_id", "type", "page_id", "refers", "stated", "complete",
                                                                 F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest"), "payloads")
    answers = found.where("type = 'response'").select(F.col("record_id").alias("refers"), F.col("page_id").alias("o_page"),
                                                       F.col("payload_bytes").alias("o_bytes"), F.col("payload_digest").alias("o_digest")).distinct()
    own = found.where("type = 'response'").select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    again = found.where("type = 'revisit'").join(answers, "refers", "left").select(
        "page_id", F.col("o_bytes").alias("payload_bytes"), F.col("o_digest").alias("payload_digest"), F.col("type").alias("record_type"), F.col("o_page").alias("refers_to"))
    return own.union(again)
