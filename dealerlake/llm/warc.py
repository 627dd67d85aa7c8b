"""Web archive records: written through Spark's text writer, read back and put together again.

A page becomes an HTTP response with a chunked body. A block longer than a segment is split into a
first record and continuation records that name it as their origin. Pages whose payload another page
of smaller id has already are written as revisit records without a body.

Each archive file holds a bounded number of records of bounded size, gzipped as a whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealerlake.llm.common import record_batch
from dealerlake.session import scratch_dir

CRLF = "\r\n"
# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@dataclass(frozen=True)
class Layout:
    """Sizes in characters; a character takes up to four bytes."""

    segment: int = 32_768
    chunk: int = 8_192
    records_per_file: int = 1_024
    least_revisit: int = 0  # payloads below so many bytes are always written whole
    date: str = "2025-01-01T00:00:00Z"


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: each 5 hex digits are 4 base32 digits."""
    digest = F.sha1(payload)
    values = [F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 10).cast("int") for k in range(8)]
    digits = [F.substring(F.lit(BASE32), F.shiftright(v, 15 - 5 * d).bitwiseAND(31) + 1, F.lit(1)) for v in values for d in range(4)]
    return F.concat(*digits)


def with_roles(pages: DataFrame, layout: Layout) -> DataFrame:
    """page_id, url, html ('' for NULL), payload_digest, refers_to (NULL for a response).

    Of rows with equal payloads those with the smallest page_id are responses. A row without a
    page_id is a revisit only if some row with one has its payload.
    """
    html = F.coalesce("html", F.lit(""))
    payload = F.encode(html, "UTF-8")
    read = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        sha1_base32(payload).alias("payload_digest"),
        F.length(payload).cast("long").alias("payload_bytes"),
    )
    firsts = (
        read.select("payload_digest", "payload_bytes", "page_id").groupBy("payload_digest", "payload_bytes")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("times"))
        .filter((F.col("times") > 1) & (F.col("payload_bytes") >= layout.least_revisit))
        .drop("times")
    )
    refers = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return read.join(firsts, ["payload_digest", "payload_bytes"], "left").select(
        "page_id", "url", "html", "payload_digest", "payload_bytes", refers.alias("refers_to")
    )


def chunked(body: str, size: int) -> str:
    """The body in HTTP chunked framing, cut between characters."""
    pieces = [body[at : at + size] for at in range(0, len(body), size)]
    return "".join(f"{len(p.encode()):x}{CRLF}{p}{CRLF}" for p in pieces) + f"0{CRLF}{CRLF}"


def unchunked(framed: bytes) -> bytes:
    """Undo chunked framing. Chunk extensions and trailers are skipped; a framing error raises ValueError."""
    parts, at = [], 0
    while True:
        end = framed.index(b"\r\n", at)
        size = int(framed[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(parts)
        at = end + 2 + size
        if framed[at : at + 2] != b"\r\n":
            raise ValueError("chunk not closed")
        parts.append(framed[end + 2 : at])
        at += 2


def _header(value: object) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", str(value))


def _record(fields: dict[str, object], block: str) -> str:
    lines = [VERSION, *(f"{k}: {_header(v)}" for k, v in fields.items() if v is not None), f"Content-Length: {len(block.encode())}"]
    return CRLF.join([*lines, "", block])


def page_records(page_id: int | None, url: str | None, html: str, digest: str, refers_to: int | None, name: str, layout: Layout) -> Iterator[str]:
    """The records of one page, without the line ends that close each."""
    head = {
        "WARC-Type": "response", "WARC-Record-ID": f"<urn:record:{name}>", "WARC-Date": layout.date, "WARC-Target-URI": url,
        "X-Page-ID": page_id, "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http; msgtype=response",
    }
    answer = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"
    if refers_to is not None:
        head |= {"WARC-Type": "revisit", "WARC-Profile": REVISIT_PROFILE, "X-Refers-To-Page-ID": refers_to}
        yield _record(head, f"{answer}Content-Length: {len(html.encode())}{CRLF}{CRLF}")
        return
    block = f"{answer}Transfer-Encoding: chunked{CRLF}{CRLF}{chunked(html, layout.chunk)}"
    pieces = [block[at : at + layout.segment] for at in range(0, len(block), layout.segment)]
    if len(pieces) == 1:
        yield _record(head, block)
        return
    for number, piece in enumerate(pieces, 1):
        if number > 1:
            head = {
                "WARC-Type": "continuation", "WARC-Record-ID": f"<urn:record:{name}:{number}>", "WARC-Date": layout.date,
                "WARC-Segment-Origin-ID": f"<urn:record:{name}>",
            }
        total = len(block.encode()) if number == len(pieces) else None
        yield _record(head | {"WARC-Segment-Number": number, "WARC-Segment-Total-Length": total}, piece)


def write_archives(pages: DataFrame, folder: str, layout: Layout = Layout()) -> None:
    """One response or revisit record per row, in gzipped archive files under ``folder``."""
    schema = pa.schema([("value", pa.string())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            records = []
            for row in batch.select(["page_id", "url", "html", "payload_digest", "refers_to"]).to_pylist():
                count += 1
                records.extend(page_records(row["page_id"], row["url"], row["html"], row["payload_digest"], row["refers_to"], f"{part}-{count}", layout))
                if len(records) >= 500:
                    yield record_batch(schema, [records])
                    records = []
            yield record_batch(schema, [records])

    records = with_roles(pages, layout).mapInArrow(write, "value string")
    # A record is closed by two line ends, which is what the writer puts after each row.
    writer = records.write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", layout.records_per_file)
    writer.text(folder)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split(CRLF)
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        start, at = end + 4, end + 4 + int(fields["Content-Length"])
        yield fields, data[start:at]
        at += 4


RECORDS = pa.schema(
    [("origin", pa.string()), ("segment", pa.int64()), ("total", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()),
     ("record_type", pa.string()), ("refers_to", pa.int64()), ("declared", pa.string()), ("block", pa.binary())]
)
RECORDS_DDL = "origin string, segment long, total long, page_id long, url string, record_type string, refers_to long, declared string, block binary"


def _number(fields: dict[str, str], name: str) -> int | None:
    return int(fields[name]) if name in fields else None


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records of all archives under ``folder``. ``segment`` is NULL for a record in one piece."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for f, block in parse_records(zlib.decompress(content.as_py(), wbits=47)):
                    origin = f.get("WARC-Segment-Origin-ID", f["WARC-Record-ID"])
                    rows.append((origin, _number(f, "WARC-Segment-Number"), _number(f, "WARC-Segment-Total-Length"), _number(f, "X-Page-ID"),
                                 f.get("WARC-Target-URI"), f["WARC-Type"], _number(f, "X-Refers-To-Page-ID"), f.get("WARC-Payload-Digest", "")[5:], block))
                    size += len(block)
                    if size > 4 << 20:
                        yield record_batch(RECORDS, list(zip(*rows, strict=True)))
                        rows, size = [], 0
                if rows:
                    yield record_batch(RECORDS, list(zip(*rows, strict=True)))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("content").mapInArrow(read, RECORDS_DDL)


def reassemble(records: DataFrame) -> DataFrame:
    """Segmented records as whole ones; ``whole`` says that no segment is missing and the length is as declared."""
    head = F.get(F.filter("parts", lambda p: p["segment"] == 1), 0)
    joined = F.aggregate("parts", F.lit(b""), lambda held, p: F.concat(held, p["block"]))
    numbered = F.forall(F.transform("parts", lambda p, i: p["segment"] == i + 1), lambda ok: ok)
    return (
        records.filter(F.col("segment").isNotNull()).groupBy("origin")
        .agg(F.sort_array(F.collect_list(F.struct("segment", "total", "page_id", "url", "record_type", "refers_to", "declared", "block"))).alias("parts"))
        .select(
            head["page_id"].alias("page_id"), head["url"].alias("url"), head["record_type"].alias("record_type"),
            head["refers_to"].alias("refers_to"), head["declared"].alias("declared"), joined.alias("block"),
            (numbered & (F.array_max(F.transform("parts", lambda p: p["total"])) == F.length(joined))).alias("whole"),
        )
    )


PAGES = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("intact", pa.bool_())]
)
PAGES_DDL = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, intact boolean"


def _decoded(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split(CRLF)[1:])
    return fields, unchunked(body) if fields.get("Transfer-Encoding") == "chunked" else body


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per page of the archives, with its payload if asked for.

    ``intact`` is false where segments are missing, the framing is broken or the digest differs from
    the declared one; the payload and its measures are then NULL. A revisit has no payload of its own;
    its measures are those its record states.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                kept = (row["page_id"], row["url"], row["record_type"], row["refers_to"])
                try:
                    if not row["whole"]:
                        raise ValueError("segments are missing")
                    fields, body = _decoded(row["block"])
                    if row["record_type"] == "revisit":
                        out.append((*kept, int(fields["Content-Length"]), row["declared"], None, True))
                        continue
                    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
                    if digest != row["declared"]:
                        raise ValueError("other digest")
                    out.append((*kept, len(body), digest, body if payloads else None, True))
                except ValueError:
                    out.append((*kept, None, None, None, False))
            if out:
                yield record_batch(PAGES, list(zip(*out, strict=True)))

    records = read_records(spark, folder)
    columns = ("page_id", "url", "record_type", "refers_to", "declared", "block", "whole")
    single = records.filter(F.col("segment").isNull()).withColumn("whole", F.lit(True)).select(*columns)
    return single.union(reassemble(records).select(*columns)).mapInArrow(decode, PAGES_DDL)


def round_trip(pages: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """Write the pages to archives in the shared folder, read them back: page_id, payload_bytes, payload_digest,
    record_type, refers_to of every row. A NULL html is an empty payload. Further columns are not read."""
    folder = scratch_dir(pages.sparkSession, "warc")
    write_archives(pages, folder, layout)
    read = read_archives(pages.sparkSession, folder, payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH read AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), coded AS (
  SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::INTEGER, 1)), '') AS payload_digest
  FROM read
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM coded
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM firsts
"""
