"""Legacy archive converter: ARC records to WARC records.

ARC files are parsed by their version block (version 1 or 2 names the fields of the
header lines) and by the declared length of every record, never by searching for a
separator.  Each record becomes a WARC record with a synthesised identifier (a name
based UUID of its URL, date and payload), timestamp, type and digests.  Records with
equal payloads of a stated size at least are kept once: the one with the largest
page id is the response, the others revisit it.

WARC files are written by Spark's text writer (one record a row, the record's closing
blank lines as the line separator, gzip), so a lost executor costs one task and only
committed files stay; they are read back by declared lengths.

Defined results: null html is an empty payload, a null URL is written as
``urn:page:none``, white space and control characters in URLs are percent-encoded;
rows that share the largest page id of a payload are all responses, and a revisit
refers to that id; a row with a null page id never is the response of a group with
other ids.  Text that is not valid UTF-8 cannot occur in a string column.  Repeated rows
give a record each; a long page is one record whatever its length; an empty table gives no
archive and an empty result.  Only page id, URL and html are read, so further columns of
any name do not clash.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duescore.llm.common import slices, stage_path, staged

MIN_REVISIT_BYTES = 1000
CAPTURE_DATE = "20200101000000"
NO_URL = "urn:page:none"
#: Records of one WARC file; a file is read back as one row.
FILE_RECORDS = 5_000
#: Pages with one payload that go to one task.
HOT_ROWS = 1_000
END = "\r\n\r\n"

# The field names of ARC header lines by version.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}


@dataclass
class ArcRecord:
    version: int
    fields: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        """The block without its HTTP header, if it has one."""
        if self.block.startswith(b"HTTP/"):
            head, sep, body = self.block.partition(b"\r\n\r\n")
            return body if sep else b""
        return self.block


def arc_version_block(version: int, date: str = CAPTURE_DATE, name: str = "pages.arc") -> bytes:
    """The record that opens an ARC file and names the fields of its header lines."""
    body = f"{version} 0 pages\n{' '.join(ARC_FIELDS[version])}\n\n".encode()
    line = f"filedesc://{name} 0.0.0.0 {date} text/plain"
    if version == 2:
        line += f" 200 - - 0 {name}"
    return f"{line} {len(body)}\n".encode() + body


def arc_record(version: int, url: str, payload: bytes, offset: int, date: str = CAPTURE_DATE, http: bool = True) -> bytes:
    """One ARC record: header line, block of the declared length, line feed."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() if http else b""
    block = head + payload
    line = f"{url} 0.0.0.0 {date} text/html"
    if version == 2:
        line += f" 200 {hashlib.md5(payload).hexdigest()} - {offset} pages.arc"
    return f"{line} {len(block)}\n".encode() + block + b"\n"


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file after its version block, by their declared lengths."""
    data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    at = data.index(b"\n") + 1
    head = data[: at - 1].decode("latin-1").split(" ")
    if not head[0].startswith("filedesc://"):
        raise ValueError("an ARC file starts with a filedesc record")
    block = data[at : at + int(head[-1])]
    version = int(block.split(b" ", 1)[0])
    names = block.split(b"\n")[1].decode("latin-1").split()
    if version not in ARC_FIELDS or names != ARC_FIELDS[version]:
        raise ValueError(f"unknown ARC version {version}: {names}")
    at += int(head[-1])
    while True:
        while data[at : at + 1] == b"\n":  # line feeds between records
            at += 1
        if at >= len(data):
            return
        end = data.index(b"\n", at)
        values = data[at:end].decode("latin-1").split(" ")
        if len(values) != len(names):
            raise ValueError(f"ARC header line with {len(values)} fields, version {version} has {len(names)}")
        fields = dict(zip(names, values))
        size = int(fields["Archive-length"])
        if end + 1 + size > len(data):
            raise ValueError("ARC record shorter than its declared length")
        yield ArcRecord(version, fields, data[end + 1 : end + 1 + size])
        at = end + 1 + size


def warc_date(arc: str) -> str:
    """An ARC date of 14 digits (or a shorter one of older files) as a WARC timestamp."""
    d = (arc + "00000101000000"[len(arc) :])[:14] if len(arc) < 14 else arc
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(url: str, date: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{date} {digest} {url}')}>"


def clean_url(url: str | None) -> str:
    return quote(url, safe="%/:?#[]@!$&'()*+,;=~-._") if url else NO_URL


ARC_ROW = "page_id {kind}, url string, arc_date string, content_type string, digest string, payload_bytes bigint, payload binary"


def arc_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, version, arc): an ARC file of one record for each page; even ids as
    version 1, odd and null ids as version 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        openings = {v: arc_version_block(v) for v in ARC_FIELDS}
        for b in slices(batches, html_col):
            ids = b.column(id_col).to_pylist()
            versions = [1 if i is not None and i % 2 == 0 else 2 for i in ids]
            out = [
                openings[v] + arc_record(v, clean_url(u), (h or "").encode(), len(openings[v]))
                for v, u, h in zip(versions, b.column(url_col).to_pylist(), b.column(html_col).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([b.column(id_col), pa.array(versions, pa.int32()), pa.array(out, pa.binary())], names=["page_id", "version", "arc"])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, url_col, html_col).mapInArrow(run, f"page_id {kind}, version int, arc binary")


def arc_rows(arcs: DataFrame, arc_col: str = "arc") -> DataFrame:
    """One row per record of ARC files in a binary column, with the digest of its payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, arc_col):
            out: list[list] = [[] for _ in range(7)]
            for page, data in zip(b.column("page_id").to_pylist(), b.column(arc_col)):
                for r in parse_arc(data.as_py()):
                    payload = r.payload
                    row = (page, r.fields["URL"], r.fields["Archive-date"], r.fields["Content-type"], hashlib.sha1(payload).hexdigest(), len(payload), payload)
                    for column, value in zip(out, row):
                        column.append(value)
            kinds = [b.schema.field("page_id").type, pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(out, kinds)], names=["page_id", "url", "arc_date", "content_type", "digest", "payload_bytes", "payload"]
            )

    kind = arcs.schema["page_id"].dataType.simpleString()
    return arcs.select("page_id", arc_col).mapInArrow(run, ARC_ROW.format(kind=kind))


def warc_text(url: str, date: str, digest: str, payload: bytes, page: object, kept: object, kept_page_url: str | None, kept_date: str | None = None) -> bytes:
    """A response record, or with ``kept`` (page id and record id of the response) a
    revisit record, whose block is the HTTP header alone.  Without the closing lines."""
    named = base64.b32encode(bytes.fromhex(digest)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kept is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if kept is not None else 'response'}",
        f"WARC-Target-URI: {url}",
        f"WARC-Date: {date}",
        f"WARC-Record-ID: {record_id(url, date, digest + str(page))}",
        f"WARC-Payload-Digest: sha1:{named}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        f"X-Page-Id: {'' if page is None else page}",
    ]
    if kept is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {kept}",
            f"WARC-Refers-To-Target-URI: {kept_page_url}",
            f"WARC-Refers-To-Date: {kept_date or date}",
        ]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records of a WARC file, by their declared lengths."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        size = int(head["Content-Length"])
        at = end + 4 + size
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError("WARC record does not end where its length says")
        yield head, data[end + 4 : at]
        at += 4


def with_originals(rows: DataFrame, min_bytes: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``rows`` with the page id, URL and date of the record that each one revisits, or null.

    The response of each payload is found from narrow rows by a combinable maximum and
    joined by the digest.  Rows with their payloads go to as many tasks as a payload has
    ``hot_rows``: a digest that holds a share of all pages is salted (at most 1,000
    digests hold over a thousandth each, so their list is broadcast), and rows too small to
    revisit anything are spread by a hash of their own."""
    big = rows.where(F.col("payload_bytes") >= min_bytes)
    first = F.max(F.struct(F.col("page_id").alias("kept"), F.col("url").alias("kept_url"), F.col("arc_date").alias("kept_date")))
    groups = staged(big.groupBy("digest").agg(F.count("*").alias("n"), first.alias("g")).where("n > 1").select(F.col("digest").alias("of"), "n", "g.*"), "warc-groups")
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = groups.where(F.col("n") >= max(hot_rows, -(-total // 1_000))).select(F.col("of").alias("hot"), F.ceil(F.col("n") / hot_rows).cast("int").alias("salts"))
    own = F.xxhash64("page_id", "url", "arc_date")
    is_big = F.col("payload_bytes") >= min_bytes
    dealt = rows.join(F.broadcast(hot), F.col("digest") == F.col("hot"), "left").select(
        *rows.columns, F.when(is_big, F.col("digest")).otherwise(F.concat(F.lit("-"), own.cast("string"))).alias("_to"),
        F.when(is_big, F.coalesce(F.pmod(own, "salts"), F.lit(0))).otherwise(0).cast("int").alias("_salt"))
    spread = groups.join(F.broadcast(hot), F.col("of") == F.col("hot"), "left").select(
        F.col("of").alias("_to"), "kept", "kept_url", "kept_date", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("_salt"))
    marked = dealt.join(spread, ["_to", "_salt"], "left")
    revisits = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    return marked.select(*rows.columns, *[F.when(revisits, F.col(c)).alias(c) for c in ("kept", "kept_url", "kept_date")])


def warc_records(rows: DataFrame) -> DataFrame:
    """(page_id, record): the WARC text of every converted row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "payload"):
            out = []
            cols = [b.column(c).to_pylist() for c in ("page_id", "url", "arc_date", "digest", "payload", "kept", "kept_url", "kept_date")]
            for page, url, date, digest, payload, kept, kept_url, kept_date in zip(*cols):
                refers = None if kept is None else record_id(kept_url, warc_date(kept_date), digest + str(kept))
                out.append(warc_text(url, warc_date(date), digest, payload, page, refers, kept_url, None if kept is None else warc_date(kept_date)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    return rows.mapInArrow(run, "record binary")


def write_warcs(records: DataFrame, path: str) -> None:
    """gzip WARC files; every row is a record without its closing blank lines."""
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def read_warcs(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record: page_id, type, record and referred ids, full payload's
    length and digest.  The digest of a response is computed from its payload and must
    equal the stated one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = re.compile(rb"\r\nContent-Length: (\d+)\r\n", re.I)
        for b in batches:
            out: list[tuple] = []
            for data in b.column("content"):
                for head, block in parse_warc(gzip.decompress(data.as_py())):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    size = int(length.search(http + b"\r\n")[1])
                    if head["WARC-Type"] == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
                        raise ValueError(f"payload of {head['WARC-Record-ID']} differs from its digest")
                    page = head["X-Page-Id"]
                    out.append((int(page) if page else None, size, digest, head["WARC-Type"], head["WARC-Record-ID"], head.get("WARC-Refers-To")))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "record_id", "refers_to_id"],
            )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(
        run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, record_id string, refers_to_id string"
    )


def archived(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages as ARC, converted to WARC files in the shared folder and read back: one
    row per page, ``refers_to`` the page id of the response a revisit refers to."""
    spark = pages.sparkSession
    path = stage_path(spark, "warc")
    rows = with_originals(arc_rows(arc_pages(pages)), min_bytes)
    write_warcs(warc_records(rows), path)
    back = staged(read_warcs(spark, path), "warc-index")
    out = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id")
    # Only revisits are joined, and against a table: Spark can split a response that many refer to.
    named = back.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id")).agg(F.max("page_id").alias("refers_to"))
    revisits = back.where("record_type = 'revisit'").join(staged(named, "warc-responses"), "refers_to_id", "left").select(*out)
    return back.where("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("bigint")).select(*out).unionByName(revisits)
