"""WARC archives: writing page captures, and assembling transactions from records.

``write_pages`` makes a request, a response or revisit, and a metadata record for
every page. Of pages with equal payloads of at least ``least_revisit`` bytes the one
with the smallest id is the response, the others are revisits that refer to it.
Archives are whole-file gzip, so any gunzip gives plain WARC/1.1; every record ends
with the two line ends that Spark's text writer puts behind a row, and a file holds
a bounded number of records.

``read_records`` parses archives by Content-Length, one file at a time.
``captures`` joins the records of a transaction through their concurrent-to
identifiers, whichever side carries them, and gives one nested row per response,
revisit or resource. Only ids are grouped; a group is one transaction.

A null payload counts as empty; a null url leaves out the target URI; characters
that a header can't hold are percent-encoded. Null ids come last in the order of
ids. Of repeated rows with the smallest id all are responses. An empty table
writes no record and reads back no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDS_PER_FILE = 15_000
#: Packed bytes that are unpacked together.
FED_BYTES = 1 << 16
DATE = "2000-01-01T00:00:00Z"
_URL = re.compile(r"(?:[A-Za-z][\w+.-]*://([^/?#]*))?([^?#]*)(\?[^#]*)?")
#: Every printable ASCII sign stays as it is in a header.
_HEADER_SAFE = "".join(map(chr, range(0x21, 0x7F)))

RECORD = ("record_id string, type string, concurrent_to string, target_uri string, date string, refers_to string, "
          "content_type string, payload_digest string, payload_bytes bigint, block binary, payload binary")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()  # 20 bytes: no padding


def record_id(kind: str, page_id, row: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{kind}/{page_id}/{row}'.encode()).digest())}>"


def record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payloads = [x or b"" for x in batch.column("payload").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("page_id"), pa.array([digest_of(x) for x in payloads]),
             pa.array([len(x) for x in payloads], pa.int64())], ["row", "page_id", "digest", "size"])


def revisits(pages: DataFrame, least_revisit: int) -> DataFrame:
    """``row, first_id, first_row`` of the pages whose payload a page with a smaller id has."""
    seen = pages.mapInArrow(_digests, "row bigint, page_id bigint, digest string, size bigint").where(
        F.col("size") >= least_revisit)
    place = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row")
    # Partial minima per task: a payload that a third of the pages share moves few rows here.
    firsts = seen.groupBy("digest", "size").agg(F.min(place).alias("first"), F.count("*").alias("n")).where(F.col("n") > 1)
    same = F.col("first.page_id").eqNullSafe(F.col("page_id"))
    return seen.join(firsts, ["digest", "size"]).where(~same).select(
        "row", F.col("first.page_id").alias("first_id"), F.col("first.row").alias("first_row"))


def write_pages(pages: DataFrame, path: str, least_revisit: int = 0, date: str = DATE) -> None:
    """Write ``pages`` (page_id, url, html) as archives under ``path``."""
    pages = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"), F.col("html").cast("binary").alias("payload"))
    linked = pages.join(revisits(pages.select("row", "page_id", "payload"), least_revisit), "row", "left")

    def transaction(row: int, page_id, url: str | None, payload: bytes, first_id, first_row) -> list[bytes]:
        uri = None if url is None else quote(url, safe=_HEADER_SAFE)
        host, path, query = _URL.match(uri or "").groups()
        main, digest = record_id("response", page_id, row), f"sha1:{digest_of(payload)}"
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
        common = [("WARC-Date", date), ("WARC-Target-URI", uri)]
        request = record(
            [("WARC-Type", "request"), ("WARC-Record-ID", record_id("request", page_id, row)), *common,
             ("WARC-Concurrent-To", main), ("Content-Type", "application/http; msgtype=request")],
            f"GET {path or '/'}{query or ''} HTTP/1.1\r\nHost: {host or ''}\r\n\r\n".encode())
        again = first_row is not None
        answer = record(
            [("WARC-Type", "revisit" if again else "response"), ("WARC-Record-ID", main), *common,
             ("WARC-Refers-To", record_id("response", first_id, first_row) if again else None),
             ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if again else None),
             ("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response")],
            http.encode() + (b"" if again else payload))
        fields = f"page-id: {page_id}\r\n" if page_id is not None else ""
        metadata = record(
            [("WARC-Type", "metadata"), ("WARC-Record-ID", record_id("metadata", page_id, row)), *common,
             ("WARC-Concurrent-To", main), ("Content-Type", "application/warc-fields")], fields.encode())
        return [request, answer, metadata]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "page_id", "url", "payload", "first_id", "first_row"]
        for batch in batches:
            out, held = [], 0
            for values in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                row, page_id, url, payload, first_id, first_row = values
                out += transaction(row, page_id, url, payload or b"", first_id, first_row)
                held += len(payload or b"")
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    (linked.mapInArrow(records, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


class BrokenArchive(ValueError):
    """An archive that ends too early or holds something else than records from here on."""


def unpacked(packed: bytes) -> Iterator[bytes]:
    """Contents of an archive in pieces: of all its gzip members, usually one a record, or as it is."""
    view, at = memoryview(packed), 0
    while at < len(view):
        if view[at:at + 2] != b"\x1f\x8b":
            yield bytes(view[at:])
            return
        member = zlib.decompressobj(31)
        while not member.eof:
            if at >= len(view):
                raise BrokenArchive("the last gzip member is cut off")
            fed = view[at:at + FED_BYTES]
            try:
                piece = member.decompress(fed)
            except zlib.error as error:
                raise BrokenArchive(str(error)) from error
            at += len(fed) - len(member.unused_data)
            if piece:
                yield piece


def parse(archive: bytes | Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names lowered) and block of every record of an unpacked archive, of which one record is held at a time."""
    held, at = bytearray(), 0
    pieces = iter([archive] if isinstance(archive, bytes) else archive)

    def have(n: int) -> bool:
        nonlocal at
        while len(held) - at < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            del held[:at]
            at = 0
            held.extend(piece)
        return True

    while have(1):
        # Line ends between records; some writers leave more or less than two.
        if held[at] in b"\r\n":
            at += 1
            continue
        sought = 0
        while (end := held.find(b"\r\n\r\n", at + sought)) < 0:
            sought = max(0, len(held) - at - 3)
            if len(held) - at >= 5 and not held.startswith(b"WARC/", at) or not have(len(held) - at + 1):
                raise BrokenArchive("no record where one should begin")
        version, *lines = held[at:end].decode("utf-8", "replace").split("\r\n")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        if not version.startswith("WARC/") or not headers.get("content-length", "").isdigit() or "warc-type" not in headers:
            raise BrokenArchive("no record where one should begin")
        at, size = end + 4, int(headers["content-length"])
        if not have(size):
            raise BrokenArchive("the last record is cut off")
        block = bytes(held[at:at + size])
        at += size
        yield headers, block


def _http_payload(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, body


def _row_of(headers: dict[str, str], block: bytes, payload_too: bool) -> tuple:
    kind = headers["warc-type"]
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    size, payload = None, None
    if kind in ("response", "revisit") and headers.get("content-type", "").startswith("application/http"):
        http, payload = _http_payload(block)
        if kind == "revisit":
            size, payload = int(http["content-length"]) if "content-length" in http else None, None
        else:
            size, found = len(payload), digest_of(payload)
            if digest not in (None, found):
                raise ValueError(f"payload of {headers['warc-record-id']} has digest {found}, not {digest}")
            digest = found
    elif kind == "resource":
        size, payload, digest = len(block), block, digest_of(block)
    keep = payload_too or kind not in ("response", "resource")
    return (headers["warc-record-id"], kind, headers.get("warc-concurrent-to"), headers.get("warc-target-uri"),
            headers.get("warc-date"), headers.get("warc-refers-to"), headers.get("content-type"), digest, size,
            block if keep and payload is None else None, payload if keep else None)


def _broken(error: Exception, record_id: str | None = None) -> tuple:
    return (record_id, "broken", *[None] * 7, str(error).encode(), None)


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record; without ``payloads`` only their sizes and digests, checked against the headers.

    What can't be read is a row of type ``broken`` with the reason as its block: a record whose payload hasn't the digest it
    names, or the rest of an archive that is cut off or no archive. All records before it are kept.
    """
    kinds = [pa.string()] * 8 + [pa.int64(), pa.binary(), pa.binary()]
    names = [c.split()[0] for c in RECORD.split(", ")]

    def rows_of(packed: bytes) -> Iterator[tuple[tuple, int]]:
        try:
            for headers, block in parse(unpacked(packed)):
                try:
                    yield _row_of(headers, block, payloads), len(block)
                except (ValueError, KeyError) as error:
                    yield _broken(error, headers.get("warc-record-id")), 0
        except BrokenArchive as error:
            yield _broken(error), 0

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for row, size in rows_of(content.as_py()):
                    rows.append(row)
                    held += size * payloads + 500
                    if held > 8 << 20:
                        yield out(rows)
                        rows, held = [], 0
                yield out(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(unpack, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per transaction: the captured record, its ``requests`` and its ``metadata``."""
    main = records.where(F.col("type").isin("response", "revisit", "resource"))
    others = records.where(F.col("type").isin("request", "metadata")).select(
        "record_id", "type", "concurrent_to", "date", "content_type", "block")
    # A captured record may name its request instead of being named by it.
    named = main.where(F.col("concurrent_to").isNotNull()).select(
        F.col("record_id").alias("named_by"), F.col("concurrent_to").alias("record_id"))
    keyed = others.join(named, "record_id", "left").withColumn("capture", F.coalesce("named_by", "concurrent_to"))
    part = F.struct("record_id", "date", "content_type", "block")
    grouped = keyed.where(F.col("capture").isNotNull()).groupBy("capture").agg(*(
        F.array_sort(F.collect_list(F.when(F.col("type") == kind, part))).alias(name)
        for kind, name in (("request", "requests"), ("metadata", "metadata"))))
    joined = main.join(grouped, main["record_id"] == grouped["capture"], "left")
    return joined.select(
        main["record_id"], "target_uri",
        F.struct("type", "date", "refers_to", "content_type", "payload_digest", "payload_bytes", "payload").alias("answer"),
        "requests", "metadata")


def page_ids(found: DataFrame) -> DataFrame:
    """``captures`` with ``page_id``, and ``refers_to_page``, the id of the page whose capture a revisit refers to."""
    text = F.col("metadata")[0]["block"].cast("string")
    number = F.regexp_extract(text, r"page-id: (-?\d+)", 1)
    own = found.withColumn("page_id", F.when(number != "", number.cast("long")))
    # Only captures that some revisit refers to are looked up.
    target = own.where(F.col("answer.type") == "response").select(
        F.col("record_id").alias("target_id"), F.col("page_id").alias("refers_to_page"))
    return own.join(target, F.col("answer.refers_to") == F.col("target_id"), "left").drop("target_id")
