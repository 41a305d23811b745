r"""WARC archives as chunked record tables.

A record is written as rows (archive, record, chunk, data, digest): chunk 0 is its header block, the others are slices of at most CHUNK bytes of
its content, and each row carries the SHA-1 of the payload up to its end, so a reader can check every step and no stage
has to hold a record of its own size beside the input. The rows of one record, in order, are the bytes of a WARC/1.1 record; the records
of an archive one after another are a WARC file (`export_archive`, `parse_file`).

Among records whose payloads are equal and at least REVISIT_BYTES long, the one with the largest page_id is the response and the others are
revisits without payload that refer to it by its record id, which is made of page and payload digest. Which they are is settled on narrow rows (digest, length, id). While there are
few of them they are broadcast and texts stay where they are; beyond, texts are moved once, by page, so copies of one payload spread evenly.

Defined results: a null html is an empty payload; a null url has no target line, and line breaks and control signs in a url are percent-encoded; rows that repeat page_id and payload
are separate records with the same outcome and the same record id; a null page_id is a record of its own, never a referred-to one, and a revisit if a page has its payload; other columns are ignored;
an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import arrow_stage, materialise, partitions, small

CHUNK = 1 << 20
REVISIT_BYTES = 1000
ARCHIVES = 64
#: All records carry this time, so that the same pages give the same archives.
DATE = "2024-01-01T00:00:00Z"
TABLE = "archive int, record long, chunk int, data binary, digest string"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _safe(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def header(kind: str, page: int | None, record: int, url: str | None, size: int, digest: str, refers_to: int | None, block: int) -> bytes:
    name = f"{page}:{digest}" if page is not None else f":{record}"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_safe(url)}")
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Bytes: {size}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}:{digest}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {block}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def parsed_header(data: bytes) -> dict[str, str]:
    first, *lines = data.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines if line)}


def _keyed(pages: DataFrame, page: str, url: str, html: str) -> DataFrame:
    payload = F.encode(F.coalesce(F.col(f"`{html}`"), F.lit("")), "UTF-8")
    rows = pages.select(F.monotonically_increasing_id().alias("record"), F.col(f"`{page}`").cast("long").alias("page"), F.col(f"`{url}`").alias("url"), payload.alias("payload"))
    return rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("sum", F.sha1("payload"))


def revisits(rows: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page, sum, refers_to) of the rows that revisit another page."""
    narrow = rows.filter(F.col("size") >= least).select("page", "sum", "size").distinct()
    keeper = narrow.filter("page is not null").groupBy("sum", "size").agg(F.max("page").alias("refers_to"))
    return narrow.join(keeper, ["sum", "size"]).filter("page is null or page <> refers_to").select("page", "sum", "refers_to")


def write_records(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", chunk: int = CHUNK, archives: int = ARCHIVES) -> DataFrame:
    """The chunked record table of all pages."""
    rows = _keyed(pages, page, url, html)
    marks = materialise(revisits(rows).select(F.col("page").alias("of_page"), F.col("sum").alias("of_sum"), "refers_to"), "revisits")
    marked = rows.join(small(marks), F.col("page").eqNullSafe(F.col("of_page")) & (F.col("sum") == F.col("of_sum")), "left")
    marked = marked.select("record", "page", "url", "size", "sum", "refers_to", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"))

    def make():
        def record(number, page, url, size, sum_, refers_to, payload) -> Iterator[tuple]:
            archive = number % archives
            if refers_to is not None:
                yield archive, number, 0, header("revisit", page, number, url, size, sum_, refers_to, len(_HTTP)), sum_
                yield archive, number, 1, _HTTP + b"\r\n\r\n", sum_
                return
            running = hashlib.sha1()
            yield archive, number, 0, header("response", page, number, url, size, sum_, None, len(_HTTP) + size) + _HTTP, running.hexdigest()
            view = memoryview(payload)
            for k, at in enumerate(range(0, max(size, 1), chunk)):
                part = view[at : at + chunk]
                running.update(part)
                yield archive, number, k + 1, bytes(part) + (b"\r\n\r\n" if at + chunk >= size else b""), running.hexdigest()

        def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, count = [], 0
            for batch in batches:
                texts = batch.column(6)
                for k, row in enumerate(zip(*(c.to_pylist() for c in batch.columns[:6]), strict=True)):
                    payload = texts[k].as_buffer() if row[5] is None else None
                    for out in record(*row, payload):
                        held.append(out)
                        count += len(out[3])
                        if count > 4 * chunk:
                            yield _batch(held)
                            held, count = [], 0
            if held:
                yield _batch(held)

        return stage

    return arrow_stage(marked, make, TABLE)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["archive", "record", "chunk", "data", "digest"])


class _Reader:
    """One record, read chunk by chunk; holds its header and a running digest, never its payload."""

    def __init__(self) -> None:
        self.head: dict[str, str] | None = None
        self.waiting = b""
        self.left = 0
        self.http = False
        self.size = 0
        self.sum = hashlib.sha1()

    def feed(self, data: bytes) -> None:
        if self.head is None:
            self.waiting += data
            end = self.waiting.find(b"\r\n\r\n")
            if end < 0:
                return
            self.head, data = parsed_header(self.waiting[:end]), self.waiting[end + 4 :]
            self.left, self.waiting, self.http = int(self.head["content-length"]), b"", True
        data = data[: self.left]
        self.left -= len(data)
        if self.http:
            self.waiting += data
            end = self.waiting.find(b"\r\n\r\n")
            if end < 0:
                return
            data, self.waiting, self.http = self.waiting[end + 4 :], b"", False
        self.size += len(data)
        self.sum.update(data)

    def result(self) -> tuple:
        """page_id, payload_bytes, payload_digest, record_type, refers_to; raises if the record is cut or its payload differs from its digest."""
        head = self.head or {}
        kind, digest, size = head.get("warc-type"), head.get("warc-payload-digest", "").removeprefix("sha1:"), int(head.get("x-payload-bytes", -1))
        if self.left or kind not in ("response", "revisit") or kind == "response" and (size, digest) != (self.size, self.sum.hexdigest()):
            raise ValueError(f"damaged record {head.get('warc-record-id')}")
        page = head["warc-record-id"].split(":")[2]
        refers_to = head["warc-refers-to"].split(":")[2] if kind == "revisit" else ""
        return int(page) if page else None, size, digest, kind, int(refers_to) if refers_to else None


RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_RESULT = (("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()))


def read_records(table: DataFrame) -> DataFrame:
    """A row for each record of a chunked record table; each record's chunks stream by in order, with checks of the running digests."""

    def make():
        def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, reader, out = None, None, []
            for batch in batches:
                for number, data, digest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    if number != at:
                        if reader is not None:
                            out.append(reader.result())
                        at, reader = number, _Reader()
                    reader.feed(data)
                    if reader.head and reader.head["warc-type"] == "response" and reader.sum.hexdigest() != digest:
                        raise ValueError(f"record {number}: the running digest differs")
                if out:
                    yield rows(out)
                    out = []
            if reader is not None:
                yield rows([reader.result()])

        def rows(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*out, strict=True), _RESULT, strict=True)], [n for n, _ in _RESULT])

        return stage

    dealt = table.repartition(partitions(table.sparkSession), "record").sortWithinPartitions("record", "chunk").select("record", "data", "digest")
    return arrow_stage(dealt, make, RESULT)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write every page's record to archives in the shared folder, and read the archives back."""
    return read_records(materialise(write_records(pages), "warc"))


def export_archive(table: DataFrame, archive: int, out: BinaryIO) -> int:
    """Write one archive of a chunked record table as a WARC file, a chunk at a time; returns its number of bytes."""
    n = 0
    for row in table.filter(F.col("archive") == archive).orderBy("record", "chunk").select("data").toLocalIterator(prefetchPartitions=True):
        n += out.write(row.data)
    return n


def parse_file(stream: BinaryIO, chunk: int = CHUNK) -> Iterator[tuple]:
    """The records of a WARC file, as `read_records` gives them, with the memory of one chunk."""
    while line := stream.readline():
        reader = _Reader()
        while line and line != b"\r\n":
            reader.feed(line)
            line = stream.readline()
        reader.feed(line)
        while reader.left:
            part = stream.read(min(chunk, reader.left))
            if not part:
                break
            reader.feed(part)
        yield reader.result()
        stream.read(4)
