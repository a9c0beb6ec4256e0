"""Converter from legacy ARC archives, versions 1 and 2, to WARC.

An ARC file begins with a version block that says how the header lines of its
records read: in version 1 `URL IP-address Archive-date Content-type
Archive-length`, in version 2 with result code, checksum, location, offset and
file name before the length. Each record is a header line, as many bytes as the
line declares, and a newline. The converter reads both, and makes WARC records
of the same content: identifiers are name-based UUIDs, so that they are the same
in each run; dates, types and digests follow from the ARC fields and the block.

Archives are written by Spark's text writer, one record a row, since every ARC
and WARC record ends with the newline that the writer adds; they may thus lie in
any store that Spark writes to. An archive is what one task writes.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.llm.repeats import partitions
from tickline.llm.shared import new_folder

#: Least payload, in bytes, that a later equal one may refer to.
REVISIT_BYTES = 100
CAPTURED = "20240101000000"
IP = "0.0.0.0"
FIELDS = {1: b"URL IP-address Archive-date Content-type Archive-length", 2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "warc-record")
PIECE = 1 << 20


def _url_field(url: str | None) -> bytes:
    """The URL as a header field holds it: no blanks, no controls, ASCII."""
    return b"".join(bytes([b]) if 0x20 < b < 0x7F else b"%%%02X" % b for b in (url or "").encode()) or b"-"


def version_block(version: int, name: str, date: str = CAPTURED) -> bytes:
    body = b"%d 0 tickline\n%s\n" % (version, FIELDS[version])
    line = b"filedesc://%s %s %s text/plain " % (name.encode(), IP.encode(), date.encode())
    if version == 2:
        line += b"200 - - 0 %s " % name.encode()
    return line + b"%d\n%s" % (len(body), body)


def arc_record(version: int, page_id: int | None, url: str | None, payload: bytes, name: str, offset: int, date: str = CAPTURED) -> bytes:
    """One record without its closing newline."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if page_id is not None:
        head += b"X-Page-Id: %d\r\n" % page_id
    body = head + b"\r\n" + payload
    line = b"%s %s %s text/html " % (_url_field(url), IP.encode(), date.encode())
    if version == 2:
        line += b"200 %s - %d %s " % (hashlib.md5(body).hexdigest().encode(), offset, name.encode())
    return line + b"%d\n%s" % (len(body), body)


def _to_arc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task = TaskContext.get()
    number = task.partitionId() if task else 0
    version, name, offset = 1 + number % 2, f"part-{number}.arc", 0
    for batch in batches:
        out, size = [], 0
        if not offset:
            out.append(version_block(version, name))
            offset += len(out[0]) + 1
        for page, url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            out.append(arc_record(version, page, url, (html.as_py() or "").encode(), name, offset))
            offset += len(out[-1]) + 1
            size += len(out[-1])
            if size > PIECE:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])


def save(records: DataFrame, path: str) -> None:
    """Writes rows of record bytes (without the closing newline) as gzip archives."""
    records.select(F.col("record").cast("string").alias("value")).write.option("compression", "gzip").option("lineSep", "\n").text(path)


def write_arc(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    save(pages.select(F.col(id_col).cast("bigint"), F.col(url_col), F.col(html_col)).mapInArrow(_to_arc, "record binary"), path)


class _Reader:
    """Lines and blocks of an archive, plain or gzip of one or many members, held a piece at a time."""

    def __init__(self, raw: memoryview) -> None:
        self.raw, self.at, self.have, self.done = raw, 0, bytearray(), 0
        self.inflate = zlib.decompressobj(31) if bytes(raw[:2]) == b"\x1f\x8b" else None

    def _more(self) -> bool:
        if self.at >= len(self.raw) and not (self.inflate and self.inflate.unconsumed_tail):
            return False
        if self.inflate is None:
            self.have += self.raw[self.at : self.at + PIECE]
            self.at += PIECE
            return True
        piece = self.inflate.unconsumed_tail or self.raw[self.at : self.at + PIECE // 4]
        if not self.inflate.unconsumed_tail:
            self.at += PIECE // 4
        self.have += self.inflate.decompress(piece, PIECE)
        if self.inflate.eof:
            self.at = min(self.at, len(self.raw)) - len(self.inflate.unused_data)
            self.inflate = zlib.decompressobj(31)
        return True

    def line(self) -> bytes | None:
        """The next line without its newline; None at the end."""
        seen = 0
        while (end := self.have.find(b"\n", seen)) < 0:
            seen = len(self.have)
            if not self._more():
                return None
        out = bytes(self.have[:end])
        del self.have[: end + 1]
        self.done += end + 1
        return out

    def block(self, size: int) -> bytes:
        while len(self.have) < size:
            if not self._more():
                raise ValueError(f"record of {size} bytes is cut off after {len(self.have)}")
        out = bytes(self.have[:size])
        del self.have[:size]
        self.done += size
        return out


@dataclass
class ArcRecord:
    offset: int
    url: bytes
    ip: bytes
    date: bytes
    mime: bytes
    block: bytes


def parse_arc(raw: memoryview) -> Iterator[ArcRecord]:
    """The records of an ARC file but for its version block."""
    reader, fields = _Reader(raw), len(FIELDS[1].split())
    while True:
        offset = reader.done
        line = reader.line()
        if line is None:
            return
        if not line.strip():
            continue
        parts = line.rstrip(b"\r").split(b" ")
        if parts[0].startswith(b"filedesc://"):
            block = reader.block(int(parts[-1]))
            named = block.split(b"\n")
            fields = len(named[1].split()) if len(named) > 1 and named[1].split() else fields
            continue
        if len(parts) < fields:
            raise ValueError(f"header line has {len(parts)} fields where its version has {fields}")
        tail = parts[-(fields - 1) :]
        yield ArcRecord(offset, b"%20".join(parts[: len(parts) - fields + 1]), tail[0], tail[1], tail[2], reader.block(int(tail[-1])))


def http_parts(block: bytes) -> tuple[dict[bytes, bytes], bytes]:
    """Header fields, lower-case, and body of an HTTP response; a block that is none is all body."""
    if not block.startswith(b"HTTP/"):
        return {}, block
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        head, _, body = block.partition(b"\n\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.splitlines()[1:])}, body


def warc_date(arc_date: bytes) -> bytes:
    """ISO form of the 14 digits (or 12, or 8) of an ARC date."""
    d = (arc_date + b"00000000000000")[:14] if len(arc_date) >= 8 else b"19700101000000"
    return b"%s-%s-%sT%s:%s:%sZ" % (d[:4], d[4:6], d[6:8], d[8:10], d[10:12], d[12:14])


def record_id(url: bytes, date: bytes, digest: bytes, page: bytes) -> bytes:
    return b"<urn:uuid:%s>" % str(uuid.uuid5(NAMESPACE, (b" ".join((url, date, digest, page))).decode("latin-1"))).encode()


def warc_record(fields: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    """One record without the last of its closing newlines."""
    head = b"".join(b"%s: %s\r\n" % f for f in fields)
    return b"WARC/1.1\r\n%sContent-Length: %d\r\n\r\n%s\r\n\r" % (head, len(block), block)


def _details(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What deciding on types needs: record, page, digest, payload length, url and date."""
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            rows = []
            for r in parse_arc(memoryview(content.as_buffer())):
                head, payload = http_parts(r.block)
                page = head.get(b"x-page-id")
                rows.append((f"{path}#{r.offset}", int(page) if page else None, hashlib.sha256(payload).hexdigest(), len(payload), r.url.decode("latin-1"), warc_date(r.date).decode()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["rec", "page", "digest", "size", "url", "date"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            held, size = [], 0
            for r in parse_arc(memoryview(content.as_buffer())):
                held.append((f"{path}#{r.offset}", r.url, r.ip, r.date, r.block))
                size += len(r.block)
                if size > PIECE:
                    yield _block_batch(held)
                    held, size = [], 0
            if held:
                yield _block_batch(held)


def _block_batch(held: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), (pa.string(), *(pa.binary(),) * 4), strict=True)], names=["rec", "url", "ip", "date", "block"])


def _to_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = True
    for batch in batches:
        out, size = [], 0
        if first:
            info = b"software: tickline\r\nformat: WARC File Format 1.1\r\n"
            out.append(warc_record([(b"WARC-Type", b"warcinfo"), (b"WARC-Date", warc_date(CAPTURED.encode())), (b"WARC-Record-ID", record_id(b"warcinfo", b"", b"", b"")), (b"Content-Type", b"application/warc-fields")], info))
            first = False
        for url, ip, date, block, of_page, of_url, of_date in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            head, payload = http_parts(block)
            digest, page, when = hashlib.sha256(payload).hexdigest().encode(), head.get(b"x-page-id", b""), warc_date(date)
            fields = [(b"WARC-Type", b"response" if of_url is None else b"revisit"), (b"WARC-Target-URI", url), (b"WARC-Date", when), (b"WARC-IP-Address", ip), (b"WARC-Record-ID", record_id(url, when, digest, page)), (b"WARC-Payload-Digest", b"sha256:" + digest)]
            if of_url is not None:
                of_url, of_date, of = of_url.encode("latin-1"), of_date.encode(), b"" if of_page is None else b"%d" % of_page
                fields += [(b"WARC-Profile", PROFILE), (b"WARC-Refers-To", record_id(of_url, of_date, digest, of)), (b"WARC-Refers-To-Target-URI", of_url), (b"WARC-Refers-To-Date", of_date), (b"X-Refers-To-Page-Id", of), (b"X-Payload-Length", b"%d" % len(payload))]
                block = block[: len(block) - len(payload)]
            fields += [(b"WARC-Block-Digest", b"sha256:" + hashlib.sha256(block).hexdigest().encode()), (b"Content-Type", b"application/http; msgtype=response")]
            out.append(warc_record(fields, block))
            size += len(out[-1])
            if size > PIECE:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])


def _archives(spark: SparkSession, path: str) -> DataFrame:
    """The archives in a folder, whatever their names; files whose names begin with a dot or an underscore are none."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def convert(spark: SparkSession, arc_path: str, warc_path: str) -> None:
    """Writes WARC archives of the records of ARC archives.

    Of records with equal payloads of at least REVISIT_BYTES, the one with the
    smallest page id (records without one last; then by place) becomes a
    response and the others revisits of it.
    """
    details = _archives(spark, arc_path).mapInArrow(_details, "rec string, page bigint, digest string, size bigint, url string, date string")
    large = details.where(F.col("size") >= REVISIT_BYTES)
    order = F.struct(F.col("page").isNull().alias("none"), "page", "rec", "url", "date")
    first = large.groupBy("digest").agg(F.min(order).alias("of"), F.count("*").alias("n")).where("n > 1").select("digest", "of")
    revisits = large.select("rec", "digest").join(first, "digest").where("rec != of.rec").select("rec", F.col("of.page").alias("of_page"), F.col("of.url").alias("of_url"), F.col("of.date").alias("of_date"))
    blocks = _archives(spark, arc_path).mapInArrow(_blocks, "rec string, url binary, ip binary, date binary, block binary")
    typed = blocks.repartition(partitions(spark), "rec").join(revisits.hint("shuffle_hash"), "rec", "left").select("url", "ip", "date", "block", "of_page", "of_url", "of_date")
    save(typed.mapInArrow(_to_warc, "record binary"), warc_path)


def parse_warc(raw: memoryview) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """(fields with lower-case names, block) of each record."""
    reader = _Reader(raw)
    while (line := reader.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a record does not begin with its version")
        fields = {}
        while (line := reader.line()) is not None and line.strip():
            name, _, value = line.partition(b":")
            fields[name.strip().lower()] = value.strip()
        yield fields, reader.block(int(fields[b"content-length"]))


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(1):
            rows = []
            for fields, block in parse_warc(memoryview(content.as_buffer())):
                kind = fields[b"warc-type"].decode()
                if kind not in ("response", "revisit"):
                    continue
                head, payload = http_parts(block)
                digest = fields[b"warc-payload-digest"].partition(b":")[2].decode()
                if kind == "response" and digest != hashlib.sha256(payload).hexdigest():
                    raise ValueError("a payload does not have the digest that its record declares")
                page, of = head.get(b"x-page-id"), fields.get(b"x-refers-to-page-id")
                size = len(payload) if kind == "response" else int(fields[b"x-payload-length"])
                rows.append((int(page) if page else None, size, digest, kind, int(of) if of else None, fields[b"warc-record-id"].decode(), fields[b"warc-target-uri"].decode("latin-1"), fields[b"warc-date"].decode()))
            if rows:
                types = (pa.int64(), pa.int64(), *(pa.string(),) * 2, pa.int64(), *(pa.string(),) * 3)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "target_uri", "date"])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row for each response or revisit; a response whose digest is wrong is an error."""
    return _archives(spark, path).mapInArrow(_read_back, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, record_id string, target_uri string, date string")


def archive_pages(pages: DataFrame, folder: str | None = None, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages as ARC archives, converted to WARC in `folder` and read back; one row for each page.

    A null html is an empty payload, a null url is `-`. Rows with equal ids are
    records of their own. Without pages there are no records. The ids must be
    integers. Without a folder, a new one in the session's shared folder is used.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "archives")
    write_arc(pages, f"{folder}/arc", id_col=id_col, url_col=url_col, html_col=html_col)
    convert(spark, f"{folder}/arc", f"{folder}/warc")
    return read_warc(spark, f"{folder}/warc").withColumnRenamed("page_id", id_col)
