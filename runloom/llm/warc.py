"""WARC archives as a Python data source, and pages written with revisit records.

The writer stores each record as a gzip member of its own whose extra field ``sl`` holds
the member's length. Every task writes a file with a name of its own; the commit lists
the files of the tasks that succeeded in a manifest, with the offsets where blocks of
members begin, so what a lost or repeated attempt left is never read.

The reader plans a partition per block from the manifest. Filters on header columns are
pushed down: of each member the headers are inflated first; a record that a filter
excludes is skipped by its member length, and so is the payload of a wanted record unless
payloads or their verification are asked for.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    StringStartsWith,
    WriterCommitMessage,
)

from .support import fresh_path, stored

MANIFEST = "manifest.json"
BLOCK_BYTES = 8 << 20
#: Payloads from this size on may be revisits.
REVISIT_BYTES = 1000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"
#: Columns of the reader; the payload comes only with the option of that name.
COLUMNS = {
    "record_id": "string",
    "record_type": "string",
    "target_uri": "string",
    "refers_to": "string",
    "payload_digest": "string",
    "payload_bytes": "long",
}
_ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _place(path: str) -> tuple[arrow_fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return arrow_fs.LocalFileSystem(), path
    return arrow_fs.FileSystem.from_uri(path)


def gzip_member(content: bytes, level: int = 6) -> bytes:
    """A gzip member that says in its extra field how long it is, packed and unpacked."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = packer.compress(content) + packer.flush()
    total = 10 + 2 + 12 + len(packed) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + (12).to_bytes(2, "little") + b"sl" + (8).to_bytes(2, "little")
    sizes = (total & 0xFFFFFFFF).to_bytes(4, "little") + (len(content) & 0xFFFFFFFF).to_bytes(4, "little")
    tail = zlib.crc32(content).to_bytes(4, "little") + (len(content) & 0xFFFFFFFF).to_bytes(4, "little")
    return head + sizes + packed + tail


def warc_record(headers: dict[str, str], content: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in headers.items()], f"Content-Length: {len(content)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + content + b"\r\n\r\n"


def page_record(page: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """A response with its payload, or a revisit of the record that has it."""
    headers = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": f"<urn:page:{page}>", "WARC-Date": "1970-01-01T00:00:00Z"}
    if url is not None:
        headers["WARC-Target-URI"] = quote(url, safe=":/?#[]@!$&'()*+,;=%~")
    headers["WARC-Payload-Digest"] = f"sha1:{digest}"
    if refers_to is not None:
        headers |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    headers["Content-Type"] = "application/http; msgtype=response"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return warc_record(headers, http if refers_to is not None else http + payload)


@dataclass
class WrittenFile(WriterCommitMessage):
    name: str
    blocks: list = field(default_factory=list)


class WarcWriter(DataSourceArrowWriter):
    """Takes rows ``(page, url, payload, digest, refers_to)``, all text but the payload."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, root = _place(self.path)
        system.create_dir(root, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        starts, offset = [0], 0
        with system.open_output_stream(f"{root}/{name}", compression=None) as out:
            info = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "Content-Type": "application/warc-fields"}
            member = gzip_member(warc_record(info, b"format: WARC File Format 1.1\r\n"))
            out.write(member)
            offset += len(member)
            for batch in iterator:
                for page, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    if offset - starts[-1] >= BLOCK_BYTES:
                        starts.append(offset)
                    member = gzip_member(page_record(page, url, payload, digest, refers_to))
                    out.write(member)
                    offset += len(member)
        return WrittenFile(name, [list(b) for b in zip(starts, [*starts[1:], offset])])

    def commit(self, messages: list) -> None:
        system, root = _place(self.path)
        system.create_dir(root, recursive=True)
        files = [{"name": m.name, "blocks": m.blocks} for m in messages if m is not None]
        with system.open_output_stream(f"{root}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list) -> None:
        system, root = _place(self.path)
        for m in messages:
            if m is not None:
                system.delete_file(f"{root}/{m.name}")


@dataclass
class Block(InputPartition):
    name: str
    start: int
    end: int

    def __init__(self, name: str, start: int, end: int):
        super().__init__(None)
        self.name, self.start, self.end = name, start, end


def _member_length(data: memoryview, at: int) -> tuple[int, int | None]:
    """Where a member's packed bytes begin, and its whole length if it says so."""
    flags, begin, length = data[at + 3], at + 10, None
    if flags & 4:
        size = int.from_bytes(data[begin : begin + 2], "little")
        extra = bytes(data[begin + 2 : begin + 2 + size])
        k = 0
        while k + 4 <= len(extra):
            n = int.from_bytes(extra[k + 2 : k + 4], "little")
            if extra[k : k + 2] == b"sl":
                length = int.from_bytes(extra[k + 4 : k + 8], "little")
            k += 4 + n
        begin += 2 + size
    for flag in (8, 16):
        if flags & flag:
            begin = at + bytes(data[at:]).index(b"\0", begin - at) + 1
    return begin + 2 * bool(flags & 2), length


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode().split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines) if k}


def _name(urn: str | None) -> str | None:
    return urn.strip("<>").removeprefix("urn:page:") if urn is not None else None


def read_records(data: bytes, wants, payload: bool, verify: bool) -> Iterator[tuple]:
    """Rows of the wanted records of a block of gzip members; ``wants`` judges a header row."""
    view, at = memoryview(data), 0
    while at < len(view):
        begin, length = _member_length(view, at)
        inflate = zlib.decompressobj(-15)
        packed = view[begin : at + length] if length else view[begin:]
        text = inflate.decompress(packed, 2048)
        while b"\r\n\r\n" not in text and inflate.unconsumed_tail:
            text += inflate.decompress(inflate.unconsumed_tail, 2048)
        head, _, rest = text.partition(b"\r\n\r\n")
        h = _headers(head)
        kind = h.get("warc-type")
        uri = h.get("warc-target-uri")
        row = [_name(h.get("warc-record-id")), kind, unquote(uri) if uri is not None else None, _name(h.get("warc-refers-to")), h.get("warc-payload-digest", "").removeprefix("sha1:") or None]
        wanted = wants(row)
        full = wanted and kind == "response" and (payload or verify)
        if full or length is None:
            rest += inflate.decompress(inflate.unconsumed_tail)
        at = at + length if length else len(view) - len(inflate.unused_data) + 8
        if not wanted:
            continue
        while kind in ("response", "revisit") and b"\r\n\r\n" not in rest and inflate.unconsumed_tail:
            rest += inflate.decompress(inflate.unconsumed_tail, 2048)
        http, _, body = rest.partition(b"\r\n\r\n")
        size = _headers(http).get("content-length") if kind in ("response", "revisit") else None
        size = int(size) if size is not None else None
        content = None
        if full:
            content = body[:size]
            if verify and (len(content) != size or hashlib.sha1(content).hexdigest() != row[4]):
                raise ValueError(f"record {row[0]}: the payload is not the one of its digest")
        yield (*row, size, *([content] if payload else []))


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema, payload: bool, verify: bool):
        self.path, self.payload, self.verify = path, payload, verify
        self.names = [f.name for f in schema.fields]
        self.kinds = [_ARROW["long" if f.dataType.simpleString() == "bigint" else f.dataType.simpleString()] for f in schema.fields]
        self.tests: list[tuple[int, str, object]] = []

    def pushFilters(self, filters):
        headers = list(COLUMNS)[:5]
        for one in filters:
            column = one.attribute[0] if getattr(one, "attribute", None) else None
            if column in headers and isinstance(one, EqualTo):
                self.tests.append((headers.index(column), "in", (one.value,)))
            elif column in headers and isinstance(one, In):
                self.tests.append((headers.index(column), "in", tuple(one.value)))
            elif column in headers and isinstance(one, StringStartsWith):
                self.tests.append((headers.index(column), "starts", one.value))
            else:
                yield one

    def partitions(self):
        system, root = _place(self.path)
        with system.open_input_stream(f"{root}/{MANIFEST}", compression=None) as manifest:
            files = json.loads(manifest.read())
        return [Block(f["name"], *b) for f in files for b in f["blocks"]] or [Block("", 0, 0)]

    def _wants(self, row: list) -> bool:
        for k, how, value in self.tests:
            if row[k] is None or (row[k] not in value if how == "in" else not row[k].startswith(value)):
                return False
        return True

    def read(self, partition: Block) -> Iterator[pa.RecordBatch]:
        data = b""
        if partition.name:
            system, root = _place(self.path)
            with system.open_input_file(f"{root}/{partition.name}") as file:
                data = file.read_at(partition.end - partition.start, partition.start)
        rows: list[tuple] = []
        for row in read_records(data, self._wants, self.payload, self.verify):
            rows.append(row)
            if len(rows) == (100 if self.payload else 5000):
                yield self._batch(rows)
                rows = []
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), self.kinds)], self.names)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)``; options ``payload`` and ``verify``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def _flag(self, name: str) -> bool:
        return str(self.options.get(name, "false")).lower() == "true"

    def schema(self) -> str:
        extra = {"payload": "binary"} if self._flag("payload") else {}
        return ", ".join(f"{c} {t}" for c, t in (COLUMNS | extra).items())

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], schema, self._flag("payload"), self._flag("verify"))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark) -> None:
    spark.conf.set(PUSHDOWN_CONF, "true")
    spark.dataSource.register(WarcSource)


def write_pages(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write one record per row of ``pages``.

    Of rows with equal payloads of at least ``REVISIT_BYTES`` bytes, those with the largest
    key are responses and the others revisit them. Only digests are grouped; a digest that
    occurs once is not joined to anything.
    """
    register(pages.sparkSession)
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    digest = F.sha1(payload)
    large = F.octet_length(payload) >= REVISIT_BYTES
    sizes = pages.filter(large).select(digest.alias("same"), F.col(key).alias("key"))
    repeated = stored(sizes.groupBy("same").agg(F.max("key").alias("original"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "repeated-payloads")
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), payload.alias("payload"), digest.alias("digest"))
    joined = rows.join(repeated, F.col("digest") == F.col("same"), "left")
    refers = F.when(~F.col("key").eqNullSafe(F.col("original")), F.col("original")).cast("string")
    page = F.coalesce(F.col("key").cast("string"), F.lit(""))
    joined.select(page.alias("page"), "url", "payload", "digest", refers.alias("refers_to")).write.format("warc").mode("append").save(path)


def archive_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", path: str | None = None) -> DataFrame:
    """``(key, payload_bytes, payload_digest, record_type, refers_to)`` as read back.

    A null or empty page is a response of 0 bytes. Rows of one key and payload are all
    responses; a null key revisits a record that has a key, and is a response otherwise.
    An empty table writes no records and gives no rows. Payloads of responses are inflated
    and held against their digests while reading.
    """
    spark = pages.sparkSession
    kind = pages.schema[key].dataType.simpleString()
    path = path or fresh_path(spark, "warc")
    write_pages(pages, path, key, url, html)
    records = spark.read.format("warc").option("verify", "true").load(path)
    wanted = records.filter(F.col("record_type").isin("response", "revisit"))
    named = F.when(F.col("record_id") != "", F.col("record_id")).cast(kind)
    return wanted.select(named.alias(key), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
