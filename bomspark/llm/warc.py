"""WARC archives as a PySpark Python data source (format ``warc``).

Writing: one or more files per task, each record a gzip member of its own with
its lengths in the member's extra field; files appear under their final
names only when the job commits, so a repeated task leaves nothing behind.

Reading: planning packs whole files into partitions.  Predicates on the record
type and other headers are pushed down; a record's headers are inflated and
parsed first, and the rest of a record that no predicate wants, or whose
payload is not asked for, is skipped without being inflated or decoded.

Files are opened by pyarrow's file systems (local or shared paths, hdfs, s3).
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In,
                                    InputPartition, IsNotNull, StringStartsWith,
                                    WriterCommitMessage)
from pyspark.sql.types import StructType

from .common import scratch_path, stored

SCHEMA = ("record_type string, record_id string, page_id long, target_uri string, "
          "refers_to long, payload_digest string, payload_length long, payload binary")
#: Payloads shorter than this are always written whole.
REVISIT_BYTES = 100
PARTITION_BYTES = 64 << 20
FILE_BYTES = 256 << 20
DATE = "2020-01-01T00:00:00Z"
#: The standard's revisit profile and the skip-length subfield of gzip's extra field.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EXTRA = struct.Struct("<2sHII")
_GZIP = struct.Struct("<4sIBBH")
#: Record ids are UUIDs: this prefix, then the page's number.
_PAGE_SPACE, _OTHER_SPACE = 0x5041474553000000, 0x4F54484552000000
_BATCH_ROWS, _BATCH_BYTES = 1000, 8 << 20


def record_id(page_id: int) -> str:
    return f"<urn:uuid:{uuid.UUID(int=(_PAGE_SPACE << 64) | (page_id & (1 << 64) - 1))}>"


def page_of(record: str | None) -> int | None:
    """The page number in a record id, if it is one of ours."""
    if not record or not record.startswith("<urn:uuid:"):
        return None
    n = uuid.UUID(record[10:-1]).int
    if n >> 64 != _PAGE_SPACE:
        return None
    n &= (1 << 64) - 1
    return n - (1 << 64) if n >> 63 else n


def header_value(text: str) -> str:
    """A header's value on one line: controls and ``%`` percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 or c == "%" else c for c in text)


def plain_value(text: str) -> str:
    from urllib.parse import unquote_to_bytes
    return unquote_to_bytes(text.encode("utf-8", "surrogatepass")).decode("utf-8", "replace")


def record_bytes(kind: str, rec: str, uri: str, digest: str, length: int, refers_to: int | None,
                 payload: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {rec}", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {header_value(uri)}", f"WARC-Payload-Digest: sha256:{digest}",
             f"X-Payload-Length: {length}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
        payload = b""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {length}\r\n\r\n").encode()
    lines += ["Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(http) + len(payload)}"]
    return b"".join(["\r\n".join(lines).encode("utf-8", "surrogatepass"), b"\r\n\r\n", http,
                     payload, b"\r\n\r\n"])


def member(data: bytes) -> bytes:
    """``data`` as one gzip member that states its own lengths (if they fit)."""
    squeeze = zlib.compressobj(1, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = squeeze.compress(data) + squeeze.flush()
    whole = _GZIP.size + _EXTRA.size + len(body) + 8
    if max(whole, len(data)) >> 32:
        return _GZIP.pack(b"\x1f\x8b\x08\x00", 0, 0, 255, 0)[:10] + body + struct.pack(
            "<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    return b"".join([_GZIP.pack(b"\x1f\x8b\x08\x04", 0, 0, 255, _EXTRA.size),
                     _EXTRA.pack(b"sl", 8, whole, len(data)), body,
                     struct.pack("<II", zlib.crc32(data), len(data))])


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Rows of (page_id, url, payload, payload_digest, record_type, refers_to)."""

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.file_bytes = int(options.get("filebytes", FILE_BYTES))
        self.job = uuid.uuid4().hex[:12]

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        store, root = pafs.FileSystem.from_uri(self.path)
        staging = f"{root}/_temporary-{self.job}"
        store.create_dir(staging, recursive=True)
        files, out = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if out is not None and out.tell() >= self.file_bytes:
                    out.close()
                    out = None
                if out is None:
                    files.append(f"{uuid.uuid4().hex}.warc.gz")
                    out = store.open_output_stream(f"{staging}/{files[-1]}", compression=None)
                    out.write(member(self._info()))
                payload = row["payload"] or b""
                rec = (f"<urn:uuid:{uuid.UUID(int=(_OTHER_SPACE << 64) | uuid.uuid4().int >> 64)}>"
                       if row["page_id"] is None else record_id(row["page_id"]))
                out.write(member(record_bytes(
                    row["record_type"], rec, row["url"] or "", row["payload_digest"], len(payload),
                    row["refers_to"], payload)))
        if out is not None:
            out.close()
        return Written(files)

    @staticmethod
    def _info() -> bytes:
        body = b"format: WARC File Format 1.1\r\n"
        return (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\n"
                f"WARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\n"
                f"Content-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"

    def commit(self, messages: list) -> None:
        store, root = pafs.FileSystem.from_uri(self.path)
        for name in (f for m in messages if m is not None for f in m.files):
            store.move(f"{root}/_temporary-{self.job}/{name}", f"{root}/{name}")
        self._clear(store, root)

    def abort(self, messages: list) -> None:
        store, root = pafs.FileSystem.from_uri(self.path)
        self._clear(store, root)

    def _clear(self, store: pafs.FileSystem, root: str) -> None:
        staging = f"{root}/_temporary-{self.job}"
        if store.get_file_info(staging).type == pafs.FileType.Directory:
            store.delete_dir(staging)


@dataclass
class Files(InputPartition):
    paths: list[str]


class Records:
    """Records of one file, read forward; a record's rest is skipped on request."""

    def __init__(self, source):
        self.source, self.ahead = source, b""

    def _fill(self, n: int) -> bool:
        while len(self.ahead) < n:
            more = self.source.read(max(n - len(self.ahead), 1 << 16))
            if not more:
                return False
            self.ahead += more
        return True

    def _drop(self, n: int) -> None:
        if n <= len(self.ahead):
            self.ahead = self.ahead[n:]
        else:
            self.source.seek(self.source.tell() + n - len(self.ahead))
            self.ahead = b""

    def each(self, wanted) -> Iterator[tuple[dict[str, str], bytes | None]]:
        """(headers, block) of the records for which ``wanted(headers)`` gives
        whether the block is needed (block None if not) or None to skip."""
        while self._fill(2):
            gz = self.ahead[:2] == b"\x1f\x8b"
            yield from self._member(wanted) if gz else self._plain(wanted)

    def _plain(self, wanted) -> Iterator[tuple[dict[str, str], bytes | None]]:
        while (end := self.ahead.find(b"\r\n\r\n")) < 0:
            if not self._fill(len(self.ahead) + 1):
                if self.ahead.strip():
                    raise ValueError("a WARC record ends within its headers")
                self.ahead = b""
                return
        if not self.ahead[:end].strip():
            self._drop(end + 4)
            return
        headers = parse_headers(self.ahead[:end])
        self._drop(end + 4)
        length = int(headers["content-length"])
        want = wanted(headers)
        if want:
            if not self._fill(length):
                raise ValueError("a WARC record ends within its block")
            yield headers, self.ahead[:length]
        elif want is not None:
            yield headers, None
        self._drop(length)
        if self._fill(4) and self.ahead[:4] == b"\r\n\r\n":
            self._drop(4)

    def _member(self, wanted) -> Iterator[tuple[dict[str, str], bytes | None]]:
        whole = 0
        if self._fill(24) and self.ahead[3] & 4:
            name, _, whole, _ = _EXTRA.unpack(self.ahead[12:24])
            whole = whole if name == b"sl" else 0
        if whole and not self._fill(min(whole, 1 << 16)):
            raise ValueError("a WARC file ends within a record")
        inflate, text, given = zlib.decompressobj(31), b"", 0

        def pull(limit: int) -> bytes:
            """About ``limit`` more inflated bytes, fewer only at the member's end."""
            nonlocal given
            parts, size = [], 0
            while not inflate.eof and size < limit:
                data = inflate.unconsumed_tail
                if not data:
                    if given >= len(self.ahead):
                        if not whole:      # read bytes are let go, however long the member is
                            self._drop(given)
                            given = 0
                        if not self._fill(given + 1):
                            raise ValueError("a WARC file ends within a record")
                    data = self.ahead[given:given + (1 << 16)]
                    given += len(data)
                part = inflate.decompress(data, limit - size)
                parts.append(part)
                size += len(part)
            return b"".join(parts)

        while True:
            while (end := text.find(b"\r\n\r\n")) < 0 and not inflate.eof:
                text += pull(1024)
            if end < 0:
                raise ValueError("a WARC record has no end of headers")
            if not text[:end].strip():     # blank lines before a record
                text = text[end + 4:]
                continue
            headers = parse_headers(text[:end])
            want = wanted(headers)
            length, text = int(headers["content-length"]), text[end + 4:]
            if want:
                text += pull(length - len(text))
                if len(text) < length:
                    raise ValueError("a WARC record ends within its block")
                yield headers, text[:length]
            elif want is not None:
                yield headers, None
            if whole:                      # 'sl' is the size of one record's member
                self._drop(whole)
                return
            while len(text) < length and not inflate.eof:     # what is not wanted is not kept
                length -= len(text)
                text = pull(min(length, 1 << 16))
            text = text[length:]
            while not text.strip() and not inflate.eof:
                text = pull(1024)
            if not text.strip():           # no further record in this member
                break
        self._drop(given - len(inflate.unused_data))


def parse_headers(data: bytes) -> dict[str, str]:
    """Header lines by lower-case name; a line that begins with a blank goes on
    with the one before."""
    lines = data.decode("utf-8", "replace").split("\r\n")
    lines = lines[1:] if lines[0].startswith("WARC/") else lines[2:]
    headers, last = {}, ""
    for line in lines:
        if line[:1] in (" ", "\t") and last:
            headers[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = name.strip().lower()
            headers[last] = value.strip()
    return headers


def _digest(headers: dict[str, str]) -> str | None:
    value = headers.get("warc-payload-digest")
    return value.split(":", 1)[-1] if value else None


def _number(value: str | None) -> int | None:
    return int(value) if value is not None else None


#: Columns that headers alone decide.
_COLUMNS = {
    "record_type": lambda h: h.get("warc-type"),
    "record_id": lambda h: h.get("warc-record-id"),
    "page_id": lambda h: page_of(h.get("warc-record-id")),
    "target_uri": lambda h: (plain_value(h["warc-target-uri"]) if "warc-target-uri" in h else None),
    "refers_to": lambda h: page_of(h.get("warc-refers-to")),
    "payload_digest": _digest,
    "payload_length": lambda h: _number(h.get("x-payload-length")),
}


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.with_payload = options.get("payload", "true").lower() != "false"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        """Takes equality, membership, prefix and not-null tests on header
        columns; returns the rest to Spark."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in _COLUMNS:
                yield f
            elif isinstance(f, EqualTo):
                self.tests.append((column, "in", (f.value,)))
            elif isinstance(f, In):
                self.tests.append((column, "in", tuple(f.value)))
            elif isinstance(f, StringStartsWith):
                self.tests.append((column, "prefix", f.value))
            elif isinstance(f, IsNotNull):
                self.tests.append((column, "some", None))
            else:
                yield f

    def partitions(self) -> list[Files]:
        store, root = pafs.FileSystem.from_uri(self.path)
        found = store.get_file_info(pafs.FileSelector(root, recursive=True)) if store.get_file_info(
            root).type == pafs.FileType.Directory else [store.get_file_info(root)]
        files = sorted((f for f in found if f.type == pafs.FileType.File
                        and not any(p[:1] in "._" for p in f.path[len(root):].split("/") if p)),
                       key=lambda f: f.path)
        parts, size = [], 0
        for f in files:
            if not parts or size + f.size > self.partition_bytes:
                parts.append(Files([]))
                size = 0
            parts[-1].paths.append(f.path)
            size += f.size
        return parts or [Files([])]

    def wanted(self, headers: dict[str, str]) -> bool | None:
        for column, test, value in self.tests:
            own = _COLUMNS[column](headers)
            if own is None or test == "in" and own not in value or (
                    test == "prefix" and not own.startswith(value)):
                return None
        return self.with_payload and headers.get("warc-type") != "revisit"

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(self.path)
        kinds = [pa.int64() if n in ("page_id", "refers_to", "payload_length") else pa.string()
                 for n in _COLUMNS] + [pa.binary()]
        names, rows, size = [*_COLUMNS, "payload"], [], 0
        for path in partition.paths:
            with store.open_input_file(path) as source:
                for headers, block in Records(source).each(self.wanted):
                    payload = block
                    if block is not None and block.startswith(b"HTTP/"):
                        payload = block[block.find(b"\r\n\r\n") + 4:]
                    rows.append((*(of(headers) for of in _COLUMNS.values()), payload))
                    size += len(payload or b"")
                    if len(rows) >= _BATCH_ROWS or size >= _BATCH_BYTES:
                        yield self._batch(rows, kinds, names)
                        rows, size = [], 0
        if rows:
            yield self._batch(rows, kinds, names)

    @staticmethod
    def _batch(rows: list, kinds: list, names: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


class WarcSource(DataSource):
    """Options: ``path``; reading ``payload`` (false: headers only) and
    ``partitionBytes``; writing ``fileBytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def archive_rows(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html", least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """What is written per page.  Digests are compared over all pages; only those
    of repeated payloads are kept in a table, which the pages are joined with
    (broadcast only if Spark's size check of that table allows it)."""
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                       F.encode(F.coalesce(html_col, F.lit("")), "UTF-8").alias("payload"))
    src = src.withColumn("payload_digest", F.sha2("payload", 256))
    first = stored(src.where(F.octet_length("payload") >= least_bytes).groupBy("payload_digest")
                   .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1 and first is not null").drop("n"), "repeated-payloads")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return src.join(first, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, **columns) -> None:
    """Pages as WARC files below ``path``.

    Null HTML is an empty payload, a null URL an empty one.  Of equal payloads
    of at least 100 bytes the smallest page number is the response and the
    others revisit it; rows that repeat that number are responses too, and
    payloads without any numbered page are all responses.  Other columns are
    ignored; no pages give no files."""
    register(pages.sparkSession)
    archive_rows(pages, **columns).write.format("warc").mode("append").save(path)


def read_archives(spark: SparkSession, path: str, **options) -> DataFrame:
    """Records of the archives below ``path``; files are packed into partitions of
    Spark's file partition size unless ``partitionBytes`` is given."""
    register(spark)
    size = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return spark.read.format("warc").options(**{"partitionBytes": size, **options}).load(path)


def round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Archives the pages in the shared folder and reads them back: page_id,
    payload_bytes, payload_digest (from the payload read, or a revisit's
    headers), record_type, refers_to."""
    spark = pages.sparkSession
    path = scratch_path(spark, "llm-warc")
    write_archives(pages, path, **columns)
    back = read_archives(spark, path).where(F.col("record_type").isin("response", "revisit"))
    whole = F.col("record_type") == "response"
    return back.select(
        "page_id",
        F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length"))
        .alias("payload_bytes"),
        F.when(whole, F.sha2("payload", 256)).otherwise(F.col("payload_digest"))
        .alias("payload_digest"), "record_type", "refers_to")
