"""WARC archives as a Python data source for Spark.

``spark.read.format("warc")`` plans partitions of whole files, takes over predicates on
the record type and other header columns, reads a record's headers first, and passes over
the block of a record that is not wanted without decoding it. ``df.write.format("warc")``
writes gzip members per record into files of bounded size; a manifest written on commit
names the files that count, so those of failed or repeated tasks are never read. Each
member names its own compressed length in its header, so that of an unwanted record only
the headers are inflated and the next member is found in the file. Archives of other
writers, without such lengths, are inflated as a whole.

Defined cases: a NULL html is an empty payload; pages with NULL ids are never the largest
of equal ones, and revisit one with an id if there is one; repeated rows are records each;
payloads of any length are written whole and read one at a time; an empty table gives an
archive without records; other columns are ignored.

Paths are those of the shared store, given as URIs that ``pyarrow.fs`` can open (local,
HDFS, S3, GCS).

Options: ``path``; ``payload``, one of ``bytes`` (read it), ``verify`` (read it, check its
length and digest, give NULL) and ``skip`` (NULL, not read); ``file_bytes``, the
uncompressed size at which a file is closed.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from skymeter.session import materialize, own, work_path

SCHEMA = (
    "record_id string, record_type string, record_date string, target_uri string, payload_digest string, "
    "payload_length long, refers_to string, headers map<string,string>, payload binary"
)
# Columns that come from one header each.
HEADERS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "record_date": "warc-date",
    "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}
# Not in the standard: the length of the full payload, also of records without it.
LENGTH_HEADER = "x-payload-length"
FILE_BYTES = 256 * 1024**2
PARTITION_BYTES = 128 * 1024**2
BATCH_BYTES = 16 * 1024**2
BATCH_RECORDS = 2_000
MANIFEST = "_manifest.json"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Fixed values of gzip: the start of a member with an extra field, and there a subfield with
# the lengths of the member and of its content.
MEMBER = struct.Struct("<4sIBBH2sHII")
MEMBER_START, SUBFIELD = b"\x1f\x8b\x08\x04", b"SL"
GZIP_WINDOW, RAW_WINDOW = 31, -15
# Compressed bytes that are inflated at a time: headers fit in few of them.
CHUNK = 4_096
# Fixed times keep an archive the same however often a task runs.
DATE = "1970-01-01T00:00:00Z"


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def base32_digest(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record: version, headers, empty line, block, two line ends."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def http_response(payload: bytes) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload


def read_headers(stream: io.BufferedIOBase) -> dict[str, str] | None:
    """Headers of the next record by lower-case name; None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    headers: dict[str, str] = {}
    name = ""
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in (" ", "\t") and name:
            headers[name] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        name = name.strip().lower()
        headers[name] = value.strip()
    return headers


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """The block without the HTTP headers, where it has them."""
    if headers.get("content-type", "").startswith("application/http"):
        _, _, block = block.partition(b"\r\n\r\n")
    return block


def member(data: bytes) -> bytes:
    """A gzip member that names its length; any gzip reader can read it."""
    deflate = zlib.compressobj(1, zlib.DEFLATED, RAW_WINDOW)
    packed = deflate.compress(data) + deflate.flush()
    length = MEMBER.size + len(packed) + 8
    known = (length, len(data)) if max(length, len(data)) < 1 << 32 else (0, 0)
    head = MEMBER.pack(MEMBER_START, 0, 4, 255, 12, SUBFIELD, 8, *known)
    return head + packed + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def member_length(head: bytes) -> int | None:
    """The length that a member names, if it does."""
    if len(head) < MEMBER.size:
        return None
    start, _, _, _, _, subfield, _, length, _ = MEMBER.unpack(head)
    return length if start == MEMBER_START and subfield == SUBFIELD and length else None


class Member(io.RawIOBase):
    """The content of one gzip member, inflated no further than it is read."""

    def __init__(self, file: io.BufferedIOBase):
        self.file, self.inflater, self.inflated = file, zlib.decompressobj(GZIP_WINDOW), 0

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.inflater.eof:
            data = self.inflater.unconsumed_tail or self.file.read(CHUNK)
            if not data:
                raise ValueError("truncated record")
            out = self.inflater.decompress(data, len(buffer))
            if out:
                buffer[: len(out)] = out
                self.inflated += len(out)
                return len(out)
        return 0


def skip(stream: io.BufferedIOBase, length: int) -> bool:
    """Passes over a block; whether more may follow."""
    if isinstance(getattr(stream, "raw", None), Member):
        return False  # one record each
    end = stream.tell() + length
    if stream.seek(length, io.SEEK_CUR) != end:
        raise ValueError("truncated record")
    return True


@dataclass
class FilePartition(InputPartition):
    paths: tuple[str, ...]


def _bare(digest: str | None) -> str | None:
    return None if digest is None else digest.removeprefix("sha1:")


def _header_value(column: str, headers: dict[str, str]) -> str | None:
    value = headers.get(HEADERS[column])
    return _bare(value) if column == "payload_digest" else value


def header_test(given: Filter) -> Callable[[dict[str, str]], bool] | None:
    """A test of the headers for a predicate on one of their columns; None if it is none."""
    column = given.attribute[0] if len(getattr(given, "attribute", ())) == 1 else ""
    if column not in HEADERS:
        return None
    tests: dict[type, Callable[[str | None, object], bool]] = {
        EqualTo: lambda v, w: v is not None and v == w,
        EqualNullSafe: lambda v, w: v == w,
        In: lambda v, w: v is not None and v in w,
        StringStartsWith: lambda v, w: v is not None and v.startswith(w),
        StringEndsWith: lambda v, w: v is not None and v.endswith(w),
        StringContains: lambda v, w: v is not None and w in v,
        IsNull: lambda v, w: v is None,
        IsNotNull: lambda v, w: v is not None,
    }
    test = tests.get(type(given))
    if test is None:
        return None
    wanted = getattr(given, "value", None)
    return lambda headers: test(_header_value(column, headers), wanted)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.payload = options.get("payload", "bytes")
        if self.payload not in ("bytes", "verify", "skip"):
            raise ValueError(f"payload: {self.payload}")
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for given in filters:
            if header_test(given) is None:
                yield given
            else:
                self.filters.append(given)

    def partitions(self) -> list[InputPartition]:
        """Whole files, small ones together."""
        system, folder = open_path(self.path)
        manifest = system.get_file_info(f"{folder}/{MANIFEST}")
        if manifest.type == fs.FileType.File:
            with system.open_input_stream(manifest.path) as file:
                names = {f"{folder}/{n}" for n in json.loads(file.read())["files"]}
        else:
            names = None
        infos = system.get_file_info(fs.FileSelector(folder, recursive=True))
        found = sorted(
            (i.path, i.size)
            for i in infos
            if i.type == fs.FileType.File and i.path.endswith((".warc", ".warc.gz"))
            if names is None or i.path in names
        )
        if names is not None and len(found) != len(names):
            raise FileNotFoundError(f"files of the manifest are missing in {self.path}")
        groups: list[list[str]] = []
        size = PARTITION_BYTES
        for path, length in found:
            if size + length > PARTITION_BYTES:
                groups.append([])
                size = 0
            groups[-1].append(path)
            size += length
        return [FilePartition(tuple(g)) for g in groups] or [FilePartition(())]

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        system, _ = open_path(self.path)
        schema = _arrow_schema()
        tests = [header_test(f) for f in self.filters]
        rows: list[tuple] = []
        size = 0
        for path in partition.paths:
            with system.open_input_file(path) as file:
                for row in self._file_records(file, file.size(), path.endswith(".gz"), tests):
                    rows.append(row)
                    size += len(row[-1] or b"")
                    if size >= BATCH_BYTES or len(rows) >= BATCH_RECORDS:
                        yield _batch(rows, schema)
                        rows, size = [], 0
        if rows:
            yield _batch(rows, schema)

    def _file_records(self, file, size: int, compressed: bool, tests: list) -> Iterator[tuple]:
        plain = io.BufferedReader(file, 1 << 20)
        if not compressed:
            yield from self._records(plain, tests)
            if plain.tell() > size:  # the last block was passed over, and ends behind the file
                raise ValueError("truncated record")
            return
        at = 0
        while at < size:
            length = member_length(plain.read(MEMBER.size))
            plain.seek(at)
            if length is None:
                yield from self._records(gzip.open(plain), tests)
                return
            if at + length > size:
                raise ValueError("truncated record")
            yield from self._records(io.BufferedReader(Member(plain), CHUNK), tests)
            at += length
            plain.seek(at)

    def _records(self, stream: io.BufferedIOBase, tests: list) -> Iterator[tuple]:
        while (headers := read_headers(stream)) is not None:
            length = int(headers["content-length"])
            if not all(test(headers) for test in tests):
                if not skip(stream, length):
                    return
                continue
            known = headers.get(LENGTH_HEADER)
            payload, payload_length, more = None, int(known) if known is not None else None, True
            if self.payload == "skip":
                more = skip(stream, length)
            else:
                block = stream.read(length)
                if len(block) != length:
                    raise ValueError("truncated record")
                if headers.get("warc-type") != "revisit":
                    payload = payload_of(headers, block)
                    if self.payload == "verify":
                        _verify(headers, payload)
                        payload_length, payload = len(payload), None
            yield (*(_header_value(c, headers) for c in HEADERS), payload_length, headers, payload)
            if not more:
                return


def _verify(headers: dict[str, str], payload: bytes) -> None:
    digest = base32_digest(hashlib.sha1(payload, usedforsecurity=False).hexdigest())
    if _bare(headers.get("warc-payload-digest", f"sha1:{digest}")) != digest:
        raise ValueError(f"digest of {headers.get('warc-record-id')} differs")
    if int(headers.get(LENGTH_HEADER, len(payload))) != len(payload):
        raise ValueError(f"length of {headers.get('warc-record-id')} differs")


def _arrow_schema() -> pa.Schema:
    text = [pa.field(c, pa.string()) for c in ("record_id", "record_type", "record_date", "target_uri")]
    rest = [
        pa.field("payload_digest", pa.string()),
        pa.field("payload_length", pa.int64()),
        pa.field("refers_to", pa.string()),
        pa.field("headers", pa.map_(pa.string(), pa.string())),
        pa.field("payload", pa.binary()),
    ]
    return pa.schema(text + rest)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = dict(zip([*HEADERS, "payload_length", "headers", "payload"], zip(*rows, strict=True), strict=True))
    columns["headers"] = [list(h.items()) for h in columns["headers"]]
    return pa.RecordBatch.from_arrays([pa.array(list(columns[f.name]), f.type) for f in schema], schema=schema)


@dataclass
class Written(WriterCommitMessage):
    files: tuple[str, ...]


class WarcWriter(DataSourceArrowWriter):
    """Writes rows ``record_id, record_type, target_uri, refers_to, sha1, payload_length, payload``."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path = options["path"]
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, folder = open_path(self.path)
        system.create_dir(folder, recursive=True)
        files: list[str] = []
        out, size = None, 0
        try:
            for batch in iterator:
                columns = {c: batch.column(c) for c in batch.schema.names}
                for i in range(batch.num_rows):
                    if out is None or size >= self.file_bytes:
                        if out is not None:
                            out.close()
                        files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out = system.open_output_stream(f"{folder}/{files[-1]}", compression=None)
                        size = out.write(member(_info(files[-1])))
                    written = _record_of({c: v[i].as_py() for c, v in columns.items()})
                    out.write(member(written))
                    size += len(written)
        finally:
            if out is not None:
                out.close()
        return Written(tuple(files))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Names the files of the tasks that count; with ``append``, beside those there are."""
        system, folder = open_path(self.path)
        system.create_dir(folder, recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        manifest = f"{folder}/{MANIFEST}"
        if not self.overwrite and system.get_file_info(manifest).type == fs.FileType.File:
            with system.open_input_stream(manifest) as file:
                files = json.loads(file.read())["files"] + files
        with system.open_output_stream(manifest) as file:
            file.write(json.dumps({"files": sorted(files)}).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, folder = open_path(self.path)
        for message in messages:
            for name in message.files if message is not None else ():
                system.delete_file(f"{folder}/{name}")


def _info(name: str) -> bytes:
    headers = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:file:{name}>"), ("WARC-Date", DATE)]
    return record([*headers, ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")


def _record_of(row: dict) -> bytes:
    kind = row["record_type"]
    headers = [("WARC-Type", kind), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", DATE)]
    if row["target_uri"] is not None:
        # A line end would begin a new header.
        headers.append(("WARC-Target-URI", row["target_uri"].replace("\r", "%0D").replace("\n", "%0A")))
    headers.append(("WARC-Payload-Digest", f"sha1:{base32_digest(row['sha1'])}"))
    headers.append(("X-Payload-Length", str(row["payload_length"])))
    if kind == "revisit":
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", row["refers_to"])]
        return record(headers, b"")
    return record([*headers, ("Content-Type", "application/http; msgtype=response")], http_response(row["payload"]))


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def read_records(spark: SparkSession, path: str, payload: str = "bytes") -> DataFrame:
    """The records of archives, with predicates on headers taken over by the source.

    Turns on the session's setting for filters of Python sources, which has no effect on
    other ones.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").option("path", path).option("payload", payload).load()


def page_records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0
) -> DataFrame:
    """Rows to write: of equal payloads the one with the largest id as response.

    The others revisit it. Payloads below ``least_bytes`` are all responses, and so are
    repeated rows of the largest id. NULL ids are never the largest; among themselves
    alone they are all responses. Payloads are equal if their SHA-1 and length are.
    """
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "payload_length": F.octet_length("payload").cast("long")})
    # Only digests that occur again, by ids alone, which combine before they move.
    again = (
        rows.filter(F.col("payload_length") >= least_bytes)
        .groupBy("sha1", "payload_length")
        .agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .select("sha1", "payload_length", "largest")
    )
    # Stored, so that the pages of a payload with very many are split in the join.
    joined = rows.join(materialize(again, "payloads-again"), ["sha1", "payload_length"], "left")
    revisits = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return joined.select(
        _page_urn("page_id").alias("record_id"),
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.when(revisits, _page_urn("largest")).alias("refers_to"),
        "sha1",
        "payload_length",
        F.when(~revisits, F.col("payload")).alias("payload"),
    )


def _page_urn(column: str):
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))


def page_of(urn: str):
    """The id in the record id of a page; NULL for a page without one."""
    return F.nullif(F.regexp_extract(urn, "^<urn:page:(-?[0-9]*)>$", 1), F.lit("")).cast("long")


def archive_pages(pages: DataFrame, path: str | None = None, **names: str | int) -> str:
    """Writes a record per page and returns the path of the archives."""
    spark = pages.sparkSession
    given, path = path, path or work_path(spark, "warc")
    spark.dataSource.register(WarcDataSource)
    page_records(pages, **names).write.format("warc").mode("append").option("path", path).save()
    return path if given else own(spark, path)


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri`` of archived pages.

    Reads the archives back: payloads of responses are checked against their digest and
    length, other kinds of records are passed over by their headers.
    """
    records = read_records(spark, path, payload="verify").filter(F.col("record_type").isin("response", "revisit"))
    return records.select(
        page_of("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        page_of("refers_to").alias("refers_to"),
        "target_uri",
    )
