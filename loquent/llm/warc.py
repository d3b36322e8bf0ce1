"""WARC archives as a Spark data source, and writing pages as archives.

Reading plans one partition per group of files. In a partition headers are
parsed first; record types and headers that a filter asks for are tested on them,
and a payload is inflated only if the record passes and the schema needs it.
Compressed members written here say their length in a gzip extra field, so that
an unwanted record is skipped without inflating it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from loquent.session import scratch_path

FORMAT = "warc"
SCHEMA = (
    "record_id STRING, record_type STRING, target_uri STRING, refers_to STRING,"
    " payload_digest STRING, payload_bytes LONG, headers MAP<STRING, STRING>,"
    " payload BINARY"
)
#: What a frame to be written must have; a record with ``refers_to`` is a revisit.
WRITTEN = "record_id STRING, target_uri STRING, refers_to STRING, payload BINARY"
# Header fields by column, and the profile of a revisit.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}
LENGTH = "X-Payload-Length"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_committed.json"
#: Bytes of files in one partition, of one written file, of one Arrow batch.
PARTITION_BYTES, FILE_BYTES, BATCH_BYTES = 128 << 20, 256 << 20, 4 << 20
_MOST_HEADER = 1 << 20


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path inside it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    path = path.replace("s3a://", "s3://", 1)
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(record_id: str, target: str | None, refers_to: str | None, payload: bytes) -> bytes:
    """One response or revisit record, not compressed."""
    fields = {
        "WARC-Type": "revisit" if refers_to is not None else "response",
        "WARC-Record-ID": f"<{record_id}>",
        "WARC-Date": "2024-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        LENGTH: str(len(payload)),
        "Content-Type": "application/http;msgtype=response",
    }
    if target is not None:
        fields["WARC-Target-URI"] = target
    if refers_to is not None:
        fields["WARC-Refers-To"] = f"<{refers_to}>"
        fields["WARC-Profile"] = PROFILE
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    fields["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {_header(v)}\r\n" for k, v in fields.items())
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def member(raw: bytes, level: int = 1) -> bytes:
    """A gzip member of its own whose extra field tells both lengths."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(raw) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    told = size < 1 << 32 and len(raw) < 1 << 32
    extra = struct.pack("<H2sHII", 12, b"sl", 8, size, len(raw)) if told else b""
    head = struct.pack("<4BIBB", 31, 139, 8, 4 if told else 0, 0, 0, 255)
    tail = struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)
    return head + extra + body + tail


class _Committed(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class ArchiveWriter(DataSourceArrowWriter):
    """Writes files of each task; only files of committed tasks are listed."""

    def __init__(self, path: str, level: int):
        self.path, self.level = path, level

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        files: list[str] = []
        out = None
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or out.tell() > FILE_BYTES:
                    if out:
                        out.close()
                    files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out = fs.open_output_stream(f"{root}/{files[-1]}", compression=None)
                    info = "WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{}>\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
                    out.write(member(info.format(uuid.uuid4()).encode(), self.level))
                raw = record(
                    row["record_id"], row["target_uri"], row["refers_to"], row["payload"] or b""
                )
                out.write(member(raw, self.level))
        if out:
            out.close()
        return _Committed(files)

    def commit(self, messages: list) -> None:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        files = [f for m in messages if m for f in m.files]
        if fs.get_file_info(f"{root}/{MANIFEST}").type == pafs.FileType.File:
            with fs.open_input_stream(f"{root}/{MANIFEST}") as old:
                files = [*json.loads(old.read()), *files]
        with fs.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list) -> None:
        """Files of a failed write stay unlisted, so no reader sees them."""


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


def _parse(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a line that continues one is joined."""
    fields: dict[str, str] = {}
    name = ""
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            fields[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


def _gzip_start(file: io.BufferedReader) -> tuple[int | None, bool]:
    """Reads a member's header; its whole length if told, and whether there is one."""
    head = file.read(10)
    if len(head) < 10:
        return None, False
    flags, told = head[3], None
    if flags & 4:
        extra = file.read(struct.unpack("<H", file.read(2))[0])
        at = 0
        while at + 4 <= len(extra):
            kind, size = extra[at : at + 2], struct.unpack("<H", extra[at + 2 : at + 4])[0]
            if kind == b"sl" and size == 8:
                told = struct.unpack("<I", extra[at + 4 : at + 8])[0]
            at += 4 + size
    for flag in (8, 16):
        while flags & flag and file.read(1) not in (b"\0", b""):
            pass
    if flags & 2:
        file.read(2)
    return told, True


def records(file: io.BufferedReader, wanted, full: bool) -> Iterator[tuple[dict, bytes | None]]:
    """(header fields, block) of the records of a file that ``wanted`` accepts.

    The block is None unless ``full``.
    """
    packed = file.peek(2)[:2] == b"\x1f\x8b"
    while True:
        start = file.tell()
        if packed:
            told, more = _gzip_start(file)
            if not more:
                return
            inflate = zlib.decompressobj(-15)
            seen = b""
            while b"\r\n\r\n" not in seen and not inflate.eof:
                piece = file.read(4096)
                if not piece or len(seen) > _MOST_HEADER:
                    raise ValueError(f"broken record at byte {start}")
                seen += inflate.decompress(piece)
            head, _, rest = seen.partition(b"\r\n\r\n")
            fields = _parse(head)
            take = wanted(fields)
            if not (take and full) and told:
                file.seek(start + told)
                if take:
                    yield fields, None
                continue
            parts = [rest]
            while not inflate.eof:
                piece = file.read(1 << 16)
                if not piece:
                    raise ValueError(f"record cut short at byte {start}")
                more_bytes = inflate.decompress(piece)
                if take and full:
                    parts.append(more_bytes)
            file.seek(file.tell() - len(inflate.unused_data) + 8)
            if take:
                block = b"".join(parts)[: int(fields["content-length"])] if full else None
                yield fields, block
        else:
            lines = []
            line = file.readline()
            while line in (b"\r\n", b"\n"):
                line = file.readline()
            if not line:
                return
            while line not in (b"\r\n", b"\n", b""):
                lines.append(line.rstrip(b"\r\n"))
                line = file.readline()
            fields = _parse(b"\r\n".join(lines))
            size = int(fields["content-length"])
            if wanted(fields):
                yield fields, file.read(size) if full else None
                if full:
                    continue
            file.seek(size, io.SEEK_CUR)


def _bare(value: str | None) -> str | None:
    return value[1:-1] if value and value[0] == "<" and value[-1] == ">" else value


def value_of(fields: dict[str, str], column: str) -> str | None:
    value = _bare(fields.get(HEADERS[column].lower()))
    if column == "payload_digest" and value:
        value = value.rpartition(":")[2].upper()
    return value


class ArchiveReader(DataSourceReader):
    def __init__(self, schema, options: dict):
        self.schema, self.path = schema, options["path"]
        self.verify = options.get("verify", "false").lower() == "true"
        self.size = int(options.get("partitionbytes", PARTITION_BYTES))
        self.filters: list[tuple] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality, IN and prefix filters on columns that are headers."""
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else ""
            if column in HEADERS and isinstance(f, EqualTo):
                self.filters.append((column, "in", (f.value,)))
            elif column in HEADERS and isinstance(f, In):
                self.filters.append((column, "in", tuple(f.value)))
            elif column in HEADERS and isinstance(f, StringStartsWith):
                self.filters.append((column, "prefix", f.value))
            else:
                yield f

    def wanted(self, fields: dict[str, str]) -> bool:
        for column, how, value in self.filters:
            own = value_of(fields, column)
            if own is None:
                return False
            if not (own in value if how == "in" else own.startswith(value)):
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        """Files, largest first, packed up to the partition size."""
        fs, root = file_system(self.path)
        info = fs.get_file_info(root)
        if info.type == pafs.FileType.File:
            found = [info]
        else:
            found = fs.get_file_info(pafs.FileSelector(root))
            names = None
            if any(x.base_name == MANIFEST for x in found):
                with fs.open_input_stream(f"{root}/{MANIFEST}") as listed:
                    names = set(json.loads(listed.read()))
            found = [
                x
                for x in found
                if x.base_name.endswith((".warc", ".warc.gz"))
                and (names is None or x.base_name in names)
            ]
        groups: list[list[str]] = []
        room = 0
        for x in sorted(found, key=lambda x: (-x.size, x.path)):
            if not groups or room < x.size:
                groups.append([])
                room = self.size
            groups[-1].append(x.path)
            room -= x.size
        # Without any partition Spark would read one without files.
        return [Files(g) for g in groups or [[]]]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        names = schema.names
        full = "payload" in names or self.verify
        fs, _ = file_system(self.path)
        rows: list[dict] = []
        held = 0
        for path in partition.paths:
            with io.BufferedReader(fs.open_input_file(path), 1 << 20) as file:
                for fields, block in records(file, self.wanted, full):
                    row = {c: value_of(fields, c) for c in HEADERS}
                    told = fields.get(LENGTH.lower())
                    row["payload_bytes"] = int(told) if told else None
                    row["headers"] = list(fields.items())
                    row["payload"] = None
                    if full and row["record_type"] != "revisit":
                        payload = block
                        if fields.get("content-type", "").startswith("application/http"):
                            payload = block.partition(b"\r\n\r\n")[2]
                        if self.verify and row["payload_digest"]:
                            row_digest = payload_digest(payload)
                            if row_digest != row["payload_digest"]:
                                raise ValueError(f"digest of {row['record_id']} in {path}")
                        row["payload_bytes"] = len(payload)
                        row["payload"] = payload
                    rows.append({c: row[c] for c in names})
                    held += 400 + (len(row["payload"] or b"") if "payload" in names else 0)
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class ArchiveSource(DataSource):
    """``spark.read.format("warc").load(path)``, and ``write`` of ``WRITTEN`` columns.

    Options: ``verify`` (true: inflate every wanted payload and compare its SHA-1
    with the header), ``partitionBytes``. A schema without ``payload`` leaves
    payloads packed. Empty folders give no rows.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(schema, dict(self.options))

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options["path"], int(self.options.get("level", "1")))


def read_archives(
    spark: SparkSession, path: str, schema: str = SCHEMA, **options: str
) -> DataFrame:
    """Records of the archives in a folder, with filter pushdown switched on."""
    spark.dataSource.register(ArchiveSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(FORMAT).schema(schema).options(**options).load(path)


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` with ``first_id``: the smallest page_id of the same payload.

    It is null where the page itself is that one, where the payload has fewer
    bytes than ``least_bytes``, and where the page has no equal. Payloads are
    equal when SHA-1 and length agree. Only digests are grouped and matched, so
    a page text that fills a third of the table stays spread out.
    """
    heads = pages.select(
        "page_id", F.sha1("payload").alias("_digest"), F.octet_length("payload").alias("_bytes")
    )
    alike = (
        heads.filter(F.col("_bytes") >= least_bytes)
        .groupBy("_digest", "_bytes")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    later = (
        heads.join(alike, ["_digest", "_bytes"])
        .filter(~F.col("page_id").eqNullSafe(F.col("first_id")))
        .select(F.col("page_id").alias("_id"), F.col("_digest").alias("_own"), "first_id")
        .distinct()
    )
    keyed = pages.withColumn("_digest", F.sha1("payload"))
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_own"))
    return keyed.join(later, same, "left").drop("_id", "_digest", "_own")


def write_pages(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Writes a record per row of (page_id, url, html) below ``path``.

    A null html is an empty payload. The first page of a payload is a response,
    the others revisit it. Rows that repeat a page_id and its html are all
    written, with the same type. A null page_id revisits any other; an empty
    table leaves a folder without records. Further columns are not read.
    """
    page_spark = pages.sparkSession
    page_spark.dataSource.register(ArchiveSource)
    payload = F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    found = revisits(pages.select("page_id", "url", payload), least_bytes)
    name = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))
    rows = found.select(
        name.alias("record_id"),
        F.col("url").alias("target_uri"),
        F.concat(F.lit("urn:page:"), F.col("first_id").cast("string")).alias("refers_to"),
        "payload",
    )
    rows.write.format(FORMAT).mode("append").save(path)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Pages written as archives to the shared folder and read back as records."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_pages(pages, path)
    columns = "record_id STRING, record_type STRING, refers_to STRING, payload_digest STRING, payload_bytes LONG"
    found = read_archives(spark, path, columns, verify="true")
    return found.filter(F.col("record_type").isin("response", "revisit"))


def page_id(name: str) -> Column:
    """The page_id in a record name; null for none."""
    return F.expr(f"try_cast(substring({name}, {len('urn:page:') + 1}) as bigint)")
