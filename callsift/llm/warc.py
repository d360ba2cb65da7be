"""WARC archives: writing and reading them, as a PySpark data source named ``warc``.

Writing: each task writes one archive; a record is its own gzip member when the
option ``compress`` is true. Names come from the write job, so a task that runs
again never touches another's file, and only files of committed tasks stay.

Reading: partitions are planned from files, small ones together. Filters on
``record_type`` and on header columns are taken over; a record's headers are parsed
first, and the payload is read only where the columns asked for need it and the
headers pass: in a plain file it is skipped by seeking, in a compressed one it is
passed over without being kept.

Any file system that pyarrow can open by URI holds archives.
"""

from __future__ import annotations

import io
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)

SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes bigint, payload binary"
)
#: Column and header of each value that stands in a record's header lines.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "payload_bytes": "X-Payload-Length",
}
#: Files are packed into partitions of about so many bytes.
PARTITION_BYTES = 64 << 20
_CHUNK = 1 << 20
_VERSION = b"WARC/1.1"


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or a plain path."""
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def listed(uri: str, suffixes: tuple[str, ...]) -> list[pafs.FileInfo]:
    """Files with these endings below a folder, or the one file, by path."""
    fs, path = opened(uri)
    info = fs.get_file_info(path)
    if info.type == pafs.FileType.File:
        return [info]
    found = fs.get_file_info(pafs.FileSelector(path, recursive=True))
    return sorted((x for x in found if x.type == pafs.FileType.File and x.path.endswith(suffixes)), key=lambda x: x.path)


@dataclass
class Written(WriterCommitMessage):
    path: str | None


class FilesWriter(DataSourceWriter):
    """One file a task, under a name of its own; files of failed tasks are removed."""

    suffix = ""

    def __init__(self, options: dict):
        self.folder = options["path"]
        self.job = uuid.uuid4().hex

    def rows_to(self, rows: Iterator, out) -> None:
        raise NotImplementedError

    def name(self) -> str:
        """File name of the running task."""
        from pyspark import TaskContext

        context = TaskContext.get()
        return f"{self.job}-{context.partitionId():06d}-{context.taskAttemptId()}{self.suffix}"

    def write(self, rows: Iterator) -> Written:
        first = next(rows, None)
        if first is None:
            return Written(None)
        fs, folder = opened(self.folder)
        fs.create_dir(folder, recursive=True)
        path = posixpath.join(folder, self.name())

        def every():
            yield first
            yield from rows

        with fs.open_output_stream(path, compression=None) as out:
            self.rows_to(every(), out)
        return Written(path)

    def commit(self, messages: list) -> None:
        """Removes what attempts that didn't count have left."""
        fs, folder = opened(self.folder)
        fs.create_dir(folder, recursive=True)
        kept = {posixpath.basename(x.path) for x in messages if x is not None and x.path}
        for info in fs.get_file_info(pafs.FileSelector(folder)):
            if info.base_name.startswith(self.job) and info.base_name not in kept:
                fs.delete_file(info.path)

    def abort(self, messages: list) -> None:
        for x in messages:
            if x is not None and x.path:
                opened(self.folder)[0].delete_file(x.path)


def record(values: dict, payload: bytes) -> bytes:
    """One WARC record."""
    lines = [_VERSION]
    for column, header in HEADERS.items():
        value = values.get(column)
        if value is not None:
            text = " ".join(str(value).split()) if column == "target_uri" else str(value)
            lines.append(f"{header}: {text}".encode())
    lines += [b"Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}".encode(), b"", payload, b"", b""]
    return b"\r\n".join(lines)


class WarcWriter(FilesWriter):
    def __init__(self, options: dict):
        super().__init__(options)
        self.compress = options.get("compress", "true").lower() == "true"
        self.suffix = ".warc.gz" if self.compress else ".warc"

    def rows_to(self, rows: Iterator, out) -> None:
        for row in rows:
            values = row.asDict()
            whole = record(values, bytes(values["payload"] or b""))
            if self.compress:
                member = zlib.compressobj(1, zlib.DEFLATED, 31)
                whole = member.compress(whole) + member.flush()
            out.write(whole)


class _Inflated(io.RawIOBase):
    """The bytes of all gzip members of a stream, one after another."""

    def __init__(self, raw):
        self._raw, self._member, self._input, self._ready = raw, None, b"", b""

    def read(self, size: int = _CHUNK) -> bytes:
        while not self._ready:
            if not self._input:
                self._input = self._raw.read(_CHUNK)
                if not self._input:
                    return self._member.flush() if self._member else b""
            if self._member is None:
                self._member = zlib.decompressobj(31)
            self._ready = self._member.decompress(self._input, _CHUNK)
            self._input = self._member.unconsumed_tail
            if self._member.eof:
                self._input = self._member.unused_data
                self._member = None
        out, self._ready = self._ready[:size], self._ready[size:]
        return out


class _Source:
    """Reads header blocks and payloads of one archive."""

    def __init__(self, file, compressed: bool):
        self._file = file
        self._stream = _Inflated(file) if compressed else file
        self._seekable = not compressed
        self._held = b""

    def headers(self) -> bytes | None:
        """The next header block without its blank line; none at the end."""
        scanned = 0
        while True:
            if not scanned:
                self._held = self._held.lstrip(b"\r\n")
            at = self._held.find(b"\r\n\r\n", max(scanned - 3, 0))
            if at >= 0:
                block, self._held = self._held[:at], self._held[at + 4 :]
                return block
            scanned = len(self._held)
            more = self._stream.read(_CHUNK if not self._seekable else 1 << 14)
            if not more:
                if scanned:
                    raise ValueError("an archive ends within a record")
                return None
            self._held += more

    def payload(self, size: int) -> bytes:
        parts, have = [self._held[:size]], min(size, len(self._held))
        self._held = self._held[size:]
        while have < size:
            more = self._stream.read(min(_CHUNK, size - have))
            if not more:
                raise ValueError("an archive ends within a record")
            take = size - have
            parts.append(more[:take])
            self._held = more[take:]
            have += len(parts[-1])
        return b"".join(parts)

    def skip(self, size: int) -> None:
        here = min(size, len(self._held))
        self._held = self._held[here:]
        size -= here
        if size and self._seekable:
            self._file.seek(self._file.tell() + size)
            return
        while size:
            more = self._stream.read(min(_CHUNK, size))
            if not more:
                raise ValueError("an archive ends within a record")
            here = min(size, len(more))
            self._held = more[here:]
            size -= here


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.folder = options["path"]
        self.columns = schema.fieldNames()
        self.wanted: list[tuple[str, set | None]] = []
        self.payload = "payload" in self.columns

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes over equality, membership and presence of header columns."""
        text = set(HEADERS) - {"payload_bytes"}
        for one in filters:
            column = one.attribute[0] if isinstance(one, EqualTo | In | IsNotNull) and len(one.attribute) == 1 else None
            if column not in text:
                yield one
            elif isinstance(one, EqualTo):
                self.wanted.append((column, {one.value}))
            elif isinstance(one, In):
                self.wanted.append((column, set(one.value)))
            else:
                self.wanted.append((column, None))

    def partitions(self) -> list[Files]:
        out, some, size = [], [], 0
        for info in listed(self.folder, (".warc", ".warc.gz")):
            if some and size + info.size > PARTITION_BYTES:
                out.append(Files(tuple(some)))
                some, size = [], 0
            some.append(info.path)
            size += info.size
        return [*out, Files(tuple(some))] if some or not out else out

    def read(self, partition: Files) -> Iterator[tuple]:
        fs, _ = opened(self.folder)
        for path in partition.paths:
            with fs.open_input_file(path) as file:
                yield from self._records(_Source(file, path.endswith(".gz")))

    def _records(self, source: _Source) -> Iterator[tuple]:
        by_header = {header.lower(): column for column, header in HEADERS.items()}
        while (block := source.headers()) is not None:
            lines = block.decode().split("\r\n")
            values, size = {}, 0
            for line in lines[1:]:
                header, _, value = line.partition(":")
                header = header.lower()
                if header == "content-length":
                    size = int(value)
                elif header in by_header:
                    values[by_header[header]] = value.strip()
            if "payload_bytes" in values:
                values["payload_bytes"] = int(values["payload_bytes"])
            passes = all(values.get(c) is not None if some is None else values.get(c) in some for c, some in self.wanted)
            if not passes or not self.payload:
                source.skip(size)
            else:
                values["payload"] = source.payload(size)
            if passes:
                yield tuple(values.get(c) for c in self.columns)


class WarcSource(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options, schema)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    """Makes the format known; Python filters are pushed down from then on."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Records of all archives at ``path``; without ``payload`` in ``columns`` none is decoded."""
    register(spark)
    reader = spark.read.format("warc")
    if columns:
        kinds = dict(x.strip().split(" ") for x in SCHEMA.split(","))
        reader = reader.schema(", ".join(f"{c} {kinds[c]}" for c in columns))
    return reader.load(path)


def records(pages: DataFrame, page_id: str, url: str, html: str, least: int = 1000) -> DataFrame:
    """Rows of archive records for a table of pages.

    Pages with equal payloads of at least ``least`` bytes are written once: that
    with the largest id is the response, others are revisits of it, without a
    payload. Rows that repeat the id and payload of a response are responses too,
    as no record revisits itself. A null payload counts as empty, and a page
    without an id is always a response.

    Only digests are grouped; payloads cross the network once, by page id and digest.
    """
    payload = F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b""))
    full = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("target_uri"),
        payload.alias("payload"),
    ).select("*", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    large = full.where(F.col("payload_bytes") >= least).select("page_id", "sha1", "payload_bytes")
    kept = large.groupBy("sha1", "payload_bytes").agg(F.max("page_id").alias("kept"), F.min("page_id").alias("least"))
    kept = kept.where(F.col("kept") > F.col("least")).drop("least")
    again = (
        large.join(kept, ["sha1", "payload_bytes"])
        .where(F.col("page_id") < F.col("kept"))
        .select("page_id", "sha1", "kept")
        .distinct()
    )
    joined = full.join(again, ["page_id", "sha1"], "left")
    first = F.col("kept").isNull()
    return joined.select(
        _urn("page_id").alias("record_id"),
        F.when(first, "response").otherwise("revisit").alias("record_type"),
        "target_uri",
        _urn("kept").alias("refers_to"),
        F.concat(F.lit("sha1:"), "sha1").alias("payload_digest"),
        "payload_bytes",
        F.when(first, F.col("payload")).alias("payload"),
    )


def _urn(column: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.col(column).cast("string"), F.lit(">"))
