"""WARC archives as a Python data source.

Writing: every task writes one file of gzip members, one record each, and the commit lists the files, so
leftovers of lost tasks are never read. A member carries its own compressed and plain length in a gzip extra
field. Reading: files are planned into partitions by bytes; of each record only the headers are
inflated at first, and where the pushed predicates or the options do not want the payload, the
rest of the member is passed over unread. Files of other writers, compressed or not, are read as streams.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringStartsWith,
    WriterCommitMessage,
)

from tabkit.llm.common import let_workers_import

PARTITION_BYTES = 32 << 20
BATCH_BYTES = 4 << 20
# Bytes inflated at a time while the end of the headers is not reached.
HEAD_STEP = 512
_INDEX = "_records.json"
# Columns and the headers they come from (fixed by the format).
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "date": "WARC-Date",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}
SCHEMA = T.StructType([*(T.StructField(c, T.StringType()) for c in HEADERS), T.StructField("payload", T.BinaryType())])
_ARROW = pa.schema([*((c, pa.string()) for c in HEADERS), ("payload", pa.binary())])
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pafs.LocalFileSystem(), path


def _clean(value: str) -> str:
    """A header value on one line: control characters become percent escapes."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 0x20 or ord(c) == 0x7F else c for c in value)


def record(row: dict) -> bytes:
    """One record, uncompressed. A revisit has the HTTP head alone."""
    payload = row["payload"] or b""
    block = _HTTP + f"Content-Length: {len(payload)}\r\n\r\n".encode()
    if row["record_type"] != "revisit":
        block += payload
    lines = ["WARC/1.1", *(f"{h}: {_clean(row[c])}" for c, h in HEADERS.items() if row.get(c) is not None)]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def member(plain: bytes) -> bytes:
    """A gzip member with its compressed and its plain length in the extra field ``SL``."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(plain) + deflate.flush()
    size = 12 + 20 + len(body) + 8
    head = struct.pack("<4BIBBH", 0x1F, 0x8B, 8, 4, 0, 0, 255, 20) + struct.pack("<2sHQQ", b"SL", 16, size, len(plain))
    return head + body + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)


def parse_headers(head: bytes) -> dict[str, str]:
    """Header names in lower case; the version line is left out."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if line)}


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP head; the whole block where there is none."""
    return block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block


class _Wanted:
    """Predicates on the columns that come from headers."""

    def __init__(self, filters: list[tuple], payload: bool):
        self.filters, self.payload = filters, payload

    def row(self, headers: dict[str, str]) -> list | None:
        values = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
        for kind, column, wanted in self.filters:
            v = values[column]
            if kind == "null":
                ok = (v is None) == wanted
            elif kind == "prefix":
                ok = v is not None and v.startswith(wanted)
            else:
                ok = v is not None and v in wanted
            if not ok:
                return None
        return list(values.values())


def _members(f, wanted: _Wanted) -> Iterator[list]:
    """Rows of a file whose members carry their lengths."""
    at, end = 0, f.size()
    while at < end:
        f.seek(at)
        first = f.read(4096)
        size = struct.unpack_from("<Q", first, 16)[0]
        inflate = zlib.decompressobj(-15)
        plain, waiting, pos = b"", first[32:size], min(len(first), size)
        while b"\r\n\r\n" not in plain:  # no more than a little beyond the headers
            if not waiting:
                waiting = f.read(min(4096, size - pos)) if pos < size else b""
                pos += len(waiting)
            more = inflate.decompress(waiting, HEAD_STEP)
            waiting = inflate.unconsumed_tail
            if not more and not waiting and pos >= size:
                break
            plain += more
        head, _, rest = plain.partition(b"\r\n\r\n")
        headers = parse_headers(head)
        row = wanted.row(headers)
        if row is not None:
            payload = None
            if wanted.payload:
                rest += inflate.decompress(waiting + (f.read(size - pos) if pos < size else b""))
                payload = payload_of(rest[: int(headers["content-length"])])
            yield [*row, payload]
        at += size


def _stream(f, wanted: _Wanted) -> Iterator[list]:
    """Rows of any other archive, read from its start to its end."""
    buffer = b""

    def fill(n: int) -> bool:
        nonlocal buffer
        parts, have = [buffer], len(buffer)
        while have < n:
            more = f.read(1 << 16)
            if not more:
                break
            parts.append(more)
            have += len(more)
        buffer = b"".join(parts)
        return have >= n

    while True:
        while fill(len(buffer) + 1) and b"\r\n\r\n" not in buffer:
            pass
        buffer = buffer.lstrip(b"\r\n")
        head, found, rest = buffer.partition(b"\r\n\r\n")
        if not found:
            return
        headers = parse_headers(head)
        row = wanted.row(headers)
        buffer, length = rest, int(headers.get("content-length", 0))
        keep = row is not None and wanted.payload
        if keep:
            fill(length)
            yield [*row, payload_of(buffer[:length])]
            buffer = buffer[length:]
        else:
            while length > 0:
                fill(1)
                step = min(length, len(buffer))
                if not step:
                    break
                buffer, length = buffer[step:], length - step
            if row is not None:
                yield [*row, None]


def read_file(path: str, wanted: _Wanted) -> Iterator[list]:
    fs, name = _filesystem(path)
    with fs.open_input_file(name) as f:
        head = f.read(16)
        if head[:2] == b"\x1f\x8b" and len(head) == 16 and head[3] == 4 and head[12:14] == b"SL":
            yield from _members(f, wanted)
            return
        packed = head[:2] == b"\x1f\x8b"
    with fs.open_input_stream(name, compression="gzip" if packed else None) as f:
        yield from _stream(f, wanted)


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(None)
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool, partition_bytes: int):
        self.path, self.payload, self.partition_bytes = path, payload, partition_bytes
        self.filters: list[tuple] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if column not in HEADERS:
                yield f
            elif isinstance(f, EqualTo):
                self.filters.append(("in", column, {f.value}))
            elif isinstance(f, In):
                self.filters.append(("in", column, set(f.value)))
            elif isinstance(f, StringStartsWith):
                self.filters.append(("prefix", column, f.value))
            elif isinstance(f, (IsNull, IsNotNull)):
                self.filters.append(("null", column, isinstance(f, IsNull)))
            else:
                yield f

    def _listed(self) -> list[tuple[str, int]]:
        fs, root = _filesystem(self.path)
        scheme = self.path[: len(self.path) - len(root)] if self.path.endswith(root) else ""
        info = fs.get_file_info(root)
        if info.type == pafs.FileType.File:
            return [(self.path, info.size)]
        index = fs.get_file_info(f"{root}/{_INDEX}")
        if index.type == pafs.FileType.File:
            with fs.open_input_stream(index.path) as f:
                names = set(json.loads(f.read()))
        else:
            names = None
        found = fs.get_file_info(pafs.FileSelector(root))
        return sorted(
            (scheme + x.path, x.size)
            for x in found
            if (x.base_name in names if names is not None else x.base_name.endswith((".warc", ".warc.gz")))
        )

    def partitions(self) -> list[InputPartition]:
        parts: list[list[str]] = []
        room = 0
        for path, size in self._listed():
            if not parts or size > room:
                parts.append([])
                room = self.partition_bytes
            parts[-1].append(path)
            room -= size
        return [_Files(p) for p in parts] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        wanted = _Wanted(self.filters, self.payload)
        rows: list[list] = []
        size = 0
        for path in partition.paths:
            for row in read_file(path, wanted):
                rows.append(row)
                size += 200 + len(row[-1] or b"")
                if size >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[list]) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


class _Written(WriterCommitMessage):
    def __init__(self, name: str | None):
        self.name = name


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path
        fs, root = _filesystem(path)
        fs.create_dir(root, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = _filesystem(self.path)
        name = f"records-{uuid.uuid4().hex}.warc.gz"  # an attempt's own file
        out = None
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                out.write(member(record(row)))
        if out is None:
            return _Written(None)
        out.close()
        return _Written(name)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = _filesystem(self.path)
        names = [m.name for m in messages if m is not None and m.name]
        index = f"{root}/{_INDEX}"
        if fs.get_file_info(index).type == pafs.FileType.File:
            with fs.open_input_stream(index) as f:
                names += json.loads(f.read())
        with fs.open_output_stream(index) as f:
            f.write(json.dumps(sorted(names)).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Nothing to do: files that no commit lists are never read."""


class WarcDataSource(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")``.

    Option ``payload`` (true): false leaves the payload null and undecoded. ``partitionBytes``: files
    up to that many bytes are read in one task.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        payload = str(self.options.get("payload", "true")).lower() != "false"
        return WarcReader(self.options["path"], payload, int(self.options.get("partitionBytes", PARTITION_BYTES)))

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only ever appended to")
        if schema.fieldNames() != SCHEMA.fieldNames():
            raise ValueError(f"records have the columns {SCHEMA.fieldNames()}")
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    let_workers_import(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def write_warc(records: DataFrame, path: str) -> None:
    """Write records with the columns of `SCHEMA` to a folder that driver and executors share."""
    register(records.sparkSession)
    records.select(*SCHEMA.fieldNames()).write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def page_records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 100
) -> DataFrame:
    """Pages as records. Of those with equal payloads of at least ``least_bytes`` bytes, that with the smallest
    id is a response (all of them, if it is there repeatedly) and the others revisit it.

    Null texts are empty payloads; a null id is written as an empty one and is never the smallest, unless there
    is no other: such rows are all responses.
    """
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.filter(F.octet_length("payload") >= least_bytes)
    owners = large.groupBy("digest").agg(F.min("id").alias("owner"), F.count("*").alias("n")).filter("n > 1 AND owner IS NOT NULL")
    # a payload with very many copies is one key: adaptive execution splits its rows
    placed = rows.join(owners.select("digest", "owner"), "digest", "left")
    again = F.col("owner").isNotNull() & (F.col("id").isNull() | (F.col("id") != F.col("owner")))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    return placed.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        name(F.col("id")).alias("record_id"),
        F.lit("1970-01-01T00:00:00Z").alias("date"),
        F.col("url").alias("target_uri"),
        F.when(again, name(F.col("owner"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), F.col("digest")).alias("payload_digest"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def resolved(spark: SparkSession, path: str) -> DataFrame:
    """Every record of an archive with the size and SHA-256 of its full payload.

    Responses are measured from their payloads, which only they have decoded; a revisit takes both from
    the response it refers to.
    """
    full = read_warc(spark, path).filter("record_type = 'response'")
    full = full.select("record_id", "record_type", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    again = read_warc(spark, path, payload=False).filter("record_type = 'revisit'").select("record_id", "record_type", "refers_to")
    sizes = full.groupBy(F.col("record_id").alias("refers_to")).agg(F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest"))
    # a response with very many revisits is one key: adaptive execution splits its rows
    return full.unionByName(again.join(sizes, "refers_to", "left"))
