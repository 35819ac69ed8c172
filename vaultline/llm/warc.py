"""Web pages to WARC archives and back, payloads of any size chunk by chunk.

A payload is a run of rows, one for each chunk: the record's number, the chunk's number, its bytes, and how
many bytes came so far with their digest, which goes on from chunk to chunk. This table is written once;
the rows of last chunks tell equal payloads. The archives are written from chunk rows in order, each
record led by a row of its own (chunk -1) with its length, digest and what it refers to, and they are read
back into the same form. No step holds a whole record.

Archives are gzip files with one member a record. They are written by tasks under names of their own
attempt, and those named in the returned table count: a task that ran twice leaves a file nobody reads.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import join_spread
from vaultline.sources.scratch import keep, new_folder

CHUNK_BYTES = 256 << 10
#: An archive that has reached this size is closed and a new one begun.
ARCHIVE_BYTES = 1 << 30
#: What an archive holds at least, on average, before more tasks than shuffle partitions write archives.
_TASK_BYTES = 256 << 20
#: A batch of rows is given on when its chunks have so many bytes.
_BATCH_BYTES = 4 << 20
#: No header line or header may be longer.
_LONGEST_LINE = 64 << 10

#: Fixed values of the format.
VERSION = "WARC/1.1"
HTTP = "application/http; msgtype=response"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"

_CHUNKS = "record long, page_id long, url string, chunk int, last boolean, data binary, size long, digest binary"


def chunked(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows of ``record``, ``page_id``, ``url``, ``chunk`` (from 0), ``last``, ``data``, ``size`` and ``digest`` (SHA-1) up to here.

    ``record`` numbers the rows of ``pages``. A null or empty html is one empty chunk. The numbers hold
    only where the result is written: another run may give others.
    """
    rows = pages.select(
        F.monotonically_increasing_id().alias("record"),
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    last = F.greatest(F.ceil(F.octet_length("payload") / F.lit(chunk_bytes)).cast("int") - 1, F.lit(0))
    cut = rows.withColumn("chunks", last).select(
        "record",
        "page_id",
        "url",
        "payload",
        "chunks",
        F.explode(F.sequence(F.lit(0), "chunks")).alias("chunk"),
    )
    cut = cut.select(
        "record",
        "page_id",
        "url",
        "chunk",
        (F.col("chunk") == F.col("chunks")).alias("last"),
        F.substring("payload", F.col("chunk") * F.lit(chunk_bytes) + 1, F.lit(chunk_bytes)).alias("data"),
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, size = None, 0  # the chunks of a record follow one another, maybe in two batches
        for batch in batches:
            sizes, digests = [], []
            for chunk, data in zip(batch.column(3).to_pylist(), batch.column(5)):
                if chunk == 0:
                    state, size = hashlib.sha1(), 0
                state.update(data.as_buffer())
                size += len(data.as_buffer())
                sizes.append(size)
                digests.append(state.digest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())], [*batch.schema.names, "size", "digest"]
            )

    return cut.mapInArrow(digest, _CHUNKS)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


class _Archive:
    """An archive that is being written."""

    def __init__(self, system: FileSystem, path: str):
        self.path, self.stream, self.size, self.records, self.member = path, system.open_output_stream(path, compression=None), 0, 0, None

    def _put(self, data: bytes) -> None:
        if data:
            self.stream.write(data)
            self.size += len(data)

    def begin(self, fields: list[tuple[str, str]], length: int) -> None:
        self.member = zlib.compressobj(3, wbits=31)
        self.records += 1
        lines = [VERSION, *(f"{name}: {value}" for name, value in fields), f"Content-Length: {length}", "", ""]
        self.write("\r\n".join(lines).encode())

    def write(self, data) -> None:
        self._put(self.member.compress(data))

    def end(self) -> None:
        self.write(b"\r\n\r\n")
        self._put(self.member.flush())
        self.member = None


def _uri(url: str | None) -> str | None:
    """A url without what would break a header line."""
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda x: f"%{ord(x[0]):02X}", url)


def record_id(page: int | None, record: int) -> str:
    return f"<urn:page:{'' if page is None else page}:{record}>"


def page_of(name: Column) -> Column:
    """The page of a record id, null where it has none."""
    return F.regexp_extract(name, "^<urn:page:(-?[0-9]*):", 1).try_cast("long")


_ARCHIVES = "path string, records long, bytes long"


def write(
    pages: DataFrame,
    folder: str,
    revisit_from: int = 0,
    chunk_bytes: int = CHUNK_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Write every page as one record; returns the written archives: ``path``, ``records``, ``bytes``.

    ``folder`` is one that all executors share, and new. Of pages whose payloads are equal and have at
    least ``revisit_from`` bytes, that with the smallest ``page_id`` is a response (without an id it comes last; of rows
    with one id the first) and the others are revisits of it; all shorter ones are responses. Nulls: a null html
    is empty, a null url is left out, a null id too. No pages give no archives. Other columns stay behind.
    """
    spark = pages.sparkSession
    table = chunked(pages, chunk_bytes)
    path = new_folder(spark, "chunks")
    table.write.option("compression", "zstd").parquet(path)  # payloads are most of what is kept
    chunks = spark.read.schema(table.schema).parquet(path)
    whole = chunks.where("last").select("record", "page_id", "url", "size", "digest")
    many, total = whole.agg(F.count("*"), F.sum("size")).first()
    groups = (
        whole.where(F.col("size") >= revisit_from)
        .groupBy("digest", "size")
        .agg(F.count("*").alias("n"), F.min(F.struct(F.col("page_id").isNull(), "page_id", "record")).alias("first"))
        .where("n > 1")
        .select("digest", "size", "n", F.col("first.page_id").alias("first_page"), F.col("first.record").alias("first_record"))
    )
    copies = join_spread(whole.select("record", "digest", "size"), keep(groups, "copies"), ["digest", "size"], "n", many)
    copies = copies.where("record != first_record").select("record", "first_page", "first_record")
    none = lambda kind: F.lit(None).cast(kind)
    heads = whole.join(copies, "record", "left").select(
        "record", F.lit(-1).alias("chunk"), "page_id", "url", "size", "digest", "first_page", "first_record", none("binary").alias("data")
    )
    bodies = chunks.where("size > 0").select(
        "record", "chunk", none("long").alias("page_id"), none("string").alias("url"), none("long").alias("size"),
        none("binary").alias("digest"), none("long").alias("first_page"), none("long").alias("first_record"), "data",
    )
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(parallel, ceil((total or 0) / _BATCH_BYTES)), ceil((total or 0) / _TASK_BYTES))
    # an explicit number of partitions: none is split or merged at run time, a record stays in one
    rows = heads.unionByName(bodies).repartition(tasks, "record").sortWithinPartitions("record", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = FileSystem.from_uri(folder)
        part, archive, done, skip = TaskContext.get().partitionId(), None, [], True

        def close() -> None:
            if archive is not None:
                if archive.member is not None:
                    archive.end()
                archive.stream.close()
                done.append((f"{folder}/{archive.path.rsplit('/', 1)[1]}", archive.records, archive.size))

        for batch in batches:
            names = batch.schema.names
            plain = zip(*[batch.column(at).to_pylist() for at in range(len(names) - 1)])
            for row, data in zip(plain, batch.column(len(names) - 1)):
                record, chunk, page, url, size, digest, first_page, first_record = row
                if chunk >= 0:
                    if not skip:
                        archive.write(data.as_buffer())
                    continue
                if archive is not None and archive.member is not None:
                    archive.end()
                if archive is None or archive.size >= archive_bytes:
                    close()
                    system.create_dir(root, recursive=True)
                    archive = _Archive(system, f"{root}/part-{part:06d}-{len(done)}-{uuid.uuid4().hex}.warc.gz")
                    said = b"software: vaultline\r\nformat: WARC File Format 1.1\r\n"
                    archive.begin([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
                                   ("Content-Type", "application/warc-fields")], len(said))
                    archive.write(said)
                    archive.end()
                    archive.records = 0
                skip = first_record is not None
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
                fields = [("WARC-Type", "revisit" if skip else "response"), ("WARC-Record-ID", record_id(page, record)), ("WARC-Date", date)]
                if url is not None:
                    fields.append(("WARC-Target-URI", _uri(url)))
                fields.append(("WARC-Payload-Digest", f"sha1:{base32(digest)}"))
                if skip:
                    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(first_page, first_record))]
                archive.begin([*fields, ("Content-Type", HTTP)], len(http) + (0 if skip else size))
                archive.write(http)
        close()
        columns = list(zip(*done)) or [(), (), ()]
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["path", "records", "bytes"])

    return keep(rows.mapInArrow(run, _ARCHIVES), "archives")


class _Block:
    """The bytes of one record's block, read from the archive as they are asked for."""

    def __init__(self, stream, left: int, archive: str):
        self.stream, self.left, self.archive = stream, left, archive

    def line(self) -> bytes:
        line = self.stream.readline(min(self.left, _LONGEST_LINE))
        self.left -= len(line)
        return line

    def read(self, most: int) -> bytes:
        data = self.stream.read(min(self.left, most))
        if not data and self.left:
            raise EOFError(f"{self.archive} ends within a record")
        self.left -= len(data)
        return data


def _fields(line) -> dict[str, str]:
    """Header fields up to the empty line, names in lower case; a line that begins with white space goes on with the one before."""
    found: dict[str, str] = {}
    name, size = "", 0
    while (text := line()).strip():
        size += len(text)
        if size > 4 * _LONGEST_LINE:
            raise ValueError("a header is too long")
        said = text.decode("utf-8", "replace")
        if said[0] in " \t" and name:
            found[name] += " " + said.strip()
            continue
        name, _, value = said.partition(":")
        name = name.strip().lower()
        found[name] = value.strip()
    return found


_READ = (
    "archive string, record_id string, record_type string, url string, refers_to string, chunk int, last boolean, data binary, "
    "size long, digest string, intact boolean"
)


def _chunks_of(path: str, chunk_bytes: int) -> Iterator[tuple]:
    system, place = FileSystem.from_uri(path)
    with system.open_input_stream(place, compression=None) as raw:
        stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else io.BufferedReader(raw)
        readline = lambda: stream.readline(_LONGEST_LINE)
        while first := readline():
            if not first.strip():
                continue
            if not first.startswith(b"WARC/"):
                raise ValueError(f"{path} has no record where one should begin")
            head = _fields(readline)
            block = _Block(stream, int(head["content-length"]), path)
            http = {}
            if head.get("content-type", "").lower().startswith("application/http"):
                block.line()
                http = _fields(block.line)
            stated = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
            kind = head.get("warc-type")
            named = (path, head.get("warc-record-id"), kind, head.get("warc-target-uri"), head.get("warc-refers-to"))
            if kind == "revisit":
                length = int(http["content-length"]) if "content-length" in http else None
                yield (*named, 0, True, b"", length, stated, None)
                while block.left:
                    block.read(chunk_bytes)
                continue
            state, size, chunk = hashlib.sha1(), 0, 0
            while True:
                data = block.read(chunk_bytes)
                while block.left and len(data) < chunk_bytes:
                    data += block.read(chunk_bytes - len(data))
                state.update(data)
                size += len(data)
                digest, last = base32(state.digest()), not block.left
                yield (*named, chunk, last, data, size, digest, digest == stated if last and stated else None)
                chunk += 1
                if last:
                    break


def read(archives: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The records of archives (column ``path``) as chunk rows, one task for each archive at most.

    ``archive``, ``record_id``, ``record_type``, ``url``, ``refers_to``, ``chunk``, ``last``, ``data``, and of the payload
    up to here ``size`` and ``digest`` (base32 SHA-1). ``intact`` says in the last row whether the digest is the one
    that the record states. A revisit is one row without data: size and digest are those of the payload it
    refers to, as the record states them. An archive that ends within a record, or has something
    else where one should begin, raises. No archives give no rows.
    """
    names = [part.split()[0] for part in _READ.split(", ")]
    kinds = [pa.string()] * 5 + [pa.int32(), pa.bool_(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for row in _chunks_of(path, chunk_bytes):
                    rows.append(row)
                    size += len(row[7]) + 200
                    if size >= _BATCH_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
        yield batch_of(rows)

    paths = archives.select("path")
    return paths.repartition(max(1, paths.count())).mapInArrow(run, _READ)
