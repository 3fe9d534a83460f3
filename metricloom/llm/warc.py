"""WARC archives as a PySpark data source, ``warc``.

Reading: each partition is a run of whole files of about ``targetBytes``.
Filters on ``record_type`` and on header columns are pushed into the reader. A
record's headers are parsed first; one that the filters refuse, or whose
payload no column asks for, is passed over by its length, and its block is
never decoded (in plain files it is not even read).

Rows reach Spark in Arrow batches cut by bytes, so long payloads don't add up.

Writing: one file or more for each task, under ``_pending/<job>`` and a name of
that task attempt. When the job commits, the files of the attempts that Spark
counts move out of there and the job's folder is removed with what lost or
repeated attempts left. Readers pass over folders and files whose name starts
with ``_`` or ``.``, so they never see such files. ``.warc`` and ``.warc.gz`` (one member for each
record) are read and written. Paths may be of any store that pyarrow opens.

:func:`archive` turns pages into records and stores equal payloads once: the
others become ``revisit`` records that refer to it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, "
    "payload_digest string, refers_to string, payload_bytes long, content_type string, payload binary"
)
REVISIT_FROM = 1000  # bytes; smaller payloads are always stored
FILE_BYTES = 64 << 20
TARGET_BYTES = 128 << 20
BATCH_BYTES = 8 << 20
BATCH_ROWS = 4096
MOVES = 32  # files moved at a time when a job commits
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


@dataclass
class Files(InputPartition):
    paths: list[str]

    def __init__(self, paths: list[str]) -> None:
        super().__init__(0)
        self.paths = paths


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def digest_hex(value: str | None) -> str | None:
    """Bare hexadecimal SHA-1 of a ``sha1:BASE32`` header."""
    if not value or not value.startswith("sha1:"):
        return None
    return base64.b32decode(value[5:]).hex()


def headers_of(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k}


def read_headers(stream) -> tuple[dict[str, str], int] | None:
    """Headers of the next record of a stream, and their size; None at its end."""
    lines = []
    while True:
        line = stream.readline()
        if not line:
            return None
        if line.startswith(b"WARC/"):
            break
    while line not in (b"\r\n", b"\n", b""):
        lines.append(line)
        line = stream.readline()
    block = b"".join(lines)
    return headers_of(block.rstrip(b"\r\n")), len(block)


def batches(rows: Iterable[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Arrow batches of ``rows`` that end at ``BATCH_ROWS`` rows or ``BATCH_BYTES`` of payload."""
    types = {"payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(name, types.get(name, pa.string())) for name in names])
    at = names.index("payload") if "payload" in names else None

    def made(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[at] or b"") if at is not None else 0
        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield made(held)
            held, size = [], 0
    if held:
        yield made(held)


class Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.names = schema.names
        self.options = dict(options)
        self.wanted: list[tuple[str, tuple]] = []
        types = options.get("recordTypes")
        if types:
            self.wanted.append(("record_type", tuple(types.split(","))))
        self.payload = options.get("payload", "true").lower() == "true"

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if name and name != "payload" and isinstance(f, EqualTo) and f.value is not None:
                self.wanted.append((name, (f.value,)))
            elif name and name != "payload" and isinstance(f, In):
                self.wanted.append((name, tuple(f.value)))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        store, path = open_store(self.options["path"])
        found = store.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True))
        seen = lambda name: not any(part.startswith(("_", ".")) for part in name[len(path.rstrip("/")):].split("/"))
        files = sorted(
            (x.path, x.size) for x in found if x.is_file and x.path.endswith((".warc", ".warc.gz")) and seen(x.path)
        )
        target = int(self.options.get("targetbytes", self.options.get("targetBytes", TARGET_BYTES)))
        out, held, size = [], [], 0
        for name, length in files:
            if held and size + length > target:
                out.append(Files(held))
                held, size = [], 0
            held.append(name)
            size += length
        return [*out, *([Files(held)] if held else [])] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return batches(self._rows(partition), self.names)

    def _rows(self, partition: Files) -> Iterator[tuple]:
        store, _ = open_store(self.options["path"])
        for name in partition.paths:
            with store.open_input_file(name) as raw:
                plain = not name.endswith(".gz")
                stream = io.BufferedReader(raw, 1 << 16) if plain else gzip.GzipFile(fileobj=raw)
                while (head := read_headers(stream)) is not None:
                    yield from self._record(stream, head[0])

    def _record(self, stream, headers: dict[str, str]):
        length = int(headers.get("content-length", 0))
        row = {
            "record_type": headers.get("warc-type"),
            "record_id": headers.get("warc-record-id"),
            "target_uri": headers.get("warc-target-uri"),
            "date": headers.get("warc-date"),
            "payload_digest": digest_hex(headers.get("warc-payload-digest")),
            "refers_to": headers.get("warc-refers-to"),
            "content_type": headers.get("content-type"),
        }
        if any(name in row and row[name] not in values for name, values in self.wanted):
            stream.seek(length, 1)
            return
        # The HTTP headers at the block's start say how long the whole payload is.
        left, http, size = length, {}, None
        if (row["content_type"] or "").startswith("application/http"):
            lines = []
            while left:
                line = stream.readline(left)
                left -= len(line)
                if line in (b"\r\n", b"\n", b""):
                    break
                lines.append(line)
            http = headers_of(b"".join(lines).rstrip(b"\r\n"))
            size = int(http["content-length"]) if "content-length" in http else None
        row["payload_bytes"] = left if size is None else size
        if any(name == "payload_bytes" and row[name] not in values for name, values in self.wanted):
            stream.seek(left, 1)
            return
        if self.payload and "payload" in self.names and row["record_type"] != "revisit":
            row["payload"] = stream.read(left)
        else:
            stream.seek(left, 1)
        yield tuple(row.get(name) for name in self.names)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


def record(row) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    revisit = row["record_type"] == "revisit"
    payload = bytes(row["payload"] or b"")
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: {row['content_type'] or 'text/html; charset=utf-8'}\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    one_line = lambda text: " ".join(str(text).split())
    lines = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {row['record_id']}",
        f"WARC-Date: {row['date'] or DATE}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if row["target_uri"] is not None:
        lines.append(f"WARC-Target-URI: {one_line(row['target_uri'])}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {row['refers_to']}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Writer(DataSourceWriter):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.pending = f"_pending/{uuid.uuid4().hex}"
        self.gz = options.get("compression", "gzip").lower() == "gzip"
        self.most = int(options.get("filebytes", options.get("fileBytes", FILE_BYTES)))

    def write(self, iterator) -> Written:
        store, path = open_store(self.path)
        attempt, files, out, size = uuid.uuid4().hex, [], None, 0
        store.create_dir(f"{path}/{self.pending}", recursive=True)
        try:
            for row in iterator:
                if out is None or size > self.most:
                    if out is not None:
                        out.close()
                    name = f"{attempt}-{len(files):05d}.warc" + (".gz" if self.gz else "")
                    out, size = store.open_output_stream(f"{path}/{self.pending}/{name}", compression=None), 0
                    files.append(name)
                data = record(row)
                data = gzip.compress(data, 6, mtime=0) if self.gz else data
                out.write(data)
                size += len(data)
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages) -> None:
        store, path = open_store(self.path)
        names = [name for message in messages if message for name in message.files]
        move: Callable[[str], None] = lambda name: store.move(f"{path}/{self.pending}/{name}", f"{path}/{name}")
        with ThreadPoolExecutor(MOVES) as pool:
            for _ in pool.map(move, names):
                pass
        self._clear(store, path)

    def abort(self, messages) -> None:
        self._clear(*open_store(self.path))

    def _clear(self, store: pafs.FileSystem, path: str) -> None:
        if store.get_file_info(f"{path}/{self.pending}").type == pafs.FileType.Directory:
            store.delete_dir(f"{path}/{self.pending}")


class WarcDataSource(DataSource):
    """``format("warc")``: options path, recordTypes, payload, compression, fileBytes, targetBytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> Reader:
        return Reader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def archive(
    pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url",
    payload_col: str = "html", revisit_from: int = REVISIT_FROM, compression: str = "gzip",
) -> None:
    """Writes a record for every page under ``path``.

    Payloads are UTF-8; a null is empty. Of equal payloads of ``revisit_from``
    bytes or more the one with the largest id is a response and the others
    revisit it; a row that repeats the largest id is a response too, and where
    no row has an id all are. A record's id is ``urn:page:<id>``, or
    ``urn:page:none``; a null uri has no header. Other columns are ignored.
    """
    register(pages.sparkSession)
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(uri_col).cast("string").alias("target_uri"),
        payload.alias("payload"),
    ).withColumns({"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    # Only payloads that do repeat go through the join; counting folds in each task.
    held = (
        rows.where(F.col("payload_bytes") >= revisit_from).groupBy("payload_digest")
        .agg(F.max("id").alias("holder"), F.count("*").alias("n")).where("n > 1 AND holder IS NOT NULL").drop("n")
    )
    joined = rows.join(held, "payload_digest", "left")
    revisit = F.col("holder").isNotNull() & ~F.col("id").eqNullSafe(F.col("holder"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    records = joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        urn(F.col("id")).alias("record_id"), "target_uri", F.lit(DATE).alias("date"), "payload_digest",
        F.when(revisit, urn(F.col("holder"))).alias("refers_to"), "payload_bytes",
        F.lit("text/html; charset=utf-8").alias("content_type"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )
    records.write.format("warc").mode("append").option("path", path).option("compression", compression).save()


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records under ``path``; without ``payload`` blocks are passed over."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def intact(records: DataFrame) -> DataFrame:
    """``records``, read with payloads, where length and digest are the payload's own.

    A response's ``payload_bytes`` and ``payload_digest`` are measured on the
    payload that was read, and ``intact`` says whether its headers agree. Other
    records carry no payload; they keep their headers' and ``intact`` is null.
    """
    stored = F.col("record_type") == "response"
    size, digest = F.octet_length("payload").cast("long"), F.sha1("payload")
    return records.withColumns({
        "payload_bytes": F.when(stored, size).otherwise(F.col("payload_bytes")),
        "payload_digest": F.when(stored, digest).otherwise(F.col("payload_digest")),
        "intact": F.when(
            stored, F.col("payload_bytes").eqNullSafe(size) & F.col("payload_digest").eqNullSafe(digest)
        ),
    })


def page_id(urn: Column) -> Column:
    """The id in ``<urn:page:ID>``, null for none."""
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
