"""WARC archives through a table of chunks.

A payload is a run of rows (record, chunk number, bytes), each with the digest of the
payload up to its end; the row that ends a payload thus has its size and digest. Chunks are
shuffled, written and read back as a stream: no step holds a record's payload, whatever
its length. Archives are gzip files with one member per record.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simalign.llm import files
from simalign.session import stage

CHUNK_BYTES = 256 << 10
ARCHIVE_BYTES = 256 << 20
#: Payloads below this size are always written whole.
REVISIT_BYTES = 100
DATE = "2024-01-01T00:00:00Z"
LEVEL = 3

CHUNKS = (
    "record long, name long, uri string, chunk int, last boolean, stop long, digest string, data binary"
)
READ = (
    "record_id string, name long, uri string, type string, refers_to long, chunk int, last boolean,"
    " payload_bytes long, digest string, data binary"
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(zip(*rows, strict=True), schema, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=schema)


def chunk_table(pages: DataFrame, name_col: str, uri_col: str, payload_col: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunks of every payload (a string as UTF-8), staged in the shared folder.

    `record` numbers the input rows, so that rows which repeat stay apart. `digest` is the
    SHA-256 of the payload up to `stop`. A NULL or empty payload is one empty chunk.
    """
    rows = pages.select(
        F.monotonically_increasing_id().alias("record"), F.col(name_col).cast("long").alias("name"),
        F.col(uri_col).cast("string").alias("uri"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("record", pa.int64()), ("name", pa.int64()), ("uri", pa.string()), ("chunk", pa.int32()),
            ("last", pa.bool_()), ("stop", pa.int64()), ("digest", pa.string()), ("data", pa.binary()),
        ])
        out, held = [], 0
        for batch in batches:
            records, names, uris = (batch.column(i).to_pylist() for i in range(3))
            for i, payload in enumerate(batch.column(3)):
                view = memoryview(payload.as_buffer())
                digest, at, number = hashlib.sha256(), 0, 0
                while True:
                    piece = view[at : at + chunk_bytes]
                    digest.update(piece)
                    at += len(piece)
                    last = at == len(view)
                    out.append((records[i], names[i], uris[i], number, last, at, digest.hexdigest(), bytes(piece)))
                    held += len(piece)
                    number += 1
                    if held >= 8 * chunk_bytes:
                        yield _batch(out, schema)
                        out, held = [], 0
                    if last:
                        break
        if out:
            yield _batch(out, schema)

    # payloads are compressed harder than other staged tables, as they are most of the bytes
    path = files.new_folder(pages.sparkSession, "chunks")
    rows.mapInArrow(cut, CHUNKS).write.option("compression", "zstd").parquet(path)
    return pages.sparkSession.read.schema(CHUNKS).parquet(path)


def verdicts(chunks: DataFrame, at_least: int = REVISIT_BYTES) -> DataFrame:
    """(record, type, refers_record, refers_to, payload_bytes, payload_digest) of every record.

    Of the records with one digest and at least `at_least` bytes, that with the smallest name
    is the response (of equal names the first record, NULL names last); the others revisit it.
    Only digests move. The first of a digest is found with partial aggregates, and met again
    only where a digest repeats.
    """
    ends = chunks.filter("last").select(
        "record", "name", F.col("stop").alias("payload_bytes"), F.col("digest").alias("payload_digest")
    )
    order = F.struct(F.col("name").isNull().alias("none"), "name", "record")
    firsts = (
        ends.filter(F.col("payload_bytes") >= at_least).groupBy("payload_digest")
        .agg(F.min(order).alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
        .select(F.col("payload_digest").alias("_digest"), F.col("_first.name").alias("_name"), F.col("_first.record").alias("_record"))
    )
    met = ends.join(
        firsts, (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") >= at_least), "left"
    )
    again = F.col("_record").isNotNull() & (F.col("_record") != F.col("record"))
    return met.select(
        "record", F.when(again, "revisit").otherwise("response").alias("type"),
        F.when(again, F.col("_record")).alias("refers_record"), F.when(again, F.col("_name")).alias("refers_to"),
        "payload_bytes", "payload_digest",
    )


def _record_id(name, record) -> str:
    return f"<urn:record:{'null' if name is None else name}:{record}>"


def _heads(row: dict) -> tuple[bytes, bytes]:
    """WARC header and HTTP header of a record; both are short."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    body = row["payload_bytes"] if row["type"] == "response" else 0
    uri = row["uri"]
    lines = [
        "WARC/1.1", f"WARC-Type: {row['type']}", f"WARC-Record-ID: {_record_id(row['name'], row['record'])}",
        f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + body}",
    ]
    if uri is not None:
        safe = uri.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
        lines.append(f"WARC-Target-URI: {safe}")
    if row["type"] == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_record_id(row['refers_to'], row['refers_record'])}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode(), http


def write_archives(chunks: DataFrame, decided: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every record once; returns the manifest (file, records, bytes).

    Payload chunks move once, to the task of their record; revisits keep none.
    """
    decided = decided.withColumnRenamed("record", "_record")
    needed = (F.col("type") == "response") | (F.col("chunk") == 0)
    met = (
        chunks.repartition("record").join(decided, F.col("record") == F.col("_record")).filter(needed)
        .withColumn("data", F.when(F.col("type") == "response", F.col("data")))
        .select(
            "record", "name", "uri", "chunk", F.when(F.col("type") == "response", F.col("last")).otherwise(True).alias("last"),
            "digest", "data", "type", "refers_record", "refers_to", "payload_bytes", "payload_digest",
        )
        .sortWithinPartitions("record", "chunk")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, uri, size, records, done = None, None, 0, 0, []
        packer = digest = None
        for batch in batches:
            rows = batch.drop_columns(["data"]).to_pylist()
            for row, data in zip(rows, batch.column("data"), strict=True):
                if sink is None:
                    sink, uri = files.create(folder, f"pages-{uuid.uuid4().hex}.warc.gz")
                if row["chunk"] == 0:
                    packer, digest = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), hashlib.sha256()
                    head, http = _heads(row)
                    size += sink.write(packer.compress(head + http)) or 0
                if data.is_valid:
                    piece = memoryview(data.as_buffer())
                    digest.update(piece)
                    if digest.hexdigest() != row["digest"]:
                        raise ValueError(f"chunk {row['chunk']} of record {row['record']} does not follow the one before")
                    size += sink.write(packer.compress(piece)) or 0
                if row["last"]:
                    size += sink.write(packer.compress(b"\r\n\r\n") + packer.flush()) or 0
                    records += 1
                    if size >= archive_bytes:
                        sink.close()
                        done.append((uri, records, size))
                        sink, size, records = None, 0, 0
        if sink is not None:
            sink.close()
            done.append((uri, records, size))
        if done:
            yield pa.RecordBatch.from_pydict(dict(zip(("file", "records", "bytes"), map(list, zip(*done, strict=True)), strict=True)))

    return stage(met.mapInArrow(write, "file string, records long, bytes long"))


class _Unpacked:
    """Bytes of a gzip stream with many members, as they come."""

    def __init__(self, stream):
        self.stream, self.packed, self.plain, self.unpacker = stream, b"", bytearray(), None

    def more(self) -> bool:
        while True:
            if not self.packed:
                self.packed = self.stream.read(1 << 18)
                if not self.packed:
                    return False
            if self.unpacker is None:
                self.unpacker = zlib.decompressobj(31)
            got = self.unpacker.decompress(self.packed, 1 << 20)
            if self.unpacker.eof:
                self.packed, self.unpacker = self.unpacker.unused_data, None
            else:
                self.packed = self.unpacker.unconsumed_tail
            self.plain += got
            if got:
                return True

    def head(self) -> list[str] | None:
        """Lines up to an empty line, or None at the end."""
        while (at := self.plain.find(b"\r\n\r\n")) < 0:
            if not self.more():
                if self.plain:
                    raise ValueError("the archive ends inside a header")
                return None
        lines = bytes(self.plain[:at]).decode().split("\r\n")
        del self.plain[: at + 4]
        return lines

    def take(self, n: int) -> bytes:
        """At most n bytes, at least one."""
        if not self.plain and not self.more():
            raise ValueError("the archive ends inside a record")
        out = bytes(self.plain[:n])
        del self.plain[:n]
        return out


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _name(record_id: str | None) -> int | None:
    if record_id is None:
        return None
    name = record_id.strip("<>").split(":")[2]
    return None if name == "null" else int(name)


def _records(source: _Unpacked, chunk_bytes: int, with_data: bool) -> Iterator[tuple]:
    while (lines := source.head()) is not None:
        warc = _fields(lines)
        length = int(warc["content-length"])
        http_lines = source.head()
        http = _fields(http_lines)
        left = length - sum(len(x.encode()) + 2 for x in http_lines) - 2
        kind, stated = warc["warc-type"], warc["warc-payload-digest"].removeprefix("sha256:")
        uri = warc.get("warc-target-uri")
        if uri is not None:
            uri = uri.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
        base = (warc["warc-record-id"], _name(warc["warc-record-id"]), uri, kind, _name(warc.get("warc-refers-to")))
        if kind == "revisit":
            yield (*base, 0, True, int(http["content-length"]), stated, b"" if with_data else None)
        else:
            digest, at, number = hashlib.sha256(), 0, 0
            while True:
                want, piece = min(chunk_bytes, left), b""
                while len(piece) < want:
                    piece += source.take(want - len(piece))
                digest.update(piece)
                at, left = at + len(piece), left - len(piece)
                if not left and digest.hexdigest() != stated:
                    raise ValueError(f"payload of {base[0]} does not have its digest")
                if with_data or not left:
                    yield (*base, number, not left, at, digest.hexdigest(), piece if with_data else None)
                number += 1
                if not left:
                    break
        end = b""
        while len(end) < 4:
            end += source.take(4 - len(end))
        if end != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")


def read_archives(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """Chunks of all records, one task per archive, digests checked on the way.

    `payload_bytes` and `digest` run along the chunks; the last row of a record has those of
    its payload. Revisits have one row without bytes and state the payload they stand for.
    Without data only the last row of a record is returned.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("record_id", pa.string()), ("name", pa.int64()), ("uri", pa.string()), ("type", pa.string()),
            ("refers_to", pa.int64()), ("chunk", pa.int32()), ("last", pa.bool_()), ("payload_bytes", pa.int64()),
            ("digest", pa.string()), ("data", pa.binary()),
        ])

        for batch in batches:
            for file in batch.column("file").to_pylist():
                out, held = [], 0
                with files.open_stream(file) as stream:
                    for row in _records(_Unpacked(stream), chunk_bytes, with_data):
                        out.append(row)
                        held += len(row[-1] or b"") + 200
                        if held >= 2 << 20:
                            yield _batch(out, schema)
                            out, held = [], 0
                if out:
                    yield _batch(out, schema)

    return files.one_file_per_task(manifest).mapInArrow(read, READ)


def archive(pages: DataFrame, name_col: str = "page_id", uri_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write one record per row into archives in the shared folder; returns the manifest.

    NULL payloads are empty, NULL uris are left out, a NULL name is written as null. Rows
    that repeat are records of their own: the first is the response, the others revisit it.
    An empty table gives no archive. Other columns are ignored.
    """
    chunks = chunk_table(pages, name_col, uri_col, payload_col)
    return write_archives(chunks, stage(verdicts(chunks)), files.new_folder(pages.sparkSession, "warc"))
