"""WARC archives written and read as chunked records.

Writing. Each task streams its rows into one archive in the shared folder, a gzip member per record. Rows whose payload
equals one of a smaller id become revisit records without payload. A payload goes through the compressor in chunks, and
its digest is taken on the way, so no record is copied whole. The task reports its file; files of failed attempts are
never read, since only reported names count.

Reading. Archives are streamed block by block. A record becomes rows (record_id, chunk, ...): each chunk carries its
bytes and the digest of the payload up to there, the last one is marked and holds the digest of the full payload.

Null payloads count as empty. Rows with a null id are written too, but nothing refers to them. Rows that repeat an id
and payload: one of them is the response, its repeats carry the same id and are responses as well. Other columns are not
archived.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import staged
from daybook.session import make_folder, new_scratch_path

CHUNK = 64 * 1024
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CHUNK_ROWS = "record_id string, id long, uri string, record_type string, refers_to long, payload_bytes long, chunk int, at long, data binary, digest string, last boolean"


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits: five of them at a time are four letters."""
    parts = []
    for i in range(8):
        number = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        parts += [F.substring(F.lit(BASE32), F.shiftright(number, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(id, uri, payload, refers_to): refers_to is the smallest id with an equal payload, null for that row itself."""
    rows = pages.withColumn("payload", F.coalesce("payload", F.lit(""))).withColumn("sha", F.sha1(F.col("payload").cast("binary")))
    long_enough = F.octet_length("payload") >= min_bytes
    firsts = (
        rows.filter(long_enough & F.col("id").isNotNull()).groupBy(F.col("sha").alias("first_sha"))
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    )
    joined = rows.join(staged(firsts, "op3-firsts"), (F.col("sha") == F.col("first_sha")) & long_enough, "left")
    return joined.select("id", "uri", "payload", F.when(F.col("id") > F.col("first"), F.col("first")).alias("refers_to"), base32_of_hex(F.col("sha")).alias("digest"))


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _header(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def _clean(value: str | None) -> str:
    return " ".join((value or "").split())


class Writer:
    """One archive; a gzip member per record."""

    def __init__(self, stream):
        self.stream = stream

    def record(self, record_id: str, key: int | None, uri: str | None, payload: memoryview, digest: str, refers_to: int | None) -> None:
        kind = "response" if refers_to is None else "revisit"
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        body = len(payload) if refers_to is None else 0
        fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{record_id}>"), ("WARC-Date", "1970-01-01T00:00:00Z")]
        fields += [("WARC-Target-URI", _clean(uri))] if _clean(uri) else []
        fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
        fields += [("Content-Length", str(len(http) + body))]
        fields += [("Page-Id", str(key))] if key is not None else []
        if refers_to is not None:
            fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("Refers-To-Page-Id", str(refers_to))]
        z = zlib.compressobj(4, zlib.DEFLATED, 31)
        self.stream.write(z.compress(_header(fields) + http))
        for at in range(0, body, CHUNK):
            self.stream.write(z.compress(payload[at : at + CHUNK]))
        self.stream.write(z.compress(b"\r\n\r\n") + z.flush())


def write(rows: DataFrame, folder: str) -> DataFrame:
    """Archive rows of ``with_revisits``; (file, records) for each archive written."""

    def run(batches):
        files, at = _open(folder)
        name, n, stream, writer = f"part-{uuid.uuid4().hex}.warc.gz", 0, None, None
        for batch in batches:
            if stream is None and batch.num_rows:
                stream = files.open_output_stream(f"{at}/{name}", compression=None)
                writer = Writer(stream)
            ids, uris, payloads, refers, digests = (batch.column(c) for c in ("id", "uri", "payload", "refers_to", "digest"))
            for i in range(batch.num_rows):
                data = payloads[i].as_buffer()
                view = memoryview(data) if data is not None else memoryview(b"")
                writer.record(str(uuid.uuid4()), ids[i].as_py(), uris[i].as_py(), view, digests[i].as_py(), refers[i].as_py())
                n += 1
        if stream is not None:
            stream.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["file", "records"])

    return rows.mapInArrow(run, "file string, records long")


class Reader:
    """Bytes of an archive, decompressed block by block over its gzip members."""

    def __init__(self, stream):
        self.stream, self.buffer, self.z, self.rest = stream, bytearray(), None, b""

    def _more(self) -> bool:
        while True:
            data = self.rest or self.stream.read(CHUNK)
            self.rest = b""
            if not data:
                return False
            if self.z is None:
                self.z = zlib.decompressobj(31)
            out = self.z.decompress(data, 4 * CHUNK)
            self.rest = self.z.unconsumed_tail
            if self.z.eof:
                self.rest, self.z = self.z.unused_data, None
            if out:
                self.buffer += out
                return True

    def head(self) -> dict[str, str] | None:
        """Header fields up to the empty line; None at the end of the archive."""
        while (end := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self._more():
                return None
        lines = bytes(self.buffer[:end]).decode().split("\r\n")
        del self.buffer[: end + 4]
        return {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:] if ": " in x)}

    def read(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more():
            pass
        out = bytes(self.buffer[:n])
        if len(out) < n:
            raise EOFError("the archive ends inside a record")
        del self.buffer[:n]
        return out


def _chunks(stream) -> Iterator[tuple]:
    reader = Reader(stream)
    while (warc := reader.head()) is not None:
        before = int(warc["content-length"])
        http = reader.head()
        size = int(http["content-length"])
        kind, refers = warc["warc-type"], warc.get("refers-to-page-id")
        known = (warc["warc-record-id"].strip("<>"), int(warc["page-id"]) if "page-id" in warc else None, warc.get("warc-target-uri"), kind, int(refers) if refers else None, size)
        want = warc["warc-payload-digest"].removeprefix("sha1:")
        if kind == "revisit":
            yield (*known, 0, 0, None, want, True)
        else:
            sha, at, chunk = hashlib.sha1(), 0, 0
            while True:
                data = reader.read(min(CHUNK, size - at))
                sha.update(data)
                digest = base64.b32encode(sha.copy().digest()).decode()
                last = at + len(data) == size
                if last and digest != want:
                    raise ValueError(f"payload digest of {known[0]} differs from its header")
                yield (*known, chunk, at, data, digest, last)
                at, chunk = at + len(data), chunk + 1
                if last:
                    break
        if reader.read(4) != b"\r\n\r\n" or before < 0:
            raise ValueError("a record does not end where its length says")


def read(spark: SparkSession, folder: str, archives: DataFrame) -> DataFrame:
    """The chunk table of the archives named in column ``file`` of ``archives``."""

    def run(batches):
        files, at = _open(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with files.open_input_stream(f"{at}/{name}", compression=None, buffer_size=CHUNK) as stream:
                    rows, held = [], 0
                    for row in _chunks(stream):
                        rows.append(row)
                        held += len(row[8] or b"")
                        if held >= 64 * CHUNK or len(rows) >= 5000:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    n = max(1, archives.count())
    return archives.select("file").repartition(n, "file").mapInArrow(run, CHUNK_ROWS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.string(), pa.bool_()]
    names = ["record_id", "id", "uri", "record_type", "refers_to", "payload_bytes", "chunk", "at", "data", "digest", "last"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def archive(pages: DataFrame, min_bytes: int = 0) -> tuple[str, DataFrame]:
    """Write ``pages`` (id, uri, payload) to a new folder; the folder and its list of archives."""
    folder = new_scratch_path(pages.sparkSession, "op3-warc")
    make_folder(pages.sparkSession, folder)
    return folder, staged(write(with_revisits(pages, min_bytes), folder), "op3-files")
