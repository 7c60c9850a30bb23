"""Monolithic gzip normaliser for WARC archives.

Some writers gzip a whole archive as one stream, which can only be read from its
start.  The normaliser inflates such a stream once, rewrites every record as a
gzip member of its own and writes a sidecar index of offsets; from then on any
record is one ranged read, and archives split over many tasks.

Archives are files in the shared folder, reached from the tasks through
``pyarrow.fs`` by the folder's URI.  Each attempt of a task writes names of its
own, and only names in the written manifest count, so a lost or doubled task
leaves nothing behind that is read.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PLACE, placed, shared_path, written

LEAST_PAYLOAD = 100
CHUNK = 1 << 20
GZIP = 16 + zlib.MAX_WBITS
END = b"\r\n\r\n"


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder's URI, or of a plain path."""
    if re.match(r"^file:/[^/]", uri):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


# -- records ---------------------------------------------------------------

def render(kind: str, record_id: str, headers: dict[str, str], payload: bytes) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{record_id}>",
            *[f"{k}: {v}" for k, v in headers.items()], f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + END + payload + END


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(END)
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return headers, rest[:int(headers["Content-Length"])]


def header_safe(value: str | None) -> str:
    """JSON in ASCII: no line break or control character gets into a header."""
    return json.dumps(value)


def records(stream: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of an inflated stream, whose parts may end anywhere."""
    buffer = bytearray()
    for part in stream:
        buffer += part
        while (head := buffer.find(END)) >= 0:
            size = int(re.search(rb"(?im)^Content-Length: (\d+)\r?$", bytes(buffer[:head])) [1])
            end = head + len(END) + size + len(END)
            if len(buffer) < end:
                break
            yield bytes(buffer[:end])
            del buffer[:end]
    if buffer:
        raise ValueError(f"{len(buffer)} bytes after the last whole record")


def inflate(source: BinaryIO) -> Iterator[bytes]:
    """The source as one stream; members, if there are many, follow each other."""
    z = zlib.decompressobj(GZIP)
    while data := source.read(CHUNK):
        while data:
            if z.eof:
                z = zlib.decompressobj(GZIP)
            part = z.decompress(data, 4 * CHUNK)
            data = z.unconsumed_tail or z.unused_data
            if part:
                yield part
    while part := z.decompress(z.unconsumed_tail, 4 * CHUNK) if z.unconsumed_tail else z.flush():
        yield part
    if not z.eof:
        raise ValueError("the gzip stream is cut off")


def member(record: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    return z.compress(record) + z.flush()


# -- steps -----------------------------------------------------------------

def record_types(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, n_bytes, record_type, refers_to, refers_null.

    Of equal payloads of ``LEAST_PAYLOAD`` bytes or more, the row with the
    smallest page_id (null last; ties: the first in the table) is the response.
    The choice is an aggregate by digest; the join back can be split where one
    payload has many copies, and short payloads don't meet in it at all.
    """
    html = F.coalesce("html", F.lit("")).cast("binary")
    d = placed(pages, "page_id", "url", html.alias("payload"))
    d = d.withColumns({"digest": F.sha2("payload", 256), "n_bytes": F.octet_length("payload").cast("long"),
                       "rank": F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("page_id"), *PLACE)})
    first = d.where(F.col("n_bytes") >= LEAST_PAYLOAD).groupBy(F.col("digest").alias("key")).agg(F.min("rank").alias("first"))
    key = F.when(F.col("n_bytes") >= LEAST_PAYLOAD, F.col("digest")).otherwise(F.concat_ws("/", F.lit("short"), *PLACE))
    d = d.withColumn("join_key", key).join(first, F.col("join_key") == F.col("key"), "left")
    revisit = F.col("first").isNotNull() & (F.col("first") != F.col("rank"))
    return d.select("page_id", "url", "payload", "digest", "n_bytes",
                    F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                    F.when(revisit, F.col("first.page_id")).alias("refers_to"))


def write_monolithic(rows: DataFrame, folder: str) -> DataFrame:
    """Each partition as one archive, gzipped as a single stream: path, n_records."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        path, out, n = f"{base}/{uuid.uuid4().hex}.warc.gz", None, 0
        z = zlib.compressobj(6, zlib.DEFLATED, GZIP)
        for batch in batches:
            for i in range(batch.num_rows):
                r = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
                if out is None:
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(path, compression=None)
                page = "null" if r["page_id"] is None else str(r["page_id"])
                headers = {"WARC-Target-URI": header_safe(r["url"]), "WARC-Payload-Digest": f"sha256:{r['digest']}",
                           "X-Payload-Length": str(r["n_bytes"])}
                body = r["payload"]
                if r["record_type"] == "revisit":
                    body = b""
                    headers |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                                "WARC-Refers-To": "null" if r["refers_to"] is None else f"<urn:page:{r['refers_to']}>"}
                out.write(z.compress(render(r["record_type"], page, headers, body)))
                n += 1
        if out is not None:
            out.write(z.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [n]})

    return written(rows.mapInArrow(write, "path string, n_records long"), "warc-manifest")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive of ``path`` with a member for each record, and a
    sidecar ``.idx`` of JSON lines beside it; returns the index: path, offset,
    length, page, record_type.

    An archive is inflated once, from its start to its end, by one task; memory
    is bounded by its longest record.
    """
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        for batch in batches:
            for source in batch.column(0).to_pylist():
                fs.create_dir(base, recursive=True)
                path, at, rows = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, []
                with (fs.open_input_stream(source, compression=None) as src, fs.open_output_stream(path, compression=None) as out,
                      fs.open_output_stream(f"{path}.idx", compression=None) as idx):
                    for record in records(inflate(src)):
                        headers, _ = parse(record)
                        packed = member(record)
                        out.write(packed)
                        row = {"offset": at, "length": len(packed), "page": headers["WARC-Record-ID"][10:-1],
                               "record_type": headers["WARC-Type"]}
                        idx.write(json.dumps(row).encode() + b"\n")
                        rows.append({"path": path, **row})
                        at += len(packed)
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_pylist(rows)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows)

    n = max(1, archives.count())
    spread = archives.select("path").repartition(min(n, 100_000))
    return written(spread.mapInArrow(rewrite, "path string, offset long, length long, page string, record_type string"), "warc-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The record at each index row: page_id, url, payload, payload_bytes,
    payload_digest, record_type, refers_to.  Digest and length of a response are
    those of the payload read; of a revisit, those that its headers carry."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_folder(folder)
        path, source = None, None
        for batch in batches:
            rows = []
            for p, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if p != path:
                    path, source = p, fs.open_input_file(p)
                source.seek(offset)
                headers, payload = parse(zlib.decompress(source.read(length), GZIP))
                page, ref = headers["WARC-Record-ID"][10:-1], headers.get("WARC-Refers-To", "null")
                full = headers["WARC-Type"] == "response"
                rows.append({
                    "page_id": None if page == "null" else int(page), "url": json.loads(headers["WARC-Target-URI"]), "payload": payload,
                    "payload_bytes": len(payload) if full else int(headers["X-Payload-Length"]),
                    "payload_digest": hashlib.sha256(payload).hexdigest() if full else headers["WARC-Payload-Digest"][7:],
                    "record_type": headers["WARC-Type"], "refers_to": None if ref == "null" else int(ref[10:-1])})
                if len(rows) == 256:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
    return index.select("path", "offset", "length").sortWithinPartitions("path", "offset").mapInArrow(
        read, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` as monolithic archives, normalise them and read them back.

    A null html is an empty payload, a null page_id or url stays null, repeated
    rows are records each; further columns are left out; an empty table gives no
    records.  A payload must fit in memory.
    """
    folder = folder or shared_path(pages.sparkSession, "warc")
    manifest = write_monolithic(record_types(pages), f"{folder}/monolithic")
    return read_records(normalise(manifest, f"{folder}/normal"), folder)
