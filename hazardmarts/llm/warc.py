"""WARC archives: one gzip member per record, written by tasks and read back by a sequential reader.

``write_archives`` writes every row as one record. Rows with equal payloads of at least ``min_revisit``
bytes share one response, that of the largest page id; the others become revisit records that carry
the headers but not the payload. ``read_archives`` streams each archive: it inflates one member after
another in small pieces, frames the record by its Content-Length, and checks block and payload digests.

Null payloads count as empty; null urls are written without a target header and read as null; null ids
likewise. Control characters, spaces and non-ASCII characters of a url are percent-encoded in the
header, and a second header keeps the exact url. Ties: if several rows have equal payload and the
largest id, each of them is a response. A payload whose ids are all null is all responses. Payloads of
any length are written and read in pieces. Only the three named columns are read, so further columns
cannot clash. An empty table gives no archives and an empty result.

A task writes to files of new names and reports them in its output rows. Files of lost or repeated
attempts are in no report and so are never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardmarts.llm.common import stored

MIN_REVISIT = 1000
ROLL_BYTES = 128 << 20
# Tasks that read at once; further archives are read one after another.
MAX_READERS = 10_000
PIECE = 1 << 16
# Record and header syntax of the WARC 1.0 format.
VERSION = b"WARC/1.0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
END = b"\r\n\r\n"

MANIFEST = "path string, records bigint, bytes bigint"
RECORD = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, payload binary"
)


class BrokenArchive(ValueError):
    """An archive that breaks the framing or a digest."""


def with_revisits(pages: DataFrame, page_id: str, url: str, payload: str, min_revisit: int) -> DataFrame:
    """page_id, url, payload (binary), digest and ``refers_to`` (null: a response).

    Groups of equal payloads are counted by digest with map-side aggregation; only groups of two or more
    are joined back, one row each, and adaptive execution splits a digest with many rows.
    """
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    groups = (
        rows.where(F.octet_length("payload") >= min_revisit)
        .groupBy(F.col("digest").alias("g_digest"))
        .agg(F.max("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 and first_id is not null")
    )
    refers = F.when(F.col("first_id") != F.coalesce(F.col("page_id"), F.col("first_id") - 1), F.col("first_id"))
    joined = rows.join(groups, F.col("digest") == F.col("g_digest"), "left")
    return joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _quoted(url: str) -> str:
    return "".join(
        chr(b) if 0x21 <= b <= 0x7E else f"%{b:02X}" for b in url.encode("utf-8", "surrogatepass")
    )


def _sha1_header(digest_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest_hex)).decode()


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """The bytes of one record before compression."""
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    lines = [
        ("WARC-Type", "revisit" if refers_to is not None else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", _sha1_header(digest)),
        ("WARC-Block-Digest", _sha1_header(hashlib.sha1(block).hexdigest())),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        lines.append(("WARC-Target-URI", _quoted(url)))
        lines.append(("X-Url", base64.b64encode(url.encode("utf-8", "surrogatepass")).decode()))
    if page_id is not None:
        lines.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        lines += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(refers_to, digest)),
            ("X-Refers-To-Page", str(refers_to)),
        ]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode("ascii") + b"\r\n"
    return head + block + END


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _writer(folder: str, roll_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        out, name, records, size = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for row in zip(*columns, strict=True):  # one Arrow value at a time, not whole batches
                if out is None:
                    store.create_dir(root, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, records, size = store.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                data = _member(build_record(*[v.as_py() for v in row]))
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= roll_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", records, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), schema.types)], schema=schema)

    return write


def located(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme of the file system that Spark finds it on, as Arrow spells it; an unknown one raises here."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    whole = re.sub("^file:/+", "file:///", re.sub("^s3a?://", "s3://", whole))
    fs.FileSystem.from_uri(whole)
    return whole


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
    min_revisit: int = MIN_REVISIT, roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Writes the archives and returns their manifest (path, records, bytes), itself stored."""
    folder = located(pages.sparkSession, folder)
    rows = with_revisits(pages, page_id, url, payload, min_revisit)
    return stored(rows.mapInArrow(_writer(folder, roll_bytes), MANIFEST), "warc-manifest")


def _members(stream, piece: int) -> Iterator[Iterator[bytes]]:
    """For each gzip member an iterator over its inflated pieces, which must be used up in turn."""
    waiting = stream.read(piece)
    while waiting:

        def pieces() -> Iterator[bytes]:
            nonlocal waiting
            unpack = zlib.decompressobj(31)
            while not unpack.eof:
                if not waiting and not (waiting := stream.read(piece)):
                    raise BrokenArchive("the last member is cut off")
                data = unpack.decompress(waiting, piece)
                waiting = unpack.unconsumed_tail or unpack.unused_data
                if data:
                    yield data
            if not waiting:
                waiting = stream.read(piece)

        yield pieces()


def _head(buffer: bytearray, pieces: Iterator[bytes]) -> dict[str, str]:
    """Header lines up to the empty line; what follows stays in the buffer."""
    while (at := buffer.find(END)) < 0:
        piece = next(pieces, None)
        if piece is None or len(buffer) > 1 << 24:
            raise BrokenArchive("a record without an end of its headers")
        buffer += piece
    lines = bytes(buffer[:at]).decode("ascii").split("\r\n")
    del buffer[: at + len(END)]
    return {"": lines[0]} | {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def _sha1_of(header: str) -> str:
    kind, _, value = header.partition(":")
    if kind != "sha1":
        raise BrokenArchive(f"unknown digest {kind!r}")
    return base64.b32decode(value).hex()


def read_record(pieces: Iterator[bytes]) -> tuple:
    """One record, framed by its Content-Length and checked against its digests."""
    buffer = bytearray()
    head = _head(buffer, pieces)
    if head[""] != VERSION.decode():
        raise BrokenArchive(f"not a record: {head['']!r}")
    length = int(head["content-length"])
    for piece in pieces:
        buffer += piece
    if len(buffer) != length + len(END) or buffer[length:] != END:
        raise BrokenArchive("a block of another length than its header says")
    del buffer[length:]
    if hashlib.sha1(buffer).hexdigest() != _sha1_of(head["warc-block-digest"]):
        raise BrokenArchive("block digest")
    http = _head(buffer, iter(()))
    payload, digest, kind = bytes(buffer), _sha1_of(head["warc-payload-digest"]), head["warc-type"]
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(http["content-length"])):
        raise BrokenArchive("payload digest")
    number = lambda key: int(head[key]) if key in head else None
    url = base64.b64decode(head["x-url"]).decode("utf-8", "surrogatepass") if "x-url" in head else None
    return (
        number("x-page-id"), url, kind, number("x-refers-to-page"), int(http["content-length"]), digest,
        payload if kind == "response" else None,
    )


RECORD_ARROW = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])


def read_archive(path: str, piece: int = PIECE) -> Iterator[tuple]:
    store, inner = fs.FileSystem.from_uri(path)
    with store.open_input_stream(inner, compression=None, buffer_size=0) as stream:
        for pieces in _members(stream, piece):
            yield read_record(pieces)


def _reader(with_payload: bool, batch_bytes: int = 4 << 20):
    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, RECORD_ARROW.types, strict=True)], schema=RECORD_ARROW
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for path, expected in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
                count = 0
                for row in read_archive(path):
                    count += 1
                    size += len(row[-1] or b"") + 200
                    rows.append(row if with_payload else (*row[:-1], None))
                    if size >= batch_bytes:
                        yield packed(rows)
                        rows, size = [], 0
                if count != expected:
                    raise BrokenArchive(f"{path}: {count} records, {expected} written")
        if rows:
            yield packed(rows)

    return read


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the archives in a manifest. Archives are dealt out evenly to as many tasks as there are, which a
    number keeps adaptive execution from putting together again."""
    tasks = min(max(manifest.count(), 1), MAX_READERS)
    archives = manifest.select("path", "records").repartitionByRange(tasks, "path")
    return archives.mapInArrow(_reader(with_payload), RECORD)

