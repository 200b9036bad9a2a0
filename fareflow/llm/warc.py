"""WARC archives as seekable Zstandard bundles.

Every Spark task writes its records into bundles. A bundle is a row of
independent Zstandard frames, each holding whole WARC records, and ends with a
seek table: a skippable frame that lists the compressed and the plain size of
each frame. A reader therefore finds any frame from the last bytes of the file.
An index table maps each record identifier to (bundle, frame, offset inside the
plain frame, length).

Of records with equal payloads the one with the largest page_id is a response
and the others are revisits that point to it.

* null or missing html: an empty payload; null url: an empty target.
* null page_id: the smallest of all; among equal payloads with only null ids,
  each is a response.
* repeated rows that share the largest page_id of a payload: each a response.
* an empty table: no bundle and no row. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.session import shared_dir

# Fixed values of the seekable format and of the WARC format.
SEEK_MAGIC = 0x8F92EAB1
SKIPPABLE_MAGIC = 0x184D2A5E
WARC_VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 128 << 20
LEVEL = 3

INDEX_SCHEMA = "record_id string, page_id long, bundle string, frame int, frame_at long, frame_size long, offset long, length long"
PAGE_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
               "refers_to long, url string, record_id string")


def with_roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages with ``digest`` (hex SHA-1), ``refers_to`` and ``revisit``.

    Only digests and ids are grouped, with a partial maximum per task, so a
    payload shared by a third of all pages costs one row per task.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    last = rows.groupBy("digest").agg(F.max("page_id").alias("last_id"))
    revisit = ((F.length("payload") >= min_bytes) & F.col("last_id").isNotNull()
               & ~F.col("page_id").eqNullSafe(F.col("last_id")))
    return (rows.join(last, "digest").withColumn("revisit", revisit)
            .select("page_id", "url", "payload", "digest", "revisit",
                    F.when(F.col("revisit"), F.col("last_id")).alias("refers_to")))


def record_id(page_id: int | None, digest: str) -> str:
    """Page ids alone may be null or repeated, so the payload takes part."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def encode_record(page_id, url, payload: bytes, digest: str, revisit: bool, refers_to) -> bytes:
    digest32 = base64.b32encode(bytes.fromhex(digest)).decode()
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)),
            ("WARC-Target-URI", "".join((url or "").splitlines())), ("WARC-Payload-Digest", f"sha1:{digest32}"),
            ("X-Payload-Length", str(len(payload))), ("X-Page-ID", "" if page_id is None else str(page_id))]
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    if revisit:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)),
                 ("X-Refers-To-Page-ID", str(refers_to))]
        body = http
    else:
        body = http + payload
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    return b"".join([WARC_VERSION, b"\r\n", "".join(f"{k}: {v}\r\n" for k, v in head).encode(), b"\r\n", body, b"\r\n\r\n"])


def decode_records(plain: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, HTTP body) of each record of a plain frame, or of a slice that starts at a record."""
    at = 0
    while at < len(plain):
        stop = plain.index(b"\r\n\r\n", at)
        lines = plain[at:stop].decode().split("\r\n")
        if lines[0].encode() != WARC_VERSION:
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        body = plain[stop + 4:stop + 4 + int(head["Content-Length"])]
        yield head, body[body.index(b"\r\n\r\n") + 4:]
        at = stop + 4 + int(head["Content-Length"]) + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", packed, plain) for packed, plain in frames)
    body = entries + struct.pack("<IBI", len(frames), 0, SEEK_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(start, packed size, plain size) of each frame."""
    file.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEK_MAGIC:
        raise ValueError("not a seekable bundle")
    file.seek(size - 9 - 8 * count)
    out, at = [], 0
    for packed, plain in struct.iter_unpack("<II", file.read(8 * count)):
        out.append((at, packed, plain))
        at += packed
    return out


class Bundle:
    """One bundle being written. Frames close at ``FRAME_BYTES`` of plain records,
    so a task holds one frame, or one record if that is longer."""

    def __init__(self, store: fs.FileSystem, folder: str, name: str):
        self.store, self.path, self.name = store, f"{folder}/{name}", name
        self.temporary = f"{folder}/_{name}.{uuid.uuid4().hex}"
        self.out = store.open_output_stream(self.temporary)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frames, self.records, self.size, self.at = [], [], 0, 0

    def add(self, page_id, ident: str, record: bytes) -> list[tuple]:
        self.records.append((page_id, ident, record))
        self.size += len(record)
        return self.close_frame() if self.size >= FRAME_BYTES else []

    def close_frame(self) -> list[tuple]:
        if not self.records:
            return []
        plain = b"".join(r for _, _, r in self.records)
        packed = self.packer.compress(plain)
        self.out.write(packed)
        rows, offset = [], 0
        for page_id, ident, record in self.records:
            rows.append((ident, page_id, self.name, len(self.frames), self.at, len(packed), offset, len(record)))
            offset += len(record)
        self.frames.append((len(packed), len(plain)))
        self.at += len(packed)
        self.records, self.size = [], 0
        return rows

    def close(self) -> list[tuple]:
        rows = self.close_frame()
        self.out.write(seek_table(self.frames))
        self.out.close()
        self.store.move(self.temporary, self.path)
        return rows


def write_archive(pages: DataFrame, root: str, min_bytes: int = 0) -> None:
    """Bundles under ``root/bundles`` and the index table under ``root/index``.

    A task names its bundles after its attempt and returns their index rows;
    only rows of the attempts that Spark commits reach the index, and readers
    open only bundles of the index. A retried task leaves its first bundle
    unread.
    """
    folder = f"{root}/bundles"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        stem = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        names = [f.strip().split(" ")[0] for f in INDEX_SCHEMA.split(",")]
        bundle, made = None, 0

        def table_of(rows):
            columns = list(zip(*rows))
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 4)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            columns = [batch.column(n) for n in ("page_id", "url", "payload", "digest", "revisit", "refers_to")]
            for i in range(batch.num_rows):
                page_id, url, payload, digest, revisit, refers_to = (c[i].as_py() for c in columns)
                if bundle is None:
                    bundle = Bundle(store, base, f"{stem}-{made:04d}.warc.zst")
                    made += 1
                rows = bundle.add(page_id, record_id(page_id, digest),
                                  encode_record(page_id, url, payload, digest, revisit, refers_to))
                if bundle.at >= BUNDLE_BYTES:
                    rows += bundle.close()
                    bundle = None
                if rows:
                    yield table_of(rows)
        if bundle is not None and (rows := bundle.close()):
            yield table_of(rows)

    with_roles(pages, min_bytes).mapInArrow(write, INDEX_SCHEMA).write.mode("overwrite").parquet(f"{root}/index")


def read_index(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{root}/index")


def read_archive(spark: SparkSession, root: str, with_payload: bool = False) -> DataFrame:
    """Every record of every bundle, one frame at a time, frames spread over the cluster."""
    frames = read_index(spark, root).select("bundle", "frame", "frame_at", "frame_size").distinct()
    return _read(frames, root, with_payload)


def fetch(spark: SparkSession, root: str, ids: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records whose ``record_id`` is in ``ids``; only their frames are read."""
    spots = read_index(spark, root).join(ids.select("record_id").distinct(), "record_id", "left_semi")
    return _read(spots.groupBy("bundle", "frame", "frame_at", "frame_size")
                 .agg(F.collect_list(F.struct("offset", "length")).alias("spots")), root, with_payload)


def _read(frames: DataFrame, root: str, with_payload: bool) -> DataFrame:
    schema = PAGE_SCHEMA + (", payload binary" if with_payload else "")
    folder = f"{root}/bundles"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        unpacker = zstandard.ZstdDecompressor()
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()] + [pa.binary()] * with_payload
        names = [f.strip().split(" ")[0] for f in schema.split(",")]
        for batch in batches:
            for spot in batch.to_pylist():
                with store.open_input_file(f"{base}/{spot['bundle']}") as file:
                    file.seek(spot["frame_at"])
                    plain = unpacker.decompress(file.read(spot["frame_size"]))
                parts = ([plain[s["offset"]:s["offset"] + s["length"]] for s in spot["spots"]] if "spots" in spot else [plain])
                rows = [page_row(head, body, with_payload) for part in parts for head, body in decode_records(part)]
                columns = list(zip(*rows)) or [[] for _ in kinds]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return frames.repartition("bundle", "frame").mapInArrow(read, schema)


def page_row(head: dict[str, str], body: bytes, with_payload: bool) -> tuple:
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = head["WARC-Type"]
    if kind == "response" and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
        raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
    as_id = lambda text: int(text) if text else None
    row = (as_id(head.get("X-Page-ID", "")), int(head["X-Payload-Length"]), digest, kind,
           as_id(head.get("X-Refers-To-Page-ID", "")), head.get("WARC-Target-URI", ""), head["WARC-Record-ID"])
    return row + ((body if kind == "response" else None,) if with_payload else ())


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` to a new archive in the shared folder and read it back."""
    root = shared_dir(spark, "warc")
    write_archive(pages, root)
    return read_archive(spark, root)
