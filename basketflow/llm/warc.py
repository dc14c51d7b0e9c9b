"""WARC records in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding some whole
WARC records, closed by the seek table of Zstandard's seekable format (a
skippable frame that lists every frame's compressed and decompressed size). An
index row maps a record identifier to its bundle, frame and offset inside the
decompressed frame, so one record costs one frame's read.

Bundles are written by the tasks themselves to shared storage, under a name
that no other attempt uses; the index is a Parquet table that Spark commits.
A task that is lost or run twice leaves at most a file that no index row names.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.graph import written
from basketflow.llm.words import ready
from basketflow.session import scratch_dir

#: Decompressed bytes after which a frame, and a bundle, is closed.
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
#: Payloads below it are always stored in full.
REVISIT_BYTES = 100
# Fixed values of the seekable format: skippable-frame magic, footer magic.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit."""
    revisit = refers_to is not None
    target = " ".join((url or "").split()).encode("ascii", "backslashreplace").decode() or "about:blank"
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {record_id(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """A record's headers and payload. A revisit has no payload; its length is
    the one its HTTP header states."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record at this offset")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    http, _, payload = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length:"))
    return {"headers": fields, "payload": payload, "length": length}


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame for (compressed, decompressed) sizes."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(f, size: int) -> list[tuple[int, int, int]]:
    """(file offset, compressed, decompressed) of each frame of a bundle."""
    f.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8
    f.seek(size - 9 - n * entry)
    table, out, at = f.read(n * entry), [], 0
    for i in range(n):
        packed, plain = struct.unpack_from("<II", table, i * entry)
        out.append((at, packed, plain))
        at += packed
    return out


def _store(uri: str):
    """(file system, path) of a shared folder; local paths, file:, hdfs:, s3:
    and gs: folders can be used."""
    from pyarrow import fs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


class _Bundle:
    """A bundle being written, frame by frame."""

    def __init__(self, folder: str, level: int):
        import zstandard

        store, path = _store(folder)
        store.create_dir(path, recursive=True)
        self.name = f"part-{uuid.uuid4().hex}.warc.zst"
        self.out = store.open_output_stream(f"{path}/{self.name}", compression=None)
        self.packer = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.frames, self.open, self.size, self.total = [], [], 0, 0
        self.add(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:%s>\r\n"
                 b"WARC-Date: 1970-01-01T00:00:00Z\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
                 % str(uuid.uuid4()).encode())

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, offset) at which the record stands."""
        if self.size and self.size + len(record) > FRAME_BYTES:
            self._flush()
        at = len(self.frames), self.size
        self.open.append(record)
        self.size += len(record)
        self.total += len(record)
        return at

    def _flush(self) -> None:
        packed = self.packer.compress(b"".join(self.open))
        self.out.write(packed)
        self.frames.append((len(packed), self.size))
        self.open, self.size = [], 0

    def close(self) -> None:
        if self.size:
            self._flush()
        self.out.write(seek_table(self.frames))
        self.out.close()


def mark_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_digest, refers_to): of equal payloads of
    at least REVISIT_BYTES bytes, all but those with the smallest page id refer
    to it. A null id is never referred to and never refers; a null payload is
    empty."""
    p = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url"),
                     F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload")) \
        .withColumn("payload_digest", F.sha2("payload", 256))
    long = p.where(F.octet_length("payload") >= REVISIT_BYTES).select("page_id", "payload_digest")
    first = long.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("_last")) \
        .where("refers_to < _last").select("payload_digest", "refers_to")
    # Written, so that the join has a plain scan on this side and Spark can
    # split a payload that very many pages share.
    first = written(first, "warc-shared")
    revisits = long.join(first, "payload_digest").where("page_id > refers_to").distinct()
    return p.join(revisits, ["page_id", "payload_digest"], "left")


def write_bundles(records: DataFrame, folder: str, level: int = 3) -> DataFrame:
    """Write the marked records into bundles below ``folder`` and return the
    committed index: (page_id, record_id, bundle, frame, offset, length)."""
    ready(records.sparkSession, 256)
    id_type = records.schema["page_id"].dataType.simpleString()

    def run(batches):
        bundle = None
        for batch in batches:
            rows = {k: [] for k in ("record_id", "bundle", "frame", "offset", "length")}
            for r in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if bundle is None or bundle.total >= BUNDLE_BYTES:
                    if bundle:
                        bundle.close()
                    bundle = _Bundle(folder, level)
                data = record_bytes(*r)
                frame, offset = bundle.add(data)
                for k, v in zip(rows, (record_id(r[0]), bundle.name, frame, offset, len(data))):
                    rows[k].append(v)
            yield pa.record_batch([batch.column(0), pa.array(rows["record_id"], pa.string()),
                                   pa.array(rows["bundle"], pa.string()), pa.array(rows["frame"], pa.int32()),
                                   pa.array(rows["offset"], pa.int64()), pa.array(rows["length"], pa.int64())],
                                  names=["page_id", *rows])
        if bundle:
            bundle.close()

    index = records.select("page_id", "url", "payload", "payload_digest", "refers_to").mapInArrow(
        run, f"page_id {id_type}, record_id string, bundle string, frame int, offset long, length long")
    path = f"{folder}/index"
    index.write.parquet(path)
    return records.sparkSession.read.schema(index.schema).parquet(path)


def read_bundles(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Look the records of ``index`` up in their bundles: (page_id,
    payload_bytes, payload_digest, record_type, refers_to[, payload]) with
    bundle, frame and offset. A response's length and digest are taken from
    the payload read and held against its header; a revisit's are those its
    headers state."""
    ready(index.sparkSession, 256)
    id_type = index.schema["page_id"].dataType.simpleString()
    near = index.select("page_id", "bundle", "frame", "offset", "length") \
        .repartition("bundle", F.floor(F.col("frame") / 16)).sortWithinPartitions("bundle", "frame", "offset")

    def run(batches):
        import zstandard

        unpack, name, number, frames, f, data = zstandard.ZstdDecompressor(), None, None, [], None, b""
        store, path = _store(folder)
        for batch in batches:
            out = []
            for page_id, bundle, frame, offset, length in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if bundle != name:
                    if f:
                        f.close()
                    f = store.open_input_file(f"{path}/{bundle}")
                    name, number, frames = bundle, None, read_seek_table(f, f.size())
                if frame != number:
                    at, packed, plain = frames[frame]
                    f.seek(at)
                    data, number = unpack.decompress(f.read(packed), max_output_size=plain), frame
                rec = parse_record(data[offset:offset + length])
                head = rec["headers"]
                digest, refers = head["WARC-Payload-Digest"].removeprefix("sha256:"), None
                if head["WARC-Type"] == "revisit":
                    refers = head["WARC-Refers-To"][len("<urn:x-page:"):-1]
                elif hashlib.sha256(rec["payload"]).hexdigest() != digest or len(rec["payload"]) != rec["length"]:
                    raise ValueError(f"damaged record {head['WARC-Record-ID']} in {bundle}")
                if head["WARC-Record-ID"] != record_id(page_id):
                    raise ValueError(f"the index names another record than {head['WARC-Record-ID']}")
                out.append((rec["length"], digest, head["WARC-Type"], refers, bundle, frame, offset, rec["payload"]))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
            cols = [pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)][:8 if with_payload else 7]
            yield pa.record_batch([batch.column(0), *cols], names=["page_id", *names])
        if f:
            f.close()

    names = ["payload_bytes", "payload_digest", "record_type", "refers_to", "bundle", "frame", "offset"]
    names += ["payload"] * with_payload
    kinds = "long, string, string, string, string, int, long, binary".split(", ")
    out = near.mapInArrow(run, ", ".join([f"page_id {id_type}", *(f"{n} {t}" for n, t in zip(names, kinds))]))
    return out.withColumn("refers_to", F.col("refers_to").cast(id_type))


def archive_pages(pages: DataFrame, folder: str | None = None, level: int = 3) -> tuple[DataFrame, str]:
    """Write ``pages`` (page_id, url, html) as WARC bundles below ``folder``
    (a new shared scratch folder if none is given); returns (index, folder).

    Nulls: html null is an empty payload, url null is ``about:blank``, a null
    page id is stored as a response. Rows that repeat an id and payload are
    stored alike; an empty table writes no bundle; other columns are ignored.
    """
    folder = folder or scratch_dir(pages.sparkSession, "warc")
    return write_bundles(mark_revisits(pages), folder, level), folder
