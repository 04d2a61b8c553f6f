"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that can each be decompressed alone.  A bundle is a run of frames and ends in the seek
table of the public seekable format, in a skippable frame, so that any Zstandard reader can read the whole as one
stream.  The index maps each record to its bundle, its frame and its place inside the frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oremill.llm.common import blocks, stored
from oremill.session import scratch_dir

#: Payloads shorter than this are written again rather than referred to.
REVISIT_BYTES = 1000
#: A frame is closed at so many bytes of records, a bundle at so many compressed bytes.
FRAME_BYTES, BUNDLE_BYTES = 256 * 1024, 64 * 1024 * 1024
LEVEL = 3

# Fixed values of the seekable format and of WARC 1.1.
_SKIPPABLE, _SEEKABLE, _FOOTER_BYTES = 0x184D2A5E, 0x8F92EAB1, 9
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:oremill:page:"

INDEX = "page_id long, bundle string, frame int, frame_offset long, frame_bytes int, record_offset int, record_bytes int"


def record_types(pages: DataFrame) -> DataFrame:
    """Add ``payload``, ``payload_bytes``, ``payload_digest`` (SHA-1, hex), ``record_type`` and ``refers_to``.

    Of equal payloads of at least ``REVISIT_BYTES`` bytes the one with the largest page id is a response and the others
    revisit it; rows that repeat its id are responses too.  A null payload is an empty one.  A null id never is the
    largest.  Only digests are aggregated.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    large = rows.where(F.col("payload_bytes") >= REVISIT_BYTES)
    shared = large.groupBy("payload_digest").agg(F.max("page_id").alias("owner"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    # Stored, so that the join has a shuffle of its own in which Spark can split a digest that very many pages share.
    joined = rows.join(stored(shared.select("payload_digest", "owner"), "warc-owners"), "payload_digest", "left")
    revisit = F.coalesce((F.col("payload_bytes") >= REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(F.col("owner")) & F.col("owner").isNotNull(), F.lit(False))
    return joined.select(
        *rows.columns,
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("owner")).alias("refers_to"),
    )


def _record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record: a whole HTTP response, or of a revisit its head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {quote(url, safe=_URI)}"] if url else []),
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        *([f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_ID}{refers_to}>"] if refers_to is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URI = "!#$%&'()*+,/:;=?@[]~"


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records that stand one after the other in some bytes: header fields in lower case, and the block."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        size = int(head["content-length"])
        yield head, data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


class _Bundle:
    """A bundle being written: frames go out as they fill, the seek table at the end."""

    def __init__(self, folder: str, frame_bytes: int):
        self.frame_bytes = frame_bytes
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        system, path = fs.FileSystem.from_uri(self.path)
        self.out, self.compressor = system.open_output_stream(path, compression=None), zstandard.ZstdCompressor(level=LEVEL)
        self.sizes: list[tuple[int, int]] = []
        self.written, self.frame, self.places = 0, bytearray(), []

    def add(self, page_id, record: bytes) -> list[dict]:
        """Index rows of the records that are now in the file."""
        self.places.append((page_id, len(self.frame), len(record)))
        self.frame += record
        return self.flush() if len(self.frame) >= self.frame_bytes else []

    def flush(self) -> list[dict]:
        if not self.places:
            return []
        packed = self.compressor.compress(bytes(self.frame))
        self.out.write(packed)
        common = {"bundle": self.path, "frame": len(self.sizes), "frame_offset": self.written, "frame_bytes": len(packed)}
        rows = [{"page_id": p, **common, "record_offset": at, "record_bytes": size} for p, at, size in self.places]
        self.sizes.append((len(packed), len(self.frame)))
        self.written += len(packed)
        self.frame, self.places = bytearray(), []
        return rows

    def close(self) -> list[dict]:
        rows = self.flush()
        entries = b"".join(struct.pack("<II", *size) for size in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()
        return rows


_ARROW_INDEX = pa.schema(
    [("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("frame_offset", pa.int64()), ("frame_bytes", pa.int32()), ("record_offset", pa.int32()), ("record_bytes", pa.int32())]
)


def write(
    pages: DataFrame,
    folder: str,
    date: str = "1970-01-01T00:00:00Z",
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write one record for each row of ``page_id``, ``url`` and ``html`` to bundles in a shared folder; gives the index.

    Every task writes bundles of its own under new names.  The index is stored by Spark, which takes the rows of one
    attempt of each task, so what a lost or repeated task has left behind is never referred to.  A null html is an empty
    payload, a null url no target; repeated rows are repeated records; an empty table gives an empty index.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for block in blocks(batches, "payload"):
            rows: list[dict] = []
            for r in block.to_pylist():
                bundle = bundle or _Bundle(folder, frame_bytes)
                rows += bundle.add(r["page_id"], _record(r["page_id"], r["url"], r["payload"], r["payload_digest"], r["refers_to"], date))
                if bundle.written >= bundle_bytes:
                    rows += bundle.close()
                    bundle = None
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _ARROW_INDEX)
        if bundle:
            yield pa.RecordBatch.from_pylist(bundle.close(), _ARROW_INDEX)

    typed = record_types(pages).select("page_id", "url", "payload", "payload_digest", "refers_to")
    _make(folder)
    return stored(typed.mapInArrow(run, INDEX), "warc-index")


def _make(folder: str) -> None:
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)


def _seek_table(path: str) -> list[tuple[int, int]]:
    """Offset and size of each frame, from the end of the file alone."""
    system, inner = fs.FileSystem.from_uri(path)
    with system.open_input_file(inner) as file:
        size = file.size()
        file.seek(size - _FOOTER_BYTES)
        count, flags, magic = struct.unpack("<IBI", file.read(_FOOTER_BYTES))
        if magic != _SEEKABLE or flags:
            raise ValueError(f"{path} has no seek table without checksums")
        file.seek(size - _FOOTER_BYTES - 8 * count)
        table = file.read(8 * count)
    found, at = [], 0
    for packed, _ in struct.iter_unpack("<II", table):
        found.append((at, packed))
        at += packed
    return found


def _frame(path: str, offset: int, size: int) -> bytes:
    system, inner = fs.FileSystem.from_uri(path)
    with system.open_input_file(inner) as file:
        file.seek(offset)
        return zstandard.ZstdDecompressor().decompress(file.read(size))


RECORD = "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, target string"
_ARROW_RECORD = pa.schema(
    [("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("target", pa.string())]
)


def _row(head: dict[str, str], block: bytes) -> dict:
    """What a record says; the digest and the size are the header's, and for a response they are checked."""
    number = lambda v: int(v) if (v := v.strip("<>").removeprefix(_ID)) else None
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(line for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")).partition(b":")[2])
    digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
    whole = head["warc-type"] == "response"
    if whole and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {head['warc-record-id']} is damaged")
    return {
        "page_id": number(head["warc-record-id"]),
        "record_type": head["warc-type"],
        "refers_to": number(head["warc-refers-to"]) if "warc-refers-to" in head else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if whole else None,
        "target": head.get("warc-target-uri"),
    }


def read(spark: SparkSession, bundles: DataFrame) -> DataFrame:
    """All records of the bundles named in a column ``bundle``, each frame read by its place in the seek table."""

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [{"bundle": p, "at": at, "size": size} for p in batch.column("bundle").to_pylist() for at, size in _seek_table(p)]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("bundle", pa.string()), ("at", pa.int64()), ("size", pa.int64())]))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                yield pa.RecordBatch.from_pylist([_row(*r) for r in parse(_frame(f["bundle"], f["at"], f["size"]))], _ARROW_RECORD)

    places = bundles.select("bundle").distinct().mapInArrow(frames, "bundle string, at long, size long")
    # A frame is the unit of work: few bundles are still read by all tasks.
    spread = places.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spread.mapInArrow(records, RECORD)


def lookup(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records of some page ids, without reading other frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                data = _frame(r["bundle"], r["frame_offset"], r["frame_bytes"])
                part = data[r["record_offset"] : r["record_offset"] + r["record_bytes"]]
                yield pa.RecordBatch.from_pylist([_row(*x) for x in parse(part)], _ARROW_RECORD)

    return index.join(wanted.select("page_id").distinct(), "page_id", "left_semi").mapInArrow(run, RECORD)


def archived(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive all pages in the shared folder and read them back: one row per page."""
    index = write(pages, scratch_dir(spark, "llm-warc"))
    return read(spark, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
