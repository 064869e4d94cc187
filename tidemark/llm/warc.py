"""WARC archives as seekable Zstandard bundles.

A task writes its records into bundles: records are grouped into independent frames, a bundle ends
with a seek table in a skippable frame, and the index maps each record to the offset inside its
frame. Frames are read back on their own, by any task.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, saved, shared_folder, whole_text

# Format numbers of skippable frames and seek tables, and the first line of a record.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
VERSION = b"WARC/1.1"

#: Payloads below this size are never replaced by revisits.
LEAST_REVISIT = 100
#: Uncompressed bytes after which a frame is closed; bounds a task's memory besides the largest record.
FRAME_BYTES = 1 << 20
#: Compressed bytes after which a bundle is closed.
BUNDLE_BYTES = 256 << 20

RECORD = "page_id long, url string, digest string, payload_bytes long, refers_to long, payload binary"
INDEX = (
    "bundle string, frame int, frame_at long, frame_bytes long, content_bytes long, "
    "records array<struct<record_id:string,at:long,length:long>>"
)
READ = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "record_id string"
)
_INDEX_TYPE = pa.schema(
    [
        ("bundle", pa.string()),
        ("frame", pa.int32()),
        ("frame_at", pa.int64()),
        ("frame_bytes", pa.int64()),
        ("content_bytes", pa.int64()),
        (
            "records",
            pa.list_(pa.struct([("record_id", pa.string()), ("at", pa.int64()), ("length", pa.int64())])),
        ),
    ]
)


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or an absolute path, on any store pyarrow can reach."""
    return fs.FileSystem.from_uri(uri)


def _line(value: object) -> bytes:
    """A header value: no line breaks, whatever a URL holds."""
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in str(value)).encode()


def record_id(page_id: int | None) -> str:
    return f"urn:page:{page_id}"


def to_record(
    page_id: int | None, url: str | None, digest: str, size: int, refers_to: int | None, payload: bytes
) -> bytes:
    """One record: a response with its payload, or a revisit with the headers alone."""
    kind = b"response" if refers_to is None else b"revisit"
    head = [
        VERSION,
        b"WARC-Type: " + kind,
        b"WARC-Record-ID: <" + record_id(page_id).encode() + b">",
        b"WARC-Payload-Digest: sha256:" + digest.encode(),
        b"X-Payload-Length: %d" % size,
    ]
    if url is not None:
        head.append(b"WARC-Target-URI: " + _line(url))
    if refers_to is not None:
        head.append(b"WARC-Refers-To: <" + record_id(refers_to).encode() + b">")
        payload = b""
    head.append(b"Content-Length: %d" % len(payload))
    return b"\r\n".join(head) + b"\r\n\r\n" + payload + b"\r\n\r\n"


def from_record(content: memoryview) -> tuple[dict[str, str], memoryview]:
    """Headers and payload of the record that ``content`` holds."""
    head = bytes(content[: 64 << 10])
    end = head.find(b"\r\n\r\n")
    if end < 0:  # a very long address
        head = bytes(content)
        end = head.index(b"\r\n\r\n")
    first, *lines = head[:end].split(b"\r\n")
    if first != VERSION:
        raise ValueError(f"no record starts here: {first[:40]!r}")
    fields = dict(x.decode().split(": ", 1) for x in lines)
    payload = content[end + 4 : end + 4 + int(fields["Content-Length"])]
    if bytes(content[end + 4 + len(payload) :]) != b"\r\n\r\n":
        raise ValueError(f"record {fields['WARC-Record-ID']} does not end where its index says")
    return fields, payload


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame: compressed and content size of each frame, then the footer."""
    body = b"".join(struct.pack("<II", *x) for x in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(source: pa.NativeFile, size: int) -> list[tuple[int, int, int]]:
    """``(offset, compressed size, content size)`` of each frame, from the end of a bundle."""
    source.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE:
        raise ValueError("the bundle has no seek table")
    source.seek(size - 9 - 8 * count)
    sizes = struct.iter_unpack("<II", source.read(8 * count))
    at, out = 0, []
    for packed, content in sizes:
        out.append((at, packed, content))
        at += packed
    return out


class Bundle:
    """A bundle being written by one task attempt, under a name of its own."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        store, path = open_store(self.uri)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.sink = store.open_output_stream(path, compression=None)
        self.packer = zstandard.ZstdCompressor(level=3)
        self.frames: list[tuple[int, int]] = []
        self.at = 0
        self.parts: list[bytes] = []
        self.entries: list[dict] = []
        self.filled = 0

    def add(self, name: str, record: bytes) -> list[dict]:
        """The index rows of the frames that this record closes: the open one if the record would pass
        its size, so that reading a short record never unpacks a long one, and its own if it fills it."""
        closed = [self.flush()] if self.parts and self.filled + len(record) > FRAME_BYTES else []
        self.entries.append({"record_id": name, "at": self.filled, "length": len(record)})
        self.parts.append(record)
        self.filled += len(record)
        if self.filled >= FRAME_BYTES:
            closed.append(self.flush())
        return closed

    def flush(self) -> dict | None:
        if not self.parts:
            return None
        packed = self.packer.compress(b"".join(self.parts))
        self.sink.write(packed)
        row = {
            "bundle": self.uri,
            "frame": len(self.frames),
            "frame_at": self.at,
            "frame_bytes": len(packed),
            "content_bytes": self.filled,
            "records": self.entries,
        }
        self.frames.append((len(packed), self.filled))
        self.at += len(packed)
        self.parts, self.entries, self.filled = [], [], 0
        return row

    def close(self) -> dict | None:
        row = self.flush()
        self.sink.write(seek_table(self.frames))
        self.sink.close()
        return row


def with_revisits(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """Rows to archive (schema ``RECORD``): payload digest, and for a repeated payload the page whose
    response it revisits.

    Equal payloads are those with equal SHA-256. The smallest page of a payload of at least
    ``LEAST_REVISIT`` bytes is its response; rows that repeat this page are responses too. A page
    with a null id revisits the smallest page there is, else is a response.
    """
    payload = F.encode(whole_text(html_col), "UTF-8")
    rows = pages.select(
        column(id_col).cast("long").alias("page_id"),
        column(url_col).cast("string").alias("url"),
        F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        payload.alias("payload"),
    )
    # Only repeated payloads reach the join: their digests with the first page, counted map-side.
    repeated = (
        rows.filter(F.col("payload_bytes") >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .select("digest", "first")
    )
    # The payloads stay where they are if Spark measures the table of repeated digests as small;
    # otherwise adaptive execution splits a hot digest.
    other = ~F.col("page_id").eqNullSafe(F.col("first"))
    joined = rows.join(saved(repeated, "repeated-payloads"), "digest", "left")
    refers = F.when(F.col("first").isNotNull() & other, F.col("first"))
    return joined.select("page_id", "url", "digest", "payload_bytes", refers.alias("refers_to"), "payload")


def write_bundles(records: DataFrame, folder: str) -> DataFrame:
    """Write rows of schema ``RECORD`` below ``folder``, a URI every executor reaches; gives the
    index, one row per frame.

    A task that is run again writes new bundles; only those of the attempt that Spark took are in
    the index. The index is saved, so nothing is written twice afterwards.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle: Bundle | None = None
        for batch in batches:
            names = batch.schema.names
            order = [names.index(x.split()[0]) for x in RECORD.split(", ")]
            for k in range(batch.num_rows):
                page_id, url, digest, size, refers_to, payload = (batch.column(i)[k].as_py() for i in order)
                bundle = bundle or Bundle(folder)
                closed = bundle.add(record_id(page_id), to_record(page_id, url, digest, size, refers_to, payload))
                if closed:
                    yield pa.RecordBatch.from_pylist(closed, _INDEX_TYPE)
                if bundle.at >= BUNDLE_BYTES:
                    row, bundle = bundle.close(), None
                    if row:
                        yield pa.RecordBatch.from_pylist([row], _INDEX_TYPE)
        if bundle and (row := bundle.close()):
            yield pa.RecordBatch.from_pylist([row], _INDEX_TYPE)

    return saved(records.mapInArrow(work, INDEX), "warc-index")


def read_bundles(index: DataFrame) -> DataFrame:
    """Read every record that ``index`` maps (schema ``READ``); other rows of a frame are skipped.

    The seek table must agree with the index, a record must lie where the index says, and the digest
    of a response is computed from the payload read; a difference raises an error.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, pa.NativeFile, list] | None = None
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                if opened is None or opened[0] != row["bundle"]:
                    store, path = open_store(row["bundle"])
                    source = store.open_input_file(path)
                    opened = (row["bundle"], source, read_seek_table(source, source.size()))
                _, source, table = opened
                at, packed, content = table[row["frame"]]
                if (at, packed, content) != (row["frame_at"], row["frame_bytes"], row["content_bytes"]):
                    raise ValueError(f"seek table and index of {row['bundle']} differ")
                source.seek(at)
                frame = memoryview(unpacker.decompress(source.read(packed), max_output_size=content))
                out = [_read(frame[x["at"] : x["at"] + x["length"]]) for x in row["records"]]
                yield pa.RecordBatch.from_pylist(out, _READ_TYPE)

    return index.mapInArrow(work, READ)


_READ_TYPE = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("record_id", pa.string()),
    ]
)


def _number(name: str | None) -> int | None:
    text = (name or "None").strip("<>").rpartition(":")[2]
    return None if text == "None" else int(text)


def _read(content: memoryview) -> dict:
    fields, payload = from_record(content)
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].rpartition(":")[2]
    size = int(fields["X-Payload-Length"])
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    return {
        "page_id": _number(fields["WARC-Record-ID"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _number(fields.get("WARC-Refers-To")),
        "record_id": fields["WARC-Record-ID"].strip("<>"),
    }


def find_records(index: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The index cut down to the records named in ``record_ids`` (column ``record_id``): only their
    frames are read, at their offsets."""
    entries = index.select("*", F.explode("records").alias("entry")).withColumn("record_id", F.col("entry.record_id"))
    wanted = entries.join(record_ids.select("record_id").distinct(), "record_id", "left_semi")
    frame = ["bundle", "frame", "frame_at", "frame_bytes", "content_bytes"]
    # A frame holds a bounded number of records, so their list is bounded.
    return wanted.groupBy(*frame).agg(F.collect_list("entry").alias("records"))


def archive(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Write all pages into bundles below the shared folder; the index, and what reading back gives.

    A null html is an empty payload, null addresses have no header, an empty table gives no bundle;
    extra columns are not read. Each input row is one record.
    """
    folder = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    index = write_bundles(with_revisits(pages), folder)
    return index, read_bundles(index)
