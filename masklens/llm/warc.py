"""WARC archives as seekable Zstandard bundles.

``write_bundles`` writes one WARC record per row into bundle files in the shared folder: records are
grouped into independent Zstandard frames, and each bundle ends in a seek table (a skippable frame that
lists the compressed and plain size of every frame). Its rows are the index: record id -> bundle, frame,
offset and length inside the plain frame. ``read_records`` reads records back through index and seek
table, decompressing only the frames asked for. Equal payloads are stored once; the others are revisits.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masklens.llm.common import stored

FRAME_BYTES = 256 << 10  # a frame is closed once its plain size reaches this
BUNDLE_BYTES = 32 << 20  # a bundle is closed once its compressed size reaches this ...
PLAIN_BYTES = 64 << 20  # ... or its plain size this, which is what one reader of a bundle holds (and one record more) ...
BUNDLE_RECORDS = 20_000  # ... or it has so many records
LEVEL = 3
# fixed values of the public seekable format (little endian)
SKIPPABLE_MAGIC, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1

INDEX = ("record_id string, bundle string, frame int, at long, length long")
RECORD = ("record_id string, record_type string, uri string, refers_to string, payload_bytes long, "
          "payload_digest string, payload binary")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(record_id: str, kind: str, uri: str | None, digest: str, size: int, refers_to: str | None,
                 payload: bytes) -> bytes:
    """One WARC 1.1 record. A revisit names its response and holds no payload; its size is in a header."""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{record_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if uri is not None:
        head.append("WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A"))
    body = payload if kind == "response" else b""
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple:
    """A record's columns in the order of ``RECORD``; a response's size and digest come from its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    named = dict(x.split(": ", 1) for x in lines[1:])
    payload = rest[:int(named["Content-Length"])]
    if rest[len(payload):] != b"\r\n\r\n":
        raise ValueError("a record is cut or too long")
    own = lambda x: x.removeprefix("<urn:page:").removesuffix(">")
    told = named["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = named["WARC-Type"]
    if kind == "response":
        if payload_digest(payload) != told:
            raise ValueError("a payload does not match its digest")
        size = len(payload)
    else:
        size, payload = int(named["X-Payload-Length"]), None
    return (own(named["WARC-Record-ID"]), kind, named.get("WARC-Target-URI"),
            own(named["WARC-Refers-To"]) if "WARC-Refers-To" in named else None, size, told, payload)


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame for frames of (compressed, plain) size, without checksums."""
    body = b"".join(struct.pack("<II", c, d) for c, d in sizes) + struct.pack("<IBI", len(sizes), 0, SEEK_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(offset in the file, compressed size, plain size) of every frame, from the end of a bundle."""
    file.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8
    file.seek(size - 9 - count * entry)
    raw, frames, at = file.read(count * entry), [], 0
    for i in range(count):
        c, d = struct.unpack_from("<II", raw, i * entry)
        frames.append((at, c, d))
        at += c
    return frames


def _store(folder: str):
    """The file system of a folder given by URI or absolute path, and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        fs.LocalFileSystem(), folder)


class _Bundle:
    """Collects records into frames; ``close`` writes the file under its final name in one move."""

    def __init__(self):
        import zstandard

        self.zip = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.frames: list[tuple[int, int]] = []
        self.parts: list[bytes] = []
        self.plain = bytearray()
        self.rows: list[tuple[str, int, int, int]] = []
        self.size = 0

    def add(self, record_id: str, raw: bytes) -> None:
        if self.plain and len(self.plain) + len(raw) > FRAME_BYTES:
            self.end_frame()
        self.rows.append((record_id, len(self.frames), len(self.plain), len(raw)))
        self.plain += raw

    def end_frame(self) -> None:
        if self.plain:
            packed = self.zip.compress(bytes(self.plain))
            self.frames.append((len(packed), len(self.plain)))
            self.parts.append(packed)
            self.size += len(packed)
            self.plain = bytearray()

    def full(self) -> bool:
        plain = sum(size for _, size in self.frames) + len(self.plain)
        return self.size >= BUNDLE_BYTES or plain >= PLAIN_BYTES or len(self.rows) >= BUNDLE_RECORDS

    def close(self, folder: str) -> pd.DataFrame:
        self.end_frame()
        store, base = _store(folder)
        name = f"{uuid.uuid4().hex}.warc.zst"
        with store.open_output_stream(f"{base}/.{name}", compression=None) as out:
            for part in self.parts:
                out.write(part)
            out.write(seek_table(self.frames))
        store.move(f"{base}/.{name}", f"{base}/{name}")
        frame = pd.DataFrame(self.rows, columns=["record_id", "frame", "at", "length"])
        frame.insert(1, "bundle", name)
        return frame


def write_bundles(records: DataFrame, folder: str) -> DataFrame:
    """Write ``records`` (record_id, record_type, uri, refers_to, payload binary, payload_digest hex of the
    SHA-1) as bundles in ``folder``; returns the stored index.

    A retried or repeated task writes new bundles under new names; only the index of the attempt that
    Spark commits names a bundle, so an unfinished or repeated one is never read.
    """
    store, base = _store(folder)
    store.create_dir(base, recursive=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundle = _Bundle()
        for batch in batches:
            for row in batch.itertuples(index=False):
                payload = bytes(row.payload) if row.payload is not None else b""
                digest = base64.b32encode(bytes.fromhex(row.payload_digest)).decode()
                text = lambda x: None if x is None or x != x else str(x)
                bundle.add(str(row.record_id), record_bytes(str(row.record_id), row.record_type, text(row.uri), digest,
                                                            len(payload), text(row.refers_to), payload))
                if bundle.full():
                    yield bundle.close(folder)
                    bundle = _Bundle()
        if bundle.rows:
            yield bundle.close(folder)

    return stored(records.mapInPandas(run, INDEX), f"{folder}/index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` (all of it, or the rows of some record ids) points at: columns ``RECORD``.

    One group per bundle; of a bundle, the seek table and the frames asked for are read.
    """
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        store, base = _store(folder)
        unzip, out = zstandard.ZstdDecompressor(), []
        with store.open_input_file(f"{base}/{rows['bundle'].iloc[0]}") as file:
            frames = read_seek_table(file, file.size())
            for number, some in rows.sort_values(["frame", "at"]).groupby("frame", sort=True):
                at, packed, plain = frames[number]
                file.seek(at)
                data = unzip.decompress(file.read(packed))
                if len(data) != plain:
                    raise ValueError("a frame does not have the size that the seek table gives")
                for record_id, start, length in zip(some["record_id"], some["at"], some["length"], strict=True):
                    out.append(parse_record(data[start:start + length]))
                    if out[-1][0] != record_id:
                        raise ValueError("the index points at another record")
        return pd.DataFrame(out, columns=["record_id", "record_type", "uri", "refers_to", "payload_bytes",
                                          "payload_digest", "payload"])

    return index.groupBy("bundle").applyInPandas(run, RECORD)


def as_records(pages: DataFrame, path: str, *, page_id: str = "page_id", uri: str = "url", body: str = "html",
               least_bytes: int = 0) -> DataFrame:
    """Records for ``pages``: of equal payloads of at least ``least_bytes`` bytes, the largest id is the response.

    The payload is the body in UTF-8, empty for null. Rows that share a payload and the largest id are
    all responses; a null id counts as the smallest. An empty table gives no records, and other columns
    are not read. The largest id per payload is found on digests alone and stored, so that a payload with
    a third of all rows is pre-aggregated and its join can be split by adaptive execution.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(uri).cast("string").alias("uri"),
                        F.coalesce(F.col(body), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload"))
    last = stored(rows.where(F.octet_length("payload") >= least_bytes).groupBy("payload_digest")
                  .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1")
                  .select("payload_digest", "last"), f"{path}/last")
    return (rows.join(last, "payload_digest", "left")
            .withColumn("again", F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
                        & (F.octet_length("payload") >= least_bytes))
            .select(F.coalesce(F.col("page_id").cast("string"), F.lit("null")).alias("record_id"),
                    F.when(F.col("again"), "revisit").otherwise("response").alias("record_type"), "uri",
                    F.when(F.col("again"), F.col("last").cast("string")).alias("refers_to"), "payload", "payload_digest"))
