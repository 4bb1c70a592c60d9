"""WARC records in seekable Zstandard bundles.

A bundle is a run of independent zstd frames, each with whole records of about ``FRAME_BYTES``, followed by two skippable
frames: a record map (page id, frame, offset within the decoded frame, length) and, last, the seek table of the public
seekable format (compressed and decompressed size of every frame). Any zstd reader decodes the bundle from its start; a
reader that knows the seek table decodes one frame to get one record.

Records with equal payloads are stored once: the one with the largest page id is the response, the others revisit it.

Edge cases: a null payload is an empty one. A null page id is written as ``null``, is never another record's referent
while a row with an id has the payload, and is a response if none has. Rows that repeat both page id and payload get
the same type each. A null URL leaves the header out. An empty table makes no bundle and an empty result. Extra columns
are not read. Long payloads make a frame of their own; a bundle is closed after ``BUNDLE_BYTES``.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import salt, shared_groups, staged, work_dir
from corpusloom.llm.storage import read_at, read_file, write_file

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 32 << 20
DATE = "1970-01-01T00:00:00Z"
# fixed values of the public zstd seekable format
SKIPPABLE_SEEK_TABLE, SKIPPABLE_RECORD_MAP, SEEKABLE_MAGIC = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
SEEK_FOOTER = struct.Struct("<IBI")
MAP_ROW = np.dtype([("page", "<i8"), ("null", "u1"), ("frame", "<u4"), ("offset", "<u4"), ("length", "<u4")])
EOL = "\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit (``refers_to`` is set) holds the HTTP header without the payload."""
    http = f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: {len(payload)}{EOL}{EOL}"
    block = http.encode() + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(3, "WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~-._"))
    if refers_to is not None:
        head.insert(2, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    return (EOL.join(head) + EOL * 2).encode() + block + (EOL * 2).encode()


def parse(data: bytes, at: int = 0) -> tuple[dict, int]:
    """Fields of the record at ``at`` and where the next one starts."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split(EOL)
    fields = dict(line.split(": ", 1) for line in lines[1:])
    end = stop + 4 + int(fields["Content-Length"])
    http_end = data.index(b"\r\n\r\n", stop + 4)
    http = dict(line.split(": ", 1) for line in data[stop + 4 : http_end].decode().split(EOL)[1:])
    page = fields["WARC-Record-ID"][len("<urn:page:") : -1]
    kind, refers = fields["WARC-Type"], fields.get("WARC-Refers-To")
    payload = data[http_end + 4 : end]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"record {page}: payload doesn't match its digest")
    found = {
        "page_id": None if page == "null" else int(page),
        "payload_bytes": len(payload) if kind == "response" else int(http["Content-Length"]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": int(refers[len("<urn:page:") : -1]) if refers else None,
    }
    return found | {"url": fields.get("WARC-Target-URI"), "payload": payload}, end + 4


class BundleWriter:
    """Collects records into frames; ``content`` is the finished bundle."""

    def __init__(self):
        self.compressor = zstandard.ZstdCompressor(level=3)
        self.frames: list[bytes] = []
        self.sizes: list[int] = []
        self.rows: list[tuple] = []
        self.open: list[bytes] = []
        self.open_bytes = self.bytes = 0

    def add(self, page_id: int | None, data: bytes) -> None:
        if self.open and self.open_bytes + len(data) > FRAME_BYTES:
            self.close_frame()
        self.rows.append((page_id or 0, page_id is None, len(self.frames), self.open_bytes, len(data)))
        self.open.append(data)
        self.open_bytes += len(data)

    def close_frame(self) -> None:
        self.frames.append(self.compressor.compress(b"".join(self.open)))
        self.sizes.append(self.open_bytes)
        self.bytes += len(self.frames[-1])
        self.open, self.open_bytes = [], 0

    def content(self) -> list[bytes]:
        if self.open:
            self.close_frame()
        table = np.array(self.rows, MAP_ROW).tobytes()
        seek = b"".join(struct.pack("<II", len(f), n) for f, n in zip(self.frames, self.sizes, strict=True))
        seek += SEEK_FOOTER.pack(len(self.frames), 0, SEEKABLE_MAGIC)
        return [
            *self.frames,
            struct.pack("<II", SKIPPABLE_RECORD_MAP, len(table)), table,
            struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(seek)), seek,
        ]


def seek_table(tail: bytes) -> np.ndarray:
    """(compressed, decompressed) sizes of the frames, from a bundle's last bytes."""
    n, _, magic = SEEK_FOOTER.unpack(tail[-SEEK_FOOTER.size :])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end")
    return np.frombuffer(tail[-SEEK_FOOTER.size - 8 * n : -SEEK_FOOTER.size], "<u4").reshape(n, 2)


def frame(uri: str, offset: int, length: int) -> bytes:
    """One decoded frame, read without the rest of the bundle."""
    return zstandard.ZstdDecompressor().decompress(read_at(uri, offset, length))


def record_map(uri: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(record map, starts, sizes of the frames) of a bundle, reading only its end."""
    n, _, _ = SEEK_FOOTER.unpack(read_at(uri, -SEEK_FOOTER.size, SEEK_FOOTER.size))
    size = SEEK_FOOTER.size + 8 * n
    sizes = seek_table(read_at(uri, -size, size)).astype(np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes[:, 0])))
    (length,) = struct.unpack("<4xI", read_at(uri, int(starts[-1]), 8))
    return np.frombuffer(read_at(uri, int(starts[-1]) + 8, length), MAP_ROW), starts, sizes


def index(bundles: DataFrame) -> DataFrame:
    """(page_id, path, frame_offset, frame_length, offset, length) of every record, from the bundles' own tables."""

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, starts, sizes = record_map(path)
                at = rows["frame"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows["page"].copy(), mask=rows["null"].astype(bool)), pa.array([path] * len(rows)),
                        pa.array(starts[at]), pa.array(sizes[at, 0]), pa.array(rows["offset"].astype(np.int64)),
                        pa.array(rows["length"].astype(np.int64)),
                    ],
                    ["page_id", "path", "frame_offset", "frame_length", "offset", "length"],
                )

    kinds = "page_id long, path string, frame_offset long, frame_length long, offset long, length long"
    return bundles.select("path").mapInArrow(run, kinds)


def write_bundles(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """Write every row as a record; return the staged list of bundles (path, n_records, n_bytes)."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    page = F.col(id_col).cast("long")
    rows = pages.select(page.alias("page"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload")).withColumn("salt", salt(F.col("page")))
    large = F.octet_length("payload") >= least_bytes
    equal = rows.filter(large).select("sha", "salt", "page")
    first = shared_groups(equal, ["sha"], "salt", F.col("page"), "response")
    refers = F.when(large & ~F.col("page").eqNullSafe(F.col("response")), F.col("response"))
    planned = rows.join(first, ["sha", "salt"], "left").select("page", "url", "payload", "sha", refers.alias("refers"))

    def run(batches):
        part, seq, bundle = TaskContext.get().partitionId(), 0, BundleWriter()

        def close():
            content = bundle.content()
            path = write_file(folder, f"bundle-{part:05d}-{seq:04d}.warc.zst", content)
            values = [[path], [len(bundle.rows)], [sum(map(len, content))]]
            return pa.RecordBatch.from_arrays(list(map(pa.array, values)), ["path", "n_records", "n_bytes"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                for page_id, url, data, sha, refers_to in zip(*(c.to_pylist() for c in batch.slice(lo, 256).columns)):
                    digest = base64.b32encode(bytes.fromhex(sha)).decode()
                    bundle.add(page_id, record(page_id, url, data, digest, refers_to))
                    if bundle.bytes >= BUNDLE_BYTES:
                        yield close()
                        seq, bundle = seq + 1, BundleWriter()
        if bundle.rows:
            yield close()

    return staged(planned.mapInArrow(run, "path string, n_records long, n_bytes long"), "bundles")


def read_bundles(bundles: DataFrame, id_col: str = "page_id", with_payload: bool = False) -> DataFrame:
    """Parse every record of the bundles, frame by frame, checking payloads against their digests."""
    n = max(1, bundles.count())
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    names += ["url", "payload"] * with_payload
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()][: len(names)]
    out = [id_col, *names[1:]]

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                raw = read_file(path)
                at = 0
                for packed, _ in seek_table(raw).tolist():
                    data = zstandard.ZstdDecompressor().decompress(raw[at : at + packed])
                    at += packed
                    found, where = [], 0
                    while where < len(data):
                        fields, where = parse(data, where)
                        found.append(fields)
                    columns = [pa.array([f[k] for f in found], t) for k, t in zip(names, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, out)

    fields = [f"{id_col} long", "payload_bytes long", "payload_digest string", "record_type string", "refers_to long"]
    fields += ["url string", "payload binary"] * with_payload
    return bundles.select("path").repartition(min(n, 10_000)).mapInArrow(run, ", ".join(fields))


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            least_bytes: int = 0) -> DataFrame:
    """Write all rows to bundles in the shared folder and return what reading them back gives."""
    folder = work_dir(pages.sparkSession, "warc")
    return read_bundles(write_bundles(pages, folder, id_col, url_col, payload_col, least_bytes), id_col)
