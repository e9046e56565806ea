"""WARC bundles in seekable Zstandard.

Records are grouped into independent Zstandard frames; a bundle ends in a seek table, a
skippable frame with the sizes of all frames, which readers of the seekable format
understand. The index maps each record to (bundle, frame, offset in the frame), so one
record is read by decompressing one frame.

Of records with equal payloads the one with the largest page id holds the payload, others
are revisit records that refer to it. A task that fails leaves a bundle that no index row
names; only what the committed index names is read.

A null html is an empty payload, a null url a record without a target. A null page id is
smaller than any other. Rows equal in id and payload: one response, the others revisit it.
Pages of any size are whole records; a frame grows with the record it holds.

Bundles are written and read with Arrow's file systems, so the shared folder may be any
store these know. Binary writers in Spark take one file a row, hence not these.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import urllib.parse
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, parts, stored
from tidemark.session import shared_dir

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
LEVEL = 3
#: Payloads of fewer bytes are always written in full.
LEAST_REVISIT = 0
DATE = "2000-01-01T00:00:00Z"

#: The seekable format's numbers.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<II")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = ("page_id bigint, record_id string, bundle string, frame int, offset bigint, "
         "length bigint")
PAGE = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str, nth: int) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{nth}')}"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, nth: int,
           refers_to: int | None = None, revisit: bool = False) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP head of its payload but not the payload."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    body = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <{record_id(page_id, digest, nth)}>", f"WARC-Date: {DATE}"]
    if url is not None:
        safe = urllib.parse.quote(url, safe="%/:?#[]@!$&'()*+,;=~-._")
        head.append(f"WARC-Target-URI: {safe}")
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}",
                 f"WARC-Refers-To: <{record_id(refers_to, digest, 0)}>"]
        if refers_to is not None:
            head.append(f"WARC-Refers-To-Page-ID: {refers_to}")
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes, offset: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at ``offset``, and where the next one begins."""
    end = data.index(b"\r\n\r\n", offset)
    lines = data[offset:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record at {offset}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    start = end + 4
    stop = start + int(headers["Content-Length"])
    return headers, data[start:stop], stop + 4


class BundleWriter:
    """Collects records into frames, and frames into a file that ends in a seek table."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.path = path
        self.out = store.open_output_stream(path, compression=None)
        self.compress = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress
        self.frames: list[tuple[int, int]] = []
        self.held: list[bytes] = []
        self.size = self.written = 0

    def add(self, data: bytes) -> tuple[int, int, int]:
        """(frame, offset in the frame, length) of the record."""
        if self.held and self.size + len(data) > FRAME_BYTES:
            self.end_frame()
        place = (len(self.frames), self.size, len(data))
        self.held.append(data)
        self.size += len(data)
        return place

    def end_frame(self) -> None:
        if self.held:
            frame = self.compress(b"".join(self.held))
            self.out.write(frame)
            self.frames.append((len(frame), self.size))
            self.written += len(frame)
            self.held, self.size = [], 0

    def close(self) -> None:
        self.end_frame()
        table = b"".join(ENTRY.pack(*f) for f in self.frames)
        table += FOOTER.pack(len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()


class BundleReader:
    """Frames of one bundle, found by its seek table."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.file = store.open_input_file(path)
        size = self.file.size()
        n, _, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{path} has no seek table")
        table = self.file.read_at(n * ENTRY.size, size - FOOTER.size - n * ENTRY.size)
        self.places, at = [], 0
        for k in range(n):
            packed, plain = ENTRY.unpack_from(table, k * ENTRY.size)
            self.places.append((at, packed, plain))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, plain = self.places[number]
        return zstandard.ZstdDecompressor().decompress(
            self.file.read_at(packed, at), max_output_size=plain)

    def record(self, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
        headers, block, _ = parse(self.frame(frame), offset)
        return headers, block


def page_of(headers: dict[str, str], block: bytes) -> tuple:
    """A page's row from its record; a payload that does not have its digest is an error."""
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"damaged payload in {headers['WARC-Record-ID']}")
    page, refers = headers.get("WARC-Page-ID"), headers.get("WARC-Refers-To-Page-ID")
    return (int(page) if page else None, size, digest, kind, int(refers) if refers else None)


def write_bundles(pages: DataFrame, folder: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Write all pages to bundles under ``folder``; returns the committed index."""
    width = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    page = F.col("page_id").cast("bigint")
    rows = pages.select(page.alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"), F.sha1(html).alias("sha"),
                        F.xxhash64(page).alias("own"))
    # Narrow rows settle which page holds a payload; the pages themselves move once.
    groups = (rows.filter(F.octet_length("html") >= least).groupBy("sha")
              .agg(F.max("page_id").alias("head"), F.count("*").alias("n")).filter("n > 1"))
    revisits = rows.select("own", "sha").distinct().join(groups, "sha").select(
        "own", "sha", "head")
    dealt = (rows.repartition(width, "own", "sha").join(
        revisits.withColumn("again", F.lit(True)), ["own", "sha"], "left")
        .select("page_id", "url", "html", "sha", "own", "head", "again")
        .repartition(width, "own", "sha")
        .sortWithinPartitions("own", "sha", "url"))

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        writer, index, before, nth = None, [], None, 0

        def finish():
            writer.close()
            columns = list(zip(*index))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (
                    pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()))],
                names=[c.split()[0] for c in INDEX.split(", ")])
        for batch in batches:
            for part in parts(batch, "html"):
                for page_id, url, html, sha, head, again in zip(
                        *(part.column(c).to_pylist()
                          for c in ("page_id", "url", "html", "sha", "head", "again"))):
                    payload = html.encode()
                    nth = nth + 1 if before == (page_id, sha) else 0
                    before = (page_id, sha)
                    revisit = bool(again) and (page_id != head or nth > 0)
                    if writer is None:
                        name = f"{root}/pages-{uuid.uuid4().hex}.warc.zst"
                        writer, index = BundleWriter(store, name), []
                    digest = payload_digest(payload)
                    place = writer.add(record(page_id, url, payload, digest, nth, head, revisit))
                    index.append((page_id, record_id(page_id, digest, nth), writer.path, *place))
                    if writer.written >= BUNDLE_BYTES:
                        yield finish()
                        writer = None
        if writer is not None:
            yield finish()
    return stored(map_batches(dealt, run, INDEX), "index")


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """Every page of the bundles that an index names, read frame by frame."""
    width = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frames = index.select("bundle", "frame").distinct().repartition(
        width, "bundle", "frame").sortWithinPartitions("bundle", "frame")

    def run(batches):
        store, _ = fs.FileSystem.from_uri(folder)
        reader, path = None, None
        for batch in batches:
            for name, frame in zip(batch.column("bundle").to_pylist(),
                                   batch.column("frame").to_pylist()):
                if name != path:
                    reader, path = BundleReader(store, name), name
                data, at, rows = reader.frame(frame), 0, []
                while at < len(data):
                    headers, block, at = parse(data, at)
                    rows.append(page_of(headers, block))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                    names=[c.split()[0] for c in PAGE.split(", ")])
    return map_batches(frames, run, PAGE)


def fetch(index: DataFrame, folder: str) -> DataFrame:
    """``page_id``, ``record_id`` and ``block`` of the records that an index names, each by its
    frame and offset."""
    def run(batches):
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                _, block = BundleReader(store, row["bundle"]).record(row["frame"], row["offset"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["page_id"]], pa.int64()),
                     pa.array([row["record_id"]], pa.string()), pa.array([block], pa.binary())],
                    names=["page_id", "record_id", "block"])
    return map_batches(index, run, "page_id bigint, record_id string, block binary")


def archive(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Write pages to bundles in the shared folder and read them back."""
    folder = shared_dir(pages.sparkSession, "warc")
    return read_bundles(write_bundles(pages, folder, least), folder)


ORACLE = """
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS html, url FROM pages),
groups AS (SELECT html, max(page_id) AS head, count(*) AS n FROM rows GROUP BY html),
placed AS (
  SELECT r.page_id, strlen(r.html) AS payload_bytes, sha1(r.html) AS sha, g.n > 1 AND (
           r.page_id IS DISTINCT FROM g.head OR row_number() OVER (
             PARTITION BY r.html, r.page_id ORDER BY r.url) > 1) AS again, g.head
  FROM rows r JOIN groups g ON r.html = g.html),
digits AS (
  SELECT *, list_transform(range(8), lambda i: ('0x' || substr(sha, CAST(i * 5 + 1 AS INT), 5))::BIGINT)
           AS quarters FROM placed)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((quarters[i // 4 + 1] >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1 AS INT), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN head END AS refers_to
FROM digits
"""
