"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent frames; a skippable frame at the end holds the seek table (compressed and plain size
and checksum of each frame, as in the public seekable format), and an index maps record ids to (file, frame, offset in the
frame, length). One record is read by decompressing one frame.

Writing: each task writes archives under names of its own in the shared folder and moves them there whole; the index is a
table written by the same job, and holds the files of tasks that were committed only. So a lost executor costs a repeated
task, and files without index rows are ignored.

Defined results: null html is an empty payload, a null url gets a urn. Of equal payloads of at least 100 bytes the smallest
page id is the response; rows that repeat that id with that payload are responses too; a null id never wins against an
id, and if all ids of a group are null, all are responses. Repeated rows repeat; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.llm.common import AtomicFile, apart, fresh_dir, table, text_slices
from motionloom.llm.common import file_system as _file_system

LEAST_REVISIT = 100
FRAME_BYTES, FILE_BYTES = 256 << 10, 128 << 20
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"


def record_id(page: int | None) -> str:
    return f"<urn:page:{page if page is not None else 'none'}>"


def page_of(record: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", record or "")
    return int(found[1]) if found else None


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False) -> bytes:
    """One WARC/1.1 record around an HTTP response; a revisit holds the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {quote(url, safe='%/:=&?~#+!$,;@()*[]') if url else 'urn:none'}", f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}"]
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, where the next record begins)."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    n = int(headers["Content-Length"])
    return headers, data[end + 4 : end + 4 + n], end + 4 + n + 4


class BundleWriter:
    """A seekable bundle; add() returns (frame, offset in the frame)."""

    def __init__(self, uri: str, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.file, self.frame_bytes = AtomicFile(uri), frame_bytes
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.entries: list[bytes] = []
        self.held: list[bytes] = []
        self.size = self.written = 0

    def add(self, data: bytes) -> tuple[int, int]:
        if self.held and self.size + len(data) > self.frame_bytes:
            self._frame()
        at = len(self.entries), self.size
        self.held.append(data)
        self.size += len(data)
        return at

    def _frame(self) -> None:
        plain = b"".join(self.held)
        packed = self.zstd.compress(plain)
        self.file.write(packed)
        self.entries.append(struct.pack("<III", len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.written += len(packed)
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.held:
            self._frame()
        body = b"".join(self.entries) + struct.pack("<IBI", len(self.entries), 0x80, SEEKABLE)
        self.file.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.file.close()


class BundleReader:
    def __init__(self, uri: str):
        fs, path = _file_system(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{uri} has no seek table")
        each = 12 if flags & 0x80 else 8
        raw = self.file.read_at(each * n, size - 9 - each * n)
        self.frames, at = [], 0
        for i in range(n):
            packed, plain, *check = struct.unpack_from("<III" if each == 12 else "<II", raw, each * i)
            self.frames.append((at, packed, plain, *check))
            at += packed
        self.zstd = zstandard.ZstdDecompressor()

    def frame(self, k: int) -> bytes:
        at, packed, plain, *check = self.frames[k]
        data = self.zstd.decompress(self.file.read_at(packed, at), max_output_size=plain)
        if check and xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check[0]:
            raise ValueError(f"frame {k} is damaged")
        return data


def with_types(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """id, url, html, record_type, refers_to. The smallest ids are a map-side aggregate; the join back splits a hot digest."""
    rows = pages.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{url_col}`").alias("url"), F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.when(F.octet_length("html") >= least, F.sha2("html", 256)))
    first = rows.where("digest IS NOT NULL").groupBy(F.col("digest").alias("d")).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = F.col("d").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return rows.join(first, apart(F.col("digest")) == apart(F.col("d")), "left").select("id", "url", "html", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to"))


INDEX = "page_id bigint, record_type string, refers_to bigint, file string, frame int, frame_offset bigint, length bigint"


def write(pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes rows of with_types() as archives in folder, and the index of all records as a table in folder/index; returns the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, uri, held = None, "", []

        def index() -> pa.RecordBatch:
            cols = list(zip(*held, strict=True)) or [[]] * 7
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in INDEX.split(", ")])

        for b in text_slices(batches, 8 << 20, "html"):
            for page, url, html, kind, refers in zip(*(b.column(c).to_pylist() for c in ("id", "url", "html", "record_type", "refers_to")), strict=True):
                if out is None:
                    uri = f"{folder}/part-{uuid.uuid4().hex}.warc.zst"
                    out = BundleWriter(uri, frame_bytes)
                data = record(page, url, (html or "").encode(), refers, kind == "revisit")
                held.append((page, kind, refers, uri, *out.add(data), len(data)))
                if out.written > file_bytes:
                    out.close()
                    out = None
                    yield index()
                    held = []
        if out is not None:
            out.close()
            yield index()

    pages.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def one_each(index: DataFrame) -> DataFrame:
    """The files of an index, a partition for each, so that as many tasks can read as there are files."""
    files = index.select("file").distinct()
    return files.repartitionByRange(max(1, files.count()), "file")


def read(files: DataFrame) -> DataFrame:
    """Archives (column file) -> one row per record: page_id, url, record_type, refers_to, payload_digest, payload_bytes,
    payload (null for revisits). The digest of a response is that of the payload as read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column("file").to_pylist():
                bundle = BundleReader(uri)
                for k in range(len(bundle.frames)):
                    data, at, rows = bundle.frame(k), 0, []
                    while at < len(data):
                        h, block, at = parse(data, at)
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        revisit = h["WARC-Type"] == "revisit"
                        if not revisit and len(payload) != size:
                            raise ValueError(f"a payload in {uri} is cut short")
                        rows.append((page_of(h["WARC-Record-ID"]), h["WARC-Target-URI"], h["WARC-Type"], page_of(h.get("WARC-Refers-To")), h["WARC-Payload-Digest"].removeprefix("sha256:") if revisit else hashlib.sha256(payload).hexdigest(), size, None if revisit else payload))
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()), strict=True)], names=["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"])

    return files.select("file").mapInArrow(run, "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary")


def read_record(file: str, frame: int, frame_offset: int) -> tuple[dict[str, str], bytes]:
    """One record by its index entry; only its frame is read."""
    headers, block, _ = parse(BundleReader(file).frame(frame), frame_offset)
    return headers, block


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write(with_types(table(spark, sf_dir, "pages")), fresh_dir(spark, "warc"))
    return read(one_each(index)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id <> first THEN first END AS refers_to
FROM d
"""
