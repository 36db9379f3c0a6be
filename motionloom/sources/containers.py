"""What the headers of video files say, without a decoder: MP4 and MOV containers, read box by box.

Files are listed first, by name and size. A budget then picks files in one order over the whole listing, and only those are opened;
of an opened file only box headers and the small boxes of its first video track are read, by seeking, never the samples."""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.operators.ranks import in_order
from motionloom.operators.rules import Rule, issues

PROBED = "codec string, pix_fmt string, width int, height int, fps double, duration_s double, samples bigint, reason string"
# Sample entries by codec, the only layout that browsers are sure to show, the least sharpness.
CODECS = {b"avc1": "h264", b"avc3": "h264", b"hvc1": "hevc", b"hev1": "hevc", b"av01": "av1", b"vp09": "vp9", b"mp4v": "mpeg4"}
SAFE_CODEC, SAFE_PIX_FMT = "h264", "yuv420p"
LEAST_SHARPNESS = 20.0
_PARENTS = {b"moov", b"trak", b"mdia", b"minf", b"stbl"}
_MOST_BOX = 16 << 20


def boxes(file, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(kind, first byte, past the last) of the content of each box from where file stands to end; a torn box raises."""
    at = file.tell()
    while at + 8 <= end:
        file.seek(at)
        size, kind = struct.unpack(">I4s", file.read(8))
        head = 8
        if size == 1:
            size, head = struct.unpack(">Q", file.read(8))[0], 16
        size = size or end - at
        if size < head or at + size > end:
            raise ValueError(f"box {kind!r} is cut off")
        yield kind, at + head, at + size
        at += size


def _inner(file, start: int, end: int, into: dict) -> dict:
    """The bytes of the boxes below, by kind; of a kind that comes again the first counts, but every track is a dict of its own."""
    file.seek(start)
    for kind, a, b in list(boxes(file, end)):
        if kind == b"trak":
            into.setdefault("tracks", []).append(_inner(file, a, b, {}))
        elif kind in _PARENTS:
            _inner(file, a, b, into)
        elif kind in (b"hdlr", b"mdhd", b"stsd", b"stts", b"stsz") and kind not in into:
            file.seek(a)
            into[kind] = file.read(min(b - a, 20 if kind == b"stsz" else _MOST_BOX))
    return into


def probe(file, size: int) -> dict:
    """codec, pix_fmt, width, height, fps, duration_s, samples of the first video track; reason where there is none."""
    file.seek(0)
    track = next((t for t in _inner(file, 0, size, {}).get("tracks", []) if t.get(b"hdlr", b"")[8:12] == b"vide"), None)
    if track is None:
        return {"reason": "no video track"}
    wide = track[b"mdhd"][0] == 1
    scale, length = struct.unpack(">IQ" if wide else ">II", track[b"mdhd"][20:32] if wide else track[b"mdhd"][12:20])
    entry = track[b"stsd"][8:]
    kind = entry[4:8]
    width, height = struct.unpack(">HH", entry[32:36])
    runs = struct.iter_unpack(">II", track[b"stts"][8 : 8 + 8 * struct.unpack(">I", track[b"stts"][4:8])[0]])
    samples, ticks = map(sum, zip(*((n, n * d) for n, d in runs), strict=True)) if len(track[b"stts"]) > 8 else (0, 0)
    return {"codec": CODECS.get(kind, kind.decode("latin1")), "pix_fmt": _pix_fmt(kind, entry), "width": width, "height": height, "fps": samples * scale / ticks if ticks else None, "duration_s": length / scale if scale else None, "samples": samples}


def _pix_fmt(kind: bytes, entry: bytes) -> str | None:
    """Of H.264 alone: its base profiles have 4:2:0 and 8 bits only, the high ones say so in their record."""
    at = entry.find(b"avcC")
    if kind not in (b"avc1", b"avc3") or at < 0:
        return None
    record = entry[at + 4 :]
    if record[1] in (66, 77, 88):
        return "yuv420p"
    file = io.BytesIO(record[5:])
    for mask in (0x1F, 0xFF):  # the two lists of parameter sets
        for _ in range((file.read(1) or b"\0")[0] & mask):
            file.seek(struct.unpack(">H", file.read(2))[0], 1)
    rest = file.read(3)
    if len(rest) < 3:
        return "yuv420p" if record[1] == 100 else None
    chroma, bits = {0: "gray", 1: "yuv420p", 2: "yuv422p", 3: "yuv444p"}[rest[0] & 3], 8 + (rest[1] & 7)
    return chroma if bits == 8 else f"{chroma}{bits}le"


def list_videos(spark: SparkSession, root: str, pattern: str = "*.mp4") -> DataFrame:
    """path, size, modified of the files below root, at any depth. No file is opened. Spark lists no empty files: they count as missing."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def budgeted(listed: DataFrame, budget: int, *order: Column) -> DataFrame:
    """listed with chosen: the first `budget` rows in order over all of them, by range totals; a negative budget takes all."""
    if budget < 0:
        return listed.withColumn("chosen", F.lit(True))
    return in_order(listed, *order, number="__number").withColumn("chosen", F.col("__number") < budget).drop("__number")


def probed(listed: DataFrame) -> DataFrame:
    """path and the probe's columns of every listed file; reason says why one has none. Files are opened where the task runs, through
    the file system of their URI."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        names = [c.split()[0] for c in PROBED.split(", ")]
        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                try:
                    where, name = (fs.LocalFileSystem(), "/" + path[5:].lstrip("/")) if path.startswith("file:") else fs.FileSystem.from_uri(path)
                    with where.open_input_file(name) as file:
                        found = probe(file, file.size())
                except Exception as e:  # whatever a broken file does, it is a row with a reason
                    found = {"reason": f"{type(e).__name__}: {e}"[:200]}
                rows.append([path, *[found.get(n) for n in names]])
            yield pd.DataFrame(rows, columns=["path", *names]).astype({"width": "Int32", "height": "Int32", "samples": "Int64", "fps": float, "duration_s": float})

    return listed.select("path").mapInPandas(run, f"path string, {PROBED}")


def video_issues(videos: DataFrame, fps: float, tolerance: float = 0.5, episode: str = "episode_index", date: str = "source_date") -> DataFrame:
    """Issues of videos, one row per episode and camera: columns present (whether the file is there), length (frames of the episode),
    codec, pix_fmt, duration_s, reason and sharpness (mean variance of the Laplacian; null where it wasn't measured)."""
    there = F.coalesce("present", F.lit(False))
    known = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c))
    wanted = F.col("length") / F.lit(float(fps))
    return issues(videos, [
        Rule("missing_video", "error", ~there, "video_key"),
        Rule("probe_failed", "error", there & F.col("reason").isNotNull(), "video_key"),
        Rule("browser_unsafe_codec", "warning", there & F.col("reason").isNull() & ~(F.col("codec").eqNullSafe(SAFE_CODEC) & F.col("pix_fmt").eqNullSafe(SAFE_PIX_FMT)), "codec"),
        Rule("duration_mismatch", "warning", there & known("duration_s") & (F.abs(F.col("duration_s") - wanted) > tolerance), "duration_s", F.col("duration_s") - wanted),
        Rule("low_sharpness", "warning", there & known("sharpness") & (F.col("sharpness") < LEAST_SHARPNESS), "sharpness", F.col("sharpness")),
    ], episode, date)
