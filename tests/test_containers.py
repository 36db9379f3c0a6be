"""Video headers from files that are built here."""

import struct

import pytest
from pyspark.sql import functions as F

from motionloom.sources import containers as C


def box(kind, *content, wide=False):
    body = b"".join(content)
    return struct.pack(">I4sQ", 1, kind, 16 + len(body)) + body if wide else struct.pack(">I4s", 8 + len(body), kind) + body


def track(handler, kind, width, height, scale, runs, record=b"", version=0):
    length = sum(n * d for n, d in runs)
    head = struct.pack(">B3xQQIQ4x", 1, 0, 0, scale, length) if version else struct.pack(">B3xIIII4x", 0, 0, 0, scale, length)
    entry = box(kind, b"\0" * 24, struct.pack(">HH", width, height), b"\0" * 50, record)
    tables = box(b"stbl", box(b"stsd", struct.pack(">II", 0, 1), entry), box(b"stts", struct.pack(">II", 0, len(runs)), *[struct.pack(">II", n, d) for n, d in runs]))
    return box(b"trak", box(b"mdia", box(b"mdhd", head), box(b"hdlr", b"\0" * 8, handler, b"\0" * 13), box(b"minf", tables)))


def avc(profile, *rest):
    return box(b"avcC", bytes([1, profile, 0, 30, 0xFF, 0xE1]), struct.pack(">H", 4), b"spsx", b"\1", struct.pack(">H", 2), b"pp", *rest)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    top = tmp_path_factory.mktemp("videos")
    sound = track(b"soun", b"mp4a", 0, 0, 48_000, [(10, 1024)])
    made = {
        "a/one.mp4": box(b"ftyp", b"isom") + box(b"mdat", b"x" * 5000, wide=True) + box(b"moov", sound, track(b"vide", b"avc1", 640, 480, 10_240, [(50, 1024)], avc(77))),
        "a/b/c/d/two.mp4": box(b"moov", track(b"vide", b"avc1", 1920, 1080, 90_000, [(29, 3000), (1, 6000)], avc(122, bytes([0xFE, 0xFA, 0xF8, 0])), version=1)) + box(b"mdat", b"y"),
        "hevc.mp4": box(b"moov", track(b"vide", b"hvc1", 64, 32, 30, [(3, 1)])),
        "high.mp4": box(b"moov", track(b"vide", b"avc1", 8, 8, 30, [(3, 1)], avc(100))),
        "sound.mp4": box(b"moov", sound),
        "empty.mp4": b"",
        "torn.mp4": box(b"moov", track(b"vide", b"avc1", 64, 32, 30, [(3, 1)]))[:-40],
        "other.txt": b"no video",
    }
    for name, data in made.items():
        (top / name).parent.mkdir(parents=True, exist_ok=True)
        (top / name).write_bytes(data)
    return f"file://{top}"


def test_probe(spark, files):
    listed = C.list_videos(spark, files)
    got = {r.path.rsplit("/", 1)[1][:-4]: r for r in C.probed(listed).collect()}
    assert set(got) == {"one", "two", "hevc", "high", "sound", "torn"}
    plain = lambda r: (r.codec, r.pix_fmt, r.width, r.height, r.samples, r.reason)
    assert plain(got["one"]) == ("h264", "yuv420p", 640, 480, 50, None) and got["one"].fps == pytest.approx(10) and got["one"].duration_s == pytest.approx(5)
    assert plain(got["two"]) == ("h264", "yuv422p10le", 1920, 1080, 30, None) and got["two"].fps == pytest.approx(30 * 90_000 / 93_000)
    assert plain(got["hevc"]) == ("hevc", None, 64, 32, 3, None) and plain(got["high"])[1] == "yuv420p"
    assert got["sound"].reason == "no video track" and "cut off" in got["torn"].reason
    assert C.probed(listed.where("false")).count() == 0


def test_budget_opens_so_many_files(spark, files):
    listed = C.list_videos(spark, files)
    chosen = C.budgeted(listed, 3, F.col("path")).where("chosen")
    assert [r.path for r in chosen.orderBy("path").collect()] == sorted(r.path for r in listed.collect())[:3] and C.probed(chosen).count() == 3
    assert C.budgeted(listed, -1).where("chosen").count() == 6 and C.budgeted(listed, 0, F.col("path")).where("chosen").count() == 0


def test_issues(spark):
    rows = [(1, "d", "ego", True, 50, "h264", "yuv420p", 5.0, None, 30.0), (2, "d", "ego", False, 50, None, None, None, None, None), (3, "d", "ego", True, 50, None, None, None, "torn", None), (4, "d", "ego", True, 50, "hevc", None, 5.6, None, 19.0), (5, None, "ego", True, 50, "h264", "yuv422p", float("nan"), None, float("nan"))]
    df = spark.createDataFrame(rows, "episode_index bigint, source_date string, video_key string, present boolean, length bigint, codec string, pix_fmt string, duration_s double, reason string, sharpness double")
    got = sorted((r.episode_index, r.code, r.severity) for r in C.video_issues(df, 10.0).collect())
    assert got == [(2, "missing_video", "error"), (3, "probe_failed", "error"), (4, "browser_unsafe_codec", "warning"), (4, "duration_mismatch", "warning"), (4, "low_sharpness", "warning"), (5, "browser_unsafe_codec", "warning")]
