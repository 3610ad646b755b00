"""Hand-derived cases and properties of the tracking operators."""

import hashlib
import json
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framewright import schemas
from framewright.config import DetectConfig, WindowConfig
from framewright.functions import exprs as X
from framewright.operators import decide, geometry, ingest, normalize, report, series, shard, windows
from framewright.sources import external, files
from framewright.streaming import segments as stream

quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


# ---------------------------------------------------------------- expressions


@pytest.mark.parametrize("value,expected", [(2.5, 2), (3.5, 4), (5.0, 4), (709.5, 710)])
def test_even_floor(spark, value, expected):
    assert one(spark, X.even_floor(F.lit(value))) == expected


@pytest.mark.parametrize(
    "cx,cy,side,w,h,expected",
    [
        (960, 540, 400, 1920, 1080, (760, 340, 400, None)),
        (100, 100, 400, 1920, 1080, (0, 0, 400, None)),
        (960, 540, 2000, 1920, 1080, (420, 0, 1080, "shrunk_to_frame")),
        (960, 540, 1080, 1920, 1080, (420, 0, 1080, None)),
        (960, 540, 100, 1920, 1080, (910, 490, 100, "below_min_crop_px")),
        (50, 50, 200, 100, 100, (0, 0, 100, "shrunk_below_min_crop_px")),
    ],
)
def test_clamp_box(spark, cx, cy, side, w, h, expected):
    box = one(spark, X.clamp_box(F.lit(float(cx)), F.lit(float(cy)), F.lit(float(side)), F.lit(w), F.lit(h), 128))
    assert tuple(box) == expected


@pytest.mark.parametrize("n", [1, 2, 30, 100, 1000003])
def test_stable_bucket(spark, n):
    keys = [f"k{i}" for i in range(50)] + ["", "é"]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select("k", X.stable_bucket("k", n).alias("b")).collect()
    assert {r.k: r.b for r in rows} == {k: int(hashlib.md5(k.encode()).hexdigest(), 16) % n for k in keys}


@pytest.mark.parametrize("text,expected", [("25/1", 25.0), ("30000/1001", 30000 / 1001), ("0/0", None), ("bad", None), ("1/2/3", None), (None, None), ("5/x", None)])
def test_rate(spark, text, expected):
    assert one(spark, X.rate(F.lit(text).cast("string"))) == expected


def test_vfr_edges(spark):
    got = [one(spark, X.is_vfr(F.lit(a).cast("double"), F.lit(r).cast("double"))) for a, r in [(25.0, 25.25), (25.0, 25.26), (0.0, 25.0), (None, 25.0), (25.0, None)]]
    assert got == [False, True, True, True, True]


@pytest.mark.parametrize(
    "name,expected",
    [
        ("abcdefghijk.mp4", "abcdefghijk"), ("x abcdefghij_.mkv", "abcdefghij_"), ("[dQw4w9WgXcQ] t.webm", "dQw4w9WgXcQ"),
        ("-V-tqJyxp_8.mp4", "-V-tqJyxp_8"), ("my-video_abcdefghijk.mp4", None), ("short.mp4", None),
    ],
)
def test_video_id(spark, name, expected):
    assert one(spark, X.video_id(F.lit(name))) == expected


@pytest.mark.parametrize("path,suffix,stem", [("/a/b.MP4", ".mp4", "b"), ("/a/b.mp4.part", ".part", "b.mp4"), ("/a/b", "", "b"), ("/a/.hid", "", ".hid")])
def test_paths(spark, path, suffix, stem):
    assert one(spark, X.suffix(F.lit(path))) == suffix
    assert one(spark, X.stem(F.lit(path))) == stem


@pytest.mark.parametrize("size", [0, 10, 16384, 20000, 32768, 32769, 50000])
def test_fingerprint(spark, size):
    raw = bytes(i * 7 % 251 for i in range(size))
    whole = raw[:16384] + (raw[-16384:] if size > 32768 else b"") + str(size).encode()
    assert one(spark, X.fingerprint(F.lit(raw), F.lit(size))) == hashlib.md5(whole).hexdigest()[:16]


def test_param_hash_ignores_runtime_settings():
    assert DetectConfig().param_hash() == DetectConfig(workers=1, overwrite=True).param_hash() != DetectConfig(frame_stride=2).param_hash()


# ---------------------------------------------------------------- series


def _track(spark, frames, values=None):
    values = values or [float(f) for f in frames]
    return spark.createDataFrame([("v", f, x) for f, x in zip(frames, values)], "video_id string, frame_idx int, cx double")


@pytest.mark.parametrize(
    "frames,stride,expected",
    [
        ([0, 16], 4, [(0, 19, 1, 12)]),
        ([0, 20], 4, [(0, 3, 0, 0), (20, 23, 0, 0)]),
        ([0, 16], 1, [(0, 16, 1, 15)]),
        ([0, 17], 1, [(0, 0, 0, 0), (17, 17, 0, 0)]),
        ([5], 4, [(5, 8, 0, 0)]),
    ],
)
def test_sessions(spark, frames, stride, expected):
    out = series.segments(series.sessionize(_track(spark, frames), stride, 15), stride).orderBy("seg_index").collect()
    assert [(r.start_frame, r.end_frame, r.n_bridged_gaps, r.max_gap_frames) for r in out] == expected


def test_no_detections(spark):
    assert series.segments(series.sessionize(_track(spark, []), 4, 15), 4).count() == 0


@quick
@given(st.sets(st.integers(0, 120), min_size=1, max_size=40), st.sampled_from([1, 4, 6]), st.sampled_from([0, 3, 15]))
def test_sessions_match_a_frame_walk(spark, frames, stride, tolerance):
    covered = sorted({g for f in frames for g in range(f, f + stride)})
    walked, start, last = [], covered[0], covered[0]
    for g in covered[1:]:
        if g - last - 1 > tolerance:
            walked.append((start, last))
            start = g
        last = g
    walked.append((start, last))
    out = series.segments(series.sessionize(_track(spark, sorted(frames)), stride, tolerance), stride).orderBy("seg_index").collect()
    # overlapping samples cannot occur on a stride grid; off-grid ones only move inner gaps
    assert [(r.start_frame, r.end_frame) for r in out] == walked


def test_densify(spark):
    rows = series.sessionize(_track(spark, [10, 14], [0.0, 4.0]), 4, 15)
    out = series.densify(rows, ["cx"], 4).orderBy("frame_idx").collect()
    assert [(r.frame_idx, r.cx) for r in out] == list(zip(range(10, 18), [0, 1, 2, 3, 4, 4, 4, 4]))


def _smoothed(x, span):
    if span <= 1:
        return x
    span += span % 2 == 0
    return np.convolve(np.pad(x, span // 2, mode="edge"), np.ones(span) / span, mode="valid")


@quick
@given(st.lists(st.floats(-100, 100), min_size=1, max_size=60), st.sampled_from([2, 3, 7, 25]))
def test_moving_average(spark, values, span):
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "k string, i int, v double")
    got = [r.v for r in series.moving_average(df, ["k"], "i", ["v"], span).orderBy("i").collect()]
    expected = _smoothed(np.array(values), min(span, max(3, len(values))))
    assert np.allclose(got, expected, atol=1e-9)
    fixed = [r.v for r in series.moving_average(df, ["k"], "i", ["v"], span, None).orderBy("i").collect()]
    assert np.allclose(fixed, _smoothed(np.array(values), span), atol=1e-9)


# ---------------------------------------------------------------- frames


def _kpt(**conf):
    out = [[50.0, 30.0, 0.0] for _ in range(17)]
    for k, c in conf.items():
        out[int(k[1:])][2] = c
    return [tuple(p) for p in out]


GOOD = {"k0": 0.9, "k5": 0.9, "k9": 0.9}


def _box(height=60.0, width=20.0, conf=0.9, kpt=None):
    return (40.0, 0.0, 40.0 + width, float(height), conf, kpt if kpt is not None else _kpt(**GOOD))


@pytest.mark.parametrize(
    "boxes,reason",
    [
        ([], "no_detection"),
        (None, "no_detection"),
        ([_box(conf=0.29)], "low_conf"),
        ([_box(conf=0.30)], "ok"),
        ([_box(height=44.9)], "no_prominent"),
        ([_box(height=45.0)], "ok"),
        ([_box(), _box()], "multi_prominent"),
        ([_box(60, 20), _box(40, 19)], "not_dominant"),
        ([_box(64, 20), _box(40, 20)], "ok"),
        ([_box(kpt=_kpt(k1=0.9, k5=0.9, k9=0.9))], "no_face_or_shoulder"),
        ([_box(kpt=_kpt(k1=0.9, k2=0.5, k5=0.5, k9=0.9))], "ok"),
        ([_box(kpt=_kpt(k0=0.9, k5=0.9))], "no_wrist"),
        ([_box(kpt=[(1.0, 1.0, p[2]) for p in _kpt(**GOOD)])], "hand_cropped"),
        ([_box(kpt=_kpt(**GOOD, k13=0.5, k16=0.5))], "full_body"),
        ([_box(kpt=_kpt(**GOOD, k13=0.5))], "ok"),
    ],
)
def test_frame_reasons(spark, boxes, reason):
    df = spark.createDataFrame([("v", 0, 100, 100, boxes)], schemas.FRAME_DETECTIONS)
    row = decide.decide_frames(df).first()
    assert row.reason == reason
    assert (row.kpt is not None) == (reason == "ok")


# ---------------------------------------------------------------- windows


def _window_rows(n, **change):
    base = {"cx": 500.0, "cy": 300.0, "h": 100.0, "ls_x": 450.0, "ls_y": 300.0, "ls_c": 0.9, "rs_x": 550.0, "rs_y": 300.0, "rs_c": 0.9}
    base |= {"lw_x": 420.0, "lw_y": 340.0, "lw_c": 0.9, "rw_x": 580.0, "rw_y": 340.0, "rw_c": 0.9, "nose_x": 500.0, "nose_y": 240.0, "nose_c": 0.9}
    return [("s", i, i) + tuple({**base, **change}.values()) for i in range(n)], list(base)


@pytest.mark.parametrize(
    "change,n,reason",
    [
        ({}, 100, "ok"),
        ({}, 50, "ok"),
        ({}, 49, "shoulders_not_visible"),
        ({"ls_c": 0.39}, 100, "shoulders_not_visible"),
        ({"ls_c": 0.40}, 100, "shoulders_not_visible"),
        ({"ls_c": 0.41}, 100, "ok"),
        ({"ls_y": 330.0}, 100, "tilted_presenter"),
        ({"lw_c": 0.1, "rw_c": 0.3}, 100, "hands_not_visible_enough"),
        ({"h": 10.0, "lw_x": 500.0, "lw_y": 300.0, "rw_x": 500.0, "rw_y": 300.0}, 100, "below_min_crop_px"),
        ({"lw_x": -900.0}, 100, "wrist_clipped_boundary"),
        ({"nose_y": 270.0}, 100, "face_too_small_for_lipsync"),
        ({"nose_y": 100.0}, 100, "inconsistent_headroom"),
        ({"ls_y": float("nan")}, 100, "face_too_small_for_lipsync"),
    ],
)
def test_window_reasons(spark, change, n, reason):
    rows, names = _window_rows(n, **change)
    det = spark.createDataFrame(rows, "segment_uid string, i int, frame_idx int, " + ", ".join(f"{c} double" for c in names))
    seg = spark.createDataFrame([("s", 0, 100, 1920, 1080)], "segment_uid string, start_frame int, n_frames int, width int, height int")
    cfg = WindowConfig(headroom_max=260.0)
    got = windows.gate_windows(seg, det, cfg).collect()
    if change.get("ls_y") is not None and math.isnan(change["ls_y"]):
        assert len(got) == 1 and got[0].drop_reason != "tilted_presenter"  # NaN passes "greater than" gates
    else:
        assert [r.drop_reason for r in got] == [reason]


def test_windows_without_detections_are_judged(spark):
    rows, names = _window_rows(100)
    det = spark.createDataFrame(rows, "segment_uid string, i int, frame_idx int, " + ", ".join(f"{c} double" for c in names))
    seg = spark.createDataFrame([("s", 0, 400, 1920, 1080), ("short", 0, 99, 1920, 1080)], "segment_uid string, start_frame int, n_frames int, width int, height int")
    got = windows.gate_windows(seg, det, WindowConfig(headroom_max=260.0)).orderBy("window_uid").collect()
    assert [(r.window_uid, r.kept) for r in got] == [("s_w0000", True), ("s_w0001", False), ("s_w0002", False), ("s_w0003", False)]
    none = windows.gate_windows(seg.where("false"), det)
    manifest = windows.render_manifest(none.withColumns({"video_id": F.lit("v"), "path": F.lit("p"), "fps": F.lit(25.0)}))
    assert manifest.count() == 0 and len(manifest.columns) == 12


def test_segment_join_explodes_tracks(spark):
    man = spark.createDataFrame([("s", "ok", 0, [0, 4], [1.0, 2.0], [1.0, 2.0], [9.0, 9.0], 10, 10)], "segment_uid string, status string, start_frame int, track_frames array<int>, track_cx array<double>, track_cy array<double>, track_h array<double>, width int, height int")
    flat = [float(i) for i in range(34)]
    kpt = spark.createDataFrame([("s", 2, flat, flat, flat)], "segment_uid string, n_detections int, kpt_x array<double>, kpt_y array<double>, kpt_conf array<double>")
    got = windows.segment_detections(man, kpt).orderBy("i").collect()
    assert [(r.frame_idx, r.cx, r.nose_x, r.lw_x) for r in got] == [(0, 1.0, 0.0, 9.0), (4, 2.0, 17.0, 26.0)]


# ---------------------------------------------------------------- ingest, normalise, shards, reports


def test_triage_precedence(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "video_id string")
    got = ingest.triage(ids("a", "b", "c", "d", "a", None), ids("a", "a"), ids("a", "b"), ids("a", "b", "c")).collect()
    assert sorted((str(r.video_id), r.outcome) for r in got) == [("None", "queued"), ("a", "existing"), ("a", "existing"), ("b", "archived"), ("c", "low_quality"), ("d", "queued")]


@pytest.mark.parametrize(
    "formats,chosen,best",
    [
        ([("h", 1080), ("h", 720)], 1080, "1080p"), ([("h", 720)], 720, "720p"), ([("h", 2160), ("h", 1440)], 1440, "2160p"), ([("h", 480)], None, "480p"),
        ([("none", 1080)], None, "none"), ([(None, 720)], 720, "720p"), ([("h", None)], None, "none"), ([], None, "none"),
    ],
)
def test_ladder(spark, formats, chosen, best):
    row = ingest.resolution_ladder(spark.createDataFrame([("v", formats)], schemas.MEDIA_INFO)).first()
    assert (row.chosen_height, row.best_available_resolution) == (chosen, best)


def test_probe_flattening(spark):
    video = {"codec_type": "video", "codec_name": "h264", "width": 640, "height": 360, "avg_frame_rate": "0/0", "r_frame_rate": "25/1"}
    docs = [
        {"streams": [video, {**video, "avg_frame_rate": "25/1", "width": 1280}, {"codec_type": "audio", "duration": "2.0"}], "format": {"duration": "2.5"}},
        {"streams": [{"codec_type": "audio"}]},
        {},
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(3, "{broken"), (4, None)], "id int, json string")
    got = normalize.flatten_probe(df).orderBy("id").collect()
    assert [(r.width, r.avg_fps, r.has_audio, r.duration, r.readable) for r in got[:2]] == [(1280, 25.0, True, 2.5, True), (None, None, True, None, False)]
    assert not any(r.readable for r in got[1:])
    assert normalize.flatten_probe(df, retry_streams=False).where("id = 0").first().width == 640


@pytest.mark.parametrize("delta,ok", [(0.079, True), (0.081, False), (None, True)])
def test_duration_check(spark, delta, ok):
    schema = "video_id string, avg_fps double, width int, height int, v_duration double, a_duration double, duration double, has_audio boolean"
    s = spark.createDataFrame([("v", 30.0, 8, 8, 10.0, None, None, False)], schema)
    d = spark.createDataFrame([("v", 25.0, 8, 8, 99.0, None, None if delta is None else 10.0 + delta, False)], schema)
    row = normalize.verify(s, d).first()
    assert (row.duration_ok, row.verified) == (ok, ok)


def test_verify_uses_containers_and_streams_as_named(spark):
    schema = "video_id string, avg_fps double, width int, height int, v_duration double, a_duration double, duration double, has_audio boolean"
    s = spark.createDataFrame([(v, 30.0, 8, 8, 10.0, 10.0, 12.0, True) for v in "abcd"], schema)
    d = spark.createDataFrame([("a", 25.0, 8, 8, 12.0, 12.0, 10.0, True), ("b", 25.0, 8, 8, 10.0, 10.0, 12.0, True), ("c", 25.0, 8, 8, None, 11.0, 10.0, True), ("d", 25.01, 8, 8, 10.0, 10.2, 10.0, True)], schema)
    got = {r.video_id: (r.duration_ok, r.av_ok, r.fps_ok, r.verified) for r in normalize.verify(s, d).collect()}
    assert got["a"] == (True, True, True, True) and got["b"] == (False, True, True, False) and got["c"] == (True, True, True, True) and got["d"][1] is False


def test_zero_rates_and_widths_are_not_readable(spark):
    docs = [{"streams": [{"codec_type": "video", "width": w, "height": 4, "avg_frame_rate": r, "r_frame_rate": "25/1"}]} for w, r in ((0, "25/1"), (8, "0/1"), (8, "25/1"))]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, json string")
    assert [r.readable for r in normalize.flatten_probe(df).orderBy("id").collect()] == [False, False, True]


def test_not_a_number_is_below_every_limit(spark):
    nan = float("nan")
    kpt = [(1.0, 1.0, nan)] * 17
    box = (0.0, 0.0, 50.0, 50.0)
    rows = [(0, 60, 100, [(*box, 0.9, kpt)]), (1, 60, 100, [(*box, nan, kpt)])]
    frames = spark.createDataFrame(rows, "frame_idx int, frame_h int, frame_w int, dets array<struct<x1: double, y1: double, x2: double, y2: double, conf: double, kpt: array<struct<x: double, y: double, conf: double>>>>")
    assert [r.reason for r in decide.decide_frames(frames).orderBy("frame_idx").collect()] == ["no_face_or_shoulder", "low_conf"]


def test_relative_paths_and_rates(spark):
    assert [one(spark, X.relative_path(F.lit(p), "/a+b/")) for p in ("/a+b/c/d.mp4", "/aab/c.mp4")] == ["c/d.mp4", "/aab/c.mp4"]
    assert one(spark, normalize.fps_gate(F.lit(None).cast("double"))) == "fps=unknown" and one(spark, normalize.fps_gate(F.lit(25.0))) is None
    assert one(spark, X.error_tail(F.lit("one\ntwo"), 5)) == "e two" and len(one(spark, X.utc_now())) == 20


def test_status_log_and_resume(spark):
    manifest = spark.createDataFrame([(f"u{i}",) for i in range(20)], "window_uid string")
    log = spark.createDataFrame([("u1", "ffmpeg_failed"), ("u1", "ok"), ("u2", "ffmpeg_failed")], "window_uid string, status string")
    left = {r.window_uid for r in shard.pending(manifest, log).collect()}
    assert left == {f"u{i}" for i in range(20)} - {"u1"}
    parts = [{r.window_uid for r in shard.shard(manifest, log, t, 3).collect()} for t in range(3)]
    assert set().union(*parts) == left and sum(map(len, parts)) == len(left)
    done = manifest.withColumn("status", F.lit("ok"))
    assert shard.pending(manifest, done).count() == 0


def test_placeholders(spark):
    videos = spark.createDataFrame([("a", 10, 20, None, None), ("b", 10, 20, "bad_fps", "fps=30.000")], "video_id string, width int, height int, status string, drop_reason string")
    none = series.segments(series.sessionize(_track(spark, []), 4, 15), 4).withColumns({"drop_reason": F.lit(""), "kept": F.lit(True)})
    got = {r.video_id: r for r in report.with_placeholders(videos, none).collect()}
    assert [(got[v].status, got[v].drop_reason, got[v].kept, got[v].n_windows) for v in "ab"] == [("no_segments", "no_valid_frames", False, 0), ("bad_fps", "fps=30.000", False, 0)]


def test_manifest_end_to_end(spark):
    kpt = [(500.0, 300.0, 0.9)] * 17
    rows = [("v", f, 1, 0.6, 1, 0.9, 500.0 + f % 8, 300.0, 80.0, 150.0, [(x + f, y, c) for x, y, c in kpt]) for f in range(0, 160, 4)]
    det = spark.createDataFrame(rows, schemas.DETECTIONS)
    videos = spark.createDataFrame([("v", 1920, 1080, None, None)], "video_id string, width int, height int, status string, drop_reason string")
    row = report.manifest(videos, det).first()
    assert (row.kept, row.drop_reason, row.n_segments, row.n_windows, row.start_frame, row.end_frame) == (True, "", 1, 1, 0, 159)
    assert len(row.track_cx) == 40 and row.geom_valid
    assert len(schemas.conform(report.manifest(videos, det), schemas.MANIFEST).columns) == 47


# ---------------------------------------------------------------- files, streams, boundaries


def test_sources(spark, tmp_path):
    (tmp_path / "ids.csv").write_text("video_id,x\n abcdefghijk ,1\nshort,2\nabcdefghijk,3\n\nABCDEFGHIJK,4\n")
    assert [r.video_id for r in files.id_list(spark, str(tmp_path / "ids.csv")).orderBy("pos").collect()] == ["abcdefghijk", "abcdefghijk", "ABCDEFGHIJK"]
    assert files.id_archive(spark, str(tmp_path / "none.txt")).count() == 0
    (tmp_path / "a.txt").write_text("x\n\n x\ny z\n")
    assert files.id_archive(spark, str(tmp_path / "a.txt")).count() == 2
    assert files.done_list(spark, str(tmp_path / "a.txt")).count() == 3
    media = tmp_path / "media" / "sub"
    media.mkdir(parents=True)
    for name, size in (("abcdefghijk.mp4", 3), ("bbbbbbbbbbb.MKV", 1), ("ccccccccccc.mp4.part", 1), ("ddddddddddd.mp4", 0), ("e.txt", 1)):
        (media / name).write_bytes(b"x" * size)
    assert files.existing_ids(spark, str(media)).count() == 2
    listed = files.sorted_listing(spark, str(tmp_path / "media"))
    assert [r.path.rsplit("/", 1)[1] for r in listed.collect()] == ["abcdefghijk.mp4", "bbbbbbbbbbb.MKV"]
    done = spark.createDataFrame([("abcdefghijk",)], "video_id string")
    assert files.undone(listed, done).count() == 1
    prints = {r.path.rsplit("/", 1)[1]: r.fingerprint for r in files.head_tail(spark, str(media)).collect()}
    assert prints["abcdefghijk.mp4"] == hashlib.md5(b"xxx3").hexdigest()[:16]


def test_report_and_sinks(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"video_id":"a","src_fps":30.0}\n{bad\n{"src_fps":1.0}\n{"video_id":"a","src_fps":0}\n{"video_id":"a","src_fps":25.0}\n')
    rates = normalize.original_fps(files.report(spark, str(tmp_path / "r.jsonl"))).collect()
    assert [(r.video_id, r.orig_fps) for r in rates] == [("a", 25.0)]
    rows = spark.createDataFrame([("u", "ok", None, 1.0, False, 0.5)], shard.STATUS_SCHEMA)
    log = str(tmp_path / "log")
    assert files.status_log(spark, log).count() == 0
    files.append_status(rows, log)
    files.append_status(rows, log)
    assert files.status_log(spark, log).count() == 2
    files.append_low_quality(spark.createDataFrame([("a", None)], "video_id string, best_available_resolution string"), str(tmp_path / "lq"))
    assert files.low_quality_log(spark, str(tmp_path / "lq")).where("video_id = 'a'").count() == 1
    files.write_shards(rows, str(tmp_path / "s"))
    files.compact(spark, str(tmp_path / "s"), shard.STATUS_SCHEMA, str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("*.parquet"))) == 1


def test_stream_matches_batch(spark, tmp_path):
    frames = [0, 3, 19, 40, 41, 300]
    _track(spark, frames).write.parquet(str(tmp_path / "in"))
    batch = {(r.start_frame, r.end_frame, r.n_detections) for r in series.segments(series.sessionize(_track(spark, frames), 1, 15), 1).collect()}
    table = stream.session_segments(_track(spark, frames), 1, 15)
    assert {(r.start_frame, r.end_frame, r.n_detections) for r in table.collect()} == batch
    live = stream.read_detections(spark, str(tmp_path / "in"), "video_id string, frame_idx int, cx double")
    out = stream.session_segments(live, 1, 15, "1 second")
    for _ in range(2):  # a restart adds nothing
        stream.write_once(out, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {(r.start_frame, r.end_frame, r.n_detections) for r in spark.read.parquet(str(tmp_path / "out") + "/batch=*").collect()}
    assert got == {s for s in batch if s[1] < 280}  # the last session stays open behind the watermark


def test_failures_become_statuses(spark):
    def action(row):
        if row["k"] == "bad":
            raise ValueError("no")
        return {"status": "ok"}

    got = external.process_each(spark.createDataFrame([("good",), ("bad",)], "k string"), action, "k").collect()
    assert {(r.k, r.status, r.error) for r in got} == {("good", "ok", None), ("bad", "failed", "ValueError: no")}


def test_geometry_of_a_lone_detection(spark):
    rows = series.sessionize(spark.createDataFrame([("v", 0, 1.0, 1.0, 1.0, [(0.0, 0.0, 0.0)] * 17, 100, 100)], "video_id string, frame_idx int, cx double, cy double, h double, kpt array<struct<x: double, y: double, conf: double>>, width int, height int"), 4, 15)
    row = geometry.segment_geometry(rows).first()
    assert (row.geom_valid, row.geom_drop_reason, row.bx) == (False, "insufficient_box_track", None)
