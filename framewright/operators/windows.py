"""Fixed-length windows of segments and their ordered gates.

``index_mode="detection"`` (the default) counts windows in frames but fills them with
detections by position: window k gets detections k * w .. k * w + w - 1.  ``"frame"`` fills
them by frame number and scales the shoulder rule to the samples that a window can have.
Windows without detections are judged as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import KEYPOINTS, LEFT_SHOULDER, LEFT_WRIST, NOSE, RENDER_SIZE, RIGHT_SHOULDER, RIGHT_WRIST, WindowConfig
from ..functions import exprs as X
from .series import moving_average

_POINTS = {"ls": LEFT_SHOULDER, "rs": RIGHT_SHOULDER, "lw": LEFT_WRIST, "rw": RIGHT_WRIST, "nose": NOSE}


def explode_keypoints(keypoints: DataFrame) -> DataFrame:
    """Rows (segment_uid, i, ls_x, ls_y, ls_c, ...) from flattened arrays of 17 points a detection."""
    at = lambda c, k: F.get(c, (F.col("i") * KEYPOINTS + k).cast("int"))
    picks = [at(c, k).alias(f"{name}_{s}") for name, k in _POINTS.items() for c, s in (("kpt_x", "x"), ("kpt_y", "y"), ("kpt_conf", "c"))]
    rows = keypoints.withColumn("i", F.explode(F.sequence(F.lit(0), F.greatest(F.col("n_detections") - 1, F.lit(0)))))
    return rows.where("n_detections > 0").select("segment_uid", "i", *picks)


def segment_detections(manifest: DataFrame, keypoints: DataFrame) -> DataFrame:
    """Detections of usable segments: keypoints joined to the manifest's tracks by segment_uid.

    The status filter and the four columns reach the scans; neither side is forced to be
    broadcast, as both hold arrays.
    """
    ok = manifest.where("status = 'ok'").select("segment_uid", "start_frame", "track_frames", "track_cx", "track_cy", "track_h", "width", "height")
    joined = keypoints.select("segment_uid", "n_detections", "kpt_x", "kpt_y", "kpt_conf").join(ok, "segment_uid")
    tracks = joined.select("segment_uid", "start_frame", "width", "height", F.posexplode(F.arrays_zip("track_frames", "track_cx", "track_cy", "track_h")).alias("i", "t"))
    tracks = tracks.select("segment_uid", "start_frame", "width", "height", "i", F.col("t.track_frames").alias("frame_idx"), F.col("t.track_cx").alias("cx"), F.col("t.track_cy").alias("cy"), F.col("t.track_h").alias("h"))
    return tracks.join(explode_keypoints(joined), ["segment_uid", "i"])


def slices(segments: DataFrame, cfg: WindowConfig = WindowConfig()) -> DataFrame:
    """One row per whole window of each segment (segment_uid, start_frame, n_frames, ...); a remainder is left out."""
    n = F.expr(f"cast(n_frames div {cfg.window_frames} as int)")
    rows = segments.withColumn("_n", n).where("_n > 0").withColumn("window", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n")
    return rows.withColumn("window_uid", X.window_uid("segment_uid", "window")).withColumn("start_frame_abs", F.col("start_frame") + F.col("window") * cfg.window_frames)


def window_number(cfg: WindowConfig) -> Column:
    place = F.col("i") if cfg.index_mode == "detection" else F.col("frame_idx") - F.col("start_frame")
    return F.floor(place / cfg.window_frames).cast("int")


def _sure(point: str, least: float) -> Column:
    return X.above(F.coalesce(F.col(f"{point}_c"), F.lit(0.0)), F.lit(least))


def gate_windows(segments: DataFrame, detections: DataFrame, cfg: WindowConfig = WindowConfig()) -> DataFrame:
    """Every window with its verdict: kept, drop_reason, bx, by, b_side, face_height_render.

    segments: segment_uid, start_frame, n_frames, width, height and what should pass
    through.  detections: segment_uid, i (place in the segment), frame_idx, cx, cy, h and
    the points ls, rs, lw, rw, nose as _x, _y, _c.
    """
    keys = ["segment_uid", "window"]
    rows = detections.drop("start_frame", "width", "height")
    if cfg.index_mode == "frame":
        rows = rows.join(segments.select("segment_uid", "start_frame"), "segment_uid")
    rows = rows.withColumn("window", window_number(cfg))
    rows = rows.withColumn("_h", F.col("h")).withColumn("_cx", F.col("cx")).withColumn("_cy", F.col("cy"))
    order = "i"
    span = min(cfg.smooth_span_frames, max(3, int(cfg.window_frames * cfg.smooth_span_frac)))  # of the nominal length
    passed = ["_cx", "_cy", *(f"{p}_{c}" for p in _POINTS for c in "xyc")]
    rows = moving_average(rows.select(*keys, order, "cx", "cy", "h", *passed), keys, order, ["cx", "cy", "h"], span, None)
    shoulders = _sure("ls", cfg.kpt_conf) & _sure("rs", cfg.kpt_conf)
    tilt = F.abs(F.col("ls_y") - F.col("rs_y")) / F.greatest(F.abs(F.col("ls_x") - F.col("rs_x")), F.lit(1.0))
    left, right = _sure("lw", cfg.wrist_conf_min), _sure("rw", cfg.wrist_conf_min)

    def point(p: str, sure: Column) -> Column:
        x, y = F.col(f"{p}_x"), F.col(f"{p}_y")
        return F.when(sure, F.struct(x.alias("x"), y.alias("y"), F.hypot(x - F.col("_cx"), y - F.col("_cy")).alias("d")))

    wrists = F.filter(F.array(point("lw", left), point("rw", right)), lambda p: p.isNotNull())
    face = F.greatest("ls_y", "rs_y") - F.col("nose_y")
    flat = rows.select(
        *keys, "cx", "cy", "h", "nose_y", shoulders.alias("_sh"), F.when(shoulders, tilt).alias("_tilt"), (left | right).cast("int").alias("_wr"),
        face.alias("_face"), wrists.alias("_pts"),
    )
    figures = flat.groupBy(*keys).agg(
        F.count_if("_sh").alias("n_shoulders"), F.median("_tilt").alias("tilt"), F.avg("_wr").alias("wrist_share"),
        F.median("cx").alias("_bcx"), F.median("cy").alias("_bcy"), F.median("h").alias("_bh"),
        F.median("_face").alias("_face"), F.median("nose_y").alias("_nose"), F.flatten(F.collect_list("_pts")).alias("_pts"),
    )
    out = slices(segments, cfg).join(figures, keys, "left")
    # a window holds window_frames detections at most, so its points fit an array
    d = F.array_sort(F.transform(F.coalesce("_pts", F.array()), lambda p: p.d))
    out = out.withColumn("_d", d)
    spot = (F.size("_d") - 1) * (cfg.wrist_percentile / 100)
    low = F.floor(spot).cast("int")
    a, b = F.get("_d", low), F.get("_d", F.least(low + 1, F.size("_d") - 1))
    reach = F.when(F.size("_d") > 0, a + (b - a) * (spot - low)).otherwise(0.0)
    side = F.greatest(F.col("_bh") * cfg.crop_scale, reach * (1 + cfg.hand_margin_frac) * 2)
    out = out.withColumn("_box", X.clamp_box(F.col("_bcx"), F.col("_bcy"), side, F.col("width"), F.col("height"), cfg.min_crop_px))
    x, y, s = F.col("_box.x"), F.col("_box.y"), F.col("_box.side")
    outside = F.filter("_pts", lambda p: (p.x < F.col("_box.x")) | (p.x > F.col("_box.x") + F.col("_box.side")) | (p.y < F.col("_box.y")) | (p.y > F.col("_box.y") + F.col("_box.side")))
    clipped = F.try_divide(F.size(outside).cast("double"), F.size("_pts").cast("double"))
    needed = cfg.window_frames * 0.5 / (cfg.frame_stride if cfg.index_mode == "frame" else 1)
    face_render = F.try_divide(F.col("_face"), s) * RENDER_SIZE
    nose_render = X.to_render(F.col("_nose"), y, s)
    reason = (
        F.when(F.coalesce("n_shoulders", F.lit(0)) < needed, "shoulders_not_visible")
        .when(X.above(F.col("tilt"), F.lit(cfg.max_shoulder_tilt)), "tilted_presenter")
        .when(F.col("wrist_share") < cfg.min_wrist_presence_frac, "hands_not_visible_enough")
        .when(F.col("_box.side") < cfg.min_crop_px, F.col("_box.reason"))
        .when(X.above(clipped, F.lit(cfg.max_wrist_cutoff_frac)), "wrist_clipped_boundary")
        .when(face_render < cfg.min_face_size_px, "face_too_small_for_lipsync")
        .when((nose_render < cfg.headroom_min) | X.above(nose_render, F.lit(cfg.headroom_max)), "inconsistent_headroom")
        .otherwise("ok")
    )
    out = out.withColumn("drop_reason", reason)
    ok = F.col("drop_reason") == "ok"
    return out.select(
        "window_uid", *[c for c in segments.columns if c != "window_uid"], "window", "start_frame_abs", ok.alias("kept"), "drop_reason",
        F.when(ok, x).alias("bx"), F.when(ok, y).alias("by"), F.when(ok, s).alias("b_side"), F.when(ok, face_render).alias("face_height_render"),
    )


def render_manifest(gated: DataFrame) -> DataFrame:
    """The twelve columns of kept windows; always the full schema."""
    return gated.where("kept").select(
        "window_uid", "segment_uid", "video_id", "path", F.col("start_frame_abs").cast("long").alias("start_frame_abs"), "bx", "by", "b_side", "face_height_render",
        F.col("width").cast("int").alias("width"), F.col("height").cast("int").alias("height"), F.col("fps").cast("float").alias("fps"),
    )


def drop_histogram(gated: DataFrame) -> DataFrame:
    """Windows by drop reason, most first."""
    return gated.groupBy("drop_reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "drop_reason")
