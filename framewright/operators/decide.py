"""Frame decisions over nested detections.

A frame's boxes travel in one array, so the whole cascade is a projection: no exchange.
Boxes are struct<x1, y1, x2, y2, conf, kpt: array<struct<x, y, conf>>>.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (
    LEFT_EAR,
    LEFT_ELBOW,
    LEFT_EYE,
    LEFT_SHOULDER,
    LEFT_WRIST,
    LOWER_BODY,
    NOSE,
    RIGHT_EAR,
    RIGHT_ELBOW,
    RIGHT_EYE,
    RIGHT_SHOULDER,
    RIGHT_WRIST,
    DetectConfig,
)
from ..functions.exprs import at_least


def _sure(kpt: Column, k: int, least: float) -> Column:
    return F.coalesce(at_least(F.get(kpt, F.lit(k)).conf, least), F.lit(False))


def hand_usable(kpt: Column, wrist: int, elbow: int, box_height: Column, width: Column, height: Column, cfg: DetectConfig) -> Column:
    """The wrist is sure and a hand-sized circle round it lies in the frame, margin left out."""
    w, e = F.get(kpt, F.lit(wrist)), F.get(kpt, F.lit(elbow))
    arm = F.hypot(w.x - e.x, w.y - e.y) * cfg.hand_extent_ratio
    radius = F.greatest(F.lit(cfg.hand_radius_min), F.when(_sure(kpt, elbow, cfg.kpt_conf), arm).otherwise(box_height * cfg.hand_fallback_frac))
    margin = F.least(width, height) * cfg.hand_margin_frac
    inside = (w.x - radius >= margin) & (w.x + radius <= width - margin) & (w.y - radius >= margin) & (w.y + radius <= height - margin)
    return _sure(kpt, wrist, cfg.kpt_conf) & F.coalesce(inside, F.lit(False))


def usable_hands(kpt: Column, box_height: Column, width: Column, height: Column, cfg: DetectConfig = DetectConfig()) -> Column:
    both = [hand_usable(kpt, w, e, box_height, width, height, cfg) for w, e in ((LEFT_WRIST, LEFT_ELBOW), (RIGHT_WRIST, RIGHT_ELBOW))]
    return (both[0].cast("int") + both[1].cast("int")).cast("tinyint")


def decide_frames(frames: DataFrame, cfg: DetectConfig = DetectConfig()) -> DataFrame:
    """frames (frame_w, frame_h, dets, ...) with reason, n_persons, hfrac, hands, conf, cx, cy, w, h, kpt.

    The first rule that holds names the reason; ``ok`` frames carry the one prominent box.
    Null and empty dets are no_detection.
    """
    kept = F.filter(F.coalesce("dets", F.array()), lambda d: at_least(d.conf, cfg.person_conf))
    boxes = F.transform(
        kept,
        lambda d: F.struct(
            ((d.y2 - d.y1) / F.col("frame_h")).alias("hfrac"),
            (F.greatest(d.y2 - d.y1, F.lit(1.0)) * F.greatest(d.x2 - d.x1, F.lit(1.0))).alias("area"),
            d.alias("d"),
        ),
    )
    out = frames.withColumn("_n", F.size(F.coalesce("dets", F.array()))).withColumn("_b", boxes)
    out = out.withColumn("_tall", F.filter("_b", lambda b: at_least(b.hfrac, cfg.min_height_frac))).withColumn("_p", F.get("_tall", F.lit(0)))
    areas = F.sort_array(F.transform("_b", lambda b: b.area), asc=False)
    out = out.withColumn("_areas", areas)
    first, second = F.get("_areas", F.lit(0)), F.get("_areas", F.lit(1))
    dominant = (F.col("_p.area") >= first) & (F.col("_p.area") >= F.greatest(second, F.lit(1.0)) * cfg.prominence_ratio)
    kpt, least = F.col("_p.d.kpt"), cfg.kpt_conf
    sure = lambda k: _sure(kpt, k, least)
    head = sure(NOSE) | (sure(LEFT_EYE) & sure(RIGHT_EYE)) | sure(LEFT_EAR) | sure(RIGHT_EAR)
    shoulder = sure(LEFT_SHOULDER) | sure(RIGHT_SHOULDER)
    tall = F.greatest(F.col("_p.d.y2") - F.col("_p.d.y1"), F.lit(1.0))
    hands = usable_hands(kpt, tall, F.col("frame_w"), F.col("frame_h"), cfg)
    lower = sum((_sure(kpt, k, cfg.lower_body_conf).cast("int") for k in LOWER_BODY), F.lit(0))
    reason = (
        F.when(F.col("_n") == 0, "no_detection")
        .when(F.size("_b") == 0, "low_conf")
        .when(F.size("_tall") == 0, "no_prominent")
        .when(F.size("_tall") > 1, "multi_prominent")
        .when((F.size("_b") >= 2) & ~dominant, "not_dominant")
        .when(~(head & shoulder), "no_face_or_shoulder")
    )
    if cfg.min_visible_hands > 0:
        reason = reason.when(~(sure(LEFT_WRIST) | sure(RIGHT_WRIST)), "no_wrist").when(hands < cfg.min_visible_hands, "hand_cropped")
    if cfg.exclude_full_body:
        reason = reason.when(lower >= 2, "full_body")
    out = out.withColumn("reason", reason.otherwise("ok")).withColumn("n_persons", F.size("_b")).withColumn("hfrac", F.array_max(F.transform("_b", lambda b: b.hfrac)))
    ok = F.col("reason") == "ok"
    d = F.col("_p.d")
    return out.select(
        *frames.columns,
        "reason",
        "n_persons",
        F.coalesce("hfrac", F.lit(0.0)).alias("hfrac"),
        F.when(ok, hands).otherwise(F.lit(0)).cast("tinyint").alias("hands"),
        F.when(ok, d.conf).otherwise(0.0).alias("conf"),
        F.when(ok, (d.x1 + d.x2) / 2).otherwise(0.0).alias("cx"),
        F.when(ok, (d.y1 + d.y2) / 2).otherwise(0.0).alias("cy"),
        F.when(ok, d.x2 - d.x1).otherwise(0.0).alias("w"),
        F.when(ok, tall).otherwise(0.0).alias("h"),
        F.when(ok, kpt).alias("kpt"),
    )


def sampled(frames: DataFrame, stride: int) -> DataFrame:
    """Every stride-th frame."""
    return frames.where(F.col("frame_idx") % stride == 0)


def to_source_pixels(detections: DataFrame) -> DataFrame:
    """Coordinates of decoded frames (frame_w, frame_h) in source pixels (width, height)."""
    from ..functions.exprs import rescale

    sx, sy = (rescale(F.lit(1.0), F.col(s), F.col(d)) for s, d in (("width", "frame_w"), ("height", "frame_h")))
    scaled = detections.withColumn("_sx", sx).withColumn("_sy", sy)
    for c, s in (("cx", "_sx"), ("w", "_sx"), ("cy", "_sy"), ("h", "_sy")):
        scaled = scaled.withColumn(c, F.col(c) * F.col(s))
    kpt = F.transform("kpt", lambda k: F.struct((k.x * F.col("_sx")).alias("x"), (k.y * F.col("_sy")).alias("y"), k.conf.alias("conf")))
    return scaled.withColumn("kpt", kpt).drop("_sx", "_sy")
