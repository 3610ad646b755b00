"""Static square crops of segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import LEFT_WRIST, RIGHT_WRIST, DetectConfig
from ..functions import exprs as X
from .series import SEGMENT, densify, moving_average


def wrist_distances(cfg: DetectConfig) -> Column:
    """Distances from the track's centre to the wrists that are sure, as an array."""

    def one(k: int) -> Column:
        p = F.get("kpt", F.lit(k))
        return F.when(X.above(p.conf, cfg.wrist_conf_min), F.hypot(p.x - F.col("cx"), p.y - F.col("cy")))

    return F.filter(F.array(one(LEFT_WRIST), one(RIGHT_WRIST)), lambda d: d.isNotNull())


def segment_geometry(sessions: DataFrame, sizes: DataFrame | None = None, cfg: DetectConfig = DetectConfig()) -> DataFrame:
    """One row per segment of sessionized detections (cx, cy, h, kpt; width and height, or from ``sizes`` by video).

    Columns bx, by, b_side, body_side_px, wrist_reach_px, body_coverage_frac,
    body_max_drift_px, geom_valid, geom_drop_reason.  Fewer than two detections give
    insufficient_box_track; a crop under the least size gives body_below_min_crop_px.
    """
    if sizes is not None:
        sessions = sessions.join(sizes.select("video_id", "width", "height"), "video_id", "left")
    reach = sessions.withColumn("_d", F.explode_outer(wrist_distances(cfg))).groupBy(*SEGMENT).agg(
        F.coalesce(F.percentile("_d", F.lit(cfg.wrist_percentile / 100)), F.lit(0.0)).alias("wrist_reach_px"),
        F.max("width").alias("width"),
        F.max("height").alias("height"),
    )
    dense = densify(sessions, ["cx", "cy", "h"], cfg.frame_stride)
    smooth = moving_average(dense, SEGMENT, "frame_idx", ["cx", "cy", "h"], cfg.smooth_span_frames, cfg.smooth_span_frac)
    centre = smooth.groupBy(*SEGMENT).agg(F.median("cx").alias("_cx"), F.median("cy").alias("_cy"), F.median("h").alias("_h"))
    side = F.greatest(F.col("_h") * cfg.crop_scale, F.col("wrist_reach_px") * (1 + cfg.crop_hand_margin) * 2)
    box = centre.join(reach, SEGMENT, "right").withColumn("_box", X.clamp_box(F.col("_cx"), F.col("_cy"), side, F.col("width"), F.col("height"), cfg.min_crop_px))
    half = F.col("h") / 2
    b = F.col("_box")
    inside = (F.col("cx") - half >= b.x) & (F.col("cx") + half <= b.x + b.side) & (F.col("cy") - half >= b.y) & (F.col("cy") + half <= b.y + b.side)
    fit = (
        smooth.join(box.select(*SEGMENT, "_box", "_cx", "_cy"), SEGMENT)
        .groupBy(*SEGMENT)
        .agg(
            F.avg(inside.cast("int")).alias("_cover"),
            F.greatest(F.max(F.abs(F.col("cx") - F.col("_cx"))), F.max(F.abs(F.col("cy") - F.col("_cy")))).alias("_drift"),
        )
    )
    out = box.join(fit, SEGMENT, "left")
    small = b.side < cfg.min_crop_px
    valid = F.col("_cx").isNotNull() & F.coalesce(~small, F.lit(False))  # no crop without a size
    return out.select(
        *SEGMENT,
        *(F.when(valid, e).alias(n) for n, e in (("bx", b.x), ("by", b.y), ("b_side", b.side), ("body_side_px", b.side))),
        F.when(valid, F.col("wrist_reach_px")).otherwise(0.0).alias("wrist_reach_px"),
        F.when(valid, F.col("_cover")).otherwise(0.0).alias("body_coverage_frac"),
        F.when(valid, F.col("_drift")).otherwise(0.0).alias("body_max_drift_px"),
        valid.alias("geom_valid"),
        F.when(F.col("_cx").isNull(), "insufficient_box_track").when(small, "body_below_min_crop_px").otherwise(b.reason).alias("geom_drop_reason"),
    )
