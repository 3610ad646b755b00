"""Ordered-series operators: sessions, gaps, dense tracks, moving averages, motion.

Everything is partitioned by video, so one exchange on video_id serves a whole chain;
(video_id, seg_index) groupings reuse it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import LEFT_WRIST, RIGHT_WRIST, DetectConfig
from ..functions import exprs as X

SEGMENT = ["video_id", "seg_index"]


def unique_frames(detections: DataFrame, order: str) -> DataFrame:
    """One row per (video_id, frame_idx): that with the largest ``order``."""
    rest = [c for c in detections.columns if c not in ("video_id", "frame_idx")]
    picked = detections.groupBy("video_id", "frame_idx").agg(F.max_by(F.struct(*rest), order).alias("r"))
    return picked.select("video_id", "frame_idx", "r.*")


def sessionize(detections: DataFrame, stride: int, tolerance: int) -> DataFrame:
    """Adds seg_index and gap.

    A sample covers the next ``stride`` frames; a segment ends where over ``tolerance``
    frames are not covered.  ``gap`` counts the uncovered frames before a detection inside
    its segment (0 for none).
    """
    w = Window.partitionBy("video_id").orderBy("frame_idx")
    step = F.col("frame_idx") - F.lag("frame_idx").over(w)
    opens = F.when(step <= stride + tolerance, 0).otherwise(1)
    out = detections.withColumn("_step", step).withColumn("_open", opens)
    out = out.withColumn("seg_index", (F.sum("_open").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).cast("int"))
    gap = F.when(F.col("_open") == 1, 0).otherwise(F.greatest(F.col("_step") - stride, F.lit(0)))
    return out.withColumn("gap", gap.cast("int")).drop("_step", "_open")


def segments(sessions: DataFrame, stride: int, *more: Column) -> DataFrame:
    """Start, end, length and gap figures of each segment of :func:`sessionize`; ``more`` aggregates too."""
    out = sessions.groupBy(*SEGMENT).agg(
        F.min("frame_idx").alias("start_frame"),
        (F.max("frame_idx") + stride - 1).alias("end_frame"),
        F.count("*").alias("n_detections"),
        F.count_if(F.col("gap") > 0).alias("n_bridged_gaps"),
        F.max("gap").cast("long").alias("max_gap_frames"),
        *more,
    )
    return out.select(
        X.segment_uid("video_id", "seg_index").alias("segment_uid"),
        *SEGMENT,
        "start_frame",
        "end_frame",
        (F.col("end_frame") - F.col("start_frame") + 1).alias("n_frames"),
        *[c for c in out.columns if c not in (*SEGMENT, "start_frame", "end_frame")],
    )


def densify(sessions: DataFrame, values: list[str], stride: int = 1) -> DataFrame:
    """One row for each frame of each segment with two detections or more.

    Values between detections are interpolated linearly, those after the last one hold.
    """
    w = Window.partitionBy(*SEGMENT).orderBy("frame_idx")
    nxt = F.lead("frame_idx").over(w)
    n = F.count("*").over(Window.partitionBy(*SEGMENT))
    base = sessions.select(*SEGMENT, "frame_idx", *values, nxt.alias("_next"), n.alias("_n"), *(F.lead(v).over(w).alias(f"_next_{v}") for v in values))
    base = base.where("_n >= 2")
    grid = F.sequence("frame_idx", F.coalesce(F.col("_next") - 1, F.col("frame_idx") + stride - 1))
    out = base.withColumn("frame", F.explode(grid))
    share = F.try_divide((F.col("frame") - F.col("frame_idx")).cast("double"), (F.col("_next") - F.col("frame_idx")).cast("double"))
    line = [F.coalesce(F.col(v) + (F.col(f"_next_{v}") - F.col(v)) * share, F.col(v)).alias(v) for v in values]
    return out.select(*SEGMENT, F.col("frame").alias("frame_idx"), *line)


def moving_average(series: DataFrame, keys: list[str], order: str, values: list[str], span: int, frac: float | None = 1.0) -> DataFrame:
    """Centred moving averages with the ends repeated outwards; replaces ``values``.

    The length is smooth_span(n) for a series of n rows.  Series at least ``span`` long use
    one window frame for all; shorter ones (under ``span`` rows each) are folded into arrays.
    With ``frac=None`` every series is averaged over ``span`` (made odd), however short.
    """
    full = span if span % 2 else span + 1
    whole = Window.partitionBy(*keys)
    ordered = whole.orderBy(order)
    base = series.withColumn("_n", F.count("*").over(whole)).withColumn("_i", F.row_number().over(ordered) - 1)
    if span <= 1:
        return base.drop("_n", "_i")
    long_enough = F.lit(True) if frac is None else F.floor(F.col("_n") * frac) >= span
    pad = full // 2
    near = ordered.rowsBetween(-pad, pad)
    everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.greatest(F.lit(0), F.lit(pad) - F.col("_i"))
    after = F.greatest(F.lit(0), F.lit(pad) - (F.col("_n") - 1 - F.col("_i")))
    wide = base.where(long_enough)
    others = [c for c in series.columns if c not in values]
    wide = wide.select(
        *others,
        *(
            ((F.sum(v).over(near) + before * F.first(v).over(everything) + after * F.last(v).over(everything)) / full).alias(v)
            for v in values
        ),
    )
    if frac is None:
        return wide
    rest = [c for c in others if c not in (*keys, order)]
    short = base.where(~long_enough).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, *values, *rest))).alias("_s"))
    size = F.size("_s")
    half = F.floor(X.smooth_span(size, span, frac) / 2).cast("int")

    def mean(v: str):
        def at(i):
            return F.element_at(F.col("_s"), F.least(F.greatest(i, F.lit(1)), size)).getField(v).cast("double")

        def one(x, i):
            total = F.aggregate(F.sequence(i + 1 - half, i + 1 + half), F.lit(0.0), lambda acc, j: acc + at(j))
            return total / (2 * half + 1)

        return F.transform("_s", one)

    short = short.select(*keys, "_s", *(mean(v).alias(f"_m_{v}") for v in values))
    short = short.select(*keys, F.posexplode("_s").alias("_p", "_r"), *(f"_m_{v}" for v in values))
    short = short.select(
        *keys,
        F.col(f"_r.{order}").alias(order),
        *(F.col(f"_r.{c}").alias(c) for c in rest),
        *(F.element_at(F.col(f"_m_{v}"), F.col("_p") + 1).alias(v) for v in values),
    )
    return wide.unionByName(short.select(*wide.columns))


def motion(sessions: DataFrame, cfg: DetectConfig = DetectConfig()) -> DataFrame:
    """Adds body_motion and wrist_motion of each detection against the one before in its segment.

    Both are relative to the earlier box's diagonal (1 at least); null for a segment's
    first detection and where no keypoint is sure in both.  Needs kpt, w and h.
    """
    w = Window.partitionBy(*SEGMENT).orderBy("frame_idx")
    diagonal = F.greatest(F.hypot("w", "h"), F.lit(1.0))
    base = sessions.withColumn("_kpt", F.lag("kpt").over(w)).withColumn("_diag", F.lag(diagonal).over(w))
    pairs = F.zip_with(
        "_kpt",
        "kpt",
        lambda a, b: F.when(
            X.at_least(a.conf, cfg.kpt_conf) & X.at_least(b.conf, cfg.kpt_conf), (F.abs(b.x - a.x) + F.abs(b.y - a.y)) / 2
        ),
    )
    sure = F.filter("_m", lambda m: m.isNotNull())
    total = F.aggregate(sure, F.lit(0.0), lambda a, m: a + m)
    left, right = F.get("_m", F.lit(LEFT_WRIST)), F.get("_m", F.lit(RIGHT_WRIST))
    wrists = (F.coalesce(left, F.lit(0.0)) + F.coalesce(right, F.lit(0.0))) / F.nullif(left.isNotNull().cast("int") + right.isNotNull().cast("int"), F.lit(0))
    base = base.withColumn("_m", pairs)
    return base.withColumn("body_motion", F.try_divide(total, F.size(sure)) / F.col("_diag")).withColumn("wrist_motion", wrists / F.col("_diag")).drop("_kpt", "_diag", "_m")


def motion_figures(cfg: DetectConfig = DetectConfig()) -> list[Column]:
    """Aggregates over :func:`motion`: exact median and percentile, 0 where nothing moved measurably."""
    return [
        F.coalesce(F.median("body_motion"), F.lit(0.0)).alias("body_motion_median"),
        F.coalesce(F.percentile("wrist_motion", F.lit(cfg.hand_motion_pctl / 100)), F.lit(0.0)).alias("wrist_motion_p75"),
    ]


def segment_verdict(cfg: DetectConfig = DetectConfig(), geometry: bool = True) -> Column:
    """Drop reason of a segment, empty for a kept one; first rule that holds."""
    out = F.when(F.col("n_frames") < cfg.min_segment_frames, "too_short")
    if geometry:
        out = out.when(~F.coalesce("geom_valid", F.lit(False)), F.coalesce("geom_drop_reason", F.lit("invalid_crop_geometry")))
    out = out.when(~F.isnan("body_motion_median") & (F.col("body_motion_median") < cfg.motion_min), "low_motion")
    if cfg.hand_motion_min > 0:
        out = out.when(F.col("wrist_motion_p75") < cfg.hand_motion_min, "low_hand_motion")
    return out.otherwise("")


def collect_tracks(sessions: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Arrays by frame for each segment: track_frames, and a column for each (name, cast) of ``columns``."""
    rows = F.array_sort(F.collect_list(F.struct("frame_idx", *columns)))
    out = sessions.groupBy(*SEGMENT).agg(rows.alias("_r"))
    named = [F.col("_r").getField(c).cast(f"array<{t}>").alias(f"track_{c}") for c, t in columns.items()]
    return out.select(*SEGMENT, F.col("_r").getField("frame_idx").cast("array<int>").alias("track_frames"), *named)
