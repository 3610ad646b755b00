"""Manifest assembly, previews and totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DetectConfig
from ..functions import exprs as X
from . import geometry, series


def manifest(videos: DataFrame, detections: DataFrame, cfg: DetectConfig = DetectConfig(), stride: int | None = None) -> DataFrame:
    """Segments of every video; a video without one keeps a placeholder row.

    videos: video_id, status (null for readable ones), drop_reason, width, height, ...
    """
    stride = stride or cfg.frame_stride
    sessions = series.sessionize(detections, stride, cfg.gap_tolerance)
    figures = series.segments(
        series.motion(sessions, cfg),
        stride,
        *series.motion_figures(cfg),
        F.avg("hands").alias("hands_usable_mean"),
        F.median("hfrac").alias("height_frac_median"),
        F.max("n_persons").alias("n_persons_max"),
    )
    boxes = geometry.segment_geometry(sessions, videos.select("video_id", "width", "height"), cfg)
    tracks = series.collect_tracks(sessions, {"cx": "float", "cy": "float", "w": "float", "h": "float", "conf": "float", "hands": "tinyint"})
    whole = figures.join(boxes, series.SEGMENT).join(tracks, series.SEGMENT)
    whole = whole.withColumn("drop_reason", series.segment_verdict(cfg)).withColumn("kept", F.col("drop_reason") == "")
    return with_placeholders(videos, whole, cfg)


def with_placeholders(videos: DataFrame, segments: DataFrame, cfg: DetectConfig = DetectConfig()) -> DataFrame:
    """Left join from videos: nulls, kept false and no windows where there is no segment."""
    counted = segments.groupBy("video_id").agg(F.count("*").cast("int").alias("n_segments"))
    base = videos.withColumnRenamed("status", "_status").withColumnRenamed("drop_reason", "_reason")
    out = base.join(segments, "video_id", "left").join(counted, "video_id", "left")
    none = F.col("segment_uid").isNull()
    return (
        out.withColumn("status", F.coalesce("_status", F.when(none, "no_segments").otherwise("ok")))
        .withColumn("drop_reason", F.when(none, F.coalesce("_reason", F.lit("no_valid_frames"))).otherwise(F.col("drop_reason")))
        .withColumn("kept", F.coalesce("kept", F.lit(False)))
        .withColumn("n_segments", F.coalesce("n_segments", F.lit(0)))
        .withColumn("n_windows", F.coalesce(F.expr(f"cast(n_frames div {cfg.window_frames} as int)"), F.lit(0)))
        .drop("_status", "_reason")
    )


def _kept(value: Column | str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("kept"), X.col(value)).otherwise(0)), F.lit(0)).cast("long")


def preview(manifest: DataFrame) -> DataFrame:
    """One row per video: resolution, counts and the list of its segments."""
    text = F.when(F.col("start_frame").isNotNull(), X.segment_text("start_frame", "end_frame", "kept"))
    listed = F.array_sort(F.collect_list(F.when(text.isNotNull(), F.struct("seg_index", text.alias("t")))))
    out = manifest.groupBy("video_id").agg(
        F.min(X.resolution_text("width", "height")).alias("resolution"),
        F.min("fps").alias("fps"),
        F.max("n_segments").cast("long").alias("num_segments"),
        F.count_if("kept").alias("num_segments_kept"),
        _kept("n_frames").alias("total_kept_frames"),
        _kept("n_windows").alias("n_windows_total"),
        listed.alias("_l"),
        F.min("status").alias("status"),
    )
    joined = F.concat(F.lit("["), F.array_join(F.transform("_l", lambda x: x.t), ","), F.lit("]"))
    return out.withColumn("segments", joined).drop("_l")


def totals(manifest: DataFrame, fps: float = 25.0) -> DataFrame:
    """One row over the whole manifest."""
    ok = F.when(F.col("status") == "ok", F.col("video_id"))
    hours = F.sum(F.when(F.col("kept"), F.col("n_frames")).otherwise(0)) / F.lit(fps) / F.lit(3600.0)
    return manifest.agg(
        F.count_distinct("video_id").alias("videos_scanned"),
        F.count_distinct(ok).alias("videos_ok"),
        F.count("segment_uid").alias("segments_total"),
        F.count_if("kept").alias("segments_kept"),
        _kept("n_windows").alias("windows_total"),
        F.coalesce(F.bround(hours, 1), F.lit(0.0)).alias("hours_kept"),
    )
