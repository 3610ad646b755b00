"""Probe documents, normalisation plans and their verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import NormalizeConfig
from ..functions import exprs as X

PROBE_SCHEMA = (
    "streams array<struct<codec_type: string, codec_name: string, width: string, height: string, "
    "avg_frame_rate: string, r_frame_rate: string, duration: string, nb_frames: string>>, format struct<duration: string>"
)


def flatten_probe(probes: DataFrame, retry_streams: bool = True) -> DataFrame:
    """probes (..., json) with the figures of the first video and audio streams.

    With ``retry_streams`` the first video stream whose rate can be read is taken, else
    simply the first.  Documents without a rate or a width, or with one of zero, are not readable.
    """
    doc = F.from_json("json", PROBE_SCHEMA, {"mode": "PERMISSIVE"})
    out = probes.withColumn("_doc", doc)
    video = F.filter("_doc.streams", lambda s: s.codec_type == "video")
    if retry_streams:
        good = F.filter(video, lambda s: X.rate(s.avg_frame_rate).isNotNull())
        video = F.when(F.size(good) > 0, good).otherwise(video)
    out = out.withColumn("_v", F.get(video, F.lit(0))).withColumn("_a", F.get(F.filter("_doc.streams", lambda s: s.codec_type == "audio"), F.lit(0)))
    out = out.select(
        *probes.columns,
        X.rate("_v.avg_frame_rate").alias("avg_fps"),
        X.rate("_v.r_frame_rate").alias("r_fps"),
        F.col("_v.width").try_cast("int").alias("width"),
        F.col("_v.height").try_cast("int").alias("height"),
        F.col("_v.codec_name").alias("codec"),
        F.col("_v.duration").try_cast("double").alias("v_duration"),
        F.col("_a").isNotNull().alias("has_audio"),
        F.col("_a.duration").try_cast("double").alias("a_duration"),
        F.col("_doc.format.duration").try_cast("double").alias("duration"),
        F.col("_v.nb_frames").try_cast("long").alias("nb_frames"),
    )
    some = lambda c: F.coalesce(F.col(c) != 0, F.lit(False))
    return out.withColumn("readable", some("avg_fps") & some("width"))


def plan(meta: DataFrame, cfg: NormalizeConfig = NormalizeConfig()) -> DataFrame:
    """Adds vfr and mode (copy or transcode)."""
    return meta.withColumn("vfr", X.is_vfr("avg_fps", "r_fps", cfg)).withColumn("mode", X.mode("avg_fps", "r_fps", "codec", cfg))


def verify(source: DataFrame, output: DataFrame, key: str = "video_id", cfg: NormalizeConfig = NormalizeConfig()) -> DataFrame:
    """Five checks of each output against its source, and the two deltas in milliseconds.

    A source lasts as long as its video stream, or else its container; an output as long as
    its container; sound is held against the output's video stream.  Checks whose durations
    are unknown or zero pass.
    """
    names = ("avg_fps", "width", "height", "v_duration", "a_duration", "duration", "has_audio")
    s = source.select(key, *(F.col(c).alias(f"s_{c}") for c in names))
    d = output.select(key, *(F.col(c).alias(f"d_{c}") for c in names))
    both = s.join(d, key)
    both = both.withColumn("_sd", F.coalesce(X.falsy("s_v_duration"), X.falsy("s_duration"))).withColumn("_dd", X.falsy("d_duration"))
    audio, video = X.falsy("d_a_duration"), X.falsy("d_v_duration")
    rules = {
        "fps_ok": F.coalesce(F.abs(F.col("d_avg_fps") - cfg.fps) < cfg.verify_fps_tolerance, F.lit(False)),
        "duration_ok": F.coalesce(F.abs(F.col("_dd") - F.col("_sd")) <= cfg.duration_tolerance, F.lit(True)),
        "av_ok": F.coalesce(~F.col("d_has_audio") | (F.abs(audio - video) <= cfg.av_tolerance), F.lit(True)),
        "audio_ok": F.col("s_has_audio").eqNullSafe(F.col("d_has_audio")),
        "size_ok": F.col("s_width").eqNullSafe(F.col("d_width")) & F.col("s_height").eqNullSafe(F.col("d_height")),
    }
    both = both.select(
        key,
        *(e.alias(n) for n, e in rules.items()),
        X.delta_ms("_sd", "_dd").alias("dur_delta_ms"),
        F.when(F.col("d_has_audio"), X.delta_ms(video, audio)).alias("av_delta_ms"),
    )
    every = F.lit(True)
    for n in rules:
        every = every & F.col(n)
    return both.withColumn("verified", every)


def outcome(exists: Column, readable: Column, encoded: Column, verified: Column) -> Column:
    """Status of one file, in the order in which a run meets the outcomes."""
    return F.when(exists, "skipped_exists").when(~readable, "unreadable").when(~encoded, "encode_failed").when(~verified, "verify_failed").otherwise("ok")


def final_mode(mode: Column, retried: Column) -> Column:
    return F.when((mode == "copy") & retried, "copy->transcode").otherwise(mode)


def histogram(rows: DataFrame, column: str) -> DataFrame:
    """Rows by value, nulls left out, in value order."""
    return rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(column)


def worst_deltas(report: DataFrame, delta: str = "dur_delta_ms", key: str = "video_id", n: int = 10) -> DataFrame:
    """The n verified files with the largest deltas that are not zero."""
    kept = report.where((F.col("status") == "ok") & (F.col(delta) != 0)).select(key, F.abs(delta).alias("delta"))
    return kept.orderBy(F.desc("delta"), F.desc(key)).limit(n)


def original_fps(report: DataFrame, order: str = "position") -> DataFrame:
    """(video_id, orig_fps): the last usable rate that a report gives each video."""
    return report.where(F.col("video_id").isNotNull() & (F.col("src_fps") != 0)).groupBy("video_id").agg(F.max_by("src_fps", order).alias("orig_fps"))


def with_original_fps(videos: DataFrame, rates: DataFrame) -> DataFrame:
    """videos with orig_fps; a left join whose build side the optimizer broadcasts only when it is small."""
    return videos.join(rates, "video_id", "left")


def fps_gate(fps: Column, target: float = 25.0, tolerance: float = 0.01) -> Column:
    """``fps=...`` where a rate is off the target or unknown, else null."""
    return F.when(F.coalesce(F.abs(fps - target) > tolerance, F.lit(True)), F.coalesce(F.when(fps.isNotNull(), F.format_string("fps=%.3f", fps)), F.lit("fps=unknown")))
