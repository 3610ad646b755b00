"""Column functions.  All of them stay in the JVM and accept nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import RENDER_SIZE, NormalizeConfig, RenderConfig

# Fixed value: what a video id is in a file name
VIDEO_ID = r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{11})(?![A-Za-z0-9_-])"


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- names and paths


def video_id(name: Column | str) -> Column:
    """First run of exactly 11 id characters in a file name; null if there is none."""
    return F.nullif(F.regexp_extract(col(name), VIDEO_ID, 1), F.lit(""))


def base_name(path: Column | str) -> Column:
    return F.substring_index(col(path), "/", -1)


def suffix(path: Column | str) -> Column:
    """Last dot and what follows, in lower case; empty for names without or with a leading dot alone."""
    return F.lower(F.regexp_extract(base_name(path), r"[^.].*?(\.[^.]+)$", 1))


def stem(path: Column | str) -> Column:
    name = base_name(path)
    return F.coalesce(F.nullif(F.regexp_extract(name, r"^(.+)\.[^.]+$", 1), F.lit("")), name)


def relative_path(path: Column | str, root: str) -> Column:
    head = root.rstrip("/") + "/"
    return F.when(F.startswith(col(path), F.lit(head)), F.substring(col(path), len(head) + 1, 1 << 30)).otherwise(col(path))


def segment_uid(video: Column | str, index: Column | str) -> Column:
    return F.format_string("%s_seg%04d", col(video).cast("string"), col(index).cast("int"))


def window_uid(segment: Column | str, window: Column | str) -> Column:
    return F.format_string("%s_w%04d", col(segment), col(window).cast("int"))


def output_path(root: str, uid: Column | str) -> Column:
    return F.concat_ws("/", F.lit(root), F.substring(col(uid), 1, 2), col(uid), F.lit("video.mp4"))


def resolution_label(height: Column | str) -> Column:
    return F.concat(col(height).cast("string"), F.lit("p"))


def resolution_height(label: Column | str) -> Column:
    return F.rtrim(col(label), F.lit("p")).try_cast("int")


def resolution_text(width: Column | str, height: Column | str) -> Column:
    return F.coalesce(F.concat(col(width).cast("string"), F.lit("x"), col(height).cast("string")), F.lit(""))


def segment_text(start: Column | str, end: Column | str, kept: Column | str) -> Column:
    """``(start,end)``, with a star where the segment is dropped; null without a start."""
    return F.concat(F.lit("("), col(start).cast("string"), F.lit(","), col(end).cast("string"), F.lit(")"), F.when(col(kept), "").otherwise("*"))


def error_tail(text: Column | str, n: int) -> Column:
    return F.right(F.translate(col(text), "\n", " "), F.lit(n))


def utc_now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")


# ---------------------------------------------------------------- hashes


def stable_bucket(key: Column | str, n: int) -> Column:
    """The 128-bit MD5 of a key modulo n, from four 32-bit digits (no overflow for n < 2^31)."""
    digest = F.md5(col(key).cast("binary"))
    out = F.lit(0).cast("long")
    for k in range(4):
        digit = F.conv(F.substring(digest, k * 8 + 1, 8), 16, 10).cast("long")
        out = (out * F.lit((1 << 32) % n) + digit) % F.lit(n)
    return out


def fingerprint(content: Column | str, length: Column | str, head: int = 16384) -> Column:
    """16 hex digits of the MD5 of a file's head, of its tail if it is over twice that, and its size."""
    content, length = col(content), col(length)
    tail = F.when(length > 2 * head, F.substring(content, -head, head)).otherwise(F.lit(b""))
    return F.substring(F.md5(F.concat(F.substring(content, 1, head), tail, length.cast("string").cast("binary"))), 1, 16)


# ---------------------------------------------------------------- probes


def falsy(x: Column | str) -> Column:
    """Null for zero, so that coalesce falls through as a truth test does."""
    return F.nullif(col(x), F.lit(0.0))


def rate(text: Column | str) -> Column:
    """``num/den`` as a number; null unless there is one slash and both sides count."""
    parts = F.split(col(text), "/")
    ratio = F.try_divide(F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double"))
    return F.when(F.size(parts) == 2, ratio)


def is_vfr(avg: Column | str, real: Column | str, cfg: NormalizeConfig = NormalizeConfig()) -> Column:
    """Rates differ by over the tolerance; unknown or zero rates count as variable."""
    avg, real = falsy(avg), falsy(real)
    return F.coalesce(F.abs(real - avg) / avg > cfg.vfr_tolerance, F.lit(True))


def can_copy(avg: Column | str, real: Column | str, codec: Column | str, cfg: NormalizeConfig = NormalizeConfig()) -> Column:
    close = F.coalesce(F.abs(col(avg) - cfg.fps) < cfg.copy_tolerance, F.lit(False))
    return close & ~is_vfr(avg, real, cfg) & F.coalesce(col(codec).isin(*cfg.copy_codecs), F.lit(False))


def mode(avg: Column | str, real: Column | str, codec: Column | str, cfg: NormalizeConfig = NormalizeConfig()) -> Column:
    return F.when(can_copy(avg, real, codec, cfg), "copy").otherwise("transcode")


def delta_ms(before: Column | str, after: Column | str) -> Column:
    return F.bround((col(after) - col(before)) * 1000, 1)


# ---------------------------------------------------------------- geometry


def above(x: Column, limit) -> Column:
    """``x > limit`` with NaN below everything, as in IEEE comparisons."""
    return ~F.isnan(x) & (x > limit)


def at_least(x: Column, limit) -> Column:
    """``x >= limit`` with NaN below everything, as in IEEE comparisons."""
    return ~F.isnan(x) & (x >= limit)


def even_floor(x: Column | str) -> Column:
    """Half-even rounding with the lowest bit cleared."""
    return F.bround(col(x)).cast("long").bitwiseAND(F.lit(-2).cast("long"))


def seek_seconds(frame: Column | str, fps: float = RenderConfig.fps) -> Column:
    return col(frame) / F.lit(fps)


def clamp_box(cx: Column, cy: Column, side: Column, width: Column, height: Column, min_crop: int) -> Column:
    """struct<x, y, side, reason> of a square moved and shrunk into the frame.

    reason: null, shrunk_to_frame, below_min_crop_px or shrunk_below_min_crop_px.
    """
    limit = F.least(width, height).cast("double")
    shrunk = side > limit
    s = F.when(shrunk, limit).otherwise(side)
    x = F.least(F.greatest(cx - s / 2, F.lit(0.0)), width - s)
    y = F.least(F.greatest(cy - s / 2, F.lit(0.0)), height - s)
    reason = (
        F.when(shrunk & (s < min_crop), "shrunk_below_min_crop_px").when(s < min_crop, "below_min_crop_px").when(shrunk, "shrunk_to_frame")
    )
    return F.struct(x.alias("x"), y.alias("y"), s.alias("side"), reason.alias("reason"))


def to_render(value: Column, origin: Column, side: Column) -> Column:
    return F.try_divide(value - origin, side) * RENDER_SIZE


def smooth_span(n: Column, span: int, frac: float) -> Column:
    """Odd length of the moving average over n values."""
    s = F.least(F.lit(span), F.greatest(F.lit(3), F.floor(n * frac).cast("int")))
    return F.when(s % 2 == 0, s + 1).otherwise(s)


def rescale(value: Column, source: Column, decoded: Column) -> Column:
    """A coordinate of the decoded frame in source pixels; decoded sizes are even."""
    return value * F.try_divide(source.cast("double"), (decoded.cast("long").bitwiseAND(F.lit(-2).cast("long"))).cast("double"))


# ---------------------------------------------------------------- render plan


def render_command(cfg: RenderConfig = RenderConfig()) -> Column:
    """Arguments of one window's render, from path, start_frame_abs, bx, by, b_side."""
    side, x, y = even_floor("b_side"), F.bround("bx").cast("long"), F.bround("by").cast("long")
    crop = F.format_string("crop=%d:%d:%d:%d,scale=%d:%d", side, side, x, y, F.lit(cfg.size), F.lit(cfg.size))
    words = [
        F.lit("ffmpeg"), F.lit("-y"), F.lit("-ss"), F.format_string("%.6f", seek_seconds("start_frame_abs", cfg.fps)), F.lit("-i"), F.col("path"),
        F.lit("-vf"), crop, F.lit("-frames:v"), F.lit(str(cfg.frames)), F.lit("-r"), F.lit(f"{cfg.fps:g}"), F.lit("-map"), F.lit("0:v:0"),
        F.lit("-map"), F.lit("0:a:0?"), F.lit("-c:v"), F.lit("libx264"), F.lit("-crf"), F.lit(str(cfg.crf)), F.lit("-preset"), F.lit(cfg.preset),
        F.lit("-threads"), F.lit(str(cfg.threads)), F.lit("-ar"), F.lit(str(cfg.audio_rate)),
    ]
    return F.array(*words)


def normalize_command(cfg: NormalizeConfig = NormalizeConfig()) -> Column:
    """Arguments that copy or transcode one file, from src, dst and mode."""
    copy = F.array(*(F.lit(x) for x in ("-c:v", "copy")))
    encode = F.array(*(F.lit(x) for x in ("-vf", f"fps={cfg.fps:g}", "-c:v", "libx264", "-crf", "16", "-preset", "veryfast", "-threads", "1")))
    head = F.array(F.lit("ffmpeg"), F.lit("-y"), F.lit("-i"), F.col("src"))
    audio = F.array(*(F.lit(x) for x in ("-ar", "16000", "-ac", "1")))
    return F.concat(head, F.when(F.col("mode") == "copy", copy).otherwise(encode), audio, F.array(F.concat("dst", F.lit(".part"))))
