"""Deterministic stand-ins for tracking relations, made from the star-schema tables.

Real inputs (frames, probes, media listings) have no table here, so each operator runs on
a relation whose columns are exact arithmetic over table columns.  The SQL texts below make
the same relations in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DetectConfig, WindowConfig
from ..operators import series

DETECT = DetectConfig(frame_stride=1, min_segment_frames=24, motion_min=0.5, hand_motion_min=0.6, min_crop_px=128)
WINDOW = WindowConfig(window_frames=20, min_face_size_px=60.0, max_shoulder_tilt=0.12, min_wrist_presence_frac=0.6, headroom_min=20.0, headroom_max=300.0)
WIDTH, HEIGHT = 1920, 1080


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections: a user's events are a video's, the hour is the frame, the last event of an hour counts."""
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("video_id"),
        F.expr("timestampdiff(HOUR, timestamp_ntz'2024-01-01 00:00:00', ts)").alias("frame_idx"),
        F.col("event_id").alias("e"),
        F.col("value").alias("cx"),
    )
    rows = rows.groupBy("video_id", "frame_idx").agg(F.max_by("cx", "e").alias("cx"), F.max("e").alias("e"))
    e = F.col("e")
    part = lambda m, d: (e % m) / F.lit(float(d))
    return rows.select(
        "video_id", "frame_idx", "e", "cx",
        (F.col("cx") * 0.5 + 200.0 + e % 50).alias("cy"), (F.lit(40.0) + e % 30).alias("w"), (F.lit(80.0) + e % 60).alias("h"),
        part(100, 100).alias("conf"), (e % 3).alias("hands"), part(80, 160).alias("hfrac"), (e % 4 + 1).alias("n_persons"),
    )


#: point: (x, y, confidence) over cx, cy and e, in both dialects
POINTS = {
    "ls": ("cx - 20", "cy + e % 7", "(e % 10) / 10.0 + 0.25"),
    "rs": ("cx + 20", "cy + e % 11", "(e % 9) / 10.0 + 0.3"),
    "lw": ("cx - 30 - e % 13", "cy + 40", "(e % 8) / 10.0"),
    "rw": ("cx + 30 + e % 17", "cy + 45", "(e % 6) / 10.0"),
    "nose": ("cx", "cy - 30 - e % 5", "e * 0 + 0.9"),
}
_PLACE = {"nose": 0, "ls": 5, "rs": 6, "lw": 9, "rw": 10}


def _double(text: str) -> str:
    """Spark reads decimal literals as decimals; these are doubles."""
    import re

    return re.sub(r"(\d+\.\d+)", r"\1D", text)


def with_points(rows: DataFrame) -> DataFrame:
    """Adds each point's columns and the keypoint array."""
    out = rows.select(*rows.columns, *(F.expr(f"cast({_double(t)} as double)").alias(f"{p}_{c}") for p, v in POINTS.items() for c, t in zip("xyc", v)))
    by_place = {k: p for p, k in _PLACE.items()}
    point = lambda k: (
        F.struct(*(F.col(f"{by_place[k]}_{c}").alias(n) for c, n in zip("xyc", ("x", "y", "conf"))))
        if k in by_place
        else F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("conf"))
    )
    return out.withColumn("kpt", F.array(*(point(k) for k in range(17))))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.sessionize(track(spark, sf_dir), DETECT.frame_stride, DETECT.gap_tolerance)


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with boxes: an order's lines are a frame's boxes, 100 by 60 pixels."""
    p, s, n = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    a = p * 7 + s * 3 + n
    kpt = F.array(
        *(
            F.struct(((a * (k + 3)) % 100).cast("double").alias("x"), ((a * (k + 5)) % 60).cast("double").alias("y"), (((a * (k + 1)) % 100) / 100.0).alias("conf"))
            for k in range(17)
        )
    )
    x1, y1 = (a % 40).cast("double"), (a % 20).cast("double")
    box = F.struct(x1.alias("x1"), y1.alias("y1"), (x1 + 10 + F.col("l_quantity")).alias("x2"), (y1 + a % 41).alias("y2"), ((a % 97) / 96.0).alias("conf"), kpt.alias("kpt"))
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("frame_idx"))
    return rows.agg(F.collect_list(box).alias("dets")).withColumn("frame_w", F.lit(100)).withColumn("frame_h", F.lit(60))


TRACK_SQL = """
tr AS (
  SELECT user_id AS video_id, CAST(floor(epoch(ts) / 3600) AS BIGINT) - 473352 AS frame_idx, arg_max(value, event_id) AS cx, max(event_id) AS e
  FROM events GROUP BY 1, 2
), t AS (
  SELECT *, cx * 0.5 + 200.0 + e % 50 AS cy, CAST(40.0 + e % 30 AS DOUBLE) AS w, CAST(80.0 + e % 60 AS DOUBLE) AS h, (e % 100) / 100.0 AS conf,
         e % 3 AS hands, (e % 80) / 160.0 AS hfrac, e % 4 + 1 AS n_persons FROM tr
), st AS (SELECT *, frame_idx - lag(frame_idx) OVER (PARTITION BY video_id ORDER BY frame_idx) AS step FROM t),
sess AS (
  SELECT *, CAST(sum(CASE WHEN step <= 16 THEN 0 ELSE 1 END) OVER (PARTITION BY video_id ORDER BY frame_idx) - 1 AS INTEGER) AS seg_index,
         CASE WHEN step <= 16 THEN greatest(step - 1, 0) ELSE 0 END AS gap FROM st
)"""

SEGMENT_SQL = f"""{TRACK_SQL}, seg AS (
  SELECT printf('%d_seg%04d', video_id, seg_index) AS segment_uid, video_id, seg_index, min(frame_idx) AS start_frame, max(frame_idx) AS end_frame,
         max(frame_idx) - min(frame_idx) + 1 AS n_frames, count(*) AS n_detections, count(*) FILTER (WHERE gap > 0) AS n_bridged_gaps,
         max(gap) AS max_gap_frames
  FROM sess GROUP BY video_id, seg_index
)"""

POINT_SQL = "SELECT *, " + ", ".join(f"CAST({t} AS DOUBLE) AS {p}_{c}" for p, v in POINTS.items() for c, t in zip("xyc", v)) + " FROM sess"

DENSE_SQL = f"""{TRACK_SQL}, d0 AS (
  SELECT video_id, seg_index, frame_idx, cx, cy, h, lead(frame_idx) OVER w AS nf, lead(cx) OVER w AS ncx, lead(cy) OVER w AS ncy, lead(h) OVER w AS nh,
         count(*) OVER (PARTITION BY video_id, seg_index) AS n
  FROM sess WINDOW w AS (PARTITION BY video_id, seg_index ORDER BY frame_idx)
), d1 AS (SELECT *, unnest(generate_series(frame_idx, coalesce(nf - 1, frame_idx))) AS f FROM d0 WHERE n >= 2),
dense AS (
  SELECT video_id, seg_index, f AS frame_idx, coalesce(cx + (ncx - cx) * (CAST(f - frame_idx AS DOUBLE) / (nf - frame_idx)), cx) AS cx,
         coalesce(cy + (ncy - cy) * (CAST(f - frame_idx AS DOUBLE) / (nf - frame_idx)), cy) AS cy,
         coalesce(h + (nh - h) * (CAST(f - frame_idx AS DOUBLE) / (nf - frame_idx)), h) AS h
  FROM d1
)"""


def _mean(v: str) -> str:
    return f"unnest([list_sum([l{v}[greatest(1, least(n, j + 1))] FOR j IN range(i - p, i + p + 1)]) / (2 * p + 1) FOR i IN range(n)]) AS {v}"


SMOOTH_SQL = f"""{DENSE_SQL}, lists AS (
  SELECT video_id, seg_index, list(frame_idx ORDER BY frame_idx) AS lf, list(cx ORDER BY frame_idx) AS lcx, list(cy ORDER BY frame_idx) AS lcy,
         list(h ORDER BY frame_idx) AS lh, count(*) AS n, least(25, greatest(3, count(*))) // 2 AS p
  FROM dense GROUP BY 1, 2
), smooth AS (SELECT video_id, seg_index, unnest(lf) AS frame_idx, {_mean("cx")}, {_mean("cy")}, {_mean("h")} FROM lists)"""

FRAME_SQL = """
b AS (SELECT l_orderkey AS frame_idx, l_partkey * 7 + l_suppkey * 3 + l_linenumber AS a, l_quantity AS q FROM lineitem),
box AS (
  SELECT frame_idx, a, CAST(a % 40 AS DOUBLE) AS x1, CAST(a % 20 AS DOUBLE) AS y1, CAST(a % 40 AS DOUBLE) + 10 + q AS x2,
         CAST(a % 20 AS DOUBLE) + a % 41 AS y2, (a % 97) / 96.0 AS conf FROM b
)"""
