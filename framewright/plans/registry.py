"""Registered queries of the tracking operators, each with equivalent DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DetectConfig
from ..functions import exprs as X
from ..operators import decide, geometry, ingest, normalize, report, series, shard, windows
from ..sources import external
from ..streaming import segments as stream
from . import proxies as P

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its name, with the SQL that gives the same rows."""

    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _long(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


def _round(names, n: int = 4):
    """Rounded columns; the offset keeps exact ties, on which engines differ, from being ties."""
    return [F.round(F.col(c) + 1e-9, n).alias(c) for c in names]


# ---------------------------------------------------------------- series


@query(f"WITH {P.SEGMENT_SQL} SELECT segment_uid, video_id, seg_index, start_frame, end_frame, n_frames, n_detections FROM seg")
def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = series.segments(P.sessions(spark, sf_dir), 1)
    return out.select("segment_uid", "video_id", "seg_index", "start_frame", "end_frame", "n_frames", "n_detections")


@query(f"WITH {P.SEGMENT_SQL} SELECT segment_uid, n_bridged_gaps, CAST(max_gap_frames AS BIGINT) AS max_gap_frames FROM seg")
def gap_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.segments(P.sessions(spark, sf_dir), 1).select("segment_uid", "n_bridged_gaps", "max_gap_frames")


_POINT_LIST = ["ls", "rs", "lw", "rw", "nose"]
_MOTION_SQL = f"""{P.SEGMENT_SQL}, pt AS ({P.POINT_SQL}), pr AS (
  SELECT *, greatest(lag(sqrt(w * w + h * h)) OVER o, 1.0) AS pd, {", ".join(f"lag({p}_{c}) OVER o AS p_{p}_{c}" for p in _POINT_LIST for c in "xyc")}
  FROM pt WINDOW o AS (PARTITION BY video_id, seg_index ORDER BY frame_idx)
), mo AS (
  SELECT *, {", ".join(f"CASE WHEN {p}_c >= 0.5 AND p_{p}_c >= 0.5 THEN (abs({p}_x - p_{p}_x) + abs({p}_y - p_{p}_y)) / 2 END AS m_{p}" for p in _POINT_LIST)} FROM pr
), mv AS (
  SELECT video_id, seg_index,
    list_avg(list_filter([m_nose, m_ls, m_rs, m_lw, m_rw], lambda x: x IS NOT NULL)) / pd AS body,
    list_avg(list_filter([m_lw, m_rw], lambda x: x IS NOT NULL)) / pd AS wrist FROM mo
), mf AS (
  SELECT video_id, seg_index, coalesce(median(body), 0.0) AS body_motion_median, coalesce(quantile_cont(wrist, 0.75), 0.0) AS wrist_motion_p75 FROM mv GROUP BY 1, 2
)"""


def _moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = series.motion(P.with_points(P.sessions(spark, sf_dir)), P.DETECT)
    return series.segments(moved, 1, *series.motion_figures(P.DETECT))


@query(f"WITH {_MOTION_SQL} SELECT video_id, seg_index, round(body_motion_median + 1e-9, 4) AS body_motion_median, round(wrist_motion_p75 + 1e-9, 4) AS wrist_motion_p75 FROM mf")
def motion_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moved(spark, sf_dir).select("video_id", "seg_index", *_round(["body_motion_median", "wrist_motion_p75"]))


@query(
    f"""WITH {_MOTION_SQL} SELECT segment_uid, n_frames, reason AS drop_reason, reason = '' AS kept FROM (
  SELECT *, CASE WHEN n_frames < {P.DETECT.min_segment_frames} THEN 'too_short' WHEN body_motion_median < {P.DETECT.motion_min} THEN 'low_motion'
    WHEN wrist_motion_p75 < {P.DETECT.hand_motion_min} THEN 'low_hand_motion' ELSE '' END AS reason FROM seg JOIN mf USING (video_id, seg_index))"""
)
def segment_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _moved(spark, sf_dir).withColumn("drop_reason", series.segment_verdict(P.DETECT, geometry=False))
    return out.select("segment_uid", "n_frames", "drop_reason", (F.col("drop_reason") == "").alias("kept"))


@query(f"WITH {P.SEGMENT_SQL} SELECT video_id, start_frame, end_frame, n_detections FROM seg")
def session_window_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream.session_segments(P.track(spark, sf_dir), 1, P.DETECT.gap_tolerance)


@query(
    f"WITH {P.TRACK_SQL} SELECT video_id, CAST(frame_idx // 20 AS INTEGER) AS window, count(*) AS n_detections FROM t GROUP BY 1, 2"
)
def tumbling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream.tumbling_counts(P.track(spark, sf_dir), 20)


@query(f"WITH {P.DENSE_SQL} SELECT video_id, seg_index, frame_idx, round(cx + 1e-9, 4) AS cx, round(cy + 1e-9, 4) AS cy, round(h + 1e-9, 4) AS h FROM dense")
def dense_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = series.densify(P.sessions(spark, sf_dir), ["cx", "cy", "h"])
    return out.select("video_id", "seg_index", "frame_idx", *_round(["cx", "cy", "h"]))


@query(f"WITH {P.SMOOTH_SQL} SELECT video_id, seg_index, frame_idx, round(cx + 1e-9, 4) AS cx, round(cy + 1e-9, 4) AS cy, round(h + 1e-9, 4) AS h FROM smooth")
def smoothed_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    dense = series.densify(P.sessions(spark, sf_dir), ["cx", "cy", "h"])
    out = series.moving_average(dense, series.SEGMENT, "frame_idx", ["cx", "cy", "h"], 25)
    return out.select("video_id", "seg_index", "frame_idx", *_round(["cx", "cy", "h"]))


_GEOMETRY_SQL = f"""{P.SMOOTH_SQL}, pt AS ({P.POINT_SQL}), ds AS (
  SELECT video_id, seg_index, unnest([CASE WHEN lw_c > 0.3 THEN sqrt((lw_x - cx) * (lw_x - cx) + (lw_y - cy) * (lw_y - cy)) END,
    CASE WHEN rw_c > 0.3 THEN sqrt((rw_x - cx) * (rw_x - cx) + (rw_y - cy) * (rw_y - cy)) END]) AS d FROM pt
), reach AS (SELECT video_id, seg_index, coalesce(quantile_cont(d, 0.95), 0.0) AS reach FROM ds GROUP BY 1, 2),
mid AS (SELECT video_id, seg_index, median(cx) AS mx, median(cy) AS my, median(h) * 1.8 AS base FROM smooth GROUP BY 1, 2),
bx0 AS (SELECT *, greatest(base, 2 * reach * 1.1) AS want FROM reach LEFT JOIN mid USING (video_id, seg_index)),
bx1 AS (SELECT *, least(want, 1080.0) AS side FROM bx0),
bx2 AS (SELECT *, least(greatest(mx - side / 2, 0.0), 1920 - side) AS bx, least(greatest(my - side / 2, 0.0), 1080 - side) AS oy FROM bx1),
fit AS (
  SELECT video_id, seg_index, avg(CASE WHEN cx - h / 2 >= bx AND cx + h / 2 <= bx + side AND cy - h / 2 >= oy AND cy + h / 2 <= oy + side THEN 1 ELSE 0 END) AS cover,
         greatest(max(abs(cx - mx)), max(abs(cy - my))) AS drift
  FROM smooth JOIN bx2 USING (video_id, seg_index) WHERE mx IS NOT NULL GROUP BY 1, 2
)"""


@query(
    f"""WITH {_GEOMETRY_SQL} SELECT video_id, seg_index, CASE WHEN ok THEN round(bx + 1e-9, 4) END AS bx, CASE WHEN ok THEN round(oy + 1e-9, 4) END AS "by",
  CASE WHEN ok THEN round(side + 1e-9, 4) END AS b_side, CASE WHEN ok THEN round(reach + 1e-9, 4) ELSE 0 END AS wrist_reach_px,
  CASE WHEN ok THEN round(cover + 1e-9, 4) ELSE 0 END AS body_coverage_frac, CASE WHEN ok THEN round(drift + 1e-9, 4) ELSE 0 END AS body_max_drift_px, ok AS geom_valid,
  CASE WHEN mx IS NULL THEN 'insufficient_box_track' WHEN side < 128 THEN 'body_below_min_crop_px' WHEN want > 1080 THEN 'shrunk_to_frame' END AS geom_drop_reason
  FROM (SELECT *, mx IS NOT NULL AND side >= 128 AS ok FROM bx2 LEFT JOIN fit USING (video_id, seg_index))"""
)
def crop_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.with_points(P.sessions(spark, sf_dir)).withColumn("width", F.lit(P.WIDTH)).withColumn("height", F.lit(P.HEIGHT))
    out = geometry.segment_geometry(rows, cfg=P.DETECT)
    figures = ["bx", "by", "b_side", "wrist_reach_px", "body_coverage_frac", "body_max_drift_px"]
    return out.select("video_id", "seg_index", *_round(figures), "geom_valid", "geom_drop_reason")


@query(
    f"""WITH {P.TRACK_SQL} SELECT video_id, seg_index, string_agg(CAST(frame_idx AS VARCHAR), ',' ORDER BY frame_idx) AS track_frames,
  string_agg(CAST(hands AS VARCHAR), ',' ORDER BY frame_idx) AS track_hands, count(*) AS n FROM sess GROUP BY 1, 2"""
)
def collect_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = series.collect_tracks(P.sessions(spark, sf_dir), {"hands": "tinyint", "cx": "float"})
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return out.select("video_id", "seg_index", text("track_frames"), text("track_hands"), F.size("track_cx").cast("long").alias("n"))


@query(
    "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE r = 1"
)
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.first_occurrences(P.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


@query(
    """SELECT user_id, CAST(floor(epoch(ts) / 3600) AS BIGINT) - 473352 AS frame_idx, arg_max(event_type, event_id) AS event_type
  FROM events GROUP BY 1, 2"""
)
def unique_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("video_id"), F.expr("timestampdiff(HOUR, timestamp_ntz'2024-01-01 00:00:00', ts)").alias("frame_idx"), "event_id", "event_type"
    )
    out = series.unique_frames(rows, "event_id")
    return out.select(F.col("video_id").alias("user_id"), "frame_idx", "event_type")


# ---------------------------------------------------------------- frames

_HAND = """
CASE WHEN k{w} >= 50 AND x{w} - r{w} >= 0.6 AND x{w} + r{w} <= 99.4 AND y{w} - r{w} >= 0.6 AND y{w} + r{w} <= 59.4 THEN 1 ELSE 0 END"""
_KPT_SQL = f"""{P.FRAME_SQL}, kp AS (
  SELECT *, y2 - y1 AS bh, {", ".join(f"(a * {k + 1}) % 100 AS k{k}, CAST((a * {k + 3}) % 100 AS DOUBLE) AS x{k}, CAST((a * {k + 5}) % 60 AS DOUBLE) AS y{k}" for k in range(17))} FROM box
), rad AS (
  SELECT *, greatest(4.0, CASE WHEN k7 >= 50 THEN 0.75 * sqrt((x9 - x7) * (x9 - x7) + (y9 - y7) * (y9 - y7)) ELSE 0.11 * bh END) AS r9,
            greatest(4.0, CASE WHEN k8 >= 50 THEN 0.75 * sqrt((x10 - x8) * (x10 - x8) + (y10 - y8) * (y10 - y8)) ELSE 0.11 * bh END) AS r10 FROM kp
), hd AS (SELECT *, {_HAND.format(w=9)} + {_HAND.format(w=10)} AS hands FROM rad)"""


@query(f"WITH {_KPT_SQL} SELECT frame_idx, CAST(hands AS BIGINT) AS hands, count(*) AS n FROM hd GROUP BY 1, 2")
def usable_hands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.frames(spark, sf_dir).select("frame_idx", "frame_w", "frame_h", F.explode("dets").alias("d"))
    hands = decide.usable_hands(F.col("d.kpt"), F.col("d.y2") - F.col("d.y1"), F.col("frame_w"), F.col("frame_h"))
    return rows.select("frame_idx", hands.cast("long").alias("hands")).groupBy("frame_idx", "hands").agg(F.count("*").alias("n"))


@query(
    f"""WITH {_KPT_SQL}, kept AS (
  SELECT *, bh / 60 AS hf, greatest(bh, 1.0) * greatest(x2 - x1, 1.0) AS area FROM hd WHERE conf >= 0.3
), f AS (
  SELECT frame_idx, count(*) AS n_persons, max(hf) AS hfrac, count(*) FILTER (WHERE hf >= 0.45) AS tall, list(area ORDER BY area DESC) AS areas,
    {", ".join(f"max({c}) FILTER (WHERE hf >= 0.45) AS {c}" for c in ["area", "hands", "conf", *(f"k{k}" for k in range(17))])} FROM kept GROUP BY 1
), every AS (SELECT DISTINCT frame_idx FROM box), v AS (
  SELECT e.frame_idx, coalesce(n_persons, 0) AS n_persons, coalesce(hfrac, 0.0) AS hfrac, hands, conf, CASE
    WHEN f.frame_idx IS NULL THEN 'low_conf' WHEN tall = 0 THEN 'no_prominent' WHEN tall > 1 THEN 'multi_prominent'
    WHEN n_persons >= 2 AND NOT (area >= areas[1] AND area >= 1.6 * greatest(areas[2], 1.0)) THEN 'not_dominant'
    WHEN NOT ((k0 >= 50 OR (k1 >= 50 AND k2 >= 50) OR k3 >= 50 OR k4 >= 50) AND (k5 >= 50 OR k6 >= 50)) THEN 'no_face_or_shoulder'
    WHEN NOT (k9 >= 50 OR k10 >= 50) THEN 'no_wrist' WHEN hands < 1 THEN 'hand_cropped'
    WHEN (k13 >= 50)::INT + (k14 >= 50)::INT + (k15 >= 50)::INT + (k16 >= 50)::INT >= 2 THEN 'full_body' ELSE 'ok' END AS reason
  FROM every e LEFT JOIN f USING (frame_idx)
) SELECT frame_idx, reason, CAST(n_persons AS BIGINT) AS n_persons, round(hfrac, 6) AS hfrac,
  CAST(CASE WHEN reason = 'ok' THEN hands ELSE 0 END AS BIGINT) AS hands, round(CASE WHEN reason = 'ok' THEN conf ELSE 0 END, 6) AS conf FROM v"""
)
def frame_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decide.decide_frames(P.frames(spark, sf_dir))
    return _long(out.select("frame_idx", "reason", "n_persons", F.round("hfrac", 6).alias("hfrac"), "hands", F.round("conf", 6).alias("conf")), "n_persons", "hands")


@query(f"WITH {P.FRAME_SQL} SELECT count(DISTINCT frame_idx) AS frames, count(*) AS boxes FROM box WHERE frame_idx % 4 = 0")
def sampled_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decide.sampled(P.frames(spark, sf_dir), 4)
    return out.agg(F.count("*").alias("frames"), F.sum(F.size("dets")).alias("boxes"))


# ---------------------------------------------------------------- windows


def _windows(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    from dataclasses import replace

    from pyspark.sql import Window

    sessions = P.with_points(P.sessions(spark, sf_dir))
    segs = series.segments(sessions, 1).select("segment_uid", "video_id", "seg_index", "start_frame", "n_frames")
    segs = segs.withColumn("width", F.lit(P.WIDTH)).withColumn("height", F.lit(P.HEIGHT))
    order = Window.partitionBy("video_id", "seg_index").orderBy("frame_idx")
    rows = sessions.withColumn("segment_uid", X.segment_uid("video_id", "seg_index")).withColumn("i", F.row_number().over(order) - 1)
    points = [f"{p}_{c}" for p in P.POINTS for c in "xyc"]
    return windows.gate_windows(segs, rows.select("segment_uid", "i", "frame_idx", "cx", "cy", "h", *points), replace(P.WINDOW, index_mode=mode, frame_stride=4 if mode == "frame" else 1))


def _window_sql(place: str, needed: str) -> str:
    w = P.WINDOW
    return f"""{P.SEGMENT_SQL}, pt AS ({P.POINT_SQL}), ix AS (
  SELECT *, row_number() OVER (PARTITION BY video_id, seg_index ORDER BY frame_idx) - 1 AS i FROM pt
), wn AS (SELECT ix.*, CAST(floor({place} / {w.window_frames}) AS INTEGER) AS win FROM ix JOIN (SELECT video_id, seg_index, start_frame FROM seg) USING (video_id, seg_index)),
ws AS (
  SELECT video_id, seg_index, win, list(cx ORDER BY i) AS lcx, list(cy ORDER BY i) AS lcy, list(h ORDER BY i) AS lh, count(*) AS n,
    count(*) FILTER (WHERE ls_c > {w.kpt_conf} AND rs_c > {w.kpt_conf}) AS n_sh,
    median(abs(ls_y - rs_y) / greatest(abs(ls_x - rs_x), 1.0)) FILTER (WHERE ls_c > {w.kpt_conf} AND rs_c > {w.kpt_conf}) AS tilt,
    avg(CASE WHEN lw_c > {w.wrist_conf_min} OR rw_c > {w.wrist_conf_min} THEN 1 ELSE 0 END) AS share,
    median(greatest(ls_y, rs_y) - nose_y) AS face, median(nose_y) AS nose
  FROM wn GROUP BY 1, 2, 3
), sm AS (
  SELECT video_id, seg_index, win, {", ".join(f"list_median([list_sum([l{v}[greatest(1, least(n, j + 1))] FOR j IN range(i - 10, i + 11)]) / 21 FOR i IN range(n)]) AS m{v}" for v in ("cx", "cy", "h"))} FROM ws
), pts AS (
  SELECT video_id, seg_index, win, unnest([lw_x, rw_x]) AS x, unnest([lw_y, rw_y]) AS y, unnest([lw_c, rw_c]) AS c, cx, cy FROM wn
), good AS (SELECT * FROM pts WHERE c > {w.wrist_conf_min}),
rc AS (SELECT video_id, seg_index, win, quantile_cont(sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)), 0.95) AS reach FROM good GROUP BY 1, 2, 3),
b0 AS (SELECT *, greatest(mh * {w.crop_scale}, 2 * coalesce(reach, 0.0) * {1 + w.hand_margin_frac}) AS want FROM ws JOIN sm USING (video_id, seg_index, win) LEFT JOIN rc USING (video_id, seg_index, win)),
b1 AS (SELECT *, least(want, 1080.0) AS side FROM b0),
b2 AS (SELECT *, least(greatest(mcx - side / 2, 0.0), 1920 - side) AS bx, least(greatest(mcy - side / 2, 0.0), 1080 - side) AS oy FROM b1),
cl AS (
  SELECT video_id, seg_index, win, avg(CASE WHEN x < bx OR x > bx + side OR y < oy OR y > oy + side THEN 1 ELSE 0 END) AS clipped
  FROM good JOIN b2 USING (video_id, seg_index, win) GROUP BY 1, 2, 3
), allw AS (SELECT *, unnest(range(n_frames // {w.window_frames})) AS win FROM seg),
j AS (SELECT allw.segment_uid, allw.start_frame, allw.win, b2.* EXCLUDE (video_id, seg_index, win), clipped FROM allw LEFT JOIN b2 USING (video_id, seg_index, win) LEFT JOIN cl USING (video_id, seg_index, win)),
gated AS (
  SELECT *, face / side * 512 AS fr, (nose - oy) / side * 512 AS nr, CASE WHEN coalesce(n_sh, 0) < {needed} THEN 'shoulders_not_visible'
    WHEN tilt > {w.max_shoulder_tilt} THEN 'tilted_presenter' WHEN share < {w.min_wrist_presence_frac} THEN 'hands_not_visible_enough'
    WHEN side < {w.min_crop_px} THEN CASE WHEN want > 1080 THEN 'shrunk_below_min_crop_px' ELSE 'below_min_crop_px' END
    WHEN clipped > {w.max_wrist_cutoff_frac} THEN 'wrist_clipped_boundary' WHEN face / side * 512 < {w.min_face_size_px} THEN 'face_too_small_for_lipsync'
    WHEN (nose - oy) / side * 512 < {w.headroom_min} OR (nose - oy) / side * 512 > {w.headroom_max} THEN 'inconsistent_headroom' ELSE 'ok' END AS drop_reason FROM j
)"""


_WINDOW_COLUMNS = ["bx", "by", "b_side", "face_height_render"]
_WINDOW_SELECT = f"""SELECT segment_uid || printf('_w%04d', win) AS window_uid, start_frame + win * {P.WINDOW.window_frames} AS start_frame_abs, drop_reason = 'ok' AS kept, drop_reason,
  CASE WHEN drop_reason = 'ok' THEN round(bx + 1e-9, 4) END AS bx, CASE WHEN drop_reason = 'ok' THEN round(oy + 1e-9, 4) END AS "by", CASE WHEN drop_reason = 'ok' THEN round(side + 1e-9, 4) END AS b_side,
  CASE WHEN drop_reason = 'ok' THEN round(fr + 1e-9, 4) END AS face_height_render FROM gated"""


@query(f"WITH {_window_sql('i', '10.0')} {_WINDOW_SELECT}")
def window_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir, "detection").select("window_uid", "start_frame_abs", "kept", "drop_reason", *_round(_WINDOW_COLUMNS))


@query(f"WITH {_window_sql('(frame_idx - start_frame)', '2.5')} {_WINDOW_SELECT}")
def window_gates_by_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir, "frame").select("window_uid", "start_frame_abs", "kept", "drop_reason", *_round(_WINDOW_COLUMNS))


@query(f"WITH {_window_sql('i', '10.0')} SELECT drop_reason, count(*) AS n FROM gated GROUP BY 1")
def drop_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.drop_histogram(_windows(spark, sf_dir, "detection"))


@query(f"WITH {P.SEGMENT_SQL} SELECT segment_uid || printf('_w%04d', win) AS window_uid, start_frame + win * 20 AS start_frame_abs FROM (SELECT *, unnest(range(n_frames // 20)) AS win FROM seg)")
def window_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    segs = series.segments(P.sessions(spark, sf_dir), 1)
    return windows.slices(segs, P.WINDOW).select("window_uid", "start_frame_abs")


@query(
    """WITH e AS (SELECT vec_id, unnest(embedding[1:51]) AS v, unnest(range(51)) AS p FROM embeddings)
SELECT vec_id, CAST(p // 17 AS BIGINT) AS i, round(sum(CAST(v AS DOUBLE)), 4) AS total, round(max(CAST(v AS DOUBLE)) FILTER (WHERE p % 17 = 9), 6) AS wrist FROM e GROUP BY 1, 2"""
)
def kpt_reshape(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(F.slice("embedding", 1, 51)).alias("p", "v"))
    rows = rows.select("vec_id", F.expr("cast(p div 17 as long)").alias("i"), (F.col("p") % 17).alias("k"), F.col("v").cast("double").alias("v"))
    return rows.groupBy("vec_id", "i").agg(F.round(F.sum("v"), 4).alias("total"), F.round(F.max(F.when(F.col("k") == 9, F.col("v"))), 6).alias("wrist"))


def _flat_keypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened arrays: the first 51 numbers of a vector are 3 detections of 17 points, x; y and conf follow by sums."""
    rows = P.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("segment_uid"), F.slice("embedding", 1, 51).cast("array<double>").alias("kpt_x"))
    shifted = F.transform("kpt_x", lambda v: v + 1), F.transform("kpt_x", lambda v: F.abs(v))
    return rows.select("segment_uid", F.when(F.col("segment_uid") % 5 == 0, 0).otherwise(3).alias("n_detections"), "kpt_x", shifted[0].alias("kpt_y"), shifted[1].alias("kpt_conf"))


_POINT_COLUMNS = {"ls": 5, "rs": 6, "lw": 9, "rw": 10, "nose": 0}
_EXPLODED_SQL = ", ".join(
    f"round(CAST(embedding[i * 17 + {k + 1}] AS DOUBLE), 6) AS {n}_x, round(CAST(embedding[i * 17 + {k + 1}] AS DOUBLE) + 1, 6) AS {n}_y, round(abs(CAST(embedding[i * 17 + {k + 1}] AS DOUBLE)), 6) AS {n}_c"
    for n, k in _POINT_COLUMNS.items()
)


def _exploded_columns() -> list:
    return [F.round(f"{n}_{c}", 6).alias(f"{n}_{c}") for n in _POINT_COLUMNS for c in "xyc"]


@query(f"SELECT vec_id AS segment_uid, i, {_EXPLODED_SQL} FROM embeddings, range(3) r(i) WHERE vec_id % 5 <> 0")
def explode_keypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = windows.explode_keypoints(_flat_keypoints(spark, sf_dir))
    return out.select("segment_uid", F.col("i").cast("long").alias("i"), *_exploded_columns())


@query(
    f"""SELECT vec_id AS segment_uid, i, vec_id + i AS frame_idx, CAST(i * 2 AS DOUBLE) AS cx, CAST(i * 3 AS DOUBLE) AS cy, CAST(i + 50 AS DOUBLE) AS h, {_EXPLODED_SQL}
FROM embeddings, range(3) r(i) WHERE vec_id % 5 <> 0 AND vec_id % 3 = 0"""
)
def segment_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    keypoints = _flat_keypoints(spark, sf_dir)
    series_of = lambda f: F.transform(F.sequence(F.lit(0), F.lit(2)), f)
    manifest = keypoints.select(
        "segment_uid", F.when(F.col("segment_uid") % 3 == 0, "ok").otherwise("no_segments").alias("status"), F.col("segment_uid").alias("start_frame"), F.lit(640).alias("width"), F.lit(360).alias("height"),
        series_of(lambda i: F.col("segment_uid") + i).alias("track_frames"), series_of(lambda i: i * 2.0).cast("array<double>").alias("track_cx"), series_of(lambda i: i * 3.0).cast("array<double>").alias("track_cy"),
        series_of(lambda i: i + 50.0).cast("array<double>").alias("track_h"),
    )
    out = windows.segment_detections(manifest, keypoints)
    return out.select("segment_uid", F.col("i").cast("long").alias("i"), F.col("frame_idx").cast("long").alias("frame_idx"), "cx", "cy", "h", *_exploded_columns())


@query(
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity * sx AS DOUBLE) AS cx, CAST((l_partkey % 60) * sy AS DOUBLE) AS cy, CAST((l_suppkey % 9) * sx AS DOUBLE) AS w, CAST((l_suppkey % 7) * sy AS DOUBLE) AS h,
  CAST((l_partkey % 40) * sx AS DOUBLE) AS nose_x FROM (SELECT *, 1920.0::DOUBLE / (640 + 2 * (l_suppkey % 3)) AS sx, 1080.0::DOUBLE / (360 + 2 * (l_suppkey % 5)) AS sy FROM lineitem)"""
)
def to_source_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded frames have odd sizes here as well: the last bit is cleared before they scale."""
    n = lambda c: c.cast("double")
    s, p = F.col("l_suppkey"), F.col("l_partkey")
    rows = P.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", n(F.col("l_quantity")).alias("cx"), n(p % 60).alias("cy"), n(s % 9).alias("w"), n(s % 7).alias("h"), F.lit(1920).alias("width"), F.lit(1080).alias("height"),
        (640 + 2 * (s % 3) + s % 2).alias("frame_w"), (360 + 2 * (s % 5) + p % 2).alias("frame_h"), F.array(F.struct(n(p % 40).alias("x"), n(p % 60).alias("y"), F.lit(0.5).alias("conf"))).alias("kpt"),
    )
    out = decide.to_source_pixels(rows)
    return out.select("l_orderkey", "l_linenumber", "cx", "cy", "w", "h", F.col("kpt")[0].x.alias("nose_x"))


# ---------------------------------------------------------------- ingest

_TRIAGE_SQL = """tri AS (
  SELECT o_orderkey AS video_id, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49) THEN 'existing'
    WHEN o_orderkey IN (SELECT c_custkey FROM customer) THEN 'archived' WHEN o_orderkey IN (SELECT p_partkey * 3 FROM part) THEN 'low_quality' ELSE 'queued' END AS outcome
  FROM orders)"""


def _triaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: P.table(spark, sf_dir, n)
    return ingest.triage(
        t("orders").select(F.col("o_orderkey").alias("video_id")),
        t("lineitem").where("l_quantity >= 49").select(F.col("l_orderkey").alias("video_id")),
        t("customer").select(F.col("c_custkey").alias("video_id")),
        t("part").select((F.col("p_partkey") * 3).alias("video_id")),
    )


@query(f"WITH {_TRIAGE_SQL} SELECT * FROM tri")
def triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _triaged(spark, sf_dir)


@query(f"WITH {_TRIAGE_SQL} SELECT outcome, count(*) AS n FROM tri GROUP BY 1")
def triage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.counts(_triaged(spark, sf_dir))


@query(
    r"""SELECT page_id, nullif(regexp_extract(url, '(?:^|[^A-Za-z0-9_-])([A-Za-z0-9_-]{11})(?:$|[^A-Za-z0-9_-])', 1), '') AS video_id FROM pages"""
)
def id_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.table(spark, sf_dir, "pages").select("page_id", X.video_id("url").alias("video_id"))


_FORMAT_SQL = """fm AS (
  SELECT l_orderkey AS video_id, CASE l_linenumber % 4 WHEN 0 THEN 'none' WHEN 1 THEN NULL ELSE 'h264' END AS vcodec,
    [240, 480, 720, 1080, 1440, 2160][1 + CAST((l_partkey + l_suppkey) % 6 AS INTEGER)] AS height FROM lineitem)"""


def _formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber") % 4
    sizes = F.array(*(F.lit(h) for h in (240, 480, 720, 1080, 1440, 2160)))
    height = F.get(sizes, ((F.col("l_partkey") + F.col("l_suppkey")) % 6).cast("int"))
    return P.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("video_id"), F.when(n == 0, "none").when(n != 1, "h264").alias("vcodec"), height.alias("height")
    )


@query(
    f"""WITH {_FORMAT_SQL}, v AS (SELECT video_id, CASE WHEN vcodec IS DISTINCT FROM 'none' THEN height END AS h FROM fm),
  g AS (SELECT video_id, coalesce(max(h) FILTER (WHERE h = 1080), max(h) FILTER (WHERE h = 720), min(h) FILTER (WHERE h > 720)) AS chosen_height, max(h) AS best_height FROM v GROUP BY 1)
SELECT video_id, CAST(chosen_height AS BIGINT) AS chosen_height, CAST(best_height AS BIGINT) AS best_height, CASE WHEN chosen_height IS NULL THEN 'low_quality' ELSE 'downloaded' END AS outcome,
  coalesce(best_height || 'p', 'none') AS best_available_resolution FROM g"""
)
def resolution_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = _formats(spark, sf_dir).groupBy("video_id").agg(F.collect_list(F.struct("vcodec", "height")).alias("formats"))
    out = ingest.resolution_ladder(media)
    return _long(out.select("video_id", "chosen_height", "best_height", "outcome", "best_available_resolution"), "chosen_height", "best_height")


@query(
    f"""WITH {_FORMAT_SQL}, v AS (SELECT video_id, CASE WHEN vcodec IS DISTINCT FROM 'none' THEN height END AS h FROM fm)
SELECT video_id, CAST(coalesce(max(h) FILTER (WHERE h = 1080), max(h) FILTER (WHERE h = 720), min(h) FILTER (WHERE h > 720)) AS BIGINT) AS chosen_height, CAST(max(h) AS BIGINT) AS best_height FROM v GROUP BY 1"""
)
def resolution_ladder_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(ingest.ladder_rows(_formats(spark, sf_dir), "video_id"), "chosen_height", "best_height")


# ---------------------------------------------------------------- normalise


def _probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probe documents from order lines: rates, codecs and durations follow from the keys."""
    n = F.col("l_linenumber")
    rate = F.when(n % 5 == 0, "0/0").when(n % 5 == 1, "25/1").when(n % 5 == 2, "30000/1001").when(n % 5 == 3, "bad").otherwise("25/1")
    seconds = (F.col("l_partkey") % 1000).cast("string")
    text = F.concat(
        F.lit('{"streams":[{"codec_type":"video","codec_name":"'), F.when(n % 2 == 0, "vp9").otherwise("h264"), F.lit('","width":'), (F.col("l_suppkey") % 2000 + 1).cast("string"),
        F.lit(',"height":720,"avg_frame_rate":"'), rate, F.lit('","r_frame_rate":"25/1"}'),
        F.when(n % 3 == 0, F.lit("")).otherwise(F.lit(',{"codec_type":"audio","duration":"1.5"}')), F.lit('],"format":{"duration":"'), seconds, F.lit('"}}'),
    )
    return P.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("json"))


_PENDING_BUCKET = "(('0x' || md5(CAST(o_orderkey AS VARCHAR)))::UHUGEINT % 30)::BIGINT"
_PROBE_SQL = """pb AS (
  SELECT l_orderkey, l_linenumber, CASE l_linenumber % 5 WHEN 1 THEN 25.0 WHEN 2 THEN 30000.0 / 1001 WHEN 4 THEN 25.0 END AS avg_fps,
    CAST(l_suppkey % 2000 + 1 AS BIGINT) AS width, CASE WHEN l_linenumber % 2 = 0 THEN 'vp9' ELSE 'h264' END AS codec, l_linenumber % 3 <> 0 AS has_audio,
    CAST(l_partkey % 1000 AS DOUBLE) AS duration FROM lineitem)"""


@query(f"WITH {_PROBE_SQL} SELECT l_orderkey, l_linenumber, round(avg_fps, 6) AS avg_fps, width, codec, has_audio, duration, avg_fps IS NOT NULL AS readable FROM pb")
def probe_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = normalize.flatten_probe(_probes(spark, sf_dir))
    return _long(out.select("l_orderkey", "l_linenumber", F.round("avg_fps", 6).alias("avg_fps"), "width", "codec", "has_audio", "duration", "readable"), "width")


@query(
    f"""WITH {_PROBE_SQL}, p2 AS (SELECT *, coalesce(abs(25.0 - avg_fps) / nullif(avg_fps, 0) > 0.01, TRUE) AS vfr FROM pb)
SELECT l_orderkey, l_linenumber, vfr, CASE WHEN coalesce(abs(avg_fps - 25) < 0.001, FALSE) AND NOT vfr AND codec IN ('h264', 'hevc') THEN 'copy' ELSE 'transcode' END AS mode FROM p2"""
)
def vfr_copy_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.plan(normalize.flatten_probe(_probes(spark, sf_dir))).select("l_orderkey", "l_linenumber", "vfr", "mode")


def _pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Source figures from orders, output figures from each order's first line."""
    one = lambda t: F.lit(t)
    price = F.col("o_totalprice")
    source = P.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("video_id"), one(30.0).alias("avg_fps"), (F.col("o_custkey") % 3).cast("int").alias("width"), one(720).alias("height"),
        F.when(F.col("o_orderkey") % 7 != 0, F.floor(price) / 8).alias("v_duration"), one(1.0).alias("a_duration"), (F.floor(price) / 8 + F.when(F.col("o_orderkey") % 7 != 0, 5.0).otherwise(0.0)).alias("duration"), (F.col("o_orderkey") % 5 != 0).alias("has_audio"),
    )
    lines = P.table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("o"), "l_quantity", "l_partkey", "l_suppkey")
    both = P.table(spark, sf_dir, "orders").join(lines, F.col("o") == F.col("o_orderkey"))
    moved = F.floor(price) / 8 + (F.col("l_partkey") % 9 - 4) / F.lit(32.0)
    output = both.select(
        F.col("o_orderkey").alias("video_id"), (F.lit(25.0) + F.when(F.col("l_suppkey") % 11 == 0, 0.5).otherwise(0.0)).alias("avg_fps"), ((F.col("o_custkey") + F.when(F.col("l_quantity") > 45, 1).otherwise(0)) % 3).cast("int").alias("width"),
        one(720).alias("height"), (moved + 3.0).alias("v_duration"), (moved + 3.0 + (F.col("l_suppkey") % 7) / F.lit(32.0)).alias("a_duration"), moved.alias("duration"), (F.col("o_orderkey") % 5 != 0).alias("has_audio"),
    )
    return source, output


_VERIFY_SQL = """vf AS (
  SELECT o_orderkey AS video_id, o_orderkey % 5 <> 0 AS audio, floor(o_totalprice) / 8 AS sd, floor(o_totalprice) / 8 + (l_partkey % 9 - 4) / 32.0 AS dd, (l_suppkey % 7) / 32.0 AS lead_s, l_suppkey % 11 <> 0 AS fps_ok,
    o_custkey % 3 = (o_custkey + CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END) % 3 AS size_ok FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber = 1
), vr AS (SELECT *, abs(dd - sd) <= 0.08 AS duration_ok, NOT audio OR abs(dd + lead_s - dd) <= 0.1 AS av_ok FROM vf)"""


@query(
    f"""WITH {_VERIFY_SQL} SELECT video_id, fps_ok, duration_ok, av_ok, size_ok, round_even((dd - sd) * 1000, 1) AS dur_delta_ms,
  CASE WHEN audio AND lead_s >= 0 THEN round_even(lead_s * 1000, 1) END AS av_delta_ms, fps_ok AND duration_ok AND av_ok AND size_ok AS verified FROM vr"""
)
def verify_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = normalize.verify(*_pair(spark, sf_dir))
    return out.select("video_id", "fps_ok", "duration_ok", "av_ok", "size_ok", F.round("dur_delta_ms", 1).alias("dur_delta_ms"), "av_delta_ms", "verified")


@query(
    f"""WITH {_PROBE_SQL}, p2 AS (SELECT *, coalesce(abs(25.0 - avg_fps) / nullif(avg_fps, 0) > 0.01, TRUE) AS vfr FROM pb),
p3 AS (SELECT CASE WHEN coalesce(abs(avg_fps - 25) < 0.001, FALSE) AND NOT vfr AND codec IN ('h264', 'hevc') THEN CASE WHEN l_orderkey % 4 = 0 THEN 'copy->transcode' ELSE 'copy' END ELSE 'transcode' END AS mode FROM p2)
SELECT mode, count(*) AS n FROM p3 GROUP BY 1"""
)
def mode_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = normalize.plan(normalize.flatten_probe(_probes(spark, sf_dir)))
    return normalize.histogram(planned.withColumn("mode", normalize.final_mode(F.col("mode"), F.col("l_orderkey") % 4 == 0)), "mode")


@query("SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS ok, count(*) FILTER (WHERE o_orderstatus <> 'F') AS failed, sum(o_custkey % 7)::DOUBLE AS elapsed_s FROM orders")
def render_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = P.table(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") == "F", "ok").otherwise("ffmpeg_failed").alias("status"), (F.col("o_custkey") % 7).cast("double").alias("elapsed_s"))
    return shard.render_counters(log)


@query(
    f"""SELECT window_uid, {_PENDING_BUCKET} AS bucket FROM (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS window_uid FROM orders WHERE o_orderstatus <> 'F')"""
)
def pending_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left to render in all shards, with each window's shard."""
    rows = P.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("window_uid"), F.when(F.col("o_orderstatus") == "F", "ok").otherwise("ffmpeg_failed").alias("status"))
    return shard.pending(rows.select("window_uid"), rows).select("window_uid", X.stable_bucket(F.col("window_uid"), 30).alias("bucket"))


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 1")
def status_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.histogram(P.table(spark, sf_dir, "orders"), "o_orderstatus")


@query(
    """SELECT o_orderkey AS video_id, abs(o_totalprice - 150000) AS delta FROM orders WHERE o_orderstatus = 'F' AND o_totalprice <> 150000
  ORDER BY abs(o_totalprice - 150000) DESC, o_orderkey DESC LIMIT 10"""
)
def worst_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("video_id"), F.when(F.col("o_orderstatus") == "F", "ok").otherwise("failed").alias("status"), (F.col("o_totalprice") - 150000).alias("dur_delta_ms")
    )
    return normalize.worst_deltas(rows)


@query(
    """SELECT o_orderkey, c_custkey, c_mktsegment, r.orig_fps FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN (SELECT user_id, arg_max(value, event_id) AS orig_fps FROM events WHERE value <> 0 GROUP BY 1) r ON o_custkey = r.user_id"""
)
def orig_fps_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = normalize.original_fps(P.table(spark, sf_dir, "events").select(F.col("user_id").alias("video_id"), F.col("value").alias("src_fps"), F.col("event_id").alias("position")))
    videos = P.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("video_id"))
    customers = P.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    out = normalize.with_original_fps(videos, rates)
    return out.join(customers, F.col("video_id") == F.col("c_custkey"), "left").select("o_orderkey", "c_custkey", "c_mktsegment", "orig_fps")


@query("SELECT o_orderkey, o_orderstatus, l_linenumber, l_quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'O'")
def segment_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = P.table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select("o_orderkey", "o_orderstatus")
    rows = P.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    return rows.join(ok, "o_orderkey")


# ---------------------------------------------------------------- shards and reports

_BUCKET = "(('0x' || md5(CAST({k} AS VARCHAR)))::UHUGEINT % {n})::BIGINT"


@query(f"SELECT o_orderkey, {_BUCKET.format(k='o_orderkey', n=30)} AS bucket FROM orders")
def stable_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.table(spark, sf_dir, "orders").select("o_orderkey", X.stable_bucket(F.col("o_orderkey").cast("string"), 30).alias("bucket"))


@query(
    f"""SELECT window_uid, bucket FROM (SELECT CAST(o_orderkey AS VARCHAR) AS window_uid, {_BUCKET.format(k='o_orderkey', n=30)} AS bucket FROM orders)
WHERE bucket = 7 AND window_uid NOT IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F') ORDER BY window_uid LIMIT 100"""
)
def shard_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("window_uid"), F.when(F.col("o_orderstatus") == "F", "ok").otherwise("ffmpeg_failed").alias("status"))
    return shard.shard(rows.select("window_uid"), rows, 7, 30, limit=100)


@query(
    """SELECT user_id AS window_uid, arg_max(event_type, event_id) AS status, max(event_id) AS attempt,
  CASE WHEN arg_max(event_id % 2, event_id) = 0 THEN arg_max(value, event_id) END AS body_side_px FROM events GROUP BY 1"""
)
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.table(spark, sf_dir, "events").select(F.col("user_id").alias("window_uid"), F.col("event_type").alias("status"), F.col("event_id").alias("attempt"), F.col("value").alias("body_side_px"))
    log = shard.append_status(rows.where("attempt % 2 = 0"), rows.where("attempt % 2 = 1").drop("body_side_px"))
    return shard.latest_status(log)


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures = _moved(spark, sf_dir).withColumn("drop_reason", series.segment_verdict(P.DETECT, geometry=False))
    videos = P.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("video_id"), (F.col("c_nationkey") * 10 + 100).alias("width"), F.lit(720).alias("height"), F.lit(25.0).alias("fps"), F.lit(None).cast("string").alias("status"), F.lit(None).cast("string").alias("drop_reason")
    )
    cfg = DetectConfig(window_frames=20)
    return report.with_placeholders(videos, figures.withColumn("kept", F.col("drop_reason") == ""), cfg)


_MANIFEST_SQL = f"""{_MOTION_SQL}, man AS (
  SELECT c_custkey AS video_id, (c_nationkey * 10 + 100) || 'x720' AS resolution, s.segment_uid, s.seg_index, s.start_frame, s.end_frame, s.n_frames, coalesce(s.n_frames // 20, 0) AS n_windows,
    CASE WHEN s.segment_uid IS NULL THEN FALSE ELSE n_frames >= {P.DETECT.min_segment_frames} AND body_motion_median >= {P.DETECT.motion_min} AND wrist_motion_p75 >= {P.DETECT.hand_motion_min} END AS kept,
    CASE WHEN s.segment_uid IS NULL THEN 'no_segments' ELSE 'ok' END AS status
  FROM customer LEFT JOIN (SELECT * FROM seg JOIN mf USING (video_id, seg_index)) s ON c_custkey = s.video_id
)"""


@query(
    f"""WITH {_MANIFEST_SQL} SELECT video_id, resolution, count(segment_uid) AS num_segments, count(*) FILTER (WHERE kept) AS num_segments_kept,
  CAST(coalesce(sum(n_frames) FILTER (WHERE kept), 0) AS BIGINT) AS total_kept_frames, CAST(coalesce(sum(n_windows) FILTER (WHERE kept), 0) AS BIGINT) AS n_windows_total,
  '[' || coalesce(string_agg('(' || start_frame || ',' || end_frame || ')' || CASE WHEN kept THEN '' ELSE '*' END, ',' ORDER BY seg_index) FILTER (WHERE segment_uid IS NOT NULL), '') || ']' AS segments, min(status) AS status
FROM man GROUP BY 1, 2"""
)
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.preview(_manifest(spark, sf_dir)).drop("fps")


@query(
    f"""WITH {_MANIFEST_SQL} SELECT count(DISTINCT video_id) AS videos_scanned, count(DISTINCT CASE WHEN status = 'ok' THEN video_id END) AS videos_ok, count(segment_uid) AS segments_total,
  count(*) FILTER (WHERE kept) AS segments_kept, CAST(coalesce(sum(n_windows) FILTER (WHERE kept), 0) AS BIGINT) AS windows_total, coalesce(round(sum(n_frames) FILTER (WHERE kept) / 25.0 / 3600, 1), 0) AS hours_kept FROM man"""
)
def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.totals(_manifest(spark, sf_dir))


@query(
    """SELECT o_orderkey, 'out/' || substr(uid, 1, 2) || '/' || uid || '/video.mp4' AS path, printf('%.6f', o_custkey / 25.0) AS seek,
  CAST(round_even(o_totalprice / 2, 0) AS BIGINT) - CAST(round_even(o_totalprice / 2, 0) AS BIGINT) % 2 AS side
FROM (SELECT *, printf('%d_seg%04d', o_custkey, CAST(o_orderkey % 10000 AS INTEGER)) AS uid FROM orders)"""
)
def render_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.table(spark, sf_dir, "orders").withColumn("uid", X.segment_uid("o_custkey", F.col("o_orderkey") % 10000))
    rows = rows.select(
        "o_orderkey", X.output_path("out", "uid").alias("path"), F.col("o_custkey").alias("start_frame_abs"), F.lit(0.5).alias("bx"), F.lit(1.5).alias("by"), (F.col("o_totalprice") / 2).alias("b_side")
    ).withColumn("argv", X.render_command())
    side = F.regexp_extract(F.get("argv", F.lit(7)), r"crop=(\d+):", 1).cast("long")
    return rows.select("o_orderkey", "path", F.get("argv", F.lit(3)).alias("seek"), side.alias("side"))


@query(
    """SELECT doc_id, substr(md5(CASE WHEN strlen(text) > 200 THEN encode(text)[1:100] || encode(text)[-100:] ELSE encode(text)[1:100] END || encode(CAST(strlen(text) AS VARCHAR))), 1, 16) AS fingerprint FROM documents"""
)
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("b"))
    return rows.select("doc_id", X.fingerprint("b", F.length("b"), head=100).alias("fingerprint"))


@query("SELECT l_orderkey, l_linenumber, substr('01234', 1, CAST(l_linenumber % 5 + 1 AS INTEGER)) || 'p' AS label, CAST(l_partkey % 2160 AS BIGINT) AS height FROM lineitem")
def resolution_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.table(spark, sf_dir, "lineitem")
    digits = F.substring(F.lit("01234"), F.lit(1), (F.col("l_linenumber") % 5 + 1).cast("int"))
    height = X.resolution_height(X.resolution_label(F.col("l_partkey") % 2160)).cast("long")
    return rows.select("l_orderkey", "l_linenumber", F.concat(digits, F.lit("p")).alias("label"), height.alias("height"))


@query(
    f"WITH {P.TRACK_SQL} SELECT video_id, count(*) AS ok, CAST(0 AS BIGINT) AS failed FROM t GROUP BY 1"
)
def external_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row-to-status boundary with an action that succeeds on its second attempt."""

    def action(row: dict) -> dict:
        if not row.get("again"):
            raise RuntimeError("first attempt")
        return {"status": "ok"}

    rows = P.track(spark, sf_dir).select("video_id")
    out = external.process_each(rows, action, "video_id", retries=1, retry=lambda r: r | {"again": True})
    return out.groupBy(F.col("video_id").cast("long").alias("video_id")).agg(F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") != "ok").alias("failed"))


@query(f"WITH {P.TRACK_SQL} SELECT video_id, frame_idx, round(cx * 2 + 1, 6) AS score FROM t")
def external_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch inference boundary with a linear model that loads once per process."""
    rows = P.track(spark, sf_dir).select("video_id", "frame_idx", "cx")
    out = external.infer(rows, "linear", lambda: (2.0, 1.0), lambda m, pdf: pdf[["video_id", "frame_idx"]].assign(score=pdf["cx"] * m[0] + m[1]), "video_id long, frame_idx long, score double")
    return out.withColumn("score", F.round("score", 6))


@query()
def param_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(DetectConfig().param_hash(), DetectConfig(workers=1).param_hash())], "param_hash string, other_workers string")
