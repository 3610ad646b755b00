"""Schemas of the relations that stages exchange."""

from __future__ import annotations

from pyspark.sql.types import StructType, _parse_datatype_string

KEYPOINT = "struct<x: double, y: double, conf: double>"
BOX = f"struct<x1: double, y1: double, x2: double, y2: double, conf: double, kpt: array<{KEYPOINT}>>"

CANDIDATES = "pos bigint, video_id string"
MEDIA_INFO = "video_id string, formats array<struct<vcodec: string, height: int>>"
PROBES = "video_id string, side string, json string"
VIDEOS = (
    "video_id string, path string, parent_size_bytes bigint, parent_md5_16k string, width int, height int, "
    "fps float, parent_n_frames bigint, orig_fps float"
)
FRAME_DETECTIONS = f"video_id string, frame_idx int, frame_w int, frame_h int, dets array<{BOX}>"
DETECTIONS = (
    "video_id string, frame_idx int, n_persons int, hfrac double, hands tinyint, conf double, "
    f"cx double, cy double, w double, h double, kpt array<{KEYPOINT}>"
)
MANIFEST = (
    "segment_uid string, video_id string, seg_index int, path string, parent_size_bytes bigint, parent_md5_16k string, "
    "parent_n_frames bigint, start_frame bigint, end_frame bigint, n_frames int, n_windows int, track_stride tinyint, "
    "track_frames array<int>, track_cx array<float>, track_cy array<float>, track_w array<float>, track_h array<float>, "
    "track_conf array<float>, track_hands array<tinyint>, n_bridged_gaps int, max_gap_frames int, hands_usable_mean float, "
    "wrist_motion_p75 float, body_motion_median float, height_frac_median float, n_persons_max int, kept boolean, "
    "drop_reason string, width int, height int, fps float, orig_fps float, status string, n_segments int, "
    "stage1_version string, stage1_param_hash string, model_name string, created_utc string, bx float, by float, "
    "b_side float, body_side_px float, wrist_reach_px float, body_coverage_frac float, body_max_drift_px float, "
    "geom_valid boolean, geom_drop_reason string"
)
KEYPOINTS = (
    "segment_uid string, video_id string, track_frames array<int>, n_detections int, kpt_layout string, "
    "n_keypoints tinyint, kpt_x array<float>, kpt_y array<float>, kpt_conf array<float>"
)
RENDER_MANIFEST = (
    "window_uid string, segment_uid string, video_id string, path string, start_frame_abs bigint, bx double, by double, "
    "b_side double, face_height_render double, width int, height int, fps float"
)
PREVIEW = (
    "video_id string, resolution string, fps double, num_segments bigint, num_segments_kept bigint, "
    "total_kept_frames bigint, n_windows_total bigint, segments string, status string"
)


def parse(ddl: str) -> StructType:
    """A StructType of one of the texts above (needs an active session)."""
    return _parse_datatype_string(ddl)


def conform(rows, ddl: str):
    """rows with exactly the columns and types of a schema; missing columns are null."""
    from pyspark.sql import functions as F

    have = set(rows.columns)
    return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in parse(ddl)))
