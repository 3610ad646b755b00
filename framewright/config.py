"""Settings of the two analysis stages.

They share names but not values, so they are two classes and never one.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

# The COCO-17 keypoint order
NOSE, LEFT_EYE, RIGHT_EYE, LEFT_EAR, RIGHT_EAR = 0, 1, 2, 3, 4
LEFT_SHOULDER, RIGHT_SHOULDER, LEFT_ELBOW, RIGHT_ELBOW, LEFT_WRIST, RIGHT_WRIST = 5, 6, 7, 8, 9, 10
LOWER_BODY = (13, 14, 15, 16)
KEYPOINTS = 17
FPS = 25.0
FPS_TOLERANCE = 0.01
RENDER_SIZE = 512
#: Settings that change where and how fast a run goes, never what it says.
RUNTIME_KEYS = ("batch_size", "queue_batches", "workers", "half", "overwrite")


@dataclass(frozen=True)
class DetectConfig:
    """Frame decisions, segments, motion and segment crops."""

    frame_stride: int = 4
    batch_size: int = 64
    queue_batches: int = 16
    half: bool = True
    workers: int = 6
    overwrite: bool = False
    person_conf: float = 0.30
    min_height_frac: float = 0.45
    kpt_conf: float = 0.50
    lower_body_conf: float = 0.50
    exclude_full_body: bool = True
    prominence_ratio: float = 1.6
    min_visible_hands: int = 1
    hand_extent_ratio: float = 0.75
    hand_fallback_frac: float = 0.11
    hand_margin_frac: float = 0.01
    hand_radius_min: float = 4.0
    min_segment_frames: int = 104
    gap_tolerance: int = 15
    motion_min: float = 0.0010
    hand_motion_min: float = 0.0050
    hand_motion_pctl: float = 75.0
    crop_scale: float = 1.8
    smooth_span_frac: float = 1.0
    smooth_span_frames: int = 25
    crop_hand_margin: float = 0.10
    wrist_conf_min: float = 0.30
    wrist_percentile: float = 95.0
    min_crop_px: int = 128
    window_frames: int = 100

    def param_hash(self) -> str:
        """First 16 hex digits of the SHA-256 of the sorted settings that matter."""
        kept = {k: v for k, v in asdict(self).items() if k not in RUNTIME_KEYS}
        return hashlib.sha256(json.dumps(kept, sort_keys=True).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class WindowConfig:
    """Fixed-length windows and their gates."""

    crop_scale: float = 2.0
    hand_margin_frac: float = 0.20
    min_face_size_px: float = 100.0
    max_shoulder_tilt: float = 0.25
    max_wrist_cutoff_frac: float = 0.03
    min_wrist_presence_frac: float = 0.65
    kpt_conf: float = 0.40
    wrist_conf_min: float = 0.30
    wrist_percentile: float = 95.0
    smooth_span_frames: int = 25
    smooth_span_frac: float = 1.0
    min_crop_px: int = 128
    window_frames: int = 100
    headroom_min: float = 60.0
    headroom_max: float = 220.0
    #: "detection" reads windows of detections, "frame" windows of frames (see README)
    index_mode: str = "detection"
    frame_stride: int = 4

    def __post_init__(self):
        if self.index_mode not in ("detection", "frame"):
            raise ValueError(f"index_mode: {self.index_mode}")
        if self.window_frames < 1:
            raise ValueError("window_frames must be positive")


@dataclass(frozen=True)
class NormalizeConfig:
    """Normalised media: target rate and what may be copied."""

    fps: float = 25.0
    copy_tolerance: float = 0.001
    vfr_tolerance: float = 0.01
    duration_tolerance: float = 0.08
    av_tolerance: float = 0.10
    verify_fps_tolerance: float = 0.01
    copy_codecs: tuple[str, ...] = ("h264", "hevc")


@dataclass(frozen=True)
class RenderConfig:
    """Rendered windows: size, length and encoder settings."""

    fps: float = 25.0
    size: int = 512
    frames: int = 100
    audio_rate: int = 16000
    crf: int = 16
    preset: str = "veryfast"
    threads: int = 2
    tasks: int = 30
