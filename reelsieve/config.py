"""Dimension tables of the curation rules: group thresholds, per-source metric rules, lexicons, pipeline constants.

All are data: rows for a join, or parameters of an operator.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Thresholds per group (jump_threshold_m, max_jumps_flag, max_jumps_fail, min_caption_len, check_camera_words,
# saturation_min, saturation_max, max_scene_cuts, rule_source).
GROUPS = {
    "wds-DL3DV-ALL-2K": (0.5, 3, 50, 0, True, 0.0, 180.0, None, "DL3DV"),
    "wds-sekai-real-walking-hq": (0.5, 3, 15, 50, True, 0.0, 180.0, None, "Sekai_Walking"),
    "wds-OmniWorld-Game": (2.0, 15, 50, 10, False, None, None, None, "OmniWorld"),
    "wds-SpatialVID-hq": (0.5, 0, 5, 50, True, 0.0, 180.0, None, "SpatialVID"),
    "wds-RealEstate10K-360p": (0.5, 3, 50, 50, True, 0.0, 180.0, 1, "RealEstate10K"),
    "wds-sekai-game-drone": (5.0, 20, 80, 10, False, None, None, None, "Sekai_Game_Drone"),
    "wds-sekai-game-walking": (2.0, 15, 50, 10, False, None, None, None, "Sekai_Game_Walking"),
}
DEFAULT_GROUP = (1.0, 10, 50, 50, True, None, None, None, None)
GROUP_SCHEMA = "group string, jump_threshold_m double, max_jumps_flag int, max_jumps_fail int, min_caption_len int, check_camera_words boolean, saturation_min double, saturation_max double, max_scene_cuts int, rule_source string"

# Inclusive metric ranges per source; a metric without a range is not checked for that source.
RULES = {
    "OmniWorld": {"vmaf_motion": (0.5, 100), "unimatch_flow": (3, 100), "dover": (0.35, 1.0), "vlm_entity": (0, 10), "vlm_quality": (0.5, 1.5)},
    "Sekai_Game": {"vmaf_motion": (0.5, 50), "unimatch_flow": (3, 80), "dover": (0.25, 1.0), "vlm_entity": (0, 10), "vlm_quality": (0.5, 1.5)},
    "Sekai_Walking": {"vmaf_motion": (0.5, 50), "unimatch_flow": (3, 50), "dover": (0.35, 1.0), "color_saturation": (0, 180), "vlm_entity": (0, 25), "vlm_quality": (0.5, 1.5)},
    "RealEstate10K": {"vmaf_motion": (0.5, 50), "unimatch_flow": (3, 80), "dover": (0.40, 1.0), "color_saturation": (0, 180), "scene_cuts": (None, 1)},
    "Sekai_Game_Drone": {"vmaf_motion": (0.5, 100), "unimatch_flow": (3, 150), "dover": (0.25, 1.0), "vlm_entity": (0, 10), "vlm_quality": (0.5, 1.5)},
    "Sekai_Game_Walking": {"vmaf_motion": (0.5, 50), "unimatch_flow": (3, 80), "dover": (0.25, 1.0), "vlm_entity": (0, 10), "vlm_quality": (0.5, 1.5)},
    "MiraData": {"vmaf_motion": (0.5, 50), "unimatch_flow": (3, 80), "dover": (0.4, 1.0), "color_saturation": (0, 180), "scene_cuts": (None, 1)},
    "DL3DV_GS": {"vmaf_motion": (6, 50), "unimatch_flow": (3, 80), "dover": (0.4, 1.0), "color_saturation": (0, 180), "scene_cuts": (None, 1)},
    "SpatialVID": {"vmaf_motion": (0.5, 50), "unimatch_flow": (3, 80), "dover": (0.35, 1.0), "color_saturation": (0, 180), "vlm_entity": (0, 10), "vlm_quality": (0.5, 1.5)},
    "DL3DV": {"vmaf_motion": (0.5, 100), "color_saturation": (0, 180), "scene_cuts": (None, 2)},
}
RULE_SCHEMA = "source string, metric string, lo double, hi double"

# Camera-motion verbs that captions must not use, and the placeholder captions.
FORBIDDEN_VERBS = ("pan", "tilt", "zoom", "dolly", "truck", "crab", "crane", "fly-through", "flythrough", "walk", "walking", "rotate", "spin", "orbit", "approach", "retreat")
CAMERA_PHRASE = r"\bthe camera\b|\bfirst[- ]person view (?:going|walking|moving)\b|\bcamera (?:pans|tilts|zooms|moves|rotates)\b"
# Camera-action phrases of the quality check.
ACTION_PHRASES = (
    r"\bpan(?:s|ned|ning)?\s+(?:left|right)\b",
    r"\btilt(?:s|ed|ing)?\s+(?:up|down)\b",
    r"\bzoom(?:s|ed|ing)?\s+(?:in|out)\b",
    r"\bdolly\b",
    r"\bcamera\s+(?:moves?|tracks?|follows?|sweeps?|pushes?|pulls?)\b",
    r"\bcamera\s+(?:pan|tilt|roll|orbit)s?\b",
    r"\b(?:tracking|follow)\s+shot\b",
)
# Words of the plain substring test.
CAMERA_SUBSTRINGS = ("camera", "panning", "zooming", "tilting", "tracking", "dolly", "pan", "zoom", "tilt", "rotate")
# Captions that say nothing (lower case).
PLACEHOLDERS = ("", "n/a", "none", "no caption", "null", "tbd")
# Where a reply with a reasoning trace has its answer (first group; case doesn't count, a dot is any character), and
# words of the trace that an answer doesn't have; the last line doesn't have the numbers of steps either.
ANSWER_PATTERNS = (
    r"""(?:Output|Result|Final|Cleaned caption|Rewritten):\s*["']?([^"\n]+)["']?""",
    r"</think>\s*(.+?)(?:<|$)",
    r"Thinking Process:.*?(?:\n\n|\n-\s*)(.*?)(?:\n|$)",
)
TRACE_WORDS = ("Analyze", "Step", "Process", "Thinking")
TRACE_NUMBERS = ("1.", "2.")
# The members of a complete sample, and the priorities of the review plan's groups.
MEMBERS = ("mp4", "poses_c2w.npy", "intrinsics.npy", "scale.npy", "caption.txt", "meta.json")


@dataclass(frozen=True)
class Constants:
    """Pipeline constants: fixed values."""

    width: int = 1280
    height: int = 720
    fps: int = 16
    camera_frames: int = 961
    ema_momentum: float = 0.99
    inlier_percentile: float = 80.0
    fov_min: float = 25.0
    fov_max: float = 120.0
    focal_divergence_max: float = 0.20
    scale_cv_max: float = 2.0
    sample_every_s: float = 0.5
    window_s: int = 60
    chunk_s: int = 5
    samples_per_shard: int = 1000


def group_table(spark: SparkSession, groups: dict | None = None) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in (groups or GROUPS).items()], GROUP_SCHEMA)


def rule_rows(rules: dict | None = None) -> list[tuple]:
    return [(s, m, None if lo is None else float(lo), None if hi is None else float(hi)) for s, r in (rules or RULES).items() for m, (lo, hi) in r.items()]


def rule_table(spark: SparkSession, rules: dict | None = None) -> DataFrame:
    return spark.createDataFrame(rule_rows(rules), RULE_SCHEMA)
