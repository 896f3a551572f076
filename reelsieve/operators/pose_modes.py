"""Pose artifacts of clips by pose mode: what each frame's pose, intrinsics and metric scale are, and which clips can't have them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..steps import written
from . import geometry

_AT = {"x": 3, "y": 7, "z": 11}


def _intrinsics(k: Column) -> Column:
    """fx, fy, cx, cy of a 3x3 matrix as an array."""
    return F.array(*geometry.unpacked(k).values())


def _flagged(both: DataFrame, key: str) -> DataFrame:
    """key, error of each clip: null if every frame has a pose of 16 numbers, and a camera."""
    poses, cameras = F.count("pose"), F.count("k")
    bad = F.min(F.when(F.size("pose") != 16, F.size("pose")))
    return both.groupBy(key).agg(
        F.when(poses != cameras, F.format_string("camera count %d != pose count %d", cameras, poses))
        .when(bad.isNotNull(), F.format_string("a pose has 16 numbers, not %d", bad))
        .when(F.count_if(F.col("pose").isNotNull() & F.col("k").isNotNull()) < poses, "cameras and poses are of different frames")
        .alias("error")
    )


def gt_pose(poses: DataFrame, cameras: DataFrame, key: str, t: str, percentile: float = 80.0) -> tuple[DataFrame, DataFrame]:
    """(artifact, errors) of clips whose poses are given: key, t, pose, intrinsics, scale, and key, error.

    poses: key, t, pose (16 numbers, row by row); cameras: key, t, center (3 numbers) and k (3x3, row by row) of a model without
    a metric scale. The scale of every frame is that of the robust similarity transform from the cameras' centers to the given
    ones. A clip whose cameras and poses don't match in number or in frames, or that can't be aligned (fewer than three frames,
    no extent), has an error in place of its artifact; others aren't held up by it.
    """
    both = poses.select(key, t, "pose").join(cameras.select(key, t, "center", "k"), [key, t], "full")
    both = written(both, "gt-pose")
    flags = _flagged(both, key)
    sound = both.join(flags.where("error IS NULL").select(key), key, "left_semi")
    src, dst = [f"s{a}" for a in _AT], [f"d{a}" for a in _AT]
    centers = sound.select(key, t, *[F.col("center")[i].alias(s) for i, s in enumerate(src)], *[F.col("pose")[at].alias(d) for d, at in zip(dst, _AT.values(), strict=True)])
    fits = geometry.sim3_inliers(centers, key, [t], src, dst, percentile).select(key, F.col("s").alias("scale"))
    fits = written(fits, "gt-pose-fits")
    artifact = sound.join(fits.where("scale IS NOT NULL"), key).select(key, t, "pose", _intrinsics(F.col("k")).alias("intrinsics"), "scale")
    lost = fits.where("scale IS NULL").select(key, F.lit("cameras can't be aligned with poses").alias("error"))
    return artifact, flags.where("error IS NOT NULL").unionByName(lost)


def estimated(poses: DataFrame, cameras: DataFrame, key: str, t: str, scales: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(artifact, errors) of clips whose poses are estimated; scales: key, t, scale, and 1 for a frame without one, or without the table.

    poses and cameras as in gt_pose(), of which center isn't read.
    """
    both = poses.select(key, t, "pose").join(cameras.select(key, t, "k"), [key, t], "full")
    both = written(both, "estimated")
    flags = _flagged(both, key)
    sound = both.join(flags.where("error IS NULL").select(key), key, "left_semi")
    if scales is None:
        rows = sound.withColumn("scale", F.lit(1.0))
    else:
        rows = sound.join(scales.select(key, t, F.col("scale").cast("double").alias("scale")), [key, t], "left").withColumn("scale", F.coalesce("scale", F.lit(1.0)))
    return rows.select(key, t, "pose", _intrinsics(F.col("k")).alias("intrinsics"), "scale"), flags.where("error IS NOT NULL")
