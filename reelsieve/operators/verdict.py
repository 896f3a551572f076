"""Verdicts: group thresholds, per-source metric rules with reasons, quality gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_GROUP, GROUP_SCHEMA, Constants
from ..functions.columns import above, focal_divergence, fov_degrees, reasons, variation

HARD_CHECKS = ("t_aligned", "no_nan_inf", "so3_valid", "first_frame_ok", "pose_quality_ok")


def with_group(df: DataFrame, groups: DataFrame, group: str = "group") -> DataFrame:
    """Each row's thresholds; groups that aren't listed get the default ones. The list is a dimension of a few rows."""
    names = [x.split()[0] for x in GROUP_SCHEMA.split(", ")][1:]
    listed = F.broadcast(groups.withColumn("__listed", F.lit(True)).withColumnRenamed("group", "__group"))
    joined = df.join(listed, F.col(group) == F.col("__group"), "left")
    for name, default in zip(names, DEFAULT_GROUP, strict=True):
        joined = joined.withColumn(name, F.when(F.col("__listed"), F.col(name)).otherwise(F.lit(default)))
    return joined.drop("__listed", "__group")


def verdict(n_jumps: Column, flag_limit: Column, fail_limit: Column, hard_ok: Column | None = None, **flags: Column) -> tuple[Column, Column]:
    """(pass, flag or fail; reasons). Hard checks and the fail limit decide first; limits are exceeded strictly."""
    hard = ~F.coalesce(hard_ok, F.lit(True)) if hard_ok is not None else F.lit(False)
    found = reasons(n_jumps=n_jumps > flag_limit, **flags)
    v = F.when(hard, "fail").when(n_jumps > fail_limit, "fail").when(F.size(found) > 0, "flag").otherwise("pass")
    r = F.when(hard, F.array(F.lit("hard"))).when(n_jumps > fail_limit, F.array(F.lit("max_jumps_fail"))).otherwise(found)
    return v, r


def unpivot(df: DataFrame, key: list[str], metrics: list[str]) -> DataFrame:
    return df.unpivot(key, metrics, "metric", "score")


def violations(scores: DataFrame, rules: DataFrame, key: str, source: str) -> DataFrame:
    """key, source, accepted, reasons: every rule of the source must hold; a missing or NaN score violates its rule.

    scores: key, source, metric, score. Rules are inclusive ranges, an open end is null; metrics without a rule pass.
    A source without any rule is an error (raised when the row is read).
    """
    known = F.broadcast(rules.groupBy("source").agg(F.collect_list(F.struct("metric", "lo", "hi")).alias("__rules")).withColumnRenamed("source", "__source"))
    held = scores.groupBy(key, source).agg(F.map_from_entries(F.collect_list(F.struct("metric", "score"))).alias("__scores"))
    rows = held.join(known, F.col(source) == F.col("__source"), "left")
    listed = F.when(F.col("__source").isNull(), F.raise_error(F.concat(F.lit("no rules for source "), F.col(source)))).otherwise(F.col("__rules"))

    def bad(rule: Column) -> Column:
        score = F.coalesce(F.col("__scores")[rule["metric"]], F.when(rule["metric"] == "scene_cuts", 0.0))
        good = score.isNotNull() & ~F.isnan(score) & (rule["lo"].isNull() | (score >= rule["lo"])) & (rule["hi"].isNull() | (score <= rule["hi"]))
        return ~F.coalesce(good, F.lit(False))

    found = F.array_sort(F.transform(F.filter(listed, bad), lambda r: r["metric"]))
    return rows.select(key, source, (F.size(found) == 0).alias("accepted"), found.alias("reasons"))


def pose_quality(df: DataFrame, key: str, fx: str = "fx", fy: str = "fy", scale: str = "scale", width: float = 1280, height: float = 720, constants: Constants | None = None) -> DataFrame:
    """Per key: FOV ranges, focal divergence, scale variation, passed and reasons. NaN exceeds no limit."""
    c = constants or Constants()
    x, y, d = fov_degrees(width, F.col(fx)), fov_degrees(height, F.col(fy)), focal_divergence(F.col(fx), F.col(fy))
    g = df.groupBy(key).agg(F.min(x).alias("fov_x_min"), F.max(x).alias("fov_x_max"), F.min(y).alias("fov_y_min"), F.max(y).alias("fov_y_max"), F.max(d).alias("focal_div_max"), variation(F.col(scale)).alias("scale_cv"))
    out = reasons(
        fov_x=(F.col("fov_x_min") < c.fov_min) | above(F.col("fov_x_max"), c.fov_max),
        fov_y=(F.col("fov_y_min") < c.fov_min) | above(F.col("fov_y_max"), c.fov_max),
        focal_divergence=above(F.col("focal_div_max"), c.focal_divergence_max),
        scale_cv=above(F.col("scale_cv"), c.scale_cv_max),
    )
    return g.withColumn("reasons", out).withColumn("passed", F.size("reasons") == 0)


def coverage(df: DataFrame, key: str, splats: str, empty: str, least: float = 1000, share: float = 0.70, most_empty: float = 0.65) -> DataFrame:
    """Per key: share of sampled frames with enough splats, largest empty tile share, passed, reason."""
    g = df.groupBy(key).agg(F.avg((F.col(splats) >= least).cast("double")).alias("covered"), F.max(empty).alias("max_empty"), F.count(splats).alias("n"))
    why = F.when(F.col("n") == 0, "no_sampled_frames").when(F.col("covered") < share, "coverage").when(F.col("max_empty") > most_empty, "tile_empty").otherwise("")
    return g.withColumn("reason", why).withColumn("passed", why == "")


def missing_members(df: DataFrame, key: str, ext: str, required: tuple[str, ...]) -> DataFrame:
    """Per key: required members that are missing and members that aren't required, both sorted."""
    have = F.collect_set(ext)
    want = F.array(*[F.lit(x) for x in required])
    g = df.groupBy(key).agg(have.alias("__have"))
    return g.select(key, F.array_sort(F.array_except(want, "__have")).alias("missing"), F.array_sort(F.array_except("__have", want)).alias("extra"))


def entity_count(*counts: Column) -> Column:
    """Sum of the counts; a sentinel below 0 counts as 0."""
    return sum((F.greatest(c, F.lit(0)) for c in counts[1:]), F.greatest(counts[0], F.lit(0)))
