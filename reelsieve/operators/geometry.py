"""Similarity transforms between trajectories from grouped moments, plain and robust; trajectory errors; principal axes; camera forms."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..steps import written
from .order_statistics import exact_percentile
from .series import interpolate_arrays

#: Fixed value: points of a smaller variance have no extent.
LEAST_VARIANCE = 1e-12


def umeyama(src: np.ndarray, dst: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Scale, rotation and shift that bring src nearest to dst in the sense of least squares."""
    if src.shape != dst.shape or len(src) < 3:
        raise ValueError("at least three pairs of points are needed")
    a, b = src - src.mean(0), dst - dst.mean(0)
    return _solve(b.T @ a / len(src), (a**2).sum() / len(src), src.mean(0), dst.mean(0))


def _solve(cov: np.ndarray, variance: float, mean_src: np.ndarray, mean_dst: np.ndarray):
    if not variance >= LEAST_VARIANCE:
        raise ValueError("the points have no extent")
    u, d, vt = np.linalg.svd(cov)
    sign = np.ones(3)
    sign[-1] = np.sign(np.linalg.det(u) * np.linalg.det(vt)) or 1.0
    rot = u @ np.diag(sign) @ vt
    scale = float((d * sign).sum() / variance)
    return scale, rot, mean_dst - scale * rot @ mean_src


def inlier_fit(src: np.ndarray, dst: np.ndarray, percentile: float = 80.0, rounds: int = 5):
    """umeyama() on the points within a percentile of the residuals, refitted until they don't change."""
    keep = np.ones(len(src), dtype=bool)
    fit = umeyama(src, dst)
    for _ in range(rounds):
        error = residuals(src, dst, *fit)
        now = error <= np.percentile(error, percentile)
        if now.sum() < 3 or (now == keep).all():
            break
        keep, fit = now, umeyama(src[now], dst[now])
    return fit, keep


def residuals(src: np.ndarray, dst: np.ndarray, s: float, r: np.ndarray, t: np.ndarray) -> np.ndarray:
    return np.linalg.norm(dst - (s * src @ r.T + t), axis=1)


def sim3(df: DataFrame, key: str, src: list[str], dst: list[str]) -> DataFrame:
    """Transform per key from central moments: only 16 numbers and the count of a key meet in Python.

    The moments are merged from partial aggregates about running means, so points far from the origin lose no digits. n counts
    the pairs without a null; the transform is null for fewer than three of them and for points without extent.
    """
    x, y = [F.col(c).cast("double") for c in src], [F.col(c).cast("double") for c in dst]
    whole = reduce(lambda a, c: a & c.isNotNull(), [*x, *y], F.lit(True))
    x, y = [F.when(whole, c) for c in x], [F.when(whole, c) for c in y]
    moments = [F.count_if(whole).alias("n"), *[F.avg(c).alias(f"x{i}") for i, c in enumerate(x)], *[F.avg(c).alias(f"y{i}") for i, c in enumerate(y)]]
    moments += [F.covar_pop(y[i], x[j]).alias(f"m{i}{j}") for i in range(3) for j in range(3)] + [sum(map(F.var_pop, x)).alias("extent")]

    def solve(batches):
        for rows in batches:
            out = []
            for r in rows.to_dict("records"):
                cov = np.array([[r[f"m{i}{j}"] for j in range(3)] for i in range(3)])
                try:
                    s, rot, t = _solve(cov, r["extent"], *(np.array([r[f"{p}{i}"] for i in range(3)]) for p in "xy")) if r["n"] >= 3 else (None, None, None)
                except ValueError:
                    s = rot = t = None
                out.append((r[key], r["n"], s, None if rot is None else rot.ravel().tolist(), None if t is None else t.tolist()))
            yield pd.DataFrame(out, columns=[key, "n", "s", "r", "t"])

    kind = dict(df.dtypes)[key]
    return df.groupBy(key).agg(*moments).mapInPandas(solve, f"`{key}` {kind}, n long, s double, r array<double>, t array<double>")


def _moved(src: list[str]) -> list[Column]:
    return [F.col("s") * sum(F.col("r")[3 * i + j] * F.col(src[j]) for j in range(3)) + F.col("t")[i] for i in range(3)]


def _residual(src: list[str], dst: list[str]) -> Column:
    """The distance between dst and src, moved by the columns s, r, t."""
    return F.sqrt(sum((F.col(d) - m) ** 2 for d, m in zip(dst, _moved(src), strict=True)))


def sim3_inliers(df: DataFrame, key: str, order: list[str], src: list[str], dst: list[str], percentile: float = 80.0, rounds: int = 5) -> DataFrame:
    """Robust transform per key: n, n_inliers, s, r, t, rmse over the inliers; nulls where it can't be fitted.

    A fit to all points; then, until they don't change, a fit to the points whose residual is at most the percentile of all
    residuals, unless they are fewer than three. Each round is grouped moments and an exact percentile over all keys at once:
    only 17 numbers of a key meet in Python, and no clip comes into one task. A null key isn't fitted. n counts the pairs without a null; order is
    not needed any more, the fit does not depend on it.
    """
    x, y = [f"__x{i}" for i in range(3)], [f"__y{i}" for i in range(3)]
    named = [F.col(a).cast("double").alias(b) for a, b in zip([*src, *dst], [*x, *y], strict=True)]
    whole = reduce(lambda a, c: a & F.col(c).isNotNull(), [*x, *y], F.lit(True))
    points = df.select(F.col(key).alias("__key"), *named).where(whole).withColumn("__keep", F.lit(True))
    fits = written(sim3(points, "__key", x, y).withColumn("open", F.col("s").isNotNull()), "fits")
    for _ in range(rounds):
        error = written(points.join(fits.select("__key", "s", "r", "t"), "__key").withColumn("__e", _residual(x, y)).drop("s", "r", "t"), "residuals")
        # Keys that are done go on with the points and the fit that they have.
        limits = exact_percentile(error.join(fits.where("open").select("__key"), "__key", "left_semi"), "__key", "__e", percentile / 100).withColumnRenamed("value", "__limit")
        inside = F.col("__e") <= F.col("__limit")
        counts = error.join(limits, "__key").groupBy("__key").agg(F.count_if(inside).alias("inside"), F.bool_or(inside != F.col("__keep")).alias("moved"), F.first("__limit").alias("__limit"))
        moved = written(counts.where("moved AND inside >= 3").select("__key", "__limit"), "moved")
        if moved.isEmpty():
            break
        points = error.join(moved, "__key", "left").select("__key", *x, *y, F.when(F.col("__limit").isNotNull(), inside).otherwise(F.col("__keep")).alias("__keep"))
        again = sim3(points.join(moved, "__key", "left_semi").where("__keep"), "__key", x, y).withColumn("open", F.col("s").isNotNull())
        fits = written(again.unionByName(fits.join(moved, "__key", "left_anti").withColumn("open", F.lit(False))), "fits")
    every = points.join(fits.drop("n", "open"), "__key", "left")
    out = every.groupBy("__key").agg(F.count("*").alias("n"), F.count_if(F.col("__keep") & F.col("s").isNotNull()).alias("n_inliers"), F.sqrt(F.avg(F.when(F.col("__keep"), _residual(x, y)) ** 2)).alias("rmse"))
    got = out.join(fits.drop("n", "open"), "__key").select(F.col("__key").alias(key), "n", "n_inliers", "s", "r", "t", "rmse")
    # A key without a whole pair has no point.
    return df.select(key).distinct().join(got, key, "left").select(key, F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("n_inliers", F.lit(0)).cast("long").alias("n_inliers"), "s", "r", "t", "rmse")


def trajectory_error(df: DataFrame, key: str, fits: DataFrame, src: list[str], dst: list[str]) -> DataFrame:
    """Per key: RMSE, mean, median and largest error after the key's transform (columns s, r, t of fits)."""
    rows = df.join(fits.select(key, "s", "r", "t"), key)
    rows = rows.select(key, _residual(src, dst).alias("e"))
    return rows.groupBy(key).agg(F.sqrt(F.avg(F.col("e") ** 2)).alias("rmse"), F.avg("e").alias("mean"), F.percentile("e", F.lit(0.5)).alias("median"), F.max("e").alias("max"))


def _turned(state: Column, p: int, q: int) -> Column:
    """One Jacobi step: a symmetric 3x3 matrix (first nine numbers) without its entry p, q, and the axes (last nine, row by row) that turn with it."""
    a, v = (lambda i, j: state[3 * i + j]), (lambda i, j: state[9 + 3 * i + j])
    tau = F.try_divide(a(q, q) - a(p, p), 2 * a(p, q))
    tan = F.when(a(p, q) == 0, 0.0).otherwise(F.when(tau < 0, -1.0).otherwise(1.0) / (F.abs(tau) + F.sqrt(1 + tau * tau)))

    def turn(tan: Column) -> Column:
        c = 1 / F.sqrt(1 + tan * tan)
        s, k = tan * c, 3 - p - q
        new = {(i, j): a(i, j) for i in range(3) for j in range(3)}
        new[p, p], new[q, q] = a(p, p) - tan * a(p, q), a(q, q) + tan * a(p, q)
        new[p, q] = new[q, p] = F.lit(0.0)
        new[p, k] = new[k, p] = c * a(p, k) - s * a(q, k)
        new[q, k] = new[k, q] = s * a(p, k) + c * a(q, k)
        axes = {(i, j): v(i, j) for i in range(3) for j in range(3)}
        for j in range(3):
            axes[p, j], axes[q, j] = c * v(p, j) - s * v(q, j), s * v(p, j) + c * v(q, j)
        return F.array(*[new[i, j] for i in range(3) for j in range(3)], *[axes[i, j] for i in range(3) for j in range(3)])

    return F.transform(F.array(tan), turn)[0]


def eigen3(m: Column, sweeps: int = 8) -> Column:
    """Eigenvalues and unit eigenvectors of a symmetric 3x3 matrix (nine numbers): array of struct(variance, axis), the largest first.

    Jacobi sweeps as column expressions, without a Python worker. Of an axis the component of largest size is positive (the first
    of equal ones); where variances are equal any axes of their space may come.
    """
    start = F.concat(m, F.array(*[F.lit(float(i % 4 == 0)) for i in range(9)]))

    def sweep(state: Column, _: Column) -> Column:
        state = F.transform(F.array(state), lambda x: _turned(x, 0, 1))[0]
        state = F.transform(F.array(state), lambda x: _turned(x, 0, 2))[0]
        return F.transform(F.array(state), lambda x: _turned(x, 1, 2))[0]

    def faced(axis: Column) -> Column:
        size = F.transform(axis, lambda x: F.round(F.abs(x), 9))
        lead = F.element_at(axis, F.array_position(size, F.array_max(size)).cast("int"))
        return F.transform(axis, lambda x: F.when(lead < 0, -x).otherwise(x))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(sweeps)), start, sweep)
    pairs = F.transform(F.array(done), lambda d: F.array(*[F.struct((-d[4 * i]).alias("less"), faced(F.slice(d, 10 + 3 * i, 3)).alias("axis")) for i in range(3)]))[0]
    return F.transform(F.array_sort(pairs), lambda x: F.struct((-x["less"]).alias("variance"), x["axis"].alias("axis")))


def scene_axes(df: DataFrame, key: str, at: list[str]) -> DataFrame:
    """Per key: n, centroid (array), variances and axes (row by row) of the positions, the longest first; one position has no spread and the unit axes.

    The covariance is the sample's (n - 1). Positions with a null coordinate don't count.
    """
    x = [F.col(c).cast("double") for c in at]
    whole = reduce(lambda a, c: a & c.isNotNull(), x, F.lit(True))
    moments = [F.covar_samp(x[i], x[j]).alias(f"m{i}{j}") for i in range(3) for j in range(i, 3)]
    g = df.where(whole).groupBy(key).agg(F.count("*").alias("n"), F.array(*[F.avg(c) for c in x]).alias("centroid"), *moments)
    # One position has no sample covariance.
    m = F.array(*[F.coalesce(f"m{min(i, j)}{max(i, j)}", F.lit(0.0)) for i in range(3) for j in range(3)])
    found = g.select(key, "n", "centroid", eigen3(m).alias("found"))
    return found.select(key, "n", "centroid", F.col("found.variance").alias("variances"), F.flatten("found.axis").alias("axes"))


def relative_motion(df: DataFrame, key: str, t: str, lag: int, src: str, dst: str) -> DataFrame:
    """Per key: rot_mean, trans_mean and the same of the second half, rot_2nd_half, trans_2nd_half.

    Errors of the motion from frame i to i + lag, i = 0, lag, 2 lag...: the angle in degrees between the two rotations and
    the distance between the two shifts, each seen from its own frame i. src, dst: rigid 4x4 poses, row by row. The second
    half of m motions begins with number floor(m / 2). A key without two frames lag apart gives no row.
    """
    rows = df.where(F.col(t) % lag == 0).select(key, F.col(t).alias("__t"), F.col(src).alias("__s"), F.col(dst).alias("__d"))
    later = rows.select(key, (F.col("__t") - lag).alias("__t"), F.col("__s").alias("__s1"), F.col("__d").alias("__d1"))

    def motion(p: Column, q: Column) -> tuple[list[Column], list[Column]]:
        turned = [sum(p[4 * k + i] * q[4 * k + j] for k in range(3)) for i in range(3) for j in range(3)]
        return turned, [sum(p[4 * k + i] * (q[4 * k + 3] - p[4 * k + 3]) for k in range(3)) for i in range(3)]

    (turned, moved), (turned_to, moved_to) = motion(F.col("__s"), F.col("__s1")), motion(F.col("__d"), F.col("__d1"))
    cosine = (sum(a * b for a, b in zip(turned, turned_to, strict=True)) - 1) / 2
    rot = F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))))
    trans = F.sqrt(sum((a - b) ** 2 for a, b in zip(moved, moved_to, strict=True)))
    errors = rows.join(later, [key, "__t"]).select(key, (F.col("__t") / lag).cast("long").alias("__i"), rot.alias("rot"), trans.alias("trans"))
    halves = errors.groupBy(key).agg(F.floor(F.count("*") / 2).alias("__half"))
    late = F.col("__i") >= F.col("__half")
    return errors.join(halves, key).groupBy(key).agg(
        F.avg("rot").alias("rot_mean"), F.avg("trans").alias("trans_mean"),
        F.avg(F.when(late, F.col("rot"))).alias("rot_2nd_half"), F.avg(F.when(late, F.col("trans"))).alias("trans_2nd_half"),
    )


def reanchor(df: DataFrame, key: str, pose: str = "pose", order: str = "t") -> DataFrame:
    """Poses relative to the first one: inverse(P0) @ P, for rigid 4x4 poses stored row by row."""
    first = df.groupBy(key).agg(F.min_by(pose, order).alias("__p0"))
    p, q = F.col("__p0"), F.col(pose)
    rt = lambda i, k: p[4 * k + i]  # noqa: E731  transposed rotation
    rows = []
    for i in range(3):
        rows += [sum(rt(i, k) * q[4 * k + j] for k in range(3)) for j in range(3)]
        rows.append(sum(rt(i, k) * (q[4 * k + 3] - p[4 * k + 3]) for k in range(3)))
    return df.join(first, key).withColumn(pose, F.array(*rows, *[F.lit(float(x)) for x in (0, 0, 0, 1)])).drop("__p0")


#: Fixed value: a first pose nearer to the identity than this is one.
ANCHORED = 1e-3


def dense_poses(keyframes: DataFrame, key: str, t: str, pose: str) -> DataFrame:
    """key, t, pose for every frame from 0 to the last keyframe: entries on straight lines between keyframes, relative to the first frame.

    Rotations between keyframes are not made orthogonal again. Clips whose first pose is the identity already stay as they are.
    """
    dense = interpolate_arrays(keyframes, key, t, pose)
    unit = F.array(*[F.lit(float(i % 5 == 0)) for i in range(16)])
    first = dense.where(F.col(t) == 0).select(key, (F.array_max(F.zip_with(pose, unit, lambda a, b: F.abs(a - b))) > ANCHORED).alias("__off"))
    rows = dense.join(first, key)
    moved = reanchor(rows.where("__off"), key, pose, t).select(key, t, pose)
    return moved.unionByName(rows.where("NOT __off").select(key, t, pose))


def ray_intrinsics(df: DataFrame, key: str, u: str, v: str, x: str, y: str) -> DataFrame:
    """fx, cx, fy, cy of a pinhole from rays (x, y at depth 1) and pixels, by two straight lines."""
    return df.groupBy(key).agg(F.regr_slope(u, x).alias("fx"), F.regr_intercept(u, x).alias("cx"), F.regr_slope(v, y).alias("fy"), F.regr_intercept(v, y).alias("cy"))


def unpacked(k: Column) -> dict[str, Column]:
    """fx, fy, cx, cy of a 3x3 matrix, row by row."""
    return {"fx": k[0], "fy": k[4], "cx": k[2], "cy": k[5]}


def to_matrix(fx: Column, fy: Column, cx: Column, cy: Column) -> Column:
    """The 3x3 matrix, row by row."""
    zero, one = F.lit(0.0), F.lit(1.0)
    return F.array(fx, zero, cx, zero, fy, cy, zero, zero, one)


def pose_of(values: Column) -> Column:
    """The 4x4 pose of 16, 12 (without the last row) or 3 (a position) numbers; another number of them is an error."""
    last = F.array(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))
    at = F.array(*[values[i // 4] if i % 4 == 3 and i < 12 else F.lit(float(i % 5 == 0)) for i in range(16)])
    wrong = F.raise_error(F.format_string("a pose has 16, 12 or 3 numbers, not %d", F.size(values))).cast("array<double>")
    return F.when(F.size(values) == 16, values).when(F.size(values) == 12, F.concat(values, last)).when(F.size(values) == 3, at).otherwise(wrong)


def metric_scale(df: DataFrame, key: str, order: list[str], src: list[str], dst: list[str], percentile: float = 80.0) -> DataFrame:
    """Per key the scale of the transform that is fitted again, once, on the points within the percentile of the residuals."""
    return sim3_inliers(df, key, order, src, dst, percentile, rounds=1).select(key, "s")


def by_mode(clips: DataFrame, mode: str, plans: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Each mode's plan over its clips, united; a clip of another mode is an error."""
    known = F.when(F.col(mode).isin(*plans), F.col(mode)).otherwise(F.raise_error(F.concat(F.lit("unknown mode "), F.coalesce(mode, F.lit("null")))))
    clips = clips.withColumn(mode, known)
    parts = [plan(clips.where(F.col(mode) == name)) for name, plan in plans.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
