"""One-to-one association, exact percentiles, robust fits and principal axes against plain Python and numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelsieve.operators import geometry, merge, order_statistics


def greedy(pairs):
    used_a, used_b, out = set(), set(), []
    for g, a, b, d in sorted(set(pairs), key=lambda x: (x[3], x[1], x[2])):
        if (g, a) not in used_a and (g, b) not in used_b:
            used_a.add((g, a))
            used_b.add((g, b))
            out.append((g, a, b, d))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_association_is_the_greedy_one(spark, seed):
    """Few distinct times and differences, so that most choices are ties; repeated pairs; a null group."""
    draw = random.Random(seed)
    pairs = [(draw.choice([1, 2, None]), float(draw.randrange(12)), float(draw.randrange(12)), draw.choice([0.0, 0.5, 1.0, 2.0])) for _ in range(300)]
    pairs = list({p[:3]: p for p in pairs}.values())
    df = spark.createDataFrame(pairs + pairs[:40], "g long, a double, b double, diff double")
    assert sorted(map(tuple, merge.associate(df, "g", "a", "b").collect()), key=str) == greedy(pairs)


def test_association_along_a_chain_and_of_nothing(spark):
    """Each pair waits for the one before: as many rounds as that takes."""
    chain = [(1, float((k + 1) // 2), float(k // 2), k / 8) for k in range(9)]
    df = spark.createDataFrame(chain, "g long, a double, b double, diff double")
    assert sorted(map(tuple, merge.associate(df, "g", "a", "b").collect())) == sorted(greedy(chain))
    assert merge.associate(df.limit(0), "g", "a", "b").count() == 0


def test_exact_percentiles(spark):
    draw = random.Random(1)
    groups = {"one": [3.0], "two": [1.0, 2.0], "same": [7.0] * 5000, "ties": [float(draw.randrange(5)) for _ in range(9000)], "wide": [draw.gauss(0, 1) for _ in range(30000)], "signs": [-1.0, 0.0, 1.0, None, None], None: [4.0, 8.0], "none": [None]}
    df = spark.createDataFrame([(k, x) for k, xs in groups.items() for x in xs], "k string, x double").repartition(6)
    for share in (0.0, 0.0005, 0.5, 0.8, 1.0):
        got = {r.k: r.value for r in order_statistics.exact_percentile(df, "k", "x", share).collect()}
        want = {k: np.percentile([x for x in xs if x is not None], 100 * share) for k, xs in groups.items() if k != "none"}
        assert got.keys() == want.keys() and all(np.isclose(got[k], want[k], rtol=0, atol=1e-12) for k in want), share
    with pytest.raises(ValueError):
        order_statistics.exact_percentile(df, "k", "x", 1.5)


def _clip(rng, n, outliers, noise=0.01):
    angle = rng.uniform(0, 3)
    rot = np.array([[np.cos(angle), -np.sin(angle), 0], [np.sin(angle), np.cos(angle), 0], [0, 0, 1]])
    src = rng.normal(size=(n, 3))
    dst = 0.7 * src @ rot.T + [1, -2, 0.5] + rng.normal(scale=noise, size=(n, 3))
    dst[: int(outliers * n)] += rng.normal(scale=5, size=(int(outliers * n), 3))
    return src, dst


def test_robust_fits_of_many_clips(spark):
    """Clips that end after different rounds, by few points, by no change or by the number of rounds."""
    rng = np.random.default_rng(5)
    clips = {f"c{k}": _clip(rng, n, share) for k, (n, share) in enumerate([(300, 0.2), (300, 0.0), (40, 0.5), (5, 0.2), (3, 0.0), (4, 0.0), (1000, 0.1)])}
    clips |= {"few": _clip(rng, 2, 0), "point": (np.ones((9, 3)), np.ones((9, 3)))}
    x, y = ["x0", "x1", "x2"], ["y0", "y1", "y2"]
    rows = [(k, i, *map(float, [*a, *b])) for k, (src, dst) in clips.items() for i, (a, b) in enumerate(zip(src, dst, strict=True))] + [("few", 9, None, *[1.0] * 5), ("gone", 0, None, *[1.0] * 5)]
    df = spark.createDataFrame(rows, "k string, i long, " + ", ".join(f"{c} double" for c in [*x, *y]))
    for percentile, rounds in ((80.0, 5), (50.0, 1)):
        got = {r.k: r for r in geometry.sim3_inliers(df, "k", ["i"], x, y, percentile, rounds).collect()}
        assert got.keys() == {*clips, "gone"} and got["gone"].n == 0
        for k, (src, dst) in clips.items():
            assert got[k].n == len(src)
            try:
                (s, r, t), keep = geometry.inlier_fit(src, dst, percentile, rounds)
            except ValueError:
                assert got[k].s is None and got[k].n_inliers == 0
                continue
            e = geometry.residuals(src[keep], dst[keep], s, r, t)
            assert got[k].n_inliers == keep.sum()
            np.testing.assert_allclose([got[k].s, *got[k].r, *got[k].t, got[k].rmse], [s, *r.ravel(), *t, np.sqrt((e**2).mean())], rtol=1e-9, atol=1e-9)


def test_eigenvectors_of_symmetric_matrices(spark):
    rng = np.random.default_rng(2)
    made = [a @ a.T for a in rng.normal(size=(40, 3, 3))] + [np.diag([3.0, 1.0, 2.0]), np.eye(3), np.zeros((3, 3)), np.outer([1.0, 2, 3], [1, 2, 3]), np.diag([2.0, 2, 1]) + 0, 1e6 * np.array([[2.0, 1, 0], [1, 2, 0], [0, 0, 1e-6]])]
    df = spark.createDataFrame([(i, m.ravel().tolist()) for i, m in enumerate(made)], "i int, m array<double>")
    for r in df.select("i", geometry.eigen3(F.col("m")).alias("e")).collect():
        m, values, axes = made[r.i], np.array([x.variance for x in r.e]), np.array([x.axis for x in r.e])
        size = max(1.0, np.abs(m).max())
        np.testing.assert_allclose(values, np.linalg.eigvalsh(m)[::-1], atol=1e-12 * size)
        np.testing.assert_allclose(axes @ axes.T, np.eye(3), atol=1e-12)
        np.testing.assert_allclose(axes.T @ np.diag(values) @ axes, m, atol=1e-11 * size)
        assert all(a[np.argmax(np.round(np.abs(a), 9))] > 0 for a in axes)


def test_scene_axes(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(500, 3)) @ np.diag([3.0, 1.0, 0.2]) @ np.linalg.qr(rng.normal(size=(3, 3)))[0] + 1e5
    rows = [("a", *map(float, p)) for p in points] + [("b", 1.0, 2.0, 3.0), ("c", None, 1.0, 1.0), ("a", 1.0, None, 1.0)]
    got = {r.k: r for r in geometry.scene_axes(spark.createDataFrame(rows, "k string, x double, y double, z double"), "k", ["x", "y", "z"]).collect()}
    assert got.keys() == {"a", "b"} and got["a"].n == 500
    _, values, axes = np.linalg.svd(np.cov(points.T))
    np.testing.assert_allclose(got["a"].variances, values, rtol=1e-9)
    np.testing.assert_allclose(np.abs(np.reshape(got["a"].axes, (3, 3))), np.abs(axes), atol=1e-7)
    assert got["b"].variances == [0, 0, 0] and sorted(got["b"].axes) == [0] * 6 + [1] * 3 and got["b"].centroid == [1, 2, 3]
