"""Pose artifacts by mode, quaternions and probes against plain versions."""

import json
import random

import numpy as np
from pyspark.sql import functions as F

from reelsieve.functions import columns as C
from reelsieve.operators import geometry, pose_modes

K = [700.0, 0.0, 640.0, 0.0, 710.0, 360.0, 0.0, 0.0, 1.0]


def clip(rnd, name, n, s, noise=0):
    """Frames of a clip, whose cameras are turned, shifted and scaled by 1 / s; the first `noise` of them are far off."""
    q, _ = np.linalg.qr(rnd.normal(size=(3, 3)))
    q *= np.sign(np.linalg.det(q))
    centers = rnd.normal(size=(n, 3))
    given = s * centers @ q.T + [1.0, 2.0, 3.0]
    centers[:noise] += 5
    poses, cameras = [], []
    for t in range(n):
        m = np.eye(4)
        m[:3, 3] = given[t]
        poses.append((name, t, m.ravel().tolist()))
        cameras.append((name, t, centers[t].tolist(), K))
    return poses, cameras, geometry.inlier_fit(centers, given)[0][0] if n >= 3 else None


def test_given_poses(spark):
    rnd = np.random.default_rng(3)
    made = {"a": clip(rnd, "a", 30, 2.5), "b": clip(rnd, "b", 40, 0.7, noise=5), "few": clip(rnd, "few", 2, 1.0), "lost": clip(rnd, "lost", 10, 1.0), "moved": clip(rnd, "moved", 6, 1.0), "short": clip(rnd, "short", 5, 1.0)}
    poses, cameras = [p for x in made.values() for p in x[0]], [c for x in made.values() for c in x[1]]
    cameras = [c for c in cameras if c[:2] not in {("lost", 3), ("lost", 4)}]
    cameras = [(n, t + (n == "moved"), *rest) for n, t, *rest in cameras]
    poses = [(n, t, p[:12] if (n, t) == ("short", 2) else p) for n, t, p in poses]
    p = spark.createDataFrame(poses, "clip string, t long, pose array<double>")
    c = spark.createDataFrame(cameras, "clip string, t long, center array<double>, k array<double>")
    artifact, errors = pose_modes.gt_pose(p, c, "clip", "t")
    rows = artifact.collect()
    for name in "ab":
        own = sorted((r for r in rows if r.clip == name), key=lambda r: r.t)
        assert [r.pose for r in own] == [x[2] for x in made[name][0]]
        assert {round(r.scale, 9) for r in own} == {round(made[name][2], 9)} and own[0].intrinsics == [700.0, 710.0, 640.0, 360.0]
    assert {r.clip for r in rows} == {"a", "b"} and abs(made["b"][2] - 0.7) < 1e-6
    assert {r.clip: r.error for r in errors.collect()} == {
        "lost": "camera count 8 != pose count 10", "moved": "cameras and poses are of different frames", "short": "a pose has 16 numbers, not 12", "few": "cameras can't be aligned with poses",
    }
    artifact, errors = pose_modes.estimated(p, c, "clip", "t", spark.createDataFrame([("a", 0, 3.0), ("a", 1, None)], "clip string, t long, scale double"))
    assert {(r.clip, r.t): r.scale for r in artifact.where("clip = 'a' AND t < 3").collect()} == {("a", 0): 3.0, ("a", 1): 1.0, ("a", 2): 1.0}
    assert sorted(r.clip for r in errors.collect()) == ["lost", "moved", "short"]
    plain, _ = pose_modes.estimated(p, c, "clip", "t")
    assert plain.where("scale <> 1").count() == 0 and plain.count() == 72
    empty, none = pose_modes.gt_pose(p.limit(0), c.limit(0), "clip", "t")
    assert empty.count() == none.count() == 0


def test_quaternions(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(200)] + [(900, [1.0, 0.0, 0.0, 0.0]), (901, [0.0, 0.0, 0.0, 2.0]), (902, [0.0, 0.0, 0.0, 0.0]), (903, None)]
    df = spark.createDataFrame(rows, "i int, q array<double>").select("i", "q", C.from_xyzw(F.col("q")).alias("m"))
    for r in df.select("i", "q", "m", C.to_wxyz(F.col("m"), 3).alias("back")).collect():
        if r.i >= 902:
            assert r.m is None and r.back is None
            continue
        m, q = np.array(r.m).reshape(3, 3), np.array(r.q) / np.linalg.norm(r.q)
        assert np.allclose(m @ m.T, np.eye(3)) and np.isclose(np.linalg.det(m), 1)
        assert np.allclose(m @ q[:3], q[:3])  # the axis stays
        assert np.isclose(np.trace(m), 4 * q[3] ** 2 - 1)
        q *= np.sign(q[np.argmax(np.abs(q))])
        assert np.allclose(r.back, [q[3], *q[:3]])


def test_probes(spark):
    def text(**stream):
        return json.dumps({"streams": [{"width": 64, "height": 48, **stream}], "format": {"duration": "7.5"}})

    cases = {
        text(r_frame_rate="30000/1001", duration="2.0", nb_frames="61"): (30000 / 1001, 2.0, 61),
        text(r_frame_rate="24/1", duration="N/A"): (24.0, 7.5, 180),
        text(avg_frame_rate="25/1", nb_frames="0"): (25.0, 7.5, 188),
        text(r_frame_rate="5/0", nb_frames="N/A"): (0.0, 7.5, 0),
        json.dumps({"streams": [{"width": 1, "height": 1, "r_frame_rate": "10/1"}]}): (10.0, 0.0, 0),
    }
    df = spark.createDataFrame([(x,) for x in [*cases, "{}", "no json", None]], "raw string")
    got = {r.raw: r.v for r in df.select("raw", C.probed(F.col("raw")).alias("v")).collect()}
    assert {x: (got[x].fps, got[x].duration_s, got[x].n_frames) for x in cases} == cases
    assert got["{}"] is got["no json"] is got[None] is None


def test_probes_are_parsed_once(spark):
    df = spark.createDataFrame([("{}",)], "raw string").select(C.probed(F.upper("raw")).alias("v")).select("v.width", "v.fps", "v.duration_s", "v.n_frames")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("upper(") == 1


def test_formats(spark):
    df = spark.createDataFrame([(1.23456789,), (None,)], "x double")
    assert [tuple(r) for r in df.select(C.fixed(F.col("x"), 6), C.fixed(F.col("x"), 2, 1000)).collect()] == [("1.234568", "1234.57"), ("N/A", "N/A")]


def test_formats_round_the_exact_value_half_to_even(spark):
    numbers = [9.105625, 6.97375 / 7, 0.125, 0.375, 2.5e-3, -0.001, 1e23, 2.0**60 + 256, 1234567890123.4567, float("nan"), float("inf"), float("-inf")]
    df = spark.createDataFrame([(x,) for x in numbers], "x double").coalesce(1)
    for digits, factor in ((2, 1000), (2, 1), (4, 1), (6, 1)):
        assert [r.f for r in df.select(C.fixed(F.col("x"), digits, factor).alias("f")).collect()] == ["%.*f" % (digits, x * factor) for x in numbers]
