"""Fits and associations against numpy and plain Python."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelsieve.functions import columns as C
from reelsieve.operators import generators, geometry, merge, validation
from reelsieve.plans import registry


def test_one_to_one_association_against_greedy(spark, small):
    rows = spark.read.parquet(f"{small}/events.parquet").select("user_id", "event_type", "ts").collect()
    at = lambda t: (t - datetime.datetime(1970, 1, 1)).total_seconds()
    want = set()
    for user in {r.user_id for r in rows}:
        a = [at(r.ts) for r in rows if r.user_id == user and r.event_type == "click"]
        b = [at(r.ts) for r in rows if r.user_id == user and r.event_type != "click"]
        used_a, used_b = set(), set()
        for d, x, y in sorted((abs(x - y), x, y) for x in a for y in b):
            if d < 7200 and x not in used_a and y not in used_b:
                used_a.add(x)
                used_b.add(y)
                want.add((user, round(x, 3), round(y, 3)))
    pairs = merge.candidates(*(spark.createDataFrame([(r.user_id, at(r.ts)) for r in rows if (r.event_type == "click") == click], f"user_id long, {t} double") for click, t in ((True, "ta"), (False, "tb"))), "ta", "tb", 7200.0, on=["user_id"])
    got = {(r.user_id, round(r.ta, 3), round(r.tb, 3)) for r in merge.associate(pairs, "user_id", "ta", "tb").collect()}
    assert got == want
    assert registry.queries()["asof_one_to_one"](spark, small).count() == len(want)


def test_waypoints_look_at_and_clip(spark):
    points = spark.createDataFrame([(1, k, float(k * k)) for k in range(5)] + [(2, 0, 3.0)], "scene int, k int, x double")
    got = {}
    for r in generators.waypoints(points, "scene", "k", ["x"], 17).collect():
        got.setdefault(r.scene, {})[r.t] = r.x
    assert np.allclose([got[1][t] for t in range(17)], np.interp(np.linspace(0, 1, 17), np.linspace(0, 1, 5), [k * k for k in range(5)]))
    assert set(got[2].values()) == {3.0}
    position, target = np.array([1.0, 2.0, -3.0]), np.array([0.5, 0.0, 4.0])
    pose = spark.range(1).select(generators.look_at(tuple(map(F.lit, position.tolist())), tuple(map(F.lit, target.tolist()))).alias("p")).first().p
    pose = np.array(pose).reshape(4, 4)
    assert np.allclose(pose[:3, :3] @ pose[:3, :3].T, np.eye(3)) and np.isclose(np.linalg.det(pose[:3, :3]), 1)
    assert np.allclose(pose[:3, 2], (target - position) / np.linalg.norm(target - position)) and np.allclose(pose[:3, 3], position)
    assert spark.range(1).select(generators.clipped(F.lit(9.0), F.lit(0.0), F.lit(5.0))).first()[0] == 5.5
    with pytest.raises(ValueError):
        generators.family_position("other", F.lit(0.0), F.lit(1.0), *[(F.lit(0.0),) * 3] * 3)


def test_normal_draws(spark):
    x = np.array([r[0] for r in spark.range(20000).select(generators.normal(F.col("id"), "x")).collect()])
    assert abs(x.mean()) < 0.03 and abs(x.std() - 1) < 0.03


def test_errors_of_picks_poses_and_parameters(spark):
    frames = spark.createDataFrame([(1, t, t * 1.0) for t in range(5)], "k int, t long, v double")
    picks = lambda *at: spark.createDataFrame([(1, a) for a in at], "k int, at long")
    assert sorted(r.v for r in validation.selected(frames, picks(4, 0), "k", "t", "at").collect()) == [0, 4]
    for bad in (5, -1):
        with pytest.raises(Exception, match="outside"):
            validation.selected(frames, picks(bad), "k", "t", "at").collect()
    with pytest.raises(Exception, match="16, 12 or 3"):
        spark.range(1).select(geometry.pose_of(F.array(F.lit(1.0)))).collect()
    with pytest.raises(Exception, match="unknown mode"):
        geometry.by_mode(spark.createDataFrame([("x",)], "mode string"), "mode", {"a": lambda d: d}).collect()
    validation.frozen({"a": 1, "b": 2}, {"a": 1})
    with pytest.raises(ValueError, match="a=2, not 1"):
        validation.frozen({"a": 2}, {"a": 1})


def test_columns(spark):
    one = spark.range(1)
    value = lambda c: one.select(c).first()[0]
    assert C.inflections("zoom") == ["zoom", "zooms", "zoomed", "zooming", "zoomned", "zoomning"]
    assert [value(C.has_verb(F.lit(t), ("pan", "dolly-in", "rotate"), None)) for t in ("panning left", "a company", "rotating", "dolly-ins", "rotated it", "japan")] == [True, False, True, True, True, False]
    assert [value(C.rate(F.lit(t))) for t in ("30000/1001", "25", "1/0")] == [30000 / 1001, 25.0, 0.0]
    assert value(C.fps_of(F.lit("x FPS: 24.5"))) == 24.5 and value(C.fps_of(F.lit("none"))) == 30.0
    assert value(C.display(F.lit(0.00001))) == "1.00e-05" and value(C.display(F.lit(1.5))) == "1.500000" and value(C.display(F.lit(None).cast("double"))) == "N/A"
    assert value(C.significant(F.lit(123456.0))) == 123000.0
    assert value(C.decoded(F.lit(bytearray(b"a\xffb")))) == "a�b"
    assert value(C.final_answer(F.lit("<think>Step one</think> A red car."))) == "A red car."
    assert value(C.substring_hit(F.lit("the company"))) and value(C.ratio(F.lit(1.0), F.lit(0.0))) == float("inf")
    assert np.allclose(value(C.rotation(F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(0.0))), np.eye(3).ravel())
    assert value(C.norm(F.array(F.lit(3.0), F.lit(4.0)))) == 5.0 and value(C.distance(F.array(F.lit(1.0)), F.array(F.lit(4.0)))) == 3.0
    assert [r for r in one.select(*C.frames_of(F.lit(None).cast("double"), F.lit(2.0), F.lit(None).cast("long"), F.lit(16.0))).first()] == [2.0, 32]


def _turn(angle):
    c, s = np.cos(angle), np.sin(angle)
    return np.array([[c, -s, 0], [s, c, 0], [0, 0, 1.0]])


def _table(spark, parts):
    rows = [(k, i, *map(float, a), *map(float, b)) for k, (src, dst) in parts.items() for i, (a, b) in enumerate(zip(src, dst, strict=True))]
    return spark.createDataFrame(rows, "k string, i int, x0 double, x1 double, x2 double, y0 double, y1 double, y2 double"), ["x0", "x1", "x2"], ["y0", "y1", "y2"]


def test_sim3_of_a_known_transform_far_from_the_origin(spark):
    rng = np.random.default_rng(1)
    src = rng.normal(size=(200, 3))
    to = lambda p: 0.7 * p @ _turn(0.4).T + np.array([1.0, -2.0, 0.5])
    df, x, y = _table(spark, {"near": (src, to(src)), "far": (src + 1e6, to(src + 1e6)), "few": (src[:2], src[:2]), "point": (np.ones((5, 3)), src[:5])})
    df = df.unionByName(df.where("k = 'near' AND i = 0").withColumn("y1", F.lit(None).cast("double")))
    got = {r.k: r for r in geometry.sim3(df, "k", x, y).collect()}
    for k, exact in (("near", 1e-9), ("far", 1e-6)):
        assert got[k].n == 200 and abs(got[k].s - 0.7) < exact and np.allclose(np.array(got[k].r).reshape(3, 3), _turn(0.4), atol=exact)
    assert np.allclose(got["near"].t, [1, -2, 0.5], atol=1e-9)
    assert got["few"].s is None and got["point"].s is None and got["point"].n == 5


def test_robust_fits_with_outliers(spark):
    rng = np.random.default_rng(2)
    src = rng.normal(size=(300, 3))
    dst = 0.7 * src @ _turn(0.4).T + np.array([1.0, -2.0, 0.5]) + rng.normal(scale=1e-3, size=src.shape)
    dst[rng.permutation(300)[:60]] += rng.normal(scale=5, size=(60, 3))
    df, x, y = _table(spark, {"a": (src, dst), "b": (src[:2], dst[:2])})
    got = {r.k: r for r in geometry.sim3_inliers(df, "k", ["i"], x, y).collect()}
    assert 0.60 * 300 <= got["a"].n_inliers <= 0.85 * 300 and abs(got["a"].s - 0.7) < 0.05 and got["b"].s is None
    (s, r, t), _ = geometry.inlier_fit(src, dst, rounds=1)
    once = geometry.umeyama(*(p[(e := geometry.residuals(src, dst, *geometry.umeyama(src, dst))) <= np.percentile(e, 80)] for p in (src, dst)))[0]
    scale = {r.k: r.s for r in geometry.metric_scale(df, "k", ["i"], x, y).collect()}
    assert np.isclose(s, once) and np.isclose(scale["a"], once) and scale["b"] is None


def test_fits_of_the_queries_against_numpy(spark, small):
    points = {}
    for r in sorted(spark.read.parquet(f"{small}/embeddings.parquet").select("label", "vec_id", "embedding").collect(), key=lambda r: r.vec_id):
        points.setdefault(r.label, []).append(r.embedding[:6])
    found = {name: {r.label: r for r in registry.queries()[name](spark, small).collect()} for name in ("sim3_fit", "sim3_inlier", "metric_scale", "trajectory_errors")}
    assert all(set(rows) == set(points) for rows in found.values())
    for label, p in points.items():
        a, b = np.array(p, dtype=float)[:, :3], np.array(p, dtype=float)[:, 3:]
        if len(a) < 3:
            assert found["sim3_fit"][label].s is None
            continue
        # The fit by its own definition: no smaller sum of squares nearby, and a rotation.
        fit = found["sim3_fit"][label]
        rot, t = np.array(fit.r).reshape(3, 3), np.array(fit.t)
        assert np.allclose(rot @ rot.T, np.eye(3)) and np.isclose(np.linalg.det(rot), 1)
        cost = lambda s, r, t: (np.linalg.norm(b - (s * a @ r.T + t), axis=1) ** 2).sum()
        least = cost(fit.s, rot, t)
        for step in (1e-3, -1e-3):
            assert cost(fit.s + step, rot, t) >= least and cost(fit.s, rot @ _turn(step), t) >= least and cost(fit.s, rot, t + step) >= least
        e = np.linalg.norm(b - (fit.s * a @ rot.T + t), axis=1)
        got = found["trajectory_errors"][label]
        assert np.allclose([got.rmse, got.mean, got.median, got.max], [np.sqrt((e**2).mean()), e.mean(), np.median(e), e.max()])
        keep, now = np.ones(len(a), dtype=bool), geometry.umeyama(a, b)
        for turn in range(5):
            e = geometry.residuals(a, b, *now)
            new = e <= np.percentile(e, 80)
            if new.sum() < 3 or (new == keep).all():
                break
            keep, now = new, geometry.umeyama(a[new], b[new])
            if turn == 0:
                assert np.isclose(found["metric_scale"][label].s, now[0])
        assert found["sim3_inlier"][label].n_inliers == keep.sum() and np.isclose(found["sim3_inlier"][label].s, now[0])


def test_relative_motion_of_rigid_poses(spark):
    rng = np.random.default_rng(3)

    def pose():
        q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
        out = np.eye(4)
        out[:3, :3], out[:3, 3] = q * np.sign(np.linalg.det(q)), rng.normal(size=3)
        return out

    found, given = [pose() for _ in range(23)], [pose() for _ in range(23)]
    rot, trans = [], []
    for i in range(0, 23 - 4, 4):
        off = np.linalg.inv(np.linalg.inv(given[i]) @ given[i + 4]) @ np.linalg.inv(found[i]) @ found[i + 4]
        rot.append(np.degrees(np.arccos(np.clip((np.trace(off[:3, :3]) - 1) / 2, -1, 1))))
        trans.append(np.linalg.norm(off[:3, 3]))
    rows = [(1, t, found[t].ravel().tolist(), given[t].ravel().tolist()) for t in range(23)] + [(2, 0, found[0].ravel().tolist(), given[0].ravel().tolist())]
    got = geometry.relative_motion(spark.createDataFrame(rows, "k int, t int, f array<double>, g array<double>"), "k", "t", 4, "f", "g").collect()
    assert len(got) == 1 and len(rot) == 5
    assert np.allclose(got[0][1:], [np.mean(rot), np.mean(trans), np.mean(rot[2:]), np.mean(trans[2:])])
