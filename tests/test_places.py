import random

import numpy as np
import pytest
from oracle import agree, connection
from pyspark.sql import functions as F

from reelsieve.operators import colour, generators, packing, scenes
from reelsieve.plans import registry


def test_places_follow_the_order(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", "hot", "hot", "hot", None]), i, "x") for i in range(3000)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "name string, id long, part string").repartition(7)
    got = {r.rn: (r.name, r.id) for r in packing.place(df, "name", "id").collect()}
    want = sorted(((n, i) for n, i, _ in rows), key=lambda x: (x[0] is not None, x[0] or "", x[1]))
    assert [got[k] for k in range(1, 3001)] == want and packing.place(df, "name", "id").columns == ["name", "id", "part", "rn"]
    assert sorted(r.at for r in packing.place(df.select(F.lit(1).alias("one")), "one", out="at").collect()) == list(range(1, 3001))
    assert packing.place(df.limit(0), "id").count() == 0


@pytest.mark.parametrize("name", ["scene_trajectories", "waypoint_interpolation", "grid_sampling", "shard_assignment", "batch_stats_grouping_sets"])
def test_agrees_with_sql_on_the_larger_tables(spark, middle, name):
    agree(spark, connection(middle), registry.queries()[name], registry.oracle_sql()[name], middle)


def test_trajectories_are_smoothed_and_stay_in_the_box(spark):
    cameras = [(s, k, float(k % 3), float(k * k % 5), float(k)) for s, n in ((1, 9), (2, 1), (3, 2)) for k in range(n)]
    frames = 201
    got = scenes.trajectories(spark.createDataFrame(cameras, "scene long, cam int, x double, y double, z double"), "scene", "cam", frames).collect()
    assert len(got) == 3 * 40 * frames
    paths = {}
    for r in got:
        paths.setdefault((r.scene, r.family, r.k), {})[r.t] = r
    assert {f: sum(1 for s, g, _ in paths if s == 1 and g == f) for f in generators.FAMILIES} == generators.FAMILIES
    own = np.array([c[2:] for c in cameras if c[0] == 1])
    centre, radius, pad = own.mean(axis=0), np.median(np.linalg.norm(own - own.mean(axis=0), axis=1)), 0.1 * (own.max(axis=0) - own.min(axis=0))
    for (scene, _, _), rows in paths.items():
        at = np.array([(rows[t].x, rows[t].y, rows[t].z) for t in range(frames)])
        if scene == 1:
            assert (at >= own.min(axis=0) - pad - 1e-9).all() and (at <= own.max(axis=0) + pad + 1e-9).all()
        if scene == 2:
            assert np.allclose(at, own[0] * 0 + at[0])
    s = np.linspace(0, 1, frames)
    orbit = centre + radius * np.stack([np.cos(2 * np.pi * s), 0 * s, np.sin(2 * np.pi * s)], axis=1)
    sigma = frames / 200
    half = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-half, half + 1) / sigma) ** 2)
    padded = np.pad(orbit, ((half, half), (0, 0)), mode="edge")
    smooth = np.stack([np.convolve(padded[:, d], kernel / kernel.sum(), mode="valid") for d in range(3)], axis=1)
    want = np.clip(smooth, own.min(axis=0) - pad, own.max(axis=0) + pad)
    rows = paths[1, "orbit", 0]
    assert np.allclose([(rows[t].x, rows[t].y, rows[t].z) for t in range(frames)], want)
    for r in rows.values():
        pose = np.array(r.pose).reshape(4, 4)
        way = centre - pose[:3, 3]
        assert np.allclose(pose[:3, 2], way / np.linalg.norm(way)) and np.allclose(pose[:3, 3], (r.x, r.y, r.z))


def test_grid_of_a_raster(spark):
    high, wide, grid = 7, 45, 32
    raster = np.arange(high * wide, dtype=float).reshape(high, wide)
    df = spark.createDataFrame([(1, raster.ravel().tolist(), high, wide), (2, [1.0] * 4, 3, 3), (3, None, 2, 2), (4, [5.0], 1, 1)], "k int, v array<double>, h int, w int")
    got = {(r.k, r.gy, r.gx): r.value for r in colour.grid_sample(df, ["k"], "v", "h", "w", grid).collect()}
    ys, xs = ([i * (n - 1) // (grid - 1) for i in range(grid)] for n in (high, wide))
    assert {k for k, _, _ in got} == {1, 4} and all(got[1, i, j] == raster[y, x] for i, y in enumerate(ys) for j, x in enumerate(xs))
    assert {v for (k, _, _), v in got.items() if k == 4} == {5.0}


def test_waypoints_of_any_number(spark):
    points = spark.createDataFrame([(1, k, float(k % 10)) for k in range(3000)] + [(2, 0, 7.0)], "scene int, k int, x double")
    got = {}
    for r in generators.waypoints(points, "scene", "k", ["x"], lambda n: 4 * (n - 1) + 1).collect():
        got.setdefault(r.scene, {})[r.t] = r.x
    assert got[2] == {0: 7.0} and len(got[1]) == 4 * 2999 + 1
    assert np.allclose([got[1][t] for t in range(4 * 2999 + 1)], np.interp(np.arange(4 * 2999 + 1) / 4, np.arange(3000), np.arange(3000) % 10))
