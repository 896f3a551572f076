"""Trajectories of scenes with poses: interpolated between cameras and along eight motion families, drawn by hash."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import seed_of
from ..steps import written
from . import generators, series
from .order_statistics import exact_percentile

#: Fixed value: cameras that an interpolated trajectory goes through.
WAYPOINTS = 6


def summary(cameras: DataFrame, scene: str) -> DataFrame:
    """scene, n, r (median distance from the centroid), cx, cy, cz, and low_ and high_ of x, y, z; cameras: scene, x, y, z."""
    box = cameras.groupBy(scene).agg(F.count("*").alias("n"), *[F.avg(a).alias(f"c{a}") for a in "xyz"], *[f(a).alias(f"{name}_{a}") for a in "xyz" for f, name in ((F.min, "low"), (F.max, "high"))])
    far = F.sqrt(reduce(lambda s, a: s + (F.col(a) - F.col(f"c{a}")) * (F.col(a) - F.col(f"c{a}")), "xyz", F.lit(0.0)))
    middle = exact_percentile(cameras.join(box, scene).select(scene, far.alias("far")), scene, "far", 0.5)
    return box.join(middle.withColumnRenamed("value", "r"), scene)


def _share(scene: str) -> Column:
    """A number in [0, 1) for each trajectory."""
    return seed_of(F.concat_ws(":", F.col(scene).cast("string"), "family", F.col("k").cast("string"), F.lit("camera"))) / F.lit(float(1 << 32))


def trajectories(cameras: DataFrame, scene: str, camera: str, frames: int) -> DataFrame:
    """scene, family, k, t, x, y, z, pose (16 numbers): the 40 trajectories of every scene that has cameras, looking at its centroid.

    cameras: scene, camera (a key that orders a scene's cameras), x, y, z. Ten trajectories go straight between up to six
    cameras, which are spread evenly over the scene's list from a place drawn by hash; the others follow their family from a
    camera and in a direction drawn by hash. Positions are smoothed in time and kept in the cameras' box and a tenth around.
    A scene's cameras are numbered in one sorted pass and met by number, so a scene with very many of them is not gathered.
    """
    # Both are read several times.
    stats = written(summary(cameras, scene), "scenes")
    placed = series.numbered(cameras.select(scene, camera, *"xyz"), scene, camera, out="__i").select(scene, F.col("__i").cast("long").alias("__i"), *[F.col(a).alias(f"a{a}") for a in "xyz"])
    placed = written(placed, "cameras")
    every = generators.trajectories(stats, scene).join(stats, scene)
    fixed = [c for c in stats.columns if c != scene]

    # Through cameras: the points are few for each trajectory, whatever the scene holds.
    m = F.least(F.col("n"), F.lit(WAYPOINTS))
    picked = every.where("family = 'interpolation'").select(scene, "family", "k", "n", m.alias("__m"), F.explode(F.sequence(F.lit(0), (m - 1).cast("int"))).alias("__j"))
    picked = picked.withColumn("__i", F.floor((_share(scene) + F.col("__j")) * F.col("n") / F.col("__m")).cast("long"))
    points = picked.join(placed, [scene, "__i"]).select(F.struct(scene, "family", "k").alias("__path"), F.col("__j").alias("__place"), *[F.col(f"a{a}").alias(a) for a in "xyz"])
    through = generators.waypoints(points, "__path", "__place", list("xyz"), frames)

    # Along the families.
    moving = every.where("family <> 'interpolation'").withColumn("__i", F.floor(_share(scene) * F.col("n")).cast("long")).join(placed, [scene, "__i"])
    direction = generators.unit(tuple(generators.normal(F.col(scene), F.col("family"), F.col("k"), a) for a in "xyz"))
    moving = moving.withColumns({f"d{a}": d for a, d in zip("xyz", direction, strict=True)}).withColumn("__path", F.struct(scene, "family", "k"))
    moving = moving.select("__path", "family", "r", *[f"{p}{a}" for p in "cad" for a in "xyz"], F.explode(F.sequence(F.lit(0), F.lit(frames - 1))).alias("t"))
    s = F.col("t") / F.lit(float(max(1, frames - 1)))
    centroid, anchor, way = (tuple(F.col(f"{p}{a}") for a in "xyz") for p in "cad")
    closed = {f: generators.family_position(f, s, F.col("r"), centroid, anchor, way) for f in generators.FAMILIES if f != "random_walk"}
    at = [F.coalesce(*[F.when(F.col("family") == f, p[i]) for f, p in closed.items()]) for i in range(3)]
    along = moving.where("family <> 'random_walk'").select("__path", "t", *[x.alias(a) for a, x in zip("xyz", at, strict=True)])
    w = Window.partitionBy("__path").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    drawn = lambda a: F.col("r") / 50 * generators.normal(F.col(f"__path.{scene}"), F.col("family"), F.col("__path.k"), F.col("t"), a)
    walks = moving.where("family = 'random_walk'").select("__path", "t", *[(F.col(f"a{a}") + F.sum(drawn(a)).over(w)).alias(a) for a in "xyz"])

    rows = through.unionByName(along).unionByName(walks)
    if frames / 200 > 0.5:
        for a in "xyz":
            rows = rows.drop(a).join(series.smoothed(rows, "__path", "t", a, frames / 200), ["__path", "t"]).withColumnRenamed("value", a)
    rows = rows.select(F.col(f"__path.{scene}").alias(scene), F.col("__path.family").alias("family"), F.col("__path.k").alias("k"), "t", *"xyz").join(stats.select(scene, *fixed), scene)
    kept = tuple(generators.clipped(F.col(a), F.col(f"low_{a}"), F.col(f"high_{a}")) for a in "xyz")
    rows = rows.select(scene, "family", "k", "t", *[x.alias(a) for a, x in zip("xyz", kept, strict=True)], *[f"c{a}" for a in "xyz"])
    return rows.select(scene, "family", "k", "t", *"xyz", generators.look_at(tuple(F.col(a) for a in "xyz"), centroid).alias("pose"))
