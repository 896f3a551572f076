"""Generated rows: jobs per source, camera trajectories in closed form and as hashed random walks."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import seed_of

#: Trajectories of each family for a scene, next to ten interpolated ones.
FAMILIES = {"orbit": 4, "spiral": 4, "dolly": 4, "flythrough": 4, "random_walk": 4, "crane": 3, "pendulum": 3, "compound": 4}
INTERPOLATED = 10
#: Frames that one row makes at a time.
_BLOCK = 4096


def jobs(sources: DataFrame, name: str, target: str, smoke: bool = False) -> DataFrame:
    """One row per clip to make: clip_id `name_000000`, k."""
    n = F.lit(1) if smoke else F.col(target)
    rows = sources.where(n > 0).select(name, F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))).alias("k"))
    return rows.withColumn("clip_id", F.concat(F.col(name), F.lit("_"), F.lpad(F.col("k").cast("string"), 6, "0")))


def trajectories(scenes: DataFrame, scene: str) -> DataFrame:
    """The 40 trajectories of every scene: family, k."""
    every = [("interpolation", k) for k in range(INTERPOLATED)] + [(f, k) for f, n in FAMILIES.items() for k in range(n)]
    return scenes.select(scene, F.explode(F.array(*[F.struct(F.lit(f).alias("family"), F.lit(k).alias("k")) for f, k in every])).alias("x")).select(scene, "x.family", "x.k")


def normal(*parts: Column | str) -> Column:
    """A standard normal number drawn by hash from the parts (Box and Muller)."""
    text = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    u = [(seed_of(F.concat_ws(":", *[p.cast("string") for p in text], F.lit(end))) + 1) / F.lit(float((1 << 32) + 1)) for end in "ab"]
    return F.sqrt(-2 * F.log(u[0])) * F.cos(2 * math.pi * u[1])


Vector = tuple[Column, Column, Column]


def unit(v: Vector, least: float = 1e-6) -> Vector:
    """v / max(length, least)."""
    length = F.greatest(F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2]), F.lit(least))
    return v[0] / length, v[1] / length, v[2] / length


def cross(a: Vector, b: Vector) -> Vector:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def look_at(position: Vector, target: Vector) -> Column:
    """The camera's pose (16 numbers, row by row) at position: columns right, up, forward, position; up is y."""
    forward = unit(tuple(t - p for t, p in zip(target, position, strict=True)))
    right = unit(cross((F.lit(0.0), F.lit(1.0), F.lit(0.0)), forward))
    up = cross(forward, right)
    rows = [x for k in range(3) for x in (right[k], up[k], forward[k], position[k])]
    return F.array(*[x.cast("double") for x in rows], F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))


def family_position(family: str, s: Column, radius: Column, centroid: Vector, anchor: Vector, direction: Vector) -> Vector:
    """x, y, z at s in [0, 1] for the closed-form families.

    centroid and radius: of the scene; anchor: one of its cameras; direction: a unit vector drawn for the trajectory. The
    ends, turns and widths of the families are fixed values.
    """
    turn = 2 * math.pi * s
    toward = unit(tuple(c - a for c, a in zip(centroid, anchor, strict=True)))
    circle = (radius * F.cos(turn), F.lit(0.0), radius * F.sin(turn))
    wide = radius * (1 + 0.5 * s)
    along = {
        "orbit": (centroid, circle),
        "spiral": (centroid, (wide * F.cos(2 * turn), 0.5 * radius * (s - 0.5), wide * F.sin(2 * turn))),
        "dolly": (anchor, tuple((s - 0.5) * radius * d for d in toward)),
        "flythrough": (anchor, tuple((s - 0.5) * 2 * radius * d for d in direction)),
        "crane": (anchor, tuple((s - 0.5) * radius * d for d in direction)),
        "pendulum": (anchor, tuple(0.5 * radius * F.sin(turn) * d for d in direction)),
        "compound": (centroid, tuple(c + 0.3 * radius * F.sin(3 * turn) * d for c, d in zip(circle, direction, strict=True))),
    }
    if family not in along:
        raise ValueError(f"{family} has no closed form")
    start, move = along[family]
    return tuple(a + b for a, b in zip(start, move, strict=True))


def random_walk(rows: DataFrame, key: str, frames: int, radius: str) -> DataFrame:
    """key, t, x, y, z: running sums of normal steps of radius / 50, drawn by hash from the key and the frame."""
    every = rows.select(key, radius, F.explode(F.sequence(F.lit(0), F.lit(frames - 1))).alias("t"))
    w = Window.partitionBy(key).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    return every.select(key, "t", *[F.sum(F.col(radius) / 50 * normal(F.col(key), F.col("t"), a)).over(w).alias(a) for a in "xyz"])


def waypoints(points: DataFrame, key: str, place: str, coordinates: list[str], frames: int | Callable[[Column], Column]) -> DataFrame:
    """key, t and the coordinates on the straight pieces between the points, which are evenly spaced in time; one point stays put.

    frames may be a function of a key's number of points. Frames are dealt in blocks and meet their points by place: a key
    of any length is in no task as a whole. Places are 0, 1, 2, ...
    """
    n = points.groupBy(key).agg(F.count("*").alias("__n"))
    last = F.greatest(F.lit(0), (frames(F.col("__n")) if callable(frames) else F.lit(frames)) - 1).cast("int")
    grid = n.select(key, "__n", last.alias("__last")).withColumn("__from", F.explode(F.sequence(F.lit(0), "__last", F.lit(_BLOCK))))
    grid = grid.withColumn("t", F.explode(F.sequence("__from", F.least("__last", F.col("__from") + (_BLOCK - 1))))).withColumn("__s", F.col("t") * (F.col("__n") - 1) / F.greatest(F.lit(1), "__last").cast("double"))
    grid = grid.withColumn(place, F.least(F.floor("__s"), F.greatest(F.col("__n") - 2, F.lit(0))).cast("int"))
    here = points.select(key, F.col(place).cast("int").alias(place), *coordinates)
    ends = here.join(here.select(key, (F.col(place) - 1).alias(place), *[F.col(c).alias(f"__{c}") for c in coordinates]), [key, place], "left").withColumns({f"__{c}": F.coalesce(f"__{c}", c) for c in coordinates})
    part = F.col("__s") - F.col(place)
    return grid.join(ends, [key, place]).select(key, "t", *[(F.col(c) + (F.col(f"__{c}") - F.col(c)) * part).alias(c) for c in coordinates])


def zoom_focal(t: Column, frames: int, start: float, end: float) -> Column:
    """The exact focal length of a clip that zooms evenly from start to end."""
    return start + (end - start) * t / F.lit(float(max(1, frames - 1)))


def stub_poses(clips: DataFrame, clip: str, frames: int, step: float = 0.1, focal: float = 700.0, width: int = 1280, height: int = 720) -> DataFrame:
    """clip, t, pose (16 numbers: no turn, x = t * step), fx, fy, cx, cy, scale: stand-ins where no pose runner is given."""
    rows = clips.select(clip, F.explode(F.sequence(F.lit(0), F.lit(frames - 1))).alias("t"))
    pose = F.array(*[F.col("t") * F.lit(step) if i == 3 else F.lit(float(i % 5 == 0)) for i in range(16)])
    return rows.select(clip, "t", pose.alias("pose"), F.lit(focal).alias("fx"), F.lit(focal).alias("fy"), F.lit(width / 2).alias("cx"), F.lit(height / 2).alias("cy"), F.lit(1.0).alias("scale"))


def clipped(v: Column, low: Column, high: Column, margin: float = 0.1) -> Column:
    """v inside the scene's box, widened by a margin."""
    pad = (high - low) * margin
    return F.least(F.greatest(v, low - pad), high + pad)
