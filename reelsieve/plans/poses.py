"""Queries of pose artifacts, quaternions, probes and formatted metrics over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import pose_modes, series
from .checks import _r, _t
from .registry import query

_FRAMES_SQL = "SELECT user_id AS clip, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS t, value, count(*) OVER (PARTITION BY user_id) AS n FROM events"


def _clips(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Users as clips and their events as frames: poses, and cameras at another scale that some clips lack a frame of."""
    rows = series.numbered(_t(spark, sf_dir, "events").select(F.col("user_id").alias("clip"), "ts", "event_id", "value"), "clip", "ts", "event_id")
    t = F.col("t").cast("long")
    at = [F.col("value"), (t % 7).cast("double"), (t * t % 11).cast("double")]
    row = [[F.lit(float(i == j)) for j in range(3)] for i in range(3)]
    pose = F.array(*[x for i in range(3) for x in (*row[i], at[i])], F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))
    center = F.array(*[(a - 1) / (1 + F.col("clip") % 5) for a in at])
    k = F.array(*[F.lit(v) if isinstance(v, float) else v for v in (700.0 + F.col("clip") % 3, 0.0, 640.0, 0.0, 710.0, 360.0, 0.0, 0.0, 1.0)])
    poses, cameras = rows.select("clip", t.alias("t"), pose.alias("pose")), rows.select("clip", t.alias("t"), center.alias("center"), k.alias("k"))
    return poses, cameras.where(~((F.col("clip") % 6 == 0) & (F.col("t") == 0)))


@query(f"""
    WITH f AS ({_FRAMES_SQL}), c AS (SELECT clip, max(n) AS n FROM f GROUP BY 1)
    SELECT clip, CASE WHEN clip % 6 > 0 THEN n END AS frames, CASE WHEN clip % 6 > 0 THEN 700.0 + clip % 3 END AS fx, CASE WHEN clip % 6 > 0 THEN 640.0 END AS cx, CASE WHEN clip % 6 > 0 THEN 1.0 + clip % 5 END AS scale,
        CASE WHEN clip % 6 = 0 THEN 'camera count ' || (n - 1) || ' != pose count ' || n END AS error FROM c""")
def gt_pose_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips with given poses: their scale by robust alignment with the cameras, their intrinsics, or why they have none."""
    made, errors = pose_modes.gt_pose(*_clips(spark, sf_dir), "clip", "t")
    clips = made.groupBy("clip").agg(F.count("*").alias("frames"), F.min(F.col("intrinsics")[0]).alias("fx"), F.max(F.col("intrinsics")[2]).alias("cx"), _r(F.max("scale"), 5).alias("scale"), F.lit(None).cast("string").alias("error"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("frames", "long"), ("fx", "double"), ("cx", "double"), ("scale", "double"))]
    return clips.unionByName(errors.select("clip", *none, "error"))


@query(f"""
    WITH f AS ({_FRAMES_SQL})
    SELECT clip, count(*) AS frames, round(sum(CASE WHEN t % 3 = 0 THEN value / 8 ELSE 1 END), 6) AS scales FROM f WHERE clip % 6 > 0 GROUP BY 1""")
def estimated_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips with estimated poses and a metric scale for every third frame."""
    poses, cameras = _clips(spark, sf_dir)
    scales = poses.where("t % 3 = 0").select("clip", "t", (F.col("pose")[3] / 8).alias("scale"))
    made, _ = pose_modes.estimated(poses, cameras, "clip", "t", scales)
    return made.groupBy("clip").agg(F.count("*").alias("frames"), _r(F.sum("scale")).alias("scales"))


@query("""
    WITH e AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z, embedding[4]::DOUBLE AS w FROM embeddings),
    u AS (SELECT *, sqrt(x * x + y * y + z * z + w * w) * sign(CASE greatest(abs(x), abs(y), abs(z), abs(w)) WHEN abs(x) THEN x WHEN abs(y) THEN y WHEN abs(z) THEN z ELSE w END) AS n FROM e)
    SELECT vec_id, round(w / n, 6) + 0.0 AS qw, round(x / n, 6) + 0.0 AS qx, round(y / n, 6) + 0.0 AS qy, round(z / n, 6) + 0.0 AS qz FROM u""")
def pose_quaternions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rotations of quaternions x, y, z, w, turned back into w, x, y, z."""
    q = C.to_wxyz(C.from_xyzw(F.slice("embedding", 1, 4)), 3)
    rows = _t(spark, sf_dir, "embeddings").select("vec_id", q.alias("q"))
    return rows.select("vec_id", *[_r(F.col("q")[i]).alias(f"q{a}") for i, a in enumerate("wxyz")])


@query("""
    WITH p AS (SELECT p_partkey, p_size AS s, CASE WHEN p_partkey % 4 = 0 THEN 30000.0::DOUBLE / 1001 ELSE 24.0::DOUBLE END AS fps, CASE p_partkey % 3 WHEN 0 THEN p_size / 2.0::DOUBLE WHEN 1 THEN p_size + 1.0::DOUBLE ELSE 0.0::DOUBLE END AS d FROM part)
    SELECT p_partkey, s + 100 AS width, round(fps, 6) AS fps, d AS duration_s, CASE WHEN p_partkey % 5 = 0 THEN s * 10 ELSE round_even(fps * d, 0) END::BIGINT AS n_frames FROM p""")
def probed_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as probe texts that have their duration and frame number in several places or nowhere."""
    n, s = F.col("p_partkey"), F.col("p_size")
    stream = F.struct(
        (s + 100).alias("width"), F.lit(720).alias("height"), F.when(n % 4 == 0, "30000/1001").when(n % 4 == 1, "").alias("r_frame_rate"), F.lit("24/1").alias("avg_frame_rate"),
        F.when(n % 5 == 0, (s * 10).cast("string")).when(n % 5 == 1, "N/A").when(n % 5 == 2, "0").alias("nb_frames"), F.when(n % 3 == 0, (s / 2).cast("string")).when(n % 3 == 1, "N/A").alias("duration"),
    )
    whole = F.struct(F.when(n % 3 == 1, (s + 1).cast("string")).otherwise("N/A").alias("duration"))
    raw = F.to_json(F.struct(F.array(stream).alias("streams"), whole.alias("format")))
    rows = _t(spark, sf_dir, "part").select("p_partkey", C.probed(raw).alias("v"))
    return rows.select("p_partkey", "v.width", _r(F.col("v.fps")).alias("fps"), "v.duration_s", "v.n_frames")


@query("""
    SELECT user_id, coalesce(printf('%.6f', m), 'N/A') AS metres, coalesce(printf('%.2f', m * 1000), 'N/A') AS millimetres, coalesce(printf('%.4f', m / 7), 'N/A') AS ssim FROM (SELECT user_id, avg(value) FILTER (event_type = 'error') / 7 AS m FROM events GROUP BY 1)""")
def metric_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics as a report shows them."""
    events = _t(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.when(F.col("event_type") == "error", F.col("value")).alias("value"))
    rows = series.ordered_mean(events, "user_id", ["ts", "event_id"], "value").select("user_id", (F.col("mean") / 7).alias("m"))
    return rows.select("user_id", C.fixed(F.col("m"), 6).alias("metres"), C.fixed(F.col("m"), 2, 1000).alias("millimetres"), C.fixed(F.col("m") / 7, 4).alias("ssim"))
