"""Queries of validation, motion families, review, reports and run control over the driver tables.

Cameras stand for frames: a nation is a scene and its customers, in the order of their keys, are its frames; documents stand
for samples, their sources for groups. Floats are rounded on both sides.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import colour, generators, geometry, hooks, merge, sampling, scenes, series, validation
from .registry import query


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _r(c: Column | str, n: int = 6) -> Column:
    """Rounded, and never minus zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, n) + 0.0


# --- arrays of a clip ---------------------------------------------------------------------------------------------------

_CAMERA_SQL = """
    WITH c AS (SELECT c_nationkey AS scene, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS t, c_custkey % 360 * pi() / 180 AS a, CASE WHEN c_nationkey % 5 = 0 AND c_custkey % 3 = 0 THEN 1.5 ELSE 1.0 END AS k, c_acctbal, c_custkey FROM customer),
    p AS (SELECT *, CASE WHEN t = 0 AND scene % 2 = 0 THEN 0.0 ELSE a END AS b FROM c)"""


def _cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("scene"), "c_custkey", "c_acctbal")
    rows = series.numbered(rows, "scene", "c_custkey").withColumn("k", F.when((F.col("scene") % 5 == 0) & (F.col("c_custkey") % 3 == 0), 1.5).otherwise(1.0))
    b = F.when((F.col("t") == 0) & (F.col("scene") % 2 == 0), 0.0).otherwise(F.col("c_custkey") % 360 * math.pi / 180)
    c, s, k, zero, one = F.cos(b), F.sin(b), F.col("k"), F.lit(0.0), F.lit(1.0)
    return rows.withColumn("pose", F.array(c, -s * k, zero, zero, s, c * k, zero, zero, zero, zero, one, zero, zero, zero, zero, one))


@query(_CAMERA_SQL + """
    SELECT scene, round(avg(k), 6) AS det_mean, round(stddev_pop(k), 6) AS det_std, round(max(greatest(abs(cos(b) ** 2 + k * k * sin(b) ** 2 - 1), abs(sin(b) * cos(b) * (1 - k * k)), abs(sin(b) ** 2 + k * k * cos(b) ** 2 - 1))), 6) AS orth_err,
           round(max(CASE WHEN t = 0 THEN greatest(abs(cos(b) - 1), abs(k * sin(b)), abs(sin(b)), abs(k * cos(b) - 1)) END), 6) AS first_dev, abs(avg(k) - 1) <= 1e-3 AND max(abs(k - 1)) < 1e-3 AS so3_valid,
           max(CASE WHEN t = 0 THEN greatest(abs(cos(b) - 1), abs(k * sin(b)), abs(sin(b)), abs(k * cos(b) - 1)) END) <= 1e-2 AS first_frame_ok FROM p GROUP BY 1""")
def pose_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Determinants, orthogonality and the first frame of every scene's poses."""
    got = validation.rotations(_cameras(spark, sf_dir), "scene", "t", "pose")
    return got.select("scene", *[_r(c).alias(c) for c in ("det_mean", "det_std", "orth_err", "first_dev")], "so3_valid", "first_frame_ok")


@query("""
    WITH p AS (SELECT c_nationkey AS scene, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS t, radians(c_custkey % 360) AS g, radians(c_custkey % 350) AS h, c_acctbal::DOUBLE / 1000 AS x FROM customer),
    m AS (SELECT a.scene, a.t // 2 AS i, cos((b.g - a.g) - (b.h - a.h)) AS c,
                 cos(a.g) * (b.x - a.x) + sin(a.g) * 2 - cos(a.h) * (b.x - a.x + b.t % 7 - a.t % 7) - sin(a.h) * 2 AS dx,
                 cos(a.g) * 2 - sin(a.g) * (b.x - a.x) - cos(a.h) * 2 + sin(a.h) * (b.x - a.x + b.t % 7 - a.t % 7) AS dy
          FROM p a JOIN p b ON a.scene = b.scene AND b.t = a.t + 2 WHERE a.t % 2 = 0),
    e AS (SELECT scene, i >= count(*) OVER (PARTITION BY scene) // 2 AS late, degrees(acos(greatest(-1, least(1, c)))) AS rot, sqrt(dx * dx + dy * dy) AS trans FROM m)
    SELECT scene, round(avg(rot), 4) AS rot_mean, round(avg(trans), 4) AS trans_mean, round(avg(rot) FILTER (late), 4) AS rot_2nd_half, round(avg(trans) FILTER (late), 4) AS trans_2nd_half FROM e GROUP BY 1""")
def relative_motion_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of each scene's motion over two frames, whole and second half."""
    rows = _t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("scene"), "c_custkey", (F.col("c_acctbal").cast("double") / 1000).alias("x"))
    rows = series.numbered(rows, "scene", "c_custkey")

    def pose(turn: Column, x: Column) -> Column:
        c, s, zero, one = F.cos(turn), F.sin(turn), F.lit(0.0), F.lit(1.0)
        return F.array(c, -s, zero, x, s, c, zero, F.col("t").cast("double"), zero, zero, one, zero, zero, zero, zero, one)

    key = F.col("c_custkey")
    rows = rows.select("scene", "t", pose(F.radians(key % 360), F.col("x")).alias("given"), pose(F.radians(key % 350), F.col("x") + F.col("t") % 7).alias("found"))
    got = geometry.relative_motion(rows, "scene", "t", 2, "found", "given")
    return got.select("scene", *[_r(c, 4).alias(c) for c in ("rot_mean", "trans_mean", "rot_2nd_half", "trans_2nd_half")])


@query("""
    WITH f AS (SELECT c_nationkey AS scene, CASE WHEN c_custkey % 40 = 0 THEN 'nan'::DOUBLE ELSE c_acctbal END AS poses, CASE WHEN c_custkey % 55 = 0 THEN 'inf'::DOUBLE ELSE c_acctbal END AS scale FROM customer),
    n AS (SELECT scene, count(*) FILTER (NOT isfinite(poses)) AS a, count(*) FILTER (NOT isfinite(scale)) AS b FROM f GROUP BY 1)
    SELECT scene, a AS n_bad_poses, b AS n_bad_scale, array_to_string(list_filter([CASE WHEN a > 0 THEN 'poses: ' || a || ' non-finite values' END, CASE WHEN b > 0 THEN 'scale: ' || b || ' non-finite values' END], lambda x: x IS NOT NULL), '; ') AS why FROM n""")
def finite_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that aren't finite, by array."""
    bal = F.col("c_acctbal")
    rows = _t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("scene"), F.when(F.col("c_custkey") % 40 == 0, float("nan")).otherwise(bal).alias("poses"), F.when(F.col("c_custkey") % 55 == 0, float("inf")).otherwise(bal).alias("scale"))
    return validation.finite_counts(rows, "scene", "poses", "scale").select("scene", "n_bad_poses", "n_bad_scale", F.array_join("reasons", "; ").alias("why"))


@query("""
    WITH o AS (SELECT o_custkey % 50 AS clip, count(*) AS poses, count(DISTINCT o_orderkey) AS intr, count(*) FILTER (o_orderkey % 997 <> 0) AS scale FROM orders GROUP BY 1)
    SELECT clip, poses = intr AND poses = scale AS ok, CASE WHEN poses = intr AND poses = scale THEN '' ELSE 't_mismatch: poses=' || poses || ' intr=' || intr || ' scale=' || scale END AS why FROM o""")
def length_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips of which all arrays have one length."""
    n = _t(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 50).alias("clip")).agg(F.count("*").alias("poses"), F.count_distinct("o_orderkey").alias("intr"), F.count_if(F.col("o_orderkey") % 997 != 0).alias("scale"))
    ok, why = validation.aligned(poses=F.col("poses"), intr=F.col("intr"), scale=F.col("scale"))
    return n.select("clip", ok.alias("ok"), F.coalesce(why, F.lit("")).alias("why"))


@query("SELECT s_nationkey AS scene, bool_and(s_acctbal > -500 AND s_acctbal + 500 > 0 AND isfinite(s_acctbal)) AS valid, count(*) AS n FROM supplier GROUP BY 1")
def output_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs that are finite with positive focal lengths."""
    rows = _t(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("scene"), (F.col("s_acctbal") + 500).alias("fx"), "s_acctbal")
    return validation.valid_outputs(rows, "scene", ("fx", "fx"), "s_acctbal")


@query("""
    SELECT user_id, round(avg((value < 100)::INT), 6) AS black_ratio, avg((value < 100)::INT) <= 0.3 AS passed, CASE WHEN avg((value < 100)::INT) > 0.3 THEN 'near_black_frac=' || printf('%.2f', 100 * avg((value < 100)::INT)) || '% > 30%' ELSE 'ok' END AS reason FROM events GROUP BY 1""")
def black_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of dark frames, with the limit in percent."""
    return validation.black_frames(_t(spark, sf_dir, "events"), "user_id", "value", 100).withColumn("black_ratio", _r("black_ratio"))


@query("SELECT doc_id, CASE WHEN n_chars % 5 > 0 AND n_chars % 5 <> n_chars % 7 THEN 'length_mismatch: video=' || (n_chars % 5) || ' npy=' || (n_chars % 7) END AS why FROM documents")
def length_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded length against the arrays' length."""
    n = F.col("n_chars")
    return _t(spark, sf_dir, "documents").select("doc_id", validation.length_mismatch(n % 5, n % 7).alias("why"))


@query("SELECT l_returnflag, l_linestatus, count(*) FILTER (l_quantity < 50 AND l_discount > 0.03 AND l_linenumber <> 3) AS n_pass, count(*) AS n FROM lineitem GROUP BY 1, 2")
def worker_pass_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips that a worker passes: flow, quality and no reasons."""
    why = C.reasons(third=F.col("l_linenumber") == 3)
    good = validation.worker_passes(F.col("l_quantity"), F.col("l_discount") * 10, why)
    return _t(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count_if(good).alias("n_pass"), F.count("*").alias("n"))


_CAPTION_SQL = "regexp_replace(text, '^\\s+|\\s+$', '', 'g')"


@query(f"SELECT conv_id, turn, CASE WHEN lower({_CAPTION_SQL}) IN ('', 'n/a', 'none', 'no caption', 'null', 'tbd') OR length({_CAPTION_SQL}) < 50 THEN printf('caption_len=%d < 50 or placeholder', length({_CAPTION_SQL})) END AS why FROM conversations")
def caption_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions that are placeholders or too short."""
    return _t(spark, sf_dir, "conversations").select("conv_id", "turn", C.caption_reason(F.col("text"), 50).alias("why"))


@query("""
    WITH s AS (SELECT doc_id, n_chars % 97 AS j, doc_id % 11 = 0 AS hard, n_chars < 200 AS short, n_chars % 13 = 0 AS word, (n_chars % 200)::DOUBLE AS sat FROM documents),
    f AS (SELECT *, list_filter([CASE WHEN j > 10 THEN 'n_jumps=' || j || ' > max_jumps_flag=10' END, CASE WHEN short THEN 'caption_len=3 < 50 or placeholder' END, CASE WHEN word THEN 'camera_word: ''pan left'' (+1 more)' END, CASE WHEN sat > 180 THEN 'saturation=' || printf('%.1f', sat) || ' out of [0.0,180.0]' END], lambda x: x IS NOT NULL) AS flags FROM s)
    SELECT doc_id, CASE WHEN hard OR j > 50 THEN 'fail' WHEN len(flags) > 0 THEN 'flag' ELSE 'pass' END AS verdict,
           CASE WHEN hard THEN 'so3_invalid: det_mean=' || printf('%.6f', j / 10.0) WHEN j > 50 THEN 'n_jumps=' || j || ' > max_jumps_fail=50' ELSE array_to_string(flags, '|') END AS why FROM f""")
def stage1_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict and reasons in words, every branch of the rules."""
    n = F.col("n_chars")
    rows = _t(spark, sf_dir, "documents").select(
        "doc_id",
        (n % 97).alias("n_jumps"),
        F.when(F.col("doc_id") % 11 == 0, F.array(F.format_string("so3_invalid: det_mean=%.6f", (n % 97) / 10.0))).otherwise(F.array().cast("array<string>")).alias("hard_reasons"),
        F.repeat(F.lit("x"), F.when(n < 200, 3).otherwise(60)).alias("caption"),
        F.when(n % 13 == 0, F.array(F.lit("pan left"), F.lit("zoom in"))).otherwise(F.array().cast("array<string>")).alias("words"),
        (n % 200).cast("double").alias("sat"),
    )
    v, why = validation.stage1(rows, F.lit(50), F.lit(10), F.lit(50), F.col("words"), (F.col("sat"), F.lit(0.0), F.lit(180.0)))
    return rows.select("doc_id", v.alias("verdict"), F.array_join(why, "|").alias("why"))


@query("""
    WITH s AS (SELECT source, lang = 'de' AS a, n_chars < 100 AS b FROM documents)
    SELECT source, count(*) FILTER (NOT a AND NOT b) AS n_ok, count(*) FILTER (a OR b) AS n_fail, array_to_string(list_filter([CASE WHEN bool_or(b) THEN 'caption empty' END, CASE WHEN bool_or(a) THEN 'poses dtype' END], lambda x: x IS NOT NULL), '|') AS reasons FROM s GROUP BY 1""")
def shard_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples that hold and break a shard's constraints, by shard."""
    why = F.array_compact(F.array(F.when(F.col("lang") == "de", "poses dtype"), F.when(F.col("n_chars") < 100, "caption empty")))
    got = validation.shard_audit(_t(spark, sf_dir, "documents").select("source", why.alias("why")), "source", "why")
    return got.withColumn("reasons", F.array_join("reasons", "|"))


@query("""
    WITH d AS (SELECT doc_id, CASE quality WHEN 1 THEN 'pass' WHEN 0 THEN CASE WHEN doc_id % 3 = 0 THEN 'maybe' ELSE '' END END AS v, CASE WHEN toxic = 1 THEN 'bad_mood' ELSE 'other' END AS i FROM labels), r AS (SELECT doc_id FROM documents WHERE doc_id % 10 > 1)
    SELECT doc_id, 'error' AS level, 'id is not in the review list' AS message FROM d WHERE doc_id NOT IN (SELECT doc_id FROM r)
    UNION ALL SELECT doc_id, 'error', 'invalid verdict ' || v FROM d WHERE v NOT IN ('', 'pass', 'fail') UNION ALL SELECT doc_id, 'warning', 'unknown issue ' || i FROM d WHERE i = 'bad_mood'""")
def decision_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors and warnings of review decisions."""
    q = F.col("quality")
    given = _t(spark, sf_dir, "labels").select("doc_id", F.when(q == 1, "pass").when(q == 0, F.when(F.col("doc_id") % 3 == 0, "maybe").otherwise("")).alias("v"), F.when(F.col("toxic") == 1, "bad_mood").otherwise("other").alias("i"))
    return validation.decisions(given, _t(spark, sf_dir, "documents").where("doc_id % 10 > 1"), "doc_id", "v", "i")


@query("""
    WITH f AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS t, value FROM events)
    SELECT user_id, t, round(value, 6) AS value FROM f WHERE t % 10 = 0""")
def every_tenth_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames picked by number, each checked to lie in its clip."""
    frames = series.numbered(_t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value"), "user_id", "ts", "event_id").select("user_id", F.col("t").cast("long").alias("t"), "value")
    picks = frames.where("t % 10 = 0").select("user_id", F.col("t").alias("at"))
    return validation.selected(frames, picks, "user_id", "t", "at").select("user_id", "t", _r("value").alias("value"))


# --- cameras and poses --------------------------------------------------------------------------------------------------


@query("SELECT c_custkey, round(c_acctbal, 6) AS fx, round(c_acctbal + 1, 6) AS fy, 640.0 AS cx, 360.0 AS cy, round(2 * c_acctbal + 1002, 6) AS total FROM customer")
def intrinsics_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Camera matrices packed and unpacked."""
    fx = F.col("c_acctbal")
    rows = _t(spark, sf_dir, "customer").select("c_custkey", geometry.to_matrix(fx, fx + 1, F.lit(640.0), F.lit(360.0)).alias("k"))
    return rows.select("c_custkey", *[_r(v).alias(n) for n, v in geometry.unpacked(F.col("k")).items()], _r(F.aggregate("k", F.lit(0.0), lambda a, x: a + x)).alias("total"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 2 THEN '1,0,0,' || (c_custkey % 9) ELSE '1,2,3,' || (c_custkey % 9) END AS first_row, CASE c_custkey % 3 WHEN 0 THEN 16 ELSE 1 END AS last_sum FROM customer")
def pose_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poses given by 16, 12 or 3 numbers."""
    n, x = F.col("c_custkey") % 3, (F.col("c_custkey") % 9).cast("double")
    row = [F.lit(v) for v in (1.0, 2.0, 3.0)]
    given = F.when(n == 0, F.array(*row, x, *[F.lit(0.0)] * 8, F.lit(5.0), F.lit(5.0), F.lit(5.0), F.lit(1.0))).when(n == 1, F.array(*row, x, *[F.lit(0.0)] * 8)).otherwise(F.array(x, F.lit(2.0), F.lit(3.0)))
    pose = geometry.pose_of(given)
    rows = _t(spark, sf_dir, "customer").select("c_custkey", n.alias("n"), pose.alias("p"))
    return rows.select("c_custkey", F.array_join(F.transform(F.slice("p", 1, 4), lambda v: v.cast("int").cast("string")), ",").alias("first_row"), F.aggregate(F.slice("p", 13, 4), F.lit(0.0), lambda a, v: a + v).cast("int").alias("last_sum"))


@query("""
    SELECT n_nationkey, CASE n_regionkey % 3 WHEN 0 THEN 'default' WHEN 1 THEN 'gt_pose' ELSE 'gt_depth' END AS mode, CASE n_regionkey % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 1.0 ELSE n_nationkey / 10.0 END AS scale FROM nation""")
def mode_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips of three pose modes, each by its own plan."""
    k = F.col("n_regionkey") % 3
    clips = _t(spark, sf_dir, "nation").select("n_nationkey", F.when(k == 0, "default").when(k == 1, "gt_pose").otherwise("gt_depth").alias("mode"))
    plans = {"default": lambda d: d.withColumn("scale", F.lit(0.0)), "gt_pose": lambda d: d.withColumn("scale", F.lit(1.0)), "gt_depth": lambda d: d.withColumn("scale", F.col("n_nationkey") / 10.0)}
    return geometry.by_mode(clips, "mode", plans)


_U_SQL = "((('0x' || substr(sha1(n_nationkey || ':{k}:{a}:{end}'), 1, 8))::BIGINT + 1) / 4294967297.0::DOUBLE)"


def _normal_sql(k: str, a: str) -> str:
    u = [_U_SQL.format(k=k, a=a, end=e) for e in "ab"]
    return f"sqrt(-2 * ln({u[0]})) * cos(2 * pi() * {u[1]})"


def _path_normal_sql(parts: str, a: str) -> str:
    u = [f"((('0x' || substr(sha1({parts} || ':{a}:{end}'), 1, 8))::BIGINT + 1) / 4294967297.0::DOUBLE)" for end in "ab"]
    return f"(sqrt(-2 * ln({u[0]})) * cos(2 * pi() * {u[1]}))"


_SCENE_SQL = f"""
    WITH n AS (SELECT n_nationkey, 1.0::DOUBLE + n_regionkey AS r, 0.5::DOUBLE * n_nationkey AS cx, 1.0::DOUBLE AS cy, -2.0::DOUBLE AS cz, n_nationkey + 3.0::DOUBLE AS ax, 4.0::DOUBLE AS ay, 1.0::DOUBLE AS az, {', '.join(_normal_sql('0', a) + ' AS g' + a for a in 'xyz')} FROM nation),
    m AS (SELECT *, sqrt(gx * gx + gy * gy + gz * gz) AS gl, sqrt((cx - ax) ** 2 + (cy - ay) ** 2 + (cz - az) ** 2) AS al FROM n),
    v AS (SELECT *, gx / gl AS dx, gy / gl AS dy, gz / gl AS dz, (cx - ax) / al AS tx, (cy - ay) / al AS ty, (cz - az) / al AS tz FROM m),
    s AS (SELECT v.*, g.t::INT AS t, g.t / 60.0::DOUBLE AS s, 2 * pi() * (g.t / 60.0::DOUBLE) AS w FROM v, (SELECT unnest(generate_series(0, 60)) AS t) g)"""
_FAMILY_SQL = {
    "orbit": "cx + r * cos(w), cy, cz + r * sin(w)",
    "spiral": "cx + r * (1 + 0.5 * s) * cos(2 * w), cy + 0.5 * r * (s - 0.5), cz + r * (1 + 0.5 * s) * sin(2 * w)",
    "dolly": "ax + (s - 0.5) * r * tx, ay + (s - 0.5) * r * ty, az + (s - 0.5) * r * tz",
    "flythrough": "ax + (2 * s - 1) * r * dx, ay + (2 * s - 1) * r * dy, az + (2 * s - 1) * r * dz",
    "crane": "ax + (s - 0.5) * r * dx, ay + (s - 0.5) * r * dy, az + (s - 0.5) * r * dz",
    "pendulum": "ax + 0.5 * r * sin(w) * dx, ay + 0.5 * r * sin(w) * dy, az + 0.5 * r * sin(w) * dz",
    "compound": "cx + r * cos(w) + 0.3 * r * sin(3 * w) * dx, cy + 0.3 * r * sin(3 * w) * dy, cz + r * sin(w) + 0.3 * r * sin(3 * w) * dz",
}


def _scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey").cast("double")
    direction = generators.unit(tuple(generators.normal(F.col("n_nationkey"), "0", a) for a in "xyz"))
    return _t(spark, sf_dir, "nation").select("n_nationkey", (F.col("n_regionkey") + 1.0).alias("r"), (0.5 * n).alias("cx"), F.lit(1.0).alias("cy"), F.lit(-2.0).alias("cz"), (n + 3).alias("ax"), F.lit(4.0).alias("ay"), F.lit(1.0).alias("az"), *[d.alias(f"d{a}") for d, a in zip(direction, "xyz", strict=True)])


def _vector(name: str) -> generators.Vector:
    return tuple(F.col(f"{name}{a}") for a in "xyz")


def _family(name: str):
    def motion(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _scenes(spark, sf_dir).select("*", F.explode(F.sequence(F.lit(0), F.lit(60))).alias("t"))
        at = generators.family_position(name, F.col("t") / 60.0, F.col("r"), _vector("c"), _vector("a"), _vector("d"))
        return rows.select("n_nationkey", "t", *[_r(v).alias(a) for v, a in zip(at, "xyz", strict=True)])

    motion.__name__ = f"family_{name}"
    motion.__doc__ = f"The {name} of every scene in closed form."
    x, y, z = _FAMILY_SQL[name].split(", ")
    return query(_SCENE_SQL + f" SELECT n_nationkey, t, round({x}, 6) + 0.0 AS x, round({y}, 6) + 0.0 AS y, round({z}, 6) + 0.0 AS z FROM s")(motion)


_FAMILIES = [_family(name) for name in _FAMILY_SQL]


@query(f"""
    WITH g AS (SELECT n_nationkey, 1.0::DOUBLE + n_regionkey AS r, unnest(generate_series(0, 30))::INT AS t FROM nation), d AS (SELECT n_nationkey, t, {', '.join(f"r / 50 * ({_normal_sql("' || t || '", a)}) AS {a}" for a in 'xyz')} FROM g)
    SELECT n_nationkey, t, {', '.join(f"round(sum({a}) OVER (PARTITION BY n_nationkey ORDER BY t), 6) + 0.0 AS {a}" for a in 'xyz')} FROM d""")
def family_random_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A random walk for every scene, drawn by hash."""
    rows = _t(spark, sf_dir, "nation").select("n_nationkey", (F.col("n_regionkey") + 1.0).alias("r"))
    return generators.random_walk(rows, "n_nationkey", 31, "r").select("n_nationkey", "t", *[_r(a).alias(a) for a in "xyz"])


@query(_SCENE_SQL + """,
    p AS (SELECT n_nationkey, t, cx + r * cos(w) - cx AS fx, cz + r * sin(w) - cz AS fz, r FROM s WHERE t % 10 = 0)
    SELECT n_nationkey, t, round(-fz / r, 6) + 0.0 AS right_x, round(fx / r, 6) + 0.0 AS right_z, round(-fx / r, 6) + 0.0 AS forward_x, round(-fz / r, 6) + 0.0 AS forward_z FROM p""")
def look_at_poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poses on an orbit that look at the scene's centre."""
    rows = _scenes(spark, sf_dir).select("*", F.explode(F.sequence(F.lit(0), F.lit(60), F.lit(10))).alias("t"))
    at = generators.family_position("orbit", F.col("t") / 60.0, F.col("r"), _vector("c"), _vector("a"), _vector("d"))
    pose = generators.look_at(at, _vector("c"))
    rows = rows.select("n_nationkey", "t", pose.alias("p"))
    return rows.select("n_nationkey", "t", _r(F.col("p")[0]).alias("right_x"), _r(F.col("p")[8]).alias("right_z"), _r(F.col("p")[2]).alias("forward_x"), _r(F.col("p")[10]).alias("forward_z"))


_POINTS_SQL = "WITH p AS (SELECT c_nationkey AS scene, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS k, c_acctbal AS v FROM customer), n AS (SELECT scene, count(*) AS n FROM p GROUP BY 1)"


@query(_POINTS_SQL + """,
    g AS (SELECT scene, n, unnest(generate_series(0, 4 * (n - 1)))::INT AS t FROM n), a AS (SELECT *, t / 4.0::DOUBLE AS s, least(floor(t / 4.0::DOUBLE), greatest(n - 2, 0)) AS i FROM g)
    SELECT a.scene, t, round(p.v + (coalesce(q.v, p.v) - p.v) * (s - i), 6) + 0.0 AS v FROM a JOIN p ON p.scene = a.scene AND p.k = i LEFT JOIN p q ON q.scene = a.scene AND q.k = i + 1""")
def waypoint_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions between all of a scene's evenly spaced waypoints, four frames for each piece; the same stretches per-frame intrinsics."""
    rows = series.numbered(_t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("scene"), "c_custkey", F.col("c_acctbal").alias("v")), "scene", "c_custkey", out="k")
    return series.resampled(rows, "scene", "k", ["v"], lambda n: 4 * (n - 1) + 1).select("scene", "t", _r("v").alias("v"))


@query("SELECT n_nationkey, t::INT AS t, round(500 + 400 * t / 48.0, 6) AS focal, round(t * 0.1, 6) AS x FROM nation, (SELECT unnest(generate_series(0, 48)) AS t)")
def zoom_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in poses and the exact focal track of a zoom."""
    rows = generators.stub_poses(_t(spark, sf_dir, "nation"), "n_nationkey", 49)
    return rows.select("n_nationkey", "t", _r(generators.zoom_focal(F.col("t"), 49, 500.0, 900.0)).alias("focal"), _r(F.col("pose")[3]).alias("x"))


_PATHS_SQL = f"""
    WITH cam AS (SELECT c_nationkey AS s, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS i, c_acctbal / 777 AS x, (c_custkey % 7)::DOUBLE AS y, (c_custkey % 11)::DOUBLE AS z FROM customer),
    box AS (SELECT s, count(*) AS n, {', '.join(f'avg({a}) AS c{a}, min({a}) AS l{a}, max({a}) AS h{a}' for a in 'xyz')} FROM cam GROUP BY 1),
    st AS (SELECT box.*, r FROM box JOIN (SELECT s, quantile_cont(sqrt((x - cx) ** 2 + (y - cy) ** 2 + (z - cz) ** 2), 0.5) AS r FROM cam JOIN box USING (s) GROUP BY 1) USING (s)),
    f AS (SELECT family, unnest(generate_series(0, n - 1)) AS k FROM (VALUES ('interpolation', {generators.INTERPOLATED}), {', '.join(f"('{f}', {n})" for f, n in generators.FAMILIES.items())}) v(family, n)),
    j AS (SELECT *, s || ':' || family || ':' || k AS id, ('0x' || substr(sha1(s || ':' || family || ':' || k || ':camera'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM st, f),
    t AS (SELECT unnest(generate_series(0, 48))::INT AS t),
    w AS (SELECT j.id, q.j, x, y, z FROM j, (SELECT unnest(generate_series(0, {scenes.WAYPOINTS - 1})) AS j) q, cam WHERE family = 'interpolation' AND q.j < least(n, {scenes.WAYPOINTS}) AND cam.s = j.s AND cam.i = floor((u + q.j) * n / least(n, {scenes.WAYPOINTS}))),
    g AS (SELECT j.*, t.t, t.t * (least(n, {scenes.WAYPOINTS}) - 1) / 48.0::DOUBLE AS e, least(floor(t.t * (least(n, {scenes.WAYPOINTS}) - 1) / 48.0::DOUBLE), greatest(least(n, {scenes.WAYPOINTS}) - 2, 0)) AS p FROM j, t WHERE family = 'interpolation'),
    gi AS (SELECT g.* EXCLUDE (e, p), {', '.join(f'a.{a} + (coalesce(b.{a}, a.{a}) - a.{a}) * (e - p) AS {a}' for a in 'xyz')} FROM g JOIN w a ON a.id = g.id AND a.j = p LEFT JOIN w b ON b.id = g.id AND b.j = p + 1),
    d AS (SELECT j.*, x AS ax, y AS ay, z AS az, {', '.join(_path_normal_sql('id', a) + ' AS g' + a for a in 'xyz')} FROM j JOIN cam ON cam.s = j.s AND cam.i = floor(u * n) WHERE family <> 'interpolation'),
    v AS (SELECT *, {', '.join(f'g{a} / sqrt(gx * gx + gy * gy + gz * gz) AS d{a}, (c{a} - a{a}) / greatest(sqrt((cx - ax) ** 2 + (cy - ay) ** 2 + (cz - az) ** 2), 1e-6) AS t{a}' for a in 'xyz')} FROM d),
    m AS (SELECT v.*, t.t, t.t / 48.0::DOUBLE AS e, 2 * pi() * (t.t / 48.0::DOUBLE) AS w FROM v, t),
    k AS (SELECT *, {', '.join(f"sum(r / 50 * {_path_normal_sql("id || ':' || t", a)}) OVER (PARTITION BY id ORDER BY t) AS k{a}" for a in 'xyz')} FROM m WHERE family = 'random_walk'),
    al AS (SELECT s, family, k, t, cx, cy, cz, {', '.join(f'l{a}, h{a}' for a in 'xyz')}, x, y, z FROM gi
        UNION ALL SELECT s, family, k, t, cx, cy, cz, {', '.join(f'l{a}, h{a}' for a in 'xyz')}, ax + kx, ay + ky, az + kz FROM k
        {' '.join(f"UNION ALL SELECT s, family, k, t, cx, cy, cz, {', '.join(f'l{a}, h{a}' for a in 'xyz')}, {re.sub(r'(?<![a-z])s(?![a-z])', 'e', x)} FROM m WHERE family = '{f}'" for f, x in _FAMILY_SQL.items())}),
    c AS (SELECT s, family, k, t, cx, cy, cz, {', '.join(f'least(greatest({a}, l{a} - (h{a} - l{a}) * 0.1), h{a} + (h{a} - l{a}) * 0.1) AS {a}' for a in 'xyz')} FROM al)"""


@query(_PATHS_SQL + f"""
    SELECT s AS scene, family, k::INT AS k, t, {', '.join(f'round({a}, 6) + 0.0 AS {a}' for a in 'xyz')}, {', '.join(f'round((c{a} - {a}) / greatest(sqrt((cx - x) ** 2 + (cy - y) ** 2 + (cz - z) ** 2), 1e-6), 6) + 0.0 AS forward_{a}' for a in 'xyz')} FROM c""")
def scene_trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 40 trajectories of every scene, frame by frame: positions and where the camera looks."""
    n = F.col("c_custkey")
    cameras = _t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("scene"), "c_custkey", (F.col("c_acctbal") / 777).alias("x"), (n % 7).cast("double").alias("y"), (n % 11).cast("double").alias("z"))
    rows = scenes.trajectories(cameras, "scene", "c_custkey", 49)
    return rows.select("scene", "family", "k", "t", *[_r(a).alias(a) for a in "xyz"], *[_r(F.col("pose")[4 * i + 2]).alias(f"forward_{a}") for i, a in enumerate("xyz")])


# --- scales -------------------------------------------------------------------------------------------------------------

_ORDERS_SQL = "SELECT l_suppkey % 20 AS clip, l_orderkey % 30 AS t, l_extendedprice / l_quantity AS b, 1000.0::DOUBLE + l_linenumber AS a FROM lineitem WHERE l_quantity > 0"
_FOLD_SQL = "list_transform(xs, lambda x, i: list_reduce(xs[1:i], lambda p, q: 0.99::DOUBLE * p + (1 - 0.99::DOUBLE) * q))"


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "lineitem").where("l_quantity > 0").select((F.col("l_suppkey") % 20).alias("clip"), (F.col("l_orderkey") % 30).alias("t"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("b"), (1000.0 + F.col("l_linenumber")).alias("a"))


@query(f"""
    WITH p AS ({_ORDERS_SQL}), f AS (SELECT clip, t, CASE WHEN count(*) >= 10 THEN median(b / a) ELSE 1.0 END AS seed, CASE WHEN count(*) >= 10 THEN avg(b) / (avg(a) + 1e-8) ELSE 1.0 END AS step FROM p GROUP BY 1, 2),
    l AS (SELECT clip, list_prepend(arg_min(seed, t), list(step ORDER BY t)[2:]) AS xs, list(t ORDER BY t) AS ts FROM f GROUP BY 1)
    SELECT clip, unnest(ts) AS t, round(unnest({_FOLD_SQL}), 6) AS scale FROM l""")
def ema_median_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scales from a median-ratio seed and mean-ratio steps; frames with too few pixels count 1."""
    n = F.count("*")
    frames = _pairs(spark, sf_dir).groupBy("clip", "t").agg(F.when(n >= 10, F.median(F.col("b") / F.col("a"))).otherwise(1.0).alias("seed"), F.when(n >= 10, F.avg("b") / (F.avg("a") + 1e-8)).otherwise(1.0).alias("step"))
    return series.ema(series.seeded(frames, "clip", "t", "seed", "step"), "clip", "t", "value").select("clip", "t", _r("value").alias("scale"))


@query(f"""
    WITH p AS ({_ORDERS_SQL}), f AS (SELECT clip, t, CASE WHEN count(*) >= 10 THEN sum(b) / sum(a) ELSE 1.0 END AS step FROM p GROUP BY 1, 2), l AS (SELECT clip, list(step ORDER BY t) AS xs, list(t ORDER BY t) AS ts FROM f GROUP BY 1)
    SELECT clip, unnest(ts) AS t, round(unnest({_FOLD_SQL}), 6) AS scale FROM l""")
def ema_without_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scales in which a degenerate frame counts 1 and isn't carried over."""
    frames = _pairs(spark, sf_dir).groupBy("clip", "t").agg(F.when(F.count("*") >= 10, F.sum("b") / F.sum("a")).otherwise(1.0).alias("step"))
    return series.ema(frames, "clip", "t", "step").select("clip", "t", _r("value").alias("scale"))


# --- reports, review and runs ---------------------------------------------------------------------------------------------


@query("SELECT source, count(*) AS n, count(quality) AS n_rated, round(avg(quality), 6) AS mean, median(quality) AS middle, max(quality) AS most FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def summary_without_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, median and maximum of the values that are there."""
    rows = _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id", "left")
    return rows.groupBy("source").agg(F.count("*").alias("n"), F.count("quality").alias("n_rated"), _r(F.avg("quality")).alias("mean"), F.median("quality").alias("middle"), F.max("quality").alias("most"))


@query("SELECT event_type, round(avg(10 * log10(255.0::DOUBLE ** 2 / value)), 6) AS psnr_mean, round(stddev_pop(10 * log10(255.0::DOUBLE ** 2 / value)), 6) AS psnr_std FROM events WHERE value > 0 GROUP BY 1")
def psnr_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signal-to-noise ratio from mean squared errors."""
    psnr = 10 * F.log10(F.lit(255.0**2) / F.col("value"))
    return _t(spark, sf_dir, "events").where("value > 0").groupBy("event_type").agg(_r(F.avg(psnr)).alias("psnr_mean"), _r(F.stddev_pop(psnr)).alias("psnr_std"))


@query("""
    WITH w AS (SELECT doc_id, source FROM documents), h AS (SELECT doc_id, 1 + toxic AS files FROM labels)
    SELECT source, count(*) AS wanted, count(*) FILTER (files = 2) AS complete, count(*) FILTER (files = 1) AS incomplete, count(*) FILTER (files IS NULL) AS missing, coalesce(sum(files), 0)::BIGINT AS files, round(100.0 * count(*) FILTER (files = 2) / count(*), 1) AS pct FROM w LEFT JOIN h USING (doc_id) GROUP BY 1""")
def extraction_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted samples that are complete, incomplete and missing."""
    rows = _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels").select("doc_id", (1 + F.col("toxic")).alias("files")), "doc_id", "left")
    done = F.count_if(F.col("files") == 2)
    return rows.groupBy("source").agg(F.count("*").alias("wanted"), done.alias("complete"), F.count_if(F.col("files") == 1).alias("incomplete"), F.count_if(F.col("files").isNull()).alias("missing"), F.coalesce(F.sum("files"), F.lit(0)).cast("long").alias("files"), F.round(100 * done / F.count("*"), 1).alias("pct"))


@query("""
    WITH m AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
    SELECT source, max(i) AS n_missing, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) FILTER (i <= 5) AS first_ids FROM m GROUP BY 1""")
def first_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many are missing, and the first few of them, for a report."""
    gone = merge.missing(_t(spark, sf_dir, "documents").select("source", "doc_id"), _t(spark, sf_dir, "labels"), "doc_id")
    ids = sampling.top(gone, ["source"], 5, "doc_id").groupBy("source").agg(F.array_join(F.array_sort(F.collect_list("doc_id")).cast("array<string>"), ",").alias("first_ids"))
    return gone.groupBy("source").agg(F.count("*").alias("n_missing")).join(ids, "source")


@query("""
    WITH w AS (SELECT o_orderstatus AS worker, o_orderkey % 40 <> 0 AS ok, 'order ' || o_orderkey AS e FROM orders)
    SELECT worker, count(*) FILTER (ok) AS n_ok, count(*) FILTER (NOT ok) AS n_fail, min(CASE WHEN NOT ok THEN e END) AS first_error FROM w GROUP BY 1""")
def isolated_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each sample's outcome by worker; failures don't end the work."""
    rows = _t(spark, sf_dir, "orders")
    return validation.isolated(rows.withColumnRenamed("o_orderstatus", "worker"), F.col("o_orderkey") % 40 != 0, F.concat(F.lit("order "), F.col("o_orderkey").cast("string")), "worker")


@query("""
    WITH a AS (SELECT doc_id, CASE WHEN n_chars < 300 THEN 'fail' WHEN n_chars < 900 THEN 'flag' ELSE 'pass' END AS v FROM documents), b AS (SELECT doc_id, CASE WHEN n_chars < 200 THEN 'fail' WHEN n_chars < 700 THEN 'flag' ELSE 'pass' END AS w FROM documents)
    SELECT v AS before, w AS after, count(*) AS n FROM a JOIN b USING (doc_id) GROUP BY 1, 2""")
def rerun_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts before and after a change of thresholds."""
    n, docs = F.col("n_chars"), _t(spark, sf_dir, "documents")
    before = docs.select("doc_id", F.when(n < 300, "fail").when(n < 900, "flag").otherwise("pass").alias("before"))
    after = docs.select("doc_id", F.when(n < 200, "fail").when(n < 700, "flag").otherwise("pass").alias("after"))
    return before.join(after, "doc_id").groupBy("before", "after").agg(F.count("*").alias("n"))


@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5('42:' || doc_id), doc_id) AS i FROM documents WHERE n_chars >= 900) WHERE i <= 3")
def pass_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few passes of each group by chance, in shuffled order."""
    r = sampling.rank(42, "doc_id")
    return sampling.top(_t(spark, sf_dir, "documents").where("n_chars >= 900").select("source", "doc_id"), ["source"], 3, r, "doc_id").orderBy(sampling.rank(42, "doc_id"))


@query("SELECT doc_id, CASE WHEN source LIKE 'src1%' THEN 'one' WHEN source LIKE 'src2%' THEN 'two' END AS dataset FROM documents")
def known_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset by prefix, null for an unknown one."""
    return _t(spark, sf_dir, "documents").select("doc_id", C.known_prefix(F.col("source"), {"src1": "one", "src2": "two"}).alias("dataset"))


@query("SELECT page_id, md5(CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN url || chr(65533) ELSE chr(65533) || url || chr(65533) END) AS text FROM pages")
def decoded_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes read as text: some end in a byte that isn't UTF-8, or within a character, or begin with one."""
    n, url, bad, cut = F.col("page_id") % 3, F.col("url").cast("binary"), F.unhex(F.lit("FF")), F.unhex(F.lit("C3"))
    data = F.when(n == 0, url).when(n == 1, F.concat(url, cut)).otherwise(F.concat(bad, url, bad))
    return _t(spark, sf_dir, "pages").select("page_id", F.md5(C.decoded(data)).alias("text"))


@query("""
    WITH c AS (SELECT conv_id AS doc_id, min(text) AS caption FROM conversations WHERE role = 'system' GROUP BY 1)
    SELECT doc_id, md5('Describe the scene. ' || coalesce(nullif(trim(caption), ''), 'A scene.')) AS prompt FROM documents LEFT JOIN c USING (doc_id)""")
def prompts_with_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed prompt and each sample's caption, or a stand-in where it has none."""
    captions = _t(spark, sf_dir, "conversations").where("role = 'system'").groupBy(F.col("conv_id").alias("doc_id")).agg(F.min("text").alias("caption"))
    rows = _t(spark, sf_dir, "documents").select("doc_id").join(captions, "doc_id", "left")
    return rows.select("doc_id", F.md5(F.concat(F.lit("Describe the scene. "), F.coalesce(F.nullif(F.trim("caption"), F.lit("")), F.lit("A scene.")))).alias("prompt"))


@query("""
    WITH s AS (SELECT doc_id, CASE WHEN n_chars < 300 THEN 'fail' WHEN n_chars < 900 THEN 'flag' ELSE 'pass' END AS v FROM documents)
    SELECT doc_id, v AS verdict, CASE WHEN toxic = 1 THEN 'revised ' || doc_id END AS caption FROM s LEFT JOIN labels USING (doc_id) WHERE v <> 'fail'""")
def stage3_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Third stage: failed samples are skipped, a caption only where it was revised."""
    n = F.col("n_chars")
    rows = _t(spark, sf_dir, "documents").select("doc_id", F.when(n < 300, "fail").when(n < 900, "flag").otherwise("pass").alias("verdict")).where("verdict <> 'fail'")
    rows = merge.merge_stages(rows, [_t(spark, sf_dir, "labels").select("doc_id", "toxic")], "doc_id")
    return rows.select("doc_id", "verdict", F.when(F.col("toxic") == 1, F.concat(F.lit("revised "), F.col("doc_id").cast("string"))).alias("caption"))


@query("SELECT event_id, CASE WHEN event_type = 'click' THEN value * 2 END AS score FROM events")
def hooked_where_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model's score only for the rows that need it."""
    hooks.register("double_value", lambda v: v * 2)
    return hooks.only_where(_t(spark, sf_dir, "events").select("event_id", "event_type", "value"), F.col("event_type") == "click", "double_value", "score", "value").select("event_id", "score")


@query("""
    WITH g AS (SELECT unnest(generate_series(0, 4))::INT AS i), p AS (SELECT i, i * 7 // 4 AS at FROM g)
    SELECT x.vec_id, a.i AS gy, b.i AS gx, round(x.embedding[a.at * 8 + b.at + 1]::DOUBLE, 6) AS v FROM embeddings x, p a, p b WHERE len(x.embedding) = 64""")
def grid_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of every raster of 8 rows and 8 columns on an even grid of 5 by 5."""
    rows = _t(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.lit(8).alias("height"), F.lit(8).alias("width"))
    return colour.grid_sample(rows, ["vec_id"], "embedding", "height", "width", 5).select("vec_id", "gy", "gx", _r("value").alias("v"))
