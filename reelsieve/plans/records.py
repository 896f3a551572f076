"""Queries of packed samples, scene geometry, colour and run records over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MEMBERS
from ..functions import columns as C
from ..operators import colour, geometry, ledger, packages, verdict
from ..sources import tar_format
from ..steps import new_path
from .checks import _r, _t
from .registry import query


def _members(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("tar").option("pushFilters", True).load(path)


@query("""
    SELECT user_id, count(*) AS n, round(sum(value), 4) AS total, string_agg(DISTINCT event_type, ' ' ORDER BY event_type) AS caption FROM events GROUP BY 1""")
def tar_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as packed samples: written as tar shards, of which the captions and the records are read back and put together."""
    tar_format.register(spark)
    kinds = F.array_join(F.array_sort(F.collect_set("event_type")), " ")
    users = _t(spark, sf_dir, "events").groupBy("user_id").agg(F.to_json(F.struct(F.count("*").alias("n"), F.sum("value").alias("total"))).alias("record"), kinds.alias("caption"))
    members = F.create_map(F.lit("caption.txt"), F.col("caption").cast("binary"), F.lit("meta.json"), F.col("record").cast("binary"), F.lit("mp4"), F.sha2("record", 256).cast("binary"))
    path = new_path(spark, "users")
    users.select(F.col("user_id").cast("string").alias("sample"), members.alias("members")).write.format("tar").mode("append").options(frames="unchecked", capacity=64).save(path)
    key, text = F.substring_index("name", ".", 1).cast("long").alias("user_id"), F.col("data").cast("string")
    records = _members(spark, path).where(F.col("name").endswith(".meta.json")).select(key, F.from_json(text, "n long, total double").alias("r"))
    captions = _members(spark, path).where(F.col("name").endswith(".caption.txt")).select(key, text.alias("caption"))
    return records.join(captions, "user_id").select("user_id", "r.n", _r(F.col("r.total"), 4).alias("total"), "caption")


@query("""
    WITH p AS (SELECT label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings),
    m AS (SELECT label, count(*) AS n, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz, covar_samp(x, x) AS a, covar_samp(y, y) AS d, covar_samp(z, z) AS f, covar_samp(x, y) AS b, covar_samp(x, z) AS c, covar_samp(y, z) AS e FROM p GROUP BY 1),
    s AS (SELECT *, (a + d + f) / 3 AS q, sqrt(((a - (a + d + f) / 3) ** 2 + (d - (a + d + f) / 3) ** 2 + (f - (a + d + f) / 3) ** 2 + 2 * (b * b + c * c + e * e)) / 6) AS w FROM m),
    t AS (SELECT *, acos(greatest(-1, least(1, ((a - q) * ((d - q) * (f - q) - e * e) - b * (b * (f - q) - e * c) + c * (b * e - (d - q) * c)) / (2 * w ** 3)))) / 3 AS phi FROM s),
    l AS (SELECT *, unnest([1, 2, 3]) AS k FROM t),
    v AS (SELECT *, CASE k WHEN 1 THEN q + 2 * w * cos(phi) WHEN 3 THEN q + 2 * w * cos(phi + 2 * pi() / 3) ELSE q - 2 * w * cos(phi) - 2 * w * cos(phi + 2 * pi() / 3) END AS r FROM l),
    u AS (SELECT *, b * e - c * (d - r) AS ux, b * c - (a - r) * e AS uy, (a - r) * (d - r) - b * b AS uz FROM v),
    o AS (SELECT *, sqrt(ux * ux + uy * uy + uz * uz) * CASE WHEN abs(ux) >= abs(uy) AND abs(ux) >= abs(uz) THEN sign(ux) WHEN abs(uy) >= abs(uz) THEN sign(uy) ELSE sign(uz) END AS z FROM u)
    SELECT label, k AS place, n, round(cx, 6) AS cx, round(cy, 6) AS cy, round(cz, 6) AS cz, round(r, 8) AS variance, round(ux / z, 5) + 0.0 AS ax, round(uy / z, 5) + 0.0 AS ay, round(uz / z, 5) + 0.0 AS az FROM o""")
def scene_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centre, principal axes and variances of each scene's positions; the SQL has the closed form."""
    e = F.col("embedding")
    points = _t(spark, sf_dir, "embeddings").select("label", *[e[i].alias(x) for i, x in enumerate("xyz")])
    found = geometry.scene_axes(points, "label", ["x", "y", "z"]).select("label", "n", "centroid", "axes", F.posexplode("variances").alias("i", "variance"))
    at = lambda k: F.element_at("axes", F.col("i") * 3 + k)
    return found.select("label", (F.col("i") + 1).alias("place"), "n", *[_r(F.col("centroid")[k]).alias(f"c{x}") for k, x in enumerate("xyz")], _r("variance", 8).alias("variance"), *[_r(at(k + 1), 5).alias(f"a{x}") for k, x in enumerate("xyz")])


@query("""
    WITH p AS (SELECT label, vec_id, list_transform(embedding[1:63], lambda x: least(255, floor(abs(x) * 1000))::INT) AS p FROM embeddings),
    r AS (SELECT label, vec_id, p[3 * i + 1] AS r, p[3 * i + 2] AS g, p[3 * i + 3] AS b FROM p, unnest(range(21)) AS u(i)),
    s AS (SELECT label, vec_id, greatest(r, g, b) AS v, greatest(r, g, b) - least(r, g, b) AS d FROM r),
    f AS (SELECT label, vec_id, avg(CASE WHEN v = 0 THEN 0 ELSE (d * round_even(1044480.0 / v, 0)::INT + 2048) >> 12 END) AS s FROM s GROUP BY ALL)
    SELECT label, count(*) AS n_frames, round(avg(s), 6) AS saturation FROM f GROUP BY 1""")
def colour_saturation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean HSV saturation of clips, whose frames are arrays of pixels."""
    pixels = F.transform(F.slice("embedding", 1, 63), lambda x: F.least(F.lit(255), F.floor(F.abs(x.cast("double")) * 1000).cast("int")))
    frames = _t(spark, sf_dir, "embeddings").select("label", pixels.alias("pixels"))
    return colour.clip_saturation(frames, "label", "pixels").select("label", "n_frames", _r("saturation").alias("saturation"))


def _measured(row: dict) -> int:
    """A sample's work: every eleventh one fails."""
    if row["doc_id"] % 11 == 3:
        raise ValueError(f"no frames in {row['doc_id']}")
    return len(row["text"].split())


@query(r"""
    WITH d AS (SELECT doc_id, lang, doc_id % 11 = 3 AS bad, len(regexp_extract_all(text, '\S+')) AS n FROM documents)
    SELECT lang, count(*) FILTER (NOT bad) AS n_ok, count(*) FILTER (bad) AS n_fail, min(CASE WHEN bad THEN 'ValueError: no frames in ' || doc_id END) AS first_error,
           round(count(*) FILTER (NOT bad) / count(*), 4) AS share, coalesce(sum(n) FILTER (NOT bad), 0)::BIGINT AS words FROM d GROUP BY 1""")
def ledger_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pass over all samples that was stopped halfway and resumed: failures are entries, nothing is done twice."""
    docs, path = _t(spark, sf_dir, "documents").select("doc_id", "text"), new_path(spark, "ledger")
    ledger.run(docs, "doc_id", _measured, "long", path, number=1, parts=4, stop_after=2)
    done = ledger.run(docs, "doc_id", _measured, "long", path, number=2, parts=4)
    rows = done.join(_t(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    words = rows.groupBy("lang").agg(F.coalesce(F.sum("result"), F.lit(0)).cast("long").alias("words"))
    return ledger.counts(rows, "lang").join(words, "lang")


# --- packages -------------------------------------------------------------------------------------------------------------

_EXT_SQL = "CASE l_linenumber " + " ".join(f"WHEN {k} THEN '{m}'" for k, m in enumerate(MEMBERS, 1)) + " ELSE 'extra.txt' END"


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the files of orders."""
    ext = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for k, m in enumerate(MEMBERS, 1) for x in (k, m)]), F.col("l_linenumber")), F.lit("extra.txt"))
    return _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("sample"), ext.alias("ext"), F.col("l_quantity").cast("long").alias("size"))


@query(f"""
    WITH f AS (SELECT l_orderkey AS sample, {_EXT_SQL} AS ext, max(l_quantity)::BIGINT AS b FROM lineitem GROUP BY ALL),
    c AS (SELECT sample, count(*) FILTER (ext <> 'extra.txt') AS n, coalesce(sum(b) FILTER (ext <> 'extra.txt'), 0) AS b FROM f GROUP BY 1)
    SELECT sample % 7 AS dataset, count(*) AS n_samples, count(*) FILTER (n = 6) AS n_complete, round(100 * avg((n = 6)::INT), 1) AS pct, coalesce(sum(b) FILTER (n = 6), 0)::BIGINT AS bytes FROM c GROUP BY 1""")
def member_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete samples and their bytes, by dataset."""
    return packages.totals(packages.completeness(_files(spark, sf_dir), "sample", "ext", "size"), F.col("sample") % 7)


@query(f"""
    WITH p AS (SELECT o_orderkey AS sample, o_custkey % 7 AS shard FROM orders WHERE o_orderpriority = '1-URGENT'),
    m AS (SELECT o_custkey % 7 AS shard, l_orderkey AS sample, {_EXT_SQL} AS ext, CASE WHEN l_quantity > 3 THEN l_quantity ELSE 0 END AS size FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 7 < 6),
    v AS (SELECT shard, sample, max(size) AS size FROM m WHERE ext = 'mp4' GROUP BY ALL)
    SELECT p.sample, p.shard, p.shard < 6 AND v.sample IS NOT NULL AND v.size > 0 AS ok, CASE WHEN p.shard = 6 THEN 'tar not found' WHEN v.sample IS NULL THEN 'video not in tar' WHEN v.size = 0 THEN 'empty video' END AS reason
    FROM p LEFT JOIN v ON p.sample = v.sample AND p.shard = v.shard""")
def extraction_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the picked samples' videos can be taken out of their shards, and why others can't."""
    orders = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sample"), (F.col("o_custkey") % 7).alias("shard"), "o_orderpriority")
    files = _files(spark, sf_dir).withColumn("size", F.when(F.col("size") > 3, F.col("size")).otherwise(0)).join(orders.where("shard < 6").select("sample", "shard"), "sample")
    return packages.extraction(orders.where("o_orderpriority = '1-URGENT'").select("sample", "shard"), files, "sample", "shard")


@query("""
    WITH f AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'poor' WHEN quality = 1 THEN 'good' ELSE 'acceptable' END AS rating FROM labels), p AS (SELECT doc_id, n_chars % 5 > 0 AS ok FROM documents)
    SELECT rating, CASE rating WHEN 'excellent' THEN 0 WHEN 'good' THEN 1 WHEN 'acceptable' THEN 2 ELSE 3 END AS place, count(*) AS n, count(*) FILTER (ok) AS n_ok, round(100 * count(*) FILTER (ok) / sum(count(*) FILTER (ok)) OVER (), 1) AS pct FROM p LEFT JOIN f USING (doc_id) GROUP BY 1""")
def extracted_by_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was extracted, by the reviewers' rating."""
    rating = F.when(F.col("toxic") == 1, "poor").when(F.col("quality") == 1, "good").otherwise("acceptable")
    feedback = _t(spark, sf_dir, "labels").select("doc_id", rating.alias("rating"))
    picks = _t(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") % 5 > 0).alias("ok"))
    return packages.by_rating(feedback, picks, "doc_id", "rating", ("excellent", "good", "acceptable"))


@query("""
    SELECT doc_id AS sample_id, CASE WHEN doc_id % 4 > 0 THEN lang ELSE '' END AS caption_original, 'revised ' || doc_id AS caption_revised FROM documents JOIN labels USING (doc_id) WHERE toxic = 1""")
def revised_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sidecar of captions that were revised."""
    rows = _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id", "left")
    revised = F.when(F.col("toxic") == 1, F.concat(F.lit("revised "), F.col("doc_id"))).when(F.col("quality") == 0, "")
    return packages.caption_sidecar(rows.withColumns({"was": F.when(F.col("doc_id") % 4 > 0, F.col("lang")), "now": revised}), "doc_id", "was", "now")


# --- camera ---------------------------------------------------------------------------------------------------------------

_FRAMES_SQL = "SELECT c_nationkey AS clip, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS t, radians(c_custkey % 360) AS a, c_acctbal::DOUBLE / 1000 AS x, 500 + abs(c_acctbal) / 10 AS fx, 500 + abs(c_acctbal) / 10 + c_custkey % 7 * 20 AS fy, 1 + c_custkey % 11 / 10.0 AS scale FROM customer"


def _camera_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import series

    rows = series.numbered(_t(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "clip"), "clip", "c_custkey")
    a, focal = F.radians(F.col("c_custkey") % 360), 500 + F.abs("c_acctbal") / 10
    c, s, zero, one = F.cos(a), F.sin(a), F.lit(0.0), F.lit(1.0)
    pose = F.array(c, -s, zero, F.col("c_acctbal") / 1000, s, c, zero, F.lit(2.0), zero, zero, one, F.col("t").cast("double"), zero, zero, zero, one)
    return rows.select("clip", "t", pose.alias("pose"), focal.alias("fx"), (focal + F.col("c_custkey") % 7 * 20).alias("fy"), (1 + F.col("c_custkey") % 11 / 10.0).alias("scale"))


@query(f"""
    WITH f AS ({_FRAMES_SQL}), k AS (SELECT clip, t, cos(a) AS c, sin(a) AS s, x, lead(t) OVER w AS t1, lead(cos(a)) OVER w AS c1, lead(sin(a)) OVER w AS s1, lead(x) OVER w AS x1 FROM f WHERE t % 4 = 1 WINDOW w AS (PARTITION BY clip ORDER BY t)),
    e AS (SELECT clip, unnest(range(CASE WHEN t = 1 THEN 0 ELSE t END, coalesce(t1, t + 1))) AS i, * EXCLUDE (clip) FROM k),
    d AS (SELECT clip, i, CASE WHEN i <= t THEN c ELSE c + (c1 - c) * (i - t) / (t1 - t) END AS c, CASE WHEN i <= t THEN s ELSE s + (s1 - s) * (i - t) / (t1 - t) END AS s, CASE WHEN i <= t THEN x ELSE x + (x1 - x) * (i - t) / (t1 - t) END AS x, CASE WHEN i <= t THEN t ELSE i END AS z FROM e),
    o AS (SELECT clip, c AS c0, s AS s0, x AS x0, z AS z0 FROM d WHERE i = 0)
    SELECT d.clip, d.i AS t, round(c0 * c + s0 * s, 6) + 0.0 AS p00, round(c0 * s - s0 * c, 6) + 0.0 AS p10, round(c0 * (x - x0), 6) + 0.0 AS p03, round(-s0 * (x - x0), 6) + 0.0 AS p13, round(z - z0, 6) + 0.0 AS p23 FROM d JOIN o USING (clip)""")
def dense_keyframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poses of every frame from those of the keyframes, relative to the first."""
    p = F.col("pose")
    got = geometry.dense_poses(_camera_frames(spark, sf_dir).where("t % 4 = 1"), "clip", "t", "pose")
    return got.select("clip", "t", *[_r(p[i]).alias(n) for n, i in (("p00", 0), ("p10", 4), ("p03", 3), ("p13", 7), ("p23", 11))])


@query(f"""
    WITH f AS ({_FRAMES_SQL}), g AS (SELECT clip, min(degrees(2 * atan(1280 / (2 * fx)))) AS x0, max(degrees(2 * atan(1280 / (2 * fx)))) AS x1, min(degrees(2 * atan(720 / (2 * fy)))) AS y0, max(degrees(2 * atan(720 / (2 * fy)))) AS y1, max(abs(fx - fy) / (0.5 * (fx + fy) + 1e-6)) AS d, stddev_pop(scale) / (avg(scale) + 1e-6) AS v FROM f GROUP BY 1)
    SELECT clip, round(x0, 6) AS fov_x_min, round(y1, 6) AS fov_y_max, round(d, 6) AS focal_div_max, round(v, 6) AS scale_cv, array_to_string(list_filter([CASE WHEN x0 < 25 OR x1 > 120 THEN 'fov_x' END, CASE WHEN y0 < 25 OR y1 > 120 THEN 'fov_y' END, CASE WHEN d > 0.2 THEN 'focal_divergence' END, CASE WHEN v > 2 THEN 'scale_cv' END], lambda x: x IS NOT NULL), '|') AS reasons FROM g""")
def camera_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of view, focal divergence and scale variation of every clip, with the reasons against it."""
    got = verdict.pose_quality(_camera_frames(spark, sf_dir), "clip")
    return got.select("clip", *[_r(c).alias(c) for c in ("fov_x_min", "fov_y_max", "focal_div_max", "scale_cv")], F.array_join("reasons", "|").alias("reasons"))


@query(f"""
    WITH f AS ({_FRAMES_SQL}), g AS (SELECT clip, count(*) AS n, median(fx) AS fx, median(fy) AS fy, min(scale) AS lo, max(scale) AS hi, stddev_pop(scale) / (avg(scale) + 1e-8) AS v FROM f GROUP BY 1)
    SELECT n_nationkey AS clip, n AS frames, round(degrees(2 * atan(1280 / (2 * fx))), 6) AS fov_x, round(abs(fx - fy) / (0.5 * (fx + fy) + 1e-8), 6) AS focal_divergence, round(lo, 6) AS scale_min, round(hi, 6) AS scale_max, round(v, 6) AS scale_cov, abs(fx - fy) / (0.5 * (fx + fy) + 1e-8) <= 0.05 AS passed FROM nation LEFT JOIN g ON clip = n_nationkey""")
def camera_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result record of every clip, read back from its JSON."""
    clips = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("clip"), F.lit("default").alias("mode"))
    passed = F.col("focal_divergence") <= 0.05
    records = packages.camera_record(clips, _camera_frames(spark, sf_dir), "clip", passed, C.reasons(focal_divergence=~passed), 1280, 720)
    r = F.from_json("record", "poses struct<shape:array<long>>, scale struct<min:double,max:double>, camera_qc struct<passed:boolean,fov_x_deg:double,focal_divergence:double,scale_cov:double>")
    rows = records.select("clip", r.alias("r")).select("clip", "r.*")
    return rows.select("clip", F.col("poses.shape")[0].alias("frames"), _r(F.col("camera_qc.fov_x_deg")).alias("fov_x"), _r(F.col("camera_qc.focal_divergence")).alias("focal_divergence"), _r(F.col("scale.min")).alias("scale_min"), _r(F.col("scale.max")).alias("scale_max"), _r(F.col("camera_qc.scale_cov")).alias("scale_cov"), "camera_qc.passed")


@query("""
    SELECT user_id, round(coalesce(avg(value) FILTER (event_type <> 'error'), 'nan'::DOUBLE), 6) AS motion, greatest(count(*) FILTER (event_type = 'view') - 1, 0) AS cuts FROM events GROUP BY 1""")
def motion_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Motion from each clip's log, whose frames name it in one of two ways or not at all, and its cuts."""
    v, kind = F.col("value"), F.col("event_type")
    metrics = F.struct(F.when(~kind.isin("error", "click"), v).alias("motion2"), F.when(kind == "click", v).alias("motion"), F.col("event_id").alias("index"))
    logs = _t(spark, sf_dir, "events").groupBy("user_id").agg(F.to_json(F.struct(F.collect_list(F.struct(metrics.alias("metrics"))).alias("frames"))).alias("log"), F.count_if(kind == "view").alias("scenes"))
    return logs.select("user_id", _r(C.motion_of_log(F.col("log"))).alias("motion"), C.scene_cuts(F.col("scenes")).alias("cuts"))


@query(r"""
    WITH d AS (SELECT doc_id, source, doc_id % 9 = 0 AS short, lang = 'de' AS wide, doc_id % 5 = 0 AS moved, doc_id % 7 = 0 AS blank, doc_id % 8 = 1 AS fov, regexp_matches(lower(text), '\bzoom(?:s|ed|ing|ned|ning)?\b') AS verb FROM documents),
    w AS (SELECT source, list_filter([CASE WHEN short THEN 'poses shape (960,4,4) != (961,4,4)' END, CASE WHEN wide THEN 'poses dtype float64 != float32' END, CASE WHEN moved AND NOT short THEN 'poses[0] != identity (first-frame anchor)' END, CASE WHEN blank THEN 'caption empty' WHEN verb THEN 'caption contains camera-action verbs: zoom' END, CASE WHEN fov THEN 'camera quality: fov_x' END], lambda x: x IS NOT NULL) AS why FROM d)
    SELECT source, count(*) FILTER (len(why) = 0) AS n_ok, count(*) FILTER (len(why) > 0) AS n_fail, array_to_string(list_sort(list_distinct(flatten(list(why)))), '|') AS reasons FROM w GROUP BY 1""")
def packed_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed samples against every constraint, by shard: shapes, types, first pose, camera quality, caption."""
    from ..operators import validation

    n = F.col("doc_id")
    frames = F.when(n % 9 == 0, 960).otherwise(961)
    rows = _t(spark, sf_dir, "documents").select(
        "source", F.array(frames, F.lit(4), F.lit(4)).alias("poses_shape"), F.array(F.lit(961), F.lit(1), F.lit(4)).alias("intrinsics_shape"), F.array(F.lit(961)).alias("scale_shape"),
        F.when(F.col("lang") == "de", "float64").otherwise("float32").alias("poses_type"), F.when(n % 5 == 0, 0.5).otherwise(0.0005).alias("first_dev"), F.when(n % 7 == 0, "  ").otherwise(F.col("text")).alias("caption"), n.alias("n"),
    )
    why = packages.audited(rows, 961, C.verb_hits(F.col("caption"), ("zoom",), None), F.when(F.col("n") % 8 == 1, F.array(F.lit("fov_x"))))
    return validation.shard_audit(rows.select("source", why.alias("why")), "source", "why").withColumn("reasons", F.array_join("reasons", "|"))
