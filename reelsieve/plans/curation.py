"""Curation queries over the driver tables.

A clip is a user's events in the order of (ts, event_id), its position is `value`; groups, members and verdicts are stood in
for by the columns of the other tables. Floats are rounded to 6 places on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_GROUP, GROUPS, RULES, group_table, rule_rows, rule_table
from ..functions import columns as C
from ..operators import generators, geometry, merge, packing, sampling, series, validation, verdict
from .registry import query

ORDER = ["ts", "event_id"]
#: Positions of the driver's events are about a hundred times as far apart as those of camera tracks.
SPREAD = 100.0


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _r(c: Column | str, n: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, n)


def _sql_value(x) -> str:
    return "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x).lower() if isinstance(x, bool) else str(x)


def _values(rows, names: str) -> str:
    return f"(VALUES {', '.join('(' + ', '.join(map(_sql_value, r)) + ')' for r in rows)}) AS v({names})"


# --- trajectories and verdicts ------------------------------------------------------------------------------------------

_NAMES = list(GROUPS)
_GROUP_SQL = "CASE user_id % 8 " + " ".join(f"WHEN {i} THEN '{g}'" for i, g in enumerate(_NAMES)) + " ELSE 'unlisted' END"
_LIMITS = [(g, c[0] * SPREAD, c[1], c[2]) for g, c in GROUPS.items()]
_VERDICT_SQL = f"""
    WITH cfg AS (SELECT * FROM {_values(_LIMITS, 'grp, jump, flag_limit, fail_limit')}),
    e AS (SELECT user_id, {_GROUP_SQL} AS grp, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS step FROM events),
    c AS (SELECT e.*, coalesce(jump, {DEFAULT_GROUP[0] * SPREAD}) AS jump_threshold, coalesce(flag_limit, {DEFAULT_GROUP[1]}) AS max_flag, coalesce(fail_limit, {DEFAULT_GROUP[2]}) AS max_fail FROM e LEFT JOIN cfg USING (grp)),
    m AS (SELECT user_id, grp, max_flag, max_fail, count(*) AS n_frames, coalesce(sum(step), 0) AS total, coalesce(avg(step), 0) AS mean, coalesce(max(step), 0) AS longest, count(*) FILTER (step > jump_threshold) AS n_jumps FROM c GROUP BY ALL),
    v AS (SELECT *, CASE WHEN n_jumps > max_fail THEN 'fail' WHEN n_jumps > max_flag THEN 'flag' ELSE 'pass' END AS verdict FROM m)"""


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    group = F.coalesce(*[F.when(F.col("user_id") % 8 == i, g) for i, g in enumerate(_NAMES)], F.lit("unlisted"))
    stepped = series.steps(events, "user_id", ORDER, ["value"]).withColumn("group", group)
    limited = verdict.with_group(stepped, group_table(spark))
    over = F.col("step") > F.col("jump_threshold_m") * SPREAD
    rows = limited.groupBy("user_id", "group", "max_jumps_flag", "max_jumps_fail").agg(
        F.count("*").alias("n_frames"), F.coalesce(F.sum("step"), F.lit(0.0)).alias("traj_total"), F.coalesce(F.avg("step"), F.lit(0.0)).alias("step_mean"), F.coalesce(F.max("step"), F.lit(0.0)).alias("step_max"), F.count_if(over).alias("n_jumps")
    )
    v, why = verdict.verdict(F.col("n_jumps"), F.col("max_jumps_flag"), F.col("max_jumps_fail"))
    return rows.withColumns({"verdict": v, "why": why})


@query(_VERDICT_SQL + """
    SELECT user_id, grp AS "group", n_frames, round(total, 6) AS traj_total, round(mean, 6) AS step_mean, round(longest, 6) AS step_max, n_jumps, verdict,
           CASE verdict WHEN 'fail' THEN 'max_jumps_fail' WHEN 'flag' THEN 'n_jumps' ELSE '' END AS reasons FROM v""")
def trajectory_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps, jumps and verdict of every clip under its group's limits."""
    v = _verdicts(spark, sf_dir)
    return v.select("user_id", "group", "n_frames", _r("traj_total").alias("traj_total"), _r("step_mean").alias("step_mean"), _r("step_max").alias("step_max"), "n_jumps", "verdict", F.array_join("why", "|").alias("reasons"))


@query(_VERDICT_SQL + """,
    g AS (SELECT coalesce(grp, 'total') AS "group", coalesce(verdict, 'all') AS verdict, grouping(grp, verdict) AS level, count(*) AS n FROM v GROUP BY ROLLUP (grp, verdict))
    SELECT "group", verdict, n, round(100.0 * n / max(CASE WHEN verdict = 'all' THEN n END) OVER (PARTITION BY "group"), 4) AS pct FROM g""")
def verdict_summary_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips by group and verdict with subtotals, a grand total and their shares."""
    v = _verdicts(spark, sf_dir).rollup("group", "verdict").agg(F.count("*").alias("n"))
    v = v.select(F.coalesce("group", F.lit("total")).alias("group"), F.coalesce("verdict", F.lit("all")).alias("verdict"), "n")
    whole = F.max(F.when(F.col("verdict") == "all", F.col("n"))).over(series.Window.partitionBy("group"))
    return v.select("group", "verdict", "n", _r(100.0 * F.col("n") / whole, 4).alias("pct"))


@query("""
    WITH e AS (SELECT user_id, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS step FROM events)
    SELECT user_id, round(avg(CASE WHEN step < 10 THEN 1.0 ELSE 0.0 END), 6) AS frozen_ratio, avg(CASE WHEN step < 10 THEN 1.0 ELSE 0.0 END) > 0.05 AS frozen FROM e WHERE step IS NOT NULL GROUP BY user_id""")
def frozen_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of steps that are next to nothing, and whether the clip counts as frozen."""
    rows = series.steps(_t(spark, sf_dir, "events").select("user_id", *ORDER, "value"), "user_id", ORDER, ["value"]).where("step IS NOT NULL")
    share = F.avg((F.col("step") < 10).cast("double"))
    return rows.groupBy("user_id").agg(_r(share).alias("frozen_ratio"), (share > 0.05).alias("frozen"))


@query("""
    WITH m AS (SELECT l_orderkey, list_distinct(list(l_returnflag)) AS have FROM lineitem GROUP BY 1)
    SELECT l_orderkey, array_to_string(list_filter(['A', 'N', 'R'], lambda x: NOT list_contains(have, x)), ',') AS missing, array_to_string(list_sort(list_filter(have, lambda x: NOT list_contains(['A', 'N', 'R'], x))), ',') AS extra,
           len(list_filter(['A', 'N', 'R'], lambda x: NOT list_contains(have, x))) = 0 AS complete FROM m""")
def member_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing and extra members of every sample."""
    g = verdict.missing_members(_t(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag", ("A", "N", "R"))
    return g.select("l_orderkey", F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra"), (F.size("missing") == 0).alias("complete"))


#: Rules of the customer analogue: metrics by market segment, some of them absent.
_SEGMENTS = {
    "AUTOMOBILE": {"n_orders": (5, 20), "avg_price": (100000, 300000), "acctbal": (0, 9000)},
    "BUILDING": {"n_orders": (1, 15), "acctbal": (-500, 9500)},
    "FURNITURE": {"n_orders": (8, 30), "avg_price": (50000, 260000)},
    "HOUSEHOLD": {"avg_price": (None, 255000), "scene_cuts": (None, 0)},
    "MACHINERY": {"n_orders": (5, 12), "avg_price": (120000, None), "acctbal": (100, 9999)},
}
_RULE_SQL = f"""
    WITH r AS (SELECT * FROM {_values(rule_rows(_SEGMENTS), 'source, metric, lo, hi')}),
    c AS (SELECT c_custkey, c_mktsegment, c_acctbal AS acctbal, count(o_orderkey)::DOUBLE AS n_orders, avg(o_totalprice) AS avg_price FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL),
    s AS (SELECT c_custkey, c_mktsegment, 'acctbal' AS metric, acctbal AS score FROM c UNION ALL SELECT c_custkey, c_mktsegment, 'n_orders', n_orders FROM c UNION ALL SELECT c_custkey, c_mktsegment, 'avg_price', avg_price FROM c),
    x AS (SELECT c.c_custkey, c.c_mktsegment, r.metric, CASE WHEN s.score IS NULL THEN r.metric <> 'scene_cuts' ELSE NOT ((lo IS NULL OR s.score >= lo) AND (hi IS NULL OR s.score <= hi)) END AS bad
          FROM c JOIN r ON r.source = c.c_mktsegment LEFT JOIN s ON s.c_custkey = c.c_custkey AND s.metric = r.metric)"""


def _violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.col("c_acctbal").alias("acctbal"))
    orders = _t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").cast("double").alias("n_orders"), F.avg("o_totalprice").alias("avg_price"))
    metrics = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "c_mktsegment", "acctbal", F.coalesce("n_orders", F.lit(0.0)).alias("n_orders"), "avg_price")
    scores = verdict.unpivot(metrics, ["c_custkey", "c_mktsegment"], ["acctbal", "n_orders", "avg_price"])
    return verdict.violations(scores, rule_table(spark, _SEGMENTS), "c_custkey", "c_mktsegment")


@query(_RULE_SQL + " SELECT c_mktsegment, count(DISTINCT c_custkey) AS n, (count(DISTINCT c_custkey) - count(DISTINCT c_custkey) FILTER (bad))::BIGINT AS accepted FROM x GROUP BY 1")
def rule_engine_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted rows per source under its metric ranges."""
    return _violations(spark, sf_dir).groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.count_if("accepted").alias("accepted"))


@query(_RULE_SQL + " SELECT c_custkey, c_mktsegment, count(*) FILTER (bad) = 0 AS accepted, coalesce(string_agg(metric, '|' ORDER BY metric) FILTER (bad), '') AS reasons FROM x GROUP BY 1, 2")
def rule_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's violated rules."""
    return _violations(spark, sf_dir).select("c_custkey", "c_mktsegment", "accepted", F.array_join("reasons", "|").alias("reasons"))


@query("""
    WITH f AS (SELECT p_partkey, degrees(2 * atan(p_size / (2 * (p_retailprice / 50)))) AS fov, abs(p_size - p_retailprice / 50) / (0.5 * (p_size + p_retailprice / 50) + 1e-6) AS div FROM part)
    SELECT p_partkey, round(fov, 6) AS fov, round(div, 6) AS divergence, concat_ws('|', CASE WHEN fov < 25 OR fov > 120 THEN 'fov' END, CASE WHEN div > 0.2 THEN 'focal_divergence' END) AS reasons FROM f""")
def fov_focal_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field of view and focal divergence with the reasons of their limits."""
    focal = F.col("p_retailprice") / 50
    rows = _t(spark, sf_dir, "part").select("p_partkey", C.fov_degrees(1.0, focal / F.col("p_size")).alias("fov"), C.focal_divergence(F.col("p_size"), focal).alias("div"))
    why = C.reasons(fov=(F.col("fov") < 25) | C.above(F.col("fov"), 120), focal_divergence=C.above(F.col("div"), 0.2))
    return rows.select("p_partkey", _r("fov").alias("fov"), _r("div").alias("divergence"), F.array_join(why, "|").alias("reasons"))


@query("SELECT l_partkey, round(stddev_pop(l_quantity) / (avg(l_quantity) + 1e-6), 6) AS scale_cv, stddev_pop(l_quantity) / (avg(l_quantity) + 1e-6) <= 0.6 AS ok FROM lineitem GROUP BY 1")
def scale_cv_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficient of variation of a clip's scales."""
    g = _t(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(C.variation(F.col("l_quantity")).alias("cv"))
    return g.select("l_partkey", _r("cv").alias("scale_cv"), (F.col("cv") <= 0.6).alias("ok"))


@query("""
    WITH m AS (SELECT l_suppkey, quantile_cont(l_quantity, 0.5) AS fx, quantile_cont(l_extendedprice / 1500, 0.5) AS fy, stddev_pop(l_discount) / (avg(l_discount) + 1e-8) AS cv FROM lineitem GROUP BY 1)
    SELECT l_suppkey, round(degrees(2 * atan(32 / (2 * fx))), 6) AS fov_x, round(degrees(2 * atan(18 / (2 * fy))), 6) AS fov_y, round(abs(fx - fy) / (0.5 * (fx + fy) + 1e-8), 6) AS divergence, round(cv, 6) AS scale_cv,
           degrees(2 * atan(32 / (2 * fx))) BETWEEN 25 AND 120 AND degrees(2 * atan(18 / (2 * fy))) BETWEEN 25 AND 120 AND abs(fx - fy) / (0.5 * (fx + fy) + 1e-8) <= 0.2 AND cv <= 2 AS passed FROM m""")
def robust_median_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The camera filter on median intrinsics."""
    half = F.lit(0.5)
    m = _t(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.percentile("l_quantity", half).alias("fx"), F.percentile(F.col("l_extendedprice") / 1500, half).alias("fy"), C.variation(F.col("l_discount"), 1e-8).alias("cv"))
    x, y, d = C.fov_degrees(32, F.col("fx")), C.fov_degrees(18, F.col("fy")), C.focal_divergence(F.col("fx"), F.col("fy"), 1e-8)
    return m.select("l_suppkey", _r(x).alias("fov_x"), _r(y).alias("fov_y"), _r(d).alias("divergence"), _r("cv").alias("scale_cv"), (x.between(25, 120) & y.between(25, 120) & (d <= 0.2) & (F.col("cv") <= 2)).alias("passed"))


@query("""
    WITH g AS (SELECT l_orderkey, avg(CASE WHEN l_quantity >= 15 THEN 1.0 ELSE 0.0 END) AS covered, max(l_discount) AS worst FROM lineitem GROUP BY 1)
    SELECT l_orderkey, round(covered, 6) AS covered, worst AS max_empty, CASE WHEN covered < 0.7 THEN 'coverage' WHEN worst > 0.08 THEN 'tile_empty' ELSE '' END AS reason, covered >= 0.7 AND worst <= 0.08 AS passed FROM g""")
def coverage_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of well-covered frames and the emptiest tile."""
    g = verdict.coverage(_t(spark, sf_dir, "lineitem"), "l_orderkey", "l_quantity", "l_discount", least=15, most_empty=0.08)
    return g.select("l_orderkey", _r("covered").alias("covered"), "max_empty", "reason", "passed")


# --- feedback, merges, overrides -----------------------------------------------------------------------------------------

_RATED_SQL = """
    WITH j AS (SELECT d.doc_id, d.source, CASE WHEN toxic = 1 THEN 'bad' WHEN quality = 1 AND n_chars > 2000 THEN 'excellent' WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'acceptable' END AS rating FROM documents d LEFT JOIN labels l USING (doc_id))"""
_KEPT = ("src1", "src2", "src5", "src7")


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    q, bad = F.col("quality"), F.col("toxic") == 1
    rating = F.when(bad, "bad").when((q == 1) & (F.col("n_chars") > 2000), "excellent").when(q == 1, "good").when(q == 0, "acceptable")
    return docs.join(_t(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", "source", rating.alias("rating"))


def _rejection(kept: tuple[str, ...], ratings: tuple[str, ...]) -> Column:
    return F.when(~F.col("source").isin(*kept), "dataset").when(~F.coalesce(F.col("rating").isin(*ratings), F.lit(False)), "rating").otherwise("kept")


@query(_RATED_SQL + f""",
    k AS (SELECT *, CASE WHEN source NOT IN {_KEPT} THEN 'dataset' WHEN coalesce(rating NOT IN ('excellent', 'good', 'acceptable'), true) THEN 'rating' ELSE 'kept' END AS outcome FROM j)
    SELECT outcome, coalesce(source, 'all') AS source, coalesce(rating, 'all') AS rating, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM k WHERE outcome = 'kept'), 4) AS pct_of_kept
    FROM k WHERE outcome = 'kept' GROUP BY outcome, CUBE (source, rating)
    UNION ALL SELECT outcome, 'all', 'all', count(*), NULL FROM k WHERE outcome <> 'kept' GROUP BY outcome""")
def rating_filter_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept rows by dataset and rating with all subtotals, and the rejected ones by first failing reason."""
    rows = _rated(spark, sf_dir).withColumn("outcome", _rejection(_KEPT, ("excellent", "good", "acceptable")))
    kept = rows.where("outcome = 'kept'").cube("source", "rating").agg(F.count("*").alias("n"))
    kept = kept.select(F.lit("kept").alias("outcome"), F.coalesce("source", F.lit("all")).alias("source"), F.coalesce("rating", F.lit("all")).alias("rating"), "n")
    kept = kept.withColumn("pct_of_kept", _r(100.0 * F.col("n") / F.max(F.when((F.col("source") == "all") & (F.col("rating") == "all"), F.col("n"))).over(series.Window.partitionBy("outcome")), 4))
    lost = rows.where("outcome <> 'kept'").groupBy("outcome").agg(F.count("*").alias("n")).select("outcome", F.lit("all").alias("source"), F.lit("all").alias("rating"), "n", F.lit(None).cast("double").alias("pct_of_kept"))
    return kept.unionByName(lost)


@query(_RATED_SQL + f"""
    SELECT doc_id, source, rating FROM j WHERE source IN {_KEPT} AND rating IN ('excellent', 'good', 'acceptable')
    EXCEPT SELECT doc_id, source, rating FROM j WHERE source IN {_KEPT} AND rating IN ('excellent', 'good')""")
def feedback_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a later version of the feedback filter adds to the delivered one."""
    rows = _rated(spark, sf_dir)
    new = rows.where(_rejection(_KEPT, ("excellent", "good", "acceptable")) == "kept")
    old = rows.where(_rejection(_KEPT, ("excellent", "good")) == "kept")
    return merge.missing(new, old, "doc_id")


_AUTO_SQL = "CASE WHEN n_chars < 300 THEN 'fail' WHEN n_chars < 900 THEN 'flag' ELSE 'pass' END"


def _auto(n: Column) -> Column:
    return F.when(n < 300, "fail").when(n < 900, "flag").otherwise("pass")


def _why(n: Column) -> Column:
    return C.reasons(n_jumps=n < 600, caption_len=n < 450, max_jumps_fail=n < 300, saturation=(n >= 600) & (n < 750), tone=(n >= 750) & (n < 900))


_WHY_SQL = "list_filter([CASE WHEN n_chars < 600 THEN 'n_jumps' END, CASE WHEN n_chars < 450 THEN 'caption_len' END, CASE WHEN n_chars < 300 THEN 'max_jumps_fail' END, CASE WHEN n_chars >= 600 AND n_chars < 750 THEN 'saturation' END, CASE WHEN n_chars >= 750 AND n_chars < 900 THEN 'tone' END], lambda x: x IS NOT NULL)"


@query(f"""
    WITH s1 AS (SELECT doc_id, {_AUTO_SQL} AS verdict, {_WHY_SQL} AS why FROM documents), s3 AS (SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels GROUP BY 1)
    SELECT doc_id, CASE WHEN toxic = 1 AND verdict <> 'fail' THEN 'fail' ELSE verdict END AS verdict, array_to_string(CASE WHEN toxic = 1 AND verdict <> 'fail' THEN list_concat(why, ['table6_rejected']) ELSE why END, '|') AS reasons, toxic IS NOT NULL AS checked
    FROM s1 LEFT JOIN s3 USING (doc_id)""")
def stage_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-stage verdicts with a later stage's rejections merged in."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", _auto(F.col("n_chars")).alias("verdict"), _why(F.col("n_chars")).alias("why"))
    later = merge.last_wins(_t(spark, sf_dir, "labels"), "doc_id", "toxic", "quality").select("doc_id", (F.col("toxic") == 0).alias("accepted"))
    both = merge.merge_stages(docs, [later], "doc_id")
    v, why = merge.override(F.col("verdict"), F.col("accepted"), F.col("why"))
    return both.select("doc_id", v.alias("verdict"), F.array_join(why, "|").alias("reasons"), F.col("accepted").isNotNull().alias("checked"))


_HUMAN_SQL = f"""
    WITH a AS (SELECT doc_id, {_AUTO_SQL} AS auto FROM documents), h AS (SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 'pass' WHEN toxic = 1 THEN 'fail' ELSE '' END AS human FROM labels),
    m AS (SELECT doc_id, auto AS auto_verdict, coalesce(nullif(human, ''), auto) AS verdict, coalesce(human, '') <> '' AS human_reviewed FROM a LEFT JOIN h USING (doc_id))"""


def _reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    auto = _t(spark, sf_dir, "documents").select("doc_id", _auto(F.col("n_chars")).alias("verdict"))
    human = _t(spark, sf_dir, "labels").select("doc_id", F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "pass").when(F.col("toxic") == 1, "fail").otherwise("").alias("human_verdict"))
    return merge.human_override(auto, human, "doc_id")


@query(_HUMAN_SQL + """
    SELECT CASE WHEN NOT human_reviewed THEN 'not_reviewed' WHEN auto_verdict = verdict THEN 'no_change' ELSE auto_verdict || '_to_' || verdict END AS impact, count(*) AS n, sum(doc_id)::BIGINT AS id_sum FROM m GROUP BY 1""")
def human_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What human review changed."""
    impact = F.when(~F.col("human_reviewed"), "not_reviewed").when(F.col("auto_verdict") == F.col("verdict"), "no_change").otherwise(F.concat("auto_verdict", F.lit("_to_"), "verdict"))
    return _reviewed(spark, sf_dir).groupBy(impact.alias("impact")).agg(F.count("*").alias("n"), F.sum("doc_id").alias("id_sum"))


@query(_HUMAN_SQL + """,
    r AS (SELECT CASE WHEN auto_verdict = 'flag' THEN 'fail' ELSE auto_verdict END AS auto, verdict AS human FROM m WHERE human_reviewed), c AS (SELECT auto, human, count(*) AS k FROM r GROUP BY ALL)
    SELECT d.auto, d.human, coalesce(k, 0)::BIGINT AS n, round(100.0 * coalesce(k, 0) / (SELECT count(*) FROM r), 1) AS pct
    FROM (SELECT a.v AS auto, h.v AS human FROM (VALUES ('pass'), ('fail')) a(v), (VALUES ('pass'), ('fail')) h(v)) d LEFT JOIN c USING (auto, human)""")
def agreement_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Automatic against human verdicts, empty cells included."""
    rows = _reviewed(spark, sf_dir).where("human_reviewed").select(F.when(F.col("auto_verdict") == "flag", "fail").otherwise(F.col("auto_verdict")).alias("auto"), F.col("verdict").alias("human"))
    return merge.agreement(rows, "auto", "human", ("pass", "fail"))


@query(_HUMAN_SQL + """
    SELECT lang AS issue, count(*) AS n FROM m JOIN documents USING (doc_id) WHERE human_reviewed AND auto_verdict <> verdict GROUP BY 1""")
def issue_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disagreements by issue."""
    rows = _reviewed(spark, sf_dir).where("human_reviewed AND auto_verdict <> verdict")
    return rows.join(_t(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("issue")), "doc_id").where("issue IS NOT NULL").groupBy("issue").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag = 'R')")
def incremental_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted rows that aren't there yet."""
    there = _t(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return merge.missing(_t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), there, "o_orderkey")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_totalprice > 200000)")
def processable_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose key the index has."""
    index = _t(spark, sf_dir, "orders").where("o_orderstatus = 'F' AND o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return merge.present(_t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), index, "c_custkey")


@query("""
    WITH h AS (SELECT user_id, event_type, avg(value) FILTER (ts < TIMESTAMP '2024-01-15') AS a, avg(value) FILTER (ts >= TIMESTAMP '2024-01-15') AS b FROM events GROUP BY ALL)
    SELECT user_id, event_type, round(CASE WHEN a > 0 THEN b / a ELSE 'inf'::DOUBLE END, 6) AS ratio FROM h WHERE a IS NOT NULL AND b IS NOT NULL""")
def compare_runs_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs' values per key, as a ratio."""
    events = _t(spark, sf_dir, "events").select("user_id", "event_type", "ts", "value")
    split = F.lit("2024-01-15").cast("timestamp_ntz")
    run = lambda rows, name: rows.groupBy("user_id", "event_type").agg(F.avg("value").alias(name))
    both = run(events.where(F.col("ts") < split), "a").join(run(events.where(F.col("ts") >= split), "b"), ["user_id", "event_type"])
    return both.select("user_id", "event_type", _r(C.ratio(F.col("b"), F.col("a"))).alias("ratio"))


@query("""
    WITH d AS (SELECT l_suppkey, count(*) AS done FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1), w AS (SELECT l_suppkey, count(*) AS wanted FROM lineitem GROUP BY 1)
    SELECT s_suppkey, coalesce(done, 0)::BIGINT AS done, wanted, round(100.0 * coalesce(done, 0) / wanted, 4) AS pct, 100.0 * coalesce(done, 0) / wanted >= 50 AS ok FROM supplier JOIN w ON w.l_suppkey = s_suppkey LEFT JOIN d ON d.l_suppkey = s_suppkey""")
def completion_vs_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completion per key against its target."""
    items = _t(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_linestatus") == "F").alias("done"), F.count("*").alias("wanted"))
    rows = _t(spark, sf_dir, "supplier").join(items, F.col("s_suppkey") == F.col("l_suppkey"))
    pct = 100.0 * F.col("done") / F.col("wanted")
    return rows.select("s_suppkey", "done", "wanted", _r(pct, 4).alias("pct"), (pct >= 50).alias("ok"))


# --- aggregates ----------------------------------------------------------------------------------------------------------


@query("""
    SELECT n_name AS dataset, count(*) AS samples, sum(l_quantity)::BIGINT AS size, count(DISTINCT l_suppkey) AS workers, round(avg(l_quantity), 6) AS avg_size FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1
    UNION ALL SELECT 'total', count(*), sum(l_quantity)::BIGINT, count(DISTINCT l_suppkey), round(avg(l_quantity), 6) FROM lineitem""")
def shard_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples, bytes and workers per dataset and in total, from one pass of sums per worker."""
    per = _t(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    names = _t(spark, sf_dir, "supplier").join(_t(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    rows = per.join(names, F.col("l_suppkey") == F.col("s_suppkey"))
    g = rows.rollup("n_name").agg(F.sum("n").alias("samples"), F.sum("q").cast("long").alias("size"), F.count("*").alias("workers"), _r(F.sum("q") / F.sum("n")).alias("avg_size"))
    return g.select(F.coalesce("n_name", F.lit("total")).alias("dataset"), "samples", "size", "workers", "avg_size")


@query("""
    WITH m AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, least(20, greatest(2, count(DISTINCT o_totalprice))) AS bins FROM orders)
    SELECT least(floor((o_totalprice - lo) / ((hi - lo) / bins)), bins - 1)::BIGINT AS bin, count(*) AS n FROM orders, m GROUP BY 1""")
def histogram_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal-width histogram, the last bin closed."""
    orders = _t(spark, sf_dir, "orders").select("o_totalprice")
    some = orders.distinct().limit(20).count()  # only whether there are 20 different values matters
    bins = min(20, max(2, some))
    edges = orders.agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))
    at = F.least(F.floor((F.col("o_totalprice") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / bins)), F.lit(bins - 1))
    return orders.join(F.broadcast(edges)).groupBy(at.cast("long").alias("bin")).agg(F.count("*").alias("n"))


@query(f"""
    WITH r AS (SELECT lang, {_AUTO_SQL} AS verdict, ceil(row_number() OVER (ORDER BY doc_id) / 800.0)::BIGINT AS batch FROM documents)
    SELECT batch, coalesce(lang, 'all') AS "group", coalesce(verdict, 'all') AS verdict, count(*) AS n FROM r GROUP BY GROUPING SETS ((batch, lang), (batch, verdict))""")
def batch_stats_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review batches of 800 rows with counts by group and by verdict."""
    rows = packing.place(_t(spark, sf_dir, "documents").select("doc_id", "lang", _auto(F.col("n_chars")).alias("verdict")), "doc_id")
    rows = rows.withColumn("batch", F.ceil(F.col("rn") / 800).cast("long"))
    sets = rows.groupingSets([["batch", "lang"], ["batch", "verdict"]], "batch", "lang", "verdict").agg(F.count("*").alias("n"))
    return sets.select("batch", F.coalesce("lang", F.lit("all")).alias("group"), F.coalesce("verdict", F.lit("all")).alias("verdict"), "n")


@query("""
    SELECT label, round(avg(x), 6) AS cx, round(avg(y), 6) AS cy, round(avg(z), 6) AS cz, round(quantile_cont(d, 0.5), 6) AS median_radius, round(min(y), 6) AS low, round(max(y), 6) AS high
    FROM (SELECT *, sqrt((x - mx) * (x - mx) + (y - my) * (y - my) + (z - mz) * (z - mz)) AS d FROM (SELECT *, avg(x) OVER w AS mx, avg(y) OVER w AS my, avg(z) OVER w AS mz
          FROM (SELECT label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings) WINDOW w AS (PARTITION BY label))) GROUP BY label""")
def scene_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centroid, median radius and height range of each scene."""
    points = _t(spark, sf_dir, "embeddings").select("label", *[F.col("embedding")[i].cast("double").alias(a) for i, a in enumerate("xyz")])
    centre = points.groupBy("label").agg(*[F.avg(a).alias(f"m{a}") for a in "xyz"], F.min("y").alias("low"), F.max("y").alias("high"))
    d = F.sqrt(sum((F.col(a) - F.col(f"m{a}")) ** 2 for a in "xyz"))
    radius = points.join(centre, "label").groupBy("label").agg(F.percentile(d, F.lit(0.5)).alias("median_radius"))
    return centre.join(radius, "label").select("label", *[_r(f"m{a}").alias(f"c{a}") for a in "xyz"], _r("median_radius").alias("median_radius"), _r("low").alias("low"), _r("high").alias("high"))


# --- time series ---------------------------------------------------------------------------------------------------------


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.numbered(_t(spark, sf_dir, "events").select("user_id", *ORDER, "value"), "user_id", *ORDER).select("user_id", "t", "value")


_T_SQL = "WITH f AS (SELECT user_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)::INT AS t, value FROM events)"


@query(_T_SQL + """,
    a AS (SELECT user_id, list(value ORDER BY t) AS xs FROM f GROUP BY 1),
    e AS (SELECT user_id, unnest(list_transform(xs, lambda x, i: list_reduce(xs[1:i], lambda p, q: 0.99::DOUBLE * p + (1 - 0.99::DOUBLE) * q))) AS value, unnest(generate_series(0, len(xs) - 1))::INT AS t FROM a)
    SELECT user_id, t, round(value, 6) AS value FROM e""")
def ema_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exponential moving average of a clip's scales."""
    return series.ema(_frames(spark, sf_dir), "user_id", "t", "value", 0.99).select("user_id", "t", _r("value").alias("value"))


@query(_T_SQL.replace("WITH f", "WITH RECURSIVE f") + """,
    g AS (SELECT user_id, t, CASE WHEN value >= 100 THEN value END AS x FROM f),
    r AS (SELECT user_id, t, x AS e FROM g WHERE t = 0 UNION ALL SELECT g.user_id, g.t, CASE WHEN g.x IS NULL THEN r.e WHEN r.e IS NULL THEN g.x ELSE 0.9 * r.e + (1 - 0.9::DOUBLE) * g.x END FROM r JOIN g ON g.user_id = r.user_id AND g.t = r.t + 1)
    SELECT user_id, t, round(e, 6) AS value FROM r""")
def ema_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with frames that have no valid scale: the last average is carried on."""
    frames = _frames(spark, sf_dir).withColumn("value", F.when(F.col("value") >= 100, F.col("value")))
    return series.ema(frames, "user_id", "t", "value", 0.9).select("user_id", "t", _r("value").alias("value"))


@query("""
    SELECT l_suppkey, round(sum(l_extendedprice) FILTER (l_quantity > 2 AND l_extendedprice > 2) / sum(l_quantity) FILTER (l_quantity > 2 AND l_extendedprice > 2), 6) AS scale,
           round(sum(l_quantity * l_extendedprice / (l_extendedprice + 1e-8)) / sum(l_quantity * l_quantity / (l_extendedprice + 1e-8)), 6) AS scale_inverse_target FROM lineitem GROUP BY 1""")
def wls_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted least-squares scales, both variants."""
    items = _t(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_extendedprice")
    a = series.ratio_scale(items, ["l_suppkey"], "l_quantity", "l_extendedprice", min_valid=2)
    b = series.ratio_scale(items, ["l_suppkey"], "l_quantity", "l_extendedprice", "inverse_target").withColumnRenamed("scale", "s2")
    return a.join(b, "l_suppkey").select("l_suppkey", _r("scale").alias("scale"), _r("s2").alias("scale_inverse_target"))


@query(_T_SQL + """, n AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n, lead(value, 8) OVER (PARTITION BY user_id ORDER BY t) AS b FROM f)
    SELECT user_id, t, round(abs(b - value), 6) AS flow FROM n WHERE t % 8 = 0 AND t < n - 8""")
def pair_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame pairs at a fixed stride."""
    return series.pairs(_frames(spark, sf_dir), "user_id", "value", 8).select("user_id", "t", _r(F.abs(F.col("b") - F.col("a"))).alias("flow"))


@query(_T_SQL + " SELECT user_id, t // 20 AS chunk, round(avg(value), 6) AS mean FROM f GROUP BY 1, 2 HAVING count(*) = 20")
def tumbling_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of whole chunks."""
    return series.full_chunks(_frames(spark, sf_dir), "user_id", "value", 20).select("user_id", F.col("chunk").cast("int").alias("chunk"), _r("mean").alias("mean"))


@query(_T_SQL + """,
    n AS (SELECT user_id, greatest(count(*) - 16, 0) AS last FROM f GROUP BY 1),
    s AS (SELECT DISTINCT user_id, start FROM (SELECT user_id, unnest(list_append(generate_series(0, last, 8), last)) AS start FROM n)),
    w AS (SELECT s.user_id, start, t, value FROM s JOIN f ON f.user_id = s.user_id AND t >= start AND t < start + 16),
    m AS (SELECT user_id, start, avg(value) AS m FROM w GROUP BY 1, 2)
    SELECT user_id, t, round(avg(m), 8) AS smoothed FROM w JOIN m USING (user_id, start) GROUP BY 1, 2""")
def sliding_chunk_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages over overlapping windows."""
    return series.sliding_mean(_frames(spark, sf_dir), "user_id", "value").select("user_id", "t", _r("smoothed", 8).alias("smoothed"))


@query(_T_SQL + """,
    g AS (SELECT s.user_id, s.t, CASE WHEN f.t % 3 = 1 THEN value END AS v FROM (SELECT user_id, unnest(generate_series(0, max(t)))::INT AS t FROM f GROUP BY 1) s LEFT JOIN f USING (user_id, t)),
    b AS (SELECT user_id, t, last_value(v IGNORE NULLS) OVER p AS v0, last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER p AS t0, first_value(v IGNORE NULLS) OVER q AS v1, first_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER q AS t1 FROM g
          WINDOW p AS (PARTITION BY user_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), q AS (PARTITION BY user_id ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT user_id, t, round(coalesce(CASE WHEN t0 = t1 THEN v0 ELSE v0 + (v1 - v0) * (t - t0) / (t1 - t0) END, v0, v1), 6) AS value FROM b""")
def linear_interp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known frames interpolated to every frame of the track, clamped at the ends."""
    frames = _frames(spark, sf_dir)
    return series.interpolate(frames.where("t % 3 = 1"), "user_id", "value", frames.groupBy("user_id").agg((F.max("t") + 1).alias("n"))).select("user_id", "t", _r("value").alias("value"))


_KERNEL = series.kernel(1.5)


@query(_T_SQL + f""",
    k AS (SELECT * FROM {_values([(d - len(_KERNEL) // 2, w) for d, w in enumerate(_KERNEL)], 'd, w')}), n AS (SELECT user_id, count(*) AS n FROM f GROUP BY 1)
    SELECT f.user_id, f.t, round(sum(k.w * g.value), 6) AS value FROM f JOIN n USING (user_id) CROSS JOIN k JOIN f g ON g.user_id = f.user_id AND g.t = least(greatest(f.t + k.d, 0), n - 1) GROUP BY 1, 2""")
def gaussian_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaussian smoothing with repeated edges."""
    return series.smoothed(_frames(spark, sf_dir), "user_id", "t", "value", 1.5).select("user_id", "t", _r("value").alias("value"))


@query("SELECT event_id, user_id, round(sum(value - 245) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 6) AS walk FROM events")
def cumulative_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running sums of the steps."""
    w = series.Window.partitionBy("user_id").orderBy(*ORDER).rowsBetween(series.Window.unboundedPreceding, 0)
    return _t(spark, sf_dir, "events").select("event_id", "user_id", _r(F.sum(F.col("value") - 245).over(w)).alias("walk"))


@query(_T_SQL + """,
    n AS (SELECT user_id, count(*) AS n FROM f GROUP BY 1), i AS (SELECT user_id, n, unnest(generate_series(0, ceil(n * 16 / 24.0)::INT - 1)) AS i FROM n), x AS (SELECT user_id, i, least(round_even(i * 24.0 / 16.0, 0)::INT, (n - 1)::INT) AS t FROM i)
    SELECT x.user_id, x.i::INT AS i, x.t, round(value, 6) AS value FROM x JOIN f USING (user_id, t)""")
def fps_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of a 24 fps track at 16 fps."""
    frames = _frames(spark, sf_dir)
    n = frames.groupBy("user_id").agg(F.count("*").alias("n"))
    wanted = n.select("user_id", "n", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") * 16 / 24.0).cast("int") - 1)).alias("i")).select("user_id", "i", series.resampled_index(F.col("i"), 24.0, F.col("n")).alias("t"))
    return wanted.join(frames, ["user_id", "t"]).select("user_id", "i", "t", _r("value").alias("value"))


@query(_T_SQL + """,
    n AS (SELECT user_id, count(*) AS n FROM f GROUP BY 1)
    SELECT user_id, array_to_string(list_transform(generate_series(0, 7), lambda i: floor(i * (n - 1) / 7.0)::INT), ',') AS keyframes, array_to_string(list_transform(generate_series(0, 9), lambda i: round_even(i * (n - 1) / 9.0, 0)::INT), ',') AS even FROM n""")
def keyframe_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evenly spaced frame indexes, truncated and rounded."""
    n = _frames(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("n"))
    return n.select("user_id", F.array_join(series.even_truncated(F.col("n"), 8).cast("array<string>"), ",").alias("keyframes"), F.array_join(series.even_rounded(F.col("n"), 10).cast("array<string>"), ",").alias("even"))


@query("SELECT user_id, round(avg(d), 6) AS motion FROM (SELECT user_id, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS d FROM events) GROUP BY 1")
def motion_proxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean absolute difference of consecutive frames."""
    rows = series.steps(_t(spark, sf_dir, "events").select("user_id", *ORDER, "value"), "user_id", ORDER, ["value"])
    return rows.groupBy("user_id").agg(_r(F.avg("step")).alias("motion"))


@query(_T_SQL + """,
    x AS (SELECT user_id, t, value AS truth, value + (t % 5) AS found FROM f), d AS (SELECT *, found - lag(found) OVER (PARTITION BY user_id ORDER BY t) AS d FROM x)
    SELECT user_id, round(avg(abs(found - truth)), 6) AS mae, round(100 * avg(abs(found - truth) / abs(truth)), 6) AS mape, round((max(found) - min(found)) / (max(truth) - min(truth)), 6) AS range_ratio, coalesce(min(d) > -5, true) AS monotonic FROM d GROUP BY 1""")
def focal_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well a found focal track follows the true one."""
    frames = _frames(spark, sf_dir).select("user_id", "t", F.col("value").alias("truth"), (F.col("value") + F.col("t") % 5).alias("found"))
    g = series.focal_tracking(frames, "user_id", "truth", "found")
    return g.select("user_id", _r("mae").alias("mae"), _r("mape").alias("mape"), _r("range_ratio").alias("range_ratio"), "monotonic")


# --- samples, shards, resume ---------------------------------------------------------------------------------------------

_CHANCE_SQL = "('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT / 4294967296.0"
_JUMPS_SQL = "(n_chars % 97)::INT"


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_chars")
    return _t(spark, sf_dir, "documents").select("doc_id", "lang", _auto(n).alias("verdict"), _why(n).alias("why"), (n % 97).cast("int").alias("n_jumps"))


@query(f"SELECT doc_id, lang, verdict FROM (SELECT doc_id, lang, {_AUTO_SQL} AS verdict FROM documents) WHERE verdict = 'flag' OR verdict = 'pass' AND {_CHANCE_SQL} < 0.05")
def deep_check_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flags and a twentieth of the passes."""
    return sampling.deep_check(_samples(spark, sf_dir), "doc_id", "verdict", 0.05).select("doc_id", "lang", "verdict")


@query(f"""
    WITH g AS (SELECT lang, count(*) FILTER (v = 'pass') AS n_pass, count(*) FILTER (v = 'fail') AS n_fail, count(*) FILTER (v = 'flag') AS n_flag, CASE lang WHEN 'en' THEN 'high' WHEN 'fr' THEN 'medium' ELSE 'low' END AS priority FROM (SELECT lang, {_AUTO_SQL} AS v FROM documents) GROUP BY 1),
    q AS (SELECT *, coalesce(least(CASE priority WHEN 'high' THEN CASE WHEN n_flag > 1000 THEN 2000 WHEN n_flag > 100 THEN 800 END WHEN 'medium' THEN CASE WHEN n_flag > 100 THEN 400 END ELSE 500 END, n_flag), n_flag)::BIGINT AS q_flag, CASE WHEN n_pass > 10000 THEN 500 WHEN n_pass > 1000 THEN 300 ELSE floor(n_pass * 0.2) END AS few FROM g),
    r AS (SELECT *, (CASE WHEN q_flag < 100 THEN greatest(few, 400) ELSE few END)::BIGINT AS q_pass, (CASE WHEN n_fail > 100 THEN 100 ELSE least(50, n_fail) END)::BIGINT AS q_fail FROM q)
    SELECT lang, priority, n_pass, n_fail, n_flag, q_flag, q_pass, q_fail, q_flag + q_pass + q_fail AS q_total FROM r""")
def quota_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review quotas of each group."""
    v = F.col("verdict")
    g = _samples(spark, sf_dir).groupBy("lang").agg(F.count_if(v == "pass").alias("n_pass"), F.count_if(v == "fail").alias("n_fail"), F.count_if(v == "flag").alias("n_flag"))
    return sampling.quotas(g.withColumn("priority", F.when(F.col("lang") == "en", "high").when(F.col("lang") == "fr", "medium").otherwise("low")))


_STRATA_SQL = """
    WITH s AS (SELECT doc_id, lang, md5('42:' || doc_id) AS r, n_chars % 97 > 10 AS jumps, length(trim(text)) < 400 AS short, n_chars % 13 = 0 AS word, n_chars % 200 > 180 AS sat FROM documents WHERE n_chars % 97 <= 50),
    f AS (SELECT *, jumps::INT + short::INT + word::INT + sat::INT AS reasons FROM s),
    s2 AS (SELECT doc_id, lang, r, CASE WHEN reasons >= 2 THEN 'multi' WHEN jumps OR short OR sat THEN 'boundary' ELSE 'single' END AS stratum FROM f WHERE reasons > 0)"""


@query(_STRATA_SQL + """,
    i AS (SELECT *, row_number() OVER (PARTITION BY lang, stratum ORDER BY r, doc_id) AS i, count(*) OVER (PARTITION BY lang) AS n, count(*) FILTER (stratum = 'boundary') OVER (PARTITION BY lang) AS nb, count(*) FILTER (stratum = 'multi') OVER (PARTITION BY lang) AS nm FROM s2),
    p AS (SELECT *, i <= CASE stratum WHEN 'boundary' THEN 8 WHEN 'multi' THEN 6 ELSE 20 - least(nb, 8) - least(nm, 6) END AS picked FROM i),
    k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY picked DESC, r, doc_id) AS k FROM p)
    SELECT doc_id, lang, stratum FROM k WHERE n <= 20 OR k <= 20""")
def stratified_flag_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of the first stage by stratum, topped up: the strata come from the stage's own reasons."""
    n, none = F.col("n_chars"), F.array().cast("array<string>")
    rows = _t(spark, sf_dir, "documents").select("doc_id", "lang", (n % 97).alias("n_jumps"), F.trim("text").alias("caption"), none.alias("hard_reasons"), F.when(n % 13 == 0, F.array(F.lit("pan left"))).otherwise(none).alias("words"), (n % 200).cast("double").alias("sat"))
    verdict, why = validation.stage1(rows, F.lit(400), F.lit(10), F.lit(50), F.col("words"), (F.col("sat"), F.lit(0.0), F.lit(180.0)))
    flags = rows.select("doc_id", "lang", verdict.alias("verdict"), why.alias("why")).where("verdict = 'flag'")
    return sampling.stratified_flags(flags, "lang", "doc_id", "why", 20).select("doc_id", "lang", "stratum")


@query(f"""
    WITH s AS (SELECT doc_id, lang, md5('42:' || doc_id) AS r, n_jumps > 50 AS boundary FROM (SELECT doc_id, lang, {_AUTO_SQL} AS v, {_JUMPS_SQL} AS n_jumps FROM documents) WHERE v = 'fail'),
    i AS (SELECT *, row_number() OVER (PARTITION BY lang, boundary ORDER BY r, doc_id) AS i, count(*) OVER (PARTITION BY lang) AS n, least(count(*) FILTER (boundary) OVER (PARTITION BY lang), 7) AS e FROM s)
    SELECT doc_id, lang, boundary FROM i WHERE n <= 10 OR i <= CASE WHEN boundary THEN e ELSE 10 - e END""")
def fail_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fails near the limit first."""
    hard = F.when(F.col("n_jumps") > 50, F.array().cast("array<string>")).otherwise(F.array(F.lit("so3_invalid")))
    rows = _samples(spark, sf_dir).where("verdict = 'fail'").withColumns({"hard_reasons": hard, "caption": F.lit("")})
    _, why = validation.stage1(rows, F.lit(0), F.lit(10), F.lit(50))
    rows = rows.withColumn("why", why)
    return sampling.fail_sample(rows, "lang", "doc_id", "why", 10).select("doc_id", "lang", "boundary")


@query(f"""
    WITH s AS (SELECT doc_id, {_AUTO_SQL} AS v, {_JUMPS_SQL} AS j, len({_WHY_SQL}) AS w, md5('42:' || doc_id) AS r FROM documents),
    a AS (SELECT doc_id, 1 AS bucket FROM s WHERE v = 'fail' ORDER BY j, doc_id LIMIT 40), b AS (SELECT doc_id, 2 AS bucket FROM s WHERE w >= 2 ORDER BY w DESC, doc_id LIMIT 20),
    l AS (SELECT * FROM s WHERE doc_id NOT IN (SELECT doc_id FROM a UNION SELECT doc_id FROM b)),
    c AS (SELECT doc_id, 3 AS bucket FROM l WHERE v = 'pass' ORDER BY r, doc_id LIMIT 30), d AS (SELECT doc_id, 4 AS bucket FROM l WHERE v = 'fail' ORDER BY r, doc_id LIMIT 10)
    SELECT doc_id, min(bucket)::INT AS bucket FROM (FROM a UNION ALL FROM b UNION ALL FROM c UNION ALL FROM d) GROUP BY 1 ORDER BY 2, 1 LIMIT 100""")
def balanced_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review list of 100 from four buckets."""
    return sampling.balanced(_samples(spark, sf_dir), "doc_id", "verdict", "n_jumps", "why", 100).select("doc_id", "bucket")


_KIND_SQL = "CASE WHEN len(why) >= 2 THEN 'multi' WHEN list_contains(why, 'n_jumps') THEN 'n_jumps' WHEN list_contains(why, 'tone') THEN 'camera_word' ELSE 'other' END"


@query(f"""
    WITH s AS (SELECT doc_id, lang, v, {_KIND_SQL} AS kind, md5('42:' || doc_id) AS r FROM (SELECT doc_id, lang, {_AUTO_SQL} AS v, {_WHY_SQL} AS why FROM documents)),
    p AS (SELECT * FROM (SELECT * FROM s WHERE v = 'pass' QUALIFY row_number() OVER (PARTITION BY lang ORDER BY r, doc_id) = 1) ORDER BY r, doc_id LIMIT 5), f AS (SELECT * FROM s WHERE v = 'fail' ORDER BY r, doc_id LIMIT 3),
    g AS (SELECT * FROM s WHERE v = 'flag' QUALIFY row_number() OVER (PARTITION BY kind ORDER BY r, doc_id) <= CASE kind WHEN 'camera_word' THEN 1 ELSE 2 END),
    c AS (SELECT *, 1 AS part FROM (FROM p UNION ALL FROM f UNION ALL FROM g)), x AS (SELECT *, 2 AS part FROM s WHERE doc_id NOT IN (SELECT doc_id FROM c))
    SELECT doc_id, lang, v AS verdict, part FROM (FROM c UNION ALL FROM x) ORDER BY part, r, doc_id LIMIT 20""")
def golden_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty reference samples."""
    why = F.col("why")
    kind = F.when(F.size(why) >= 2, "multi").when(F.array_contains(why, "n_jumps"), "n_jumps").when(F.array_contains(why, "tone"), "camera_word").otherwise("other")
    return sampling.golden(_samples(spark, sf_dir).withColumn("kind", kind), "doc_id", "lang", "verdict", "kind").select("doc_id", "lang", "verdict", "part")


@query("""
    WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS n FROM documents), s AS (SELECT *, (rn - 1) // 100 AS shard FROM r)
    SELECT doc_id, shard::BIGINT AS shard, 'shard-' || lpad(shard::VARCHAR, 6, '0') || '.tar' AS name, (shard % 3)::BIGINT AS worker, (CASE WHEN rn <= (n % 7) * (n // 7 + 1) THEN (rn - 1) // (n // 7 + 1) ELSE n % 7 + (rn - 1 - (n % 7) * (n // 7 + 1)) // (n // 7) END)::BIGINT AS part FROM s""")
def shard_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard, file name, strided worker and contiguous part of every sample."""
    docs = _t(spark, sf_dir, "documents").select("doc_id")
    rows = packing.place(docs, "doc_id")
    n = docs.agg(F.count("*").alias("n"))
    shard = packing.shard_of(F.col("rn"), 100)
    return rows.join(F.broadcast(n)).select("doc_id", shard.alias("shard"), packing.shard_name(shard).alias("name"), packing.strided(shard, 3).alias("worker"), packing.contiguous(F.col("rn"), F.col("n"), 7).alias("part"))


@query("""
    SELECT o_orderkey, o_orderpriority FROM orders o WHERE NOT (o_orderstatus = 'F' AND EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_linestatus = 'F'))""")
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work without a done mark or without its output."""
    orders = _t(spark, sf_dir, "orders")
    done = orders.where("o_orderstatus = 'F'").select("o_orderkey")
    output = _t(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return merge.pending(orders.select("o_orderkey", "o_orderpriority"), done, output, "o_orderkey")


@query("""
    WITH m AS (SELECT l_partkey AS sample, l_suppkey AS shard, list_distinct(list(l_returnflag)) AS have FROM lineitem GROUP BY ALL),
    f AS (SELECT * FROM m WHERE list_contains(have, 'N') AND list_contains(have, 'R'))
    SELECT sample, min(shard) AS shard, arg_min(list_contains(have, 'A'), shard) AS "has_A" FROM f GROUP BY 1""")
def locate_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First shard with all required members of a sample, one member being optional."""
    members = _t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("sample"), F.col("l_suppkey").alias("shard"), "l_returnflag")
    return merge.locate(members, "sample", "shard", "l_returnflag", ("N", "R"), ("A",))


# --- text and JSON -------------------------------------------------------------------------------------------------------

_VERBS = ("ring", "plate", "rule", "the", "tion", "of")
_HITS_SQL = "[" + ", ".join(f"CASE WHEN regexp_matches(lower(p_name), '{C.verb_pattern(v)}') THEN '{v}' END" for v in _VERBS) + "]"


@query(f"SELECT p_partkey, array_to_string(list_filter({_HITS_SQL}, lambda x: x IS NOT NULL), '|') AS hits FROM part")
def forbidden_verbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inflected verbs found in a caption."""
    return _t(spark, sf_dir, "part").select("p_partkey", F.array_join(C.verb_hits(F.col("p_name"), _VERBS, None), "|").alias("hits"))


_STRIP = ("reer", "onth", "edhe")
_STRIP_SQL = "|".join(map(C.verb_pattern, _STRIP))


@query(f"""
    WITH p AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS p FROM documents)
    SELECT doc_id, md5(array_to_string(list_filter(p, lambda s: s <> '' AND NOT regexp_matches(lower(s), '{_STRIP_SQL}')), ' ')) AS kept, len(p) AS n FROM p""")
def strip_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions without offending sentences (as a digest, with the number of sentences)."""
    text = F.col("text")
    return _t(spark, sf_dir, "documents").select("doc_id", F.md5(C.strip_sentences(text, _STRIP, None)).alias("kept"), (F.regexp_count(C.trimmed(text), F.lit(r"[.!?]\s")) + 1).cast("long").alias("n"))


_PHRASES = (r"\bthe\s+\w+ing\b", r"\bof\s+(?:the|a)\b", r"\bthat\s+on\b")


@query("SELECT doc_id, array_to_string(list_filter([" + ", ".join(f"regexp_extract(text, '(?i){p}')" for p in _PHRASES) + "], lambda x: x <> ''), '|') AS phrases FROM documents")
def phrase_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First match of each phrase pattern."""
    return _t(spark, sf_dir, "documents").select("doc_id", F.array_join(C.phrase_matches(F.col("text"), _PHRASES), "|").alias("phrases"))


_SITES = ("https://th", "http://blog")


@query("SELECT page_id, CASE WHEN starts_with(url, 'https://th') THEN 'https://th' WHEN starts_with(url, 'http://blog') THEN 'http://blog' ELSE split_part(split_part(url, '_', 1), '-', 1) END AS dataset FROM pages")
def dataset_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset of an id by prefix."""
    return _t(spark, sf_dir, "pages").select("page_id", C.dataset_of(F.col("url"), _SITES).alias("dataset"))


@query(f"""
    WITH a AS (SELECT conv_id, turn, text, regexp_matches(lower(text), '{_STRIP_SQL}') AS bad FROM conversations WHERE role = 'assistant'),
    g AS (SELECT conv_id, arg_min(text, turn) FILTER (NOT bad) AS clean, arg_max(text, turn) AS last, count(*) AS n FROM a GROUP BY 1),
    s AS (SELECT *, array_to_string(list_filter(string_split(regexp_replace(regexp_replace(last, '^\\s+|\\s+$', '', 'g'), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '' AND NOT regexp_matches(lower(x), '{_STRIP_SQL}')), ' ') AS cut FROM g)
    SELECT conv_id, n AS attempts, CASE WHEN clean IS NOT NULL THEN 'clean' WHEN cut <> '' THEN 'stripped' ELSE 'fallback' END AS how, md5(coalesce(clean, nullif(cut, ''), 'A static scene.')) AS caption FROM s""")
def caption_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First clean attempt; else the last one without its bad sentences; else a fixed caption."""
    rows = _t(spark, sf_dir, "conversations").where("role = 'assistant'").select("conv_id", "turn", "text", C.has_verb(F.col("text"), _STRIP, None).alias("bad"))
    g = rows.groupBy("conv_id").agg(F.min_by("text", F.when(~F.col("bad"), F.col("turn"))).alias("clean"), F.max_by("text", "turn").alias("last"), F.count("*").alias("n"), F.count_if(~F.col("bad")).alias("good"))
    g = g.select("conv_id", "n", F.when(F.col("good") > 0, F.col("clean")).alias("clean"), C.strip_sentences(F.col("last"), _STRIP, None).alias("cut"))
    how = F.when(F.col("clean").isNotNull(), "clean").when(F.col("cut") != "", "stripped").otherwise("fallback")
    return g.select("conv_id", F.col("n").alias("attempts"), how.alias("how"), F.md5(F.coalesce("clean", F.nullif("cut", F.lit("")), F.lit("A static scene."))).alias("caption"))


@query("""
    SELECT event_id, coalesce(TRY_CAST(json_extract_string(regexp_extract('reply: ' || props || ' end', '(?s)\\{.*\\}'), '$.k') AS INT), -1) AS k, greatest(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INT), -1), 0) + greatest(coalesce(TRY_CAST(json_extract_string(props, '$.missing') AS INT), -1), 0) AS entity_count FROM events""")
def props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed fields of a reply's JSON with sentinels."""
    said = F.from_json(C.brace_slice(F.concat(F.lit("reply: "), "props", F.lit(" end"))), "k int, missing int")
    rows = _t(spark, sf_dir, "events").select("event_id", said.alias("j")).select("event_id", F.coalesce("j.k", F.lit(-1)).alias("k"), F.coalesce("j.missing", F.lit(-1)).alias("m"))
    return rows.select("event_id", "k", verdict.entity_count(F.col("k"), F.col("m")).cast("int").alias("entity_count"))


@query("""
    SELECT page_id, regexp_replace(regexp_replace(url, '[^A-Za-z0-9_.-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') AS safe_id, split_part(list_last(string_split(url, '/')), '.', 1) AS key, ('0x' || substr(sha1(url), 1, 8))::BIGINT AS seed FROM pages""")
def safe_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File-safe ids, sample keys and seeds."""
    u = F.col("url")
    return _t(spark, sf_dir, "pages").select("page_id", C.safe_id(u).alias("safe_id"), C.sample_key(u).alias("key"), C.seed_of(u).alias("seed"))


# --- associations and geometry -------------------------------------------------------------------------------------------


@query("""
    WITH q AS (SELECT vec_id, label, embedding FROM embeddings WHERE vec_id % 100 = 0), p AS (SELECT q.vec_id AS query_id, b.vec_id AS base_id, round(sqrt(list_sum(list_transform(list_zip(q.embedding, b.embedding), lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) * (x[1]::DOUBLE - x[2]::DOUBLE)))), 6) AS dist FROM q JOIN embeddings b ON b.vec_id <> q.vec_id)
    SELECT query_id, base_id, dist FROM p QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY dist, base_id) = 1""")
def nearest_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest stored signature of each query (every hundredth row) among all others."""
    rows = _t(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    queries = rows.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return merge.nearest_vector(queries, rows.select(F.col("vec_id").alias("base_id"), "embedding"), "query_id", "base_id", "embedding", others=True)




@query("""
    WITH a AS (SELECT event_id AS id_a, user_id, epoch(ts) AS ta FROM events WHERE event_type = 'click'), b AS (SELECT event_id AS id_b, user_id, epoch(ts) AS tb FROM events WHERE event_type <> 'click')
    SELECT id_a, id_b, round(abs(ta - tb), 6) AS diff FROM a JOIN b ON a.user_id = b.user_id AND abs(ta - tb) < 7200 QUALIFY row_number() OVER (PARTITION BY id_a ORDER BY abs(ta - tb), id_b) = 1""")
def asof_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest event in time within a tolerance."""
    rows = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"))
    a = rows.where("event_type = 'click'").select(F.col("event_id").alias("id_a"), "user_id", F.col("at").alias("ta"))
    b = rows.where("event_type <> 'click'").select(F.col("event_id").alias("id_b"), "user_id", F.col("at").alias("tb"))
    found = merge.candidates(a, b, "ta", "tb", 7200.0, on=["user_id"])
    return merge.nearest(found, ["id_a"], "id_b").select("id_a", "id_b", _r("diff").alias("diff"))


@query("""
    WITH RECURSIVE e AS (SELECT user_id, event_type = 'click' AS a, epoch_us(ts) / 1e6 AS at FROM events),
    p AS (SELECT DISTINCT x.user_id, x.at AS ta, y.at AS tb, abs(x.at - y.at) AS diff FROM e x JOIN e y ON x.user_id = y.user_id AND x.a AND NOT y.a AND abs(x.at - y.at) < 7200),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY diff, ta, tb) AS k FROM p),
    g AS (
      SELECT user_id, 0::BIGINT AS k, []::DOUBLE[] AS used_a, []::DOUBLE[] AS used_b, false AS free, NULL::DOUBLE AS ta, NULL::DOUBLE AS tb, NULL::DOUBLE AS diff FROM (SELECT DISTINCT user_id FROM r)
      UNION ALL
      SELECT user_id, k, CASE WHEN free THEN list_append(used_a, ta) ELSE used_a END, CASE WHEN free THEN list_append(used_b, tb) ELSE used_b END, free, ta, tb, diff
      FROM (SELECT g.user_id, r.k, g.used_a, g.used_b, NOT list_contains(g.used_a, r.ta) AND NOT list_contains(g.used_b, r.tb) AS free, r.ta, r.tb, r.diff FROM g JOIN r ON r.user_id = g.user_id AND r.k = g.k + 1))
    SELECT user_id, ta, tb, diff FROM g WHERE free""")
def asof_one_to_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy one-to-one association in time."""
    rows = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"))
    a = rows.where("event_type = 'click'").select("user_id", F.col("at").alias("ta"))
    b = rows.where("event_type <> 'click'").select("user_id", F.col("at").alias("tb"))
    return merge.associate(merge.candidates(a, b, "ta", "tb", 7200.0, on=["user_id"]).select("user_id", "ta", "tb", "diff"), "user_id", "ta", "tb")


@query("SELECT l_suppkey, round(regr_slope(l_extendedprice, l_quantity), 6) AS fx, round(regr_intercept(l_extendedprice, l_quantity), 4) AS cx, round(regr_slope(l_tax, l_discount), 6) AS fy, round(regr_intercept(l_tax, l_discount), 6) AS cy FROM lineitem GROUP BY 1")
def ray_line_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pinhole intrinsics as straight-line fits."""
    g = geometry.ray_intrinsics(_t(spark, sf_dir, "lineitem"), "l_suppkey", "l_extendedprice", "l_tax", "l_quantity", "l_discount")
    return g.select("l_suppkey", _r("fx").alias("fx"), _r("cx", 4).alias("cx"), _r("fy").alias("fy"), _r("cy").alias("cy"))


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    return _t(spark, sf_dir, "embeddings").select("label", "vec_id", *[e[i].cast("double").alias(f"a{i}") for i in range(3)], *[e[i + 3].cast("double").alias(f"b{i}") for i in range(3)])


@query()
def sim3_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity transform per group from moments."""
    return geometry.sim3(_points(spark, sf_dir), "label", ["a0", "a1", "a2"], ["b0", "b1", "b2"])


@query()
def sim3_inlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Robust similarity transform per group."""
    return geometry.sim3_inliers(_points(spark, sf_dir), "label", ["vec_id"], ["a0", "a1", "a2"], ["b0", "b1", "b2"])


@query()
def metric_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale per group, refitted once on the points within a percentile."""
    return geometry.metric_scale(_points(spark, sf_dir), "label", ["vec_id"], ["a0", "a1", "a2"], ["b0", "b1", "b2"])


@query()
def trajectory_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors left after each group's transform."""
    points = _points(spark, sf_dir)
    fits = geometry.sim3(points, "label", ["a0", "a1", "a2"], ["b0", "b1", "b2"])
    return geometry.trajectory_error(points, "label", fits, ["a0", "a1", "a2"], ["b0", "b1", "b2"])


@query("SELECT n_name, k::INT AS k, n_name || '_' || lpad(k::VARCHAR, 6, '0') AS clip_id FROM (SELECT n_name, unnest(generate_series(0, n_regionkey * 3)) AS k FROM nation)")
def job_enumeration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per clip to make."""
    return generators.jobs(_t(spark, sf_dir, "nation").withColumn("target", F.col("n_regionkey") * 3 + 1), "n_name", "target").select("n_name", "k", "clip_id")


@query("""
    SELECT n_nationkey, t::INT AS t, round((1 + n_regionkey) * cos(2 * pi() * t / 60.0), 6) + 0.0 AS x, round((1 + n_regionkey) * sin(2 * pi() * t / 60.0), 6) + 0.0 AS z FROM nation, (SELECT unnest(generate_series(0, 60)) AS t)""")
def motion_orbit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An orbit in closed form for every scene."""
    rows = _t(spark, sf_dir, "nation").select("n_nationkey", (F.col("n_regionkey") + 1).alias("radius"), F.explode(F.sequence(F.lit(0), F.lit(60))).alias("t"))
    origin = (F.lit(0.0),) * 3
    x, _, z = generators.family_position("orbit", F.col("t") / 60.0, F.col("radius"), origin, origin, origin)
    return rows.select("n_nationkey", "t", (_r(x) + 0.0).alias("x"), (_r(z) + 0.0).alias("z"))


@query(f"""
    WITH r AS (SELECT * FROM {_values(rule_rows(), 'source, metric, lo, hi')}), n AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS k FROM (SELECT DISTINCT source FROM r)),
    d AS (SELECT n.source, doc_id, (n_chars % 130)::DOUBLE AS score FROM documents JOIN n ON doc_id % {len(RULES)} = k)
    SELECT source, metric, count(*) AS n_samples, count(*) FILTER ((lo IS NULL OR score >= lo) AND (hi IS NULL OR score <= hi)) AS n_inside FROM r JOIN d USING (source) GROUP BY ALL""")
def rule_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each rule of the table the samples of its source, and those whose score lies in its range."""
    rules = rule_table(spark)
    numbered = spark.createDataFrame([(x, k) for k, x in enumerate(sorted(RULES))], "source string, k long")
    docs = _t(spark, sf_dir, "documents").select((F.col("doc_id") % len(RULES)).alias("k"), (F.col("n_chars") % 130).cast("double").alias("score"))
    inside = (F.col("lo").isNull() | (F.col("score") >= F.col("lo"))) & (F.col("hi").isNull() | (F.col("score") <= F.col("hi")))
    rows = docs.join(F.broadcast(numbered.join(rules, "source")), "k")
    return rows.groupBy("source", "metric").agg(F.count("*").alias("n_samples"), F.count_if(inside).alias("n_inside"))
