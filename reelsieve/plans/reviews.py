"""Queries of review imports and of unpacked samples over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import review
from ..sources import readers
from .checks import _t
from .registry import query

_RECORDS_SQL = """
    WITH r AS (SELECT doc_id, CASE WHEN n_chars % 3 = 0 THEN 'fail' ELSE 'pass' END AS auto, source FROM documents WHERE doc_id % 10 < 8),
    d AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'fail' WHEN doc_id % 4 = 1 THEN 'pass' WHEN n_chars % 3 = 0 THEN 'fail' ELSE 'pass' END AS auto,
        CASE quality WHEN 1 THEN 'pass' ELSE CASE WHEN toxic = 1 THEN 'fail' WHEN doc_id % 2 = 0 THEN '' END END AS human, CASE WHEN toxic = 1 THEN 'other' ELSE '' END AS issue, lang AS notes
        FROM labels JOIN documents USING (doc_id)),
    m AS (SELECT doc_id AS sample_id, source, d.auto AS auto_verdict, coalesce(nullif(human, ''), d.auto) AS human_verdict, nullif(issue, '') AS primary_issue, coalesce(notes, '') AS notes, coalesce(human, '') <> '' AS reviewed
        FROM r JOIN d USING (doc_id))"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every labelled document as a filled decision, imported on a review list whose automatic verdicts are older ones."""
    docs = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("sample_id"), "lang", "source", "n_chars")
    k, first = F.col("sample_id"), F.when(F.col("n_chars") % 3 == 0, "fail").otherwise("pass")
    listed = docs.where(k % 10 < 8).select("sample_id", first.alias("auto_verdict"), F.col("source").alias("subset"))
    auto = F.when(k % 4 == 0, "fail").when(k % 4 == 1, "pass").otherwise(first)
    human = F.when(F.col("quality") == 1, "pass").when(F.col("toxic") == 1, "fail").when(k % 2 == 0, "")
    given = _t(spark, sf_dir, "labels").withColumnRenamed("doc_id", "sample_id").join(docs, "sample_id")
    given = given.select("sample_id", auto.alias("auto_verdict"), human.alias("human_verdict"), F.when(F.col("toxic") == 1, "other").otherwise("").alias("primary_issue"), F.col("lang").alias("notes"))
    return review.imported(listed, given, "batch1", "2024-01-31")


@query(_RECORDS_SQL + """
    SELECT sample_id, auto_verdict, human_verdict, NULL::VARCHAR AS video_quality, NULL::VARCHAR AS trajectory_quality, primary_issue, notes, 'batch1' AS reviewer, '2024-01-31' AS review_date, reviewed FROM m""")
def review_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result records of filled decisions: a blank verdict is the decision's automatic one."""
    return _records(spark, sf_dir)


@query(_RECORDS_SQL + """
    SELECT notes, count(*) AS total, count(*) FILTER (reviewed) AS reviewed, round(100.0 * count(*) FILTER (reviewed) / count(*), 1) AS reviewed_pct,
        count(*) FILTER (NOT reviewed) AS not_reviewed, round(100.0 * count(*) FILTER (NOT reviewed) / count(*), 1) AS not_reviewed_pct FROM m GROUP BY 1""")
def review_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed and not reviewed records, by language."""
    return review.statistics(_records(spark, sf_dir), "notes")


@query(_RECORDS_SQL + """
    SELECT auto_verdict, human_verdict, primary_issue, count(*) AS n FROM m WHERE (auto_verdict, human_verdict) IN (('pass', 'fail'), ('fail', 'pass')) GROUP BY ALL""")
def review_disagreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both directions of disagreement, by issue."""
    return review.disagreements(_records(spark, sf_dir))


_EXT = ("mp4", "caption.txt", "meta.json")


@query("""
    WITH f AS (SELECT l_orderkey AS k, '/data/final_wds-' || l_orderkey % 7 || '/wds-' || l_orderkey % 7 || '/w00' || l_orderkey % 3 || '/shard-' || l_suppkey % 5 AS dir, ['mp4', 'caption.txt', 'meta.json'][l_linenumber % 3 + 1] AS ext FROM lineitem),
    d AS (SELECT k, dir, bool_or(ext = 'mp4') AS v, bool_or(ext = 'caption.txt') AS c FROM f GROUP BY ALL),
    p AS (SELECT k, max(dir) AS dir, arg_max(c, dir) AS c FROM d WHERE v GROUP BY 1)
    SELECT k::VARCHAR AS sample_id, dir AS shard_dir, dir || '/' || k || '.mp4' AS mp4, dir || '/' || k || '.poses_c2w.npy' AS poses, CASE WHEN c THEN '' ELSE dir || '/' || k || '.caption.txt' END AS missing
    FROM p WHERE k IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def processable_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the files of unpacked samples: where each complete sample's files are, and what it lacks."""
    k = F.col("l_orderkey")
    ext = F.element_at(F.array(*[F.lit(e) for e in _EXT]), F.col("l_linenumber").cast("int") % 3 + 1)
    path = F.concat(F.lit("/data/final_wds-"), k % 7, F.lit("/wds-"), k % 7, F.lit("/w00"), k % 3, F.lit("/shard-"), F.col("l_suppkey") % 5, F.lit("/"), k, F.lit("."), ext)
    done = _t(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("sample_id"))
    found = readers.sample_paths(_t(spark, sf_dir, "lineitem").select(path.alias("path")), done)
    return found.select("sample_id", "shard_dir", "mp4", F.col("poses_c2w_npy").alias("poses"), F.array_join("missing", "|").alias("missing"))
