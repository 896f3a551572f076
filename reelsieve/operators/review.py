"""Filled review decisions: checked against the review list, merged with it, written as result records, and reported on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import merge, report, validation

#: The fields of a result record, in the order of its JSON.
FIELDS = ("sample_id", "auto_verdict", "human_verdict", "video_quality", "trajectory_quality", "primary_issue", "notes", "reviewer", "review_date")
_SHOWN = 5


def suffixed(left: DataFrame, right: DataFrame, key: str, suffixes: tuple[str, str]) -> DataFrame:
    """Inner join on key, in which columns that both sides have (in any case) carry their side's suffix; a null key joins nothing."""
    both = {c.lower() for c in left.columns} & {c.lower() for c in right.columns} - {key.lower()}

    def named(df: DataFrame, suffix: str) -> DataFrame:
        return df.withColumnsRenamed({c: c + suffix for c in df.columns if c.lower() in both})

    return named(left, suffixes[0]).join(named(right, suffixes[1]), key)


def checked(decisions: DataFrame, review: DataFrame, key: str = "sample_id") -> DataFrame:
    """decisions, if each is of the review list and has a known verdict or none; else an error that names the first ones. Unknown issues are no error."""
    given = decisions if "primary_issue" in decisions.columns else decisions.withColumn("primary_issue", F.lit(None).cast("string"))
    wrong = validation.decisions(given, review, key, "human_verdict", "primary_issue").where("level = 'error'")
    if some := wrong.orderBy(key, "message").limit(_SHOWN + 1).collect():
        more = " and more" if len(some) > _SHOWN else ""
        raise ValueError("; ".join(f"{r[key]}: {r.message}" for r in some[:_SHOWN]) + more)
    return decisions


def imported(review: DataFrame, decisions: DataFrame, reviewer: str, day: str, key: str = "sample_id") -> DataFrame:
    """One result record for each decision on a row of the review list, with `reviewed`: whether its verdict was filled in.

    A blank verdict is the automatic one, other blank fields are null (notes: empty). Fields come from the decisions; where they
    lack one, from the review list. Repeated rows of a side give repeated records.
    """
    both = suffixed(review, decisions, key, ("_review", "_decision"))

    def field(name: str) -> Column:
        for c in (name + "_decision", name):
            if c in both.columns:
                return F.nullif(F.col(c).cast("string"), F.lit(""))
        return F.lit(None).cast("string")

    human = field("human_verdict")
    return both.select(
        key, field("auto_verdict").alias("auto_verdict"), F.coalesce(human, field("auto_verdict")).alias("human_verdict"), *[field(c).alias(c) for c in FIELDS[3:6]],
        F.coalesce(field("notes"), F.lit("")).alias("notes"), F.lit(reviewer).alias("reviewer"), F.lit(day).alias("review_date"), human.isNotNull().alias("reviewed"),
    )


def statistics(records: DataFrame, *groups: str) -> DataFrame:
    """total, reviewed, reviewed_pct, not_reviewed, not_reviewed_pct of imported records, by groups; a table without rows has 0 of each."""
    n, done = F.count("*"), F.count_if("reviewed")

    def pct(part: Column) -> Column:
        return F.when(n > 0, F.round(100 * part / n, 1)).otherwise(0.0)

    return records.groupBy(*groups).agg(n.alias("total"), done.alias("reviewed"), pct(done).alias("reviewed_pct"), (n - done).alias("not_reviewed"), pct(n - done).alias("not_reviewed_pct"))


def disagreements(records: DataFrame) -> DataFrame:
    """auto_verdict, human_verdict, primary_issue, n of records in which a person turned pass into fail or fail into pass.

    A record without an issue counts under null, so that a direction's counts add up to its records.
    """
    sides = F.col("auto_verdict").isin("pass", "fail") & F.col("human_verdict").isin("pass", "fail")
    return records.where(sides & (F.col("auto_verdict") != F.col("human_verdict"))).groupBy("auto_verdict", "human_verdict", "primary_issue").agg(F.count("*").alias("n"))


def write_records(records: DataFrame, path: str) -> None:
    """Result records as JSON lines, empty fields as null."""
    records.select(*[c for c in records.columns if c != "reviewed"]).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def page(records: DataFrame) -> str:
    """The report of an import as HTML: counts, agreement, and both directions of disagreement by issue, the commonest first."""
    wrong = disagreements(records).orderBy(F.desc("n"), F.asc_nulls_last("primary_issue"))
    sides = [("fail", "pass"), ("pass", "fail")]
    return report.pages(
        "Human review",
        [
            ("Overall Statistics", statistics(records)),
            ("Agreement Analysis", merge.agreement(records, "auto_verdict", "human_verdict", ("pass", "fail")).orderBy("auto_verdict", "human_verdict")),
            *[(f"Disagreement: {a} to {h}", wrong.where((F.col("auto_verdict") == a) & (F.col("human_verdict") == h)).select("primary_issue", "n")) for a, h in sides],
        ],
    )
