"""Reproducible samples: hash thresholds, stratified quotas, balanced buckets, golden selections.

Order and chance come from md5(seed:id), so a sample doesn't depend on partitions, file order or reruns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank(seed: int | str, id_col: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def chance(seed: int | str, id_col: str) -> Column:
    """A number in [0, 1) from the first 8 hex digits of the hash."""
    return F.conv(F.substring(rank(seed, id_col), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def deep_check(df: DataFrame, id_col: str, verdict: str, fraction: float, seed: int = 42) -> DataFrame:
    """All flagged rows, a fraction of the passed ones, no failed one."""
    return df.where((F.col(verdict) == "flag") | ((F.col(verdict) == "pass") & (chance(seed, id_col) < fraction)))


def quotas(df: DataFrame, n_pass: str = "n_pass", n_fail: str = "n_fail", n_flag: str = "n_flag", priority: str = "priority") -> DataFrame:
    """q_flag, q_pass, q_fail, q_total: how many rows of each group to review, from its counts and priority."""
    p, f, g = F.col(n_pass), F.col(n_fail), F.col(n_flag)
    most = F.when(F.col(priority) == "high", F.when(g > 1000, 2000).when(g > 100, 800)).when(F.col(priority) == "medium", F.when(g > 100, 400)).otherwise(500)
    flag = F.coalesce(F.least(most, g), g).cast("long")
    some = F.when(p > 10000, 500).when(p > 1000, 300).otherwise(F.floor(p * 0.2)).cast("long")
    passed = F.when(flag < 100, F.greatest(some, F.lit(400))).otherwise(some).cast("long")
    failed = F.when(f > 100, 100).otherwise(F.least(F.lit(50), f)).cast("long")
    out = df.withColumns({"q_flag": flag, "q_pass": passed, "q_fail": failed})
    return out.withColumn("q_total", F.col("q_flag") + F.col("q_pass") + F.col("q_fail"))


def top(df: DataFrame, group: list[str], n: int | Column, *order: Column | str) -> DataFrame:
    """The first n rows of each group in the order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("__n") <= n).drop("__n")


def stratified_flags(df: DataFrame, group: str, id_col: str, why: str, n: int, seed: int = 42) -> DataFrame:
    """n flagged rows per group: 40 % near a threshold, 30 % with several reasons, the rest with one; then whatever is left.

    Groups of at most n rows come whole. Rows carry `stratum` (multi, boundary, single).
    """
    near = F.exists(why, lambda r: r.contains("n_jumps") | r.contains("caption_len") | r.contains("saturation"))
    rows = df.withColumn("stratum", F.when(F.size(why) >= 2, "multi").when(near, "boundary").otherwise("single"))
    r = rank(seed, id_col)
    per = Window.partitionBy(group)
    rows = rows.withColumn("__i", F.row_number().over(Window.partitionBy(group, "stratum").orderBy(r, id_col))).withColumn("__all", F.count("*").over(per))
    caps = {"boundary": int(n * 0.4), "multi": int(n * 0.3)}
    took = sum(F.least(F.count_if(F.col("stratum") == s).over(per), F.lit(c)) for s, c in caps.items())
    rows = rows.withColumn("__single", F.lit(n) - took)
    limit = F.when(F.col("stratum") == "single", F.col("__single")).when(F.col("stratum") == "boundary", caps["boundary"]).otherwise(caps["multi"])
    first = (F.col("__i") <= limit).cast("int")
    rows = rows.withColumn("__k", F.row_number().over(Window.partitionBy(group).orderBy(F.lit(1) - first, r, id_col)))
    return rows.where((F.col("__all") <= n) | (F.col("__k") <= n)).drop("__i", "__all", "__single", "__k")


def fail_sample(df: DataFrame, group: str, id_col: str, why: str, n: int, seed: int = 42) -> DataFrame:
    """n failed rows per group: 70 % just over the jump limit, the rest of others; no topping up. Groups of at most n rows come whole."""
    edge = F.exists(why, lambda r: r.contains("n_jumps") & r.contains("max_jumps_fail"))
    rows = df.withColumn("boundary", edge)
    per = Window.partitionBy(group)
    rows = rows.withColumn("__i", F.row_number().over(Window.partitionBy(group, "boundary").orderBy(rank(seed, id_col), id_col)))
    rows = rows.withColumn("__e", F.least(F.count_if("boundary").over(per), F.lit(int(n * 0.7)))).withColumn("__all", F.count("*").over(per))
    limit = F.when(F.col("boundary"), F.col("__e")).otherwise(F.lit(n) - F.col("__e"))
    return rows.where((F.col("__all") <= n) | (F.col("__i") <= limit)).drop("__i", "__e", "__all")


def balanced(df: DataFrame, id_col: str, verdict: str, n_jumps: str, why: str, total: int, seed: int = 42) -> DataFrame:
    """Up to total rows with their bucket: 40 % fails nearest the limit, 20 % with most reasons, 30 % passes and 10 % fails by chance.

    A row counts for the first bucket that has it; later buckets draw from rows that aren't taken.
    """
    n = [int(total * x) for x in (0.4, 0.2, 0.3, 0.1)]
    near = df.where(F.col(verdict) == "fail").orderBy(F.coalesce(n_jumps, F.lit(999)), id_col).limit(n[0]).withColumn("bucket", F.lit(1))
    many = df.where(F.size(why) >= 2).orderBy(F.size(why).desc(), id_col).limit(n[1]).withColumn("bucket", F.lit(2))
    taken = near.select(id_col).unionByName(many.select(id_col)).distinct()
    left = df.join(taken, id_col, "left_anti")
    passed = left.where(F.col(verdict) == "pass").orderBy(rank(seed, id_col), id_col).limit(n[2]).withColumn("bucket", F.lit(3))
    failed = left.where(F.col(verdict) == "fail").orderBy(rank(seed, id_col), id_col).limit(n[3]).withColumn("bucket", F.lit(4))
    every = near.unionByName(many).unionByName(passed).unionByName(failed)
    once = every.withColumn("__n", F.row_number().over(Window.partitionBy(id_col).orderBy("bucket"))).where("__n = 1").drop("__n")
    return once.orderBy("bucket", id_col).limit(total)


def golden(df: DataFrame, id_col: str, group: str, verdict: str, kind: str, total: int = 20, n_pass: int = 5, n_fail: int = 3, kinds: dict[str, int] | None = None, seed: int = 42) -> DataFrame:
    """A small reference set: passes of different groups, fails, flags by kind, filled up to total from the rest."""
    kinds = kinds or {"n_jumps": 2, "camera_word": 1, "multi": 2, "other": 2}
    r = rank(seed, id_col)
    one_each = top(df.where(F.col(verdict) == "pass"), [group], 1, r, id_col).orderBy(r, id_col).limit(n_pass)
    fails = df.where(F.col(verdict) == "fail").orderBy(r, id_col).limit(n_fail)
    wanted = F.coalesce(*[F.when(F.col(kind) == k, n) for k, n in kinds.items()], F.lit(0))
    flags = top(df.where(F.col(verdict) == "flag"), [kind], wanted, r, id_col)
    chosen = one_each.unionByName(fails).unionByName(flags).withColumn("part", F.lit(1))
    rest = df.join(chosen.select(id_col), id_col, "left_anti").orderBy(r, id_col).limit(total).withColumn("part", F.lit(2))
    return chosen.unionByName(rest).orderBy("part", r, id_col).limit(total)
