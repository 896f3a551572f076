"""Exact percentiles of groups of any size, without a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Values of a group that a rank may be off in the first pass, as a share of the group.
_ACCURACY = 2000


def exact_percentile(df: DataFrame, key: str, value: str, share: float) -> DataFrame:
    """key, value: the percentile of each key's values with linear interpolation between the two nearest ranks; nulls don't count.

    A first pass gives two values between which both ranks lie, within a thousandth or two of the group; a second one counts what
    is below them and ranks the distinct values between. A null key is a group; one without values gives no row.
    """
    if not 0 <= share <= 1:
        raise ValueError("the share has to be in [0, 1]")
    rows = df.select(F.col(key).alias("__key"), F.col(value).cast("double").alias("__v")).where("__v IS NOT NULL")
    around = [max(0.0, share - 2 / _ACCURACY), min(1.0, share + 2 / _ACCURACY)]
    ends = rows.groupBy("__key").agg(F.count("*").alias("n"), F.min("__v").alias("low"), F.max("__v").alias("high"), F.percentile_approx("__v", around, _ACCURACY).alias("p"))
    # A small group is ranked whole: its sketch's ranks can be off by a value or two.
    small = F.col("n") <= 4 * _ACCURACY
    low = F.when(small | F.lit(around[0] == 0.0), F.col("low")).otherwise(F.col("p")[0])
    high = F.when(small | F.lit(around[1] == 1.0), F.col("high")).otherwise(F.col("p")[1])
    ends = ends.select(F.col("__key").alias("__group"), "n", low.alias("low"), high.alias("high"))
    inside = rows.join(ends, F.col("__key").eqNullSafe(F.col("__group")))
    # What is below counts as one value, so that its number comes with the ranks.
    at = F.when(F.col("__v") >= F.col("low"), F.col("__v"))
    counts = inside.where("__v <= high").groupBy("__group", at.alias("v")).agg(F.count("*").alias("c"), F.first("n").alias("n"))
    upto = F.sum("c").over(Window.partitionBy("__group").orderBy(F.asc_nulls_first("v")))
    ranked = counts.withColumn("upto", upto)
    place = (F.col("n") - 1) * F.lit(share)
    first, second = F.floor(place), F.ceil(place)
    found = ranked.where("v IS NOT NULL").groupBy("__group").agg(
        F.min(F.when(F.col("upto") > first, F.col("v"))).alias("a"), F.min(F.when(F.col("upto") > second, F.col("v"))).alias("b"), F.first(place - first).alias("part")
    )
    return found.select(F.col("__group").alias(key), (F.col("a") + (F.col("b") - F.col("a")) * F.col("part")).alias("value"))
