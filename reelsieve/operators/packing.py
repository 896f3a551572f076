"""Numbers for shards, batches and workers; sinks for manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..steps import written


def place(df: DataFrame, *order: str, out: str = "rn") -> DataFrame:
    """Row numbers 1, 2, ... over the whole table in the order of its columns `order` (of any type, nulls first), without a single-task sort.

    Spark's range partitions, as many as the session and AQE choose, are sorted and written; a row's number is its place in
    its partition behind the rows of those before. Rows that agree in all of order follow each other in any way, but the
    same one whenever the result is read; they lie in one partition, so name a key last where many rows agree.
    """
    part, row, before = (f"__{x}_{out}" for x in ("part", "row", "before"))
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(rows.select("*", F.spark_partition_id().alias(part), F.monotonically_increasing_id().alias(row)), "placed")
    sizes = rows.groupBy(part).agg(F.count("*").alias("n"), F.min(row).alias("low"))
    # One row for each partition: this window is as small as the number of partitions.
    ahead = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(part, (F.coalesce(F.sum("n").over(ahead), F.lit(0)) - F.col("low") + 1).alias(before))
    return rows.join(F.broadcast(starts), part).withColumn(out, F.col(row) + F.col(before)).drop(part, row, before)


def shard_of(rn: Column, capacity: int) -> Column:
    return F.floor((rn - 1) / capacity).cast("long")


def shard_name(number: Column, prefix: str = "shard") -> Column:
    return F.concat(F.lit(prefix + "-"), F.lpad(number.cast("string"), 6, "0"), F.lit(".tar"))


def strided(number: Column, workers: int) -> Column:
    return F.pmod(number, F.lit(workers)).cast("long")


def contiguous(rn: Column, n: Column, workers: int) -> Column:
    """Worker of row rn (from 1) of n: contiguous parts, the first n % workers of them one row longer."""
    size, extra = F.floor(n / workers), n % workers
    long_part = extra * (size + 1)
    return F.when(rn <= long_part, F.floor((rn - 1) / (size + 1))).otherwise(extra + F.floor((rn - 1 - long_part) / F.greatest(size, F.lit(1)))).cast("long")


def manifest_line(id_col: str, why: str) -> Column:
    return F.concat_ws("\t", F.col(id_col).cast("string"), F.concat_ws("|", F.col(why)))


def write_manifests(df: DataFrame, path: str, id_col: str, verdict: str, why: str) -> None:
    """One text folder per verdict: ids, for others than passes with a tab and their reasons."""
    for v in ("pass", "fail", "flag"):
        line = F.col(id_col).cast("string") if v == "pass" else manifest_line(id_col, why)
        df.where(F.col(verdict) == v).select(line.alias("value")).write.mode("overwrite").text(f"{path}/{v}")
