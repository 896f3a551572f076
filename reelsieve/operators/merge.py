"""Joins and merges: stage results, overrides, incremental lists, associations in time, components of review."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..steps import written


def last_wins(df: DataFrame, key: str, *seq: str) -> DataFrame:
    """One row per key: the last in the order of seq."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*[F.col(s).desc() for s in seq]))).where("__n = 1").drop("__n")


def first_wins(df: DataFrame, key: str, *seq: str) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*seq))).where("__n = 1").drop("__n")


def merge_stages(first: DataFrame, later: list[DataFrame], key: str) -> DataFrame:
    """Left joins that keep the first stage's rows; later stages hold one row per key."""
    for df in later:
        first = first.join(df, key, "left")
    return first


def override(verdict: Column, accepted: Column, why: Column, more: Column | None = None) -> tuple[Column, Column]:
    """A later stage that doesn't accept turns any verdict but fail into fail and appends its reasons."""
    rejects = F.coalesce(~accepted, F.lit(False)) & (verdict != "fail")
    added = F.coalesce(more, F.array(F.lit("table6_rejected"))) if more is not None else F.array(F.lit("table6_rejected"))
    return F.when(rejects, "fail").otherwise(verdict), F.when(rejects, F.concat(why, added)).otherwise(why)


def human_override(auto: DataFrame, human: DataFrame, key: str) -> DataFrame:
    """verdict: the human's where there is one; human_reviewed, auto_verdict. human: key, human_verdict."""
    given = F.nullif("human_verdict", F.lit(""))
    return auto.join(human, key, "left").select(*[c for c in auto.columns if c != "verdict"], F.col("verdict").alias("auto_verdict"), F.coalesce(given, "verdict").alias("verdict"), given.isNotNull().alias("human_reviewed"))


def missing(wanted: DataFrame, there: DataFrame, key: str) -> DataFrame:
    """Rows of wanted whose key isn't there."""
    return wanted.join(there.select(key), key, "left_anti")


def present(wanted: DataFrame, there: DataFrame, key: str) -> DataFrame:
    return wanted.join(there.select(key), key, "left_semi")


def pending(wanted: DataFrame, done: DataFrame, output: DataFrame, key: str) -> DataFrame:
    """Work that isn't complete: complete means listed as done and with its output there."""
    return wanted.join(done.select(key).join(output.select(key), key).distinct(), key, "left_anti")


def agreement(df: DataFrame, auto: str, human: str, domain: tuple[str, ...]) -> DataFrame:
    """n and pct (of all rows) for each pair of verdicts of the domain, zero cells included."""
    spark = df.sparkSession
    cells = spark.createDataFrame([(a, h) for a in domain for h in domain], f"{auto} string, {human} string")
    counts = df.groupBy(auto, human).agg(F.count("*").alias("n"))
    rows = F.broadcast(cells).join(counts, [auto, human], "left").select(auto, human, F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    total = df.agg(F.count("*").alias("total"))
    return rows.join(F.broadcast(total)).select(auto, human, "n", F.when(F.col("total") > 0, F.round(100 * F.col("n") / F.col("total"), 1)).otherwise(0.0).alias("pct"))


def locate(members: DataFrame, sample: str, shard: str, ext: str, required: tuple[str, ...], optional: tuple[str, ...] = ()) -> DataFrame:
    """sample, shard: the first shard that holds all required members of a sample; has_<optional> flags."""
    have = F.collect_set(ext).alias("have")
    want = F.array(*[F.lit(x) for x in required])
    full = members.groupBy(sample, shard).agg(have).where(F.size(F.array_except(want, "have")) == 0)
    return full.groupBy(sample).agg(F.min(shard).alias(shard), *[F.min_by(F.array_contains("have", o), shard).alias(f"has_{o.replace('.', '_')}") for o in optional])


def candidates(a: DataFrame, b: DataFrame, time_a: str, time_b: str, tolerance: float, offset: float = 0.0, on: list[str] | None = None) -> DataFrame:
    """All pairs nearer than the tolerance (strictly), by an equi-join on time buckets; adds `diff`.

    Each b row is dealt to its bucket and both neighbours, so the join never compares all rows with all.
    """
    on = on or []
    width = F.lit(tolerance)
    left = a.withColumn("__bucket", F.floor(F.col(time_a) / width).cast("long"))
    right = b.withColumn("__at", F.floor((F.col(time_b) + offset) / width).cast("long")).withColumn("__bucket", F.explode(F.array(F.col("__at") - 1, F.col("__at"), F.col("__at") + 1))).drop("__at")
    rows = left.join(right, [*on, "__bucket"]).withColumn("diff", F.abs(F.col(time_a) - (F.col(time_b) + offset)))
    return rows.where(F.col("diff") < tolerance).drop("__bucket")


def nearest(pairs: DataFrame, key: list[str], *tie: str) -> DataFrame:
    """Of each key's candidates the one with the smallest diff."""
    return pairs.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy("diff", *tie))).where("__n = 1").drop("__n")


def associate(pairs: DataFrame, group: str, time_a: str, time_b: str) -> DataFrame:
    """One-to-one pairs by growing difference (ties: a, then b) within each group, as if they were taken one after another.

    A pair that comes first among all pairs of its a and among all of its b is taken whatever the others do. So each round
    takes all such pairs and drops what shares an a or a b with them, until none are left: the greedy choice, by windows over
    one frame's candidates, without a group in one task. Rounds are as many as the longest row of pairs of which each is kept
    from being first by the next; each is written. pairs: group, time_a, time_b, diff; a repeated pair counts once.
    """
    by_a, by_b = (Window.partitionBy(group, x) for x in (time_a, time_b))
    order = ("diff", time_a, time_b)
    left, taken = written(pairs.dropDuplicates([group, time_a, time_b]), "pairs"), pairs.limit(0)
    while not left.isEmpty():
        ranked = left.withColumn("__a", F.row_number().over(by_a.orderBy(*order))).withColumn("__b", F.row_number().over(by_b.orderBy(*order)))
        first = ranked.withColumn("__first", (F.col("__a") == 1) & (F.col("__b") == 1))
        out = first.withColumn("__out", F.max("__first").over(by_b)).withColumn("__out", F.col("__out") | F.max("__first").over(by_a))
        step = written(out.where("__first OR NOT __out").drop("__a", "__b", "__out"), "association")
        taken = taken.unionByName(step.where("__first").drop("__first"))
        left = step.where("NOT __first").drop("__first")
    return taken


#: Partial distances that a task holds at once.
_HELD = 1 << 21


def nearest_vector(queries: DataFrame, base: DataFrame, id_q: str, id_b: str, vector: str, block: int = 4096, others: bool = False) -> DataFrame:
    """id_q, id_b, dist: each query's nearest base vector (ties: smaller id); others: but the one of its own id, where both tables are one.

    The queries are sent to the base in blocks of at most `block`, by a hash of their ids. A task compares its base rows with a
    block by products of matrices, takes the exact distance of what comes within a millionth of the nearest, and sends on one
    row for each of these distances: no table of pairs is made. dist has 6 digits. Vectors are of one length, without nulls.
    """
    spark = base.sparkSession
    asked = written(queries.select(F.col(id_q).alias("q"), F.col(vector).cast("array<double>").alias("v")), "asked")
    blocks = max(1, -(-2 * asked.count() // block))
    while not asked.groupBy(F.pmod(F.xxhash64("q"), F.lit(blocks))).count().where(F.col("count") > block).isEmpty() and blocks < 1 << 20:
        blocks *= 2
    out = asked.select(F.col("q").alias(id_q), F.lit(None).cast("long").alias(id_b), F.lit(None).cast("double").alias("dist")).limit(0)
    for k in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == k).toArrow()
        if not rows.num_rows:
            continue
        sent = spark.sparkContext.broadcast((rows["q"].to_numpy(), np.array(rows["v"].to_pylist(), float).reshape(rows.num_rows, -1)))
        near = base.select(F.col(id_b).cast("long").alias("b"), F.col(vector).cast("array<double>").alias("v")).mapInArrow(_nearest_in(sent, others), "q long, b long, dist double")
        best = near.groupBy("q").agg(F.min(F.struct(F.round("dist", 6).alias("dist"), "b")).alias("m"))
        step = written(best.select(F.col("q").alias(id_q), F.col("m.b").alias(id_b), F.col("m.dist").alias("dist")), "nearest")
        sent.unpersist()
        out = out.unionByName(step)
    return out


def _nearest_in(sent: Broadcast, others: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, vectors = sent.value
        best, found = np.full(len(asked), np.inf), []
        lengths = (vectors**2).sum(axis=1)
        for batch in batches:
            if not len(asked):
                break
            ids, rows = batch.column("b").to_numpy(), np.array(batch.column("v").to_pylist(), float)
            run = max(1, _HELD // len(asked))
            for at in range(0, len(ids), run):
                part, own = rows[at : at + run], ids[at : at + run]
                rough = lengths[:, None] + (part**2).sum(axis=1)[None, :] - 2 * vectors @ part.T
                if others:
                    rough[asked[:, None] == own[None, :]] = np.inf
                best = np.minimum(best, np.sqrt(np.maximum(rough.min(axis=1), 0)))
                # Squares of products are off by rounding; the margin is wider, and than the last of the 6 digits.
                q, b = np.nonzero(rough <= ((best + 2e-6) ** 2 + 1e-9 * (1 + lengths))[:, None])
                exact = np.sqrt(((vectors[q] - part[b]) ** 2).sum(axis=1))
                # Copies of a vector are one row, that of the smallest id.
                order = np.lexsort((own[b], exact, q))
                q, exact, b = q[order], exact[order], own[b][order]
                first = np.concatenate(([True], (np.diff(q) != 0) | (np.diff(exact) != 0)))[: len(q)]
                found.append((q[first], b[first], exact[first]))
        if found:
            q, b, exact = (np.concatenate(x) for x in zip(*found, strict=True))
            keep = exact <= best[q] + 1e-5
            yield pa.RecordBatch.from_arrays([pa.array(asked[q[keep]]), pa.array(b[keep]), pa.array(exact[keep])], names=["q", "b", "dist"])

    return nearest
