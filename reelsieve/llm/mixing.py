"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents are dealt by hash to blocks. How many words a source gives follows from the weights: whole passes
over all of its blocks, and a part of one more pass that takes blocks in a hashed order until the target is met; only the
block in which it is met is taken document by document. The number of blocks to be drawn is the source's quota. The
quotas are divided among the output shards: at each node of a binary tree the left half's share of every source's quota
is drawn from the multivariate hypergeometric distribution, so every shard is a random sample of the mix and the quotas
add up exactly. A source's draws, in permuted order, fill its shards' quotas one after the other and end with the last
of them, so draws are disjoint and what a document gives is what the shards' quotas take of it; within a shard rows are
ordered by hash.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, word_count

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
BLOCK_DOCS = 64
#: Bounds what the driver holds: a row for each source, and a quota for each source and shard.
MAX_SOURCES, MAX_QUOTAS = 100_000, 4_000_000
SEED = 17
_H = 15  # hex digits of the hashes
#: Upper bits of a hash that cut a source's running sums into ranges.
RANGE_BITS = 12


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Words that each source gives: share * all sizes by weight, stopped at most * size, the excess reshared by weight.

    Sources reach their stop in the order of stop / weight; what is left over is divided among the others, so the level
    at which no further source stops is the end of all resharing.
    """
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    stops = [most * s for s in sizes]
    left, open_weight = share * sum(sizes), float(sum(weight))
    out = [0.0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: (stops[i] / weight[i], i))
    for n, i in enumerate(order):
        level = left / open_weight
        if stops[i] / weight[i] > level:
            for j in order[n:]:
                out[j] = level * weight[j]
            break
        out[i] = stops[i]
        left -= stops[i]
        open_weight -= weight[i]
    return out


def split_quotas(blocks: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """quotas[source, shard]: blocks of each source in each shard, drawn down a binary tree over the shards."""
    out = np.zeros((len(blocks), shards), dtype=np.int64)

    def split(counts: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            out[:, low] = counts
            return
        middle = (low + high) // 2
        n = int(counts.sum())
        take = n * (middle - low) // (high - low)
        rng = np.random.default_rng([seed, low, high])
        left = rng.multivariate_hypergeometric(counts, take, method="marginals") if n else counts
        split(left, low, middle)
        split(counts - left, middle, high)

    if len(blocks):
        split(np.array(blocks, dtype=np.int64), 0, shards)
    return out


def _hash(*parts) -> Column:
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, _H), 16, 10).cast("long")


def _running(rows: DataFrame, by: str, order: list[str], value: Column, out: str) -> DataFrame:
    """rows with `out`: the sum of value over src's rows up to this one, in the order of the 60-bit hash `by`, then `order`.

    Two steps, so that no task holds a whole source: sums by the hash's upper bits give each range's start, and only
    within a range are rows put in order.
    """
    rows = rows.withColumn("__range", F.shiftrightunsigned(by, 4 * _H - RANGE_BITS)).withColumn("__value", value)
    ranges = rows.groupBy("src", "__range").agg(F.sum("__value").alias("__sum"))
    before = Window.partitionBy("src").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    # At most 2 ** RANGE_BITS rows for each source.
    ranges = ranges.select("src", "__range", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("src", "__range").orderBy(by, *order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("__sum", F.sum("__value").over(inside)).join(ranges, ["src", "__range"]).withColumn(out, F.col("__sum") + F.col("__start")).drop("__range", "__value", "__sum", "__start")


def _sources(spark: SparkSession, slim: DataFrame, shards: int, weights: tuple[int, ...], share: float, most: float) -> list[tuple]:
    """(src, words, target, blocks, whole passes, words of the last pass) by source, in order."""
    totals = slim.groupBy("src").agg(F.sum("size").alias("size"), F.count("*").alias("docs")).orderBy("src").limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES or len(totals) * shards > MAX_QUOTAS:
        raise ValueError(f"more than {MAX_SOURCES} sources, or than {MAX_QUOTAS} quotas of sources and shards")
    rows = []
    for r, t in zip(totals, targets([r["size"] for r in totals], weights, share, most), strict=True):
        passes = min(int(t // r["size"]), math.ceil(most)) if r["size"] else 0
        rows.append((r["src"], int(r["size"]), t, max(1, -(-r["docs"] // BLOCK_DOCS)), passes, t - passes * r["size"]))
    return rows


def plan(df: DataFrame, shards: int = 16, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", keep: bool = False) -> DataFrame:
    """doc_id, size, source_size, target, copies, shards (array: the shard of each copy), quotas (array: blocks that its source gives each shard), h for every row; keep: df's own columns too.

    Sources are ordered by code point, null last. A row's copies are 0, 1 or 2. Rows that agree in source, doc_id and
    size stand for each other; null texts have size 0, and a source without words has target 0 and gives nothing. An
    empty table gives an empty result. Names of df's columns don't matter: with keep they come back in `row`.
    """
    spark = df.sparkSession
    source = F.when(F.col(source_col).isNull(), "z").otherwise(F.concat(F.lit("s"), F.col(source_col).cast("string")))
    full = df.select(F.col(id_col).cast("long").alias("doc_id"), source.alias("src"), word_count(F.col(text_col).cast("string")).alias("size"), *([F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if keep else []))
    full = full.withColumn("h", _hash(F.lit(seed), F.col("doc_id")))
    # Words are counted and ids hashed once; what follows works on these narrow rows.
    slim = materialize(full.select("doc_id", "src", "size", "h"), "sizes")
    rows = _sources(spark, slim, shards, weights, share, most)
    sources = spark.createDataFrame(rows, "src string, source_size long, target double, blocks long, passes int, part double")
    # One row for each source, at most MAX_SOURCES: small enough to broadcast.
    known = F.broadcast(sources)
    block = F.pmod(F.expr("h div 65536"), F.col("blocks"))
    blocks = slim.join(known, "src").groupBy("src", block.alias("block")).agg(F.sum("size").alias("words"), F.first("passes").alias("passes"), F.first("part").alias("part"))
    blocks = materialize(blocks.withColumn("bh", _hash(F.lit(seed), F.col("src"), F.col("block"))), "blocks")
    begin = F.col("end") - F.col("words")
    state = F.when(F.col("end") <= F.col("part"), 1).when(begin < F.col("part"), 2).otherwise(0)
    blocks = materialize(_running(blocks, "bh", ["block"], F.col("words"), "end").select("src", "block", "passes", (F.col("part") - begin).alias("rest"), state.alias("state")), "ordered")

    # The tree: quotas of sources and shards. A draw's place in its source's permutation tells whose quota it fills.
    last_turn = F.col("passes") + F.when(F.col("state") > 0, 1).otherwise(0)
    drawn = {r["src"]: r["n"] for r in blocks.groupBy("src").agg(F.sum(last_turn).alias("n")).collect()}
    split = split_quotas([int(drawn.get(r[0], 0)) for r in rows], shards, seed)
    quotas = spark.createDataFrame([(r[0], q.tolist(), e.tolist()) for r, q, e in zip(rows, split, np.cumsum(split, axis=1), strict=True)], "src string, quotas array<long>, ends array<long>")
    quotas = F.broadcast(quotas)
    draws = blocks.where("passes > 0 OR state > 0").select("src", "block", F.explode(F.sequence(F.lit(1), last_turn)).alias("turn"), "passes").withColumn("dh", _hash(F.lit(seed + 1), F.col("src"), F.col("block"), F.col("turn")))
    draws = _running(materialize(draws, "draws"), "dh", ["block", "turn"], F.lit(1), "place").join(quotas, "src")
    shard = F.size(F.filter("ends", lambda e: e < F.col("place")))
    draws = draws.where(F.col("place") <= F.element_at("ends", -1)).select("src", "block", F.struct((F.col("turn") > F.col("passes")).alias("last"), shard.alias("shard")).alias("draw"))
    # At most three draws of a block.
    dealt = draws.groupBy("src", "block").agg(F.array_sort(F.collect_list("draw")).alias("draws"))
    chosen = materialize(blocks.select("src", "block", "state", "rest").join(dealt, ["src", "block"], "left"), "chosen")

    # The one block of a source in which its part ends: documents in hashed order as long as they fit, then the one that
    # comes nearest to what is still missing. Rows that stand for each other are one group here.
    placed = slim.join(known.select("src", "blocks"), "src").withColumn("block", block)
    edge = placed.join(F.broadcast(chosen.where("state = 2").select("src", "block", "rest")), ["src", "block"]).groupBy("src", "doc_id", "size").agg(F.count("*").alias("n"), F.first("rest").alias("rest"))
    inside = Window.partitionBy("src").orderBy(_hash(F.lit(seed + 2), F.col("doc_id")), "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    room = F.col("rest") - F.sum(F.col("n") * F.col("size")).over(inside) + F.col("n") * F.col("size")
    edge = edge.withColumn("m", F.when(F.col("size") == 0, F.col("n")).otherwise(F.greatest(F.lit(0), F.least(F.col("n"), F.floor(room / F.col("size"))))))
    edge = edge.withColumn("gap", F.col("rest") - F.sum(F.col("m") * F.col("size")).over(Window.partitionBy("src")))
    open_ones = F.col("m") == F.col("n")
    nearest = F.row_number().over(Window.partitionBy("src").orderBy(open_ones, F.abs(F.col("size") - F.col("gap")), "doc_id"))
    more = ~open_ones & (nearest == 1) & (F.abs(F.col("size") - F.col("gap")) < F.col("gap"))
    edge = materialize(edge.select(F.col("src").alias("e_src"), F.col("doc_id").alias("e_id"), F.col("size").alias("e_size"), "n", (F.col("m") + more.cast("int")).alias("m")), "edges")

    every = F.coalesce(F.transform("draws", lambda x: x["shard"]), F.array().cast("array<int>"))
    some = F.coalesce(F.transform(F.filter("draws", lambda x: ~x["last"]), lambda x: x["shard"]), F.array().cast("array<int>"))
    at = (full if keep else slim).join(known.select("src", "source_size", "target", "blocks"), "src").join(quotas.select("src", "quotas"), "src").withColumn("block", block).drop("blocks").join(chosen, ["src", "block"])
    # About BLOCK_DOCS rows for each source.
    at = at.join(edge, (F.col("state") == 2) & (F.col("src") == F.col("e_src")) & F.col("doc_id").eqNullSafe(F.col("e_id")) & (F.col("size") == F.col("e_size")), "left")
    out = at.where("m IS NULL OR m = 0 OR m = n").withColumn("shards", F.when((F.col("state") == 2) & (F.col("m") == 0), some).otherwise(every))
    if not edge.where("m > 0 AND m < n").isEmpty():
        # Rows that stand for each other, of which only some are taken.
        rank = F.row_number().over(Window.partitionBy("src", "doc_id", "size").orderBy("h"))
        out = out.unionByName(at.where("m > 0 AND m < n").withColumn("shards", F.when(rank <= F.col("m"), every).otherwise(some)))
    return out.select("doc_id", "size", "source_size", "target", F.size("shards").alias("copies"), "shards", "quotas", "h", *(["row"] if keep else []))


def report(df: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted), shards (of its copies) and source_quotas (blocks that its source gives each shard), comma-joined, for every row of df."""
    return plan(df, **options).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), F.array_join(F.col("shards").cast("array<string>"), ",").alias("shards"), F.array_join(F.col("quotas").cast("array<string>"), ",").alias("source_quotas"))


def mixed(df: DataFrame, **options) -> DataFrame:
    """df's columns once for each copy taken (struct `row`), with shard and place; a shard is to be read in the order of place."""
    rows = plan(df, keep=True, **options).select("row", "h", F.posexplode("shards").alias("copy", "shard"))
    return rows.select("row", "shard", _hash(F.col("h"), F.col("copy"), F.col("shard")).alias("place"))


def in_order(df: DataFrame, pieces: int = 64, **options) -> DataFrame:
    """df's columns once for each copy taken; written, each file holds its shards one after the other, shuffled by place.

    A shard's rows are dealt to `pieces` parts by place, so a shard of any size is spread over tasks.
    """
    rows = mixed(df, **options)
    return rows.repartition("shard", F.col("place") % pieces).sortWithinPartitions("shard", "place").select("row.*")


def write(df: DataFrame, path: str, pieces: int = 64, **options) -> None:
    """Write the mix, one folder per shard, shuffled within each file by a sort on place."""
    rows = mixed(df, **options).select("row.*", F.col("shard").alias("mix_shard"), F.col("place").alias("mix_place"))
    rows.repartition("mix_shard", F.col("mix_place") % pieces).sortWithinPartitions("mix_shard", "mix_place").drop("mix_place").write.partitionBy("mix_shard").parquet(path)


def sql(seed: int = SEED) -> str:
    """DuckDB SQL for report() over documents, without the columns that the tree draws (shards, source_quotas)."""
    hx = lambda *parts: f"CAST('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, {_H}) AS BIGINT)"
    return f"""
    WITH d AS (SELECT doc_id, CASE WHEN source IS NULL THEN 'z' ELSE 's' || source END AS src, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
                      {hx(f"'{seed}'", 'doc_id')} AS h FROM documents),
    t AS (SELECT src, sum(size)::BIGINT AS source_size, count(*) AS docs FROM d GROUP BY src),
    w AS (SELECT *, CASE (row_number() OVER (ORDER BY src) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, row_number() OVER (ORDER BY src) AS nr FROM t),
    o AS (SELECT *, 2.0::DOUBLE * source_size / weight AS stop FROM w),
    v AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY stop, nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
                 sum(weight) OVER (ORDER BY stop, nr ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight FROM o),
    l AS (SELECT arg_min(rest / open_weight, (stop, nr)) AS level FROM v WHERE stop > rest / open_weight),
    s AS (SELECT src, source_size, docs, CASE WHEN level IS NULL OR stop <= level THEN 2.0::DOUBLE * source_size ELSE level * weight END AS target FROM o, l),
    p AS (SELECT *, greatest(1, (docs + {BLOCK_DOCS - 1}) // {BLOCK_DOCS}) AS blocks, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes FROM s),
    q AS (SELECT d.*, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size AS part, (d.h // 65536) % p.blocks AS block FROM d JOIN p USING (src)),
    b AS (SELECT src, block, any_value(part) AS part, sum(size) AS words FROM q GROUP BY src, block),
    c AS (SELECT src, block, part, words, sum(words) OVER (PARTITION BY src ORDER BY {hx(f"'{seed}'", 'src', 'block')}, block ROWS UNBOUNDED PRECEDING) AS last FROM b),
    e AS (SELECT src, block, CASE WHEN last <= part THEN 1 WHEN last - words < part THEN 2 ELSE 0 END AS state, part - (last - words) AS rest FROM c),
    f AS (SELECT q.*, state, rest, sum(size) OVER (PARTITION BY q.src, state ORDER BY {hx(f"'{seed + 2}'", 'doc_id')}, doc_id ROWS UNBOUNDED PRECEDING) <= rest AS fits FROM q JOIN e ON q.src = e.src AND q.block = e.block),
    g AS (SELECT *, rest - sum(CASE WHEN fits THEN size ELSE 0 END) OVER (PARTITION BY src, state) AS gap FROM f),
    n AS (SELECT *, row_number() OVER (PARTITION BY src, state ORDER BY fits, abs(size - gap), doc_id) AS nearest FROM g)
    SELECT doc_id, size, source_size, target, (size * (passes + CASE WHEN state = 1 OR state = 2 AND (fits OR nearest = 1 AND abs(size - gap) < gap) THEN 1 ELSE 0 END))::BIGINT AS taken FROM n"""
