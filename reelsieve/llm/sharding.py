"""Shards by extendible hashing: a directory over hash prefixes in which only buckets over the byte limit are split.

Sizes are first added up by a prefix somewhat longer than an even spread needs, so the directory works on few rows. From
these leaves the sizes of all shorter prefixes follow; a bucket is the shortest prefix that fits. Leaves that are still
too large go through the same step again with more bits, until the hash is used up.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

HASH_BITS = 60
LIMIT_BYTES = 16 << 20
_SPARE, _MORE = 4, 12
#: The columns that assign() adds.
ADDED = ("n_bytes", "shard", "shard_bytes", "shard_docs")


def _hash(id_col: Column, text: Column) -> Column:
    """60 bits of the MD5 of doc_id:text."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), text)), 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(h: Column, bits: int) -> Column:
    return F.shiftrightunsigned(h, HASH_BITS - bits)


def _directory(leaves: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """leaf, depth, bits, shard_bytes, shard_docs: each leaf's bucket; leaves that don't fit at any depth are absent.

    leaves: leaf (prefix of `high` bits), bytes, docs. Depths tried: low to high.
    """
    levels = F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")
    paths = leaves.select("leaf", "bytes", "docs", levels).withColumn("bits", F.expr(f"shiftrightunsigned(leaf, {high} - depth)"))
    fits = paths.groupBy("depth", "bits").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs")).where(F.col("shard_bytes") <= limit)
    return paths.select("leaf", "depth", "bits").join(fits, ["depth", "bits"]).groupBy("leaf").agg(F.min_by(F.struct("depth", "bits", "shard_bytes", "shard_docs"), "depth").alias("b")).select("leaf", "b.*")


def _copies(base: DataFrame) -> DataFrame:
    """base with __h by copy: of rows that agree in doc_id and text the first keeps its hash, the others get hashes of their own.

    Such rows are numbered by part of the table first and the parts are then put one after the other, so the row that
    holds a third of the table is numbered by all tasks; a table without repeated rows is only counted.
    """
    again = materialize(base.groupBy("__h").agg(F.count("*").alias("n")).where("n > 1").select("__h"), "repeated")
    if again.isEmpty():
        return base
    part = Window.partitionBy("__h", "__part").orderBy("__n")
    rows = materialize(base.join(again, "__h").withColumn("__part", F.spark_partition_id()).withColumn("__nr", F.row_number().over(part)), "numbered")
    parts = rows.groupBy("__h", "__part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("__h").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = materialize(parts.select("__h", "__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")), "parts")
    number = F.col("__nr") + F.col("__before") - 1
    own = F.conv(F.substring(F.md5(F.concat_ws(":", F.col("__h").cast("string"), number.cast("string"))), 1, HASH_BITS // 4), 16, 10).cast("long")
    rows = rows.join(parts, ["__h", "__part"]).withColumn("__h", F.when(number == 0, F.col("__h")).otherwise(own))
    return base.join(again, "__h", "left_anti").unionByName(rows.select(*base.columns))


def assign(df: DataFrame, limit_bytes: int = LIMIT_BYTES, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """doc_id, n_bytes, shard, shard_bytes, shard_docs for every row (keep: and df's own columns instead of doc_id).

    shard is the bucket's bits (empty: the only bucket). A text over the limit is a shard of its own, marked `!` and its
    hash. Rows that agree in doc_id and text are copies: each has a hash of its own, so that copies lie apart. Null texts
    count as empty, a null doc_id is hashed as empty; an empty table gives an empty result. Bytes are those of the UTF-8
    text. With keep, a column of df that is named like an added one comes back with `_` after its name (`shard_`).
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    own = df.columns if keep else []
    names = list(own)
    for i, name in enumerate(own):
        while names[i].lower() in ADDED or (names[i] != name and names[i].lower() in (x.lower() for x in own)):
            names[i] += "_"
    # df's columns stay together in __row, so that none of them can clash with a step's.
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)]) if keep else F.col(f"`{id_col}`").cast("long")
    base = _copies(df.select(row.alias("__row"), F.octet_length(text).cast("long").alias("__n"), _hash(F.col(f"`{id_col}`"), text).alias("__h")))
    sizes = materialize(base.select("__n", "__h"), "sizes")
    total = sizes.agg(F.sum("__n")).first()[0] or 0

    def named(rows: DataFrame, shard: Column, size: Column, docs: Column) -> DataFrame:
        shown = [F.col(f"__row.c{i}").alias(c) for i, c in enumerate(names)] if keep else [F.col("__row").alias("doc_id")]
        return rows.select(*shown, F.col("__n").alias("n_bytes"), shard.alias("shard"), size.alias("shard_bytes"), docs.alias("shard_docs"))

    giant = F.col("__n") > limit_bytes
    out = [named(base.where(giant), F.concat(F.lit("!"), F.lpad(F.hex("__h"), HASH_BITS // 4, "0")), F.col("__n"), F.lit(1).cast("long"))]
    low, high = 0, min(HASH_BITS, max(0, math.ceil(math.log2(max(1, total / limit_bytes)))) + _SPARE)
    rows, left = base.where(~giant), sizes.where(~giant)
    while True:
        leaves = left.groupBy(_prefix(F.col("__h"), high).alias("leaf")).agg(F.sum("__n").alias("bytes"), F.count("*").alias("docs"))
        known = materialize(_directory(leaves, low, high, limit_bytes), "directory")
        bits = F.when(F.col("depth") == 0, "").otherwise(F.expr("lpad(bin(bits), depth, '0')"))
        at = _prefix(F.col("__h"), high)
        out.append(named(rows.withColumn("leaf", at).join(known, "leaf"), bits, F.col("shard_bytes"), F.col("shard_docs")))
        over = materialize(leaves.where(F.col("bytes") > limit_bytes).select("leaf"), "over")
        if over.isEmpty():
            break
        if high == HASH_BITS:
            raise ValueError("different rows over the limit agree in all bits of their hash")
        rows = rows.withColumn("leaf", at).join(over, "leaf", "left_semi").drop("leaf")
        left = left.withColumn("leaf", at).join(over, "leaf", "left_semi").drop("leaf")
        low, high = high + 1, min(HASH_BITS, high + _MORE)
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def write(df: DataFrame, path: str, limit_bytes: int = LIMIT_BYTES, **names: str) -> None:
    """Write df in one folder per shard; a shard's rows go through one task, which the byte limit bounds.

    Folders are named `shard=b` and the bits, so that readers don't take bits for numbers.
    """
    rows = assign(df, limit_bytes, keep=True, **names).withColumn("shard", F.concat(F.lit("b"), F.col("shard")))
    rows.drop("n_bytes", "shard_bytes", "shard_docs").repartition("shard").write.partitionBy("shard").parquet(path)


def sql(limit_bytes: int = LIMIT_BYTES) -> str:
    """DuckDB SQL for assign() over documents (without repeated rows)."""
    return f"""
    WITH d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n,
                      CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, {HASH_BITS // 4}) AS BIGINT) AS h FROM documents),
    p AS (SELECT doc_id, n, h, depth, h >> ({HASH_BITS} - depth) AS bits FROM d, (SELECT unnest(generate_series(0, {HASH_BITS})) AS depth) WHERE n <= {limit_bytes}),
    s AS (SELECT depth, bits, sum(n)::BIGINT AS shard_bytes, count(*) AS shard_docs FROM p GROUP BY ALL HAVING sum(n) <= {limit_bytes})
    SELECT doc_id, n::BIGINT AS n_bytes, CASE WHEN depth = 0 THEN '' ELSE right(lpad(bin(bits), 64, '0'), depth) END AS shard, shard_bytes, shard_docs
    FROM p JOIN s USING (depth, bits) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
    UNION ALL SELECT doc_id, n, '!' || upper(lpad(hex(h), 15, '0')), n, 1 FROM d WHERE n > {limit_bytes}"""
