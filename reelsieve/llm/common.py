"""Shared helpers of the training-data operators: table access, materialised steps, batch iteration over Arrow texts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word pattern [^\x20\x09-\x0D]+; bytes.split() cuts at exactly these.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one of the application in local mode where it is unset."""
    got = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if got:
        return got
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    # A running session doesn't take the setting any more.
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="reelsieve-")
    return _LOCAL_DIRS[app]


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Write a step as Parquet to the shared folder and read it back: lineage ends there, so a lost executor costs no earlier step."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._shared_path = path
    return back


def discard(df: DataFrame) -> None:
    """Delete the files of a materialised step that no later plan reads."""
    if path := getattr(df, "_shared_path", None):
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def texts(column: pa.Array, piece: int = 256) -> Iterator[list[str]]:
    """The column's strings in small lists, nulls as empty strings, so that only a few texts are Python objects at a time."""
    for at in range(0, len(column), piece):
        yield [x or "" for x in column.slice(at, piece).to_pylist()]


def hex64(fingerprint: Column) -> Column:
    """16 lower-case hex digits of a 64-bit integer."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def word_count(text: Column) -> Column:
    """Words of WORD_PATTERN, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def sliced(df: DataFrame, key: str, most: int) -> tuple[DataFrame, int]:
    """df with a column slice from 0, and the number of slices: a key's rows stay together, a slice of several keys has at most `most` rows.

    df has to be written already: it is counted once for each number of slices that is tried, doubled each time.
    """
    n = max(1, -(-df.count() // most))
    while True:
        out = df.withColumn("slice", F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(n)).cast("int"))
        rows = out.groupBy("slice").agg(F.count("*").alias("rows"), F.min(key).alias("low"), F.max(key).alias("high"))
        if rows.where((F.col("rows") > most) & (F.col("low") != F.col("high"))).isEmpty():
            return out, n
        n *= 2


def apart(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many `_` behind it as it takes to be none of df's columns."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out
