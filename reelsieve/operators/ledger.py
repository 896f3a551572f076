"""Passes over samples with a ledger: a failing sample is a row with its error, and what is done is not done again.

The ledger is the pass's own output, so that no result is there without its entry and no entry without its result: each part of
the work is appended as a whole, by Spark's committer, or not at all. A run that is stopped leaves whole parts; the next one
takes what has no entry yet, and both together hold what one run would have.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from ..functions.columns import trimmed


def attempted(df: DataFrame, key: str, work: Callable[[dict], object], returns: str) -> DataFrame:
    """key, ok, result, error: work's value for each row, or the error that it raised; a row's failure ends neither its task nor the others.

    work gets a row as a dict. An error reads `Type: message`. returns: the type of a result.
    """
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, ok boolean, result {returns}, error string"
    kinds = [to_arrow_type(f.dataType) for f in _parse_datatype_string(schema)]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                try:
                    out.append((row[key], True, work(row), None))
                except Exception as e:  # noqa: BLE001  whatever a sample raises is its own result
                    out.append((row[key], False, None, f"{type(e).__name__}: {e}"))
            columns = zip(*out, strict=True) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[key, "ok", "result", "error"])

    return df.mapInArrow(each, schema)


def entries(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of a ledger, none where it isn't there yet."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def latest(rows: DataFrame, key: str) -> DataFrame:
    """One entry for each key: a success if there is one, else the last failure."""
    order = [F.col("ok").desc(), F.col("run").desc()]
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__n = 1").drop("__n")


def run(df: DataFrame, key: str, work: Callable[[dict], object], returns: str, path: str, number: int, parts: int = 8, retry: bool = False, stop_after: int | None = None) -> DataFrame:
    """The entries of all keys after this run: run, key, ok, result, error (one row a key).

    Rows whose key has an entry are left out; with retry only those with a success are. The rest goes through work in `parts`
    (by a hash of the key), each appended to the ledger at path. number: of the run. stop_after: parts after which the run ends.
    """
    spark = df.sparkSession
    schema = f"run int, `{key}` {df.schema[key].dataType.simpleString()}, ok boolean, result {returns}, error string"
    for part in range(parts)[:stop_after]:
        done = entries(spark, path, schema)
        # The entries are read before the part is written: what it appends isn't seen again.
        left = df.where(F.pmod(F.xxhash64(key), F.lit(parts)) == part).join((done.where("ok") if retry else done).select(key).distinct(), key, "left_anti").select(df.columns)
        attempted(left, key, work, returns).select(F.lit(number).cast("int").alias("run"), key, "ok", "result", "error").write.mode("append").parquet(path)
    return latest(entries(spark, path, schema), key)


def worker_lines(spark: SparkSession, path: str, schema: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows, malformed): the JSON lines of all workers' files below path, one row a key, and lines that aren't records of the schema.

    Rows have a column worker, the folder of their file. Of a key that several lines have the first worker's counts, and of
    its lines the one that sorts last; a line without a key is malformed, an empty one nothing.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").text(path)
    worker = F.element_at(F.split(F.input_file_name(), "/"), -2)
    read = lines.select(worker.alias("worker"), F.col("value").alias("line"), F.from_json("value", schema).alias("r")).where(trimmed(F.col("value")) != "")
    good: Column = F.col(f"r.{key}").isNotNull()
    order = Window.partitionBy(f"r.{key}").orderBy("worker", F.desc("line"))
    rows = read.where(good).withColumn("__n", F.row_number().over(order)).where("__n = 1").select("worker", "r.*")
    return rows, read.where(~good).select("worker", "line")


def counts(rows: DataFrame, by: str) -> DataFrame:
    """Per `by`: n_ok, n_fail, share (of rows that are through well) and the first error in order."""
    ok = F.col("ok")
    g = rows.groupBy(by).agg(F.count_if(ok).alias("n_ok"), F.count_if(~ok).alias("n_fail"), F.min(F.when(~ok, F.col("error"))).alias("first_error"))
    return g.withColumn("share", F.round(F.col("n_ok") / (F.col("n_ok") + F.col("n_fail")), 4))
