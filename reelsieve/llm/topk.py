"""Exact top-k inner products by three-phase uniform threshold over score lists.

Equal vectors are one class with its few smallest ids, so that a vector in a third of all rows is scored once. The components of
the classes are dealt to LISTS tables; each gives, for a query, a list of partial scores, the sum of which is the score.
1. Each list gives its k best classes for each query; what is gathered is scored in full from the other lists. The kth best of
   these scores is a safe cutoff: nothing below it is in the result.
2. The cutoff is broadcast. A class that reaches it has in one list at least a LISTS-th of it, so each list gives its entries of
   at least that, if the norms of the other parts (Cauchy-Schwarz) let the sum reach the cutoff.
3. What is missing of these scores is taken from the other lists, exactly, and the best k are ranked.
Queries go through in slices of bounded size, of which the vectors and cutoffs are broadcast; classes are never collected.

Cases: a null vector, or one with a null, NaN or infinite component, takes no part; a shorter vector counts as filled up with
zeros, an empty one as zeros; a repeated row is a row of its own, and a query leaves out its own row only; equal scores go by
vec_id, null last, and rows with a null vec_id are no queries; vectors whose scores would not fit 64 bits are an error; other
columns aren't looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, sliced

BEST = 5
#: Rows whose id it divides are queries.
EVERY = 50
#: A component is floor(SCALE * x).
SCALE = 256
#: Tables that the components are dealt to.
LISTS = 2
#: Bytes of the query vectors that are broadcast at once.
SLICE_BYTES = 4 << 20
#: Partial scores that a task holds at once.
_HELD = 1 << 22

_ENTRY = "query long, class long, score long"
_KINDS = (("query", pa.int64()), ("class", pa.int64()), ("score", pa.int64()))


def quantised(x: Column) -> Column:
    """floor(SCALE * component) as an array of longs; null if the vector takes no part."""
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    return F.when(good, F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double"))))


def _classes(vectors: DataFrame, keep: int) -> DataFrame:
    """class, q (its components), ids (struct of null_id, vec_id: the `keep` smallest of its rows) of each distinct vector; rows: vec_id, q."""
    row = F.struct(F.col("vec_id").isNull().alias("null_id"), "vec_id")
    place = F.row_number().over(Window.partitionBy("q").orderBy(row))
    few = vectors.select("q", row.alias("row"), place.alias("place")).where(F.col("place") <= keep)
    return few.groupBy("q").agg(F.array_sort(F.collect_list("row")).alias("ids")).select(F.monotonically_increasing_id().alias("class"), "q", "ids")


def _norm(q: Column) -> Column:
    return F.sqrt(F.aggregate(q, F.lit(0.0), lambda a, c: a + c.cast("double") * c))


def _lists(classes: DataFrame, width: int, lists: int) -> list[DataFrame]:
    """A table (class, part, rest) for each list: rest is the norm of the components that are in other lists."""
    each = -(-width // lists)
    return [
        materialize(classes.select("class", F.slice("q", j * each + 1, each).alias("part"), _norm(F.concat(F.slice("q", 1, j * each), F.slice("q", (j + 1) * each + 1, width))).alias("rest")), f"list-{j}")
        for j in range(lists)
    ]


class _Queries:
    """The vectors of a slice of queries, sorted by class; sent to the tasks with their cutoffs."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lists: int):
        self.ids, self.each, self.cutoff = ids, -(-vectors.shape[1] // lists), None
        self.parts = [vectors[:, j * self.each : (j + 1) * self.each] for j in range(lists)]
        squares = [(p.astype(float) ** 2).sum(axis=1) for p in self.parts]
        self.rest = [np.sqrt(sum(squares) - s) for s in squares]


def _matrix(column: pa.Array, width: int, kind: np.dtype) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), kind)
    out[np.repeat(np.arange(len(column)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _batch(query: np.ndarray, cls: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64), t) for x, (_, t) in zip((query, cls, score), _KINDS, strict=True)], names=[k for k, _ in _KINDS])


def _partial(batches: Iterator[pa.RecordBatch], asked: _Queries, j: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(classes, norms of the rest, partial scores by query and class) of runs of classes."""
    part = asked.parts[j]
    run = max(1, _HELD // max(1, len(part)))
    for batch in batches:
        cls, rest = batch.column("class").to_numpy(zero_copy_only=False), batch.column("rest").to_numpy(zero_copy_only=False)
        rows = _matrix(batch.column("part"), part.shape[1], part.dtype)
        for at in range(0, len(cls), run):
            yield cls[at : at + run], rest[at : at + run], part @ rows[at : at + run].T


def _best(table: DataFrame, sent: Broadcast, j: int, k: int) -> DataFrame:
    """Phase 1: the k best entries of each query in each task's share of list j."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        top = np.zeros((len(asked.ids), 0), asked.parts[j].dtype)
        own = np.zeros((len(asked.ids), 0), np.int64)
        for cls, _, scores in _partial(batches, asked, j):
            if scores.shape[1] > k:
                at = np.argpartition(-scores, k - 1, axis=1)[:, :k]
                scores, cls = np.take_along_axis(scores, at, axis=1), cls[at]
            else:
                cls = np.broadcast_to(cls, scores.shape)
            top, own = np.concatenate((top, scores), axis=1), np.concatenate((own, cls), axis=1)
            at = np.argsort(-top, axis=1, kind="stable")[:, :k]
            top, own = np.take_along_axis(top, at, axis=1), np.take_along_axis(own, at, axis=1)
        yield _batch(np.repeat(asked.ids, top.shape[1]), own.ravel(), top.ravel())

    order = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    return table.mapInArrow(best, _ENTRY).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).select("query", "class", "score", F.lit(1 << j).alias("bit"))


def _sufficient(table: DataFrame, sent: Broadcast, j: int, lists: int) -> DataFrame:
    """Phase 2: entries of list j of at least a lists-th of the cutoff whose sum can reach it."""

    def sufficient(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        cutoff = asked.cutoff[:, None]
        for cls, rest, scores in _partial(batches, asked, j):
            # Norms are rounded: what they rule out is out by more than that.
            reach = scores + asked.rest[j][:, None] * rest[None, :] * (1 + 1e-9) + 1
            q, c = np.nonzero((scores * lists >= cutoff) & (reach >= cutoff))
            yield _batch(asked.ids[q], cls[c], scores[q, c])

    return table.mapInArrow(sufficient, _ENTRY).withColumn("bit", F.lit(1 << j))


def _resolved(entries: DataFrame, tables: list[DataFrame], sent: Broadcast) -> DataFrame:
    """query, class, score: entries (query, class, score, bit of the list) with the partial scores that they lack, summed."""
    known = materialize(entries.groupBy("query", "class").agg(F.sum("score").alias("score"), F.bit_or("bit").alias("have")), "entries")
    out = known.select("query", "class", "score")
    for j, table in enumerate(tables):

        def missing(batches: Iterator[pa.RecordBatch], j: int = j) -> Iterator[pa.RecordBatch]:
            asked = sent.value
            for batch in batches:
                query = batch.column("query").to_numpy(zero_copy_only=False)
                part = asked.parts[j]
                rows = _matrix(batch.column("part"), part.shape[1], part.dtype)
                yield _batch(query, batch.column("class").to_numpy(zero_copy_only=False), (part[np.searchsorted(asked.ids, query)] * rows).sum(axis=1))

        lacking = known.where(F.col("have").bitwiseAND(F.lit(1 << j)) == 0).select("query", "class")
        out = out.unionByName(lacking.join(table.select("class", "part"), "class").mapInArrow(missing, _ENTRY))
    return out.groupBy("query", "class").agg(F.sum("score").alias("score"))


def _slice(classes: DataFrame, asked: _Queries, tables: list[DataFrame], k: int) -> DataFrame:
    """query, class, score: the k best classes for each query of the slice, by score and smallest id, among them."""
    sc = classes.sparkSession.sparkContext
    sent = sc.broadcast(asked)
    found = None
    for j, table in enumerate(tables):
        best = _best(table, sent, j, k)
        found = best if found is None else found.unionByName(best)
    gathered = _resolved(found, tables, sent)
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    # The kth of the gathered scores; a query with fewer classes than that takes all of them.
    kth = gathered.select("query", "score", place.alias("place")).where(F.col("place") == k).select("query", "score").toArrow()
    asked.cutoff = np.full(len(asked.ids), np.iinfo(np.int64).min if asked.parts[0].dtype == np.int64 else -np.inf, asked.parts[0].dtype)
    asked.cutoff[np.searchsorted(asked.ids, kth["query"].to_numpy())] = kth["score"].to_numpy()
    sent.unpersist()
    sent = sc.broadcast(asked)
    found = None
    for j, table in enumerate(tables):
        enough = _sufficient(table, sent, j, len(tables))
        found = enough if found is None else found.unionByName(enough)
    exact = _resolved(found, tables, sent).join(classes.select("class", F.col("ids")[0].alias("least")), "class")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "least")
    best = materialize(exact.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).select("query", "class", "score"), "best-classes")
    sent.unpersist()
    return best


def search(vectors: DataFrame, k: int = BEST, every: int = EVERY, lists: int = LISTS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Columns query_id, rank (int, from 1), vec_id, score (long): the k rows of highest inner product for each row whose vec_id `every` divides.

    vectors: vec_id (long), embedding (array of numbers). A query's own row is not among its results.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding")).alias("q")).where("q IS NOT NULL")
    # One row more than k for the query's own. The k + 1 best rows lie in the k + 1 best classes.
    keep = k + 1
    classes = materialize(_classes(rows, keep), "vectors")
    queries = materialize(rows.where(F.col("vec_id") % every == 0).join(classes.select("class", "q"), "q").select("vec_id", "class"), "queries")
    size = classes.agg(F.max(F.size("q")).alias("width"), F.max(F.array_max(F.transform("q", F.abs))).alias("most"), F.min(F.array_min("q")).alias("least")).first()
    width = max(size.width or 0, 1)
    most = max(size.most or 0, -(size.least or 0))
    if width * most * most >= 2**63 // (lists + 1):
        raise ValueError(f"scores of {width} components up to {most} do not fit 64 bits")
    # Sums of products below 2^53 are exact as doubles, and much faster.
    kind = np.float64 if width * most * most < 2**53 // (lists + 1) else np.int64
    tables = _lists(classes, width, lists)
    asked = materialize(classes.join(queries.select("class").distinct(), "class", "left_semi").select("class", "q"), "asked")
    parts, n = sliced(asked, "class", max(1, slice_bytes // (8 * width)))
    found = None
    for number in range(n):
        got = parts.where(F.col("slice") == number).orderBy("class").select("class", "q").toArrow().combine_chunks()
        if got.num_rows:
            matrix = _matrix(got["q"].combine_chunks(), width, kind)
            best = _slice(classes, _Queries(got["class"].to_numpy(), matrix, lists), tables, keep)
            found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for step in (asked, *tables):
        discard(step)
    row = F.struct((-F.col("score")).alias("less"), F.col("id.null_id").alias("null_id"), F.col("id.vec_id").alias("vec_id"), (F.col("query") == F.col("class")).alias("own"))
    best = found.join(classes.select("class", "ids"), "class").select("query", "class", "score", F.explode("ids").alias("id")).groupBy("query").agg(F.slice(F.array_sort(F.collect_list(row)), 1, keep).alias("best"))
    # Of rows with the query's vector and id one is its own.
    at = F.array_position(F.transform("best", lambda x: x.own & x.vec_id.eqNullSafe(F.col("query_id"))), True).cast("int")
    others = F.when(at == 0, F.slice("best", 1, k)).otherwise(F.slice(F.concat(F.slice("best", F.lit(1), at - 1), F.slice("best", at + 1, F.lit(keep))), 1, k))
    ranked = queries.select(F.col("vec_id").alias("query_id"), F.col("class").alias("query")).join(best, "query").select("query_id", F.posexplode(others).alias("pos", "x"))
    return ranked.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.less")).alias("score"))


def sql(k: int = BEST, every: int = EVERY) -> str:
    """DuckDB SQL for search(embeddings): all products."""
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), ranked AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score,
    row_number() OVER (PARTITION BY a.r ORDER BY list_inner_product(a.q, b.q) DESC, b.vec_id NULLS LAST) AS rank
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % {every} = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= {k}
"""
