"""Ranked lexical search by Fagin's threshold algorithm.

Documents are read once, into a forward index of their terms. Tasks then take blocks of the index, of bounded size, and turn
each into impact-sorted lists, one for each term of the items, beside the block's own forward index. An item goes down its
lists in turn; each document that it meets first there is scored in full from the forward index; it ends as soon as the sum
of what its lists can still give, the threshold, is strictly below the block's kth score, so that no tie is lost. The best of
each block are ranked together. A term that a third of all documents hold is spread over the blocks like any other.

Scores are 64-bit integers: a term of weight floor(1000 * ln((2N + 2) / (2df + 1))) gives weight * ((10^9 * tf) div (1000 * tf + 8m))
for a document with m = 25 + ((75 * n * N) div L).

Cases: a null or empty text has no terms, and an item without terms, or whose terms no document holds, no rows; equal rows of
the items are one item; repeated documents are ranked side by side; equal scores go by doc_id, null last; texts are read whole;
columns beyond doc_id, text, item_id aren't looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, sliced, texts

BEST = 10
#: Rows (item, term) that are broadcast at once; further ones take another pass over the index.
SLICE = 400_000
#: Postings of a block, and documents.
POSTINGS, DOCUMENTS = 1_000_000, 100_000
#: Entries that an item reads from each of its lists before it looks at the threshold: at first, at most.
DEPTH = (16, 1024)

#: ASCII digits and letters (lower-cased) and all bytes of other code points make terms.
_TERMS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def terms(text: str) -> Counter:
    """Occurrences of each term (UTF-8) of a text."""
    return Counter(text.encode("utf-8", "surrogatepass").translate(_TERMS).split())


def _indexed(rows: DataFrame, id_col: str) -> DataFrame:
    """id, n, terms, tfs of the rows that have a term."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for piece in texts(batch.column("text")):
                found = [terms(x) for x in piece]
                some = [k for k, x in enumerate(found) if x]
                ids = batch.column("id").slice(at, len(piece)).take(pa.array(some, pa.int64()))
                edges = pa.array(np.cumsum([0, *(len(found[k]) for k in some)]), pa.int32())
                words = pa.array([w for k in some for w in found[k]], pa.string())
                tfs = pa.array([n for k in some for n in found[k].values()], pa.int64())
                n = pa.array([found[k].total() for k in some], pa.int64())
                at += len(piece)
                yield pa.RecordBatch.from_arrays([ids, n, pa.ListArray.from_arrays(edges, words), pa.ListArray.from_arrays(edges, tfs)], names=["id", "n", "terms", "tfs"])

    return rows.select(F.col(id_col).cast("long").alias("id"), "text").mapInArrow(index, "id long, n long, terms array<string>, tfs array<long>")


class Block:
    """Postings of some documents: by document (the forward index), and by term from the highest impact down (the lists)."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, edges: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        self.ids, self.known, self.edges, self.term, self.impact = ids, known, edges, term, impact
        order = np.lexsort((-impact, term))
        self.listed_doc = np.repeat(np.arange(len(ids)), np.diff(edges))[order]
        self.listed_impact = impact[order]
        self.list_edges = np.searchsorted(term[order], np.arange(n_terms + 1))
        self._weight = np.zeros(n_terms, np.int64)
        self._met = np.zeros(len(ids), bool)

    def _scores(self, docs: np.ndarray) -> np.ndarray:
        """Full scores of documents, each of which has a posting."""
        low, size = self.edges[docs], self.edges[docs + 1] - self.edges[docs]
        first = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(low - first, size)
        return np.add.reduceat(self._weight[self.term[at]] * self.impact[at], first)

    def _better(self, docs: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        best = np.lexsort((self.ids[docs], ~self.known[docs], -scores))[:k]
        return docs[best], scores[best]

    def top(self, term: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores above 0 of the k best, and how many documents were scored.

        term, weight: the distinct terms of an item with their weights, repeats multiplied in.
        """
        low, size = self.list_edges[term], self.list_edges[term + 1] - self.list_edges[term]
        term, weight, low, size = (x[(size > 0) & (weight > 0)] for x in (term, weight, low, size))
        self._weight[term] = weight
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        met, depth, step = [], 0, DEPTH[0]
        while len(term) and depth < size.max():
            at = depth + np.arange(step)
            new = np.unique(self.listed_doc[(low[:, None] + at)[at < size[:, None]]])
            new = new[~self._met[new]]
            self._met[new] = True
            met.append(new)
            if len(new):
                docs, scores = self._better(np.concatenate((docs, new)), np.concatenate((scores, self._scores(new))), k)
            depth, step = depth + step, min(2 * step, DEPTH[1])
            on = depth < size
            threshold = int((weight[on] * self.listed_impact[low[on] + depth - 1]).sum())
            if threshold == 0 or len(docs) == k and threshold < scores[-1]:
                break
        n = sum(map(len, met))
        for x in met:
            self._met[x] = False
        self._weight[term] = 0
        return docs[scores > 0], scores[scores > 0], n


def _searched(index: DataFrame, items: Broadcast, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """item, doc_id, score: the k best of each item in each block."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, item, term, weight = items.value
        edges = np.concatenate(([0], np.flatnonzero(np.diff(item)) + 1, [len(item)]))
        held: list[tuple] = []

        def found() -> pa.RecordBatch:
            ids, known, m, size, ts, tf = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            impact = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, size))
            block = Block(ids, known, np.concatenate(([0], np.cumsum(size))), ts, impact, len(words))
            out = [(item[a], *block.top(term[a:b], weight[a:b], k)[:2]) for a, b in zip(edges[:-1], edges[1:], strict=True)] if len(item) else []
            docs = np.concatenate([d for _, d, _ in out]) if out else np.zeros(0, np.int64)
            score = np.concatenate([s for *_, s in out]) if out else np.zeros(0, np.int64)
            numbers = np.repeat([i for i, *_ in out], [len(d) for _, d, _ in out]).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(ids[docs], mask=~known[docs]), pa.array(score)], names=["item", "doc_id", "score"])

        for batch in batches:
            lists, tfs = batch.column("terms"), batch.column("tfs").flatten().to_numpy(zero_copy_only=False)
            at = pc.fill_null(pc.index_in(lists.flatten(), value_set=words), -1).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(batch)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            size = np.bincount(owner[at >= 0], minlength=len(batch))
            some = size > 0
            id_col = batch.column("id")
            ids, known = pc.fill_null(id_col, 0).to_numpy(zero_copy_only=False), pc.is_valid(id_col).to_numpy(zero_copy_only=False)
            m = 100 - 75 + (75 * batch.column("n").to_numpy(zero_copy_only=False) * n_docs) // n_terms
            held.append((ids[some], known[some], m[some], size[some], at[at >= 0].astype(np.int64), tfs[at >= 0]))
            if sum(len(x[4]) for x in held) >= POSTINGS or sum(len(x[0]) for x in held) >= DOCUMENTS:
                yield found()
        if held:
            yield found()

    return index.mapInArrow(search, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """Columns item_id, rank (int, from 1), doc_id, score (long): the k documents with the highest scores above 0 of each item.

    docs: doc_id, text; items: item_id, text. Items are broadcast in slices of at most SLICE rows (item, term).
    """
    sc = docs.sparkSession.sparkContext
    index = materialize(_indexed(docs, "doc_id"), "forward-index")
    asked = materialize(_indexed(items.select("item_id", "text").distinct(), "item_id").withColumn("item", F.monotonically_increasing_id()), "items")
    total = index.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    rows = asked.select("item", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select("item", F.col("x.terms").alias("term"), F.col("x.tfs").alias("times"))
    df = index.select(F.explode("terms").alias("term")).join(rows.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(total.n) + 2).cast("double") / (2 * F.col("df") + 1)))
    weighed = materialize(rows.join(df, "term").select("item", "term", (F.col("times") * weight).cast("long").alias("weight")), "item-terms")
    parts, n = sliced(weighed, "item", SLICE)
    found = None
    for k_slice in range(n):
        got = parts.where(F.col("slice") == k_slice).orderBy("item", "term").toArrow()
        words = pc.unique(got["term"].combine_chunks())
        sent = sc.broadcast((words, got["item"].to_numpy(), pc.index_in(got["term"], value_set=words).to_numpy().astype(np.int64), got["weight"].to_numpy()))
        best = materialize(_searched(index, sent, total.n, max(total.l, 1), k), "block-best")
        sent.unpersist()
        found = best if found is None else found.unionByName(best)
    discard(weighed)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item", F.col("id").alias("item_id")), "item").select("item_id", "rank", "doc_id", "score")


def sql(k: int = BEST) -> str:
    """DuckDB SQL for search(documents, benchmark): every document that shares a term is scored."""
    found = r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
    return rf"""
WITH doc AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS r, text FROM documents),
term AS MATERIALIZED (SELECT r, t AS term, count(*) AS tf FROM (SELECT r, {found} AS t FROM doc) GROUP BY ALL),
size AS MATERIALIZED (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM term GROUP BY r),
total AS (SELECT count(*) AS n, CAST(sum(n) AS BIGINT) AS l FROM size),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * (SELECT n FROM total) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM term GROUP BY term),
item AS MATERIALIZED (SELECT DISTINCT item_id, text FROM benchmark),
asked AS (SELECT item_id, i, t AS term, count(*) AS times FROM (SELECT item_id, i, {found} AS t FROM (SELECT *, row_number() OVER () AS i FROM item)) GROUP BY ALL),
score AS (
  SELECT i, item_id, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * s.n * (SELECT n FROM total)) // (SELECT l FROM total))))) AS BIGINT) AS score
  FROM asked JOIN term USING (term) JOIN weight USING (term) JOIN size s USING (r) GROUP BY ALL
), ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM score JOIN doc USING (r) WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {k}
"""
