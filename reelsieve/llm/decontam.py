"""Benchmark decontamination: item-sized windows, their SimHash looked up in Hamming blocks, exact similarity of what is found.

A document is read once as 5-word shingles. Only windows that hold a shingle of an item can be similar to it, so windows
are laid around such hits, each as many words as the item. A window's 64-bit SimHash is looked up among the items of its
length: fingerprints within RADIUS bits agree wholly in at least one of RADIUS + 1 blocks, so the union of the blocks'
matches misses none of them; the complete distance follows. Windows of similarity 0.8 differ in up to 18 bits and more, so
RADIUS has to be so large that a block has 2 or 3 bits: what makes the search small are the shared shingles around which
windows are laid, and the blocks guarantee the radius without choosing much. What remains is verified exactly, by the weighted Jaccard
index of shingles, the weights being how often each occurs: sum of the smaller over sum of the larger counts.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors
from .common import apart, materialize, texts

WIDTH, MIN_SIMILARITY, RADIUS = 5, 0.8, 24
#: Benchmark text that is broadcast at once; a larger benchmark is searched in slices of this size.
SLICE_BYTES = 32 << 20
_TABLE_BITS = 20
_WINDOWS = 4096


class BlockIndex:
    """Fingerprints by the value of each of radius + 1 bit blocks."""

    def __init__(self, prints: np.ndarray, radius: int):
        edges = np.linspace(0, 64, radius + 2).astype(int)
        self.prints, self.radius = prints, radius
        self.blocks = [(np.uint64(a), np.uint64((1 << int(b - a)) - 1)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        self.tables: list[dict[int, list[int]]] = []
        for shift, mask in self.blocks:
            table = defaultdict(list)
            for i, v in enumerate(((prints >> shift) & mask).tolist()):
                table[v].append(i)
            self.tables.append(dict(table))

    def near(self, prints: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """(positions in prints, number of the indexed fingerprint) within the radius."""
        found: dict[int, np.ndarray] = {}
        for (shift, mask), table in zip(self.blocks, self.tables, strict=True):
            values = (prints >> shift) & mask
            for v in np.unique(values).tolist():
                for i in table.get(v, ()):
                    found[i] = found.get(i, False) | (values == v)
        out = []
        for i, match in found.items():
            at = np.flatnonzero(match)
            at = at[np.bitwise_count(prints[at] ^ self.prints[i]) <= self.radius]
            if len(at):
                out.append((at, i))
        return out


def _prints(marks: np.ndarray, count: int) -> np.ndarray:
    """SimHashes of all runs of `count` rows of marks (0/1 bits)."""
    total = np.concatenate((np.zeros((1, 64), dtype=np.int32), np.cumsum(marks, axis=0, dtype=np.int32)))
    return vectors.pack(2 * (total[count:] - total[:-count]) > count)


class Benchmark:
    """Items ready for the search: shingles with counts, an inverted index of them, and a block index for each length."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.sizes, self.counts = [], [], []
        holders: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))  # width, shingle: items
        by_size: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for at, offsets, hashes in vectors.words([t for _, t in items]):
            for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                if a == b:
                    continue
                h = vectors.text_shingles(hashes[a:b], WIDTH)
                number = len(self.ids)
                self.ids.append(items[at + k][0])
                self.sizes.append(int(b - a))
                unique, n = np.unique(h, return_counts=True)
                self.counts.append((unique, n))
                for x in unique.tolist():
                    holders[min(WIDTH, int(b - a))][x].append(number)
                by_size[int(b - a)].append((number, int(_prints(vectors.bits(h), len(h))[0])))
        self.holders = {w: dict(x) for w, x in holders.items()}
        self.tables = {}
        for w, x in self.holders.items():
            table = np.zeros(1 << _TABLE_BITS, dtype=bool)
            table[np.fromiter(x, dtype=np.uint64) & np.uint64((1 << _TABLE_BITS) - 1)] = True
            self.tables[w] = table
        self.index = {size: (np.array([n for n, _ in x]), BlockIndex(np.array([f for _, f in x], dtype=np.uint64), RADIUS)) for size, x in by_size.items()}

    def search(self, texts: list[str]) -> list[tuple[int, int, float, int, int]]:
        """(text's number, item id, best similarity, first word, words) for each similar pair."""
        out = []
        for at, offsets, hashes in vectors.words(texts):
            for width in self.holders:
                h = vectors.shingles(hashes, width)
                maybe = np.flatnonzero(self.tables[width][h & np.uint64((1 << _TABLE_BITS) - 1)])
                hits = [(p, x) for p, x in zip(maybe.tolist(), h[maybe].tolist(), strict=True) if x in self.holders[width]]
                by_text: dict[int, list[tuple[int, int]]] = defaultdict(list)
                texts_of = np.searchsorted(offsets, [p for p, _ in hits], side="right") - 1
                for t, (p, x) in zip(texts_of.tolist(), hits, strict=True):
                    if p + width <= offsets[t + 1]:
                        by_text[t].append((p - int(offsets[t]), x))
                for t, found in by_text.items():
                    for match in self._text(hashes[offsets[t] : offsets[t + 1]], width, found):
                        out.append((at + t, *match))
        return out

    def _text(self, hashes: np.ndarray, width: int, hits: list[tuple[int, int]]) -> list[tuple[int, float, int, int]]:
        places: dict[int, set[int]] = defaultdict(set)  # by item length
        for p, x in hits:
            for size in {self.sizes[i] for i in self.holders[width][x]}:
                places[size].add(p)
        own = vectors.shingles(hashes, width)
        best: dict[int, tuple[float, int, int]] = {}
        for size, at in places.items():
            words = min(size, len(hashes))
            count = words - width + 1  # shingles of a window
            if count * (1 + 1e-9) < MIN_SIMILARITY * (size - width + 1):
                continue
            starts = sorted({s for p in at for s in range(max(0, p - count + 1), min(p, len(hashes) - words) + 1)})
            numbers, index = self.index[size]
            while starts:
                n = 1
                while n < len(starts) and n < _WINDOWS and starts[n] - starts[n - 1] <= count:
                    n += 1
                first, region = starts[0], own[starts[0] : starts[n - 1] + count]
                picked = np.array(starts[:n]) - first
                starts = starts[n:]
                prints = _prints(vectors.bits(region), count)[picked]
                for which, i in index.near(prints):
                    for similarity, s in self._verify(region, picked[which], count, int(numbers[i])):
                        best[int(numbers[i])] = max(best.get(int(numbers[i]), (0.0, 0, 0)), (similarity, -(first + s), words))
        return [(self.ids[i], similarity, -s, words) for i, (similarity, s, words) in best.items()]

    def _verify(self, region: np.ndarray, starts: np.ndarray, count: int, item: int) -> list[tuple[float, int]]:
        unique, n = self.counts[item]
        k = np.minimum(np.searchsorted(unique, region), len(unique) - 1)
        k = np.where(unique[k] == region, k, len(unique))
        held = np.concatenate(([0], np.cumsum(k < len(unique))))
        total = count + int(n.sum())
        least = MIN_SIMILARITY * total / (1 + MIN_SIMILARITY) - 1e-9  # of common weight
        out = []
        for s in starts[held[starts + count] - held[starts] >= least].tolist():
            common = int(np.minimum(np.bincount(k[s : s + count], minlength=len(unique) + 1)[:-1], n).sum())
            if common >= least:
                out.append((common / (total - common), s))
        return out


#: The benchmark that this Python worker has ready: built once for all of its tasks, not for each.
_ready: dict[str, object] = {}


def _prepared(items: list[tuple[int, str]]) -> Benchmark:
    if _ready.get("items") is not items:
        _ready.update(items=items, benchmark=Benchmark(items))
    return _ready["benchmark"]


def contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, item_id, similarity (of the best window, the first of equals), first_word, n_words for each row with a similar item.

    Rows without a match give none; repeated rows give repeated matches. Null and empty texts match nothing, items
    without words are left out, equal items match each under its own id; a document shorter than an item is one window. The
    benchmark is read in slices of a bounded size, so that no broadcast grows with it; other columns are not read.
    """
    return matches(df, benchmark, id_col, text_col, slice_bytes).drop("t")


def clean(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df's rows without a similar item; rows are told apart by doc_id and a hash of the text.

    Null and empty texts match nothing and stay; repeated rows stay or go together; very long texts are read whole; an empty
    table gives an empty result, an empty benchmark all rows; df's columns may have any names.
    """
    d, t = apart(df, "bad_id", "bad_hash")
    found = matches(df, benchmark, id_col, text_col).select(F.col("doc_id").alias(d), F.col("t").alias(t)).distinct()
    own = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(d)) & (_hash(F.col(f"`{text_col}`")) == F.col(t))
    return df.join(materialize(found, "contaminated"), own, "left_anti")


def _hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def matches(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """contaminated() with t, the hash of the row's text."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), _hash(F.col(text_col)).alias("t"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    schema = "doc_id long, t long, item_id long, similarity double, first_word long, n_words long"
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, math.ceil(size / slice_bytes))
    out = None
    for k in range(slices):
        part = items if slices == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k)
        held = df.sparkSession.sparkContext.broadcast([tuple(r) for r in part.collect()])

        def each(batches, held=held):
            bench = _prepared(held.value)
            for batch in batches:
                at = 0
                for some in texts(batch.column(1)):
                    found = bench.search(some)
                    ids = pa.array([at + x[0] for x in found], pa.int64())
                    at += len(some)
                    if found:
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(ids), batch.column(2).take(ids), *(pa.array([x[k] for x in found], kind) for k, kind in ((1, pa.int64()), (2, pa.float64()), (3, pa.int64()), (4, pa.int64())))], names=["doc_id", "t", "item_id", "similarity", "first_word", "n_words"])

        rows = docs.mapInArrow(each, schema)
        out = rows if out is None else out.unionByName(rows)
    return out
