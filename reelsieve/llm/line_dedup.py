"""Line dedup by pairwise alignment: documents that share a run of lines which others have too are aligned with patience diff,
and the common blocks go from the later one.

A run key is the hash of the shortest run of lines, from a given line or up to one, that reaches min_words words; keys that
only one document has link nothing. Each key links its later holders to its first one only (a star), so a passage in a third
of all documents gives one pair for each of them and not one for each two. No block is missed that way: where a document
shares a block of min_words words with any earlier one, each line of it lies in such a run within the block (shrink the block
around the line: what can't be shrunk any more is one of the two kinds), and that run's first holder is not later. A pair's
lines are aligned by patience diff, again for what is left of the later document until no common block of min_words words is
found. An alignment keeps the order of lines and can miss a moved block for a few short lines; the pair's shared runs go too,
so that none is left. Empty lines count where a block goes on behind them; at its ends they go with an aligned block only.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, texts

MIN_WORDS = 30


def line_keys(text: str, min_words: int = MIN_WORDS) -> tuple[list[int], list[int], list[int]]:
    """Hash and words of each line (trimmed), and the run keys from and up to the lines that have one."""
    lines = text.split("\n")
    hashes = np.array([xxhash.xxh64_intdigest(x.strip().encode()) for x in lines], dtype="<u8")
    words = [len(x.split()) for x in lines]
    raw = hashes.tobytes()
    runs = [xxhash.xxh64_intdigest(raw[8 * i : 8 * k]) for i, k in dict.fromkeys(_runs(words, 0, len(lines), min_words))]
    signed = np.array(runs, dtype="<u8").view("<i8").tolist()
    return hashes.view("<i8").tolist(), words, signed


def _anchors(a: list, b: list, a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Increasing pairs of equal lines that are unique in both ranges; if there are none, of equal occurrences of repeated lines."""
    for numbered in (False, True):
        sides = []
        for x, lo, hi in ((a, a0, a1), (b, b0, b1)):
            if numbered:
                seen: Counter = Counter()
                at = {}
                for i in range(lo, hi):
                    at[x[i], seen[x[i]]] = i
                    seen[x[i]] += 1
            else:
                n = Counter(x[lo:hi])
                at = {x[i]: i for i in range(lo, hi) if n[x[i]] == 1}
            sides.append(at)
        pairs = sorted((i, sides[1][k]) for k, i in sides[0].items() if k in sides[1])
        if pairs:
            break
    else:
        return []
    # Longest increasing subsequence of the second places: patience piles with links back.
    tops, piles, back = [], [], [-1] * len(pairs)
    for p, (_, j) in enumerate(pairs):
        k = bisect_left(tops, j)
        back[p] = piles[k - 1] if k else -1
        if k == len(tops):
            tops.append(j)
            piles.append(p)
        else:
            tops[k], piles[k] = j, p
    out, p = [], piles[-1]
    while p >= 0:
        out.append(pairs[p])
        p = back[p]
    return out[::-1]


def patience(a: list, b: list, a0: int = 0, a1: int | None = None) -> list[tuple[int, int]]:
    """Pairs (i, j) of aligned equal lines of a[a0:a1] and b, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(a0, len(a) if a1 is None else a1, 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        i0, j0 = a0, b0
        for i, j in (found := _anchors(a, b, a0, a1, b0, b1)):
            out.append((i, j))
            todo.append((i0, i, j0, j))
            i0, j0 = i + 1, j + 1
        if found:
            todo.append((i0, a1, j0, b1))
    return sorted(out)


def _runs(words: list[int | None], lo: int, hi: int, min_words: int) -> Iterator[tuple[int, int]]:
    """For each line from lo to hi the shortest run from it, and the shortest one up to it, of at least min_words words; a line without a number of words ends runs."""
    while lo < hi:
        end = lo
        while end < hi and words[end] is not None:
            end += 1
        k, held = lo, 0
        for i in range(lo, end):
            while k < end and held < min_words:
                held += words[k]
                k += 1
            if held < min_words:
                break
            if words[i]:
                yield i, k
            held -= words[i]
        i, held = lo, 0
        for k in range(lo, end):
            held += words[k]
            while held - words[i] >= min_words:
                held -= words[i]
                i += 1
            if held >= min_words and words[k]:
                yield i, k + 1
        lo = end + 1


def common_blocks(later: list, words: list[int], earlier: list, min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Ranges of the later document's lines that are aligned with the earlier one's and have at least min_words words, and
    all others that lie in a run of at least min_words words of the earlier one, wherever it is."""
    out, todo = [], [(0, len(later))]
    while todo:
        lo, hi = todo.pop()
        if sum(words[lo:hi]) < min_words:
            continue
        blocks: list[list[int]] = []
        for i, j in patience(later, earlier, lo, hi):
            if blocks and (i, j) == (blocks[-1][1], blocks[-1][2]):
                blocks[-1][1:] = [i + 1, j + 1]
            else:
                blocks.append([i, i + 1, j + 1])
        good = [(i, k) for i, k, _ in blocks if sum(words[i:k]) >= min_words]
        for i, k in good:
            todo.append((lo, i))
            lo = k
        if good:
            todo.append((lo, hi))
        out += good
    # A run may go on from what has gone already, so all runs of both documents are compared.
    known, there = dict(zip(later, words, strict=True)), set(earlier)
    runs = list(_runs([n if x in there else None for x, n in zip(later, words, strict=True)], 0, len(later), min_words))
    gone = bytearray(len(later))
    for i, k in out:
        gone[i:k] = b"\x01" * (k - i)
    runs = [(i, k) for i, k in runs if not all(gone[i:k])]
    if runs:
        held = {tuple(earlier[i:k]) for i, k in _runs([known.get(x) for x in earlier], 0, len(earlier), min_words)}
        out += [(i, k) for i, k in runs if tuple(later[i:k]) in held]
    out.sort()
    # Overlapping ranges become one.
    joined: list[tuple[int, int]] = []
    for i, k in out:
        if joined and i < joined[-1][1]:
            joined[-1] = (joined[-1][0], max(joined[-1][1], k))
        else:
            joined.append((i, k))
    out = joined
    return out


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text (without the deleted blocks), n_lines, n_removed (lines), from_docs (earlier doc_ids, ascending, comma-joined).

    One row per input row; documents without a common block keep their text to the letter. Earlier means the smaller
    (doc_id, hash of the text); rows that agree in both are one document and don't touch each other. A null doc_id
    comes first; null and empty texts have one empty line and are left alone (null becomes empty); very long texts are
    aligned whole, in time in proportion to their lines but for lines that repeat within them; an empty table gives an
    empty result; other columns are not read.
    """
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("d"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("s", F.xxhash64("text"))

    def keys(batches):
        for batch in batches:
            got = [line_keys(t, min_words) for some in texts(batch.column(2)) for t in some]
            columns = [pa.array([g[k] for g in got], kind) for k, kind in enumerate((pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["d", "s", "lines", "words", "runs"])

    # One row for each document, written: both sides of the joins below are then plain shuffles, which AQE splits where
    # an earlier document has very many later ones.
    lines = materialize(docs.select("d", "s", "text").mapInArrow(keys, "d long, s long, lines array<long>, words array<int>, runs array<long>").dropDuplicates(["d", "s"]), "lines")
    holds = lines.select(F.struct("d", "s").alias("doc"), F.explode(F.array_distinct("runs")).alias("run"))
    # Written for the same reason: an aggregate by run has no shuffle of its own that AQE could split.
    first = materialize(holds.groupBy("run").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first != last").select("run", "first"), "first")
    pairs = holds.join(first, "run").where("doc != first").select(F.col("doc.d").alias("d"), F.col("doc.s").alias("s"), F.col("first.d").alias("d0"), F.col("first.s").alias("s0")).distinct()
    own = lines.select("d", "s", "lines", "words")
    other = lines.select(F.col("d").alias("d0"), F.col("s").alias("s0"), F.col("lines").alias("lines0"))

    def align(batches):
        for batch in batches:
            # One pair's lines at a time as Python lists.
            found = [common_blocks(batch.column(3)[i].as_py(), batch.column(4)[i].as_py(), batch.column(5)[i].as_py(), min_words) for i in range(batch.num_rows)]
            ranges = pa.array([[{"a": a, "b": b} for a, b in x] for x in found], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), ranges], names=["d", "s", "d0", "ranges"])

    aligned = pairs.join(own, ["d", "s"]).join(other, ["d0", "s0"]).select("d", "s", "d0", "lines", "words", "lines0").mapInArrow(align, "d long, s long, d0 long, ranges array<struct<a:int,b:int>>")
    # Of a document's many partners most give the same ranges: what is gathered are its lines, each once.
    each = aligned.select("d", "s", "d0", F.explode("ranges").alias("r"))
    gone = each.groupBy("d", "s").agg(F.collect_set("r").alias("ranges"), F.array_join(F.array_sort(F.collect_set("d0")), ",").alias("from_docs"))
    gone = gone.withColumn("gone", F.array_distinct(F.flatten(F.transform("ranges", lambda r: F.sequence(r["a"], r["b"] - 1))))).drop("ranges")
    cut = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size("cut") - 1), F.col("gone"))
    out = docs.join(gone, ["d", "s"], "left").withColumn("cut", F.when(F.col("gone").isNotNull(), cut)).withColumn("kept", F.transform(left, lambda i: F.element_at("cut", i + 1)))
    n = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    return out.select(
        F.nullif("d", F.lit(-(1 << 63))).alias("doc_id"),
        F.coalesce(F.array_join("kept", "\n"), "text").alias("text"),
        n.cast("long").alias("n_lines"),
        F.coalesce(n - F.size("kept"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("from_docs", F.lit("")).alias("from_docs"),
    )
