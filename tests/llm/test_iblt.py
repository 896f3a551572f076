import hashlib
import re

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelsieve.llm import iblt

PIECES = re.compile(iblt._PIECES)


def pieces(text):
    return {x.strip(" ") for x in PIECES.findall(text)}


def likeness(a, b):
    a, b = pieces(a), pieces(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, got):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [t or "" for _, t in ordered]
    found = sorted((tuple(r) for r in got), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for i, t in enumerate(texts):
        after = texts[(i + 1) % len(texts)]
        cut = len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        want.append((ordered[i][0], len(t), hashlib.sha256(edited.encode()).hexdigest(), likeness(t, edited), likeness(t, after)))
    assert sorted(map(repr, ((r[0], r[1], r[2], round(r[5], 9), round(r[6], 9)) for r in found))) == sorted(repr((*w[:3], round(w[3], 9), round(w[4], 9))) for w in want)


def test_whole_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = iblt.edited_likeness(docs).collect()
    check(rows, got)
    prints = {}
    for r in got:
        text = dict(rows)[r.doc_id]
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
    assert sum(r.near_edited > r.near_next for r in got) > 0.85 * len(got)


def sketched(text):
    """size and {place: [count, keys]} of a fingerprint."""
    size, *cells = text.split(",")
    return int(size, 16), {int(at, 16): [int(c, 16), int(k, 16)] for at, c, k in (x.split(".") for x in cells if x)}


def place(key, table, size):
    data = key.to_bytes(8, "little")
    seed = xxhash.xxh64_intdigest(data, 42)
    return (xxhash.xxh64_intdigest(table.to_bytes(4, "little"), seed) & (size - 1)) + table * size


def peeled(cells, size):
    """The keys of a sketch, None if it doesn't peel."""
    cells, found = {at: list(x) for at, x in cells.items()}, set()
    while cells:
        alone = next((k for c, k in cells.values() if abs(c) == 1 and all((place(k, t, size) in cells) for t in range(3))), None)
        if alone is None:
            return None
        sign = next(c for c, k in cells.values() if k == alone and abs(c) == 1)
        found.add(alone)
        for t in range(3):
            at = place(alone, t, size)
            cells[at][0] -= sign
            cells[at][1] ^= alone
            if cells[at] == [0, 0]:
                del cells[at]
    return found


def pairs_of(spark, rows):
    df = spark.createDataFrame([(i, 0, a, b) for i, (a, b) in enumerate(rows)], "rid long, kind int, a string, b string")
    return df.select("rid", "kind", iblt.paragraph_keys(F.col("a")).alias("a"), iblt.paragraph_keys(F.col("b")).alias("b"))


def test_retries_recover_large_differences(spark):
    rows = []
    for n, shared in ((3, 0), (40, 10), (700, 300), (20000, 100)):
        rows.append(("\n".join([f"left {i}" for i in range(n)] + [f"both {i}" for i in range(shared)]), "\n".join([f"right {i}" for i in range(n)] + [f"both {i}" for i in range(shared)])))
    pairs = pairs_of(spark, rows)
    got = {r.rid: (r.n, r.d) for r in iblt.differences(pairs).collect()}
    assert got == {0: (6, 6), 1: (100, 80), 2: (2000, 1400), 3: (40200, 40000)}


def test_digests_of_the_difference(spark):
    pairs = pairs_of(spark, [("a\nb\nc", "b\nc\nd"), ("a", "a"), ("", "x"), ("", ""), ("\n".join(map(str, range(300))), "\n".join(map(str, range(250, 900))))])
    keys = {r.rid: set(r.a) ^ set(r.b) for r in pairs.collect()}
    got = {r.rid: (set(r.digests), r.d) for r in iblt.differences(pairs, digests=True).collect()}
    assert got == {i: (k, len(k)) for i, k in keys.items() if i != 3}


def test_a_failed_subtraction_is_repeated_larger(spark, monkeypatch):
    monkeypatch.setattr(iblt, "ROUNDS", 1)
    tried = []
    real = iblt.sketch
    monkeypatch.setattr(iblt, "sketch", lambda *x: tried.append(1) or real(*x))
    monkeypatch.setattr(iblt, "peel", lambda cells, *by: iblt._peel_table(cells, 0, *by))
    pairs = pairs_of(spark, [("\n".join(f"l{i}" for i in range(60)), "\n".join(f"r{i}" for i in range(60)))])
    assert [(r.n, r.d) for r in iblt.differences(pairs).collect()] == [(120, 120)] and len(tried) > 2


def test_likeness_follows_from_the_published_fingerprints(spark, small):
    got, told = iblt.edited_likeness(spark.read.parquet(f"{small}/documents.parquet")).collect(), 0
    for r in got:
        (s, a), (t, b) = sketched(r.fingerprint), sketched(r.edited_fingerprint)
        own, new = peeled(a, s), peeled(b, t)
        if own is not None and new is not None:
            told += 1
            assert abs((len(own & new) / len(own | new) if own | new else 1.0) - r.near_edited) < 1e-9
    assert told > 0.9 * len(got)


def test_ids_of_any_size_lie_in_ranges_of_like_size(spark, docs):
    rows = [(i, f"text {i}") for i in range(3000)] + [(10**12, "far"), (-(1 << 62) - 5, "low"), ((1 << 62) + 5, "high"), (None, "none"), (None, "more")]
    got = iblt.with_next(docs(rows), rows_per_range=100)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = [(*ordered[i], ordered[(i + 1) % len(ordered)][1]) for i in range(len(ordered))]
    assert sorted(map(repr, ((r.doc_id, r.text, r.next_text) for r in got.collect()))) == sorted(map(repr, want))
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1000


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-(10**6), 10**6), st.text(alphabet="ab. \n𝄞é", max_size=400)), min_size=1, max_size=30, unique_by=lambda x: x[0]))
def test_next_document_in_any_order(spark, rows):
    check(rows, iblt.edited_likeness(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_ranges_are_joined_at_their_borders(spark, docs):
    rows = [(i * 7 - 50, f"text number {i}. " * (i % 13)) for i in range(400)]
    got = iblt.with_next(docs(rows), rows_per_range=10).collect()
    ordered = sorted(rows)
    assert sorted((r.doc_id, r.next_text) for r in got) == sorted((ordered[i][0], ordered[(i + 1) % len(ordered)][1]) for i in range(len(ordered)))


def test_odd_rows(docs):
    rows = [(1, None), (2, ""), (None, "first."), (2, "second\nthird"), (2, "second\nthird"), (9, "z" * 300000)]
    df = docs(rows).withColumn("cell", F.lit(1)).withColumn("next_text", F.lit("n")).withColumn("near_next", F.lit(0))
    check(rows, iblt.edited_likeness(df).collect())
    assert iblt.edited_likeness(df.limit(0)).count() == 0
    assert [tuple(r)[5:] for r in iblt.edited_likeness(docs([(1, "alone here")])).collect()][0][1] == 1.0


def test_no_python_in_the_plan(spark, small):
    plan = iblt.edited_likeness(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
