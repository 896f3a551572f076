"""Exact top-k against all products: slices, lists, copies of one vector, ties, repeats, empty and unusable vectors."""

import math
import random
from collections import Counter

import pytest
from oracle import agree, connection

from reelsieve.llm import queries, topk

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, k=5, every=50):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for a, (query, q) in enumerate(good):
        if query is not None and query % every == 0:
            found = sorted((-sum(x * y for x, y in zip(q, v, strict=False)), i is None, i or 0) for b, (i, v) in enumerate(good) if b != a)
            out.update((query, r + 1, None if null else i, -less) for r, (less, null, i) in enumerate(found[:k]))
    return out


def rows(df):
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return Counter(tuple(r) for r in df.collect())


def _vectors(seed, n, width, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    return [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize(("lists", "slice_bytes", "width"), [(1, 4 << 20, 7), (2, 4 << 20, 8), (4, 80, 5), (3, 200, 2)])
def test_all_products(spark, lists, slice_bytes, width):
    """One list or more than there are components, one query a slice or all at once."""
    data = _vectors(lists, 400, width)
    got = rows(topk.search(spark.createDataFrame(data, SCHEMA), every=20, lists=lists, slice_bytes=slice_bytes))
    assert got == brute(data, every=20)


def test_negative_scores_only(spark):
    """All products with the queries are below 0: the cutoff is negative, and so is its share."""
    rng = random.Random(4)
    data = [(i, [(1 if i % 50 == 0 else -1) * rng.uniform(0.5, 2) for _ in range(6)]) for i in range(101) if i % 50 == 0 and i < 50 or i % 50]
    got = rows(topk.search(spark.createDataFrame(data, SCHEMA)))
    assert got == brute(data) and all(r[3] < 0 for r in got)


def test_a_third_are_copies(spark):
    """Copies are one class: the smallest ids win the ties, and a query that is a copy leaves out its own row only."""
    data = [(i, [1.0, 0.5, -0.25]) if i % 3 == 0 else (i, v) for i, v in _vectors(9, 600, 3, 0.2)]
    got = rows(topk.search(spark.createDataFrame(data, SCHEMA), every=10))
    assert got == brute(data, every=10)


def test_nulls_repeats_lengths_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [3.0, 1.0]), (50, []), (100, None), (150, [1.0, None]), (200, [nan, 1.0]), (250, [inf, 1.0]), (None, [1.0, 2.0]), (None, [1.0, 2.0]), (7, [2.0]), (8, [1.0, 1.0, 1.0]), (9, None), (300, [-0.001, 0.001])]
    df = spark.createDataFrame([(*r, 1, "x") for r in data], SCHEMA + ", class int, q string")
    got = rows(topk.search(df))
    assert got == brute(data)
    assert {r[0] for r in got} == {0, 50, 300}


def test_large_components(spark):
    """Beyond doubles' exact integers the products are taken in 64-bit integers; beyond those it is an error."""
    rng = random.Random(2)
    data = [(i, [float(rng.randint(-(2**21), 2**21)) + rng.random() for _ in range(3)]) for i in range(120)]
    assert rows(topk.search(spark.createDataFrame(data, SCHEMA))) == brute(data)
    with pytest.raises(ValueError, match="64 bits"):
        topk.search(spark.createDataFrame([(0, [1e12, 1.0]), (1, [1.0, 1.0])], SCHEMA))


def test_few_and_no_rows(spark):
    assert rows(topk.search(spark.createDataFrame([], SCHEMA))) == Counter()
    assert rows(topk.search(spark.createDataFrame([(50, [1.0])], SCHEMA))) == Counter()
    assert rows(topk.search(spark.createDataFrame([(1, [1.0])], SCHEMA))) == Counter()
    data = [(50, [1.0]), (1, [2.0]), (2, [-1.0])]
    assert rows(topk.search(spark.createDataFrame(data, SCHEMA))) == brute(data)


def test_query_against_its_sql(spark, small):
    name = "op13_top_inner_products"
    agree(spark, connection(small), queries.queries()[name], queries.oracle_sql()[name], small)
