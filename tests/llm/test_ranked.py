"""Ranked search against scoring every document: whole tables, small blocks and slices, ties, repeats and empty rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from oracle import agree, connection

from reelsieve.llm import queries, ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=10):
    bags = [Counter(TERM.findall((t or "").translate(LOWER))) for _, t in docs]
    n_docs, n_terms = sum(1 for b in bags if b), sum(b.total() for b in bags)
    df = Counter(w for b in bags for w in b)
    out = []
    for item, text in dict.fromkeys((i, t) for i, t in items):
        found = []
        for (doc, _), bag in zip(docs, bags, strict=True):
            m = 25 + (75 * bag.total() * n_docs) // n_terms if bag else 0
            score = 0
            for w, times in Counter(TERM.findall((text or "").translate(LOWER))).items():
                if bag[w]:
                    score += times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * bag[w]) // (1000 * bag[w] + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, r + 1, None if null else doc, -less) for r, (less, null, doc) in enumerate(sorted(found)[:k])]
    return Counter(out)


def rows(df):
    assert df.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return Counter(tuple(r) for r in df.collect())


def _texts(seed, n, words, size):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)]
    return [" ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(words)], k=rng.randint(1, size))) for _ in range(n)]


@pytest.mark.parametrize("limits", [(400_000, 1_000_000, 100_000), (7, 60, 9)])
def test_every_document_is_ranked(spark, monkeypatch, limits):
    """Small slices and blocks give the same rows."""
    monkeypatch.setattr(ranked, "SLICE", limits[0])
    monkeypatch.setattr(ranked, "POSTINGS", limits[1])
    monkeypatch.setattr(ranked, "DOCUMENTS", limits[2])
    monkeypatch.setattr(ranked, "DEPTH", (1, 4))
    docs, items = list(enumerate(_texts(1, 150, 40, 30))), list(enumerate(_texts(2, 6, 50, 12)))
    got = rows(ranked.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    assert got == brute(docs, items)


def test_threshold_stops_early_and_keeps_ties():
    """Where few documents have a high impact the rest is not scored; equal scores beyond k go by id."""
    n = 20_000
    impact = np.where(np.arange(n) < 12, 1000, 1 + np.arange(n) % 50)
    block = ranked.Block(np.arange(n)[::-1].copy(), np.ones(n, bool), np.arange(n + 1), np.zeros(n, np.int64), impact, 1)
    docs, scores, met = block.top(np.array([0]), np.array([3]), 10)
    assert list(scores) == [3000] * 10 and met < 100
    assert list(block.ids[docs]) == sorted(block.ids[np.arange(12)])[:10]
    again = block.top(np.array([0]), np.array([3]), 10)
    assert list(again[0]) == list(docs) and again[2] == met


def test_nulls_ties_repeats_and_clashing_columns(spark):
    docs = [(5, "Alpha beta"), (5, "Alpha beta"), (None, "alpha BETA"), (1, "alpha beta"), (2, None), (3, ""), (4, "?!"), (9, "Ünïcode日本 x1"), (7, "gamma " * 50_000 + "alpha")]
    docs += [(20 + k, "filler words here") for k in range(30)]
    items = [(1, "alpha"), (1, "alpha"), (2, "alpha alpha beta"), (3, None), (4, "absent"), (5, "ünïcode日本 Ünïcode日本"), (6, "x1"), (7, "filler")]
    got = rows(ranked.search(spark.createDataFrame([(*r, 1, "s") for r in docs], "doc_id long, text string, n long, terms string"), spark.createDataFrame([(*r, 8, "d") for r in items], "item_id long, text string, item long, doc_id string")))
    assert got == brute(docs, items)
    assert [d for i, _, d, _ in sorted(got.elements(), key=lambda x: (x[0], x[1])) if i == 1] == [1, 5, 5, None, 7]
    assert not [r for r in got if r[0] in (3, 4)]
    # Only A-Z are lower-cased.
    assert [r[2] for r in got if r[0] == 5] == [9]


def test_empty_tables(spark):
    none_d, none_i = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    some_d, some_i = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert [ranked.search(d, i).count() for d, i in ((none_d, none_i), (none_d, some_i), (some_d, none_i))] == [0, 0, 0]


def test_query_against_its_sql(spark, small):
    name = "op12_ranked_search"
    agree(spark, connection(small), queries.queries()[name], queries.oracle_sql()[name], small)
