import re
import tracemalloc
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from reelsieve.llm import quality


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    train, test = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    rows = quality.classify(docs, train).join(test, "doc_id").toPandas()
    clean = (rows.quality == 1) & (rows.toxic == 0)
    assert ((rows.p_quality >= 0.5) == (rows.quality == 1)).mean() > 0.98
    assert (rows[rows.toxic == 1].p_toxic > 0.5).mean() > 0.85
    assert rows[clean].keep.mean() > 0.99
    assert rows[~clean].keep.mean() < 0.05


def scored(spark, rows):
    return spark.createDataFrame(rows, "host string, path string, z_quality double, z_toxic double")


def test_sparse_sites_shrink_toward_their_host_and_the_prior(spark):
    rows = [("good", "a", 3.0, -4.0)] * 400 + [("bad", "a", -3.0, -4.0)] * 400 + [("rare", "a", -3.0, -4.0)] + [("good", "few", -3.0, -4.0)]
    got = {(r.host, r.path): r.shift_quality for r in quality.posteriors(scored(spark, rows)).collect()}
    assert got["good", "a"] > 1 > 0 > got["bad", "a"]
    assert abs(got["rare", "a"]) < abs(got["bad", "a"])
    assert got["good", "few"] > got["bad", "a"]


def test_posterior_matches_the_formula(spark):
    rnd = np.random.default_rng(0)
    rows = [(f"h{h}", f"p{p}", float(rnd.normal(h - 2, 1)), -3.0) for h in range(4) for p in range(3) for _ in range(20 * (h + 1))]
    p = {}
    for host, path, z, _ in rows:
        p.setdefault((host, path), []).append(1 / (1 + np.exp(-z)))
    every = np.concatenate([np.array(x) for x in p.values()])
    hosts = {h: np.concatenate([np.array(x) for (g, _), x in p.items() if g == h]) for h, _ in p}

    def strength(groups, priors):
        n = sum(map(len, groups))
        within = sum(((g - g.mean()) ** 2).sum() for g in groups) / n
        between = max((sum(len(g) * (g.mean() - m) ** 2 for g, m in zip(groups, priors, strict=True)) - within * len(groups)) / n, 1e-6)
        return min(max(within / between, 1.0), 1e6)

    a = strength(list(hosts.values()), [every.mean()] * len(hosts))
    host_post = {h: (x.sum() + a * every.mean()) / (len(x) + a) for h, x in hosts.items()}
    b = strength([np.array(x) for x in p.values()], [host_post[h] for h, _ in p])
    odds = lambda q: np.log(q / (1 - q))
    for r in quality.posteriors(scored(spark, rows)).collect():
        x = np.array(p[r.host, r.path])
        want = odds((x.sum() + b * host_post[r.host]) / (len(x) + b)) - odds(every.mean())
        assert abs(r.shift_quality - want) < 1e-9


def test_odd_rows(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 1), (None, 1, 1), (3, None, 1)], "doc_id long, quality int, toxic int")
    rows = [(1, "fine text"), (2, None), (3, ""), (None, "some words"), (4, "w " * 100000), (4, "w " * 100000)]
    df = docs(rows).withColumn("keep", F.lit("x")).withColumn("host", F.lit(1)).withColumn("t", F.lit(2))
    got = quality.classify(df, labels).collect()
    assert len(got) == len(rows)
    assert [r.keep for r in got if r.doc_id in (2, 3)] == [False, False]
    for empty in (labels.limit(0), labels.where("doc_id IS NULL")):
        assert {r.doc_id for r in quality.classify(df, empty).where("keep").collect()} == {1, None, 4}
    assert quality.classify(df.limit(0), labels).count() == 0
    kept = quality.keep(df, labels.limit(0))
    assert kept.columns == df.columns and kept.count() == 4


M = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def scrambled(x):
    x &= MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def brute_features(text):
    """Buckets and dense features, word by word in plain integers."""
    words = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", text.encode())]
    value = lambda w: sum((b + 1) * pow(M, i, 1 << 64) for i, b in enumerate(w))
    every = [scrambled(value(w) + len(w)) for w in words]
    heads = Counter(scrambled(value(w[:6])) for w in words)
    buckets = {h % quality.BUCKETS for h in every} | {scrambled(h + n) % quality.BUCKETS for h, times in heads.items() for n in (1, 2, 3) if times >= n}
    n = max(1, len(words))
    shares = [min(sum(text.count(c) for c in signs) / n, 5.0) for signs in quality._KINDS.values()]
    return buckets, [*shares, np.log1p(len(words)) / 5, min(len(text) / n, 30.0) / 10, len(set(every)) / n]


def test_scores_and_decisions_match_brute_force(spark, small):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    model = quality.train(docs.select("doc_id", "text"), labels)
    rows, z = docs.collect(), {}
    for r in rows:
        buckets, extra = brute_features(r.text)
        scaled = (np.array(extra) - model["mean"]) / model["spread"]
        z[r.doc_id] = [sum(w for at, w in zip(model[f"seen{k}"], model[f"words{k}"], strict=True) if at in buckets) + model["dense"][k] @ scaled + model["bias"][k] for k in range(2)]
    sites = {}
    for r in quality.posteriors(scored(spark, [(r.source, r.lang, float(z[r.doc_id][0]), float(z[r.doc_id][1])) for r in rows])).collect():
        sites[r.host, r.path] = (r.shift_quality, r.shift_toxic)
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    for r in rows:
        p = [1 / (1 + np.exp(-np.clip(z[r.doc_id][k] + sites[r.source, r.lang][k], -30, 30))) for k in range(2)]
        assert abs(got[r.doc_id].p_quality - p[0]) < 1e-6 and abs(got[r.doc_id].p_toxic - p[1]) < 1e-6
        assert got[r.doc_id].keep == (bool(r.text.split()) and p[0] >= 0.5 and p[1] <= 0.5)


def test_repeated_ids_stay_within_the_bound(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    rows = [(i % 40, f"word{i % 7} " * (1 + i % 5)) for i in range(900)]
    sizes = []
    real = quality.fit
    try:
        quality.fit = lambda rows, *x: sizes.append(len(rows)) or real(rows, *x)
        quality.train(docs(rows).select("doc_id", "text"), labels, 50)
    finally:
        quality.fit = real
    assert sizes == [50]


def test_fit_holds_the_words_of_a_few_rows_at_a_time():
    rnd = np.random.default_rng(2)
    rows = [np.unique(rnd.integers(0, quality.BUCKETS, 2000, dtype=np.int32)) for _ in range(2000)]
    labels = rnd.integers(0, 2, (2000, 2)).astype(float)
    tracemalloc.start()
    model = quality.fit(rows, np.zeros((2000, quality.DENSE)), labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20, peak  # all rows' words are 16 MB, their row numbers 32 MB
    y, held = labels[:, 0], np.bincount(np.concatenate(rows), minlength=quality.BUCKETS)
    assert len(quality.telling(rows, y)) == len(model["seen0"]) and (held[model["seen0"]] >= quality.MIN_DOCS).all()
