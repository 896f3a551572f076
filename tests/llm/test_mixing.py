import numpy as np
from oracle import agree, connection
from pyspark.sql import functions as F

from reelsieve.llm import mixing


def resharing(sizes):
    """Targets by resharing the excess until none is above its stop."""
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    out, stopped = [0.0] * len(sizes), set()
    left = 1.5 * sum(sizes)
    while True:
        free = [i for i in range(len(sizes)) if i not in stopped]
        if not free:
            break
        total = left - sum(2 * sizes[i] for i in stopped)
        share = {i: total * weights[i] / sum(weights[j] for j in free) for i in free}
        over = {i for i in free if share[i] >= 2 * sizes[i]}
        if not over:
            for i in free:
                out[i] = share[i]
            break
        stopped |= over
    for i in stopped:
        out[i] = 2.0 * sizes[i]
    return out


def test_targets():
    rnd = np.random.default_rng(3)
    for n in (1, 2, 3, 7, 20):
        for _ in range(30):
            sizes = [int(x) for x in rnd.integers(0, 1000, n) ** rnd.integers(1, 3)]
            assert np.allclose(mixing.targets(sizes), resharing(sizes))
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0.0, 0.0]


def test_quotas_add_up_and_are_spread():
    blocks = [100, 7, 0, 900]
    q = mixing.split_quotas(blocks, 13)
    assert q.sum(axis=1).tolist() == blocks and q.min() >= 0
    assert max(q.sum(axis=0)) - min(q.sum(axis=0)) <= 4
    assert (q == mixing.split_quotas(blocks, 13)).all()
    draws = np.stack([mixing.split_quotas([500, 500], 4, seed)[0] for seed in range(300)])
    assert np.allclose(draws.mean(axis=0), 125, atol=3)


def test_mix_meets_its_targets(spark, middle):
    rows = mixing.plan(spark.read.parquet(f"{middle}/documents.parquet"), shards=5).cache()
    assert rows.count() == 1000
    for r in rows.groupBy("source_size", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("copies").alias("most")).collect():
        assert r.most <= 2 and abs(r.taken - r.target) <= 0.03 * r.source_size
    assert {s for r in rows.collect() for s in r.shards} == set(range(5))
    again = mixing.plan(spark.read.parquet(f"{middle}/documents.parquet").repartition(7), shards=5)
    assert sorted((r.doc_id, r.shards) for r in again.collect()) == sorted((r.doc_id, r.shards) for r in rows.collect())


def test_sql(spark, middle):
    agree(spark, connection(middle), lambda s, d: mixing.report(s.read.parquet(f"{d}/documents.parquet")).drop("shards", "source_quotas"), mixing.sql(), middle)


def test_shards_are_filled_by_the_tree(spark, middle, monkeypatch):
    docs = spark.read.parquet(f"{middle}/documents.parquet")
    real = mixing.split_quotas
    rows = mixing.report(docs, shards=5).join(docs.select("doc_id", "source"), "doc_id").collect()
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        quotas = {tuple(map(int, r.source_quotas.split(","))) for r in own}
        assert len(quotas) == 1 and len(next(iter(quotas))) == 5
        # Documents of one block lie in the same shards, so a shard with a quota of blocks has rows and one without has none.
        held = {int(x) for r in own for x in r.shards.split(",") if x}
        assert held == {k for k, q in enumerate(next(iter(quotas))) if q}
    blocks = {r.source: -(-sum(x.source == r.source for x in rows) // mixing.BLOCK_DOCS) for r in rows}
    want = dict(zip(sorted(blocks), real([sum(map(int, next(r.source_quotas for r in rows if r.source == s).split(","))) for s in sorted(blocks)], 5), strict=True))
    assert all(tuple(map(int, r.source_quotas.split(","))) == tuple(want[r.source].tolist()) for r in rows)
    monkeypatch.setattr(mixing, "split_quotas", lambda blocks, shards, seed: np.zeros((len(blocks), shards), dtype=np.int64))
    assert {r.taken for r in mixing.report(docs, shards=5).collect()} == {0}


def test_running_sums_in_ranges(spark):
    rnd = np.random.default_rng(5)
    rows = [("a" if i % 3 else "b", int(rnd.integers(0, 1 << 60)), i, int(rnd.integers(0, 9))) for i in range(500)] + [("c", 7, i, 1) for i in range(20)]
    got = mixing._running(spark.createDataFrame(rows, "src string, h long, i long, v long"), "h", ["i"], F.col("v"), "sum").collect()
    for r in got:
        assert r["sum"] == sum(x[3] for x in rows if x[0] == r.src and (x[1], x[2]) <= (r.h, r.i))


def test_repeated_rows_are_taken_in_part(docs):
    rows = [(1, "a b c", None, "x", 5)] * 40 + [(i, "w " * 100, None, "y", 5) for i in range(2, 30)]
    got = mixing.report(docs(rows)).collect()
    target = next(r.target for r in got if r.doc_id == 1)
    assert len(got) == len(rows) and abs(sum(r.taken for r in got if r.doc_id == 1) - target) <= 3


def test_written_stage_is_in_the_shards_order(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    mixing.in_order(docs).write.parquet(str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.columns == docs.columns
    shard = {}
    for r in mixing.mixed(docs).select("row.doc_id", "shard").collect():
        shard.setdefault(r.doc_id, set()).add(r.shard)
    for file in (tmp_path / "out").glob("part-*.parquet"):
        low = 0
        for r in spark.read.parquet(str(file)).coalesce(1).collect():
            low = min(s for s in shard[r.doc_id] if s >= low)


def test_mixed_rows(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = {r.doc_id: r.copies for r in mixing.plan(docs).collect()}
    got = {r.doc_id: r["count"] for r in mixing.mixed(docs).select("row.*").groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in want.items() if v}
    mixing.write(docs, str(tmp_path / "mix"))
    assert spark.read.parquet(str(tmp_path / "mix")).count() == sum(want.values())


def test_odd_rows(docs):
    rows = [(i, "a b c", None, s, 5) for i, s in enumerate(["x", "y", None, None, "Z", "é"])] + [(7, None, None, "x"), (8, "", None, "w"), (None, "q r", None, "x"), (1, "a b c", None, "y"), (1, "a b c", None, "y")]
    df = docs(rows).withColumn("size", F.lit(1)).withColumn("src", F.lit(1)).withColumn("target", F.lit("t")).withColumn("h", F.lit(0)).withColumn("shards", F.lit(0))
    got = mixing.report(df).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in got)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s))
    wanted = dict(zip(names, resharing([sizes[s] for s in names]), strict=True))
    assert {round(r.target, 9) for r in got} == {round(t, 9) for t in wanted.values()}
    assert mixing.report(df.limit(0)).count() == 0
