from collections import defaultdict

from oracle import agree, connection
from pyspark.sql import functions as F

from reelsieve.llm import sharding


def brute(rows, limit):
    """Split only buckets that are too large, bit by bit."""
    import hashlib

    bits = {r: bin(int(hashlib.md5(f"{r[0]}:{r[1]}".encode()).hexdigest()[:15], 16))[2:].zfill(60) for r in rows}
    out, todo = {}, [("", [r for r in rows if len(r[1].encode()) <= limit])]
    while todo:
        prefix, held = todo.pop()
        if sum(len(r[1].encode()) for r in held) <= limit:
            out |= dict.fromkeys(held, prefix)
        else:
            todo += [(prefix + b, [r for r in held if bits[r][len(prefix)] == b]) for b in "01"]
    return out


def test_directory_matches_splitting(spark, small, docs):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    for limit in (3000, 20000, 10**9):
        got = {(r.doc_id): r for r in sharding.assign(docs(rows), limit).collect()}
        want = brute(rows, limit)
        assert {i: r.shard for i, r in got.items() if not r.shard.startswith("!")} == {k[0]: v for k, v in want.items()}
        assert {i for i, r in got.items() if r.shard.startswith("!")} == {i for i, t in rows if len(t.encode()) > limit}
        held = defaultdict(int)
        for r in got.values():
            held[r.shard] += r.n_bytes
        assert all(r.shard_bytes == held[r.shard] for r in got.values())


def test_sql(spark, middle):
    agree(spark, connection(middle), lambda s, d: sharding.assign(s.read.parquet(f"{d}/documents.parquet"), 200_000), sharding.sql(200_000), middle)


def test_odd_rows(docs):
    rows = [(1, None), (None, None), (2, ""), (3, "y" * 5000)] + [(7, "x" * 100)] * 30 + [(8, "é" * 60)]
    df = docs(rows).withColumn("shard", F.lit("old")).withColumn("leaf", F.lit(1))
    got = sharding.assign(df, 1000).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for r in got:
        sizes[r.shard] += r.n_bytes
    assert all(n <= 1000 or s.startswith("!") for s, n in sizes.items())
    assert len({r.shard for r in got if r.doc_id == 7}) >= 3
    assert [r.n_bytes for r in got if r.doc_id == 8] == [120]
    assert sharding.assign(df.limit(0), 1000).count() == 0


def test_write(docs, tmp_path):
    rows = [(i, f"text {i} " * 20) for i in range(200)]
    sharding.write(docs(rows), str(tmp_path / "out"), 5000)
    back = docs([]).sparkSession.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id, r.text) for r in back.collect()) == rows
    assert back.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("n")).where("n > 5000").count() == 0


def test_copies_lie_apart(docs):
    rows = [(i % 200, f"text {i % 200} " * 10) for i in range(400)] + [(None, "hot " * 10)] * 300
    got = sharding.assign(docs(rows).repartition(7), 2000).collect()
    assert len(got) == len(rows)
    sizes, held = defaultdict(int), defaultdict(list)
    for r in got:
        sizes[r.shard] += r.n_bytes
        held[r.doc_id].append(r.shard)
    assert all(r.shard_bytes == sizes[r.shard] <= 2000 for r in got)
    assert sum(len(set(held[i])) == 2 for i in range(200)) > 150 and len(set(held[None])) > 10
    again = sharding.assign(docs(rows[::-1]).repartition(3), 2000).collect()
    assert sorted((r.shard, repr(r.doc_id)) for r in again) == sorted((r.shard, repr(r.doc_id)) for r in got)


def test_kept_columns_with_clashing_names(docs):
    df = docs([(i, f"text {i}") for i in range(50)]).withColumn("shard", F.lit("mine")).withColumn("shard_", F.lit("too")).withColumn("leaf", F.lit("mine")).withColumn("n_bytes", F.lit(-1)).withColumn("Shard_Docs", F.lit(-2))
    got = sharding.assign(df, 100, keep=True)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard__", "shard_", "leaf", "n_bytes_", "Shard_Docs_", "n_bytes", "shard", "shard_bytes", "shard_docs"]
    assert {(r["shard__"], r["shard_"], r["leaf"], r["n_bytes_"], r["Shard_Docs_"]) for r in got.collect()} == {("mine", "too", "mine", -1, -2)}
