import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from reelsieve.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def test_stages_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = {r.doc_id for r in quality.classify(docs, spark.read.parquet(f"{small}/labels.parquet")).where("keep").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in kept}
    sets = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} for i, t in texts.items() for w in [words(t)]}
    group = {i: i for i in texts}
    for i in sorted(texts):
        for j in sorted(texts):
            if j < i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = {k: min(a, b) if g in (a, b) else g for k, g in group.items()}
    unique = {i for i in texts if group[i] == i}
    bench = [(r.item_id, words(r.text)) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    grams = {i: [tuple(w[j : j + 5]) for j in range(len(w) - 4)] for i, t in texts.items() for w in [words(t)]}
    bad = set()
    for i in unique:
        for _, item in bench:
            want = Counter(tuple(item[j : j + 5]) for j in range(len(item) - 4))
            n = max(1, min(len(item), len(words(texts[i]))) - 4)
            if not set(want) & set(grams[i]):
                continue
            for s in range(len(grams[i]) - n + 1):
                have = Counter(grams[i][s : s + n])
                common = sum((have & want).values())
                if common >= 0.8 * (sum(have.values()) + sum(want.values()) - common):
                    bad.add(i)
    clean = unique - bad
    out = corpus_pipeline.run(spark, small)
    rows = out.collect()
    times = Counter(r.doc_id for r in rows)
    assert set(times) <= clean and max(times.values()) <= 2
    assert all(r.text == texts[r.doc_id] for r in rows)
    sizes, taken = Counter(), Counter()
    source = {r.doc_id: r.source for r in docs.collect()}
    for i in clean:
        sizes[source[i]] += len(words(texts[i]))
    for i, n in times.items():
        taken[source[i]] += n * len(words(texts[i]))
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 0.15 * sum(sizes.values())
    held = Counter()
    for r in rows:
        held[r.shard] += r.n_bytes
    assert all(r.shard_bytes == held[r.shard] for r in rows)


def test_stages_keep_the_columns_and_odd_rows(spark, small, tmp_path):
    odd = spark.createDataFrame([(10**6, None, None, None, None), (None, "no id here at all", "en", "src1", 3), (10**6 + 1, "", "en", None, 0)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = spark.read.parquet(f"{small}/documents.parquet").unionByName(odd).unionByName(odd).withColumn("shard", F.lit("mine"))
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
        if name != "sharding":
            assert docs.columns == names
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), small).count() == 0
