import random
import re
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from reelsieve.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_print(text, width=3):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    some = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in some]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        up[find(a)] = find(b)
    return [find(i) for i in range(n)]


def test_fingerprint_is_that_of_the_definition():
    for text in ("", " \t\n", "One", "one TWO", "ÀB c\x0bd e\x85f", "a b c a b c a b c", "x " * 70000, "Ünï   cödé ß " * 9):
        assert simhash.fingerprint(text) & (1 << 64) - 1 == brute_print(text)


def test_shingle_hash_is_the_engines_xxhash64(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] == int(next(simhash.shingle_hashes("a B c", 3))[0].astype("<i8"))


def test_components_match_brute_force_on_planted_fingerprints(spark):
    rnd = random.Random(3)
    points = {rnd.getrandbits(64) for _ in range(60)}
    for p in list(points)[:20]:
        for _ in range(12):
            q = p
            for b in rnd.sample(range(64), rnd.choice([1, 2, 2, 3, 4])):
                q ^= 1 << b
            points.add(q)
            p = q if rnd.random() < 0.5 else p
    points = sorted(points)
    signed = [(int(np.uint64(p).astype(np.int64)), i) for i, p in enumerate(points)]
    df = spark.createDataFrame(signed, "fp long, rep long")
    for radius in (1, 2):
        links = [(r.u, r.v) for r in simhash.hamming_links(df, radius).collect()]
        assert all(bin(points[a] ^ points[b]).count("1") <= radius for a, b in links)
        near = [(i, j) for i in range(len(points)) for j in range(i) if bin(points[i] ^ points[j]).count("1") <= radius]
        a, b = union(len(points), links), union(len(points), near)
        assert len(set(zip(a, b, strict=True))) == len(set(a)) == len(set(b))


def test_groups_over_whole_documents(spark, small):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicate_groups(spark.read.parquet(f"{small}/documents.parquet")).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    prints = {i: brute_print(t) for i, t in texts.items()}
    assert {i: g[0] for i, g in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    ids = sorted(texts)
    roots = union(len(ids), [(i, j) for i in range(len(ids)) for j in range(i) if bin(prints[ids[i]] ^ prints[ids[j]]).count("1") <= 2])
    least = defaultdict(list)
    for i, r in zip(ids, roots, strict=True):
        least[r].append(i)
    assert {i: g[1] for i, g in got.items()} == {i: min(least[r]) for i, r in zip(ids, roots, strict=True)}


def test_odd_rows(docs):
    rows = [(5, None), (3, ""), (9, " \n"), (None, "a b c d"), (7, "A b C d"), (7, "A b C d"), (8, "word " * 50000)]
    df = docs(rows).withColumn("fingerprint", F.lit(1)).withColumn("fp", F.lit("x")).withColumn("component_id", F.lit(2))
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicate_groups(df).collect()), key=repr)
    assert len(got) == len(rows)
    zero = "0" * 16
    assert {g for g in got if g[1] == zero} == {(5, zero, 3), (3, zero, 3), (9, zero, 3)}
    assert [g[2] for g in got if g[0] in (None, 7)] == [7, 7, 7]
    assert simhash.near_duplicate_groups(df.limit(0)).count() == 0


def test_keep_one_matches_exact_similarity(spark, docs):
    rnd = random.Random(1)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(25):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(6, 200))]
        texts.append(" ".join(base))
        for _ in range(rnd.randint(0, 6)):
            copy = list(base)
            for _ in range(rnd.randint(0, max(1, len(copy) // 30))):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            texts.append(" ".join(copy).upper() if rnd.random() < 0.2 else " ".join(copy))
    sets = []
    for t in texts:
        w = WORD.findall(lower(t))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    links = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    roots = union(len(texts), links)
    want = {min(i for i, r in enumerate(roots) if r == root) for root in set(roots)}
    kept = simhash.keep_one(docs([(i, t) for i, t in enumerate(texts)]))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r.doc_id for r in kept.collect()} == want


def test_keep_one_of_a_large_group_of_near_copies(docs):
    rnd = random.Random(8)
    base = [f"b{rnd.randrange(10**6)}" for _ in range(150)]
    rows = [(500, " ".join(base))]
    for i in range(120):  # each is similar to the original, but not to the others
        copy = list(base)
        for at in rnd.sample(range(150), 3):
            copy[at] = f"n{i}_{at}"
        rows.append((i, " ".join(copy)))
    assert [r.doc_id for r in simhash.keep_one(docs(rows)).collect()] == [0]


def test_keep_one_of_twins_in_crowded_buckets(docs):
    rnd = random.Random(3)
    passage = [f"p{i}" for i in range(120)]
    rows, sets = [], []
    for i in range(60):  # pairs of twins; all texts share a long passage, so that nearly all of their buckets are crowded
        tail = [f"t{i}_{k}" for k in range(24)]
        for twin in range(2):
            words = passage + tail[: len(tail) - 4] + [f"e{i}_{twin}_{k}" for k in range(rnd.randint(1, 10))]
            rows.append((2 * i + twin, " ".join(words)))
            sets.append({tuple(words[k : k + 5]) for k in range(len(words) - 4)})
    links = [(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    roots = union(len(rows), links)
    want = {min(i for i, r in enumerate(roots) if r == root) for root in set(roots)}
    assert 2 < len(want) < len(rows)
    assert {r.doc_id for r in simhash.keep_one(docs(rows)).collect()} == want


def test_keep_one_of_texts_that_differ_in_how_often_a_line_repeats(docs):
    rows = []
    for i in range(30):
        own = " ".join(f"o{i}_{k}" for k in range(100))
        line = " ".join(f"l{i}_{k}" for k in range(15))
        rows += [(2 * i, f"{own}\n{line}\n{line}"), (2 * i + 1, f"{own}\n" + "\n".join([line] * 20))]
    assert {r.doc_id for r in simhash.keep_one(docs(rows)).collect()} == {2 * i for i in range(30)}


def test_crowd_links_against_all_pairs(spark):
    rnd = np.random.default_rng(6)
    rows, sets = [], []
    for i in range(70):
        base = rnd.integers(0, 1 << 63, 40)
        for _ in range(3):
            one = base.copy()
            some = rnd.random(40) < rnd.choice([0.02, 0.1, 0.3])
            one[some] = rnd.integers(0, 1 << 63, some.sum())
            sets.append(set(one.tolist()))
            rows.append((i % 2, len(rows) // 2 if i < 30 else -1, bytearray(np.unique(one).astype("<u8").tobytes())))
    df = spark.createDataFrame(rows, "key long, c long, shingles binary")
    want = set()
    for i, (k, c, _) in enumerate(rows):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if rows[j][0] == k and rows[j][1] != c and common >= 0.8 * (len(sets[i]) + len(sets[j]) - common):
                want.add((min(c, rows[j][1]), max(c, rows[j][1])))
    for block_texts in (5, 128):
        assert {(r.u, r.v) for r in simhash.crowd_links(df, 0.8, block_texts).collect()} == want
    assert want


def test_keep_one_odd_rows(docs):
    rows = [(1, None), (2, ""), (None, "a b"), (4, "a b"), (4, "a b"), (6, "other words here"), (6, "quite different text")]
    got = sorted(((r.doc_id, r.text) for r in simhash.keep_one(docs(rows)).collect()), key=repr)
    assert got == sorted([(1, None), (None, "a b"), (6, "other words here"), (6, "quite different text")], key=repr)
    assert simhash.keep_one(docs(rows).limit(0)).count() == 0


def test_rows_without_an_id_link_others_and_ids_with_two_texts_stay_apart(spark, monkeypatch):
    prints = [(1, 0), (None, 3), (4, 15), (7, 0xFFF << 20), (7, 0xFFFF << 44), (9, 0xFFFF << 44 | 1), (None, -1)]
    rows = spark.createDataFrame(prints, "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: rows)
    got = sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in simhash.near_duplicate_groups(rows).collect()), key=repr)
    unsigned = [(i, p & (1 << 64) - 1) for i, p in prints]
    roots = union(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if bin(unsigned[i][1] ^ unsigned[j][1]).count("1") <= 2])
    least = {r: min((unsigned[i][0] for i, q in enumerate(roots) if q == r and unsigned[i][0] is not None), default=None) for r in roots}
    assert got == sorted(((i, p, least[r]) for (i, p), r in zip(unsigned, roots, strict=True)), key=repr)
    assert [c for i, _, c in got if i == 7] == [7, 7] and {c for i, _, c in got if i in (1, 4)} == {1}


def test_keep_one_finds_the_closest_texts_by_the_hamming_tables(docs, monkeypatch):
    rnd = random.Random(11)
    texts = []
    for g in range(6):
        base = [f"v{rnd.randrange(10**5)}" for _ in range(500)]
        texts.append(" ".join(base))
        for _ in range(8):
            copy = list(base)
            for _ in range(rnd.choice([1, 1, 2, 20])):
                copy[rnd.randrange(500)] = f"n{rnd.randrange(10**5)}"
            texts.append(" ".join(copy))
    texts += [texts[0].upper(), texts[0], "", " "]
    prints = [brute_print(t) for t in texts]
    roots = union(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 2])
    want = {min(i for i, r in enumerate(roots) if r == root) for root in set(roots)}
    assert 10 < len(want) < len(texts) - 10
    # Without the bands the tables are the only search; every pair within two bits here is similar enough.
    none = lambda points: (points.selectExpr("w a", "w b").limit(0), points.selectExpr("w key", "w").limit(0))
    monkeypatch.setattr(simhash, "band_pairs", none)
    assert {r.doc_id for r in simhash.keep_one(docs(list(enumerate(texts)))).collect()} == want


def test_keep_one_checks_what_the_hamming_tables_find(docs):
    line = " ".join(f"l{k}" for k in range(13))
    rows = [(i, "\n".join([line] * 400) + f"\n{' '.join(f'o{i}_{k}' for k in range(30))}") for i in range(2)]
    assert bin(brute_print(rows[0][1]) ^ brute_print(rows[1][1])).count("1") <= 2  # the repeated line decides every bit
    assert {r.doc_id for r in simhash.keep_one(docs(rows)).collect()} == {0, 1}
