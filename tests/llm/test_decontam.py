import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from reelsieve.llm import decontam, vectors

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def shingles(w, width):
    return [tuple(w[i : i + width]) for i in range(len(w) - width + 1)]


def brute(docs, items):
    """All pairs with a window of similarity 0.8 or more, by comparing every window."""
    out = {}
    for d, text in docs:
        w = words(text or "")
        for i, item in items:
            v = words(item or "")
            if not v or not w:
                continue
            width, size = min(5, len(v)), min(len(v), len(w))
            want = Counter(shingles(v, width))
            for s in range(len(w) - size + 1):
                have = Counter(shingles(w[s : s + size], width))
                common = sum((have & want).values())
                union = sum(have.values()) + sum(want.values()) - common
                if union and common / union >= 0.8 and common:
                    out[d, i] = max(out.get((d, i), 0), common / union)
    return out


def planted():
    rnd = random.Random(6)
    vocabulary = [f"v{i}" for i in range(400)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(n))) for i, n in enumerate([1, 2, 4, 5, 6, 9, 15, 22, 40, 40, 60, 59, 30])]
    items += [(90, items[7][1]), (91, ""), (92, None), (93, "rep rep rep rep rep rep rep rep rep rep")]
    docs = []
    for d in range(140):
        w = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 120))]
        for _ in range(rnd.randint(0, 2)):
            item = words(items[rnd.randrange(13)][1])
            for _ in range(min(len(item), rnd.choice([0, 0, 0, 1, 1, 2, 4]))):
                at = rnd.randrange(len(item))
                change = rnd.choice("rid")
                item = item[:at] + ([] if change == "d" else ["odd"] if change == "r" else ["odd", item[at]]) + item[at + 1 :]
            at = rnd.randint(0, len(w))
            w = w[:at] + [x.upper() if rnd.random() < 0.1 else x for x in item] + w[at:]
        docs.append((d, rnd.choice([" ", "\n", " \t "]).join(w)))
    docs += [(900, items[10][1]), (901, " ".join(words(items[10][1])[:-2])), (902, "rep " * 40), (903, None), (904, "")]
    return docs, items


def test_matches_brute_force(spark, docs):
    rows, items = planted()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.contaminated(docs(rows), bench).collect()}
    want = brute(rows, items)
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    sliced = decontam.contaminated(docs(rows), bench, slice_bytes=300)
    assert {(r.doc_id, r.item_id) for r in sliced.collect()} == set(want)


def test_block_index_finds_all_within_the_radius():
    rnd = np.random.default_rng(1)
    prints = rnd.integers(0, 1 << 63, 200, dtype=np.uint64)
    probes = prints[rnd.integers(0, 200, 500)].copy()
    for k in range(500):
        for b in rnd.choice(64, rnd.integers(0, 30), replace=False):
            probes[k] ^= np.uint64(1) << np.uint64(b)
    for radius in (0, 3, 24):
        found = {(int(p), i) for at, i in decontam.BlockIndex(prints, radius).near(probes) for p in at}
        assert found == {(p, i) for p in range(500) for i in range(200) if int(probes[p] ^ prints[i]).bit_count() <= radius}


def test_long_texts_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(4000)) + "x" * 50
    whole = [h.tolist() for _, _, h in vectors.words([text])]
    monkeypatch.setattr(vectors, "PIECE", 100)
    assert [h.tolist() for _, _, h in vectors.words([text])] == whole


def test_odd_rows(spark, docs):
    bench = spark.createDataFrame([(1, "one two three four five six"), (1, "one two three four five six"), (None, "seven")], "item_id long, text string")
    df = docs([(None, "seven"), (5, "x one two three four five six y"), (5, "x one two three four five six y"), (6, None)]).withColumn("item_id", F.lit(0)).withColumn("similarity", F.lit(0))
    got = sorted(((r.doc_id, r.item_id, r.similarity, r.first_word, r.n_words) for r in decontam.contaminated(df, bench).collect()), key=repr)
    assert got == sorted([(None, None, 1.0, 0, 1)] + [(5, 1, 1.0, 1, 6)] * 4, key=repr)
    assert decontam.contaminated(df.limit(0), bench).count() == decontam.contaminated(df, bench.limit(0)).count() == 0


def test_clean_rows_of_a_repeated_id_stay(spark, docs):
    item = " ".join(f"q{i}" for i in range(40))
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, item), (None, "a clean text"), (None, None), (5, "before " + item + " after"), (5, "another clean text"), (6, item), (7, "")]
    got = sorted(((r.doc_id, r.text) for r in decontam.clean(docs(rows), benchmark).collect()), key=repr)
    assert got == sorted([(None, "a clean text"), (None, None), (5, "another clean text"), (7, "")], key=repr)


def test_what_each_step_passes_on(monkeypatch):
    """Windows come from shared shingles, the blocks keep all within the radius, and exact similarity decides: counted on planted texts."""
    rows, items = planted()
    bench = decontam.Benchmark([(i, t) for i, t in items if t])
    n = Counter()
    near, verify = decontam.BlockIndex.near, decontam.Benchmark._verify

    def counted(self, prints):
        within = np.bitwise_count(prints[:, None] ^ self.prints[None, :]) <= decontam.RADIUS
        found = near(self, prints)
        n.update(windows=len(prints), pairs=within.size, within=int(within.sum()), near=sum(len(at) for at, _ in found))
        return found

    def verified(self, *given):
        found = verify(self, *given)
        n.update(verified=len(found))
        return found

    monkeypatch.setattr(decontam.BlockIndex, "near", counted)
    monkeypatch.setattr(decontam.Benchmark, "_verify", verified)
    texts = [t or "" for _, t in rows]
    bench.search(texts)
    every = sum(max(0, len(words(t)) - size + 1) for t in texts for size in bench.index)
    assert n["near"] == n["within"]  # the blocks lose nothing that the radius holds
    assert n["verified"] < n["near"] < n["pairs"] and n["windows"] < every / 2
