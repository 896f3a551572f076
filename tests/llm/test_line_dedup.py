import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelsieve.llm import line_dedup


def words(n, tag):
    return " ".join(f"{tag}{i}" for i in range(n))


def test_repeated_passage_goes_from_the_later_document(docs):
    passage = words(20, "p") + "\nAs.\n" + words(35, "q")
    rows = [(1, "intro one\n" + passage + "\nend one"), (2, words(40, "z")), (3, "As.\nother\n" + passage + "\nend three"), (4, passage), (5, words(40, "z") + " x")]
    got = {r.doc_id: r for r in line_dedup.dedup(docs(rows)).collect()}
    assert got[1].text == rows[0][1] and got[2].text == rows[1][1] and got[5].text == rows[4][1]
    assert (got[3].text, got[3].n_removed, got[3].n_lines, got[3].from_docs) == ("As.\nother\nend three", 3, 6, "1")
    assert (got[4].text, got[4].n_removed, got[4].from_docs) == ("", 3, "1")


def test_short_common_lines_stay(docs):
    rows = [(i, f"All rights reserved.\n{words(25, f'd{i}_')}\nThe end.") for i in range(6)]
    assert all(r.n_removed == 0 and r.text == rows[r.doc_id][1] for r in line_dedup.dedup(docs(rows)).collect())


def test_no_repeated_run_is_left(docs):
    rnd = random.Random(4)
    pool = [words(rnd.randint(1, 25), f"l{i}_") for i in range(60)]
    passages = [[rnd.choice(pool) for _ in range(rnd.randint(2, 7))] for _ in range(8)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rnd.randint(1, 4)):
            lines += rnd.choice(passages) if rnd.random() < 0.5 else [words(rnd.randint(1, 30), f"own{i}_{rnd.random()}")]
        rows.append((i, "\n".join(lines)))
    got = {r.doc_id: r for r in line_dedup.dedup(docs(rows)).collect()}
    first = {}
    for i, text in rows:
        for k in line_dedup.line_keys(text)[2]:
            first.setdefault(k, i)
    touched = {i for i, text in rows if any(first[k] < i for k in line_dedup.line_keys(text)[2])}
    assert {i for i, r in got.items() if r.n_removed} == touched
    for i, r in got.items():
        kept = r.text.split("\n")
        assert not r.n_removed or len(kept) + r.n_removed == r.n_lines or r.text == ""


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=25), st.lists(st.integers(0, 6), max_size=25))
def test_patience_aligns_equal_lines_in_order(a, b):
    pairs = line_dedup.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))
    if a == b:
        assert len(pairs) == len(a)
    assert bool(pairs) == bool(set(a) & set(b))


def test_moved_blocks_are_all_found():
    a = [[f"{t}{i}" for i in range(5)] for t in "xyz"]
    later, earlier = a[2] + ["new"] + a[0] + a[1], a[0] + a[1] + a[2]
    assert line_dedup.common_blocks(later, [10] * len(later), earlier, 30) == [(0, 5), (6, 16)]


def test_passage_that_crosses_short_common_lines():
    later, words_of = ["passage", "own1", "share", "own2", "rights", "own3"], [60, 5, 2, 5, 3, 5]
    earlier = ["share", "other1", "rights", "other2", "passage", "other3"]
    assert line_dedup.common_blocks(later, words_of, earlier, 30) == [(0, 1)]
    # Of several lines, with a tail that holds too few words for a run of its own.
    later, words_of = ["p1", "", "p2", "p3", "own1", "share", "own2", "tel", "own3", "rights"], [20, 0, 20, 4, 5, 2, 5, 1, 5, 3]
    earlier = ["share", "x1", "tel", "x2", "rights", "x3", "p1", "", "p2", "p3", "x4"]
    assert line_dedup.common_blocks(later, words_of, earlier, 30) == [(0, 4)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=25), st.lists(st.integers(0, 9), max_size=25))
def test_no_shared_run_of_the_pair_is_left(later, earlier):
    size = [0, 1, 2, 3, 5, 8, 12, 20, 29, 31]
    n = [size[x] for x in later]
    found = line_dedup.common_blocks(later, n, earlier, 30)
    runs = {tuple(earlier[i:k]) for i in range(len(earlier)) for k in range(i + 1, len(earlier) + 1)}
    gone = {i for a, b in found for i in range(a, b)}
    # Every deleted line lies in a block that the earlier document holds.
    whole = {x for i in range(len(later)) for k in range(i + 1, len(later) + 1) if sum(n[i:k]) >= 30 and tuple(later[i:k]) in runs for x in range(i, k)}
    assert gone <= whole
    # And every line of such a block is deleted, but for empty ones at its ends.
    assert {x for x in whole if n[x]} <= gone


def test_a_block_that_the_first_holder_has_only_in_part(docs):
    """C shares P with A, and P Q R with B: Q and R go too, though their only long line leads to A."""
    p, q, r = words(35, "p"), words(10, "q"), words(10, "r")
    rows = [(1, p), (2, f"{p}\n{q}\n{r}"), (3, f"{p}\n{q}\n{r}"), (4, f"{q}\n{r}\nown"), (5, f"own\n{q}\n{r}\n{p}")]
    got = {x.doc_id: (x.text, x.n_removed, x.from_docs) for x in line_dedup.dedup(docs(rows)).collect()}
    assert got == {1: (p, 0, ""), 2: (f"{q}\n{r}", 1, "1"), 3: ("", 3, "1,2"), 4: (f"{q}\n{r}\nown", 0, ""), 5: (f"own\n{q}\n{r}", 1, "1")}


def test_odd_rows(docs):
    long = words(40, "r")
    rows = [(1, None), (2, ""), (3, "\n\n"), (None, long), (4, long), (4, long), (6, long + "\n"), (7, "x " * 200000)]
    df = docs(rows).withColumn("d", F.lit(1)).withColumn("s", F.lit(1)).withColumn("ranges", F.lit(0)).withColumn("n_lines", F.lit(0))
    got = sorted(((r.doc_id, r.text, r.n_removed, r.from_docs) for r in line_dedup.dedup(df).collect()), key=repr)
    assert len(got) == len(rows)
    assert (None, long, 0, "") in got and (1, "", 0, "") in got and (2, "", 0, "") in got and (3, "\n\n", 0, "") in got and (7, "x " * 200000, 0, "") in got
    assert [g[1:3] for g in got if g[0] == 4] == [("", 1), ("", 1)]
    assert [g[1:3] for g in got if g[0] == 6] == [("", 1)]
    assert line_dedup.dedup(df.limit(0)).count() == 0


def brute(rows, least=30):
    """Lines of each document that lie in a common block of least words with any earlier document: all pairs."""
    cut = {i: [x.strip() for x in t.split("\n")] for i, t in rows}

    def blocks(a, b):
        out = set()
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                    k += 1
                if sum(len(x.split()) for x in a[i : i + k]) >= least:
                    out |= set(range(i, i + k))
        return out

    out = {}
    for i, text in rows:
        gone = set().union(*(blocks(cut[i], cut[p]) for p in cut if p < i))
        out[i] = ("\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone), len(gone))
    return out


def test_text_matches_brute_force(docs):
    rnd = random.Random(11)
    passages = [[words(rnd.randint(1, 20), f"p{i}_{k}_") for k in range(rnd.randint(2, 6))] for i in range(12)]
    rows = []
    for i in range(80):
        lines = []
        for p in rnd.sample(passages, rnd.randint(0, 3)):
            lines += p[: rnd.randint(1, len(p))] if rnd.random() < 0.3 else p
            lines += [words(rnd.randint(1, 12), f"own{i}_{rnd.random()}_") for _ in range(rnd.randint(0, 2))]
        rows.append((i, "\n".join(lines)))
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup(docs(rows)).collect()}
    want = brute(rows)
    assert got == want and sum(n for _, n in want.values()) > 50


def test_long_texts_with_many_partners(docs):
    rows = [(i, "\n".join(words(40, f"m{i}_{k}_") for k in range(3))) for i in range(300)]
    rows.append((1000, "\n".join(t for _, t in rows) + "\n" + "\n".join(f"own line {k}" for k in range(20000))))
    got = {r.doc_id: r for r in line_dedup.dedup(docs(rows)).collect()}
    assert got[1000].n_removed == 900 and got[1000].text == "\n".join(f"own line {k}" for k in range(20000))
