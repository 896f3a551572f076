"""Spelling variants against plain edit neighbourhoods: the automaton, the search in blocks, whole texts and the edge cases."""

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from oracle import agree, connection
from reelsieve.llm import queries, spelling

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def neighbours(word: str) -> set[str]:
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in LETTERS}
        if i < len(word):
            out |= {word[:i] + c + word[i + 1 :] for c in LETTERS} | {word[:i] + word[i + 1 :]}
    return out - {word}


def brute(rows: list[tuple], min_length: int = 6, min_count: int = 5) -> dict[str, tuple]:
    """The contract, word by word over all edits."""
    counts: Counter = Counter()
    for doc_id, text in rows:
        at, run = 0, ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % 199 == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                counts[run] += 1
            run = ""
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    near = {w: sorted(neighbours(w) & words.keys(), key=lambda x: (-words[x], x)) for w in words}
    form = {w: near[w][0] if near[w] and words[near[w][0]] >= 5 * words[w] else None for w in words}

    def root(w: str) -> str:
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def result(df) -> dict[str, tuple]:
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_automaton_numbers_and_shares_states():
    words = sorted({b"", b"tap", b"taps", b"top", b"tops", b"tapping", b"topping"})
    a = spelling.Automaton(words)
    for k, w in enumerate(words):
        state, number = a.walk(w)
        assert (number, a.final[state]) == (k, True)
    assert a.walk(b"tq") == (-1, 0)
    assert a.walk(b"tap")[0] == a.walk(b"top")[0], "equal rests are one state"
    assert len(spelling.Automaton([bytes([x, y]) for x in range(97, 117) for y in range(97, 117)]).steps) == 3
    assert spelling.Automaton([]).walk(b"") == (0, 0) and not spelling.Automaton([]).final[0]


def _random_words(seed: int, n: int, alphabet: str) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(6, 9))) for _ in range(n)]


@pytest.mark.parametrize("alphabet", ["ab", "abé", "abcdef"])
def test_random_words_have_all_near_words(docs, alphabet):
    rng = random.Random(3)
    words = _random_words(1, 150, alphabet)
    words += [w[:k] + rng.choice(["", "a", "ba"]) + w[k + 1 :] for w in words for k in [rng.randrange(len(w))]]
    rows = [(k, " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=400))) for k in range(40)]
    want = brute(rows)
    assert result(spelling.variants(docs(rows))) == want
    assert sum(x[3] for x in want.values()) > 0 and any(x[0] for x in want.values())


def test_groups_in_blocks_lose_nothing(spark, monkeypatch):
    """A third of the words share their first or last half; groups of more than BLOCK words are searched block by block."""
    monkeypatch.setattr(spelling, "BLOCK", 7)
    rng = random.Random(5)
    words = {x: rng.randint(5, 500) for x in ["abcabc" + w[:4] for w in _random_words(2, 150, "abc")] + [w[:4] + "abcabc" for w in _random_words(3, 150, "abc")] + _random_words(4, 150, "ab")}
    got = {r.word: (r.n_near, r.form, r.form_n) for r in spelling.near_words(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    want = {}
    for w in words:
        if near := sorted(neighbours(w) & words.keys(), key=lambda x: (-words[x], x)):
            want[w] = (len(near), near[0], words[near[0]])
    assert got == want
    grouped = spelling._grouped(spark.createDataFrame(list(words.items()), "word string, n long"), 6)
    assert grouped.agg(F.max("slot")).first()[0] > 0


def test_roots_follow_long_ways(spark):
    n = 40
    forms = spark.createDataFrame([(f"w{k:02}", f"w{k + 1:02}") for k in range(n)] + [("x", "w39")], "word string, form string")
    assert {r.word: r.root for r in spelling.roots(forms).collect()} == {**{f"w{k:02}": f"w{n}" for k in range(n)}, "x": f"w{n}"}


def test_ties_nulls_repeats_and_clashing_columns(spark):
    text = "Gardens " * 30 + "gardenx " * 6 + "gardeny " * 6 + "ÉCOLES École écoles " * 5 + "shorts " + "日本語abcdefg日本 " * 5
    rows = [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "12 ?! 日本")]
    df = spark.createDataFrame([(*r, "n", 1, "w") for r in rows], "doc_id long, text string, word string, n long, form string")
    got = result(spelling.variants(df))
    assert got == brute(rows)
    assert got["gardenx"][0] == "gardens" and got["gardens"][3] >= 2
    assert "abcdefg" in got and all(w == w.lower() or "É" in w for w in got)


def test_very_long_text_and_word(spark):
    rows = [(7, "lantern lanterns " * 40_000 + "a" * 30_000), *[(8, "a" * 30_000 + " " + "a" * 29_999 + "b")] * 6]
    got = result(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got["a" * 30_000][3] == 1 and got["a" * 29_999 + "b"][3] == 1
    # The checksum may take a letter from all runs of one text.
    assert sum(x[2] for w, x in got.items() if w[0] == "l") == 80_000


def test_empty_tables(spark, docs):
    assert spelling.variants(docs([], "doc_id long, text string")).count() == 0
    assert spelling.variants(docs([(1, None), (2, "a bc")])).count() == 0


def test_query_against_its_sql(spark, small):
    name = "op11_spelling_variants"
    agree(spark, connection(small), queries.queries()[name], queries.oracle_sql()[name], small)
