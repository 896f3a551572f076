"""Captions and replies against plain Python, with the cases that earlier versions got wrong."""

import re

import pytest

from reelsieve import config
from reelsieve.functions import columns as C
from reelsieve.operators import sampling, validation
from pyspark.sql import functions as F

TEXTS = [
    "Output: A red car on a road.", "RESULT: \"a quiet street\" and more", "output:   \nsecond line is here", "Final: Step 1 of it\n</think> The answer < more", "x</THINK>\n\n A lake\nat dawn", "</think>",
    "Thinking process: a\n\nThe lake\nrest", "thinking Process:\n- Analyze it\nno", "Process this line of text", "A line that is long enough\nshort", "1. first thing to do\n2. second thing to do", "some words\n   \nThe last full line.  \n", "", "short", "Rewritten: Thinking it over\nThe last line is good",
    "no mark\nbut Step by Step it ends", "Cleaned caption: 'x'", "Result: \t \nanother good long line",
]


def answer(text):
    for p in config.ANSWER_PATTERNS:
        m = re.search(p, text, re.IGNORECASE | re.DOTALL)
        if m and not any(w in m.group(1).strip() for w in ("Analyze", "Step", "Process", "Thinking")):
            return m.group(1).strip()
    lines = [x.strip() for x in text.split("\n") if len(x.strip()) > 10]
    if lines and not any(w in lines[-1] for w in ("Analyze", "Step", "Process", "Thinking", "1.", "2.")):
        return lines[-1]
    return text


def test_answers_of_replies(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i int, x string").select("i", C.final_answer(F.col("x")).alias("a")).collect()
    assert {r.i: r.a for r in rows} == {i: answer(x) for i, x in enumerate(TEXTS)}


@pytest.mark.parametrize("least", [0, 10, 50])
def test_captions(spark, least):
    texts = ["", "  ", "N/A", "none", " No Caption ", "null", "TBD", "todo", "caption", None, "a" * 9, " " + "b" * 10 + " ", "c" * 50]
    got = {r.i: r.w for r in spark.createDataFrame(list(enumerate(texts)), "i int, x string").select("i", C.caption_reason(F.col("x"), least).alias("w")).collect()}
    for i, x in enumerate(texts):
        t = (x or "").strip()
        bad = least and (t.lower() in ("", "n/a", "none", "no caption", "null", "tbd") or len(t) < least)
        assert got[i] == (f"caption_len={len(t)} < {least} or placeholder" if bad else None)


def test_strata_follow_the_engines_reasons(spark):
    """A flag for its caption alone, its jumps alone or its saturation alone is near a threshold; one for a camera word is not."""
    rows = [(1, 0, "no caption", [], 5.0), (2, 12, "d" * 60, [], 5.0), (3, 0, "d" * 60, ["pan left"], 5.0), (4, 0, "d" * 60, [], 200.0), (5, 12, "", [], 5.0), (6, 0, "d" * 60, [], 5.0), (7, 60, "", [], 5.0)]
    df = spark.createDataFrame(rows, "id int, n_jumps int, caption string, words array<string>, sat double").withColumn("hard_reasons", F.array().cast("array<string>"))
    v, why = validation.stage1(df, F.lit(50), F.lit(10), F.lit(50), F.col("words"), (F.col("sat"), F.lit(0.0), F.lit(180.0)))
    judged = df.select("id", F.lit("g").alias("g"), v.alias("verdict"), why.alias("why"))
    assert {r.id: r.verdict for r in judged.collect()} == {1: "flag", 2: "flag", 3: "flag", 4: "flag", 5: "flag", 6: "pass", 7: "fail"}
    flags = sampling.stratified_flags(judged.where("verdict = 'flag'"), "g", "id", "why", 10)
    assert {r.id: r.stratum for r in flags.collect()} == {1: "boundary", 2: "boundary", 3: "single", 4: "boundary", 5: "multi"}
