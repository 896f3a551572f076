"""Rows that the pipeline's filtering stages have to tell apart, and columns whose names clash with the stages' own."""

import pytest
from pyspark.sql import functions as F

from reelsieve.llm import decontam, quality, simhash

NAMES = ["__d", "__t", "__h", "__p", "__bad", "kept_id", "kept_hash", "kept_host", "bad_id", "bad_hash", "d", "t", "n", "keep", "group", "similarity", "node", "component", "w", "KEPT_PATH"]
TEXT = " ".join(f"word{k}" for k in range(40))


@pytest.fixture()
def clashing(docs):
    def make(rows):
        return docs(rows).withColumns({x: F.lit(k) for k, x in enumerate(NAMES)})

    return make


def test_null_and_empty_are_one_text_and_null_and_least_one_id(clashing):
    rows = [(1, None), (1, ""), (None, "a b"), (-(1 << 63), "a b"), (2, TEXT), (2, TEXT), (3, TEXT + " more"), (4, "other words")]
    df = clashing(rows)
    got = simhash.keep_one(df)
    assert got.columns == df.columns
    kept = sorted(((r.doc_id, r.text or "") for r in got.collect()), key=str)
    assert len(kept) == 4 and [x for x in kept if x[0] == 1] == [(1, "")] and {x[1] for x in kept} == {"", "a b", TEXT, "other words"}
    assert simhash.keep_one(df.limit(0)).count() == 0


def test_decontamination_with_clashing_names(clashing, spark):
    df = clashing([(1, TEXT), (1, "clean words here"), (None, None), (2, "x " * 30 + TEXT), (3, "")])
    bench = spark.createDataFrame([(9, TEXT, 1)], "item_id long, text string, bad_id int")
    got = decontam.clean(df, bench)
    assert got.columns == df.columns and sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(1, "clean words here"), (None, None), (3, "")], key=str)
    assert decontam.clean(df, bench.limit(0)).count() == 5 and decontam.clean(df.limit(0), bench).count() == 0


def test_quality_with_clashing_names(clashing, spark):
    good, bad = "a calm and useful report on rivers ", "buy now click here free win "
    rows = [(i, (good if i % 2 else bad) * (3 + i % 5), "en", f"s{i % 3}") for i in range(60)] + [(90, None), (None, "", None, None), (1, good * 4, "en", "s1")]
    df = clashing(rows)
    labels = spark.createDataFrame([(i, i % 2, 0, 1) for i in range(40)], "doc_id long, quality int, toxic int, kept_id int")
    got = quality.keep(df, labels)
    assert got.columns == df.columns
    kept = [r.doc_id for r in got.collect()]
    assert 90 not in kept and None not in kept and set(range(1, 60, 2)) <= set(kept) and not {0, 2, 4} & set(kept)
    assert quality.keep(df.limit(0), labels).count() == 0
