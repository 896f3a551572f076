"""Ledgers of passes, worker files, colour and the running average with late events."""

import json
import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from reelsieve.operators import colour, ledger
from reelsieve.streaming import clips


@pytest.fixture()
def halved():
    def work(row):
        if row["n"] is None or row["n"] % 5 == 0:
            raise ValueError(f"bad {row['n']}")
        return row["n"] / 2

    return work


def table(df):
    return {r.k: (r.run, r.ok, r.result, r.error) for r in df.collect()}


def test_a_stopped_run_and_its_resumption_are_one_run(spark, tmp_path, halved):
    df = spark.createDataFrame([(f"s{i}", float(i), "x") for i in range(50)] + [("none", None, "x")], "k string, n double, ok string")
    whole = table(ledger.run(df, "k", halved, "double", str(tmp_path / "one"), 1, parts=5))
    assert len(whole) == 51 and whole["s7"] == (1, True, 3.5, None) and whole["s10"] == (1, False, None, "ValueError: bad 10.0")
    half = table(ledger.run(df, "k", halved, "double", str(tmp_path / "two"), 1, parts=5, stop_after=2))
    assert 0 < len(half) < 51
    again = table(ledger.run(df, "k", halved, "double", str(tmp_path / "two"), 2, parts=5))
    assert {k: v[1:] for k, v in again.items()} == {k: v[1:] for k, v in whole.items()}
    assert {k for k, v in again.items() if v[0] == 1} == half.keys(), "what is done is not done again"
    assert spark.read.parquet(str(tmp_path / "two")).count() == 51
    ledger.run(df, "k", halved, "double", str(tmp_path / "two"), 3, parts=5)
    assert spark.read.parquet(str(tmp_path / "two")).count() == 51


def test_failures_are_tried_again_on_request(spark, tmp_path, halved):
    df = spark.createDataFrame([(f"s{i}", float(i)) for i in range(20)], "k string, n double")
    ledger.run(df, "k", halved, "double", str(tmp_path), 1, parts=2)
    got = table(ledger.run(df, "k", lambda row: -row["n"] if row["n"] != 5 else 1 / 0, "double", str(tmp_path), 2, parts=2, retry=True))
    assert got["s1"] == (1, True, 0.5, None) and got["s10"] == (2, True, -10.0, None) and got["s5"] == (2, False, None, "ZeroDivisionError: division by zero")
    assert {r.k: (r.n_ok, r.n_fail, r.first_error, r.share) for r in ledger.counts(ledger.latest(spark.read.parquet(str(tmp_path)), "k").withColumn("k", F.lit("all")), "k").collect()} == {"all": (19, 1, "ZeroDivisionError: division by zero", 0.95)}
    assert table(ledger.run(df.limit(0), "k", halved, "double", str(tmp_path / "none"), 1, parts=1)) == {}


def test_union_of_worker_files(spark, tmp_path):
    for w, lines in {"w000": [{"id": "a", "v": 1}, {"id": "b", "v": 2}, "{broken", ""], "w001": [{"id": "b", "v": 9}, {"v": 3}, {"id": "c", "v": 4}, {"id": "c", "v": 5}]}.items():
        (tmp_path / w).mkdir()
        (tmp_path / w / "results.jsonl").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    (tmp_path / "w001/notes.txt").write_text("no line")
    rows, bad = ledger.worker_lines(spark, str(tmp_path), "id string, v int", "id")
    assert sorted(map(tuple, rows.collect())) == [("w000", "a", 1), ("w000", "b", 2), ("w001", "c", 5)]
    assert sorted(map(tuple, bad.collect())) == [("w000", "{broken"), ("w001", '{"v": 3}')]


def pixel(r, g, b):
    high, low = max(r, g, b), min(r, g, b)
    return ((high - low) * round((255 << 12) / high) + 2048) >> 12 if high else 0


def test_saturation(spark):
    draw = random.Random(1)
    frames = [[draw.randrange(256) for _ in range(3 * n)] for n in (1, 7, 40)] + [[0] * 9, [255, 0, 0], [9, 9, 9], None, []]
    df = spark.createDataFrame([(i % 2, i, p) for i, p in enumerate(frames)] + [(9, 0, None)], "clip int, t int, pixels array<int>")
    mean = lambda p: sum(pixel(*p[i : i + 3]) for i in range(0, len(p), 3)) / (len(p) // 3)
    got = {r.clip: (r.n_frames, r.saturation) for r in colour.clip_saturation(df, "clip", "pixels").collect()}
    for c in (0, 1):
        means = [mean(p) for i, p in enumerate(frames) if i % 2 == c and p]
        assert got[c][0] == len(means) and math.isclose(got[c][1], sum(means) / len(means))
    assert got[9] == (0, 0.0)
    for r, g, b in [(draw.randrange(256), draw.randrange(256), draw.randrange(256)) for _ in range(50)]:
        assert abs(pixel(r, g, b) - (255 * (max(r, g, b) - min(r, g, b)) / max(r, g, b, 1))) <= 0.6
    with pytest.raises(PySparkException, match="whole pixels"):
        colour.clip_saturation(spark.createDataFrame([(1, [1, 2])], "clip int, pixels array<int>"), "clip", "pixels").collect()


def test_running_ema_over_three_batches_with_late_events(spark, tmp_path):
    """Events within the watermark are folded in their own order however they arrive; those behind it are dropped."""
    clips.use_state_store(spark)
    start = datetime(2024, 1, 1)
    at = lambda m: start + timedelta(minutes=m)
    batches = [
        [("a", at(0), 10.0), ("a", at(5), 20.0), ("b", at(1), None), ("b", at(2), 4.0), ("a", at(20), 30.0)],
        [("a", at(13), 99.0), ("a", at(12), float("nan")), ("b", at(25), 8.0), ("a", at(40), 40.0)],
        [("a", at(90), 0.0), ("b", at(90), 0.0), ("b", at(3), 77.0), ("b", at(31), 6.0)],
    ]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "clip string, ts timestamp, x double").coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/batch={k}"))
    # Files of one folder, in the order in which they were written, one a batch.
    stream = spark.readStream.schema("clip string, ts timestamp, x double").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(str(tmp_path / "in"))
    out = clips.running_ema(stream, "clip", "ts", "x", 0.5, "10 minutes")
    run = out.writeStream.format("memory").queryName("running").outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert run.exception() is None
    got = {}
    for r in spark.table("running").orderBy("clip", "time", "n").collect():
        got.setdefault(r.clip, []).append(((r.time - start).seconds // 60, r.n, r.ema))
    # The first batch ends at minute 20, so the watermark is at 10 for the second, and b's event of minute 3 in the third is too late.
    assert got["a"] == [(0, 1, 10.0), (5, 2, 15.0), (12, 3, 15.0), (13, 4, 57.0), (20, 5, 43.5), (40, 6, 41.75)]
    assert got["b"] == [(1, 1, None), (2, 2, 4.0), (25, 3, 6.0), (31, 4, 6.0)]
