"""Series kernels against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from reelsieve.operators import series


def folded(xs, momentum):
    out, last = [], None
    for x in xs:
        if x is not None and math.isfinite(x):
            last = x if last is None else momentum * last + (1 - momentum) * x
        out.append(last)
    return out


@pytest.mark.parametrize("momentum", [0.3, 0.9, 0.99])
def test_ema_is_carried_over_batches(spark, momentum):
    draw = random.Random(3)
    bad = [None, math.nan, math.inf]
    clips = {
        1: [draw.choice(bad) if draw.random() < 0.2 else draw.gauss(50, 20) for _ in range(4000)],
        2: bad + [7.0] + bad,
        3: bad,
        4: [1e6] + [draw.random() for _ in range(3000)],
        5: [draw.random() for _ in range(25000)],
        None: [3.0, 4.0],
    }
    df = spark.createDataFrame([(c, t, x) for c, xs in clips.items() for t, x in enumerate(xs)], "clip long, t int, x double")
    got = {(r.clip, r.t): r.e for r in series.ema(df, "clip", "t", "x", momentum, "e").collect()}
    want = {(c, t): e for c, xs in clips.items() for t, e in enumerate(folded(xs, momentum))}
    assert got == want


def test_ema_of_an_empty_table_and_without_momentum(spark):
    df = spark.createDataFrame([(1, 0, 2.0), (1, 1, None)], "clip long, t int, x double")
    assert series.ema(df.limit(0), "clip", "t", "x").collect() == []
    # Without smoothing a gap still repeats the last value.
    assert sorted((r.t, r.value) for r in series.ema(df, "clip", "t", "x", 0).collect()) == [(0, 2.0), (1, 2.0)]
    with pytest.raises(ValueError):
        series.ema(df, "clip", "t", "x", 1.0)


@pytest.mark.parametrize(("momentum", "parts"), [(0.99, 16), (0.5, 512), (0.0, 7)])
def test_ema_of_a_hot_clip_in_parts(spark, monkeypatch, momentum, parts):
    """Clips over the limit are cut at their times: whole parts without a finite value, late seeds, ties in time, a null key."""
    monkeypatch.setattr(series, "HOT", 2000)
    monkeypatch.setattr(series, "PARTS", parts)
    draw = random.Random(8)
    gaps = lambda n, share: [draw.choice([None, math.nan, -math.inf]) if draw.random() < share else draw.gauss(50, 20) for _ in range(n)]
    clips = {1: gaps(9000, 0.2), 2: [None] * 3000 + gaps(3000, 0.5) + [math.nan] * 3000, 3: [None] * 4000, 4: gaps(1500, 0.1), None: gaps(5000, 0.0)}
    df = spark.createDataFrame([(c, t // 3 if c == 1 else t, x) for c, xs in clips.items() for t, x in enumerate(xs)], "clip long, t int, x double")
    got = {}
    for r in series.ema(df, "clip", "t", "x", momentum, "e").collect():
        got.setdefault((r.clip, r.t), []).append(r.e)
    for c, xs in clips.items():
        ordered = [(t // 3 if c == 1 else t, x) for t, x in enumerate(xs)]
        ordered.sort(key=lambda p: (p[0], p[1] is not None, p[1] is not None and math.isnan(p[1]), 0 if p[1] is None or math.isnan(p[1]) else p[1]))
        want = {}
        for (t, _), e in zip(ordered, folded([x for _, x in ordered], momentum), strict=True):
            want.setdefault((c, t), []).append(e)
        for k, es in want.items():
            key = lambda e: (e is not None, e or 0)
            for x, y in zip(sorted(got[k], key=key), sorted(es, key=key), strict=True):
                assert (x is None) == (y is None) and (x is None or math.isclose(x, y, rel_tol=1e-9)), (k, x, y)


def test_focal_tracking_divides_as_ieee_does(spark):
    clips = {1: [(0.0, 2.0), (4.0, 5.0)], 2: [(0.0, 0.0), (4.0, 5.0)], 3: [(3.0, 3.0)], 4: [(2.0, 1.0), (2.0, 3.0)], 5: [(2.0, 1.0), (4.0, 3.0)], 6: [(None, 1.0)]}
    df = spark.createDataFrame([(c, t, *x) for c, xs in clips.items() for t, x in enumerate(xs)], "clip int, t int, truth double, found double")
    got = {r.clip: (r.mae, r.mape, r.range_ratio) for r in series.focal_tracking(df, "clip", "truth", "found").collect()}
    nan, inf = math.nan, math.inf
    want = {1: (1.5, inf, 0.75), 2: (0.5, nan, 1.25), 3: (0.0, 0.0, nan), 4: (1.0, 50.0, inf), 5: (1.0, 37.5, 1.0), 6: (None, None, None)}
    assert {c: tuple(map(str, x)) for c, x in got.items()} == {c: tuple(map(str, x)) for c, x in want.items()}


def test_ordered_mean_adds_up_in_order(spark):
    draw = random.Random(4)
    clips = {c: [None if draw.random() < 0.1 else draw.choice([1e16, -1e16, draw.random(), 0.1]) for _ in range(draw.randint(1, 60))] for c in range(40)} | {90: [None], 91: [0.1, None]}
    df = spark.createDataFrame([(c, t, x) for c, xs in clips.items() for t, x in enumerate(xs)], "clip int, t int, x double")
    want = {}
    for c, xs in clips.items():
        total = 0.0
        for x in (some := [x for x in xs if x is not None]):
            total += x  # sum() compensates
        want[c] = total / len(some) if some else None
    for parts in (1, 7):
        assert {r.clip: r.m for r in series.ordered_mean(df.orderBy(F.rand(parts)).repartition(parts), "clip", ["t"], "x", "m").collect()} == want
