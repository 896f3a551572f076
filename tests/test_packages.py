"""Writers, packages and camera records through temporary folders, against plain Python and numpy."""

import io
import json
import tarfile

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from reelsieve.functions import columns as C
from reelsieve.operators import geometry, hooks, merge, packages, series
from reelsieve.sources import tar


def lines(folder):
    return sorted(x for f in folder.glob("part-*") for x in f.read_text().splitlines())


def test_a_manifest_is_replaced_as_a_whole(spark, tmp_path):
    at = tmp_path / "manifest"
    one, two = (spark.createDataFrame([(i, "x")], "id int, name string") for i in (1, 2))
    packages.replace_json(one, str(at))
    packages.replace_json(two, str(at))
    assert lines(at) == ['{"id":2,"name":"x"}'] and [p.name for p in tmp_path.iterdir()] == ["manifest"]
    with pytest.raises(PySparkException):
        packages.replace_json(two.withColumn("bad", F.raise_error(F.lit("no")).cast("int")), str(at))
    assert lines(at) == ['{"id":2,"name":"x"}'] and [p.name for p in tmp_path.iterdir()] == ["manifest"]


def test_manifests_after_review_and_sidecar(spark, tmp_path):
    df = spark.createDataFrame([("a", "pass", True), ("b", "fail", False), ("c", "pass", None), ("d", "flag", True)], "id string, verdict string, human_reviewed boolean")
    packages.reviewed_manifests(df, str(tmp_path), "id")
    assert {n: lines(tmp_path / n) for n in ("pass", "fail", "human_reviewed")} == {"pass": ["a", "c"], "fail": ["b"], "human_reviewed": ["a", "d"]}
    rows = spark.createDataFrame([("a", "old", "new"), ("b", None, "new"), ("c", "old", None), ("d", "old", "")], "id string, o string, r string")
    assert sorted(map(tuple, packages.caption_sidecar(rows, "id", "o", "r").collect())) == [("a", "old", "new"), ("b", "", "new")]


def test_completeness_with_repeats_and_others(spark):
    files = [("a", m, 10) for m in packages.MEMBERS] + [("a", "mp4", 4), ("a", "notes.txt", 99), ("b", "mp4", 7), ("c", "notes.txt", 1)]
    got = packages.completeness(spark.createDataFrame(files, "s string, ext string, size long"), "s", "ext", "size")
    assert {r.s: (r.n_files, r.bytes, r.complete, len(r.missing)) for r in got.collect()} == {"a": (6, 60, True, 0), "b": (1, 7, False, 5), "c": (0, 0, False, 6)}
    assert [tuple(r) for r in packages.totals(got, F.lit("all")).collect()] == [("all", 3, 1, 33.3, 60)]


def test_reference_package(spark, tmp_path):
    members = [(f"s.{i}", e, bytearray(f"{i}{e}".encode())) for i in range(6) for e in ("mp4", "meta.json", "caption.txt")]
    members = spark.createDataFrame(members, "sample string, ext string, data binary")
    picks = spark.createDataFrame([("s.1", "g", "flag", ["n_jumps=3", "tone"], 3), ("s.4", "g", "pass", [], None), ("gone", "h", "fail", ["x"], 9)], "sample string, grp string, verdict string, why array<string>, n_jumps int")
    for _ in range(2):
        got = packages.reference_package(picks, members, str(tmp_path / "golden"), "sample", "grp", "verdict", "why", {"n_jumps": "n_jumps"}, capacity=1).collect()
    size = sum(len(f"{i}{e}") for i in (1, 4) for e in ("mp4", "meta.json", "caption.txt"))
    assert sorted(map(tuple, got)) == [("g", 2, 2, size), ("h", 1, 0, 0)]
    shards = sorted((tmp_path / "golden/shards").glob("*.tar"))
    assert len(shards) == 2
    found = {}
    for x in shards:
        with tarfile.open(x) as t:
            found |= {n: t.extractfile(n).read().decode() for n in t.getnames()}
    assert found == {f"s.{i}.{e}": f"{i}{e}" for i in (1, 4) for e in ("mp4", "meta.json", "caption.txt")}
    text = "\n".join(f.read_text() for f in sorted((tmp_path / "golden/summary").glob("part-*")))
    assert "reasons: n_jumps=3, tone" in text and "n_jumps: N/A" in text and text.count("reasons:") == 1
    assert sum(f.read_text().count("___________") for f in (tmp_path / "golden/form").glob("part-*")) == 12
    assert {json.loads(x)["sample"] for x in lines(tmp_path / "golden/records")} == {"s.1", "s.4", "gone"}


def test_extraction_reasons_and_ratings(spark):
    members = spark.createDataFrame([("t1", "a", "mp4", 5), ("t1", "b", "meta.json", 5), ("t1", "c", "mp4", 0), ("t1", "c", "mp4", 3), ("t1", "d", "mp4", 0)], "shard string, sample string, ext string, size long")
    picks = spark.createDataFrame([("a", "t1"), ("b", "t1"), ("c", "t1"), ("d", "t1"), ("a", "t2")], "sample string, shard string")
    got = packages.extraction(picks, members, "sample", "shard")
    assert {(r.sample, r.shard): (r.ok, r.reason) for r in got.collect()} == {("a", "t1"): (True, None), ("b", "t1"): (False, "video not in tar"), ("c", "t1"): (True, None), ("d", "t1"): (False, "empty video"), ("a", "t2"): (False, "tar not found")}
    ratings = packages.by_rating(spark.createDataFrame([("a", "good")], "sample string, rating string"), got, "sample", "rating", ("good",))
    assert {r.rating: (r.place, r.n, r.n_ok, r.pct) for r in ratings.collect()} == {"good": (0, 2, 1, 50.0), None: (1, 3, 1, 50.0)}


def test_arrays_between_keyframes_and_dense_poses(spark):
    rng = np.random.default_rng(1)

    def pose():
        p = np.eye(4)
        p[:3, :3], p[:3, 3] = np.linalg.qr(rng.normal(size=(3, 3)))[0], rng.normal(size=3)
        return p

    clips = {"a": {0: pose(), 3: pose(), 4: pose(), 9: pose()}, "b": {2: pose(), 5: pose()}, "c": {0: np.eye(4), 2: pose()}, "d": {3: pose()}}
    rows = [(k, t, p.ravel().tolist()) for k, ps in clips.items() for t, p in ps.items()] + [("a", 5, None), ("a", None, [0.0] * 16)]
    df = spark.createDataFrame(rows, "k string, t int, pose array<double>")
    plain, dense = {}, {}
    for out, got in ((plain, series.interpolate_arrays(df, "k", "t", "pose")), (dense, geometry.dense_poses(df, "k", "t", "pose"))):
        for r in got.collect():
            out[r.k, r.t] = np.reshape(r.pose, (4, 4))
    for k, ps in clips.items():
        known, n = sorted(ps), max(ps) + 1
        want = np.array([[[np.interp(t, known, [ps[x][i, j] for x in known]) for j in range(4)] for i in range(4)] for t in range(n)])
        np.testing.assert_allclose([plain[k, t] for t in range(n)], want, atol=1e-12)
        anchored = want if np.allclose(want[0], np.eye(4), atol=1e-3) else np.linalg.inv(want[0]) @ want
        np.testing.assert_allclose([dense[k, t] for t in range(n)], anchored, atol=1e-9)
    assert len(plain) == len(dense) == sum(max(ps) + 1 for ps in clips.values())


def test_npz_artifacts(spark):
    out = io.BytesIO()
    np.savez(out, data=np.arange(32, dtype=np.float32).reshape(2, 4, 4), inds=np.array([0, 5]))
    half = io.BytesIO()
    np.savez(half, data=np.zeros(2))
    rows = [(1, bytearray(out.getvalue())), (2, bytearray(b"PK bad")), (3, None), (4, bytearray(half.getvalue())), (5, bytearray(out.getvalue()[:200]))]
    got = {r.i: r.a for r in spark.createDataFrame(rows, "i int, b binary").select("i", tar.npz_values("b").alias("a")).collect()}
    assert got[1].shape == [2, 4, 4] and got[1].inds == [0, 5] and got[1].data == list(range(32)) and all(got[i] is None for i in (2, 3, 4, 5))


def test_motion_of_logs(spark):
    logs = ['{"frames":[{"metrics":{"motion2":2.0,"motion":9}},{"metrics":{"motion":4}},{"metrics":{}},{}]}', '{"frames":[]}', "{}", "{broken", None]
    got = [r.m for r in spark.createDataFrame(list(enumerate(logs)), "i int, x string").orderBy("i").select(C.motion_of_log(F.col("x")).alias("m")).collect()]
    assert got[0] == 3.0 and all(np.isnan(x) for x in got[1:])
    assert [r[0] for r in spark.createDataFrame([(0,), (1,), (5,)], "n int").select(C.scene_cuts(F.col("n"))).collect()] == [0, 0, 4]


def test_first_of_each_key_and_hooks(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "z"), (None, 4, "w")], "k string, n int, v string")
    assert {r.k: r.v for r in merge.first_wins(df, "k", "n").collect()} == {"a": "y", None: "z"}
    assert {r.k: r.v for r in merge.last_wins(df, "k", "n").collect()} == {"a": "x", None: "w"}
    hooks.register("plus", lambda s: s + 1.0)
    assert sorted(r[0] for r in df.select(hooks.hook("plus", "n")).collect()) == [2.0, 3.0, 4.0, 5.0]
    hooks.unregister("plus")
    assert {r[0] for r in df.select(hooks.hook("plus", "n")).collect()} == {None}
