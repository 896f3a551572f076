"""The tar data source: parts of archives, filters and ledgers taken over, damaged archives; the sink's commit, abort, rotation and checks."""

import io
import json
import os
import signal
import tarfile

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from reelsieve.config import MEMBERS
from reelsieve.sources import tar_format

SAMPLES = "sample string, members map<string, binary>"


def npy(x):
    out = io.BytesIO()
    np.save(out, x)
    return bytearray(out.getvalue())


def clip(frames=4, caption="a wooden table", **other):
    members = {"mp4": bytearray(b"\x00video"), "poses_c2w.npy": npy(np.tile(np.eye(4, dtype=np.float32), (frames, 1, 1))), "intrinsics.npy": npy(np.full((frames, 1, 4), 7, np.float32)), "scale.npy": npy(np.ones(frames, np.float32)), "caption.txt": bytearray(caption.encode()), "meta.json": bytearray(b'{"a": 1}')}
    return {k: v for k, v in (members | other).items() if v is not None}


@pytest.fixture()
def tars(spark):
    tar_format.register(spark)
    return lambda path, **o: spark.read.format("tar").options(**o).load(str(path))


def archive(path, members):
    with tarfile.open(path, "w") as tar:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))


def names(path):
    with tarfile.open(path) as tar:
        return tar.getnames()


@pytest.mark.parametrize("part", [512, 1536, 5000, 1 << 30])
def test_parts_of_an_archive_give_each_member_once(spark, tars, tmp_path, part):
    """A member that holds an archive at a block's edge isn't taken for members."""
    archive(tmp_path / "inner.tar", [(f"x{i}", b"i" * 600) for i in range(4)])
    inner = (tmp_path / "inner.tar").read_bytes()
    (tmp_path / "d").mkdir()
    want = [(f"s{i}.{e}", bytes([65 + i]) * (400 * i + 1)) for i in range(9) for e in ("mp4", "meta.json")] + [("nested.tar", inner)]
    archive(tmp_path / "d/shard-0.tar", want)
    (tmp_path / "d/_passing-1").mkdir()
    archive(tmp_path / "d/_passing-1/shard-1.tar", want)
    df = tars(tmp_path / "d", partBytes=part)
    assert sorted((r.name, bytes(r.data)) for r in df.collect()) == sorted(want)
    size = os.path.getsize(tmp_path / "d/shard-0.tar")
    assert df.rdd.getNumPartitions() == -(-size // part)
    headers = tars(tmp_path / "d", content="false").collect()
    assert {r.name: (r.size, r.data) for r in headers} == {n: (len(d), None) for n, d in want}


def test_filters_and_suffixes_reach_the_source(spark, tars, tmp_path):
    for k in range(3):
        archive(tmp_path / f"shard-{k}.tar", [(f"s{k}{i}.{e}", b"x") for i in range(4) for e in ("mp4", "meta.json", "caption.txt")])
    (tmp_path / "shard-2.tar").write_bytes(b"never opened" * 100)
    df = tars(tmp_path, pushFilters="true").where(F.col("name").endswith(".json") & F.col("shard").contains("shard-1") & (F.col("size") == 1))
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "PushedFilters: [StringEndsWith(name,.json), StringContains(shard,shard-1)]" in plan
    condition = plan[plan.index("Condition :") :].split("\n")[0]
    assert "size" in condition and "EndsWith" not in condition and "Contains" not in condition
    assert sorted(r.name for r in df.collect()) == [f"s1{i}.meta.json" for i in range(4)]
    assert df.rdd.getNumPartitions() == 1
    some = tars(tmp_path, suffixes=".mp4, .txt", pushFilters="true").where(F.col("name").isin("s00.mp4", "s11.caption.txt", "s12.meta.json"))
    assert sorted(r.name for r in some.collect()) == ["s00.mp4", "s11.caption.txt"]
    assert [r.name for r in tars(tmp_path, pushFilters="true").where(F.col("name").startswith("s0") & (F.col("name") == "s03.mp4")).collect()] == ["s03.mp4"]


def test_one_load_with_two_filters(spark, tars, tmp_path):
    """Without the option both sides of a join read what they ask for."""
    archive(tmp_path / "a.tar", [(f"s{i}.{e}", e.encode()) for i in range(3) for e in ("mp4", "txt")])
    df = tars(tmp_path).withColumn("s", F.substring_index("name", ".", 1))
    both = df.where("name LIKE '%.mp4'").alias("a").join(df.where("name LIKE '%.txt'").alias("b"), "s")
    assert sorted((r.s, r.x, r.y) for r in both.select("s", F.col("a.name").alias("x"), F.col("b.name").alias("y")).collect()) == [(f"s{i}", f"s{i}.mp4", f"s{i}.txt") for i in range(3)]


@pytest.mark.parametrize("kind", ["parquet", "json"])
def test_members_in_the_ledger_are_not_read_again(spark, tars, tmp_path, kind):
    (tmp_path / "in").mkdir()
    for k in range(2):
        archive(tmp_path / f"in/shard-{k}.tar", [(f"s{i}.mp4", b"x") for i in range(5)])
    first = tars(tmp_path / "in").where("name < 's3'").select("shard", "name")
    first.where("NOT (shard LIKE '%1.tar' AND name = 's0.mp4')").write.format(kind).save(str(tmp_path / "done"))
    left = tars(tmp_path / "in", done=str(tmp_path / "done"))
    assert sorted((r.shard[-5:], r.name) for r in left.collect()) == [("0.tar", "s3.mp4"), ("0.tar", "s4.mp4"), ("1.tar", "s0.mp4"), ("1.tar", "s3.mp4"), ("1.tar", "s4.mp4")]
    left.select("shard", "name").write.mode("append").format(kind).save(str(tmp_path / "done"))
    assert tars(tmp_path / "in", done=str(tmp_path / "done")).count() == 0


@pytest.mark.parametrize("part", [1024, 1 << 30])
def test_damage_keeps_what_is_before_it(spark, tars, tmp_path, part):
    archive(tmp_path / "cut.tar", [(f"s{i}", b"x" * 700) for i in range(6)])
    whole = (tmp_path / "cut.tar").read_bytes()
    (tmp_path / "cut.tar").write_bytes(whole[: 3 * 1536 + 900])
    (tmp_path / "header.tar").write_bytes(whole[: 2 * 1536] + b"\xff" * 512 + whole[2 * 1536 + 512 :])
    (tmp_path / "none.tar").write_bytes(b"no tar at all" * 300)
    (tmp_path / "empty.tar").write_bytes(b"")
    archive(tmp_path / "good.tar", [("a", b"")])
    rows = tars(tmp_path, partBytes=part).collect()
    got = {}
    for r in rows:
        got.setdefault(os.path.basename(r.shard), []).append(r.name)
    want = {"cut.tar": ["None", "s0", "s1", "s2"], "header.tar": ["None", "s0", "s1"], "none.tar": ["None"], "empty.tar": ["None"], "good.tar": ["a"]}
    assert {k: sorted(map(str, v)) for k, v in got.items()} == want
    assert all((r.error is None) == (r.name is not None) for r in rows)


def test_missing_path_and_empty_folder(spark, tars, tmp_path):
    assert tars(tmp_path).count() == 0
    with pytest.raises(PySparkException, match="FileNotFoundError"):
        tars(tmp_path / "absent").count()


def _write(df, path, mode="append", **o):
    tar_format.register(df.sparkSession)
    df.write.format("tar").mode(mode).options(**o).save(str(path))


def test_shards_turn_at_capacity_and_are_numbered_on(spark, tars, tmp_path):
    df = spark.createDataFrame([(f"clip.{i:03d}", clip()) for i in range(5)], SAMPLES).coalesce(1)
    out = tmp_path / "out"
    _write(df, out, capacity=2, frames="any")
    assert sorted(os.listdir(out)) == [f"shard-{k:06d}.tar" for k in range(3)]
    assert [sum(n.endswith("meta.json") for n in names(out / f"shard-{k:06d}.tar")) for k in range(3)] == [2, 2, 1]
    assert names(out / "shard-000002.tar") == [f"clip.004.{e}" for e in MEMBERS]
    _write(df.limit(1), out, capacity=2, frames=4)
    assert sorted(os.listdir(out))[-1] == "shard-000003.tar"
    _write(df.limit(1), out, mode="overwrite", frames=4)
    assert os.listdir(out) == ["shard-000000.tar"]
    _write(df.limit(1), out, prefix="other", frames=4)
    assert sorted(os.listdir(out)) == ["other-000000.tar", "shard-000000.tar"]
    back = {r.name: bytes(r.data) for r in tars(out).where("shard LIKE '%other%'").collect()}
    assert back == {f"clip.000.{e}": bytes(x) for e, x in clip().items()}
    np.testing.assert_array_equal(np.load(io.BytesIO(back["clip.000.scale.npy"])), np.ones(4, np.float32))


BAD = [
    (clip(100), "poses_c2w: shape (100, 4, 4), not (4, 4, 4)"),
    (clip(**{"poses_c2w.npy": npy(np.tile(np.eye(4), (4, 1, 1)))}), "poses_c2w: type float64, not float32"),
    (clip(**{"intrinsics.npy": npy(np.zeros((4, 2, 4), np.float32))}), "intrinsics: shape (4, 2, 4), not (4, 1, 4)"),
    (clip(**{"scale.npy": npy(np.zeros((4, 1), np.float32))}), "scale: shape (4, 1), not (4)"),
    (clip(**{"scale.npy": bytearray(b"bad")}), "scale: unreadable array"),
    (clip(**{"poses_c2w.npy": npy(np.tile(2 * np.eye(4, dtype=np.float32), (4, 1, 1)))}), "first pose is not the identity"),
    (clip(caption="  "), "caption is empty"),
    (clip(mp4=None, **{"scale.npy": None}), "missing members: mp4, scale.npy"),
]


def test_invalid_samples_are_listed_with_their_reasons(spark, tmp_path):
    rows = [(f"bad{k}", m) for k, (m, _) in enumerate(BAD)] + [("good", clip()), (None, clip()), ("nothing", None)]
    df = spark.createDataFrame(rows, SAMPLES).repartition(3)
    _write(df, tmp_path / "out", invalid="reject", frames=4)
    lines = {x["sample"]: x["reason"] for x in map(json.loads, (tmp_path / "out/shard-rejected.jsonl").read_text().splitlines())}
    assert len(lines) == len(rows) - 1 and lines[None] == "sample has no name" and lines["nothing"].startswith("missing members: mp4, poses")
    for k, (_, why) in enumerate(BAD):
        assert lines[f"bad{k}"].startswith(why)
    assert [n for x in (tmp_path / "out").glob("*.tar") for n in names(x)] == [f"good.{e}" for e in MEMBERS]
    assert tar_format.problem("x", clip(9), frames="any") is None and "differ" in tar_format.problem("x", clip(9, **{"scale.npy": npy(np.ones(3, np.float32))}), frames="any")
    assert tar_format.problem("x", clip(961)) is None and tar_format.problem("x", clip(960)) is not None


def _killed(batches):
    for b in batches:
        yield b
        if "clip17" in b.column("sample").to_pylist():
            os.kill(os.getpid(), signal.SIGKILL)


@pytest.mark.parametrize("how", ["invalid", "killed"])
def test_a_failed_job_leaves_no_file(spark, tmp_path, how):
    good = spark.createDataFrame([(f"clip{i}", clip()) for i in range(20)], SAMPLES).repartition(4)
    _write(good.limit(2).coalesce(1), tmp_path / "out", frames=4)
    df = good.mapInArrow(_killed, SAMPLES) if how == "killed" else good.unionByName(spark.createDataFrame([("late", clip(caption=""))], SAMPLES))
    with pytest.raises(PySparkException, match="caption is empty" if how == "invalid" else None):
        _write(df, tmp_path / "out", frames=4, capacity=1)
    assert os.listdir(tmp_path / "out") == ["shard-000000.tar"]


def test_options_and_columns_are_checked(spark, tmp_path):
    df = spark.createDataFrame([("a", clip())], SAMPLES)
    for o, text in (({"capacity": 0}, "at least one"), ({"invalid": "skip"}, "fail or reject")):
        with pytest.raises(PySparkException, match=text):
            _write(df, tmp_path / "out", **o)
    with pytest.raises(PySparkException, match="columns sample and members"):
        _write(df.select("sample"), tmp_path / "out")
