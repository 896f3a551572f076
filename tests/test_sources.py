"""Round trips of sources and sinks through temporary files."""

import json
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelsieve.operators import packing, report
from reelsieve.sources import readers, shards, tar


def packed(spark, n=7, capacity=3):
    rows = []
    for i in range(n):
        for ext in shards.MEMBERS:
            if not (i == 5 and ext == "scale.npy"):
                rows.append((i // capacity, f"clip.v{i}", ext, bytearray(f"{i}:{ext}".encode() * (i + 1))))
    return spark.createDataFrame(rows, "shard long, sample string, ext string, data binary")


def test_shards_are_written_and_read_member_by_member(spark, tmp_path):
    rows = packed(spark)
    assert [(r.sample, r.missing) for r in shards.rejected(rows).collect()] == [("clip.v5", ["scale.npy"])]
    made = {r.shard: r for r in shards.write(rows, str(tmp_path / "out")).collect()}
    assert {s: (r.n_samples, r.n_members) for s, r in made.items()} == {0: (3, 18), 1: (3, 17), 2: (1, 6)}
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == [f"shard-{i:06d}.tar" for i in range(3)]
    with tarfile.open(made[2].path) as archive:
        assert archive.getnames() == [f"clip.v6.{e}" for e in sorted(shards.MEMBERS)]
    back = shards.members(spark, str(tmp_path / "out"))
    want = sorted((f"{r.sample}.{r.ext}", bytes(r.data)) for r in rows.collect())
    assert sorted((r.name, bytes(r.data)) for r in back.collect()) == want
    listed = shards.members(spark, str(tmp_path / "out"), wanted=(".json",), content=False).collect()
    assert len(listed) == 7 and all(r.data is None and r.size > 0 for r in listed)
    samples = tar.samples(back, shards.MEMBERS).collect()
    assert {r.sample: len(r.members) for r in samples} == {f"clip.v{i}": 5 if i == 5 else 6 for i in range(7)}
    again = {r.shard: r.bytes for r in shards.write(rows, str(tmp_path / "out")).collect()}
    assert again == {s: r.bytes for s, r in made.items()} and len(list((tmp_path / "out").iterdir())) == 3


def test_a_damaged_shard_keeps_what_is_before_the_damage(spark, tmp_path):
    shards.write(packed(spark), str(tmp_path)).collect()
    whole = (tmp_path / "shard-000000.tar").read_bytes()
    (tmp_path / "shard-000000.tar").write_bytes(whole[:5000])
    (tmp_path / "shard-000001.tar").write_bytes(b"no tar at all" * 100)
    got = shards.members(spark, str(tmp_path)).collect()
    errors = {r.shard.rsplit("/", 1)[-1] for r in got if r.error}
    assert "shard-000001.tar" in errors and "shard-000002.tar" not in errors
    assert 0 < sum(r.name is not None and r.shard.endswith("0.tar") for r in got) < 18
    assert sum(r.shard.endswith("2.tar") for r in got) == 6


def test_npy_members(spark):
    import io

    out = io.BytesIO()
    np.save(out, np.arange(6, dtype=np.float32).reshape(2, 3))
    df = spark.createDataFrame([(1, bytearray(out.getvalue())), (2, bytearray(b"bad")), (3, None)], "i int, data binary")
    assert {r.i: r.v for r in df.select("i", tar.npy_values("data").alias("v")).collect()} == {1: [0, 1, 2, 3, 4, 5], 2: None, 3: None}


def test_json_lines_keep_malformed_lines_apart(spark, tmp_path):
    lines = [json.dumps({"sample_id": f"s{i}", "group": "g", "verdict": "pass", "metrics": {"T": i, "n_jumps": 2}}) for i in range(3)] + ["", "{broken", "   "]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    (tmp_path / "b.jsonl").write_text(lines[0] + "\n")
    good, bad = readers.json_lines(spark, str(tmp_path / "*.jsonl"), readers.RECORD)
    assert sorted((r.sample_id, r.metrics.T) for r in good.collect()) == [("s0", 0), ("s0", 0), ("s1", 1), ("s2", 2)]
    assert [r.line for r in bad.collect()] == ["{broken"]
    good.where("sample_id = 's1'").write.json(str(tmp_path / "out"))
    again, _ = readers.json_lines(spark, str(tmp_path / "out"), readers.RECORD)
    assert [r.metrics.n_jumps for r in again.collect()] == [2]


def test_manifests(spark, tmp_path):
    rows = spark.createDataFrame([("a", "pass", []), ("b", "fail", ["n_jumps", "fov"]), ("c", "flag", ["tone"])], "id string, verdict string, why array<string>")
    packing.write_manifests(rows, str(tmp_path / "m"), "id", "verdict", "why")
    assert {v: [r.value for r in spark.read.text(str(tmp_path / "m" / v)).collect()] for v in ("pass", "fail", "flag")} == {"pass": ["a"], "fail": ["b\tn_jumps|fov"], "flag": ["c\ttone"]}


def test_listing_index_and_completeness(spark, tmp_path):
    for sample, exts in (("s.1", shards.MEMBERS), ("s.2", shards.MEMBERS[:2])):
        for ext in exts:
            (tmp_path / f"{sample}.{ext}").write_bytes(b"x" * 10)
    index = readers.sample_index(readers.listing(spark, str(tmp_path)), shards.MEMBERS)
    assert {r.sample_id: (r.n_files, r.bytes) for r in index.collect()} == {"s.1": (6, 60), "s.2": (2, 20)}
    (tmp_path / "done.tsv").write_text("sample_id\tfile_count\tcomplete\ns.1\t6\t True\ns.2\t2\tfalse\n")
    done = readers.completeness(spark, str(tmp_path / "done.tsv"))
    assert [r.sample_id for r in index.join(done, "sample_id", "left_semi").collect()] == ["s.1"]
    path = F.lit("/x/final_wds-A/wds-A/w003/shard-000007.tar")
    got = spark.range(1).select(*[c.alias(k) for k, c in readers.shard_parts(path).items()]).first()
    assert (got.dataset, got.worker, got.shard) == ("wds-A", "w003", "shard-000007")
    assert {r.key for r in readers.keys(spark.createDataFrame([("d/a.b.c",), ("a.x",)], "n string"), "n").collect()} == {"a"}


def test_timestamps_transforms_and_splits(spark, tmp_path):
    (tmp_path / "t.txt").write_text("# head\n1.5 a,b\n\n2.25\tc\nbad x\n")
    assert [(r.ts, r.fields) for r in readers.timestamps(spark, str(tmp_path / "t.txt")).orderBy("ts").collect()] == [(1.5, ["a", "b"]), (2.25, ["c"])]
    frames = [{"file_path": f"f{i}.png", "transform_matrix": np.eye(4).tolist()} for i in (2, 0, 1)]
    (tmp_path / "transforms.json").write_text(json.dumps({"fl_x": 1.0, "fl_y": 2.0, "cx": 3.0, "cy": 4.0, "frames": frames}))
    got = readers.transforms(spark, str(tmp_path / "transforms.json")).orderBy("t").collect()
    assert [r.file_path for r in got] == ["f0.png", "f1.png", "f2.png"] and got[0].pose[15] == 1.0 and got[0].fy == 2.0
    splits = spark.createDataFrame([(0, [1, 2, 3], [[1.0], [2.0]]), (1, [2], [[9.0]])], "split int, frames array<int>, poses array<array<double>>")
    assert {r.frame: r.pose for r in readers.split_frames(splits).collect()} == {1: [1.0], 2: [9.0]}


def test_catalogue_manifest_and_captions(spark):
    rows = [("a", "default", 60.0, "video", 10), ("b", "gt_pose", 30.0, "frames", 5)]
    assert readers.catalogue(spark, rows, 15).count() == 2
    with pytest.raises(ValueError, match="add up"):
        readers.catalogue(spark, rows, 16)
    with pytest.raises(ValueError, match="pose_mode"):
        readers.catalogue(spark, [("a", "other", 1.0, "video", 1)])
    lines = spark.createDataFrame([('{"id": "x", "n": 3, "more": "y"}', '{"manifest": {"prompt": {"text": "hi"}}}'), ('{"id": "z"}', "{}")], "j string, raw string")
    got = {r.id: (r.n, r.extra) for r in readers.manifest(lines, "j", "id string, n int").collect()}
    assert got == {"x": (3, {"more": "y"}), "z": (None, {})}
    assert sorted(r.caption for r in readers.captions(lines, "j", "raw").collect()) == ["", "hi"]


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("g", 1), ("g", 2), ("<h>", 3)], "k string, n int")
    assert {r.k: json.loads(r.json)["rows"] for r in report.nested_json(df, "k", "rows", "n").collect()} == {"g": [{"n": 1}, {"n": 2}], "<h>": [{"n": 3}]}
    text = report.markdown(df.orderBy("n"), "Title")
    assert text.startswith("# Title") and "| g | 2 |" in text
    page = report.html(df.orderBy("n"), "T", [1, 5])
    assert "&lt;h&gt;" in page and page.count("<rect") == 2
    report.write_csv(df.coalesce(1), str(tmp_path / "c"), blank=("notes",))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["k", "n", "notes"]
