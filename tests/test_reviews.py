"""Review imports, unpacked samples and configuration files."""

import json

import pytest
from pyspark.sql import functions as F

from reelsieve.functions import columns as C
from reelsieve.operators import review
from reelsieve.sources import catalogues, readers

LISTED = [("A", "fail", 3), ("B", "pass", 1), ("C", "fail", 10), ("D", "pass", 0), (None, "pass", 0)]
FILLED = [
    ("A", "fail", "pass", "good", "acceptable", "trajectory_minor", "Small jump"),
    ("B", "pass", "", "", "", "", ""),
    ("C", "flag", None, None, None, None, None),
    ("D", "pass", "fail", "poor", None, None, None),
    (None, "pass", "pass", None, None, None, None),
]


@pytest.fixture()
def tables(spark):
    return (
        spark.createDataFrame(LISTED, "sample_id string, auto_verdict string, n_jumps int"),
        spark.createDataFrame(FILLED, "sample_id string, auto_verdict string, human_verdict string, video_quality string, trajectory_quality string, primary_issue string, notes string"),
    )


def test_records(spark, tables, tmp_path):
    listed, filled = tables
    records = review.imported(listed, filled, "batch1", "2024-01-31")
    review.write_records(records.coalesce(1), str(tmp_path / "r"))
    lines = [json.loads(x.value) for x in spark.read.text(str(tmp_path / "r")).collect()]
    got = {x["sample_id"]: x for x in lines}
    assert sorted(got) == ["A", "B", "C", "D"] and all(tuple(x) == review.FIELDS for x in lines)
    assert got["A"] == {"sample_id": "A", "auto_verdict": "fail", "human_verdict": "pass", "video_quality": "good", "trajectory_quality": "acceptable", "primary_issue": "trajectory_minor", "notes": "Small jump", "reviewer": "batch1", "review_date": "2024-01-31"}
    assert got["B"]["human_verdict"] == "pass" and got["B"]["video_quality"] is None and got["B"]["notes"] == ""
    assert got["C"]["human_verdict"] == "flag"  # the decision's automatic verdict, not the list's


def test_statistics_and_report(tables):
    listed, filled = tables
    records = review.imported(listed, filled, "b", "d")
    assert review.statistics(records).collect() == [(4, 2, 50.0, 2, 50.0)]
    assert review.statistics(records.limit(0)).collect() == [(0, 0, 0.0, 0, 0.0)]
    assert sorted(map(tuple, review.disagreements(records).collect())) == [("fail", "pass", "trajectory_minor", 1), ("pass", "fail", None, 1)]
    page = review.page(records)
    assert all(x in page for x in ("Overall Statistics", "Agreement Analysis", "Disagreement: fail to pass", "<td>trajectory_minor</td><td>1</td>", "<td>50.0</td>"))


def test_decisions_are_checked(spark, tables):
    listed, filled = tables
    known = filled.where("sample_id IS NOT NULL")
    assert review.checked(known, listed) is known
    assert review.checked(known.drop("primary_issue"), listed).count() == 4
    for wrong, why in ((("A", "maybe"), "A: invalid verdict maybe"), (("Z", "pass"), "Z: id is not in the review list")):
        rows = spark.createDataFrame([(*wrong, "no such issue")], "sample_id string, human_verdict string, primary_issue string")
        with pytest.raises(ValueError, match=why):
            review.checked(rows, listed)
    with pytest.raises(ValueError, match="and more"):
        review.checked(spark.createDataFrame([(f"Z{i}", "pass", "") for i in range(9)], "sample_id string, human_verdict string, primary_issue string"), listed)


def test_sample_paths(spark, tmp_path):
    def put(folder, *names):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        for n in names:
            (tmp_path / folder / n).write_bytes(b"x")

    put("final_wds-a/wds-a/w000/shard-000000", "s.1.mp4", "s.1.caption.txt", "s.2.mp4", "s.3.caption.txt", "note.txt")
    put("final_wds-b/wds-b/w001/shard-000001", "s.1.mp4")
    put("other/wds-b/w001/shard-000001", "s.9.mp4")
    files = readers.listing(spark, str(tmp_path))
    got = {r.sample_id: r for r in readers.sample_paths(files).collect()}
    assert sorted(got) == ["s.1", "s.2"]
    assert got["s.1"].shard_dir.endswith("final_wds-b/wds-b/w001/shard-000001")  # the last of two
    assert got["s.1"].missing == [got["s.1"].caption_txt] and got["s.1"].poses_c2w_npy.endswith("/s.1.poses_c2w.npy")
    assert got["s.2"].missing == [got["s.2"].shard_dir + "/s.2.caption.txt"]
    done = spark.createDataFrame([("s.2",), ("s.7",)], "sample_id string")
    assert [r.sample_id for r in readers.sample_paths(files, done).collect()] == ["s.2"]
    assert readers.sample_paths(files, done.limit(0)).count() == 2
    assert readers.sample_paths(files, required=("mp4",)).where("size(missing) > 0").count() == 0


def test_catalogue_files(spark, tmp_path):
    both = {"sources": {"a": {"type": "video", "pose_mode": "default", "nominal_duration_s": 10, "target_clips": 5, "license": "X", "subset_files": ["p", "q"], "new_hint": 1}, "b": {"type": "frames", "pose_mode": "gt_depth", "nominal_duration_s": 60, "target_clips": 2}}, "totals": {"total_clips": 7}}
    path = tmp_path / "sources.json"
    path.write_text(json.dumps(both))
    got = {r.name: r for r in catalogues.sources(spark, str(path)).collect()}
    assert (got["a"].pose_mode, got["a"].nominal_duration_s, got["a"].kind, got["a"].target_clips) == ("default", 10.0, "video", 5)
    assert got["a"].more == {"license": "X", "subset_files": '["p", "q"]'} and got["b"].more == {}
    path.write_text(json.dumps(both | {"totals": {"total_clips": 8}}))
    with pytest.raises(ValueError, match="add up to 7, not 8"):
        catalogues.sources(spark, str(path))
    del both["sources"]["b"]["type"]
    path.write_text(json.dumps(both))
    with pytest.raises(ValueError, match="b lacks type"):
        catalogues.sources(spark, str(path))


def test_threshold_files(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "t.yaml").write_text("per_source:\n  A:\n    dover: [0.25, 1.0]\n    vlm_entity: null\n    scene_cuts_max: 1\n  B:\n    dover: null\n")
    path = str(tmp_path / "t.yaml")
    assert sorted(map(tuple, catalogues.rules(spark, path).collect())) == [("A", "dover", 0.25, 1.0), ("A", "scene_cuts", None, 1.0)]
    assert sorted(r.source for r in catalogues.named(spark, path).collect()) == ["A", "B"]
    (tmp_path / "t.yaml").write_text("per_source:\n  A:\n    dover: 3\n")
    with pytest.raises(ValueError, match="A.dover: 3 is no range"):
        catalogues.rules(spark, path)


def test_one_boundary_for_all_verbs(spark):
    texts = ["He pans left", "a company", "panning", "Zoomed-in", "the camera", "fly-throughs", "walker walking", "", None, "spinned", "span"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    import re

    from reelsieve.config import CAMERA_PHRASE, FORBIDDEN_VERBS

    plain = re.compile("|".join([*map(C.verb_pattern, FORBIDDEN_VERBS), CAMERA_PHRASE]))
    assert {r.t: r.h for r in df.select("t", C.has_verb("t").alias("h")).collect()} == {t: None if t is None else bool(plain.search(t.lower())) for t in texts}


def test_sentences_are_stripped_one_by_one(spark):
    texts = ["A car.  It pans left!\nThe end", "No hit.\n\n Here? ", "Zoom.", " ", "", None, "one pan", "Stop. the camera. moves"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.s for r in df.select("t", C.strip_sentences(F.col("t")).alias("s")).collect()}
    assert got == dict(zip(texts, ["A car. The end", "No hit. Here?", "", "", "", None, "", "Stop. moves"], strict=True))


def test_sample_paths_takes_a_path_apart_once(spark):
    files = spark.createDataFrame([("x",)], "x string").select(F.upper("x").alias("path"))
    plan = readers.sample_paths(files)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract(") == 1 and plan.count("upper(") == 1
