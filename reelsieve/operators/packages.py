"""Writers with a contract, and packages for review and reference sets."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MEMBERS
from ..functions.columns import trimmed
from ..sources import tar_format


def replace_json(df: DataFrame, path: str) -> None:
    """df as JSON lines at path, in the place of what is there: written beside it and then renamed, so that readers find the old rows or the new ones.

    A failed write leaves the old rows and nothing else. Between the two renames, which take no data, path is not there.
    """
    spark = df.sparkSession
    passing, before = (f"{path.rstrip('/')}._{what}-{uuid.uuid4().hex}" for what in ("passing", "before"))
    at, new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, passing, before))
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        df.write.json(passing)
        if store.exists(at):
            store.rename(at, old)
        if not store.rename(new, at):
            raise OSError(f"{passing} could not be renamed to {path}")
    except BaseException:
        if store.exists(old) and not store.exists(at):
            store.rename(old, at)
        store.delete(new, True)
        raise
    store.delete(old, True)


def reviewed_manifests(df: DataFrame, path: str, id_col: str, verdict: str = "verdict", reviewed: str = "human_reviewed") -> None:
    """Folders pass, fail and human_reviewed with one id a line: of the final verdicts, and of those that a reviewer gave."""
    lists = {"pass": F.col(verdict) == "pass", "fail": F.col(verdict) == "fail", "human_reviewed": F.coalesce(F.col(reviewed), F.lit(False))}
    for name, listed in lists.items():
        df.where(listed).select(F.col(id_col).cast("string").alias("value")).write.mode("overwrite").text(f"{path}/{name}")


def caption_sidecar(df: DataFrame, id_col: str, original: str, revised: str) -> DataFrame:
    """sample_id, caption_original (empty for null), caption_revised of the samples whose caption was revised: a blank revision is none."""
    given = F.coalesce(F.col(revised), F.lit("")) != ""
    return df.where(given).select(F.col(id_col).alias("sample_id"), F.coalesce(F.col(original), F.lit("")).alias("caption_original"), F.col(revised).alias("caption_revised"))


def completeness(files: DataFrame, sample: str, ext: str, size: str, required: tuple[str, ...] = MEMBERS) -> DataFrame:
    """Per sample: n_files (required members that are there), bytes (of these), complete, missing (sorted). Of a repeated member the largest file counts."""
    one = files.where(F.col(ext).isin(*required)).groupBy(sample, ext).agg(F.max(size).alias("__b"))
    every = files.select(sample).distinct().join(one, sample, "left")
    have = every.groupBy(sample).agg(F.collect_set(ext).alias("__have"), F.coalesce(F.sum("__b"), F.lit(0)).cast("long").alias("bytes"))
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, required)), "__have"))
    return have.select(sample, F.size("__have").alias("n_files"), "bytes", (F.size(missing) == 0).alias("complete"), missing.alias("missing"))


def totals(complete: DataFrame, by: Column, name: str = "dataset") -> DataFrame:
    """Per dataset: n_samples, n_complete, pct (one digit), bytes of the complete samples."""
    done = F.col("complete")
    return complete.groupBy(by.alias(name)).agg(
        F.count("*").alias("n_samples"),
        F.count_if(done).alias("n_complete"),
        F.round(100 * F.avg(done.cast("double")), 1).alias("pct"),
        F.coalesce(F.sum(F.when(done, F.col("bytes"))), F.lit(0)).cast("long").alias("bytes"),
    )


def extraction(picks: DataFrame, members: DataFrame, sample: str, shard: str, wanted: str = "mp4") -> DataFrame:
    """sample, shard, ok, reason: whether each picked sample's wanted member can be taken out of its shard.

    picks: sample, shard. members: shard, sample, ext, size. Reasons: `tar not found` (no member of the shard at all), `video not in
    tar`, `empty video`; null where it can. Of repeated members one that isn't empty is enough.
    """
    there = members.select(F.col(shard).alias("__shard")).distinct()
    sizes = members.where(F.col("ext") == wanted).groupBy(F.col(shard).alias("__s"), F.col(sample).alias("__n")).agg(F.max("size").alias("__size"))
    rows = picks.select(sample, shard).join(there, F.col(shard) == F.col("__shard"), "left").join(sizes, (F.col(shard) == F.col("__s")) & (F.col(sample) == F.col("__n")), "left")
    why = F.when(F.col("__shard").isNull(), "tar not found").when(F.col("__n").isNull(), "video not in tar").when(F.col("__size") == 0, "empty video")
    return rows.select(sample, shard, why.isNull().alias("ok"), why.alias("reason"))


def by_rating(feedback: DataFrame, picks: DataFrame, sample: str, rating: str, order: tuple[str, ...]) -> DataFrame:
    """rating, n, n_ok, pct (of all ok ones): what could be extracted of each rating, ratings in the given order, then others by name.

    picks: sample, ok. A sample without a rating counts under null.
    """
    place = F.coalesce(*[F.when(F.col(rating) == r, F.lit(k)) for k, r in enumerate(order)], F.lit(len(order)))
    g = picks.select(sample, "ok").join(feedback.select(sample, rating), sample, "left").groupBy(rating).agg(F.count("*").alias("n"), F.count_if("ok").alias("n_ok"))
    total = g.agg(F.sum("n_ok").alias("__all"))
    return g.crossJoin(F.broadcast(total)).select(rating, place.alias("place"), "n", "n_ok", F.round(100 * F.try_divide("n_ok", "__all"), 1).alias("pct"))


def summary_text(picks: DataFrame, sample: str, group: str, verdict: str, why: str, metrics: dict[str, str]) -> Column:
    """A sample's entry in the summary of a reference set; reasons for flags only, a missing metric as N/A."""
    lines = [F.format_string("%s", F.col(sample)), F.concat(F.lit("  group: "), F.col(group)), F.concat(F.lit("  verdict: "), F.col(verdict))]
    lines.append(F.when(F.col(verdict) == "flag", F.concat(F.lit("  reasons: "), F.array_join(why, ", "))))
    lines += [F.concat(F.lit(f"  {label}: "), F.coalesce(F.col(c).cast("string"), F.lit("N/A"))) for label, c in metrics.items()]
    return F.concat_ws("\n", *lines)


#: Fields of the form that a reviewer fills in.
FORM = ("quality (excellent, good, acceptable, poor)", "use for training (yes, no)", "main issue", "notes")


def blank_form(sample: str, group: str, verdict: str, fields: tuple[str, ...] = FORM) -> Column:
    """A sample's entry in the annotation template, to be filled in by hand."""
    return F.concat_ws("\n", F.col(sample), F.concat_ws(" | ", F.col(group), F.col(verdict)), *[F.lit(f"[ ] {f}: ___________") for f in fields])


def reference_package(picks: DataFrame, members: DataFrame, path: str, sample: str, group: str, verdict: str, why: str, metrics: dict[str, str], capacity: int = 1000) -> DataFrame:
    """Write a reference set: the picked samples' members as tar shards, their records, a summary and a blank form; group, n_picked, n_packed, bytes.

    picks: one row a sample. members: sample, ext, data, of any samples: only the picked ones' are joined. A picked sample without
    any member is in the records and not in the shards.
    """
    spark = picks.sparkSession
    tar_format.register(spark)
    held = members.join(picks.select(sample).distinct(), sample, "left_semi").groupBy(sample, "ext").agg(F.first("data").alias("data"))
    packed = held.groupBy(sample).agg(F.map_from_entries(F.collect_list(F.struct("ext", "data"))).alias("members"))
    packed.select(F.col(sample).cast("string").alias("sample"), "members").write.format("tar").mode("overwrite").options(frames="unchecked", capacity=capacity).save(f"{path}/shards")
    replace_json(picks, f"{path}/records")
    for name, text in (("summary", summary_text(picks, sample, group, verdict, why, metrics)), ("form", blank_form(sample, group, verdict))):
        picks.select(sample, F.concat(text, F.lit("\n")).alias("value")).orderBy(sample).select("value").write.mode("overwrite").text(f"{path}/{name}")
    sizes = spark.read.format("tar").option("content", False).load(f"{path}/shards").groupBy(F.regexp_extract("name", r"^(.*?)\.(?:" + "|".join(x.replace(".", r"\.") for x in MEMBERS) + r"|[^.]*)$", 1).alias("__name")).agg(F.sum("size").alias("__bytes"))
    rows = picks.select(F.col(sample).cast("string").alias("__name"), group).join(sizes, "__name", "left")
    return rows.groupBy(group).agg(F.count("*").alias("n_picked"), F.count("__bytes").alias("n_packed"), F.coalesce(F.sum("__bytes"), F.lit(0)).cast("long").alias("bytes"))


def camera_record(clips: DataFrame, frames: DataFrame, key: str, passed: Column, why: Column, width: float, height: float) -> DataFrame:
    """key, record (JSON): a clip's result record, with medians of the intrinsics, fields of view, scales and the verdict.

    clips: key, mode. frames: key, fx, fy, scale. passed, why: over n, fx, fy (medians), fov_x, fov_y, focal_divergence, scale_min,
    scale_max, scale_cov; a clip without a frame has nulls and whatever they make of them.
    """
    finite = F.when(~F.isnan("scale") & (F.abs("scale") != float("inf")), F.col("scale"))
    g = frames.groupBy(key).agg(
        F.count("*").alias("n"), F.percentile("fx", F.lit(0.5)).alias("fx"), F.percentile("fy", F.lit(0.5)).alias("fy"), F.count("scale").alias("n_scales"),
        F.min("scale").alias("scale_min"), F.max("scale").alias("scale_max"), F.try_divide(F.stddev_pop(finite), F.avg(finite) + 1e-8).alias("scale_cov"),
    )
    rows = clips.join(g, key, "left")
    fov = lambda size, f: F.degrees(2 * F.atan(F.lit(size) / (2 * F.col(f))))
    rows = rows.withColumns({"fov_x": fov(width, "fx"), "fov_y": fov(height, "fy"), "focal_divergence": F.try_divide(F.abs(F.col("fx") - F.col("fy")), 0.5 * (F.col("fx") + F.col("fy")) + 1e-8)})
    record = F.struct(
        F.col(key).cast("string").alias("clip_id"),
        F.col("mode"),
        F.lit("camera-to-world (c2w), OpenCV axes").alias("convention"),
        F.struct(F.array(F.col("n"), F.lit(4), F.lit(4)).alias("shape")).alias("poses"),
        F.struct(F.array(F.col("n"), F.lit(4)).alias("shape"), F.array(*map(F.lit, ("fx", "fy", "cx", "cy"))).alias("layout")).alias("intrinsics"),
        F.struct(F.coalesce("n_scales", F.lit(0)).alias("count"), F.col("scale_min").alias("min"), F.col("scale_max").alias("max")).alias("scale"),
        F.struct(passed.alias("passed"), why.alias("reasons"), F.col("fov_x").alias("fov_x_deg"), F.col("fov_y").alias("fov_y_deg"), "focal_divergence", "scale_cov").alias("camera_qc"),
    )
    return rows.select(key, F.to_json(record).alias("record"))


def audited(samples: DataFrame, frames: int, found: Column, quality: Column) -> Column:
    """Reasons (array) why a packed sample breaks the constraints: shapes, types, first pose, camera quality, caption.

    samples: poses_shape, intrinsics_shape, scale_shape (arrays of numbers), poses_type, first_dev (largest deviation of the first
    pose from the identity), caption. found: forbidden verbs of the caption (array); quality: reasons of the camera's evaluation (array).
    """

    def shape(name: str, *tail: int) -> Column:
        want = F.array(*map(F.lit, (frames, *tail)))
        text = lambda x: F.concat(F.lit("("), F.array_join(x.cast("array<string>"), ","), F.lit(")"))
        return F.when(~F.col(f"{name}_shape").eqNullSafe(want), F.concat(F.lit(f"{name} shape "), F.coalesce(text(F.col(f"{name}_shape")), F.lit("none")), F.lit(" != "), text(want)))

    whole = F.col("poses_shape").eqNullSafe(F.array(*map(F.lit, (frames, 4, 4))))
    empty = F.coalesce(trimmed(F.col("caption")), F.lit("")) == ""
    why = [
        shape("poses", 4, 4),
        F.when(F.col("poses_type") != "float32", F.concat(F.lit("poses dtype "), F.col("poses_type"), F.lit(" != float32"))),
        shape("intrinsics", 1, 4),
        shape("scale"),
        F.when(whole & (F.col("first_dev") > tar_format.FIRST_POSE), "poses[0] != identity (first-frame anchor)"),
        F.when(empty, "caption empty").when(F.size(found) > 0, F.concat(F.lit("caption contains camera-action verbs: "), F.array_join(found, ", "))),
    ]
    return F.concat(F.array_compact(F.array(*why)), F.transform(F.coalesce(quality, F.array().cast("array<string>")), lambda r: F.concat(F.lit("camera quality: "), r)))
