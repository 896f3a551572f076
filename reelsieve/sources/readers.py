"""Readers: JSON lines, tables of text, catalogues, transforms, timestamps, member listings. Schemas are given, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import MEMBERS
from ..functions.columns import member_parts, sample_key

#: One sample's first-stage record.
RECORD = "sample_id string, `group` string, tar_path string, verdict string, flag_reasons array<string>, metrics struct<T:int,n_jumps:int,caption_len:int,focal_div_max:double,scale_cv:double,saturation:double>"
FEEDBACK = "sample_id string, quality_rating string, use_for_training boolean, issues array<string>, notes string, annotator string"


def json_lines(spark: SparkSession, paths: str | list[str], schema: str | T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good records, malformed lines with their file). Blank lines are neither. paths may be globs."""
    lines = spark.read.text(paths).select(F.col("value").alias("line"), F.input_file_name().alias("file")).where(F.trim("line") != "")
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    full = T.StructType([*kind.fields, T.StructField("_bad", T.StringType())])
    rows = lines.withColumn("__r", F.from_json("line", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    good = rows.where("__r._bad IS NULL").select(*[F.col(f"__r.`{f.name}`") for f in kind.fields])
    return good, rows.where("__r._bad IS NOT NULL").select("file", "line")


def completeness(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """sample_id of the rows that are marked complete (in any case, with any spaces)."""
    rows = spark.read.option("header", True).option("sep", sep).schema("sample_id string, file_count string, complete string").csv(path)
    return rows.where(F.upper(F.trim("complete")) == "TRUE").select("sample_id").distinct()


def manifest(lines: DataFrame, column: str, schema: str) -> DataFrame:
    """Typed fields of JSON objects, and a map `extra` of the keys that the schema doesn't name."""
    names = [f.name for f in T.StructType.fromDDL(schema).fields]
    typed = F.from_json(column, schema)
    every = F.from_json(column, "map<string,string>")
    return lines.select(typed.alias("r"), F.map_filter(every, lambda k, _: ~k.isin(*names)).alias("extra")).select("r.*", "extra")


def captions(index: DataFrame, key: str, raw: str) -> DataFrame:
    """key, caption: manifest.prompt.text of each JSON index, empty where it has none."""
    return index.select(key, F.coalesce(F.get_json_object(raw, "$.manifest.prompt.text"), F.lit("")).alias("caption"))


def catalogue(spark: SparkSession, rows: list[tuple], total: int | None = None) -> DataFrame:
    """Sources (name, pose_mode, nominal_duration_s, kind, target_clips); a given total is checked."""
    modes = {"default", "gt_pose", "gt_depth"}
    for r in rows:
        if r[1] not in modes:
            raise ValueError(f"pose_mode of {r[0]} is none of {sorted(modes)}: {r[1]}")
    if total is not None and sum(r[4] for r in rows) != total:
        raise ValueError(f"target_clips add up to {sum(r[4] for r in rows)}, not {total}")
    return spark.createDataFrame(rows, "name string, pose_mode string, nominal_duration_s double, kind string, target_clips long")


def timestamps(spark: SparkSession, path: str) -> DataFrame:
    """ts (double) and fields of lines separated by spaces, commas or tabs; lines that begin with # are comments."""
    parts = F.split(F.trim(F.regexp_replace("value", r"[,\t ]+", " ")), " ")
    rows = spark.read.text(path).where(~F.startswith(F.ltrim("value"), F.lit("#")) & (F.trim("value") != ""))
    return rows.select(parts[0].try_cast("double").alias("ts"), F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))).alias("fields")).where("ts IS NOT NULL")


def transforms(spark: SparkSession, path: str) -> DataFrame:
    """file_path, t, pose (16 doubles), fx, fy, cx, cy of transforms.json files, in the order of file_path."""
    schema = "fl_x double, fl_y double, cx double, cy double, frames array<struct<file_path:string,transform_matrix:array<array<double>>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    frames = F.array_sort("frames")
    rows = rows.select(F.col("fl_x").alias("fx"), F.col("fl_y").alias("fy"), "cx", "cy", F.posexplode(frames).alias("t", "f"))
    return rows.select("f.file_path", "t", F.flatten("f.transform_matrix").alias("pose"), "fx", "fy", "cx", "cy")


def split_frames(splits: DataFrame) -> DataFrame:
    """frame, pose: frames zipped with poses in each split, cut to the shorter list; of equal frames the later split's.

    splits: split (its order), frames array<int>, poses array<array<double>>.
    """
    n = F.least(F.size("frames"), F.size("poses"))
    pairs = splits.select("split", F.explode(F.arrays_zip(F.slice("frames", F.lit(1), n).alias("frame"), F.slice("poses", F.lit(1), n).alias("pose"))).alias("x"))
    return pairs.groupBy(F.col("x.0" if "0" in pairs.schema["x"].dataType.names else "x.frame").alias("frame")).agg(F.max_by(F.col("x.1" if "1" in pairs.schema["x"].dataType.names else "x.pose"), "split").alias("pose"))


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, length, modificationTime of the files below a folder; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "length", "modificationTime")


def sample_index(files: DataFrame, members: tuple[str, ...]) -> DataFrame:
    """sample_id, a map from member to its path, n_files, bytes: one row per sample of a listing."""
    sample, ext = member_parts(F.col("path"), members)
    rows = files.select(sample.alias("sample_id"), ext.alias("ext"), "path", "length").where(F.col("ext").isin(*members))
    one = rows.groupBy("sample_id", "ext").agg(F.min("path").alias("path"), F.min_by("length", "path").alias("length"))
    return one.groupBy("sample_id").agg(F.map_from_entries(F.collect_list(F.struct("ext", "path"))).alias("paths"), F.count("*").alias("n_files"), F.sum("length").alias("bytes"))


def sample_paths(files: DataFrame, done: DataFrame | None = None, members: tuple[str, ...] = MEMBERS, required: tuple[str, ...] = ("mp4", "caption.txt")) -> DataFrame:
    """Where the files of each unpacked sample are: sample_id, shard_dir, a path column for each member, and `missing`.

    files: path. A sample is an mp4 in a folder final_wds-*/wds-*/w*/shard-*; of several the last in the order of paths counts.
    Paths are those that its members have to have; `missing` holds the paths of required members that aren't there. done:
    sample_id of the complete samples, the only ones to be kept; an empty table or none keeps all.
    """

    def parts(path: Column) -> Column:
        sample, ext = member_parts(path, members)
        return F.struct(F.regexp_extract(path, r"^(.*)/[^/]+$", 1).alias("shard_dir"), sample.alias("sample_id"), ext.alias("ext"))

    def wanted(x: Column) -> Column:
        return x["ext"].isin(*members) & x["shard_dir"].rlike(r"(?:^|/)final_wds-[^/]*/wds-[^/]*/w[^/]*/shard-[^/]*$")

    # Within a generator a path is taken apart once; a filter behind a select would do it for itself and once more for each column.
    rows = files.select(F.inline(F.filter(F.transform(F.array("path"), parts), wanted)))
    # One shuffle serves both aggregates.
    rows = rows.repartition("sample_id")
    there = rows.groupBy("sample_id", "shard_dir").agg(*[F.max(F.col("ext") == m).alias(f"_{k}") for k, m in enumerate(members)])
    last = there.where(f"_{members.index('mp4')}").groupBy("sample_id").agg(F.max(F.struct("shard_dir", *[f"_{k}" for k in range(len(members))])).alias("s"))
    path = {m: F.concat("s.shard_dir", F.lit("/"), "sample_id", F.lit(f".{m}")) for m in members}
    lost = F.array_compact(F.array(*[F.when(~F.col(f"s._{k}"), path[m]) for k, m in enumerate(members) if m in required]))
    out = last.select("sample_id", "s.shard_dir", *[path[m].alias(m.replace(".", "_")) for m in members], lost.alias("missing"))
    return out if done is None or done.isEmpty() else out.join(done.select("sample_id"), "sample_id", "left_semi")


def shard_parts(path: Column) -> dict[str, Column]:
    """Dataset, worker and shard of `.../final_wds-X/wds-X/w000/shard-000000.tar`."""
    return {"dataset": F.regexp_extract(path, r"/final_(wds-[^/]+)/", 1), "worker": F.regexp_extract(path, r"/(w\d+)/[^/]*$", 1), "shard": F.regexp_extract(path, r"([^/]+)\.tar$", 1)}


def keys(names: DataFrame, column: str) -> DataFrame:
    """Distinct sample keys of member names."""
    return names.select(sample_key(F.col(column)).alias("key")).distinct()
