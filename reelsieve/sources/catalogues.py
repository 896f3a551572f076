"""Configuration files as tables: the catalogue of sources and the per-source metric rules, from JSON or YAML."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from .readers import catalogue

# Fields of a source that a catalogue file may have; any other is left out.
SOURCE_FIELDS = ("citation", "type", "pose_mode", "nominal_duration_s", "real_or_synthetic", "target_clips", "repo_id", "repo", "subset", "project_url", "license", "hf_960p_mirror", "subset_hint", "subset_files")
_COLUMNS = ("pose_mode", "nominal_duration_s", "type", "target_clips")


def document(spark: SparkSession, path: str) -> dict:
    """A configuration file, which is small, from any file system that Spark reads; YAML (all but *.json) needs PyYAML."""
    text = spark.read.text(path, wholetext=True).first()
    if text is None:
        raise ValueError(f"{path} is empty")
    if path.endswith(".json"):
        return json.loads(text.value)
    try:
        import yaml
    except ImportError as e:
        raise ImportError(f"{path} needs PyYAML; the same content as JSON does not") from e
    return yaml.safe_load(text.value)


def sources(spark: SparkSession, path: str) -> DataFrame:
    """name, pose_mode, nominal_duration_s, kind, target_clips and a map `more` of a catalogue's sources.

    A file has sources: {name: {field: value}} and totals: {total_clips: n}; clips that don't add up to n are an error, and so
    are a pose mode that isn't known and a missing field of those above.
    """
    raw = document(spark, path)
    rows, more = [], []
    for name, fields in raw["sources"].items():
        if lacks := [c for c in _COLUMNS if c not in fields]:
            raise ValueError(f"{name} lacks {', '.join(lacks)}")
        rows.append((name, fields["pose_mode"], float(fields["nominal_duration_s"]), fields["type"], int(fields["target_clips"])))
        kept = {k: v for k, v in fields.items() if k in SOURCE_FIELDS and k not in _COLUMNS and v is not None}
        more.append((name, {k: v if isinstance(v, str) else json.dumps(v) for k, v in kept.items()}))
    known = catalogue(spark, rows, raw["totals"]["total_clips"])
    return known.join(F.broadcast(spark.createDataFrame(more, "name string, more map<string,string>")), "name")


def rules(spark: SparkSession, path: str) -> DataFrame:
    """source, metric, lo, hi of a threshold file: per_source: {source: {metric: [lo, hi] or null, scene_cuts_max: n or null}}.

    A metric without a range gives no row, as it is not checked for that source; a source without any is an error when its
    samples are judged only if the file doesn't name it, so `named` lists them all.
    """
    return config.rule_table(spark, _ranges(document(spark, path)))


def named(spark: SparkSession, path: str) -> DataFrame:
    """source: all that a threshold file names, those without a range too."""
    return spark.createDataFrame([(s,) for s in document(spark, path)["per_source"]], "source string")


def _ranges(raw: dict) -> dict[str, dict[str, tuple]]:
    out: dict[str, dict[str, tuple]] = {}
    for source, metrics in raw["per_source"].items():
        out[source] = {}
        for metric, limits in (metrics or {}).items():
            if limits is None:
                continue
            if metric == "scene_cuts_max":
                out[source]["scene_cuts"] = (None, limits)
            elif isinstance(limits, (list, tuple)) and len(limits) == 2:
                out[source][metric] = tuple(limits)
            else:
                raise ValueError(f"{source}.{metric}: {limits!r} is no range")
    return out
