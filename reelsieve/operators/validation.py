"""Checks of a clip's arrays and of a shard's samples, as columns and grouped aggregates, with reasons in words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import caption_reason, det3, orthogonality_error

#: Tolerances of rotation, of the first frame in quality control, of the first frame in packed shards; largest share of black frames.
SO3_TOLERANCE, FIRST_FRAME, FIRST_FRAME_PACKED, MOST_BLACK, BLACK_BELOW = 1e-3, 1e-2, 1e-3, 0.30, 10
#: A worker passes a clip below this flow and above this quality score.
MOST_FLOW, LEAST_QUALITY = 50.0, 0.3
#: Verdicts and issues that a reviewer may give.
VERDICTS = ("pass", "fail")
ISSUES = ("trajectory_jump", "bad_caption", "low_quality", "wrong_scale", "other")


def not_finite(x: Column) -> Column:
    return F.isnan(x) | (F.abs(x) == float("inf"))


def finite_counts(df: DataFrame, key: str, *arrays: str) -> DataFrame:
    """Per key: n_bad_<array>, the values that aren't finite, and reasons in words."""
    g = df.groupBy(key).agg(*[F.count_if(not_finite(F.col(a))).alias(f"n_bad_{a}") for a in arrays])
    why = F.array_compact(F.array(*[F.when(F.col(f"n_bad_{a}") > 0, F.format_string(f"{a}: %d non-finite values", f"n_bad_{a}")) for a in arrays]))
    return g.withColumn("reasons", why)


def aligned(**counts: Column) -> tuple[Column, Column]:
    """(all counts agree, else the reason)."""
    values = list(counts.values())
    same = values[0] == values[1]
    for v in values[2:]:
        same = same & (values[0] == v)
    same = F.coalesce(same, F.lit(False))
    return same, F.when(~same, F.format_string("t_mismatch: " + " ".join(f"{k}=%s" for k in counts), *[v.cast("string") for v in values]))


def rotations(df: DataFrame, key: str, t: str, pose: str, first_tolerance: float = FIRST_FRAME) -> DataFrame:
    """Per key: det_mean, det_std, orth_err, first_dev, so3_valid, first_frame_ok, reasons. pose: 16 numbers, row by row."""
    p = F.col(pose)
    unit = F.array(*[F.lit(float(i % 5 == 0)) for i in range(16)])
    away = F.array_max(F.zip_with(p, unit, lambda a, b: F.abs(a - b)))
    g = df.groupBy(key).agg(F.avg(det3(p)).alias("det_mean"), F.stddev_pop(det3(p)).alias("det_std"), F.max(orthogonality_error(p)).alias("orth_err"), F.max(F.when(F.col(t) == 0, away)).alias("first_dev"))
    g = g.withColumn("so3_valid", (F.abs(F.col("det_mean") - 1) <= SO3_TOLERANCE) & (F.col("orth_err") <= SO3_TOLERANCE)).withColumn("first_frame_ok", F.coalesce(F.col("first_dev") <= first_tolerance, F.lit(False)))
    why = [F.when(~F.col("so3_valid"), F.format_string("so3_invalid: det_mean=%.6f orth_err=%.2e", "det_mean", "orth_err")), F.when(~F.col("first_frame_ok"), F.format_string("first_frame_dev=%.4f", "first_dev"))]
    return g.withColumn("reasons", F.array_compact(F.array(*why)))


def valid_outputs(df: DataFrame, key: str, focal: tuple[str, str], *arrays: str) -> DataFrame:
    """Per key: valid, whether all values are finite and both focal lengths positive on every row, and the row count."""
    good = (F.col(focal[0]) > 0) & (F.col(focal[1]) > 0)
    for a in arrays:
        good = good & ~not_finite(F.col(a))
    return df.groupBy(key).agg(F.bool_and(F.coalesce(good, F.lit(False))).alias("valid"), F.count("*").alias("n"))


def black_frames(df: DataFrame, key: str, brightness: str, below: float = BLACK_BELOW, most: float = MOST_BLACK) -> DataFrame:
    """Per key: black_ratio, passed and the reason (shares in percent)."""
    g = df.groupBy(key).agg(F.avg((F.col(brightness) < below).cast("double")).alias("black_ratio"))
    why = F.when(F.col("black_ratio") > most, F.format_string(f"near_black_frac=%.2f%% > {most * 100:.0f}%%", F.bround(F.col("black_ratio") * 100, 2)))
    return g.withColumn("passed", F.col("black_ratio") <= most).withColumn("reason", F.coalesce(why, F.lit("ok")))


def length_mismatch(video: Column, arrays: Column) -> Column:
    """The reason where a decoded video has another length than its arrays; an undecoded one (0 or -1) says nothing."""
    return F.when((video > 0) & (video != arrays), F.format_string("length_mismatch: video=%d npy=%d", video, arrays))


def worker_passes(flow: Column, quality: Column, why: Column) -> Column:
    return F.coalesce((flow < MOST_FLOW) & (quality > LEAST_QUALITY) & (F.size(why) == 0), F.lit(False))


def frozen(given: dict, fixed: dict) -> None:
    """Parameters that may not be changed: a differing or missing one is an error that names all of them."""
    wrong = {k: given.get(k) for k, v in fixed.items() if given.get(k) != v}
    if wrong:
        raise ValueError("fixed parameters differ: " + ", ".join(f"{k}={v!r}, not {fixed[k]!r}" for k, v in sorted(wrong.items())))


def decisions(given: DataFrame, review: DataFrame, id_col: str, verdict: str, issue: str) -> DataFrame:
    """id, level (error, warning), message for each wrong field of a decision; a blank verdict or issue is allowed."""
    listed = review.select(F.col(id_col).alias("__id"), F.lit(True).alias("__listed")).distinct()
    rows = given.join(listed, F.col(id_col) == F.col("__id"), "left")
    v, i = F.coalesce(F.col(verdict), F.lit("")), F.coalesce(F.col(issue), F.lit(""))
    found = F.array_compact(
        F.array(
            F.when(F.col("__listed").isNull(), F.struct(F.lit("error").alias("level"), F.lit("id is not in the review list").alias("message"))),
            F.when((v != "") & ~v.isin(*VERDICTS), F.struct(F.lit("error").alias("level"), F.concat(F.lit("invalid verdict "), v).alias("message"))),
            F.when((i != "") & ~i.isin(*ISSUES), F.struct(F.lit("warning").alias("level"), F.concat(F.lit("unknown issue "), i).alias("message"))),
        )
    )
    return rows.select(id_col, F.explode(found).alias("x")).select(id_col, "x.level", "x.message")


def selected(frames: DataFrame, picks: DataFrame, key: str, t: str, at: str) -> DataFrame:
    """frames at the picked numbers, in the order of the picks (`place`); a pick outside a key's frames is an error."""
    n = frames.groupBy(key).agg((F.max(t) + 1).alias("__n"))
    inside = picks.join(n, key, "left")
    wrong = F.coalesce((F.col(at) < 0) | (F.col(at) >= F.col("__n")), F.lit(True))
    checked = inside.withColumn(at, F.when(wrong, F.raise_error(F.format_string("frame %s is outside [0, %s)", F.col(at).cast("string"), F.col("__n").cast("string"))).cast("long")).otherwise(F.col(at))).drop("__n")
    return checked.withColumnRenamed(at, t).join(frames, [key, t])


def stage1(df: DataFrame, min_len: Column, flag_limit: Column, fail_limit: Column, words: Column | None = None, saturation: tuple[Column, Column, Column] | None = None) -> tuple[Column, Column]:
    """(verdict, reasons in words) of a clip's first stage.

    df's columns: hard_reasons (array: why a hard check fails), n_jumps, caption. words: matched camera phrases (array), where
    the group checks them. saturation: value and the group's limits.
    """
    n = F.col("n_jumps")
    flags = [F.when(n > flag_limit, F.format_string("n_jumps=%d > max_jumps_flag=%d", n, flag_limit)), caption_reason(F.col("caption"), min_len)]
    if words is not None:
        flags.append(F.when(F.size(words) > 0, F.format_string("camera_word: '%s' (+%d more)", words[0], F.size(words) - 1)))
    if saturation:
        value, low, high = saturation
        flags.append(F.when(value.isNotNull() & low.isNotNull() & ~value.between(low, high), F.format_string("saturation=%.1f out of [%.1f,%.1f]", value, low, high)))
    found = F.array_compact(F.array(*flags))
    hard = F.size("hard_reasons") > 0
    verdict = F.when(hard | (n > fail_limit), "fail").when(F.size(found) > 0, "flag").otherwise("pass")
    return verdict, F.when(hard, F.col("hard_reasons")).when(n > fail_limit, F.array(F.format_string("n_jumps=%d > max_jumps_fail=%d", n, fail_limit))).otherwise(found)


def shard_audit(samples: DataFrame, shard: str, why: str) -> DataFrame:
    """Per shard: n_ok, n_fail and the sorted reasons that occur."""
    bad = F.size(why) > 0
    return samples.groupBy(shard).agg(F.count_if(~bad).alias("n_ok"), F.count_if(bad).alias("n_fail"), F.array_sort(F.array_distinct(F.flatten(F.collect_set(why)))).alias("reasons"))


def isolated(df: DataFrame, ok: Column, error: Column, by: str) -> DataFrame:
    """Per `by`: n_ok, n_fail and the first error in order; one sample's failure doesn't end the others' work."""
    return df.groupBy(by).agg(F.count_if(ok).alias("n_ok"), F.count_if(~ok).alias("n_fail"), F.min(F.when(~ok, error)).alias("first_error"))
