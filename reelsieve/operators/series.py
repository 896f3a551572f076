"""Time-series kernels over frames: steps, folds, interpolation, chunks, smoothing, sampling of indexes."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import columns as C
from ..steps import written


def numbered(df: DataFrame, key: str, *order: str, out: str = "t") -> DataFrame:
    """Frame numbers 0, 1, ... within the key."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1)


def steps(df: DataFrame, key: str, order: list[str], coordinates: list[str], out: str = "step") -> DataFrame:
    """Length of the step from the frame before; null for the first."""
    w = Window.partitionBy(key).orderBy(*order)
    squares = [(F.col(c) - F.lag(c).over(w)) ** 2 for c in coordinates]
    return df.withColumn(out, F.abs(F.col(coordinates[0]) - F.lag(coordinates[0]).over(w)) if len(coordinates) == 1 else F.sqrt(sum(squares[1:], squares[0])))


def trajectory(df: DataFrame, key: str, threshold: Column, step: str = "step") -> DataFrame:
    """Per key: n_frames, total, mean and longest step, steps over the threshold (strictly); zeros without steps."""
    return df.groupBy(key).agg(
        F.count("*").alias("n_frames"),
        F.coalesce(F.sum(step), F.lit(0.0)).alias("traj_total"),
        F.coalesce(F.avg(step), F.lit(0.0)).alias("step_mean"),
        F.coalesce(F.max(step), F.lit(0.0)).alias("step_max"),
        F.count_if(F.col(step) > threshold).alias("n_jumps"),
    )


#: A clip of more frames than HOT is folded in at most PARTS parts.
HOT, PARTS = 1_000_000, 512


def ema(df: DataFrame, key: str, t: str, value: str, momentum: float = 0.99, out: str = "value") -> DataFrame:
    """key, t and the exponential moving average of the frames up to t.

    The first finite value seeds it; a null, NaN or infinite one repeats the last average without moving it; before the
    seed it is null. Momentum 0 gives the last finite value. Rows with equal t follow each other by value; a null key is a clip.

    The average is a recursion in the order of frames. Clips are dealt to partitions and sorted there, and one average is
    carried from batch to batch. A clip of more than HOT frames is cut at percentiles of t: what k finite values make of an
    average x is momentum^k x + b, so each part gives k and b, the parts' maps are put one after another, and each part is
    then folded from the average before it. Such a clip is on many tasks; its averages are the fold's up to rounding.
    """
    if not 0 <= momentum < 1:
        raise ValueError("the momentum has to be in [0, 1)")
    rows = df.select(key, t, F.col(value).cast("double").alias(out))
    hot = written(rows.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") > HOT).select(F.col(key).alias("__key")), "hot-clips")
    if hot.isEmpty():
        dealt = rows.select("*", F.lit(0).alias("__part"), F.lit(None).cast("double").alias("__before"))
        return _folded(dealt, key, t, momentum, out)
    own = F.col(key).eqNullSafe(F.col("__key"))
    edges = rows.join(hot, own, "left_semi").groupBy(F.col(key).alias("__key")).agg(F.array_distinct(F.percentile_approx(t, [i / PARTS for i in range(1, PARTS)], 100 * PARTS)).alias("__edges"))
    edges = written(edges, "clip-edges")
    part = F.coalesce(F.size(F.filter("__edges", lambda e: e < F.col(t))), F.lit(0))
    dealt = rows.join(edges, own, "left").select(key, t, out, part.alias("__part"), F.col("__edges").isNotNull().alias("__cut"))
    before = written(_carried(_maps(dealt.where("__cut").drop("__cut"), key, momentum, out), momentum), "clip-parts")
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.col("__part") == F.col("__at"))
    return _folded(dealt.join(before, same, "left").select(key, t, out, "__part", "__before"), key, t, momentum, out)


def _folded(rows: DataFrame, key: str, t: str, momentum: float, out: str) -> DataFrame:
    """Each part of a clip folded from __before, the average before it. rows: key, t, out, __part, __before."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last = None, None
        for batch in batches:
            averages = []
            for k, x, part, before in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if now != (k, part):
                    now, last = (k, part), before
                if x is not None and math.isfinite(x):
                    last = x if last is None else momentum * last + (1 - momentum) * x
                averages.append(last)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(averages, pa.float64())], names=[key, t, out])

    dealt = rows.repartition(key, "__part").sortWithinPartitions(key, "__part", t, out)
    return dealt.mapInArrow(fold, rows.select(key, t, out).schema)


def _maps(rows: DataFrame, key: str, momentum: float, out: str) -> DataFrame:
    """__key, __part, k, b, seeded for each part with finite values: it makes momentum^k x + b of an average x, and `seeded` of none.

    rows: key, t, out, __part; a part's rows are read in the order in which _folded reads them.
    """
    kind = rows.schema[key].dataType.simpleString()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        now, n, b, seeded = None, 0, 0.0, None
        for batch in batches:
            for k, x, part in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if now != (k, part):
                    if n:
                        made.append((*now, n, b, seeded))
                    now, n, b, seeded = (k, part), 0, 0.0, None
                if x is not None and math.isfinite(x):
                    n += 1
                    b = momentum * b + (1 - momentum) * x
                    seeded = x if seeded is None else momentum * seeded + (1 - momentum) * x
        if n:
            made.append((*now, n, b, seeded))
        columns = list(zip(*made, strict=True)) or [()] * 5
        kinds = (rows_kind, pa.int32(), pa.int64(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, a) for c, a in zip(columns, kinds, strict=True)], names=["__key", "__part", "k", "b", "seeded"])

    rows_kind = to_arrow_type(rows.schema[key].dataType)
    t = rows.columns[1]
    dealt = rows.repartition(key, "__part").sortWithinPartitions(key, "__part", t, out)
    return dealt.mapInArrow(summed, f"__key {kind}, __part int, k long, b double, seeded double")


def _carried(maps: DataFrame, momentum: float) -> DataFrame:
    """__key, __at, __before: the average before each part that has one; a clip has at most PARTS parts, put in order in one row."""
    parts = F.array_sort(F.collect_list(F.struct("__part", "k", "b", "seeded")))
    start = F.struct(F.lit(None).cast("double").alias("x"), F.array().cast("array<struct<at:int,before:double>>").alias("out"))

    def step(state, p):
        after = F.when(state["x"].isNull(), p["seeded"]).otherwise(F.pow(F.lit(momentum), p["k"]) * state["x"] + p["b"])
        return F.struct(after.alias("x"), F.concat(state["out"], F.array(F.struct((p["__part"] + 1).alias("at"), after.alias("before")))).alias("out"))

    rows = maps.groupBy("__key").agg(F.aggregate(parts, start, step)["out"].alias("out")).select("__key", F.explode("out").alias("o"))
    # A part without finite values makes no map: the average before a part is that of the last one that has.
    after = rows.select("__key", F.col("o.at").alias("from"), F.col("o.before").alias("__before"))
    until = F.coalesce(F.lead("from").over(Window.partitionBy("__key").orderBy("from")), F.lit(PARTS + 1))
    return after.withColumn("until", until).select("__key", F.explode(F.sequence("from", F.col("until") - 1)).alias("__at"), "__before")


def seeded(df: DataFrame, key: str, t: str, seed: str, value: str, out: str = "value") -> DataFrame:
    """key, t and the values, of which a key's first is its seed."""
    first = F.row_number().over(Window.partitionBy(key).orderBy(t)) == 1
    return df.select(key, t, F.when(first, F.col(seed)).otherwise(F.col(value)).alias(out))


def ratio_scale(df: DataFrame, keys: list[str], a: str, b: str, variant: str = "inverse_depth", min_valid: float = 1e-3) -> DataFrame:
    """Weighted least-squares scale b ~ s * a per key.

    inverse_depth: weights 1/a over valid a, b > min_valid, null without any; inverse_target: weights 1/(b + 1e-8) over
    values > 1e-8, 1.0 without any.
    """
    x, y = F.col(a), F.col(b)
    if variant == "inverse_depth":
        ok = (x > min_valid) & (y > min_valid) & ~F.isnan(x) & ~F.isnan(y) & (x != float("inf")) & (y != float("inf"))
        w, rest = 1 / x, F.lit(None).cast("double")
    else:
        ok, w, rest = (x > 1e-8) & (y > 1e-8), 1 / (y + 1e-8), F.lit(1.0)
    top, low = F.sum(F.when(ok, w * x * y)), F.sum(F.when(ok, w * x * x))
    return df.groupBy(*keys).agg(F.coalesce(F.try_divide(top, low), rest).alias("scale"))


def pairs(df: DataFrame, key: str, value: str, stride: int, limit: int | None = None) -> DataFrame:
    """Frame pairs (i, i + stride) for i = 0, stride, 2 stride, ... below min(n, limit) - stride; df has t."""
    w = Window.partitionBy(key).orderBy("t")
    n = F.count("*").over(Window.partitionBy(key))
    top = n if limit is None else F.least(n, F.lit(limit))
    both = df.select(key, "t", F.col(value).alias("a"), F.lead(value, stride).over(w).alias("b"), top.alias("__n"))
    return both.where((F.col("t") % stride == 0) & (F.col("t") < F.col("__n") - stride)).drop("__n")


def full_chunks(df: DataFrame, key: str, value: str, size: int) -> DataFrame:
    """Means of non-overlapping chunks of `size` frames; a shorter tail is dropped."""
    g = df.groupBy(key, F.floor(F.col("t") / size).alias("chunk")).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))
    return g.where(F.col("n") == size).drop("n")


def sliding_mean(df: DataFrame, key: str, value: str, size: int = 16, stride: int = 8) -> DataFrame:
    """Per frame the mean over all windows that hold it of the windows' means; windows start every `stride` frames, and one ends at the last."""
    n = df.groupBy(key).agg(F.count("*").alias("__n"))
    last = F.greatest(F.col("__n") - size, F.lit(0))
    frames = df.select(key, "t", value)
    # A frame is in the windows that start at the multiples of stride just before it, or in the tail window.
    reach = F.explode(F.sequence(F.floor((F.col("t") - size + stride) / stride).cast("long"), F.floor(F.col("t") / stride).cast("long"))).alias("k")
    at = frames.join(n, key).select(key, "t", value, "__n", reach)
    regular = at.where((F.col("k") >= 0) & ((F.col("k") * stride) <= last)).select(key, "t", value, (F.col("k") * stride).cast("long").alias("start"))
    tail = frames.join(n, key).where((last % stride != 0) & (F.col("t") >= last)).select(key, "t", value, last.cast("long").alias("start"))
    held = regular.unionByName(tail)
    means = held.groupBy(key, "start").agg(F.avg(value).alias("window_mean"))
    return held.join(means, [key, "start"]).groupBy(key, "t").agg(F.avg("window_mean").alias("smoothed"))


def interpolate(df: DataFrame, key: str, value: str, grid: int | DataFrame) -> DataFrame:
    """Linear interpolation of frames known at t (integers) to 0 ... grid - 1, clamped at both ends.

    grid: one length for all, or a table of key and n, each key's own length.
    """
    lengths = df.select(key).distinct().withColumn("n", F.lit(grid)) if isinstance(grid, int) else grid.select(key, F.col("n").cast("int").alias("n"))
    every = lengths.where("n > 0").select(key, F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("t"))
    rows = every.join(df.select(key, F.col("t").cast("int").alias("t"), F.col(value).alias("__v")), [key, "t"], "left")
    back = Window.partitionBy(key).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(key).orderBy("t").rowsBetween(0, Window.unboundedFollowing)
    at = F.when(F.col("__v").isNotNull(), F.col("t"))
    rows = rows.select(key, "t", F.last("__v", True).over(back).alias("v0"), F.last(at, True).over(back).alias("t0"), F.first("__v", True).over(ahead).alias("v1"), F.first(at, True).over(ahead).alias("t1"))
    lerp = F.when(F.col("t0") == F.col("t1"), F.col("v0")).otherwise(F.col("v0") + (F.col("v1") - F.col("v0")) * (F.col("t") - F.col("t0")) / (F.col("t1") - F.col("t0")))
    return rows.select(key, "t", F.coalesce(lerp, "v0", "v1").alias("value"))


def interpolate_arrays(df: DataFrame, key: str, t: str, values: str) -> DataFrame:
    """key, t, values for every frame from 0 to a key's last known one: arrays known at some frames, each element on a straight line between them.

    Before the first known frame its array is repeated. Known frames: integers, one row each; rows with a null t or array are none.
    """
    known = df.where(F.col(t).isNotNull() & F.col(values).isNotNull()).select(key, F.col(t).cast("int").alias("__t0"), F.col(values).alias("__v0"))
    w = Window.partitionBy(key).orderBy("__t0")
    legs = known.withColumns({"__t1": F.lead("__t0").over(w), "__v1": F.lead("__v0").over(w), "__from": F.when(F.lag("__t0").over(w).isNull(), F.least(F.lit(0), "__t0")).otherwise(F.col("__t0"))})
    # Each known frame lays the frames up to the next one; the first also those before it.
    frames = legs.withColumn("__t", F.explode(F.sequence("__from", F.coalesce(F.col("__t1") - 1, F.col("__t0"))))).where("__t >= 0")
    share = (F.col("__t") - F.col("__t0")) / (F.col("__t1") - F.col("__t0"))
    line = F.zip_with("__v0", "__v1", lambda a, b: a + (b - a) * share)
    return frames.select(key, F.col("__t").alias(t), F.when(F.col("__t") <= F.col("__t0"), F.col("__v0")).otherwise(line).alias(values))


def kernel(sigma: float) -> list[float]:
    half = max(1, math.ceil(3 * sigma))
    w = [math.exp(-0.5 * (d / sigma) ** 2) for d in range(-half, half + 1)]
    return [x / sum(w) for x in w]


def even_truncated(n: Column, count: int) -> Column:
    """`count` indexes from 0 to n - 1, truncated."""
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.floor(i * (n - 1) / (count - 1)).cast("int"))


def even_rounded(n: Column, count: int) -> Column:
    """min(n, count) indexes from 0 to n - 1, rounded half to even."""
    k = F.least(n, F.lit(count)).cast("int")
    return F.when(k <= 1, F.array(F.lit(0))).otherwise(F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.bround(i * (n - 1) / (k - 1)).cast("int")))


def resampled_index(i: Column, fps: float, n: Column, target: float = 16.0) -> Column:
    """The source frame of frame i at the target rate."""
    return F.least(F.bround(i * F.lit(fps) / F.lit(target)).cast("int"), (n - 1).cast("int"))


def focal_tracking(df: DataFrame, key: str, truth: str, found: str, slack: float = -5.0) -> DataFrame:
    """Per key: MAE, MAPE, ratio of the ranges, and whether the found track rises (no drop beyond the slack).

    Quotients are IEEE's: a zero truth makes the MAPE infinite, or NaN where the found value is zero too.
    """
    w = Window.partitionBy(key).orderBy("t")
    e = F.abs(F.col(found) - F.col(truth))
    rows = df.select(key, e.alias("e"), C.quotient(e, F.abs(F.col(truth))).alias("p"), truth, found, (F.col(found) - F.lag(found).over(w)).alias("d"))
    return rows.groupBy(key).agg(F.avg("e").alias("mae"), (100 * F.avg("p")).alias("mape"), C.quotient(F.max(found) - F.min(found), F.max(truth) - F.min(truth)).alias("range_ratio"), F.coalesce(F.min("d") > slack, F.lit(True)).alias("monotonic"))


def ordered_mean(df: DataFrame, key: str, order: list[str], value: str, out: str = "mean") -> DataFrame:
    """key and the mean of its values that aren't null, added up in the given order: the last digit doesn't depend on how the rows are dealt over tasks."""
    so_far = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = df.select(key, F.struct(F.count("*").over(so_far).alias("k"), F.sum(value).over(so_far).alias("sum"), F.count(value).over(so_far).alias("n")).alias("__s"))
    return rows.groupBy(key).agg(F.max("__s").alias("__s")).select(key, F.try_divide("__s.sum", "__s.n").alias(out))


def smoothed(df: DataFrame, key: str, t: str, value: str, sigma: float, out: str = "value") -> DataFrame:
    """key, t and the Gaussian mean of the frames around, with repeated edges, by lags and leads: a clip is never gathered.

    Unchanged for sigma <= 0.5 or fewer than 3 frames.
    """
    if sigma <= 0.5:
        return df.select(key, t, F.col(value).alias(out))
    w = kernel(sigma)
    half = len(w) // 2
    near, whole = Window.partitionBy(key).orderBy(t), Window.partitionBy(key).orderBy(t).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = df.select(key, t, F.col(value).alias("__v"), F.first(value).over(whole).alias("__first"), F.last(value).over(whole).alias("__last"), F.count("*").over(whole).alias("__n"))
    total = F.lit(0.0)
    for k, weight in enumerate(w):
        d = k - half
        at = F.col("__v") if d == 0 else F.coalesce(F.lag("__v", -d).over(near), F.col("__first")) if d < 0 else F.coalesce(F.lead("__v", d).over(near), F.col("__last"))
        total = total + weight * at
    return rows.select(key, t, F.when(F.col("__n") < 3, F.col("__v")).otherwise(total).alias(out))


def resampled(df: DataFrame, key: str, k: str, values: list[str], frames: int | Callable[[Column], Column]) -> DataFrame:
    """K known rows per key stretched evenly over 0 ... frames - 1: one row is repeated, as many as frames are copied, others interpolated."""
    from .generators import waypoints

    return waypoints(df, key, k, values, frames)
