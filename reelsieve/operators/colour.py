"""Colour of decoded frames as column arithmetic over their pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of 8-bit HSV: the saturation of pure colours, and the bits after the point of its fixed-point quotient.
FULL, BITS = 255, 12


def saturation(red: Column, green: Column, blue: Column) -> Column:
    """HSV saturation (0 to 255) of an 8-bit pixel, rounded in fixed point as 8-bit converters do; black has none."""
    high, low = F.greatest(red, green, blue), F.least(red, green, blue)
    quotient = F.bround(F.lit(float(FULL << BITS)) / high).cast("int")
    return F.when(high == 0, 0).otherwise(F.shiftright((high - low) * quotient + (1 << (BITS - 1)), BITS))


def frame_saturation(pixels: Column) -> Column:
    """Mean saturation of a frame of red, green, blue, red, ... numbers; null without pixels, an error if they are no triples."""
    n = F.size(pixels)
    at = F.sequence(F.lit(0), F.floor(n / 3).cast("int") - 1)
    total = F.aggregate(at, F.lit(0).cast("long"), lambda s, i: s + saturation(F.get(pixels, 3 * i), F.get(pixels, 3 * i + 1), F.get(pixels, 3 * i + 2)))
    wrong = F.raise_error(F.format_string("a frame of %d numbers has no whole pixels", n)).cast("double")
    return F.when(n % 3 != 0, wrong).when(n > 0, total / F.floor(n / 3))


def clip_saturation(frames: DataFrame, key: str, pixels: str) -> DataFrame:
    """key, n_frames, saturation: the mean of the frames' means; frames that aren't decoded (null) or are empty don't count, a clip without others has 0."""
    rows = frames.select(key, frame_saturation(F.col(pixels)).alias("__s"))
    return rows.groupBy(key).agg(F.count("__s").alias("n_frames"), F.coalesce(F.avg("__s"), F.lit(0.0)).alias("saturation"))


def grid_sample(df: DataFrame, keep: list[str], raster: str, height: str, width: str, grid: int = 32) -> DataFrame:
    """keep, gy, gx, y, x, value: each raster's values at grid * grid even places, from edge to edge, truncated to whole ones.

    raster: the values row by row, height * width of them; rasters of another length give no rows, a raster smaller than the
    grid gives some values more than once.
    """
    steps = F.sequence(F.lit(0), F.lit(grid - 1))

    def place(i: Column, n: str) -> Column:
        return F.floor(i * (F.col(n) - 1) / F.lit(max(1, grid - 1))).cast("int")

    rows = df.where(F.size(raster) == F.col(height) * F.col(width)).select(*keep, raster, height, width, F.explode(steps).alias("gy"))
    rows = rows.select(*keep, raster, height, width, "gy", F.explode(steps).alias("gx")).withColumn("y", place(F.col("gy"), height)).withColumn("x", place(F.col("gx"), width))
    return rows.select(*keep, "gy", "gx", "y", "x", F.element_at(raster, (F.col("y") * F.col(width) + F.col("x") + 1).cast("int")).cast("double").alias("value"))
