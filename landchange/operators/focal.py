"""Neighbourhood operators on a pixel table with mirrored edges. Survey ids stand in brackets.

A square window is separable: along columns within a row, then along rows within a column. A window's partition is one line of
one raster, so no task holds more than a line. Edges are mirrored with the edge pixel repeated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window


def _along(df: DataFrame, by: list[str], line: str, axis: str, size: str, reach: int, agg: Callable[[Column], Column], values: list[str]) -> DataFrame:
    """A frame function along one axis; `size` has the axis' length."""
    low = F.when(F.col(axis) < reach, -1 - F.col(axis))
    high = F.when(F.col(axis) >= F.col(size) - reach, 2 * F.col(size) - 1 - F.col(axis))
    # each pixel with its mirror images beyond the edges: only edge pixels have any
    places = F.filter(F.array(F.col(axis), low, high), lambda x: x.isNotNull())
    padded = df.withColumn("_at", F.explode(places))
    frame = Window.partitionBy(*by, line).orderBy("_at").rowsBetween(-reach, reach)
    keep = [c for c in df.columns if c not in values]
    return padded.select(*keep, "_at", *(agg(F.col(v)).over(frame).alias(v) for v in values)).where(F.col("_at") == F.col(axis)).drop("_at")


def focal(df: DataFrame, by: list[str], values: list[str], size: int, agg: Callable[[Column], Column] = F.avg) -> DataFrame:
    """[W2, W5] each value's mean (or maximum) over a size x size window. df: by, r, c, height, width and the values, a full
    lattice with height and width at least size // 2. Nulls are left out of a window."""
    reach = size // 2
    across = _along(df, by, "r", "c", "width", reach, agg, values)
    return _along(across, by, "c", "r", "height", reach, agg, values)


def focal_std(df: DataFrame, by: list[str], value: str, size: int, out: str) -> DataFrame:
    """[W3] sqrt(max(E[x^2] - E[x]^2, 0)); nulls are first filled with the raster's mean."""
    mean = df.groupBy(*by).agg(F.avg(value).alias("_mean")) if by else df.agg(F.avg(value).alias("_mean"))
    joined = df.join(mean, by) if by else df.join(F.broadcast(mean))
    filled = joined.withColumn("_x", F.coalesce(value, "_mean")).withColumn("_xx", F.col("_x") * F.col("_x")).drop("_mean")
    smooth = focal(filled, by, ["_x", "_xx"], size)
    return smooth.withColumn(out, F.sqrt(F.greatest(F.col("_xx") - F.col("_x") * F.col("_x"), F.lit(0.0)))).drop("_x", "_xx")


def position_index(df: DataFrame, by: list[str], value: str, size: int, out: str) -> DataFrame:
    """[W7] value minus its focal mean."""
    return focal(df.withColumn(out, F.col(value)), by, [out], size).withColumn(out, F.col(value) - F.col(out))


def slope(df: DataFrame, by: list[str], value: str, pixel_m: float, out: str) -> DataFrame:
    """[W6] degrees; central differences inside, one-sided ones at the edges."""

    def gradient(line: str, axis: str) -> Column:
        w = Window.partitionBy(*by, line).orderBy(axis)
        before, after, own = F.lag(value).over(w), F.lead(value).over(w), F.col(value)
        first, last = F.lag(F.lit(1)).over(w).isNull(), F.lead(F.lit(1)).over(w).isNull()
        return F.when(first & last, 0.0).when(first, (after - own) / pixel_m).when(last, (own - before) / pixel_m).otherwise((after - before) / (2 * pixel_m))

    graded = df.withColumn("_dx", gradient("r", "c")).withColumn("_dy", gradient("c", "r"))
    return graded.withColumn(out, F.degrees(F.atan(F.sqrt(F.col("_dx") * F.col("_dx") + F.col("_dy") * F.col("_dy"))))).drop("_dx", "_dy")
