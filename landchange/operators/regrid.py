"""Rasters onto other lattices. Survey ids stand in brackets.

A lattice is (left, top, pixel): pixel (r, c) has its centre at left + (c + 0.5) pixel, top - (r + 0.5) pixel. Both lattices are
in one coordinate system, or the targets bring their centres in the source's, so a warp is a projection before the join. Every
target looks its source pixels up by whole numbers in equi-joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

Lattice = tuple[float, float, float]


def centres(targets: DataFrame, lattice: Lattice) -> DataFrame:
    """[G6] adds x, y of the pixels' centres."""
    left, top, pixel = lattice
    return targets.withColumns({"x": F.lit(left) + (F.col("c") + 0.5) * pixel, "y": F.lit(top) - (F.col("r") + 0.5) * pixel})


def _fraction(lattice: Lattice) -> tuple[Column, Column]:
    left, top, pixel = lattice
    return (F.lit(top) - F.col("y")) / pixel, (F.col("x") - F.lit(left)) / pixel


def nearest(targets: DataFrame, source: DataFrame, lattice: Lattice, by: list[str], values: list[str]) -> DataFrame:
    """[S4, S12, G8] the values of the source pixel that a target's centre lies in; NULL outside the source. targets: by, r, c, x, y."""
    row, col = _fraction(lattice)
    at = targets.withColumns({"_r": F.floor(row).cast("int"), "_c": F.floor(col).cast("int")})
    held = source.select(*by, F.col("r").alias("_r"), F.col("c").alias("_c"), *values)
    return at.join(held, [*by, "_r", "_c"], "left").select(*targets.columns, *values)


def bilinear(targets: DataFrame, source: DataFrame, lattice: Lattice, by: list[str], value: str) -> DataFrame:
    """[S4, G8] the mean of the four source pixels around a target's centre, weighted by nearness; missing ones leave their weight
    to the others, and where none is left the value is NULL."""
    row, col = _fraction(lattice)
    at = targets.withColumns({"_fr": row - 0.5, "_fc": col - 0.5}).withColumns({"_r0": F.floor("_fr"), "_c0": F.floor("_fc")})
    part = lambda f, low, d: F.col(f) - F.col(low) if d else 1 - (F.col(f) - F.col(low))
    corners = [F.struct((F.col("_r0") + i).cast("int").alias("r"), (F.col("_c0") + j).cast("int").alias("c"), (part("_fr", "_r0", i) * part("_fc", "_c0", j)).alias("w")) for i in (0, 1) for j in (0, 1)]
    looks = at.select(*targets.columns, F.explode(F.filter(F.array(*corners), lambda k: k["w"] > 0)).alias("_k"))
    held = source.where(F.col(value).isNotNull()).select(*(F.col(b).alias(f"_s_{b}") for b in by), F.col("r").alias("_sr"), F.col("c").alias("_sc"), F.col(value).alias("_v"))
    match = (F.col("_k.r") == F.col("_sr")) & (F.col("_k.c") == F.col("_sc"))
    for b in by:
        match &= F.col(b) == F.col(f"_s_{b}")
    met = looks.join(held, match, "left").groupBy(*targets.columns)
    return met.agg(F.try_divide(F.sum(F.col("_k.w") * F.col("_v")), F.sum(F.when(F.col("_v").isNotNull(), F.col("_k.w")))).alias(value))


def mode(source: DataFrame, source_lattice: Lattice, lattice: Lattice, by: list[str], value: str) -> DataFrame:
    """[S8, G7, G8] (by, r, c, value): of the source pixels whose centres lie in a target pixel the most frequent value, the least of
    equals. Only target pixels with source pixels come out. One shuffle, counts first."""
    left, top, pixel = lattice
    placed = centres(source, source_lattice)
    counted = placed.groupBy(*by, F.floor((F.lit(top) - F.col("y")) / pixel).cast("int").alias("_tr"), F.floor((F.col("x") - F.lit(left)) / pixel).cast("int").alias("_tc"), value).agg(F.count("*").alias("_n"))
    best = counted.groupBy(*by, "_tr", "_tc").agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(value))
    return best.select(*by, F.col("_tr").alias("r"), F.col("_tc").alias("c"), value)


def max_merge(layers: DataFrame, keys: list[str], values: list[str], ceiling: float | None = None) -> DataFrame:
    """[S7, S8, S9] overlapping tiles as one layer: the highest value of each pixel; above `ceiling` it stands for none and is 0."""
    merged = layers.groupBy(*keys).agg(*(F.max(v).alias(v) for v in values))
    return merged if ceiling is None else merged.withColumns({v: F.when(F.col(v) > ceiling, 0).otherwise(F.col(v)) for v in values})
