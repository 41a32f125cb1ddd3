"""Composites: one whole clear view per pixel. Survey ids stand in brackets.

Observation frames have the pixel's key columns, `day` and one column per band; a view is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def solar_day_mosaic(obs: DataFrame, keys: list[str], order: str, bands: list[str]) -> DataFrame:
    """[S5] one view per pixel and day: of each band the first non-null value in `order`. Days without any value give a row of
    nulls. One shuffle, with partial aggregation."""
    first = [F.min_by(b, F.when(F.col(b).isNotNull(), F.col(order))).alias(b) for b in bands]
    return obs.groupBy(*keys, "day").agg(*first)


def valid_views(obs: DataFrame, bands: list[str]) -> DataFrame:
    """[P6] views that have every requested band."""
    return obs.dropna(subset=bands)


def clear_counts(obs: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """[A1]"""
    return valid_views(obs, bands).groupBy(*keys).agg(F.count("*").alias("clear_count"))


def darker_quartile(obs: DataFrame, keys: list[str], bands: list[str], by: str = "blue", tie: str = "day") -> DataFrame:
    """[A2, W1] of each pixel's views the one whose `by` is at 0-based rank floor((n-1)/4), ties by `tie`: all bands from that
    one view, and clear_count. One shuffle; a pixel's views are bounded by the days of the window. Pixels without a valid view
    are absent; the lattice join brings them back as nulls."""
    rest = [c for c in bands if c != by]
    view = F.struct(F.col(by), F.col(tie), *rest)
    views = valid_views(obs, bands).groupBy(*keys).agg(F.array_sort(F.collect_list(view)).alias("_v"))
    at = F.floor((F.size("_v") - 1) / 4).cast("int")
    chosen = views.withColumn("_c", F.col("_v")[at])
    return chosen.select(*keys, *(F.col(f"_c.{b}").alias(b) for b in bands), F.col(f"_c.{tie}").alias(tie), F.size("_v").cast("bigint").alias("clear_count"))


def on_lattice(lattice: DataFrame, layer: DataFrame, keys: list[str]) -> DataFrame:
    """Every pixel of the lattice, with clear_count 0 where the layer has none."""
    return lattice.join(layer, keys, "left").withColumn("clear_count", F.coalesce("clear_count", F.lit(0).cast("bigint")))


def coverage(composite: DataFrame, by: list[str]) -> DataFrame:
    """[A3, A4] clear_fraction and median_clear over whole lattices, zeros included."""
    seen = F.avg((F.col("clear_count") > 0).cast("double")).alias("clear_fraction")
    return composite.groupBy(*by).agg(seen, F.median("clear_count").alias("median_clear"))


def scene_lists(scenes: DataFrame, by: list[str]) -> DataFrame:
    """[A5] distinct sorted platforms and dates, ids in order of time, and the scene count."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("datetime", "id"))), lambda s: s["id"])
    day = F.date_format("datetime", "yyyy-MM-dd")
    return scenes.groupBy(*by).agg(F.array_sort(F.collect_set("platform")).alias("platforms"), F.array_sort(F.collect_set(day)).alias("dates"), ordered.alias("ids"), F.count("*").alias("scene_count"))


def latest_baseline(scenes: DataFrame) -> DataFrame:
    """[P4, J3] a day's processing baseline: that of its last scene."""
    return scenes.groupBy("day").agg(F.max_by("baseline", "datetime").alias("baseline"))


def sides(composite: DataFrame, keys: list[str], side: str, bands: list[str]) -> DataFrame:
    """[J1] before and after of each pixel in one row, by conditional aggregation: one shuffle, no join."""
    pick = lambda s, b: F.max(F.when(F.col(side) == s, F.col(b))).alias(f"{b}_{s}")
    return composite.groupBy(*keys).agg(*(pick(s, b) for s in ("before", "after") for b in bands))


def share(flag: Column) -> Column:
    """Part of all rows for which the flag holds."""
    return F.avg(flag.cast("double"))
