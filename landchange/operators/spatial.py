"""Points near other points, and points in regions.

Regions: a trapezoidal decomposition. Boundaries are cut into vertical strips of about equal edge counts (from quantiles of
the edges), strips are distributed; inside a strip the edges' ends cut the plane into slabs in which a region's edges have one
order, so a point is located by a binary search for its slab and one among the slab's edges. Points of a crowded strip are
spread over several tasks, each with a copy of that strip's edges: about as many begin there in every strip, and those that
pass through come on top. A task holds the edges of as many slabs at once as SLAB_ENTRIES allows.

Points: a grid of latitude bands whose cells are as wide as the distance, on a sphere, across poles and the date line. Each
point looks into five cells, so that each pair is met once; the join's work follows the number of close pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from landchange.functions.geojson import polygons
from landchange.session import stage

EARTH_R = 6371007.2
#: Edges that begin in a strip, on average, points of a strip that one task takes, the most strips, and entries of edges in slabs
#: that a task holds at once.
STRIP_EDGES, STRIP_POINTS, MAX_STRIPS, SLAB_ENTRIES = 5_000, 50_000, 100_000, 2_000_000


def valid_position(lon: Column, lat: Column) -> Column:
    """False for null, NaN and impossible positions."""
    return F.coalesce(lon.between(-180, 180) & lat.between(-90, 90), F.lit(False))


def _band_cells(band: Column, metres: float, bands: int, radius: float) -> Column:
    """Cells in a latitude band: so many that a cell is at least as wide as any pair's difference in longitude there."""
    height = 180.0 / bands
    far = F.greatest(F.abs((band - 1) * F.lit(height) - 90), F.abs((band + 2) * F.lit(height) - 90))
    ratio = F.lit(math.sin(metres / (2 * radius))) / F.cos(F.radians(F.least(far, F.lit(90.0))))
    width = F.degrees(2 * F.asin(F.least(ratio, F.lit(1.0)))) * 1.000001
    return F.when((ratio >= 1) | (far >= 90), F.lit(1)).otherwise(F.greatest(F.lit(1), F.floor(F.lit(360.0) / width))).cast("long")


def _cell(lon: Column, cells: Column) -> Column:
    return F.pmod(F.floor((lon + 180) / 360 * cells), cells).cast("long")


def sphere_metres(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius: float = EARTH_R) -> Column:
    """Great-circle distance (haversine)."""
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)
    return F.lit(2 * radius) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def close_pairs(points: DataFrame, key: str, lon: str, lat: str, metres: float, by: list[str] = [], radius: float = EARTH_R) -> DataFrame:
    """Pairs (key_a, key_b, metres), key_a < key_b, of points at most `metres` apart that agree in `by`.

    key must be unique once exact copies are dropped, which this does. Null or impossible positions and null `by` values or
    keys are in no pair; equal positions are pairs at 0 m; an empty table gives none.
    """
    bands = max(1, math.floor(math.pi * radius / metres / 1.000001))
    clean = points.where(valid_position(F.col(lon), F.col(lat)) & F.col(key).isNotNull()).select(
        F.col(key).alias("_k"), F.col(lon).cast("double").alias("_x"), F.col(lat).cast("double").alias("_y"), *(F.col(c).alias(f"_by{i}") for i, c in enumerate(by))
    ).distinct()
    band = F.least(F.floor((F.col("_y") + 90) / 180 * bands), F.lit(bands - 1)).cast("long")
    homes = clean.withColumn("_band", band).withColumn("_n", _band_cells(F.col("_band"), metres, bands, radius)).withColumn("_cell", _cell(F.col("_x"), F.col("_n")))
    up = _band_cells(F.col("_band") + 1, metres, bands, radius)
    above = _cell(F.col("_x"), up)
    probe = lambda b, c: F.struct(b.alias("b"), c.alias("c"))
    here = [probe(F.col("_band"), F.col("_cell")), probe(F.col("_band"), F.pmod(F.col("_cell") + 1, F.col("_n")))]
    next_up = [probe(F.col("_band") + 1, F.pmod(above + d, up)) for d in (-1, 0, 1)]
    looks = homes.select("*", F.explode(F.array_distinct(F.array(*here, *next_up))).alias("_p"))
    a, b = looks.alias("a"), homes.alias("b")
    same_band = F.col("a._p.b") == F.col("a._band")
    # in the own cell, and where a band has so few cells that looking ahead goes round, both points see each other
    once = ~same_band | ((F.col("a._p.c") != F.col("a._cell")) & (F.col("a._n") > 2)) | (F.col("a._k") < F.col("b._k"))
    match = (F.col("a._p.b") == F.col("b._band")) & (F.col("a._p.c") == F.col("b._cell"))
    for i in range(len(by)):
        match &= F.col(f"a._by{i}") == F.col(f"b._by{i}")
    pairs = a.join(b, match & once & (F.col("a._k") != F.col("b._k")), "inner")
    apart = sphere_metres(F.col("a._x"), F.col("a._y"), F.col("b._x"), F.col("b._y"), radius)
    return pairs.select(F.least("a._k", "b._k").alias("key_a"), F.greatest("a._k", "b._k").alias("key_b"), apart.alias("metres")).where(F.col("metres") <= metres)


def region_edges(regions: DataFrame, key: str, geometry: str) -> DataFrame:
    """Boundary edges (region, part, x0, y0, x1, y1), x0 < x1, of GeoJSON areas; upright edges bound no slab and are left
    out. part numbers a region's polygons. Texts that hold no polygon give none."""
    kind = regions.schema[key].dataType.simpleString()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, text in zip(batch["_key"], batch["_geometry"]):
                for part, rings in enumerate(polygons(text)):
                    for ring in rings:
                        p = np.array(ring)
                        e = np.hstack([p[:-1], p[1:]])
                        e[e[:, 0] > e[:, 2]] = e[e[:, 0] > e[:, 2]][:, [2, 3, 0, 1]]
                        e = e[e[:, 0] < e[:, 2]]
                        out.append(pd.DataFrame(e, columns=["x0", "y0", "x1", "y1"]).assign(region=k, part=part))
            if out:
                yield pd.concat(out)[["region", "part", "x0", "y0", "x1", "y1"]]

    source = regions.where(F.col(key).isNotNull() & F.col(geometry).isNotNull()).select(F.col(key).alias("_key"), F.col(geometry).alias("_geometry"))
    return source.mapInPandas(read, f"region {kind}, part INT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE")


def locate_in_slabs(px: np.ndarray, py: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Which points lie inside the even-odd area bounded by edges (rows x0, y0, x1, y1; x0 < x1)."""
    xs = np.unique(np.concatenate([edges[:, 0], edges[:, 2]]))
    slab = np.searchsorted(xs, px, "right") - 1
    inside = np.zeros(len(px), bool)
    hit = np.flatnonzero((slab >= 0) & (slab < len(xs) - 1))
    if not len(hit):
        return inside
    # slabs that hold points get their edges; each (slab, edge) entry once, and no others are listed
    wanted = np.unique(slab[hit])
    first, last = np.searchsorted(wanted, np.searchsorted(xs, edges[:, 0])), np.searchsorted(wanted, np.searchsorted(xs, edges[:, 2]))
    if (last - first).sum() > SLAB_ENTRIES and len(wanted) > 1:  # long edges in many slabs: the slabs in two parts
        below = px < xs[wanted[len(wanted) // 2]]
        for part in (np.flatnonzero(below), np.flatnonzero(~below)):
            meet = (edges[:, 2] > px[part].min()) & (edges[:, 0] <= px[part].max()) if len(part) else np.zeros(len(edges), bool)
            if meet.any():
                inside[part] = locate_in_slabs(px[part], py[part], edges[meet])
        return inside
    which = np.repeat(np.arange(len(edges)), last - first)
    at = wanted[np.arange(len(which)) - np.repeat(np.cumsum(last - first) - (last - first), last - first) + np.repeat(first, last - first)]
    e = edges[which]
    slope = (e[:, 3] - e[:, 1]) / (e[:, 2] - e[:, 0])
    y_at = lambda x: e[:, 1] + (x - e[:, 0]) * slope
    left, right = y_at(xs[at]), y_at(xs[at + 1])
    order = np.lexsort(((left + right) / 2, at))
    at, e, slope, left, right = at[order], e[order], slope[order], left[order], right[order]
    begin, end = np.searchsorted(at, np.arange(len(xs) - 1), "left"), np.searchsorted(at, np.arange(len(xs) - 1), "right")
    # edges that cross inside a slab have no order there: those slabs are counted edge by edge
    same = at[1:] == at[:-1]
    crossed = np.zeros(len(xs) - 1, bool)
    tiny = 1e-12
    crossed[at[1:][same & ((left[1:] < left[:-1] - tiny) | (right[1:] < right[:-1] - tiny))]] = True
    s = slab[hit]
    x, y = px[hit], py[hit]
    lo, hi = begin[s].copy(), end[s].copy()
    active = (lo < hi) & ~crossed[s]
    while active.any():
        mid = (lo + hi) // 2
        m = np.where(active, mid, 0)
        below = e[m, 1] + (x - e[m, 0]) * slope[m] <= y
        lo = np.where(active & below, mid + 1, lo)
        hi = np.where(active & ~below, mid, hi)
        active = (lo < hi) & ~crossed[s]
    count = lo - begin[s]
    for j in np.flatnonzero(crossed[s]):
        r = slice(begin[s[j]], end[s[j]])
        count[j] = int((e[r, 1] + (x[j] - e[r, 0]) * slope[r] <= y[j]).sum())
    inside[hit] = count % 2 == 1
    return inside


def points_in_regions(points: DataFrame, key: str, lon: str, lat: str, regions: DataFrame, region_key: str, geometry: str) -> DataFrame:
    """Distinct (key, region): the regions (GeoJSON areas, edges straight in lon/lat, holes outside) a point lies in.

    Null or impossible positions lie nowhere; regions without a polygon hold nothing; a region delivered twice counts once.
    A point on a boundary counts as inside or outside, the same way for every run.
    """
    # parsed once, read for counts, cuts and search
    edges = stage(region_edges(regions, region_key, geometry).distinct(), "edges")
    clean = points.where(valid_position(F.col(lon), F.col(lat)) & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(lon).cast("double").alias("x"), F.col(lat).cast("double").alias("y")).distinct()
    return points_in_areas(clean, edges).select(F.col("k").alias(key), "region")


def points_in_areas(points: DataFrame, edges: DataFrame) -> DataFrame:
    """[X2] distinct (k, region) of planar points (k, x, y), without nulls, and even-odd areas given as edges (region, part, x0,
    y0, x1, y1), x0 < x1; a point in any part of a region is in it. edges are read several times: written, or cheap to make."""
    spark = points.sparkSession
    # strips of about STRIP_EDGES edges; the cuts are at most MAX_STRIPS numbers
    strips = min(MAX_STRIPS, edges.count() // STRIP_EDGES + 1)
    cuts = np.unique(edges.approxQuantile("x0", [i / strips for i in range(1, strips)], 0.1 / strips)) if strips > 1 else np.array([])
    shared = spark.sparkContext.broadcast(cuts)
    point_kind, region_kind = points.schema["k"].dataType.simpleString(), edges.schema["region"].dataType.simpleString()

    def strip_of_points(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(strip=np.searchsorted(shared.value, batch["x"], "right").astype("int32"))

    def strips_of_edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            low, high = np.searchsorted(shared.value, batch["x0"], "right"), np.searchsorted(shared.value, batch["x1"], "left")
            high = np.maximum(low, high)
            out = batch.loc[batch.index.repeat(high - low + 1)].copy()
            out["strip"] = (np.concatenate([np.arange(a, b + 1) for a, b in zip(low, high)]) if len(batch) else np.array([])).astype("int32")
            yield out[["strip", "region", "part", "x0", "y0", "x1", "y1"]]

    placed = points.select("k", "x", "y").mapInPandas(strip_of_points, f"k {point_kind}, x DOUBLE, y DOUBLE, strip INT")
    cut_edges = edges.mapInPandas(strips_of_edges, f"strip INT, region {region_kind}, part INT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE")
    # at most MAX_STRIPS rows: how many tasks share a strip's points
    shares = placed.groupBy("strip").agg((F.count("*") / STRIP_POINTS + 1).cast("int").alias("shares"))
    spread = placed.join(F.broadcast(shares), "strip").withColumn("share", F.pmod(F.xxhash64("x", "y"), F.col("shares")).cast("int")).select("strip", "share", "k", "x", "y")
    wanted = shares.select(F.col("strip").alias("s"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("copy"))
    copied = cut_edges.join(wanted, F.col("strip") == F.col("s")).select("s", "copy", "region", "part", "x0", "y0", "x1", "y1")

    def search(p: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        x, y, keys, out = p["x"].to_numpy(), p["y"].to_numpy(), p["k"].to_numpy(), []
        for (region, _), own in e.groupby(["region", "part"], sort=False) if len(p) else []:
            edge = own[["x0", "y0", "x1", "y1"]].to_numpy()
            near = np.flatnonzero((x >= edge[:, 0].min()) & (x <= edge[:, 2].max()) & (y >= edge[:, [1, 3]].min()) & (y <= edge[:, [1, 3]].max()))
            if len(near):
                out.append(pd.DataFrame({"k": keys[near[locate_in_slabs(x[near], y[near], edge)]], "region": region}))
        return pd.concat(out) if out else pd.DataFrame({"k": [], "region": []}, dtype=object)  # any type can be made of it

    found = spread.groupBy("strip", "share").cogroup(copied.groupBy("s", "copy")).applyInPandas(search, f"k {point_kind}, region {region_kind}")
    return found.distinct()
