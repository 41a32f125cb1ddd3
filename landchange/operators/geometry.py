"""Planar geometry. Survey ids stand in brackets.

A ring is ARRAY<STRUCT<x, y>>, closed; a polygon is an array of rings, the first the outline; a geometry an array of polygons.
Measures are Column expressions; what rebuilds outlines is an Arrow kernel.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from landchange.functions import crs, geojson
from landchange.operators import overlap
from landchange.operators.spatial import points_in_areas
from landchange.session import stage


def ring_pairs(ring: Column) -> Column:
    """Segments (a, b) of a ring."""
    return F.arrays_zip(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))).alias("a"), F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))).alias("b"))


def ring_area(ring: Column) -> Column:
    """[X1] unsigned shoelace area."""
    cross = F.transform(ring_pairs(ring), lambda s: s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda a, v: a + v)) / 2


def polygon_area(polygon: Column) -> Column:
    """[X1] outline less holes."""
    areas = F.transform(polygon, ring_area)
    return F.aggregate(F.slice(areas, 2, F.greatest(F.size(areas) - 1, F.lit(0))), F.element_at(areas, 1), lambda a, v: a - v)


def edges(polygons: DataFrame, keys: list[str], polygon: str) -> DataFrame:
    """One row per edge: keys, x0, y0, x1, y1. A null or empty polygon gives none."""
    segments = F.flatten(F.transform(F.col(polygon), ring_pairs))
    return polygons.select(*keys, F.explode(segments).alias("_s")).select(*keys, F.col("_s.a.x").alias("x0"), F.col("_s.a.y").alias("y0"), F.col("_s.b.x").alias("x1"), F.col("_s.b.y").alias("y1"))


def edge_distance(x: Column, y: Column) -> Column:
    """[X6] distance of (x, y) from this row's edge."""
    x0, y0, dx, dy = F.col("x0"), F.col("y0"), F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    along = F.coalesce(F.try_divide((x - x0) * dx + (y - y0) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    ex, ey = x - (x0 + t * dx), y - (y0 + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def zone_of_points(points: DataFrame, keys: list[str], x: str, y: str, polygons: DataFrame, zone: str, polygon: str, buffer: float) -> DataFrame:
    """[J4, J5, X2, X5, X6, X8] (keys, zone, inside, distance, in_buffer) of points in a zone or within `buffer` of it.

    inside is even-odd by the point itself, from the slabs of `points_in_areas`; distance is 0 inside. Outside, edges meet points
    in square cells of the buffer's size along each edge, so an edge is only compared with points it may reach.
    """
    step = float(max(buffer, 1.0))
    ed = edges(polygons, [zone], polygon)
    at = F.struct(*keys)
    clean = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(at.alias("k"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    turned = F.col("x0") > F.col("x1")
    pick = lambda a, b: F.when(turned, F.col(b)).otherwise(F.col(a))
    upright = F.col("x0") == F.col("x1")
    sided = ed.where(~upright).select(F.col(zone).alias("region"), F.lit(0).alias("part"), pick("x0", "x1").alias("x0"), pick("y0", "y1").alias("y0"), pick("x1", "x0").alias("x1"), pick("y1", "y0").alias("y1"))
    inside = points_in_areas(clean, stage(sided, "zone-edges"))
    # cells that an edge, widened by the buffer, runs through: column by column
    cell = lambda v: F.floor(v / F.lit(step))
    low, high, reach = F.least("x0", "x1"), F.greatest("x0", "x1"), F.lit(float(buffer))
    wide = ed.withColumn("_cx", F.explode(F.sequence(cell(low - reach), cell(high + reach))))
    along = lambda v: F.col("y0") + (F.col("y1") - F.col("y0")) * F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(v - F.col("x0"), F.col("x1") - F.col("x0"))))
    left, right = along(F.col("_cx") * step - reach), along((F.col("_cx") + 1) * step + reach)
    bottom = F.when(upright, F.least("y0", "y1")).otherwise(F.least(left, right))
    top = F.when(upright, F.greatest("y0", "y1")).otherwise(F.greatest(left, right))
    cut = wide.withColumn("_cy", F.explode(F.sequence(cell(bottom - reach), cell(top + reach))))
    placed = clean.withColumn("_cx", cell(F.col("x"))).withColumn("_cy", cell(F.col("y")))
    near = placed.join(cut, ["_cx", "_cy"]).groupBy("k", zone).agg(F.min(edge_distance(F.col("x"), F.col("y"))).alias("_d")).where(F.col("_d") <= buffer)
    ring = near.join(inside.select("k", F.col("region").alias(zone)), ["k", zone], "left_anti").select("k", zone, F.lit(False).alias("inside"), F.col("_d").alias("distance"))
    both = inside.select("k", F.col("region").alias(zone), F.lit(True).alias("inside"), F.lit(0.0).alias("distance")).unionByName(ring)
    return both.select("k.*", zone, "inside", "distance", (~F.col("inside")).alias("in_buffer"))


def geojson_polygons(text: Column) -> Column:
    """GeoJSON texts as geometries, as an Arrow kernel; NULL where a text has no polygon."""

    @F.pandas_udf(f"ARRAY<ARRAY<{RING_DDL}>>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[[[{"x": x, "y": y} for x, y in ring] for ring in rings] for rings in geojson.polygons(t)] or None for t in texts], dtype=object)

    return run(text)


def measured_ha(areas: DataFrame, geometry: str, out: str = "measured") -> DataFrame:
    """[X11] adds the area of a geometry in degrees, in hectares in the UTM zone of its box's middle."""
    x = F.transform(F.flatten(F.flatten(geometry)), lambda p: p["x"])
    zoned = areas.withColumn("_zone", crs.utm_zone((F.array_min(x) + F.array_max(x)) / 2))

    def metres(p: Column) -> Column:
        e, n = crs.utm_forward(p["x"], p["y"], F.col("_zone"))
        return F.struct(e.alias("x"), n.alias("y"))

    planar = F.transform(F.col(geometry), lambda polygon: F.transform(polygon, lambda ring: F.transform(ring, metres)))
    return zoned.withColumn(out, F.aggregate(F.transform(planar, polygon_area), F.lit(0.0), lambda a, v: a + v) / 10000).drop("_zone")


def placed(rings: list, lon: float, lat: float, pixel_m: float) -> list[list[tuple[float, float]]]:
    """Rings in pixels (x right, y down) as closed rings in degrees, their centre of area at (lon, lat)."""
    area, mx, my = 0.0, 0.0, 0.0
    for pts in rings:
        cross = [(a[0] * b[1] - b[0] * a[1], a, b) for a, b in zip(pts, [*pts[1:], pts[0]])]
        twice = sum(k for k, _, _ in cross)
        sign = 1 if twice > 0 else -1
        area += sign * twice
        mx, my = mx + sign * sum(k * (a[0] + b[0]) for k, a, b in cross), my + sign * sum(k * (a[1] + b[1]) for k, a, b in cross)
    if not area:
        return []
    cx, cy, degree = mx / (3 * area), my / (3 * area), math.radians(1) * crs.EARTH_R
    place = lambda p: (lon + (p[0] - cx) * pixel_m / (degree * math.cos(math.radians(lat))), lat - (p[1] - cy) * pixel_m / degree)
    return [[*map(place, pts), place(pts[0])] for pts in rings]


def placed_outlines(rings: Column, lon: Column, lat: Column, pixel_m: float = 20.0) -> Column:
    """Outlines in pixels as a geometry in degrees around their stored position, as an Arrow kernel; NULL where the position is
    impossible. The centre of area of all rings goes there."""

    @F.pandas_udf(f"ARRAY<ARRAY<{RING_DDL}>>")
    def run(outlines: pd.Series, lons: pd.Series, lats: pd.Series) -> pd.Series:
        out = []
        for parts, x, y in zip(outlines, lons, lats):
            ok = parts is not None and x is not None and y is not None and abs(x) <= 180 and abs(y) < 90
            rings = [[(float(p[0]), float(p[1])) for p in part] for part in (parts if ok else []) if part is not None and len(part) > 2]
            out.append([[[{"x": a, "y": b} for a, b in ring]] for ring in placed(rings, x, y, pixel_m)] or None)
        return pd.Series(out, dtype=object)

    return run(rings, lon, lat)


def runs_of(geometry: Column, step: float, band: int) -> Column:
    """[X2, X15] cells of a lattice of `step` whose centres lie in a geometry, even-odd, as runs (r, c0, c1) of cells c0 <= c < c1
    in a row, cut where they pass a multiple of `band`, as an Arrow kernel."""

    @F.pandas_udf("ARRAY<STRUCT<r:BIGINT,c0:BIGINT,c1:BIGINT>>")
    def run(shapes: pd.Series) -> pd.Series:
        out = []
        for polygons in shapes:
            ends = [(a["x"], a["y"], b["x"], b["y"]) for polygon in (polygons if polygons is not None else []) for ring in polygon for a, b in zip(ring[:-1], ring[1:])]
            if not ends:
                out.append(None)
                continue
            x0, y0, x1, y1 = np.array(ends).T
            runs = []
            for r in range(math.floor(min(y0.min(), y1.min()) / step), math.floor(max(y0.max(), y1.max()) / step) + 1):
                y = (r + 0.5) * step
                cut = (y0 > y) != (y1 > y)
                xs = np.sort((x1[cut] - x0[cut]) * (y - y0[cut]) / (y1[cut] - y0[cut]) + x0[cut])
                for left, right in zip(xs[::2], xs[1::2]):
                    begin, end = math.ceil(left / step - 0.5), math.ceil(right / step - 0.5)
                    while begin < end:
                        upto = min(end, (begin // band + 1) * band)
                        runs.append({"r": r, "c0": begin, "c1": upto})
                        begin = upto
            out.append(runs)
        return pd.Series(out, dtype=object)

    return run(geometry)


def area_gate(areas: DataFrame, measured: str, stated: str, tolerance: float = 0.03) -> DataFrame:
    """[X11, D4] areas whose measure is off the stated one by more than the tolerance; without a stated area none."""
    off = F.abs(F.col(measured) - F.col(stated)) / F.col(stated)
    return areas.withColumn("off", off).where(F.col("off") > tolerance)


def outline_of(text: Column) -> Column:
    """Bounding edges (four numbers each, x0 < x1) of GeoJSON texts, as an Arrow kernel; NULL where a text has no polygon."""

    @F.pandas_udf("ARRAY<DOUBLE>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([e.ravel() if len(e := overlap.outline_edges(t)) else None for t in texts], dtype=object)

    return run(text)


def self_crossing(text: Column) -> Column:
    """[X4, X11, D4] whether the boundary of a GeoJSON polygon crosses itself; NULL where a text has no polygon. Areas are filled
    even-odd everywhere, so such a boundary needs no repair to be measured, only to be told."""

    @F.pandas_udf("BOOLEAN")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([overlap.crosses_itself(e) if len(e := overlap.all_edges(t)) else None for t in texts], dtype=object)

    return run(text)


def in_box(west: Column, south: Column, east: Column, north: Column) -> tuple[Column, Column]:
    """[X9] the part of this row's edge (x0, y0, x1, y1) inside a box, as the share of its length at which it begins and ends;
    begin >= end where nothing is inside."""
    begin, end = F.lit(0.0), F.lit(1.0)
    for a, b, low, high in (("x0", "x1", west, east), ("y0", "y1", south, north)):
        d = F.col(b) - F.col(a)
        t, u = F.try_divide(low - F.col(a), d), F.try_divide(high - F.col(a), d)
        out = (F.col(a) < low) | (F.col(a) > high)
        begin = F.greatest(begin, F.when(d == 0, F.when(out, 2.0).otherwise(0.0)).otherwise(F.least(t, u)))
        end = F.least(end, F.when(d == 0, 1.0).otherwise(F.greatest(t, u)))
    return begin, end


def corrected(corners: DataFrame, corrections: DataFrame) -> DataFrame:
    """[X12] corners (area_id, n, lon_dms, lat_dms) with a correction's longitude or latitude in place of their own, by corner
    number; an axis without correction stays."""
    fixes = corrections.select("area_id", "n", "longitude", "latitude")
    joined = corners.join(fixes, ["area_id", "n"], "left")
    return joined.select("area_id", "n", F.coalesce("longitude", "lon_dms").alias("lon_dms"), F.coalesce("latitude", "lat_dms").alias("lat_dms"))


def box_text(west: Column, south: Column, east: Column, north: Column) -> Column:
    """A box as a GeoJSON polygon."""
    p = lambda x, y: F.array(x, y)
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(F.array(p(west, south), p(east, south), p(east, north), p(west, north), p(west, south))).alias("coordinates")))


def areas_in_boxes(areas: DataFrame, key: str, boxes: DataFrame, name: str, cell: float = 1.0) -> DataFrame:
    """[J6, J7, U6, X7] (name, key, area_a, area_b, area_both) of areas (key, edges, x0, y0, x1, y1) and boxes (name, west, south,
    east, north) that have some area in common, with the area of each and what they share; unions and differences follow.
    Bounds meet in cells of `cell` first, what is left is measured exactly."""
    cells = lambda df, w, s, e, n: df.withColumn("_cx", F.explode(F.sequence(F.floor(F.col(w) / cell), F.floor(F.col(e) / cell)))).withColumn("_cy", F.explode(F.sequence(F.floor(F.col(s) / cell), F.floor(F.col(n) / cell))))
    p, q = cells(areas.drop("edges"), "x0", "y0", "x1", "y1").alias("p"), cells(boxes, "west", "south", "east", "north").alias("q")
    meet = (F.col("p._cx") == F.col("q._cx")) & (F.col("p._cy") == F.col("q._cy")) & (F.col("x0") < F.col("east")) & (F.col("x1") > F.col("west")) & (F.col("y0") < F.col("north")) & (F.col("y1") > F.col("south"))
    pairs = p.join(q, meet).select(name, key, "west", "south", "east", "north").distinct().join(areas.select(key, F.col("edges").alias("_a")), key)
    boxed = pairs.withColumn("_b", F.array("west", "south", "east", "south", "west", "north", "east", "north"))
    return overlap.common_areas(boxed, "_a", "_b").where("area_both > 0").select(name, key, "area_a", "area_b", "area_both")


def svg_path(polygon: Column) -> Column:
    """[K14] M x,y L ... Z of every ring, one decimal."""
    def point(p: Column) -> Column:
        return F.format_string("%.1f,%.1f", p["x"], p["y"])

    def one(ring: Column) -> Column:
        pts = F.transform(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), point)
        return F.concat(F.lit("M "), F.array_join(pts, " L "), F.lit(" Z"))

    return F.array_join(F.transform(polygon, one), " ")


def clip_ring(ring: list, box: tuple[float, float, float, float]) -> list:
    """[X3] a ring cut to a box (xmin, ymin, xmax, ymax), side by side; empty where nothing is left."""
    pts = [tuple(p) for p in ring]
    pts = pts[:-1] if len(pts) > 1 and pts[0] == pts[-1] else pts
    for axis, bound, keep_above in ((0, box[0], True), (0, box[2], False), (1, box[1], True), (1, box[3], False)):
        out = []
        for i, p in enumerate(pts):
            q = pts[i - 1]
            p_in, q_in = ((p[axis] >= bound) == keep_above or p[axis] == bound), ((q[axis] >= bound) == keep_above or q[axis] == bound)
            if p_in != q_in:
                t = (bound - q[axis]) / (p[axis] - q[axis])
                cut = [q[0] + t * (p[0] - q[0]), q[1] + t * (p[1] - q[1])]
                cut[axis] = bound
                out.append(tuple(cut))
            if p_in:
                out.append(p)
        pts = out
        if not pts:
            return []
    return [*pts, pts[0]] if len(pts) >= 3 else []


def simplify_ring(ring: list, tolerance: float) -> list:
    """[X10] Douglas-Peucker without recursion; a ring keeps its ends."""
    if len(ring) < 4:
        return ring
    keep = [False] * len(ring)
    keep[0] = keep[-1] = True
    spans = [(0, len(ring) - 1)]
    while spans:
        a, b = spans.pop()
        (ax, ay), (bx, by) = ring[a], ring[b]
        dx, dy = bx - ax, by - ay
        size = (dx * dx + dy * dy) ** 0.5
        far, at = 0.0, -1
        for i in range(a + 1, b):
            x, y = ring[i]
            d = abs(dx * (y - ay) - dy * (x - ax)) / size if size else ((x - ax) ** 2 + (y - ay) ** 2) ** 0.5
            if d > far:
                far, at = d, i
        if far > tolerance:
            keep[at] = True
            spans += [(a, at), (at, b)]
    return [p for p, k in zip(ring, keep) if k]


RING_DDL = "ARRAY<STRUCT<x:DOUBLE,y:DOUBLE>>"


def clipped(ring: Column, box: Column) -> Column:
    """[X3] rings cut to boxes (STRUCT xmin, ymin, xmax, ymax), as an Arrow kernel."""

    @F.pandas_udf(RING_DDL)
    def run(rings: pd.Series, boxes: pd.DataFrame) -> pd.Series:
        out = []
        for r, b in zip(rings, boxes.itertuples(index=False)):
            out.append(None if r is None else [{"x": x, "y": y} for x, y in clip_ring([(p["x"], p["y"]) for p in r], tuple(b))])
        return pd.Series(out)

    return run(ring, box)


def simplified(ring: Column, tolerance: float) -> Column:
    """[X10] as an Arrow kernel."""

    @F.pandas_udf(RING_DDL)
    def run(rings: pd.Series) -> pd.Series:
        return rings.map(lambda r: None if r is None else [{"x": x, "y": y} for x, y in simplify_ring([(p["x"], p["y"]) for p in r], tolerance)])

    return run(ring)


def outline_of_cells(cells: set[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """[X13] boundary rings, in pixel corners, of a set of (row, col) cells; outlines run clockwise on screen, holes the other way.
    Cells that touch in a corner only come out as separate rings."""
    step: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for r, c in cells:
        sides = (((r - 1, c), (c, r), (c + 1, r)), ((r, c + 1), (c + 1, r), (c + 1, r + 1)), ((r + 1, c), (c + 1, r + 1), (c, r + 1)), ((r, c - 1), (c, r + 1), (c, r)))
        for across, a, b in sides:
            if across not in cells:
                step.setdefault(a, []).append(b)
    rings = []
    while step:
        start = min(step)
        ring, at, came = [start], start, None
        while True:
            ways = step[at]
            if came is not None and len(ways) > 1:  # at a corner touch turn right: stay on this cell
                turn = (at[0] - came[0], at[1] - came[1])
                nxt = next((w for w in ways if (w[0] - at[0], w[1] - at[1]) == (-turn[1], turn[0])), ways[0])
            else:
                nxt = ways[0]
            ways.remove(nxt)
            if not ways:
                del step[at]
            came, at = at, nxt
            if at == start:
                break
            ring.append(at)
        bends = [p for i, p in enumerate(ring) if (ring[i - 1][0] - p[0]) * (ring[(i + 1) % len(ring)][1] - p[1]) != (ring[i - 1][1] - p[1]) * (ring[(i + 1) % len(ring)][0] - p[0])]
        rings.append([*bends, bends[0]])
    return rings


def patch_outlines(patched: DataFrame, by: list[str]) -> DataFrame:
    """[X13] (by, patch, rings): each patch's boundary as rings of pixel corners."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in patched.select(*by, "patch").schema)

    def trace(pixels: pd.DataFrame) -> pd.DataFrame:
        rings = outline_of_cells(set(zip(pixels["r"].tolist(), pixels["c"].tolist())))
        head = pixels.iloc[:1][[*by, "patch"]].copy()
        head["rings"] = [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]]
        return head

    return patched.select(*by, "patch", "r", "c").groupBy(*by, "patch").applyInPandas(trace, f"{ddl}, rings ARRAY<{RING_DDL}>")
