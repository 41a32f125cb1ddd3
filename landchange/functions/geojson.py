"""Reading GeoJSON texts into rings, for kernels that run in Python workers."""

from __future__ import annotations

import json
import math


def polygons(text: str | None) -> list[list[list[tuple[float, float]]]]:
    """Polygons of a GeoJSON text as ring lists, exterior first. Features, collections and multi-polygons are opened,
    lines and points give nothing, further dimensions are dropped. A text that is no GeoJSON gives no polygon."""
    if not text:
        return []
    try:
        value = json.loads(text)
    except (ValueError, RecursionError):
        return []
    found: list = []
    open_parts = [value]
    while open_parts:
        part = open_parts.pop()
        if not isinstance(part, dict):
            continue
        kind = part.get("type")
        if kind == "Feature":
            open_parts.append(part.get("geometry"))
        elif kind == "FeatureCollection":
            open_parts.extend(part.get("features") or [])
        elif kind == "GeometryCollection":
            open_parts.extend(part.get("geometries") or [])
        elif kind in ("Polygon", "MultiPolygon"):
            members = part.get("coordinates") or []
            for rings in [members] if kind == "Polygon" else members:
                if (clean := [r for r in map(ring, rings or []) if r]) and ring((rings or [None])[0]):
                    found.append(clean)
    return found


def ring(points: object) -> list[tuple[float, float]]:
    """A closed ring of at least three points, or nothing."""
    out = []
    for p in points if isinstance(points, list) else []:
        try:
            x, y = float(p[0]), float(p[1])
        except (TypeError, ValueError, IndexError):
            return []
        if not (math.isfinite(x) and math.isfinite(y)):
            return []
        out.append((x, y))
    if len(out) > 1 and out[0] == out[-1]:
        out.pop()
    return [*out, out[0]] if len(out) >= 3 else []
