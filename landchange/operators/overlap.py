"""Common area of two outlines. Survey ids stand in brackets.

Outlines are arrays of edges (x0, y0, x1, y1), filled even-odd, so self-crossing and overlapping parts need no repair first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from landchange.functions.geojson import polygons


def all_edges(text: str | None) -> np.ndarray:
    """Edges (x0, y0, x1, y1), x0 <= x1, of a GeoJSON outline; none where the text holds no polygon."""
    parts = [np.array(r) for rings in polygons(text) for r in rings]
    if not parts:
        return np.zeros((0, 4))
    e = np.vstack([np.hstack([p[:-1], p[1:]]) for p in parts])
    turned = e[:, 0] > e[:, 2]
    e[turned] = e[turned][:, [2, 3, 0, 1]]
    return e


def bounding_edges(e: np.ndarray) -> np.ndarray:
    """Those that bound area by x, sorted; upright ones don't."""
    e = e[e[:, 0] < e[:, 2]]
    return e[np.lexsort(e.T[::-1])]


def outline_edges(text: str | None) -> np.ndarray:
    """Sorted bounding edges of a GeoJSON outline."""
    return bounding_edges(all_edges(text))


def areas(a: np.ndarray, b: np.ndarray) -> tuple[float, float, float]:
    """[X7, U6] area of outline a, of b, and of what they have in common: in each slab between two ends or crossings no edges
    cross, so lengths at its middle are exact. Joint area and differences follow from the three."""
    edges = np.vstack([a, b])
    if not len(edges):
        return 0.0, 0.0, 0.0
    edges = edges - np.array([edges[:, 0].min(), edges[:, 1].min()] * 2)
    slope = (edges[:, 3] - edges[:, 1]) / (edges[:, 2] - edges[:, 0])
    base = edges[:, 1] - slope * edges[:, 0]
    cuts = [edges[:, 0], edges[:, 2]]
    for i in range(0, len(edges), 512):  # crossings, in blocks of edges
        with np.errstate(divide="ignore", invalid="ignore"):
            x = (base[None, :] - base[i : i + 512, None]) / (slope[i : i + 512, None] - slope[None, :])
            low, high = np.maximum(edges[i : i + 512, None, 0], edges[None, :, 0]), np.minimum(edges[i : i + 512, None, 2], edges[None, :, 2])
            cuts.append(x[(x > low) & (x < high)])
    xs = np.unique(np.concatenate(cuts))
    first, last = np.searchsorted(xs, edges[:, 0]), np.searchsorted(xs, edges[:, 2])
    n = last - first
    which = np.repeat(np.arange(len(edges)), n)
    at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    y = base[which] + slope[which] * (xs[at] + xs[at + 1]) / 2
    order = np.lexsort((y, at))
    at, y, of_a = at[order], y[order], which[order] < len(a)
    in_a, in_b = np.cumsum(of_a)[:-1] % 2 == 1, np.cumsum(~of_a)[:-1] % 2 == 1
    piece = np.where(at[1:] == at[:-1], (y[1:] - y[:-1]) * (xs[at[:-1] + 1] - xs[at[:-1]]), 0.0)
    return float(piece[in_a].sum()), float(piece[in_b].sum()), float(piece[in_a & in_b].sum())


def common_areas(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """[X7, X15] adds area_a, area_b and area_both, in the outlines' own units squared, to pairs of outlines held as edge lists
    (ARRAY<DOUBLE>, four numbers an edge, x0 < x1). A null list is an empty outline."""
    schema = pairs.select("*", *(F.lit(0.0).alias(f"area_{x}") for x in ("a", "b", "both"))).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shaped = lambda x: np.zeros((0, 4)) if x is None else np.asarray(x, float).reshape(-1, 4)
        for batch in batches:
            if len(batch):
                found = np.array([areas(shaped(p), shaped(q)) for p, q in zip(batch[a], batch[b])])
                yield batch.assign(area_a=found[:, 0], area_b=found[:, 1], area_both=found[:, 2])

    return pairs.mapInPandas(run, schema)


def union_area(parts: list[np.ndarray]) -> float:
    """[U6, A17] area covered by any of several even-odd outlines."""
    parts = [p for p in parts if len(p)]
    if not parts:
        return 0.0
    edges = np.vstack(parts)
    edges = edges - np.array([edges[:, 0].min(), edges[:, 1].min()] * 2)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    slope = (edges[:, 3] - edges[:, 1]) / (edges[:, 2] - edges[:, 0])
    base = edges[:, 1] - slope * edges[:, 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        x = (base[None, :] - base[:, None]) / (slope[:, None] - slope[None, :])
    xs = np.unique(np.concatenate([edges[:, 0], edges[:, 2], x[(x > np.maximum(edges[:, None, 0], edges[None, :, 0])) & (x < np.minimum(edges[:, None, 2], edges[None, :, 2]))]]))
    total = 0.0
    for left, right in zip(xs[:-1], xs[1:]):
        over = (edges[:, 0] <= left) & (edges[:, 2] >= right)
        y = base[over] + slope[over] * (left + right) / 2
        spans = []
        for part in np.unique(owner[over]):
            own = np.sort(y[owner[over] == part])
            spans += list(zip(own[::2], own[1::2]))
        reach = -np.inf
        for low, high in sorted(spans):
            total += max(0.0, high - max(low, reach)) * (right - left)
            reach = max(reach, high)
    return total


def crosses_itself(edges: np.ndarray) -> bool:
    """[X4, X11, D4] whether two edges of an outline meet in a point inside both."""
    d = edges[:, 2:] - edges[:, :2]
    for i in range(0, len(edges), 256):
        a, da = edges[i : i + 256, None, :2], d[i : i + 256, None]
        side = lambda p: da[..., 0] * (p[None, :, 1] - a[..., 1]) - da[..., 1] * (p[None, :, 0] - a[..., 0])  # noqa: E731,B023
        own = lambda p, q: d[None, :, 0] * (p[..., 1] - edges[None, :, 1]) - d[None, :, 1] * (p[..., 0] - edges[None, :, 0])
        if ((side(edges[:, :2]) * side(edges[:, 2:]) < 0) & (own(a, None) * own(edges[i : i + 256, None, 2:], None) < 0)).any():
            return True
    return False
