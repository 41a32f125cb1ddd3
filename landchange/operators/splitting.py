"""Unions of outlines by group, without a group in one task. Survey ids stand in brackets.

The plane is cut into upright strips at quantiles of the edges; a strip's pieces of a group's polygons are united on their own,
and the strips' areas add up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from landchange.functions.geojson import polygons
from landchange.operators.overlap import bounding_edges, union_area
from landchange.session import stage

#: Edges of a strip, on average, and the most strips.
STRIP_EDGES, MAX_STRIPS = 2_000, 100_000


def polygon_edges(areas: DataFrame, group: str, geometry: str) -> DataFrame:
    """(group, polygon, x0, y0, x1, y1) of the polygons' bounding edges; polygon is unique within the frame."""
    kind = areas.schema[group].dataType.simpleString()
    source = areas.where(F.col(group).isNotNull() & F.col(geometry).isNotNull()).select(F.col(group).alias("g"), F.col(geometry).alias("t")).withColumn("i", F.monotonically_increasing_id())

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for g, text, i in zip(batch["g"], batch["t"], batch["i"]):
                for part, rings in enumerate(polygons(text)):
                    e = np.vstack([np.hstack([np.array(r[:-1]), np.array(r[1:])]) for r in rings])
                    turned = e[:, 0] > e[:, 2]
                    e[turned] = e[turned][:, [2, 3, 0, 1]]
                    out.append(pd.DataFrame(bounding_edges(e), columns=["x0", "y0", "x1", "y1"]).assign(g=g, polygon=f"{i}/{part}"))
            if out:
                yield pd.concat(out)[["g", "polygon", "x0", "y0", "x1", "y1"]]

    return source.mapInPandas(read, f"g {kind}, polygon STRING, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE")


def unions(areas: DataFrame, group: str, geometry: str) -> DataFrame:
    """[A17, U6] (group, polygons, area): per group how many polygons there are and the area that any of them covers, in the
    coordinates' own units. A polygon alone is filled even-odd. Null groups and texts without a polygon give nothing."""
    edges = stage(polygon_edges(areas, group, geometry), "polygons")
    strips = min(MAX_STRIPS, edges.count() // STRIP_EDGES + 1)
    cuts = sorted(set(edges.approxQuantile("x0", [i / strips for i in range(1, strips)], 0.1 / strips))) if strips > 1 else []
    shared = edges.sparkSession.sparkContext.broadcast(np.array([-np.inf, *cuts, np.inf]))  # at most MAX_STRIPS numbers
    kind = edges.schema["g"].dataType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Edges as their pieces in the strips that they cross."""
        bounds = shared.value
        for batch in batches:
            low, high = np.searchsorted(bounds, batch["x0"], "right") - 1, np.searchsorted(bounds, batch["x1"], "left") - 1
            n = high - low + 1
            e = batch.loc[batch.index.repeat(n)].reset_index(drop=True)
            if not len(e):
                continue
            strip = np.repeat(low, n) + np.arange(len(e)) - np.repeat(np.cumsum(n) - n, n)
            x0, y0, x1, y1 = (e[c].to_numpy() for c in ("x0", "y0", "x1", "y1"))
            a, b = np.maximum(x0, bounds[strip]), np.minimum(x1, bounds[strip + 1])
            y = lambda x: np.where(x == x1, y1, y0 + (y1 - y0) * (x - x0) / (x1 - x0))  # noqa: E731,B023
            yield pd.DataFrame({"g": e["g"], "strip": strip.astype("int32"), "polygon": e["polygon"], "x0": a, "y0": y(a), "x1": b, "y1": y(b)})

    def unite(pieces: pd.DataFrame) -> pd.DataFrame:
        parts = [p[["x0", "y0", "x1", "y1"]].to_numpy() for _, p in pieces.groupby("polygon", sort=False)]
        return pd.DataFrame({"g": pieces["g"].iloc[:1], "area": [union_area(parts)]})

    pieces = edges.mapInPandas(cut, f"g {kind}, strip INT, polygon STRING, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE")
    areas_ = pieces.groupBy("g", "strip").applyInPandas(unite, f"g {kind}, area DOUBLE").groupBy("g").agg(F.sum("area").alias("area"))
    return edges.groupBy("g").agg(F.count_distinct("polygon").alias("polygons")).join(areas_, "g").select(F.col("g").alias(group), "polygons", "area")
