"""Connected patches of flagged pixels. Survey ids stand in brackets.

Tiles are labelled on their own in Python workers; links across tile edges are few, and star rounds over them, in DataFrames,
merge the tiles' labels. The number of rounds is logarithmic in a patch's tiles.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from landchange.session import stage

TILE = 512


def star_components(links: DataFrame) -> DataFrame:
    """(node, root) of links (a, b): each node's least connected node. Null ends are ignored. Rounds of large and small stars
    until nothing moves; every round is written, so lineage stays short."""
    clean = links.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select("a", "b")
    nodes = clean.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    now = stage(clean.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    while True:
        both = now.select(F.col("a").alias("n"), F.col("b").alias("m")).union(now.select("b", "a"))
        least = both.groupBy("n").agg(F.min("m").alias("m")).select("n", F.least("n", "m").alias("low"))
        large = both.join(least, "n").where("m > n").select(F.col("m").alias("n"), F.col("low").alias("m")).where("n <> m")
        down = large.select(F.greatest("n", "m").alias("n"), F.least("n", "m").alias("m"))
        low = down.groupBy("n").agg(F.min("m").alias("low"))
        small = down.join(low, "n").select(F.col("m").alias("a"), F.col("low").alias("b")).union(low.select("n", "low")).where("a <> b")
        nxt = stage(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
        # equal sets have equal counts and hash sums
        mark = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
        if nxt.agg(*mark).first() == now.agg(*mark).first():
            return nodes.join(nxt, nodes["node"] == nxt["a"], "left").select("node", F.coalesce("b", "node").alias("root"))
        now = nxt


def _label_tile(pixels: pd.DataFrame, eight: bool) -> np.ndarray:
    """The least id of each pixel's patch within a tile. Pixels, in order of (r, c), make runs; runs of neighbouring rows that
    touch are tied, and ties settle by hooking and pointer jumping over arrays."""
    r, c, ids = pixels["r"].to_numpy(np.int64), pixels["c"].to_numpy(np.int64), pixels["id"].to_numpy()
    begins = np.append(True, (r[1:] != r[:-1]) | (c[1:] != c[:-1] + 1))
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(r)) - 1
    # a row's stretch of keys is wide enough that a look to the side stays in it
    wide, low = int(c.max() - c.min()) + 4, int(c.min()) - 1
    left, right = r[first] * wide + c[first] - low, r[last] * wide + c[last] - low
    side = 1 if eight else 0
    lo, hi = np.searchsorted(right, left - wide - side, "left"), np.searchsorted(left, right - wide + side, "right")
    n = np.maximum(hi - lo, 0)
    a = np.repeat(np.arange(len(first)), n)
    b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    root = np.arange(len(first))
    while (apart := root[a] != root[b]).any():
        p, q = root[a[apart]], root[b[apart]]
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        while (up := root[root]).tolist() != root.tolist():
            root = up
    return ids[first[root]][np.cumsum(begins) - 1]


def patches(flags: DataFrame, by: list[str], connectivity: int = 8, tile: int = TILE) -> DataFrame:
    """[W8] adds `patch` to flagged pixels: the least r * 2^31 + c of its patch, unique within `by`.

    flags: by, r, c (non-negative) and further columns of flagged pixels only, one row per pixel. connectivity 4 or 8.
    """
    eight = connectivity == 8
    ided = flags.withColumn("id", F.col("r").cast("bigint") * F.lit(1 << 31) + F.col("c")).withColumn("_tr", F.floor(F.col("r") / tile)).withColumn("_tc", F.floor(F.col("c") / tile))
    core = ided.select(*by, "r", "c", "id", "_tr", "_tc")

    def label(pixels: pd.DataFrame) -> pd.DataFrame:
        pixels = pixels.sort_values("id").reset_index(drop=True)
        return pixels.assign(local=_label_tile(pixels, eight)).drop(columns=["_tr", "_tc"])

    schema = core.drop("_tr", "_tc").withColumn("local", F.col("id")).schema
    labelled = stage(core.groupBy(*by, "_tr", "_tc").applyInPandas(label, schema), "tiles")
    # pixels on a tile's lower or right edge look across it, and in 8-neighbourhoods also to the lower left
    r, c = F.col("r"), F.col("c")
    edge = ((r + 1) % tile == 0) | ((c + 1) % tile == 0) | ((c % tile == 0) if eight else F.lit(False))
    steps = [(0, 1), (1, 0)] + ([(1, 1), (1, -1)] if eight else [])
    looks = labelled.where(edge).withColumn("_s", F.explode(F.array(*(F.struct((r + dr).alias("r"), (c + dc).alias("c")) for dr, dc in steps))))
    other = labelled.select(*(F.col(b).alias(f"_o_{b}") for b in by), F.col("r").alias("_or"), F.col("c").alias("_oc"), F.col("local").alias("_ol"))
    match = (F.col("_s.r") == F.col("_or")) & (F.col("_s.c") == F.col("_oc"))
    for b in by:
        match &= F.col(b).eqNullSafe(F.col(f"_o_{b}"))
    node = lambda x: F.struct(*by, F.col(x).alias("local"))
    links = looks.join(other, match).select(node("local").alias("a"), node("_ol").alias("b")).where("a <> b").distinct()
    merged = star_components(links).select(F.col("node").alias("_node"), F.col("root.local").alias("_root"))
    rooted = labelled.withColumn("_n", node("local")).join(merged, F.col("_n") == F.col("_node"), "left").select(*by, "r", "c", F.coalesce("_root", "local").alias("patch"))
    return flags.join(rooted, [*by, "r", "c"])


def numbered(patched: DataFrame, by: list[str]) -> DataFrame:
    """[W8] patch numbers 1, 2, ... in scan order of their first pixels. Patches, not pixels, are put in order."""
    heads = patched.select(*by, "patch").distinct()
    number = F.row_number().over(Window.partitionBy(*by).orderBy("patch"))
    return patched.join(heads.withColumn("number", number), [*by, "patch"])


def patch_stats(patched: DataFrame, by: list[str], pixel_ha: float, p: str, near: str, earlier: str) -> DataFrame:
    """[A18, A19, J9] size, area, mean probability, whether any pixel is near a mapped mine, mean earlier NDVI (nulls 0), box in
    pixels (right and lower edges exclusive) and the mean of the pixel centres."""
    c = F.col
    return patched.groupBy(*by, "patch").agg(
        F.count("*").alias("pixels"), (F.count("*") * F.lit(pixel_ha)).alias("area_ha"), F.avg(p).alias("mean_p"), F.bool_or(F.coalesce(c(near), F.lit(False))).alias("touches"), F.avg(F.coalesce(c(earlier), F.lit(0.0))).alias("earlier"),
        F.min("c").alias("c0"), F.min("r").alias("r0"), (F.max("c") + 1).alias("c1"), (F.max("r") + 1).alias("r1"), F.avg(c("c") + 0.5).alias("centre_c"), F.avg(c("r") + 0.5).alias("centre_r"),
    )
