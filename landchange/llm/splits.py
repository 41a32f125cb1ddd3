"""Train, validation and test splits that keep tied records together.

Ties are merged by a distributed union-find: every partition reduces its links to a local forest, forests are merged level by
level while they are small enough for one task, and what is left is contracted by star rounds over the cluster, so no task
ever holds all links. Groups are then dealt out largest first to the split furthest below its target.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from landchange.operators.components import star_components
from landchange.operators.sequence import running_sum
from landchange.session import shuffle_parts, stage

#: Links that one task merges; above, star rounds do the rest.
MERGE_LINKS = 1_000_000
KM_PER_DEGREE = 111.195


def local_forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links (a, b) of a partition to links (node, root) of its forest, root the least of its tree."""
    parent: dict = {}

    def find(x):
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while (up := parent.get(x, x)) != root:
            parent[x] = root
            x = up
        return root

    for batch in batches:
        for a, b in zip(batch["a"], batch["b"]):
            ra, rb = find(a), find(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
            parent.setdefault(a, a)
            parent.setdefault(b, b)
    if nodes := list(parent):  # an empty frame has no types that Arrow could take over
        yield pd.DataFrame({"a": nodes, "b": [find(x) for x in nodes]})


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node in a link and the least node it is tied to. Null ends are ignored; no links, no rows."""
    spark = links.sparkSession
    kind = links.schema[a].dataType.simpleString()
    forest_ddl = f"a {kind}, b {kind}"
    forest = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("a"), F.col(b).alias("b"))
    parts = shuffle_parts(spark)
    forest = stage(forest.repartition(parts, F.least("a", "b")).mapInPandas(local_forest, forest_ddl), "forest")
    while parts > 1 and forest.count() <= MERGE_LINKS * parts:  # levels: forests of eight partitions meet in one
        parts = max(1, parts // 8)
        if parts == 1 and forest.count() > MERGE_LINKS:
            break
        forest = stage(forest.coalesce(parts).mapInPandas(local_forest, forest_ddl), "forest")
        if parts == 1:
            return forest.select(F.col("a").alias("node"), F.col("b").alias("root")).distinct()
    rest = star_components(forest)
    return rest.select("node", "root")


def plain_name(name: Column) -> Column:
    """Letters and digits of a name, without case and accents; null where none is left."""

    @F.pandas_udf("string")
    def plain(names: pd.Series) -> pd.Series:
        def one(x):
            if x is None:
                return None
            parts = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", x).casefold())
            return "".join(c for c in parts if c.isalnum()) or None

        return names.map(one)

    return plain(name)


def same_ground(entries: DataFrame, name: str, lon: str, lat: str, box_km: str) -> DataFrame:
    """Links (a, b) of entries whose names agree in letters and digits or whose square boxes overlap: enough of them that the
    links tie together what these ties do.

    A box has its centre at lon/lat and its side in km; a null centre or side is no box, and boxes that only touch don't
    overlap. Every entry is also linked to itself, so that single ones come out. Boxes of about one size whose centres lie
    closer than that size overlap, so they hang on their least entry; other boxes meet in cells of the larger one's size, and
    two such crowds give one link, however many of their boxes overlap.
    """
    clean = entries.where(F.col(name).isNotNull()).select(F.col(name).alias("n"), F.col(lon).cast("double").alias("x"), F.col(lat).cast("double").alias("y"), F.col(box_km).cast("double").alias("s")).distinct()
    single = clean.select(F.col("n").alias("a"), F.col("n").alias("b")).distinct()
    # entries of one plain name hang on its least entry: a star, not all pairs
    plain = clean.select("n", plain_name(F.col("n")).alias("p")).where("p IS NOT NULL")
    stars = plain.join(plain.groupBy("p").agg(F.min("n").alias("low")), "p").select(F.col("low").alias("a"), F.col("n").alias("b"))
    valid = "x IS NOT NULL AND y IS NOT NULL AND s > 0 AND abs(y) < 90 AND NOT isnan(x) AND NOT isnan(y) AND s < 1e6"
    half = clean.where(valid).withColumn("h", F.col("s") / 2 / KM_PER_DEGREE).withColumn("w", F.least(F.col("h") / F.cos(F.radians("y")), F.lit(180.0)))
    # crowds: both sides' exponents of two, and the centre's place in steps of those powers, which no side is shorter than
    power = lambda r: F.floor(F.log2(2 * F.col(r)))
    place = lambda mid, r: F.floor(F.col(mid) / F.pow(F.lit(2.0), power(r)))
    crowd = half.withColumn("crowd", F.struct(power("w").alias("ex"), power("h").alias("ey"), place("x", "w").alias("px"), place("y", "h").alias("py")))
    lows = crowd.groupBy("crowd").agg(F.min("n").alias("low"))
    crowds = crowd.join(lows, "crowd").select("low", "n").distinct().select(F.col("low").alias("a"), F.col("n").alias("b"))
    # cells of level k are 360 / 2^k degrees wide; a box's level is the last at which it is no wider than a cell
    boxes = crowd.join(lows, "crowd").select("low", "x", "y", "w", "h").distinct().withColumn("k", F.greatest(F.lit(0), F.floor(F.log2(F.lit(180.0) / F.greatest("w", "h"))).cast("int")))
    levels = sorted(r["k"] for r in boxes.select("k").distinct().collect())  # a few dozen at most, for all sizes there are

    def cells(leveled: DataFrame) -> DataFrame:
        step = F.lit(360.0) / F.pow(F.lit(2.0), F.col("at"))
        span = lambda mid, r: F.sequence(F.floor((F.col(mid) + 180 - F.col(r)) / step), F.floor((F.col(mid) + 180 + F.col(r)) / step))
        around = F.pow(F.lit(2.0), F.col("at")).cast("long")
        return leveled.withColumn("cx", F.explode(span("x", "w"))).withColumn("cx", F.pmod("cx", around)).withColumn("cy", F.explode(span("y", "h")))

    asked = F.filter(F.array(*map(F.lit, levels)), lambda v: v <= F.col("k")) if levels else F.array().cast("array<int>")
    p, q = cells(boxes.withColumn("at", F.explode(asked))).alias("p"), cells(boxes.withColumn("at", F.col("k"))).alias("q")
    apart = F.abs(F.col("p.x") - F.col("q.x"))
    overlap = (F.least(apart, 360 - apart) < F.col("p.w") + F.col("q.w")) & (F.abs(F.col("p.y") - F.col("q.y")) < F.col("p.h") + F.col("q.h"))
    meet = (F.col("p.at") == F.col("q.at")) & (F.col("p.cx") == F.col("q.cx")) & (F.col("p.cy") == F.col("q.cy")) & (F.col("p.low") != F.col("q.low")) & overlap
    between = p.join(q, meet).select(F.col("p.low").alias("a"), F.col("q.low").alias("b")).distinct()
    return single.union(stars).union(crowds).union(between).distinct()


def tied_pairs(roots: DataFrame) -> DataFrame:
    """(name_a, name_b), name_a < name_b: all pairs that share a root. Its size is that of the asked-for list of pairs."""
    a, b = roots.alias("a"), roots.alias("b")
    return a.join(b, (F.col("a.root") == F.col("b.root")) & (F.col("a.node") < F.col("b.node"))).select(F.col("a.node").alias("name_a"), F.col("b.node").alias("name_b"))


def deal_class(gaps: np.ndarray, size: int, count: int) -> np.ndarray:
    """How many of `count` groups of one size go to each split, when each goes to the split with the largest gap (the first of
    equals) and lowers that gap by its size: what dealing them one by one gives, however many there are."""
    if size <= 0:
        return np.bincount([int(np.argmax(gaps))], minlength=len(gaps)) * count
    order = np.sort(gaps)[::-1]
    level = order[0] - count * size
    for k in range(1, len(gaps)):  # the level to which the gaps of the k + 1 furthest splits come down together
        if (shared := (order[: k + 1].sum() - count * size) / (k + 1)) <= order[k]:
            level = shared
    dealt = np.maximum(0, np.floor((gaps - level) / size)).astype(np.int64)
    while dealt.sum() > count:  # rounding of the level
        dealt[int(np.argmin(np.where(dealt > 0, gaps - dealt * size, np.inf)))] -= 1
    for _ in range(count - int(dealt.sum())):  # fewer than there are splits
        dealt[int(np.argmax(gaps - dealt * size))] += 1
    return dealt


def deal(groups: DataFrame, key: str, size: str, shares: dict[str, float], seed: int = 0) -> DataFrame:
    """(key, split): groups dealt largest first to the split furthest below its target, one group never in two splits.

    groups: one row per group, its key unique; a null size counts 0, null keys are left out. Groups of one size are dealt
    together, with the outcome of dealing them one by one: the driver has a row per size, and n records have fewer than
    sqrt(2 n) + 1 different sizes of groups (1.4 million for 10^12 records). Groups of equal size go in order of a hash of
    their key. shares need not sum to 1.
    """
    spark = groups.sparkSession
    sized = groups.where(F.col(key).isNotNull()).select(F.col(key).alias("_k"), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("_n"))
    classes = sized.groupBy("_n").agg(F.count("*").alias("c")).collect()
    names = list(shares)
    goal = np.array([shares[s] for s in names], float)
    gaps = goal / goal.sum() * sum(r["_n"] * r["c"] for r in classes)
    plan = []
    for row in sorted(classes, key=lambda r: -r["_n"]):
        dealt = deal_class(gaps, row["_n"], row["c"])
        gaps = gaps - dealt * row["_n"]
        upto = np.cumsum(dealt)
        plan += [(row["_n"], int(u - d), int(u), s) for d, u, s in zip(dealt, upto, names) if d]
    table = F.broadcast(spark.createDataFrame(plan, "_n BIGINT, _after BIGINT, _upto BIGINT, split STRING"))
    placed = running_sum(sized, ["_n"], [F.xxhash64(F.lit(seed), "_k"), F.col("_k")], None, "_at")
    return placed.join(table, (placed["_n"] == table["_n"]) & (F.col("_at") > F.col("_after")) & (F.col("_at") <= F.col("_upto"))).select(F.col("_k").alias(key), "split")
