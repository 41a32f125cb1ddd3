"""Close points and points in regions against brute force."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from landchange.operators import spatial as S


def brute_pairs(points, metres):
    out = set()
    for i, (a, x1, y1) in enumerate(points):
        for b, x2, y2 in points[:i]:
            p, q = math.radians(y1), math.radians(y2)
            h = math.sin((p - q) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(x1 - x2) / 2) ** 2
            if 2 * S.EARTH_R * math.asin(min(1, math.sqrt(h))) <= metres:
                out.add((min(a, b), max(a, b)))
    return out


@pytest.mark.parametrize("metres", [50.0, 200_000.0, 6_000_000.0])
def test_close_pairs_everywhere(spark, metres):
    rnd = random.Random(7)
    spread = metres / 60_000
    centres = [(180, 0), (-180, 0), (0, 90), (33, -90), (179.9999, 89.99), (120, 15), (-180, 60), (10, 45)]
    points = []
    for i in range(400):
        x, y = rnd.choice(centres)
        x, y = x + rnd.uniform(-1, 1) * spread / max(0.01, math.cos(math.radians(y))), y + rnd.uniform(-1, 1) * spread
        points.append((i, (x + 180) % 360 - 180, max(-90.0, min(90.0, y))))
    df = spark.createDataFrame(points, "k BIGINT, x DOUBLE, y DOUBLE")
    got = [(r.key_a, r.key_b) for r in S.close_pairs(df, "k", "x", "y", metres).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_pairs(points, metres)


def test_close_pairs_odd_rows(spark):
    rows = [(1, 2020, 0.0, 0.0), (1, 2020, 0.0, 0.0), (2, 2020, 0.0, 0.0), (3, 2021, 0.0, 0.0), (4, None, 0.0, 0.0), (5, 2020, None, 0.0), (6, 2020, 190.0, 0.0), (7, 2020, float("nan"), 0.0), (None, 2020, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "k BIGINT, year INT, x DOUBLE, y DOUBLE").withColumns({"_band": F.lit(1), "_k": F.lit(9)})
    assert [(r.key_a, r.key_b) for r in S.close_pairs(df, "k", "x", "y", 50.0, ["year"]).collect()] == [(1, 2)]
    assert S.close_pairs(df.limit(0), "k", "x", "y", 50.0).count() == 0


def even_odd(x, y, rings):
    inside = False
    for ring in rings:
        for (x0, y0), (x1, y1) in zip(ring, ring[1:]):
            if (y0 > y) != (y1 > y) and x < (x1 - x0) * (y - y0) / (y1 - y0) + x0:
                inside = not inside
    return inside


def random_star(rnd, cx, cy, n):
    angles = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(n))
    pts = [(cx + rnd.uniform(0.3, 1) * math.cos(a), cy + rnd.uniform(0.3, 1) * math.sin(a)) for a in angles]
    return [*pts, pts[0]]


@pytest.mark.parametrize("crossing,entries", [(False, 2_000_000), (True, 2_000_000), (False, 7), (True, 7)])
def test_slabs_equal_even_odd(monkeypatch, crossing, entries):
    monkeypatch.setattr(S, "SLAB_ENTRIES", entries)
    rnd = random.Random(3)
    for _ in range(20):
        ring = random_star(rnd, 0, 0, 12) if not crossing else [(rnd.random(), rnd.random()) for _ in range(9)]
        ring = ring if not crossing else [*ring, ring[0]]
        e = np.array([(*a, *b) if a[0] < b[0] else (*b, *a) for a, b in zip(ring, ring[1:]) if a[0] != b[0]])
        x, y = np.array([rnd.uniform(-1, 1) for _ in range(300)]), np.array([rnd.uniform(-1, 1) for _ in range(300)])
        assert S.locate_in_slabs(x, y, e).tolist() == [even_odd(a, b, [ring]) for a, b in zip(x, y)]


def test_points_in_regions(spark, monkeypatch):
    monkeypatch.setattr(S, "STRIP_EDGES", 10)  # many strips
    monkeypatch.setattr(S, "STRIP_POINTS", 20)  # and several tasks for each
    rnd = random.Random(5)
    outer = {k: random_star(rnd, rnd.uniform(0, 6), rnd.uniform(0, 2), 9) for k in range(12)}
    hole = {k: [((x - v[0][0]) * 0.2 + v[0][0], (y - v[0][1]) * 0.2 + v[0][1]) for x, y in v] for k, v in outer.items()}
    texts = [(k, json.dumps({"type": "Polygon", "coordinates": [v, hole[k]]})) for k, v in outer.items()]
    texts += [(0, texts[0][1]), (90, None), (91, "{"), (92, '{"type": "LineString", "coordinates": [[0, 0], [5, 5]]}'), (93, json.dumps({"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[[[2, 0, 7], [3, 0, 7], [3, 1, 7], [2, 0, 7]]]]}}))]
    outer[93], hole[93] = [(2, 0), (3, 0), (3, 1), (2, 0)], []
    points = [(i, rnd.uniform(-1, 7), rnd.uniform(-1, 3)) for i in range(500)]
    df = spark.createDataFrame([*points, (points[0]), (900, None, 1.0), (901, 1.0, 95.0)], "k BIGINT, x DOUBLE, y DOUBLE")
    regions = spark.createDataFrame(texts, "a BIGINT, g STRING").withColumn("k", F.lit("clash"))
    got = [(r.k, r.region) for r in S.points_in_regions(df, "k", "x", "y", regions, "a", "g").collect()]
    assert len(got) == len(set(got)) and set(got) == {(i, k) for i, x, y in points for k in outer if even_odd(x, y, [outer[k], hole[k]])}
    assert S.points_in_regions(df.limit(0), "k", "x", "y", regions, "a", "g").count() == 0
    assert S.points_in_regions(df, "k", "x", "y", regions.limit(0), "a", "g").count() == 0


def test_text_keys_and_no_hits(spark):
    square = json.dumps({"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]})
    points = spark.createDataFrame([("a", 0.5, 0.5), ("b", 5.0, 5.0)], "k STRING, x DOUBLE, y DOUBLE")
    regions = spark.createDataFrame([("r", square), ("s", "no json"), (None, square)], "id STRING, g STRING")
    within = lambda p: [tuple(r) for r in S.points_in_regions(p, "k", "x", "y", regions, "id", "g").collect()]
    assert within(points) == [("a", "r")] and within(points.where("k = 'b'")) == []


@pytest.mark.parametrize("parts", ["1", "64", "200"])
def test_any_number_of_partitions(spark, data, parts):
    from landchange.plans import problems

    before = spark.conf.get("spark.sql.shuffle.partitions")
    expected = problems.p2_found(spark, data).count()
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert problems.p2_found(spark, data).count() == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
