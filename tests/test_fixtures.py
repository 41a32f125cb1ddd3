"""Worked examples of the engine's rules, with answers known beforehand."""

import math

import pytest
from pyspark.sql import functions as F

from landchange.functions import crs, pixels as P, text
from landchange.operators import components, focal, geometry as G, metrics, mosaic, records


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_mosaic_takes_one_view(spark):
    values = {1: [0.30, 0.10, 0.20, 0.50, 0.40], 2: [0.2, 0.1, 0.4, 0.3], 3: [0.7], 4: [0.9, 0.1, 0.5, 0.3, 0.7, 0.2, 0.8, 0.6, 0.4], 5: [None]}
    rows = [(p, i, v, None if v is None else 10.0 * i) for p, vs in values.items() for i, v in enumerate(vs)]
    obs = spark.createDataFrame(rows, "pixel INT, day INT, blue DOUBLE, red DOUBLE")
    got = {r.pixel: r for r in mosaic.darker_quartile(obs, ["pixel"], ["blue", "red"]).collect()}
    assert {p: r.blue for p, r in got.items()} == {1: 0.20, 2: 0.1, 3: 0.7, 4: 0.3}
    assert all(r.red == 10 * values[p].index(r.blue) for p, r in got.items())
    lattice = spark.createDataFrame([(p,) for p in values], "pixel INT")
    counts = mosaic.on_lattice(lattice, mosaic.darker_quartile(obs, ["pixel"], ["blue", "red"]), ["pixel"]).withColumn("site", F.lit(1))
    cover = mosaic.coverage(counts, ["site"]).first()
    assert cover.clear_fraction == 0.8 and cover.median_clear == 4


def test_mosaic_is_one_shuffle(spark, data):
    from landchange.plans.engine import _mosaic

    plan = _mosaic(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan


def test_columns_reach_the_scan(spark, data):
    from landchange.plans.engine import QUERIES

    plan = QUERIES["open_ground_labels"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "s2_B11" in plan and "s2_B02" not in plan


@pytest.mark.parametrize("qa,clear", [(0, True), (1, False), (2, False), (4, False), (8, False), (16, False), (32, True), (0b101011100001000, False)])
def test_landsat_mask(spark, qa, clear):
    assert one(spark, P.clear_landsat(F.lit(qa)).alias("x")).x is clear


def test_s2_mask(spark):
    got = spark.range(12).select("id", P.clear_s2(F.col("id")).alias("x")).collect()
    assert [r.id for r in got if r.x] == [2, 4, 5, 6, 7]


@pytest.mark.parametrize("baseline,value", [("04.00", 0.05), ("03.01", 0.15), (None, 0.15)])
def test_reflectance(spark, baseline, value):
    assert one(spark, P.reflectance_s2(F.lit(1500), F.lit(baseline).cast("string")).alias("x")).x == pytest.approx(value)
    assert one(spark, P.reflectance_landsat(F.lit(10000)).alias("x")).x == pytest.approx(0.075)
    assert one(spark, P.masked(F.lit(1.0), F.lit(True), F.lit(0)).alias("x")).x is None


@pytest.mark.parametrize("before,after,land,green,bare", [(0.5, 0.29, True, True, True), (0.5, 0.30, True, True, False), (0.49, 0.1, True, False, False), (0.8, 0.1, False, False, False), (None, 0.1, True, False, False)])
def test_change(spark, before, after, land, green, bare):
    b, a, v = F.lit(before).cast("double"), F.lit(after), P.comparable(F.lit(before).cast("double"), F.lit(after), F.lit(land))
    r = one(spark, P.vegetated(b, v).alias("g"), P.bared(b, a, v).alias("c"))
    assert (r.g, r.c) == (green, bare)


def test_water(spark):
    w = lambda n, i, land: one(spark, P.water(F.lit(n), F.lit(i), F.lit(land)).alias("x")).x
    assert (w(0.11, 0.2, True), w(0.1, 0.2, True), w(0.0, 0.02, False), w(0.0, 0.02, True)) == (True, False, True, False)
    d = lambda n, i: one(spark, P.dry(F.lit(n), F.lit(i)).alias("x")).x
    assert (d(-0.11, 0.05), d(-0.1, 0.05), d(-0.11, 0.049)) == (True, False, False)


@pytest.mark.parametrize("lat,ha", [(0.0, 0.0772771229), (10.0, 0.0761031097), (16.6221, 0.0740478903)])
def test_sphere_pixel(spark, lat, ha):
    assert one(spark, crs.sphere_pixel_ha(F.lit(lat)).alias("x")).x == pytest.approx(ha, abs=1e-9)


@pytest.mark.parametrize("lon,lat,zone,east,north", [(122.3085, 16.622, 51, 426247.037, 1837866.876), (119.9548, 15.9722, 50, 816302.162, 1768106.033), (121.384, 12.09, 51, 324120.868, 1337025.286)])
def test_utm(spark, lon, lat, zone, east, north):
    e, n = crs.utm_forward(F.lit(lon), F.lit(lat), F.lit(zone))
    r = one(spark, crs.utm_zone(F.lit(lon)).alias("z"), e.alias("e"), n.alias("n"))
    assert r.z == zone and r.e == pytest.approx(east, abs=1e-3) and r.n == pytest.approx(north, abs=1e-3)


def test_grid_snap(spark):
    r = one(spark, crs.snap(F.lit(426247.037), F.lit(9.0), F.lit(10.0)).alias("l"), crs.snap(F.lit(1837866.876), F.lit(9.0), F.lit(10.0)).alias("b"), crs.pixels_across(F.lit(9.0), F.lit(10.0)).alias("s"))
    assert (r.l, r.b, r.s) == (421750, 1833370, 900)


def test_datum_and_dms(spark):
    d = lambda t: one(spark, crs.dms(F.lit(t)).alias("x")).x
    assert d("17-32-23") == pytest.approx(17.5397222222) and d("17-11-60") == pytest.approx(17.2) and d("east") is None
    lon, lat = crs.luzon_to_wgs84(crs.dms(F.lit("122-11-23")), crs.dms(F.lit("17-32-23")))
    r = one(spark, lon.alias("x"), lat.alias("y"))
    assert r.x == pytest.approx(122.19116862602132, abs=1e-9) and r.y == pytest.approx(17.538035328564412, abs=1e-9)


@pytest.mark.parametrize("box,names", [((121.18, 14.55, 121.25, 14.60), ["20N_120E"]), ((119.95, 15.9, 120.02, 16.0), ["20N_110E", "20N_120E"]), ((121.0, 9.9, 121.2, 10.1), ["10N_120E", "20N_120E"])])
def test_tiles(spark, box, names):
    assert sorted(one(spark, crs.tile_names(*map(F.lit, box)).alias("x")).x) == names


def test_scene_window(spark):
    days = ["2026-01-01", "2026-06-01", "2025-12-31", "2026-06-02", "2027-01-01"]
    scenes = spark.createDataFrame([(d, 10, "a") for d in days], "datetime STRING, cloud INT, platform STRING").withColumn("datetime", F.col("datetime").cast("timestamp"))
    got = lambda m: sorted(str(r.datetime)[:10] for r in records.scene_search(scenes, [2026], m, 60).collect())
    assert got((1, 5)) == ["2026-01-01", "2026-06-01"] and got((10, 12)) == ["2027-01-01"]


def test_display(spark):
    got = [one(spark, P.display_stretch(F.lit(x).cast("double")).alias("x")).x for x in (-0.1, 0.0, 0.11, 0.22, 0.5, None)]
    assert got == [0, 0, 155, 255, 255, 96]
    ramp = [tuple(one(spark, P.loss_colour(F.lit(y), 2001, 2025).alias("x")).x) for y in (2001, 2013, 2025)]
    assert ramp == [(255, 220, 40, 200), (255, 110, 20, 200), (255, 0, 0, 200)]


def test_focal_mirrors_the_edge(spark):
    df = spark.createDataFrame([(r, c, float(3 * r + c + 1), 3, 3) for r in range(3) for c in range(3)], "r INT, c INT, v DOUBLE, height INT, width INT")
    mean = {(r.r, r.c): r.v for r in focal.focal(df, [], ["v"], 3).collect()}
    expect = [7 / 3, 3, 11 / 3, 13 / 3, 5, 17 / 3, 19 / 3, 7, 23 / 3]
    assert [mean[divmod(i, 3)] for i in range(9)] == pytest.approx(expect)
    top = {(r.r, r.c): r.v for r in focal.focal(df, [], ["v"], 3, F.max).collect()}
    assert [top[divmod(i, 3)] for i in range(9)] == [5, 6, 6, 8, 9, 9, 8, 9, 9]
    assert {round(r.s, 6) for r in focal.slope(df, [], "v", 20.0, "s").collect()} == {8.984877}


@pytest.mark.parametrize("tile", [1, 2, 512])
def test_components(spark, tile):
    flags = spark.createDataFrame([(0, 0), (1, 1), (2, 2), (0, 3)], "r INT, c INT")
    patches = lambda k: components.patches(flags, [], k, tile).select("patch").distinct().count()
    assert patches(8) == 2 and patches(4) == 4
    assert components.patches(flags.limit(0), [], 8).count() == 0


@pytest.mark.parametrize("eight", [True, False])
def test_tile_labels_equal_a_flood(eight):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(4)
    for share in (0.2, 0.45, 0.6, 1.0):
        grid = rng.random((40, 37)) < share
        r, c = np.nonzero(grid)
        pixels = pd.DataFrame({"r": r + 7, "c": c + 1000, "id": (r + 7) * (1 << 31) + c + 1000})
        got = dict(zip(zip(r, c), components._label_tile(pixels, eight)))
        seen = {}
        for cell in zip(r, c):  # in order of ids, so a patch's first cell has its least id
            todo = [] if cell in seen else [cell]
            while todo:
                x, y = todo.pop()
                if (x, y) in got and (x, y) not in seen:
                    seen[x, y] = (cell[0] + 7) * (1 << 31) + cell[1] + 1000
                    todo += [(x + i, y + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if eight or i == 0 or j == 0]
        assert got == seen


def test_patch_outline_with_hole():
    ring = {(r, c) for r in range(3) for c in range(3)} - {(1, 1)}
    rings = sorted(G.outline_of_cells(ring), key=len)
    area = lambda pts: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(pts, pts[1:])) / 2
    assert sorted(abs(area(r)) for r in rings) == [1, 9] and sum(area(r) for r in rings) == 8


def test_pr_curve(spark):
    rows = spark.createDataFrame(list(zip([1, 0, 1, 1, 0], [0.9, 0.8, 0.7, 0.6, 0.5])), "y INT, p DOUBLE").withColumn("y", F.col("y") == 1)
    curve = metrics.pr_curve(rows, "p", "y")
    assert metrics.average_precision(curve).first().ap == pytest.approx(0.8055556)
    best = metrics.threshold_for(curve, 0.75).first()
    assert (best.threshold, best.precision, best.recall) == (0.6, 0.75, 1.0)
    r = metrics.precision_at_recall(curve, [0.25, 0.5, 0.75]).first()
    assert tuple(r) == (1.0, 0.75, 0.75)
    ties = spark.createDataFrame(list(zip([1, 0, 1, 0], [0.9, 0.9, 0.5, 0.1])), "y INT, p DOUBLE").withColumn("y", F.col("y") == 1)
    assert metrics.average_precision(metrics.pr_curve(ties, "p", "y")).first().ap == pytest.approx(0.5833333)
    none = metrics.pr_curve(rows.where("NOT y"), "p", "y")
    assert none.where("recall IS NOT NULL").count() == 0 and metrics.average_precision(none).first().ap is None


def test_polygon_rules(spark):
    ring = lambda *p: [tuple(map(float, q)) for q in p]
    zone = [("z", [ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0)), ring((1, 1), (3, 1), (3, 3), (1, 3), (1, 1))])]
    zones = spark.createDataFrame(zone, "zone STRING, polygon ARRAY<ARRAY<STRUCT<x:DOUBLE,y:DOUBLE>>>")
    assert zones.select(G.polygon_area(F.col("polygon")).alias("a")).first().a == 12
    points = spark.createDataFrame([("hole", 2.0, 2.0), ("in", 0.5, 0.5), ("off", 5.5, 2.0)], "k STRING, x DOUBLE, y DOUBLE")
    at = lambda b: {r.k: (r.inside, r.distance) for r in G.zone_of_points(points, ["k"], "x", "y", zones, "zone", "polygon", b).collect()}
    assert at(2.0) == {"hole": (False, 1.0), "in": (True, 0.0), "off": (False, 1.5)} and set(at(1.0)) == {"hole", "in"}


def test_clip_and_simplify():
    square = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
    assert sorted(set(G.clip_ring(square, (5, 5, 20, 20)))) == [(5, 5), (5, 10), (10, 5), (10, 10)]
    assert G.clip_ring(square, (20, 20, 30, 30)) == []
    assert G.simplify_ring([(0, 0), (5, 0.001), (10, 0), (10, 10), (0, 0)], 0.01) == [(0, 0), (10, 0), (10, 10), (0, 0)]


def test_relink(spark):
    runs = lambda n, name, extra: spark.createDataFrame([(name, *extra, 0, a, b) for a, b in n], f"{'candidate' if not extra else 'review'} STRING{', ord INT' if extra else ''}, r INT, c0 INT, c1 INT")
    got = records.relink(runs([(62, 64), (64, 66)], "c", ()), runs([(64, 67)], "r", (1,))).collect()
    assert [(r.review, round(r.iou, 3)) for r in got] == [("r", 0.4)]
    assert records.relink(runs([(0, 4)], "c", ()), runs([(3, 6)], "r", (1,))).count() == 0


def test_draw_of_a_stratum(spark):
    from landchange.operators.learn import stratified_sample

    rows = spark.range(5000).select("id", F.when(F.col("id") < 4000, "big").when(F.col("id") < 4990, "less").alias("s"))
    got = stratified_sample(rows, ["s"], 1000, ["id"])
    assert {r.s: r["count"] for r in got.groupBy("s").count().collect()} == {"big": 1000, "less": 990, None: 10}
    assert got.distinct().count() == 2000 and got.exceptAll(stratified_sample(rows.repartition(3), ["s"], 1000, ["id"])).count() == 0
    assert stratified_sample(rows.limit(0), ["s"], 5, ["id"]).count() == 0


def test_upsert(spark):
    store = spark.createDataFrame([("a", "x", 1), ("b", "x", 2)], "id STRING, v STRING, o INT")
    changes = spark.createDataFrame([("a", "y", 3), ("a", "z", 4), ("b", None, 5), ("c", "n", 6)], "id STRING, v STRING, o INT")
    assert sorted(map(tuple, records.upsert(store, changes, "id", "o", F.col("v").isNull()).collect())) == [("a", "z", 4), ("c", "n", 6)]


def test_constraint(spark):
    cited = spark.createDataFrame([("p", "b"), ("p", "c")], "page STRING, url STRING")
    listed = spark.createDataFrame([("a",), ("b",)], "url STRING")
    bad = records.missing_references(cited, "url", listed, "url")
    assert [r.url for r in bad.collect()] == ["c"]
    with pytest.raises(ValueError):
        records.require_none(bad, "not listed")


def test_guards(spark):
    rows = spark.createDataFrame([("a", [1, 2]), ("b", None)], "k STRING, sizePx ARRAY<INT>")
    assert records.require_some(rows, "scenes") is rows and records.exactly_one(rows.where("k = 'a'"), "area")["k"] == "a"
    records.require_known(["a", "b"], rows, "k")
    for bad in (lambda: records.require_some(rows.limit(0), "scenes"), lambda: records.exactly_one(rows, "area"), lambda: records.exactly_one(rows.limit(0), "area"), lambda: records.require_known(["a", "z"], rows, "k")):
        with pytest.raises(ValueError):
            bad()
    fresh = spark.createDataFrame([("a", [1, 3]), ("b", None)], "k STRING, sizePx ARRAY<INT>")
    assert [r.k for r in records.resized(rows, fresh, "k").collect()] == ["a"]


def test_saved_reviews(spark):
    """A further decision keeps the review's id; a null one deletes; reasons belong to rejects."""
    ddl = "reviewId STRING, rev_key BIGINT, runId STRING, candidateId STRING, decision STRING, reason STRING, note STRING"
    store = spark.createDataFrame([("r1", 1, "x", "c", "confirm", None, "n"), ("r2", 2, "x", "d", "reject", "road", None)], ddl)
    changes = spark.createDataFrame([(None, 3, "x", "c", "reject", None, "y" * 3000), ("r2", 4, "x", "d", None, None, None), ("r3", 5, "x", "e", "confirm", "road", "")], ddl)
    got = {r.reviewId: (r.rev_key, r.decision, r.reason, len(r.note or "")) for r in records.save_reviews(store, changes).collect()}
    assert got == {"r1": (3, "reject", "other", 2000), "r3": (5, "confirm", None, 0)}


def test_union_area_and_crossings():
    import numpy as np

    from landchange.operators import overlap

    box = lambda x, y, w: np.array([[x, y, x + w, y], [x, y + w, x + w, y + w]], float)
    assert overlap.union_area([box(0, 0, 2), box(1, 1, 2), box(0, 0, 1), np.zeros((0, 4))]) == pytest.approx(7) and overlap.union_area([]) == 0
    bow = '{"type":"Polygon","coordinates":[[[0,0],[2,2],[2,0],[0,2],[0,0]]]}'
    plain = '{"type":"Polygon","coordinates":[[[0,0],[2,0],[2,2],[0,2],[0,0]]]}'
    assert overlap.crosses_itself(overlap.all_edges(bow)) and not overlap.crosses_itself(overlap.all_edges(plain))
    assert overlap.areas(overlap.outline_edges(bow), overlap.outline_edges(plain)) == pytest.approx((2, 4, 2))


def test_labels(spark):
    assert one(spark, text.year_label(F.array(F.lit(2001), F.lit(1999))).alias("x")).x == "1999-2001"
    assert one(spark, text.month_label(F.lit(1), F.lit(5)).alias("x")).x == "Jan-May"
    assert math.isclose(one(spark, text.tick_step(F.lit(61.0)).alias("x")).x, 20)


def test_files_round_trip(spark, data, tmp_path):
    from landchange.sources import readers, sinks

    docs = spark.read.parquet(f"{data}/analysis.parquet").limit(5)
    sinks.write_documents(docs, "rec_id", str(tmp_path / "docs"))
    back = readers.analysis_documents(spark, str(tmp_path / "docs" / "*"))
    assert back.count() == 5
    rows = spark.read.parquet(f"{data}/features.parquet").limit(50)
    sinks.write_features(rows, str(tmp_path / "f"))
    some = readers.pixel_layers(spark, str(tmp_path / "f"), ["ndvi"], ["mabuhaw-range"])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan and "ReadSchema: struct<ndvi:double>" in plan
