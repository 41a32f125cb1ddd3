"""Queries that take their whole input, where older ones take a part or a stand-in."""

from pyspark.sql import functions as F

from landchange.plans import engine


def test_radar_takes_every_view(spark, data):
    found = {r["pixel"]: (r["db"], r["db_std"]) for r in engine.radar_stats(spark, data).collect()}
    views = spark.read.parquet(f"{data}/events.parquet").select(F.col("user_id").alias("pixel"), "value")
    assert set(found) == {r["pixel"] for r in views.select("pixel").distinct().collect()}
    db = F.when(F.col("value") > 0, 10 * F.log10("value"))
    plain = views.groupBy("pixel").agg(F.median(db).alias("db"), F.stddev_pop(db).alias("sd")).collect()
    assert all(a is b is None or abs(a - b) < 1e-5 for r in plain for a, b in zip((r["db"], r["sd"]), found[r["pixel"]]))


def test_gate_measures_outlines(spark, data):
    """A square of 0.1 degrees at the equator, without and with a hole of a quarter: some 12,308 ha on the ellipsoid."""
    from landchange.operators import geometry as G

    ring = lambda a, b: f"[[{a},{a}],[{b},{a}],[{b},{b}],[{a},{b}],[{a},{a}]]".replace("[[", "[[", 1)
    texts = [f'{{"type":"Polygon","coordinates":[{ring(0.0, 0.1)}]}}', f'{{"type":"Polygon","coordinates":[{ring(0.0, 0.1)},{ring(0.02, 0.07)}]}}', '{"type":"LineString","coordinates":[[0,0],[1,1]]}']
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k INT, t STRING").withColumn("g", G.geojson_polygons(F.col("t")))
    ha = dict(G.measured_ha(rows, "g").select("k", "measured").collect())
    assert abs(ha[0] / 12308.8 - 1) < 0.005 and abs(ha[1] / ha[0] - 0.75) < 0.001 and ha[2] is None
    assert len({r["measured"] for r in engine.area_gate(spark, data).collect()}) > 1


def test_candidates_are_relinked(spark, data):
    found = engine.relink_iou(spark, data)
    keys = spark.read.parquet(f"{data}/candidates.parquet").select(F.col("cand_key").alias("candidate"), F.lower("reviewId").alias("known")).distinct()
    links = found.join(keys, "candidate").collect()
    assert links and all(0.3 <= r["iou"] <= 1 for r in links)
    assert sum(r["known"] == r["reviewId"].lower() for r in links) > len(links) / 2
