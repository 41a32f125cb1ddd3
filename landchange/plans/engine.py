"""Queries of the engine's own operators, each beside the SQL that checks it. Ids of the survey stand in brackets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from landchange.functions import crs, pixels as P, text
from landchange.operators import change, clouds, components, focal, geometry as G, learn, metrics, mosaic, records, regrid
from landchange.plans import layers as L
from landchange.session import shared_dir, stage

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _rings_sql(source: str) -> str:
    """points (k, part, nr, i, x, y) of the polygons of source (k, g JSON), rings as stored."""
    return f"""WITH src AS ({source}), gj AS (SELECT k, CASE WHEN json_extract_string(g, '$.type') = 'Feature' THEN json_extract(g, '$.geometry') ELSE g END AS g FROM src),
 gp AS (SELECT k, 1 AS part, CAST(json_extract(g, '$.coordinates') AS DOUBLE[][][]) AS rings FROM gj WHERE json_extract_string(g, '$.type') = 'Polygon' UNION ALL
  SELECT k, generate_subscripts(CAST(json_extract(g, '$.coordinates') AS JSON[]), 1), CAST(unnest(CAST(json_extract(g, '$.coordinates') AS JSON[])) AS DOUBLE[][][]) FROM gj WHERE json_extract_string(g, '$.type') = 'MultiPolygon'),
 gr AS (SELECT k, part, generate_subscripts(rings, 1) AS nr, unnest(rings) AS ring FROM gp), gs AS (SELECT k, part, nr, generate_subscripts(ring, 1) AS i, unnest(ring) AS p FROM gr),
 points AS (SELECT k, part, nr, i, p[1] AS x, p[2] AS y FROM gs)"""


# ---- masks, reflectance, indices

REFL = f"""WITH {L.OBS}, v AS (SELECT *, (qa & 31) = 0 AS clear,
 CASE WHEN (qa & 31) = 0 AND dn_b <> 0 THEN dn_b * 2.75e-5 - 0.2 END AS b, CASE WHEN (qa & 31) = 0 AND dn_g <> 0 THEN dn_g * 2.75e-5 - 0.2 END AS g,
 CASE WHEN (qa & 31) = 0 AND dn_r <> 0 THEN dn_r * 2.75e-5 - 0.2 END AS red, CASE WHEN (qa & 31) = 0 AND dn_n <> 0 THEN dn_n * 2.75e-5 - 0.2 END AS nir FROM obs),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY pixel, side ORDER BY b, event_id) - 1 AS rk, count(*) OVER (PARTITION BY pixel, side) AS n FROM v
  WHERE b IS NOT NULL AND g IS NOT NULL AND red IS NOT NULL AND nir IS NOT NULL),
 mos AS (SELECT pixel, r, c, side, b, g, red, nir, event_id, n AS clear_count, (nir - red) / nullif(nir + red, 0) AS ndvi, (g - nir) / nullif(g + nir, 0) AS ndwi
  FROM ranked WHERE rk = (n - 1) // 4),
 px AS (SELECT DISTINCT pixel, r, c FROM obs),
 pair AS (SELECT px.pixel, px.r, px.c, px.pixel % 7 <> 0 AS land, x.ndvi AS ndvi_before, y.ndvi AS ndvi_after, x.ndwi AS ndwi_before, y.ndwi AS ndwi_after,
  x.nir AS nir_before, y.nir AS nir_after FROM px LEFT JOIN mos x ON px.pixel = x.pixel AND x.side = 'before' LEFT JOIN mos y ON px.pixel = y.pixel AND y.side = 'after')"""


def _views(spark: SparkSession, d: str) -> DataFrame:
    o = L.obs(spark, d)
    clear = P.clear_landsat(F.col("qa"))
    band = lambda n: P.masked(P.reflectance_landsat(F.col(n)), clear, F.col(n))
    return o.withColumns({"clear": clear, "b": band("dn_b"), "g": band("dn_g"), "red": band("dn_r"), "nir": band("dn_n")})


def _mosaic(spark: SparkSession, d: str) -> DataFrame:
    m = mosaic.darker_quartile(_views(spark, d), ["pixel", "r", "c", "side"], ["b", "g", "red", "nir"], by="b", tie="event_id")
    return m.withColumns({"ndvi": P.norm_diff(F.col("nir"), F.col("red")), "ndwi": P.norm_diff(F.col("g"), F.col("nir"))})


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    px = L.obs(spark, d).select("pixel", "r", "c").distinct()
    both = mosaic.sides(_mosaic(spark, d), ["pixel"], "side", ["ndvi", "ndwi", "nir"])
    return px.join(both, "pixel", "left").withColumn("land", F.col("pixel") % 7 != 0)


@query(f"WITH {L.OBS} SELECT event_id, (qa & 31) = 0 AS clear FROM obs")
def clear_mask_qa(spark, d):
    """[P1]"""
    return L.obs(spark, d).select("event_id", P.clear_landsat(F.col("qa")).alias("clear"))


@query(f"WITH {L.OBS} SELECT event_id, scl IN (2, 4, 5, 6, 7) AS clear FROM obs")
def clear_mask_scl(spark, d):
    """[P2]"""
    return L.obs(spark, d).select("event_id", P.clear_s2(F.col("scl")).alias("clear"))


@query(f"{REFL} SELECT event_id, b, g, red, nir FROM v")
def reflectance_landsat(spark, d):
    """[P3, P5]"""
    return _views(spark, d).select("event_id", "b", "g", "red", "nir")


@query(f"""WITH {L.OBS}, {L.SCENES}, base AS (SELECT day, arg_max(baseline, (datetime, id)) AS baseline FROM scenes GROUP BY day)
SELECT event_id, (dn_r + CASE WHEN coalesce(baseline, '00.00') >= '04.00' THEN -1000 ELSE 0 END) / 10000.0 AS red FROM obs LEFT JOIN base USING (day)""")
def reflectance_s2_offset(spark, d):
    """[P4, J3]"""
    s = L.scenes(spark, d).withColumn("datetime", F.struct("datetime", "id"))
    return L.obs(spark, d).join(mosaic.latest_baseline(s), "day", "left").select("event_id", P.reflectance_s2(F.col("dn_r"), F.col("baseline")).alias("red"))


_PX = "region, year, row, col"


@query(f"""SELECT {_PX}, (s2_B08 - s2_B04) / nullif(s2_B08 + s2_B04, 0) AS ndvi_, (s2_B03 - s2_B08) / nullif(s2_B03 + s2_B08, 0) AS ndwi_,
((s2_B11 + s2_B04) - (s2_B08 + s2_B02)) / nullif((s2_B11 + s2_B04) + (s2_B08 + s2_B02), 0) AS bsi_, s2_B04 / nullif(s2_B02, 0) AS iron_,
s2_B11 / nullif(s2_B08, 0) AS ferrous_, s2_B11 / nullif(s2_B12, 0) AS clay_, (s2_B02 + s2_B03 + s2_B04) / 3 AS brightness_, s1_vh_db - s1_vv_db AS vh_vv FROM features""")
def spectral_indices(spark, d):
    """[P7, P8, P9, P24]"""
    c = lambda n: P.finite(F.col(n))
    f = spark.read.parquet(f"{d}/features.parquet")
    b2, b3, b4, b8, b11, b12 = (c(f"s2_{n}") for n in ("B02", "B03", "B04", "B08", "B11", "B12"))
    return f.select(
        "region", "year", "row", "col", P.norm_diff(b8, b4).alias("ndvi_"), P.norm_diff(b3, b8).alias("ndwi_"), P.bare_soil_index(b11, b4, b8, b2).alias("bsi_"), P.ratio(b4, b2).alias("iron_"),
        P.ratio(b11, b8).alias("ferrous_"), P.ratio(b11, b12).alias("clay_"), P.brightness(b2, b3, b4).alias("brightness_"), (F.col("s1_vh_db") - F.col("s1_vv_db")).alias("vh_vv"),
    )


_OPEN = "(ndvi IS NOT NULL AND ndwi IS NOT NULL AND s2_B11 IS NOT NULL AND coalesce(land > 0 AND ndvi < 0.35 AND ndwi < 0.1, false))"


@query(f"""SELECT {_PX}, {_OPEN} AS open, CAST(CASE WHEN {_OPEN} AND coalesce(inside, false) THEN 0 WHEN {_OPEN} AND NOT coalesce(near, false) THEN
 CASE worldcover WHEN 40 THEN 1 WHEN 50 THEN 2 WHEN 60 THEN 3 WHEN 20 THEN 4 WHEN 30 THEN 4 WHEN 10 THEN 5 WHEN 90 THEN 5 WHEN 95 THEN 5 WHEN 100 THEN 5 ELSE -1 END
 ELSE -1 END AS INTEGER) AS label FROM features""")
def open_ground_labels(spark, d):
    """[P20, P21]"""
    f = spark.read.parquet(f"{d}/features.parquet")
    open_ = P.open_ground(F.col("ndvi"), F.col("ndwi"), F.col("s2_B11"), F.col("land"))
    return f.select("region", "year", "row", "col", open_.alias("open"), P.label(open_, F.col("inside"), F.col("near"), F.col("worldcover")).cast("int").alias("label"))


@query(f"WITH {L.LATTICE} SELECT r, c, CAST(CASE WHEN loss > 0 THEN 2012 - (loss + 2000) ELSE -1 END AS BIGINT) AS years FROM lat")
def years_since_loss(spark, d):
    """[P22]"""
    return L.lattice(spark, d).select("r", "c", P.years_since_loss(F.col("loss"), F.lit(2012)).cast("bigint").alias("years"))


@query("""WITH f AS (SELECT region, year, row, col, min(ndvi) AS ndvi FROM features GROUP BY ALL)
SELECT a.region, a.year, a.row, a.col, a.ndvi - b.ndvi AS d_ndvi FROM f a JOIN f b ON a.region = b.region AND a.row = b.row AND a.col = b.col AND a.year = b.year + 3""")
def temporal_diff(spark, d):
    """[P10, J2]"""
    f = spark.read.parquet(f"{d}/features.parquet").groupBy("region", "year", "row", "col").agg(F.min("ndvi").alias("ndvi"))
    earlier = f.select("region", "row", "col", (F.col("year") + 3).alias("year"), F.col("ndvi").alias("before"))
    return f.join(earlier, ["region", "year", "row", "col"]).select("region", "year", "row", "col", (F.col("ndvi") - F.col("before")).alias("d_ndvi"))


@query(f"""WITH {L.OBS}, p AS (SELECT pixel, 10 * log10(CASE WHEN value > 0 THEN value END) AS x FROM obs)
SELECT pixel, round(median(x), 9) AS db, round(stddev_pop(x), 6) AS db_std FROM p GROUP BY pixel""")
def radar_stats(spark, d):
    """[P23, A16] of all views of a pixel"""
    db = P.decibels(F.col("value"))
    return L.obs(spark, d).groupBy("pixel").agg(F.round(F.median(db), 9).alias("db"), F.round(F.stddev_pop(db), 6).alias("db_std"))


@query(f"""WITH {L.LATTICE} SELECT r, c, CAST(floor(round(pow(greatest(0, least(1, (cover / 400.0 - 0) / 0.22)), 1 / 1.4) * 255, 9)) AS INTEGER) AS grey FROM lat""")
def display_stretch(spark, d):
    """[P27]"""
    return L.lattice(spark, d).select("r", "c", P.display_stretch(F.col("cover") / F.lit(400.0)).alias("grey"))


@query(f"""WITH {L.LATTICE}, y AS (SELECT r AS pr, c AS pc, CASE WHEN cover >= 30 AND loss > 0 THEN loss + 2000 END AS yr FROM lat),
t AS (SELECT *, greatest(0.0, least(1.0, (coalesce(yr, 2001) - 2001) / 24.0::DOUBLE)) AS t FROM y)
SELECT pr, pc, 255 AS r, CAST(floor(220 * (1 - t)) AS INTEGER) AS g, CAST(floor(40 * (1 - t)) AS INTEGER) AS b, CASE WHEN yr IS NULL THEN 0 ELSE 200 END AS a FROM t""")
def loss_colours(spark, d):
    """[P18, P28, K10]"""
    y = P.counted_loss_year(F.col("loss"), F.col("cover"))
    return L.lattice(spark, d).select(F.col("r").alias("pr"), F.col("c").alias("pc"), P.loss_colour(y, 2001, 2025).alias("k")).select("pr", "pc", "k.*")


# ---- scenes

@query(f"""WITH {L.SCENES}, y(year) AS (VALUES (1996), (1997)) SELECT id, site, platform, CAST(year AS INTEGER) AS year FROM scenes JOIN y
 ON CAST(datetime AS DATE) BETWEEN make_date(year, 1, 1) AND make_date(year, 6, 1) WHERE cloud <= 60 AND platform IN ('landsat-5', 'landsat-7')""")
def scene_search(spark, d):
    """[S2, S2a, U1]"""
    return records.scene_search(L.scenes(spark, d), [1996, 1997], (1, 5), 60, ["landsat-5", "landsat-7"]).select("id", "site", "platform", "year")


@query(f"""WITH {L.SCENES}, y(year) AS (VALUES (1995), (1996), (1997)) SELECT id, CAST(year AS INTEGER) AS year FROM scenes JOIN y
 ON CAST(datetime AS DATE) BETWEEN make_date(year, 11, 1) AND make_date(year + 1, 3, 1) WHERE cloud <= 40""")
def scene_search_over_new_year(spark, d):
    """[S2, U1] a window that ends in the next year"""
    return records.scene_search(L.scenes(spark, d), [1995, 1996, 1997], (11, 2), 40).select("id", "year")


@query(f"""WITH {L.SCENES} SELECT site, array_to_string(list_sort(list(DISTINCT platform)), ' ') AS platforms, CAST(count(DISTINCT CAST(datetime AS DATE)) AS BIGINT) AS dates,
 count(*) AS scene_count, arg_min(id, (datetime, id)) AS first_id FROM scenes GROUP BY site""")
def composite_meta(spark, d):
    """[A5]"""
    return mosaic.scene_lists(L.scenes(spark, d), ["site"]).select("site", F.array_join("platforms", " ").alias("platforms"), F.size("dates").cast("bigint").alias("dates"), "scene_count", F.element_at("ids", 1).alias("first_id"))


@query(f"""WITH {L.SITES} SELECT site, unnest(list_transform(generate_series(CAST(floor((lon - 0.05) / 10) * 10 AS INTEGER), CAST(floor((lon + 0.05) / 10) * 10 AS INTEGER), 10),
 lambda x: lpad(CAST(CAST(ceil((lat + 0.05) / 10) * 10 AS INTEGER) AS VARCHAR), 2, '0') || 'N_' || lpad(CAST(x AS VARCHAR), 3, '0') || 'E')) AS tile FROM sites
 UNION SELECT site, unnest(list_transform(generate_series(CAST(floor((lon - 0.05) / 10) * 10 AS INTEGER), CAST(floor((lon + 0.05) / 10) * 10 AS INTEGER), 10),
 lambda x: lpad(CAST(CAST(ceil((lat - 0.05) / 10) * 10 AS INTEGER) AS VARCHAR), 2, '0') || 'N_' || lpad(CAST(x AS VARCHAR), 3, '0') || 'E')) AS tile FROM sites""")
def tile_names(spark, d):
    """[S10]"""
    names = crs.tile_names(F.col("lon") - 0.05, F.col("lat") - 0.05, F.col("lon") + 0.05, F.col("lat") + 0.05)
    return L.sites(spark, d).select("site", F.explode(names).alias("tile"))


@query(f"WITH {L.OBS} SELECT pixel, day, arg_min(dn_r, event_id) FILTER (WHERE qa % 5 <> 0) AS red, arg_min(dn_n, event_id) FILTER (WHERE qa % 7 <> 0) AS nir FROM obs GROUP BY pixel, day")
def solar_day_mosaic(spark, d):
    """[S5]"""
    o = L.obs(spark, d).select("pixel", "day", "event_id", F.when(F.col("qa") % 5 != 0, F.col("dn_r")).alias("red"), F.when(F.col("qa") % 7 != 0, F.col("dn_n")).alias("nir"))
    return mosaic.solar_day_mosaic(o, ["pixel"], "event_id", ["red", "nir"])


# ---- composites and change

@query(f"{REFL} SELECT pixel, side, b, g, red, nir, event_id, CAST(clear_count AS BIGINT) AS clear_count FROM mos")
def darker_quartile_mosaic(spark, d):
    """[A1, A2, W1, P6]"""
    return _mosaic(spark, d).select("pixel", "side", "b", "g", "red", "nir", "event_id", "clear_count")


@query(f"""{REFL}, full_px AS (SELECT px.pixel, s.side FROM px, (VALUES ('before'), ('after')) s(side)),
 k AS (SELECT f.side, coalesce(m.clear_count, 0) AS n FROM full_px f LEFT JOIN mos m ON f.pixel = m.pixel AND f.side = m.side)
SELECT side, avg(CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END) AS clear_fraction, CAST(median(n) AS DOUBLE) AS median_clear FROM k GROUP BY side""")
def clear_counts(spark, d):
    """[A3, A4]"""
    lattice = L.obs(spark, d).select("pixel").distinct().withColumn("side", F.explode(F.array(F.lit("before"), F.lit("after"))))
    return mosaic.coverage(mosaic.on_lattice(lattice, _mosaic(spark, d), ["pixel", "side"]), ["side"])


_VALID = "(land AND ndvi_before IS NOT NULL AND ndvi_after IS NOT NULL)"


@query(f"""{REFL} SELECT r, avg(CASE WHEN {_VALID} THEN 1.0 ELSE 0.0 END) AS comparable_fraction, count(*) FILTER (WHERE {_VALID} AND ndvi_before >= 0.5) * 0.01::DOUBLE AS vegetated_before_ha,
 count(*) FILTER (WHERE {_VALID} AND ndvi_before >= 0.5 AND ndvi_after < 0.3) * 0.01::DOUBLE AS vegetation_to_bare_ha FROM pair GROUP BY r""")
def change_veg_to_bare(spark, d):
    """[J1, P11, P12, A6, A7]"""
    return change.vegetation_to_bare(_pairs(spark, d), ["r"], 0.01).drop("inside_footprint_ha")


@query(f"""{REFL} SELECT r, CASE WHEN count(CASE WHEN r % 2 = 0 THEN c < 8 END) > 0 THEN count(*) FILTER (WHERE {_VALID} AND ndvi_before >= 0.5 AND ndvi_after < 0.3 AND r % 2 = 0 AND c < 8) * 0.01::DOUBLE END AS inside_footprint_ha
 FROM pair GROUP BY r""")
def change_inside_footprint(spark, d):
    """[A8] rows of odd number have no footprint"""
    inside = F.when(F.col("r") % 2 == 0, F.col("c") < 8)
    return change.vegetation_to_bare(_pairs(spark, d), ["r"], 0.01, inside).select("r", "inside_footprint_ha")


def _w(s: str) -> str:
    return f"(coalesce(ndwi_{s} > 0.1, false) OR (NOT land AND coalesce(nir_{s} < 0.03, false)))"


def _dry(s: str) -> str:
    return f"coalesce(ndwi_{s} < -0.1 AND nir_{s} >= 0.05, false)"


_BOTH = "ndwi_before IS NOT NULL AND ndwi_after IS NOT NULL"


@query(f"""{REFL} SELECT r, count(*) FILTER (WHERE {_BOTH} AND land AND {_dry("before")} AND {_w("after")}) * 0.01::DOUBLE AS land_to_water_ha,
 count(*) FILTER (WHERE {_BOTH} AND {_w("before")} AND {_dry("after")}) * 0.01::DOUBLE AS water_to_land_ha FROM pair GROUP BY r""")
def change_water(spark, d):
    """[P13-P16]"""
    return change.water_change(_pairs(spark, d), ["r"], 0.01)


# ---- forest and zones

_AREA = "CAST(cos(radians(10 + r * 0.00025)) * 1e6 AS BIGINT)"


@query(f"WITH {L.LATTICE} SELECT DISTINCT r, round(6371007.2 * 6371007.2 * radians(0.00025) * radians(0.00025) / 10000 * cos(radians(r * 1.5)), 9) AS ha FROM lat")
def spherical_pixel_area(spark, d):
    """[G11]"""
    return L.lattice(spark, d).select("r").distinct().select("r", F.round(crs.sphere_pixel_ha(F.col("r") * 1.5), 9).alias("ha"))


_INSIDE = "(SELECT count(*) % 2 = 1 FROM edges e WHERE e.zone = z.zone AND (e.y0 > l.r + 0.5) <> (e.y1 > l.r + 0.5) AND l.c + 0.5 < (e.x1 - e.x0) * (l.r + 0.5 - e.y0) / (e.y1 - e.y0) + e.x0)"
_DIST = """(SELECT min(sqrt(pow(l.c + 0.5 - (e.x0 + t * (e.x1 - e.x0)), 2) + pow(l.r + 0.5 - (e.y0 + t * (e.y1 - e.y0)), 2))) FROM (SELECT *,
 greatest(0.0, least(1.0, ((l.c + 0.5 - x0) * (x1 - x0) + (l.r + 0.5 - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS t FROM edges) e WHERE e.zone = z.zone)"""
ZONED = f"""WITH {L.LATTICE}, {L.EDGES}, z AS (SELECT DISTINCT zone FROM edges),
 raw AS (SELECT l.r, l.c, z.zone, {_INSIDE} AS inside, {_DIST} AS dist FROM lat l, z),
 zp AS (SELECT r, c, zone, inside, CASE WHEN inside THEN 0.0 ELSE dist END AS distance, NOT inside AS in_buffer FROM raw WHERE inside OR dist <= 3)"""


def _zoned(spark: SparkSession, d: str) -> DataFrame:
    lat = L.lattice(spark, d).withColumns({"x": F.col("c") + 0.5, "y": F.col("r") + 0.5})
    return G.zone_of_points(lat, ["r", "c"], "x", "y", L.zones(spark), "zone", "polygon", 3.0)


@query(f"{ZONED} SELECT r, c, zone FROM zp WHERE inside")
def point_in_polygon(spark, d):
    """[J4, X2]"""
    return _zoned(spark, d).where("inside").select("r", "c", "zone")


@query(f"{ZONED} SELECT r, c, zone, round(distance, 9) AS distance FROM zp")
def distance_to_boundary(spark, d):
    """[X5, X6]"""
    return _zoned(spark, d).select("r", "c", "zone", F.round("distance", 9).alias("distance"))


@query(f"{ZONED} SELECT zone, count(*) FILTER (WHERE in_buffer) AS band, count(*) FILTER (WHERE inside) AS within FROM zp GROUP BY zone")
def buffer_band(spark, d):
    """[J5, X8]"""
    return _zoned(spark, d).groupBy("zone").agg(F.count_if("in_buffer").alias("band"), F.count_if("inside").alias("within"))


@query(f"""{ZONED} SELECT zone, count(*) FILTER (WHERE inside) * 0.01::DOUBLE AS inside_ha, count(*) FILTER (WHERE in_buffer) * 0.01::DOUBLE AS buffer_ha
 FROM zp JOIN lat USING (r, c) WHERE n % 3 = 0 GROUP BY zone""")
def protected_overlay(spark, d):
    """[A12]"""
    masks = L.lattice(spark, d).select("r", "c", (F.col("n") % 3 == 0).alias("changed"))
    return change.zone_change(masks, _zoned(spark, d), ["r", "c"], [], 0.01)


_LOSS = "CASE WHEN cover >= 30 AND loss > 0 THEN loss + 2000 END"


@query(f"""WITH {L.LATTICE}, y AS (SELECT unnest(generate_series(2001, 2025)) AS year), l AS (SELECT {_LOSS} AS year, count(*) * 0.25::DOUBLE AS ha FROM lat GROUP BY 1)
SELECT CAST(y.year AS INTEGER) AS year, coalesce(l.ha, 0.0) AS loss_ha FROM y LEFT JOIN l ON y.year = l.year""")
def forest_loss_by_year(spark, d):
    """[P17, P18, A10] every year of 2001 to 2025"""
    layer = _forest(spark, d)
    return change.loss_by_year(layer, ["site"], 2001, 2025).select("year", "loss_ha")


def _forest(spark: SparkSession, d: str) -> DataFrame:
    return L.lattice(spark, d).select(F.lit(1).alias("site"), "r", "c", F.col("cover").cast("int").alias("treecover"), F.col("loss").cast("int").alias("lossyear"), F.lit(0.25).alias("area_ha"))


@query(f"""{ZONED}, f AS (SELECT zp.zone, lat.* FROM zp JOIN lat USING (r, c) WHERE inside), y AS (SELECT zone, {_LOSS} AS year, round(count(*) * 0.25::DOUBLE, 1) AS ha FROM f WHERE {_LOSS} IS NOT NULL GROUP BY ALL),
 s AS (SELECT zone, round(sum(ha), 1) AS loss_ha FROM y GROUP BY zone)
SELECT f.zone, round(count(*) * 0.25::DOUBLE, 1) AS area_ha, round(count(*) FILTER (WHERE cover >= 30) * 0.25::DOUBLE, 1) AS tree_cover_ha, any_value(s.loss_ha) AS loss_ha FROM f JOIN s USING (zone) GROUP BY f.zone""")
def forest_loss_footprint(spark, d):
    """[A9, A10, A11] within each zone"""
    layer = _zoned(spark, d).where("inside").select("r", "c", "zone").join(_forest(spark, d), ["r", "c"])
    return change.loss_summary(layer, ["zone"], 2001, 2025).select("zone", "area_ha", "tree_cover_ha", "loss_ha")


@query(f"""WITH {L.EDGES} SELECT zone, abs(sum(x0 * y1 - x1 * y0)) / 2 AS shoelace FROM edges WHERE zone <> 'hole' GROUP BY zone UNION ALL SELECT 'hole', 525.0""")
def polygon_area(spark, d):
    """[X1] the hole is taken off"""
    return L.zones(spark).select("zone", G.polygon_area(F.col("polygon")).alias("shoelace"))


@query(f"""{_rings_sql("SELECT area_key AS k, CAST(geometry AS JSON) AS g FROM protected_areas")},
 z AS (SELECT k, CAST(floor(((min(x) + max(x)) / 2 + 180) / 6) + 1 AS INTEGER) AS zone FROM points GROUP BY k),
 t AS (SELECT *, radians(y) AS phi, radians(x - (zone * 6 - 183)) AS lam, {crs._E!r} AS e FROM points JOIN z USING (k)),
 u AS (SELECT *, sinh(atanh(sin(phi)) - e * atanh(e * sin(phi))) AS t FROM t), v AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM u),
 m AS (SELECT k, part, nr, i, {0.9996 * crs._A!r} * (eta + {crs._ALPHA[0]!r} * cos(2 * xi) * sinh(2 * eta) + {crs._ALPHA[1]!r} * cos(4 * xi) * sinh(4 * eta) + {crs._ALPHA[2]!r} * cos(6 * xi) * sinh(6 * eta)) AS e,
  {0.9996 * crs._A!r} * (xi + {crs._ALPHA[0]!r} * sin(2 * xi) * cosh(2 * eta) + {crs._ALPHA[1]!r} * sin(4 * xi) * cosh(4 * eta) + {crs._ALPHA[2]!r} * sin(6 * xi) * cosh(6 * eta)) AS n FROM v),
 a AS (SELECT a.k, a.part, a.nr, abs(sum(a.e * b.n - b.e * a.n)) / 20000 AS ha FROM m a JOIN m b ON a.k = b.k AND a.part = b.part AND a.nr = b.nr AND b.i = a.i + 1 GROUP BY ALL),
 h AS (SELECT k, sum(CASE WHEN nr = 1 THEN ha ELSE -ha END) AS measured FROM a GROUP BY k)
SELECT area_key, round(measured, 3) AS measured, round(abs(measured - stated_area_ha) / stated_area_ha, 7) AS off FROM protected_areas JOIN h ON k = area_key WHERE abs(measured - stated_area_ha) / stated_area_ha > 0.03""")
def area_gate(spark, d):
    """[X11, D4] areas whose outline's area in UTM is more than 3 % off the stated one; buffer lines have none"""
    areas = spark.read.parquet(f"{d}/protected_areas.parquet").withColumn("g", G.geojson_polygons(F.col("geometry")))
    return G.area_gate(G.measured_ha(areas, "g"), "measured", "stated_area_ha").select("area_key", F.round("measured", 3).alias("measured"), F.round("off", 7).alias("off"))


@query("SELECT 'ell' AS zone, 'M 32.0,2.0 L 48.0,2.0 L 48.0,8.0 L 38.0,8.0 L 38.0,20.0 L 32.0,20.0 Z' AS path UNION ALL SELECT 'tri', 'M 10.0,35.0 L 40.0,35.0 L 25.0,49.0 Z'")
def svg_paths(spark, d):
    """[K14]"""
    return L.zones(spark).where("zone <> 'hole'").select("zone", G.svg_path(F.col("polygon")).alias("path"))


# ---- grids

@query(f"""WITH {L.SITES}, k AS (SELECT site, lon, lat, CAST(floor((lon + 180) / 6) + 1 AS INTEGER) AS zone FROM sites),
 t AS (SELECT *, radians(lat) AS phi, radians(lon - (zone * 6 - 183)) AS lam, {crs._E!r} AS e FROM k),
 u AS (SELECT *, sinh(atanh(sin(phi)) - e * atanh(e * sin(phi))) AS t FROM t), v AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM u)
SELECT site, zone, CAST(32600 + zone AS INTEGER) AS epsg,
 round(500000 + {0.9996 * crs._A!r} * (eta + {crs._ALPHA[0]!r} * cos(2 * xi) * sinh(2 * eta) + {crs._ALPHA[1]!r} * cos(4 * xi) * sinh(4 * eta) + {crs._ALPHA[2]!r} * cos(6 * xi) * sinh(6 * eta)), 4) AS east,
 round({0.9996 * crs._A!r} * (xi + {crs._ALPHA[0]!r} * sin(2 * xi) * cosh(2 * eta) + {crs._ALPHA[1]!r} * sin(4 * xi) * cosh(4 * eta) + {crs._ALPHA[2]!r} * sin(6 * xi) * cosh(6 * eta)), 4) AS north FROM v""")
def utm_forward(spark, d):
    """[G1, G2]"""
    zone = crs.utm_zone(F.col("lon"))
    e, n = crs.utm_forward(F.col("lon"), F.col("lat"), zone)
    return L.sites(spark, d).select("site", zone.alias("zone"), crs.utm_epsg(F.col("lon"), F.col("lat")).alias("epsg"), F.round(e, 4).alias("east"), F.round(n, 4).alias("north"))


@query(f"WITH {L.SITES} SELECT site, round(lon, 8) AS lon, round(lat, 8) AS lat FROM sites")
def utm_round_trip(spark, d):
    """[G2, G3] there and back: the SQL has the positions themselves"""
    zone = crs.utm_zone(F.col("lon"))
    e, n = crs.utm_forward(F.col("lon"), F.col("lat"), zone)
    placed = L.sites(spark, d).select("site", zone.alias("zone"), e.alias("e"), n.alias("n"))
    lon, lat = crs.utm_inverse(F.col("e"), F.col("n"), F.col("zone"))
    return placed.select("site", F.round(lon, 8).alias("lon"), F.round(lat, 8).alias("lat"))


@query()
def site_grid_bounds(spark, d):
    """[G4, G5, G12] each site's snapped grid and the bounds of its outline, a point every 100 m"""
    zone = crs.utm_zone(F.col("lon"))
    e, n = crs.utm_forward(F.col("lon"), F.col("lat"), zone)
    grid = L.sites(spark, d).select("site", zone.alias("zone"), crs.snap(e, F.col("box_km"), F.lit(10.0)).alias("left"), crs.snap(n, F.col("box_km"), F.lit(10.0)).alias("bottom"), crs.pixels_across(F.col("box_km"), F.lit(10.0)).alias("size"))
    step = F.explode(F.sequence(F.lit(0), F.col("size") * 10, F.lit(100)))
    along = grid.withColumn("s", step).withColumn("s", F.col("s").cast("double")).withColumn("span", F.col("size") * 10.0)
    corner = F.explode(F.array(*(F.struct(x.alias("x"), y.alias("y")) for x, y in ((F.col("left") + F.col("s"), F.col("bottom")), (F.col("left") + F.col("s"), F.col("bottom") + F.col("span")), (F.col("left"), F.col("bottom") + F.col("s")), (F.col("left") + F.col("span"), F.col("bottom") + F.col("s"))))))
    points = along.select("site", "zone", "left", "bottom", "size", corner.alias("p"))
    lon, lat = crs.utm_inverse(F.col("p.x"), F.col("p.y"), F.col("zone"))
    ends = [f(x).alias(a) for f, x, a in ((F.min, lon, "west"), (F.min, lat, "south"), (F.max, lon, "east"), (F.max, lat, "north"))]
    return points.groupBy("site", "zone", "left", "bottom", "size").agg(*ends)


@query(f"""WITH {L.SITES} SELECT site, (117 + site % 10) + (site % 60) / 60.0::DOUBLE + (site * 7 % 61) / 3600.0::DOUBLE AS lon FROM sites""")
def dms_parse(spark, d):
    """[G10]"""
    k = F.col("site")
    t = F.concat_ws("-", (117 + k % 10).cast("string"), (k % 60).cast("string"), (k * 7 % 61).cast("string"))
    return L.sites(spark, d).select("site", crs.dms(t).alias("lon"))


@query(f"WITH {L.LATTICE} SELECT r // 6 AS tr, c // 6 AS tc, avg(elevation) AS elevation FROM lat WHERE r % 6 = 3 AND c % 6 = 3 GROUP BY ALL")
def nearest_resample(spark, d):
    """[S4, G8, S12] a cell's value is that of the source cell its centre falls in"""
    lat = L.lattice(spark, d)
    coarse = lat.select(F.floor((F.col("r") - 3) / 6).cast("int").alias("r"), F.floor((F.col("c") - 3) / 6).cast("int").alias("c")).where("r >= 0 AND c >= 0").distinct()
    at = regrid.nearest(regrid.centres(coarse, (0.0, 0.0, 6.0)), lat, (0.0, 0.0, 1.0), [], ["elevation"])
    return at.where("elevation IS NOT NULL").select(F.col("r").alias("tr"), F.col("c").alias("tc"), "elevation")


@query(f"""WITH {L.LATTICE}, k AS (SELECT r // 5 AS tr, c // 5 AS tc, loss, count(*) AS n FROM lat GROUP BY ALL)
SELECT tr, tc, loss FROM k QUALIFY row_number() OVER (PARTITION BY tr, tc ORDER BY n DESC, loss) = 1""")
def mode_resample(spark, d):
    """[S8, G7, G8] the most frequent value of each block, the least of equals"""
    blocks = regrid.mode(L.lattice(spark, d), (0.0, 0.0, 1.0), (0.0, 0.0, 5.0), [], "loss")
    return blocks.select(F.col("r").alias("tr"), F.col("c").alias("tc"), "loss")


@query(f"""WITH {L.LATTICE} SELECT a.r, a.c, round(avg(b.elevation), 9) AS elevation FROM lat a JOIN lat b ON b.r IN (a.r, a.r + 1) AND b.c IN (a.c, a.c + 1)
 WHERE a.r < 49 AND a.c < 49 GROUP BY a.r, a.c""")
def bilinear_resample(spark, d):
    """[G8] half a cell to the right and down: four neighbours of equal weight"""
    lat = L.lattice(spark, d).select("r", "c", "elevation")
    targets = regrid.centres(lat.select("r", "c").where("r < 49 AND c < 49"), (0.5, -0.5, 1.0))
    return regrid.bilinear(targets, lat, (0.0, 0.0, 1.0), [], "elevation").select("r", "c", F.round("elevation", 9).alias("elevation"))


_FINE = 30.0 / 20.0  # target pixels of 30 m on a lattice of 20 m, shifted by (5, 10) m


@query(f"""WITH {L.LATTICE}, t AS (SELECT r, c, 0.25 + (c + 0.5) * {_FINE} - 0.5 AS fc, 0.5 + (r + 0.5) * {_FINE} - 0.5 AS fr FROM lat WHERE r < 32 AND c < 32),
 k AS (SELECT t.r, t.c, lat.elevation AS v, (1 - abs(t.fr - lat.r)) * (1 - abs(t.fc - lat.c)) AS w FROM t JOIN lat ON abs(t.fr - lat.r) < 1 AND abs(t.fc - lat.c) < 1)
SELECT r, c, round(sum(v * w) / sum(w), 9) AS elevation FROM k GROUP BY r, c""")
def regrid_bilinear(spark, d):
    """[S4, G8] onto pixels of another size and origin"""
    lat = L.lattice(spark, d).select("r", "c", "elevation")
    targets = regrid.centres(lat.select("r", "c").where("r < 32 AND c < 32"), (5.0, -10.0, 30.0))
    return regrid.bilinear(targets, lat, (0.0, 0.0, 20.0), [], "elevation").where("elevation IS NOT NULL").select("r", "c", F.round("elevation", 9).alias("elevation"))


@query("""SELECT CAST(l_partkey % 50 AS INTEGER) AS r, CAST(l_suppkey % 50 AS INTEGER) AS c, max(l_quantity) AS height, CASE WHEN max(l_quantity * 2.5::DOUBLE) > 100 THEN 0 ELSE max(l_quantity * 2.5::DOUBLE) END AS water
FROM lineitem GROUP BY 1, 2""")
def static_layers(spark, d):
    """[S7, S8, S9] tiles that overlap, a line number each, merged by their highest value"""
    t = spark.read.parquet(f"{d}/lineitem.parquet").select("l_linenumber", (F.col("l_partkey") % 50).cast("int").alias("r"), (F.col("l_suppkey") % 50).cast("int").alias("c"), F.col("l_quantity").alias("height"), (F.col("l_quantity") * 2.5).alias("water"))
    return regrid.max_merge(t, ["r", "c"], ["height"]).join(regrid.max_merge(t, ["r", "c"], ["water"], 100.0), ["r", "c"])


# ---- focal

def _mirror(x: str, o: str) -> str:
    return f"CASE WHEN {x} + {o} < 0 THEN -1 - ({x} + {o}) WHEN {x} + {o} > 49 THEN 99 - ({x} + {o}) ELSE {x} + {o} END"


def _focal_sql(agg: str, k: int) -> str:
    o = f"(SELECT unnest(generate_series({-k}, {k})) AS o)"
    return f"WITH {L.LATTICE}, f AS (SELECT a.r, a.c, any_value(a.elevation) AS own, {agg} AS v FROM lat a, {o} i, {o} j JOIN lat b ON b.r = {_mirror('a.r', 'i.o')} AND b.c = {_mirror('a.c', 'j.o')} GROUP BY a.r, a.c)"


@query(f"{_focal_sql('avg(b.elevation)', 5)} SELECT r, c, round(v, 9) AS v FROM f")
def focal_mean_11(spark, d):
    """[W2]"""
    return focal.focal(L.lattice(spark, d).withColumn("v", F.col("elevation")), [], ["v"], 11).select("r", "c", F.round("v", 9).alias("v"))


@query(f"{_focal_sql('max(b.elevation)', 2)} SELECT r, c, v FROM f")
def focal_max_5(spark, d):
    """[W5]"""
    return focal.focal(L.lattice(spark, d).withColumn("v", F.col("elevation")), [], ["v"], 5, F.max).select("r", "c", "v")


@query(f"{_focal_sql('avg(b.elevation * b.elevation) - avg(b.elevation) * avg(b.elevation)', 2)} SELECT r, c, round(sqrt(greatest(v, 0)), 6) AS v FROM f")
def focal_std_5(spark, d):
    """[W3]"""
    return focal.focal_std(L.lattice(spark, d), [], "elevation", 5, "v").select("r", "c", F.round("v", 6).alias("v"))


@query(f"{_focal_sql('avg(b.elevation)', 12)} SELECT r, c, round(own - v, 9) AS v FROM f")
def tpi_25(spark, d):
    """[W7]"""
    return focal.position_index(L.lattice(spark, d), [], "elevation", 25, "v").select("r", "c", F.round("v", 9).alias("v"))


def _grad(line: str, axis: str) -> str:
    w = f"OVER (PARTITION BY {line} ORDER BY {axis})"
    return f"CASE WHEN {axis} = 0 THEN (lead(elevation) {w} - elevation) / 20 WHEN {axis} = 49 THEN (elevation - lag(elevation) {w}) / 20 ELSE (lead(elevation) {w} - lag(elevation) {w}) / 40 END"


@query(f"WITH {L.LATTICE}, g AS (SELECT r, c, {_grad('r', 'c')} AS dx, {_grad('c', 'r')} AS dy FROM lat) SELECT r, c, round(degrees(atan(sqrt(dx * dx + dy * dy))), 9) AS v FROM g")
def lattice_slope(spark, d):
    """[W6]"""
    return focal.slope(L.lattice(spark, d), [], "elevation", 20.0, "v").select("r", "c", F.round("v", 9).alias("v"))


@query(f"{_focal_sql('avg(CASE WHEN b.elevation < 25 THEN 1.0 ELSE 0.0 END)', 5)} SELECT r, c, round(v, 9) AS v FROM f")
def bare_fraction(spark, d):
    """[P25, W2]"""
    bare = L.lattice(spark, d).withColumn("v", P.bare_indicator(F.when(F.col("elevation") < 25, 0.1).otherwise(0.9)))
    return focal.focal(bare, [], ["v"], 11).select("r", "c", F.round("v", 9).alias("v"))


# ---- patches

def _patch_sql(near: str) -> str:
    return f"""WITH RECURSIVE {L.LATTICE}, f AS (SELECT r, c, r * 2147483648 + c AS id, cover, n FROM lat WHERE n % 3 = 0),
 t AS (SELECT a.id AS a, b.id AS b FROM f a JOIN f b ON {near}), reach AS (SELECT id AS a, id AS b FROM f UNION SELECT reach.a, t.b FROM reach JOIN t ON reach.b = t.a),
 p AS (SELECT a AS id, CAST(min(b) AS BIGINT) AS patch FROM reach GROUP BY a), q AS (SELECT f.*, p.patch FROM f JOIN p USING (id))"""


_EIGHT, _FOUR = "abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1", "abs(a.r - b.r) + abs(a.c - b.c) <= 1"


def _patched(spark: SparkSession, d: str, connectivity: int) -> DataFrame:
    flags = L.lattice(spark, d).where("n % 3 = 0").select("r", "c", "cover", "n")
    return components.patches(flags, [], connectivity, tile=16)


@query(f"{_patch_sql(_EIGHT)} SELECT r, c, CAST(dense_rank() OVER (ORDER BY patch) AS INTEGER) AS patch FROM q")
def components_8(spark, d):
    """[W8] numbered in scan order"""
    return components.numbered(_patched(spark, d, 8), []).select("r", "c", F.col("number").alias("patch"))


@query(f"{_patch_sql(_FOUR)} SELECT r, c, patch FROM q")
def components_4(spark, d):
    """[W8]"""
    return _patched(spark, d, 4).select("r", "c", "patch")


@query(f"""{_patch_sql(_EIGHT)} SELECT patch, count(*) AS pixels, round(count(*) * 0.04, 9)::DOUBLE AS area_ha, round(avg(cover / 100.0), 9)::DOUBLE AS mean_p, bool_or(cover > 90) AS touches,
 min(c) AS c0, min(r) AS r0, max(c) + 1 AS c1, max(r) + 1 AS r1, round(avg(c + 0.5), 9)::DOUBLE AS centre_c FROM q GROUP BY patch""")
def patch_stats(spark, d):
    """[A18, A19, J9]"""
    p = _patched(spark, d, 8).withColumns({"p": F.col("cover") / 100.0, "near": F.col("cover") > 90, "earlier": F.lit(0.5)})
    s = components.patch_stats(p, [], 0.04, "p", "near", "earlier")
    return s.select("patch", "pixels", F.round("area_ha", 9).alias("area_ha"), F.round("mean_p", 9).alias("mean_p"), "touches", "c0", "r0", "c1", "r1", F.round("centre_c", 9).alias("centre_c"))


@query(f"{_patch_sql(_FOUR)} SELECT patch, count(*) AS pixels, avg(CASE WHEN cover > 50 THEN 1.0 ELSE 0.0 END) >= 0.25 AS found FROM q GROUP BY patch HAVING count(*) >= 4")
def mine_level_detection(spark, d):
    """[A26] mines of enough pixels, found if a quarter is flagged"""
    mines = _patched(spark, d, 4).groupBy("patch").agg(F.count("*").alias("pixels"), (F.avg((F.col("cover") > 50).cast("double")) >= 0.25).alias("found"))
    return mines.where("pixels >= 4")


@query(f"{_patch_sql(_EIGHT)}, u AS (SELECT patch, count(*) AS n FROM q GROUP BY patch HAVING count(*) >= 4 AND NOT bool_or(cover > 90)) SELECT count(*) AS patches, CAST(coalesce(sum(n), 0) AS BIGINT) AS pixels FROM u")
def unmapped_patches(spark, d):
    """[A27]"""
    found = _patched(spark, d, 8).groupBy("patch").agg(F.count("*").alias("n"), F.bool_or(F.col("cover") > 90).alias("near")).where("n >= 4 AND NOT near")
    return found.agg(F.count("*").alias("patches"), F.coalesce(F.sum("n"), F.lit(0)).alias("pixels"))


@query()
def patch_outlines(spark, d):
    """[X13] rings of pixel corners"""
    return G.patch_outlines(_patched(spark, d, 8), []).select("patch", F.size("rings").alias("rings"), G.ring_area(F.col("rings")[0]).alias("outline_area"))


# ---- clouds

@query(f"WITH {L.OBS} SELECT r, day, avg(CASE WHEN scl > 0 THEN 1.0 ELSE 0.0 END) AS data_share FROM obs GROUP BY r, day HAVING avg(CASE WHEN scl > 0 THEN 1.0 ELSE 0.0 END) >= 0.5")
def scene_usable(spark, d):
    """[P26]"""
    return clouds.usable_days(L.obs(spark, d), ["r"])


@query(f"WITH {L.OBS}, k AS (SELECT r, day, avg(CASE WHEN (qa & 31) = 0 THEN 1.0 ELSE 0.0 END) AS s FROM obs GROUP BY r, day) SELECT r, CAST(month(day) AS INTEGER) AS month, round(avg(s), 9) AS share, count(*) AS days FROM k GROUP BY ALL")
def monthly_clear_share(spark, d):
    """[A14]"""
    o = L.obs(spark, d).withColumn("clear", P.clear_landsat(F.col("qa")))
    return clouds.monthly_clear_share(o, ["r"]).select("r", "month", F.round("share", 9).alias("share"), "days")


@query(f"""WITH {L.SCENES}, w AS (SELECT len, f, f + len - 1 AS l FROM (SELECT unnest(generate_series(3, 6)) AS len), (SELECT unnest(generate_series(1, 10)) AS f) WHERE f + len - 1 <= 12),
 py AS (SELECT DISTINCT site, year(datetime) AS y FROM scenes WHERE year(datetime) BETWEEN 1995 AND 1997),
 k AS (SELECT w.len, w.f, w.l, s.site, year(s.datetime) AS y, count(*) FILTER (WHERE cloud < 50) AS n FROM scenes s JOIN w ON month(s.datetime) BETWEEN w.f AND w.l WHERE year(s.datetime) BETWEEN 1995 AND 1997 GROUP BY ALL),
 sh AS (SELECT len, f, l, y, avg(CASE WHEN n >= 3 THEN 1.0 ELSE 0.0 END) AS share FROM k GROUP BY ALL)
SELECT CAST(len AS INTEGER) AS length, CAST(f AS INTEGER) AS first, CAST(l AS INTEGER) AS last, round(min(share), 9) AS worst, round(avg(share), 9) AS mean FROM sh GROUP BY len, f, l HAVING count(*) = 3
ORDER BY round(min(share), 2) DESC, len, f LIMIT 6""")
def cloud_windows_topk(spark, d):
    """[A13, A15, W9, O2] the six best month windows"""
    clear = L.scenes(spark, d).select("site", F.col("datetime").cast("date").alias("day"), (F.col("cloud") < 50).alias("clear"))
    ranked = clouds.window_ranking(clear, [], ["site"], [1995, 1996, 1997])
    top = ranked.orderBy(F.desc(F.round("worst", 2)), "length", "first").limit(6)
    return top.select("length", "first", "last", F.round("worst", 9).alias("worst"), F.round("mean", 9).alias("mean"))


# ---- metrics

CURVE = """WITH s AS (SELECT "meanProbability" AS p, "touchesMappedMine" AS y FROM candidates WHERE "meanProbability" IS NOT NULL AND "touchesMappedMine" IS NOT NULL),
 k AS (SELECT p, count(*) AS n, count(*) FILTER (WHERE y) AS tp FROM s GROUP BY p),
 cu AS (SELECT p AS threshold, tp AS step, CAST(sum(n) OVER w AS BIGINT) AS n, CAST(sum(tp) OVER w AS BIGINT) AS tp, CAST(sum(tp) OVER () AS BIGINT) AS pos FROM k WINDOW w AS (ORDER BY p DESC)),
 pr AS (SELECT *, tp / n AS precision, tp / nullif(pos, 0) AS recall FROM cu)"""


def _curve(spark: SparkSession, d: str) -> DataFrame:
    return metrics.pr_curve(spark.read.parquet(f"{d}/candidates.parquet"), "meanProbability", "touchesMappedMine")


@query(f"{CURVE} SELECT threshold, precision, recall, tp, n FROM pr")
def pr_curve(spark, d):
    """[W4]"""
    return _curve(spark, d).select("threshold", "precision", "recall", "tp", "n")


@query(f"{CURVE} SELECT round(sum(precision * step) / max(pos), 9) AS ap FROM pr")
def average_precision(spark, d):
    """[A21]"""
    return metrics.average_precision(_curve(spark, d)).select(F.round("ap", 9).alias("ap"))


@query(f"{CURVE} SELECT threshold, precision, recall FROM pr ORDER BY CASE WHEN precision >= 0.3 THEN recall END DESC NULLS LAST, CASE WHEN precision < 0.3 THEN precision END DESC NULLS LAST, threshold LIMIT 1")
def threshold_for_precision(spark, d):
    """[A24]"""
    return metrics.threshold_for(_curve(spark, d), 0.3)


@query(f"{CURVE} SELECT max(precision) FILTER (WHERE recall >= 0.25) AS p_at_25, max(precision) FILTER (WHERE recall >= 0.5) AS p_at_50, max(precision) FILTER (WHERE recall >= 0.75) AS p_at_75 FROM pr")
def precision_at_recall(spark, d):
    """[A25]"""
    return metrics.precision_at_recall(_curve(spark, d), [0.25, 0.5, 0.75])


@query("""SELECT region, avg(CASE WHEN "touchesMappedMine" THEN 1.0 WHEN NOT "touchesMappedMine" THEN 0.0 END) AS positive_share,
 count(*) FILTER (WHERE "meanProbability" >= 0.5 AND "touchesMappedMine") / nullif(count(*) FILTER (WHERE "meanProbability" >= 0.5), 0) AS precision,
 count(*) FILTER (WHERE "meanProbability" >= 0.5 AND "touchesMappedMine") / nullif(count(*) FILTER (WHERE "touchesMappedMine"), 0) AS recall FROM candidates GROUP BY region""")
def precision_recall_at_threshold(spark, d):
    """[A22, A23]"""
    return metrics.at_threshold(spark.read.parquet(f"{d}/candidates.parquet"), "meanProbability", "touchesMappedMine", 0.5, ["region"])


# ---- learning

_KEYS = ["region", "year", "row", "col"]


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/features.parquet").where("y BETWEEN 0 AND 5").dropDuplicates(_KEYS)


@query("""WITH u AS (SELECT DISTINCT region, year, row, col, y FROM features WHERE y BETWEEN 0 AND 5)
SELECT region, CAST(y AS INTEGER) AS y, count(*) AS available, least(count(*), 20) AS drawn, least(count(*), 20) AS among FROM u GROUP BY region, y""")
def stratified_counts(spark, d):
    """[A20] per region and class: pixels there are, drawn ones, and different ones among them"""
    rows = spark.read.parquet(f"{d}/features.parquet").where("y BETWEEN 0 AND 5").select(*_KEYS, "y").distinct()
    drawn = stratified_sample(spark, d).groupBy("region", "y").agg(F.count("*").alias("drawn"), F.count_distinct("year", "row", "col").alias("among"))
    return rows.groupBy("region", "y").agg(F.count("*").alias("available")).join(drawn, ["region", "y"]).withColumn("y", F.col("y").cast("int"))


@query()
def stratified_sample(spark, d):
    """[A20, L1] at most 20 pixels per region and class"""
    rows = spark.read.parquet(f"{d}/features.parquet").where("y BETWEEN 0 AND 5").select(*_KEYS, "y").distinct()
    return learn.stratified_sample(rows, ["region", "y"], 20, _KEYS)


@query()
def isotonic_calibration(spark, d):
    """[L7]"""
    rows = spark.read.parquet(f"{d}/candidates.parquet").where('meanProbability IS NOT NULL AND touchesMappedMine IS NOT NULL').select(F.col("meanProbability").alias("p"), F.col("touchesMappedMine").alias("mining"), "cand_key")
    model = learn.calibrate(rows)
    return model.transform(rows).select("cand_key", "p", F.col("prediction").alias("calibrated"))


@query()
def leave_one_region_out(spark, d):
    """[L1, L3-L6, L8] each training region is scored by a forest of other regions only, held out in FOLDS groups, and the test
    regions by one of all training regions"""
    regions = spark.read.parquet(f"{d}/ml_regions.parquet").where("split IN ('train', 'test')").select(F.col("name").alias("region"), "split")
    return _evaluated(spark.read.parquet(f"{d}/features.parquet").dropDuplicates(_KEYS).join(F.broadcast(regions), "region"))


#: Groups of regions that are held out together; None holds out each region alone, at a model a region.
FOLDS = 5


def _evaluated(rows: DataFrame, most: int = 4000, fit=learn.fit_forest, folds: int | None = FOLDS) -> DataFrame:
    """(split, region, threshold, ap, positive_share, precision, recall, p_at_25, p_at_50, p_at_75) of every region, and with
    region NULL of each split's rows pooled. split is train for out-of-fold scores; the threshold is theirs for precision 0.75."""
    rows = stage(rows, "learn")
    train, pixels = rows.where("split = 'train' AND y BETWEEN 0 AND 5"), learn.scoring_set(rows)
    sizes = {r["region"]: r["count"] for r in pixels.where("split = 'train'").groupBy("region").count().collect()}  # one row a region
    sample = stage(learn.stratified_sample(train, ["region", "y"], most, _KEYS), "sample")
    scores = learn.out_of_fold(sample, pixels, learn.region_folds(sizes, folds), fit)
    model = fit(sample)
    kept = ["split", "region", "p", "mining"]
    scored = stage(scores.select(kept).unionByName(learn.mining_probability(pixels.where("split = 'test'"), model).select(kept)), "scored")
    threshold = metrics.threshold_for(metrics.pr_curve(scored.where("split = 'train'"), "p", "mining", ["split"]), 0.75, ["split"]).first()["threshold"]

    def report(by: list[str]) -> DataFrame:
        curve = metrics.pr_curve(scored, "p", "mining", by)
        return metrics.average_precision(curve, by).join(metrics.precision_at_recall(curve, [0.25, 0.5, 0.75], by), by).join(metrics.at_threshold(scored, "p", "mining", threshold, by), by)

    columns = ["split", "region", F.lit(threshold).alias("threshold"), "ap", "positive_share", "precision", "recall", "p_at_25", "p_at_50", "p_at_75"]
    return report(["split", "region"]).select(columns).unionByName(report(["split"]).withColumn("region", F.lit(None).cast("string")).select(columns))


# ---- candidates, reviews, documents

@query("""WITH r AS (SELECT * FROM reviews), a AS (SELECT "reviewId" AS id, arg_max("reviewId", rev_key) AS rid, arg_max(coalesce(decision, '-'), rev_key) AS dec FROM r WHERE "reviewId" IS NOT NULL GROUP BY 1),
 b AS (SELECT "runId" AS run, "candidateId" AS cand, arg_max(coalesce("reviewId", '-'), rev_key) AS rid, arg_max(coalesce(decision, '-'), rev_key) AS dec FROM r WHERE "runId" IS NOT NULL AND "candidateId" IS NOT NULL GROUP BY 1, 2)
SELECT c.cand_key, coalesce(a.rid, b.rid) AS linked, coalesce(a.dec, b.dec) AS decision FROM candidates c LEFT JOIN a ON c."reviewId" = a.id LEFT JOIN b ON c.run_id = b.run AND c.id = b.cand""")
def reviews_left_join(spark, d):
    """[J11]"""
    r = spark.read.parquet(f"{d}/reviews.parquet").withColumns({"ord": F.col("rev_key"), "decision": F.coalesce("decision", F.lit("-"))})
    by_run = r.withColumn("reviewId", F.col("reviewId"))
    out = records.link_reviews(spark.read.parquet(f"{d}/candidates.parquet"), by_run)
    return out.select("cand_key", F.when(F.col("decision").isNotNull(), F.coalesce("linked", F.lit("-"))).alias("linked"), "decision")


@query("""SELECT DISTINCT rev_key FROM reviews r WHERE r."reviewId" IN (SELECT "reviewId" FROM candidates WHERE "reviewId" IS NOT NULL)
 OR EXISTS (SELECT 1 FROM candidates c WHERE c.run_id = r."runId" AND c.id = r."candidateId")""")
def reviews_semi(spark, d):
    """[J12]"""
    return records.reviews_of_run(spark.read.parquet(f"{d}/reviews.parquet"), spark.read.parquet(f"{d}/candidates.parquet")).select("rev_key")


@query("""WITH ch AS (SELECT "reviewId" AS id, arg_max(coalesce(decision, '-'), rev_key) AS decision, max(rev_key) AS rev_key FROM reviews WHERE batch > 0 AND "reviewId" IS NOT NULL GROUP BY 1),
 st AS (SELECT "reviewId" AS id, coalesce(decision, '-') AS decision, rev_key FROM reviews WHERE batch = 0 AND "reviewId" IS NOT NULL)
SELECT id, decision, rev_key FROM st WHERE id NOT IN (SELECT id FROM ch) UNION ALL SELECT id, decision, rev_key FROM ch WHERE decision <> '-'""")
def review_upsert(spark, d):
    """[R1, R2] batches after the first change the store; a null decision deletes"""
    rows = spark.read.parquet(f"{d}/reviews.parquet").where("reviewId IS NOT NULL").select(F.col("reviewId").alias("id"), F.coalesce("decision", F.lit("-")).alias("decision"), "rev_key", "batch")
    return records.upsert(rows.where("batch = 0").drop("batch"), rows.where("batch > 0").drop("batch"), "id", "rev_key", F.col("decision") == "-")


@query("SELECT region, coalesce(decision, 'unreviewed') AS status, count(*) AS n FROM reviews GROUP BY ALL")
def decision_counts(spark, d):
    """[A30, R3]"""
    return spark.read.parquet(f"{d}/reviews.parquet").groupBy("region", F.coalesce("decision", F.lit("unreviewed")).alias("status")).agg(F.count("*").alias("n"))


#: Degrees, some 11 m: cells on which outlines are compared.
_CELL = 0.0001


@query(f"""{_rings_sql('SELECT rev_key AS k, CAST(geometry AS JSON) AS g FROM reviews WHERE "reviewId" IS NOT NULL AND json_valid(geometry)')},
 c AS (SELECT DISTINCT cand_key AS k, "ringsPx"[1] AS ring, lon, lat FROM candidates WHERE len("ringsPx") = 1 AND lon BETWEEN -180 AND 180 AND lat > -90 AND lat < 90),
 cs AS (SELECT k, lon, lat, ring, unnest(range(1, len(ring) + 1)) AS i FROM c), ce AS (SELECT k, lon, lat, ring[i][1] AS x0, ring[i][2] AS y0, ring[i % len(ring) + 1][1] AS x1, ring[i % len(ring) + 1][2] AS y1 FROM cs),
 cc AS (SELECT k, sum((x0 * y1 - x1 * y0) * (x0 + x1)) / (3 * sum(x0 * y1 - x1 * y0)) AS cx, sum((x0 * y1 - x1 * y0) * (y0 + y1)) / (3 * sum(x0 * y1 - x1 * y0)) AS cy FROM ce GROUP BY k),
 w AS (SELECT *, radians(1) * {crs.EARTH_R} AS deg FROM ce JOIN cc USING (k)),
 e AS (SELECT 'c' AS kind, k, lon + (x0 - cx) * 20 / (deg * cos(radians(lat))) AS x0, lat - (y0 - cy) * 20 / deg AS y0, lon + (x1 - cx) * 20 / (deg * cos(radians(lat))) AS x1, lat - (y1 - cy) * 20 / deg AS y1 FROM w
  UNION ALL SELECT 'r', a.k, a.x, a.y, b.x, b.y FROM points a JOIN points b ON a.k = b.k AND a.part = b.part AND a.nr = b.nr AND b.i = a.i + 1),
 er AS (SELECT *, unnest(range(CAST(floor(least(y0, y1) / {_CELL}) AS BIGINT), CAST(floor(greatest(y0, y1) / {_CELL}) AS BIGINT) + 1)) AS r FROM e),
 x AS (SELECT kind, k, r, (x1 - x0) * ((r + 0.5::DOUBLE) * {_CELL}::DOUBLE - y0) / (y1 - y0) + x0 AS x FROM er WHERE (y0 > (r + 0.5::DOUBLE) * {_CELL}::DOUBLE) <> (y1 > (r + 0.5::DOUBLE) * {_CELL}::DOUBLE)),
 o AS (SELECT kind, k, r, x, row_number() OVER (PARTITION BY kind, k, r ORDER BY x) AS n, lead(x) OVER (PARTITION BY kind, k, r ORDER BY x) AS nx FROM x),
 cell AS (SELECT DISTINCT kind, k, r, unnest(range(CAST(ceil(x / {_CELL}::DOUBLE - 0.5) AS BIGINT), CAST(ceil(nx / {_CELL}::DOUBLE - 0.5) AS BIGINT))) AS c FROM o WHERE n % 2 = 1),
 size AS (SELECT kind, k, count(*) AS n FROM cell GROUP BY ALL), s AS (SELECT a.k AS candidate, b.k AS review, count(*) AS n FROM cell a JOIN cell b ON a.kind = 'c' AND b.kind = 'r' AND a.r = b.r AND a.c = b.c GROUP BY ALL),
 q AS (SELECT candidate, review, s.n / (a.n + b.n - s.n) AS iou FROM s JOIN size a ON a.kind = 'c' AND a.k = candidate JOIN size b ON b.kind = 'r' AND b.k = review)
SELECT candidate, review, "reviewId", iou FROM q JOIN (SELECT DISTINCT rev_key, "reviewId" FROM reviews) ON rev_key = review WHERE iou >= 0.3 QUALIFY row_number() OVER (PARTITION BY candidate ORDER BY iou DESC, review DESC) = 1""")
def relink_iou(spark, d):
    """[J8, X15] each candidate's review of highest IoU, at least 0.3, later reviews (by rev_key) winning ties. Outlines in
    pixels are placed around the candidate's position."""
    runs = lambda df, key, shape: df.select(key, F.explode(G.runs_of(shape, _CELL, records.BAND)).alias("_k")).select(key, "_k.*").distinct()
    c = spark.read.parquet(f"{d}/candidates.parquet").select(F.col("cand_key").alias("candidate"), "ringsPx", "lon", "lat").distinct()
    r = spark.read.parquet(f"{d}/reviews.parquet").where("reviewId IS NOT NULL").select(F.col("rev_key").alias("review"), "reviewId", "geometry")
    reviewed = runs(r, "review", G.geojson_polygons(F.col("geometry"))).withColumn("ord", F.col("review"))
    links = records.relink(runs(c, "candidate", G.placed_outlines(F.col("ringsPx"), F.col("lon"), F.col("lat"))), reviewed)
    return links.join(r.select("review", "reviewId"), "review").select("candidate", "review", "reviewId", "iou")


@query('SELECT cand_key, "reviewId" FROM candidates WHERE "reviewId" IS NOT NULL AND "reviewId" NOT IN (SELECT "reviewId" FROM reviews WHERE "reviewId" IS NOT NULL)')
def dangling_reviews(spark, d):
    """[J10, J13, D1, D8] candidates that name a review that isn't there"""
    return records.missing_references(spark.read.parquet(f"{d}/candidates.parquet"), "reviewId", spark.read.parquet(f"{d}/reviews.parquet"), "reviewId").select("cand_key", "reviewId")


@query("""SELECT rec_id, slug, footprint."areaHa" AS footprint_ha, comparisons[1].change."vegetationToBareHa" AS bare_ha, comparisons[1].before.years[1] AS from_year, comparisons[1]."after".years[-1] AS to_year FROM analysis""")
def site_cards(spark, d):
    """[P33, P34]"""
    return records.site_card(spark.read.parquet(f"{d}/analysis.parquet"))


@query("""WITH a AS (SELECT rec_id, unnest(map_keys(forest.box."lossByYear")) AS year, forest FROM analysis)
SELECT rec_id, year, forest.box."lossByYear"[year] AS box_ha, coalesce(forest.footprint."lossByYear"[year], 0.0) AS footprint_ha FROM a""")
def loss_chart(spark, d):
    """[P37]"""
    return records.loss_series(spark.read.parquet(f"{d}/analysis.parquet"))


@query("SELECT min(bounds[1]) AS west, min(bounds[2]) AS south, max(bounds[3]) AS east, max(bounds[4]) AS north FROM analysis")
def overview_bounds(spark, d):
    """[A29]"""
    b = F.col("bounds")
    at = lambda i: F.try_element_at(b, F.lit(i))
    return spark.read.parquet(f"{d}/analysis.parquet").agg(F.min(at(1)).alias("west"), F.min(at(2)).alias("south"), F.max(at(3)).alias("east"), F.max(at(4)).alias("north"))


@query("""WITH c AS (SELECT rec_id, unnest(comparisons) AS c FROM analysis) SELECT rec_id, c.id AS id, CASE WHEN c.sensor = 'sentinel-2' THEN 'Sentinel-2' ELSE array_to_string(list_transform(c.before.platforms,
 lambda x: CASE x WHEN 'landsat-5' THEN 'Landsat 5' WHEN 'landsat-7' THEN 'Landsat 7' WHEN 'landsat-8' THEN 'Landsat 8' WHEN 'landsat-9' THEN 'Landsat 9' ELSE x END), ' / ') END AS label,
 CASE WHEN list_min(c.before.years) = list_max(c.before.years) THEN CAST(list_min(c.before.years) AS VARCHAR) ELSE CAST(list_min(c.before.years) AS VARCHAR) || '-' || CAST(list_max(c.before.years) AS VARCHAR) END AS years,
 len(c.before."sceneDates") AS dates FROM c WHERE c IS NOT NULL""")
def comparison_labels(spark, d):
    """[P29, P30, P35]"""
    c = spark.read.parquet(f"{d}/analysis.parquet").select("rec_id", F.explode("comparisons").alias("c")).where("c IS NOT NULL")
    return c.select("rec_id", "c.id", text.platform_label(F.col("c.sensor"), F.col("c.before.platforms")).alias("label"), text.year_label(F.col("c.before.years")).alias("years"), F.when(F.col("c.before.sceneDates").isNotNull(), F.size("c.before.sceneDates")).cast("bigint").alias("dates"))


@query("""WITH p AS (SELECT rec_id, unnest("protectedAreas") AS p FROM analysis) SELECT rec_id, p.id AS id, CASE WHEN p."footprintDistanceKm" IS NULL THEN NULL WHEN p."footprintDistanceKm" = 0 THEN 'inside'
 WHEN p."footprintDistanceKm" <= coalesce(p."bufferKm", 0) THEN 'within the buffer' ELSE 'beyond the buffer' END AS place FROM p WHERE p IS NOT NULL""")
def protected_place(spark, d):
    """[P38] and the distance sentences"""
    p = spark.read.parquet(f"{d}/analysis.parquet").select("rec_id", F.explode("protectedAreas").alias("p")).where("p IS NOT NULL")
    return p.select("rec_id", "p.id", text.distance_clause(F.col("p.footprintDistanceKm"), F.col("p.bufferKm")).alias("place"))


@query("SELECT name, coalesce(box_km, 6.0) AS box_km, coalesce(pixel_m, 20.0) AS pixel_m, coalesce(max_scene_cloud, 60.0) AS max_scene_cloud FROM ml_regions")
def config_defaults_merge(spark, d):
    """[P31, P31a]"""
    return records.merge_defaults(spark.read.parquet(f"{d}/ml_regions.parquet"), {"box_km": 6.0, "pixel_m": 20.0, "max_scene_cloud": 60.0}).select("name", "box_km", "pixel_m", "max_scene_cloud")


@query(f"WITH {L.SITES} SELECT island, count(*) AS sites, count(*) FILTER (WHERE lat > 12) AS northern FROM sites GROUP BY island")
def sites_by_group(spark, d):
    """[A33]"""
    return L.sites(spark, d).groupBy("island").agg(F.count("*").alias("sites"), F.count_if(F.col("lat") > 12).alias("northern"))


@query("SELECT doc_id, published, coalesce(regexp_matches(published, '^[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?$'), false) AS ok FROM documents")
def partial_dates(spark, d):
    """[D2]"""
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "published", F.coalesce(text.partial_date_ok(F.col("published")), F.lit(False)).alias("ok"))


@query()
def analysis_json(spark, d):
    """[K1, K2] documents as JSON, one comparison retitled"""
    from landchange.sources.sinks import as_document

    return as_document(records.retitle(spark.read.parquet(f"{d}/analysis.parquet"), {"sentinel-2-2017-2022": "Five years"}), "rec_id")


@query()
def protected_geojson(spark, d):
    """[K5] a feature collection per law"""
    from landchange.sources.sinks import feature, feature_collection

    areas = spark.read.parquet(f"{d}/protected_areas.parquet")
    return feature_collection(areas.select("law", feature(F.struct("id", "name", "kind"), F.col("geometry")).alias("f")), ["law"], "f")


@query()
def clear_counts_stream(spark, d):
    """Structured Streaming: clear views per pixel and day, run to the end of the given files"""
    import uuid

    from landchange.streaming.observations import clear_counts_by_window, observation_stream, run_once

    work = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    o = L.obs(spark, d).select("pixel", "ts", "qa")
    o.write.parquet(f"{work}/in")
    stream = observation_stream(spark, f"{work}/in", "pixel BIGINT, ts TIMESTAMP_NTZ, qa INT")
    run_once(clear_counts_by_window(stream, "pixel", "ts", "qa"), f"{work}/out", f"{work}/state")
    return spark.read.schema("pixel BIGINT, begin TIMESTAMP, views BIGINT, clear_views BIGINT").parquet(f"{work}/out")


@query("SELECT user_id AS pixel, CAST(ts AS DATE) AS day, count(*) AS views, count(*) FILTER (WHERE CAST(json_extract(props, '$.k') AS INTEGER) & 31 = 0) AS clear_views FROM events GROUP BY 1, 2")
def stream_days(spark, d):
    """The stream's counts by day, against one aggregate of all rows"""
    return clear_counts_stream(spark, d).select("pixel", F.col("begin").cast("date").alias("day"), "views", "clear_views")
