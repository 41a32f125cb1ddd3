"""Queries of the problems whose operators live in the core: nested records (p1) and points near points or regions (p2)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from landchange.operators.nested import ANALYSIS_TABLES, as_bodies, child_rows, flat_table, scalar_columns
from landchange.operators.spatial import close_pairs, points_in_regions
from landchange.types import analysis_schema

NEAR_METRES = 50.0
CHILDREN = ["comparison", "side", "scene", "footprint", "protected_area", "area_change"]


def _analysis_rows(spark: SparkSession, d: str, tables: list[str]) -> DataFrame:
    """Child rows of both analysis tables, through the triple stream and the pivot."""
    take = {t: ANALYSIS_TABLES[t] for t in tables}
    typed = as_bodies(spark.read.parquet(f"{d}/analysis.parquet"), "rec_id", take)
    raw = spark.read.parquet(f"{d}/analysis_raw.parquet").select("rec_id", "body")
    return child_rows(typed.unionByName(raw), "rec_id", "body", analysis_schema(), take)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _analysis_rows(spark, d, CHILDREN).select("rec_id", "child", "path")


def _analysis_table(spark: SparkSession, d: str, child: str, *others: str) -> DataFrame:
    """One flat table with all scalar fields; others: the tables above it and those that own fields below it."""
    return flat_table(_analysis_rows(spark, d, [child, *others]), "rec_id", child, scalar_columns(analysis_schema(), child))


def p1_comparisons(spark: SparkSession, d: str) -> DataFrame:
    return _analysis_table(spark, d, "comparison", "side")


def p1_sides(spark: SparkSession, d: str) -> DataFrame:
    return _analysis_table(spark, d, "side", "comparison", "scene", "year", "month", "platform", "scene_date")


def p1_scenes(spark: SparkSession, d: str) -> DataFrame:
    return _analysis_table(spark, d, "scene", "side")


def p1_years(spark: SparkSession, d: str) -> DataFrame:
    return _analysis_table(spark, d, "year", "side")


def p1_months(spark: SparkSession, d: str) -> DataFrame:
    return _analysis_table(spark, d, "month", "side")


def p1_platforms(spark: SparkSession, d: str) -> DataFrame:
    return _analysis_table(spark, d, "platform", "side")


def p1_scene_dates(spark: SparkSession, d: str) -> DataFrame:
    return _analysis_table(spark, d, "scene_date", "side")


def p1_protected_areas(spark: SparkSession, d: str) -> DataFrame:
    return _analysis_table(spark, d, "protected_area", "area_change")


def p1_area_changes(spark: SparkSession, d: str) -> DataFrame:
    return _analysis_table(spark, d, "area_change", "protected_area")


def p1_forest_losses(spark: SparkSession, d: str) -> DataFrame:
    return _analysis_table(spark, d, "forest_loss", "loss_year")


def p1_loss_years(spark: SparkSession, d: str) -> DataFrame:
    return _analysis_table(spark, d, "loss_year", "forest_loss")


def p1_footprints(spark: SparkSession, d: str) -> DataFrame:
    return _analysis_table(spark, d, "footprint")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    candidates = spark.read.parquet(f"{d}/candidates.parquet").select("cand_key", "year", "lon", "lat")
    areas = spark.read.parquet(f"{d}/protected_areas.parquet").where("kind = 'area'")
    near = close_pairs(candidates, "cand_key", "lon", "lat", NEAR_METRES, by=["year"])
    within = points_in_regions(candidates, "cand_key", "lon", "lat", areas, "area_key", "geometry")
    return near.select(F.col("key_a").alias("cand_key"), F.lit("candidate").alias("other_kind"), F.col("key_b").alias("other_key")).unionByName(
        within.select("cand_key", F.lit("area").alias("other_kind"), F.col("region").alias("other_key"))
    )


QUERIES = {f.__name__: f for f in (p1_found, p1_comparisons, p1_sides, p1_scenes, p1_years, p1_months, p1_platforms, p1_scene_dates, p1_protected_areas, p1_area_changes, p1_footprints, p1_forest_losses, p1_loss_years, p2_found)}

#: Brute-force SQL where it is quick on whole tables.
_TEXT = "CASE WHEN json_type({0}) = 'VARCHAR' AND json_valid({0} ->> '$') THEN CAST({0} ->> '$' AS JSON) ELSE {0} END"
_LIST = "CASE json_type({0}) WHEN 'ARRAY' THEN CAST({0} AS JSON[]) WHEN 'NULL' THEN [] ELSE [{0}] END"
_NAME = "CASE WHEN json_type({0} -> '{1}') <> 'NULL' THEN {0} -> '{1}' ELSE {0} -> '{2}' END"


def _snake(name: str) -> str:
    return re.sub("([A-Z])", lambda m: "_" + m[1].lower(), name)


def _parts_sql() -> str:
    """CTEs of all children by DuckDB's JSON functions; the nested table takes the way over JSON too."""
    named = lambda x, a, b: _NAME.format(x, a, b)
    return f"""
WITH t AS (SELECT rec_id, CASE WHEN starts_with(body, chr(65279)) THEN substr(body, 2) ELSE body END AS body FROM analysis_raw),
b AS (SELECT rec_id, to_json({{'comparisons': comparisons, 'footprint': footprint, 'protectedAreas': "protectedAreas", 'forest': forest}}) AS j FROM analysis
 UNION ALL SELECT rec_id, CAST(body AS JSON) FROM t WHERE json_valid(body)),
w AS (SELECT rec_id, CASE WHEN len(json_keys(j)) = 1 AND json_type(j -> ('$."' || json_keys(j)[1] || '"')) = 'OBJECT' THEN j -> ('$."' || json_keys(j)[1] || '"') ELSE j END AS j
 FROM b WHERE json_type(j) = 'OBJECT'),
f AS (SELECT rec_id, j -> 'comparisons' AS c, j -> 'footprint' AS f, {named("j", "protectedAreas", "protected_areas")} AS p, j -> 'forest' AS o FROM w),
g AS (SELECT rec_id, {_TEXT.format("c")} AS c, {_TEXT.format("f")} AS f, {_TEXT.format("p")} AS p, {_TEXT.format("o")} AS o FROM f),
l AS (SELECT rec_id, {_LIST.format("c")} AS c, f, {_LIST.format("p")} AS p, o FROM g),
c0 AS (SELECT rec_id, unnest(c) AS x, generate_subscripts(c, 1) - 1 AS i FROM l WHERE len(c) > 0),
c1 AS (SELECT rec_id, 'comparisons/' || i AS path, {_TEXT.format("x")} AS x FROM c0),
c2 AS (SELECT * FROM c1 WHERE json_type(x) = 'OBJECT'),
s0 AS (SELECT rec_id, path || '/before' AS path, x -> 'before' AS x FROM c2 UNION ALL SELECT rec_id, path || '/after', x -> 'after' FROM c2),
s1 AS (SELECT rec_id, path, {_TEXT.format("x")} AS x FROM s0), s2 AS (SELECT * FROM s1 WHERE json_type(x) = 'OBJECT'),
n0 AS (SELECT rec_id, path, {named("x", "sceneIds", "scene_ids")} AS x FROM s2), n1 AS (SELECT rec_id, path, {_TEXT.format("x")} AS x FROM n0),
n2 AS (SELECT rec_id, path, {_LIST.format("x")} AS x FROM n1),
n3 AS (SELECT rec_id, path || '/sceneIds/' || (generate_subscripts(x, 1) - 1) AS path, unnest(x) AS x FROM n2 WHERE len(x) > 0),
p0 AS (SELECT rec_id, unnest(p) AS x, generate_subscripts(p, 1) - 1 AS i FROM l WHERE len(p) > 0),
p1 AS (SELECT rec_id, 'protectedAreas/' || i AS path, {_TEXT.format("x")} AS x FROM p0), p2 AS (SELECT * FROM p1 WHERE json_type(x) = 'OBJECT'),
h0 AS (SELECT rec_id, path, x -> 'change' AS x FROM p2), h1 AS (SELECT rec_id, path, {_TEXT.format("x")} AS x FROM h0),
h2 AS (SELECT rec_id, path, x, unnest(json_keys(x)) AS k FROM h1 WHERE json_type(x) = 'OBJECT'),
h3 AS (SELECT rec_id, path || '/change/' || k AS path, x -> ('$."' || k || '"') AS x FROM h2), h4 AS (SELECT rec_id, path, {_TEXT.format("x")} AS x FROM h3),
q0 AS (SELECT rec_id, 'forest/box' AS path, o -> 'box' AS x FROM l WHERE json_type(o) = 'OBJECT' UNION ALL SELECT rec_id, 'forest/footprint', o -> 'footprint' FROM l WHERE json_type(o) = 'OBJECT'),
q1 AS (SELECT rec_id, path, {_TEXT.format("x")} AS x FROM q0), q2 AS (SELECT * FROM q1 WHERE json_type(x) = 'OBJECT'),
k0 AS (SELECT rec_id, path, {named("x", "lossByYear", "loss_by_year")} AS x FROM q2), k1 AS (SELECT rec_id, path, {_TEXT.format("x")} AS x FROM k0),
k2 AS (SELECT rec_id, path || '/lossByYear/' || k AS path, x -> ('$."' || k || '"') AS x FROM (SELECT rec_id, path, x, unnest(json_keys(x)) AS k FROM k1 WHERE json_type(x) = 'OBJECT'))"""


def _children_sql() -> str:
    return _parts_sql() + """
SELECT rec_id, 'comparison' AS child, path FROM c2 UNION ALL SELECT rec_id, 'side', path FROM s2 UNION ALL SELECT rec_id, 'scene', path FROM n3 WHERE json_type(x) <> 'NULL'
UNION ALL SELECT rec_id, 'footprint', 'footprint' FROM l WHERE json_type(f) = 'OBJECT' UNION ALL SELECT rec_id, 'protected_area', path FROM p2
UNION ALL SELECT rec_id, 'area_change', path FROM h4 WHERE json_type(x) = 'OBJECT'"""


#: Columns of the flat tables, written out so that the SQL stands on its own; v text, i whole numbers, d numbers.
COLUMNS = {
    "comparison": "id v, title v, sensor v, nativeResolutionM i, attribution v, change/ndviVegetated d, change/ndviBare d, change/comparableFraction d, change/vegetatedBeforeHa d, change/vegetationToBareHa d, change/insideFootprintHa d, change/overlay v,"
    " water/ndwiWater d, water/ndwiDry d, water/landToWaterHa d, water/waterToLandHa d, water/landToWaterInsideFootprintHa d, water/overlay v",
    "side": "platformLabel v, sceneCount i, clearFraction d, medianClearObservations d, image v, geotiff v",
    "footprint": "source v, citation v, url v, polygons i, areaHa d, svgPath v, geojson v",
    "protected_area": "id v, name v, short v, law v, url v, bufferKm d, areaSvgPath v, boundarySvgPath v, bufferSvgPath v, footprintDistanceKm d, footprintInsideHa d, footprintInBufferHa d",
    "area_change": "insideHa d, bufferHa d", "forest_loss": "areaHa d, treeCover2000Ha d, lossHa d", "loss_year": " d", "scene": " v", "year": " i", "month": " i", "platform": " v", "scene_date": " v",
}
FLAT = {"p1_comparisons": "comparison", "p1_sides": "side", "p1_scenes": "scene", "p1_years": "year", "p1_months": "month", "p1_platforms": "platform", "p1_scene_dates": "scene_date", "p1_protected_areas": "protected_area",
        "p1_area_changes": "area_change", "p1_footprints": "footprint", "p1_forest_losses": "forest_loss", "p1_loss_years": "loss_year"}


def _flat_sql(child: str) -> str:
    """A flat table: the child's values by name, as text tried as their types."""
    kinds = {"v": "VARCHAR", "i": "INTEGER", "d": "DOUBLE"}
    lists = {"scene": "sceneIds", "year": "years", "month": "months", "platform": "platforms", "scene_date": "sceneDates"}
    source, up = {
        "comparison": ("SELECT rec_id, path, x FROM c2", 2), "side": ("SELECT rec_id, path, x FROM s2", 1), "footprint": ("SELECT rec_id, 'footprint' AS path, f AS x FROM l WHERE json_type(f) = 'OBJECT'", 1),
        "protected_area": ("SELECT rec_id, path, x FROM p2", 2), "area_change": ("SELECT rec_id, path, x FROM h4 WHERE json_type(x) = 'OBJECT'", 2), "forest_loss": ("SELECT rec_id, path, x FROM q2", 2), "loss_year": ("SELECT rec_id, path, x FROM k2 WHERE json_type(x) <> 'NULL'", 2),
    }.get(child, ("", 2))
    if child in lists:
        name = lists[child]
        source = f"""SELECT * FROM (SELECT rec_id, path || '/{name}/' || (generate_subscripts(y, 1) - 1) AS path, unnest(y) AS x FROM (SELECT rec_id, path, {_LIST.format("y")} AS y FROM
 (SELECT rec_id, path, {_TEXT.format("y")} AS y FROM (SELECT rec_id, path, {_NAME.format("x", name, _snake(name))} AS y FROM s2))) WHERE len(y) > 0) WHERE json_type(x) <> 'NULL'"""
    cuts = "split(path, '/')"
    parent = "''" if child in ("comparison", "footprint", "protected_area", "forest_loss") else f"array_to_string({cuts}[:-{up + 1}], '/')"
    place = f"try_cast({cuts}[-1] AS INTEGER)" if child in lists or child in ("comparison", "protected_area") else "CAST(NULL AS INTEGER)"
    label = "CAST(NULL AS VARCHAR)" if child in lists or child in ("comparison", "protected_area") else f"{cuts}[-1]"

    def value(name: str) -> str:
        at = "x"
        for part in name.split("/") if name else []:
            at = f"({_NAME.format(at, part, _snake(part))})" if at == "x" else f"(SELECT {_NAME.format('i', part, _snake(part))} FROM (SELECT {_TEXT.format(at)} AS i))"
        return f"({at} ->> '$')"

    columns = ", ".join(f"try_cast({value(n)} AS {kinds[t]}) AS {re.sub(r'\W', '_', n) or 'value'}" for n, t in (c.strip(",").rsplit(" ", 1) for c in COLUMNS[child].replace(", ", ",|").split("|")))
    return f"{_parts_sql()}, o AS ({source}) SELECT rec_id, path, {parent} AS parent, {place} AS ordinal, {label} AS label, {columns} FROM o"


ORACLE = {name: _flat_sql(child) for name, child in FLAT.items()} | {
    "p1_found": _children_sql(),
    "p2_found": """
WITH c AS (SELECT DISTINCT cand_key, year, lon, lat FROM candidates WHERE lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90),
near AS (SELECT a.cand_key, 'candidate' AS other_kind, b.cand_key AS other_key FROM c a JOIN c b ON a.year = b.year AND a.cand_key < b.cand_key
 WHERE 2 * 6371007.2 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))) <= 50),
g AS (SELECT area_key, json_extract_string(geometry, '$.type') AS kind, json_extract(geometry, '$.coordinates') AS x FROM protected_areas WHERE kind = 'area'),
polygons AS (SELECT area_key, 0 AS part, CAST(x AS DOUBLE[][][]) AS rings FROM g WHERE kind = 'Polygon' UNION ALL
 SELECT area_key, generate_subscripts(CAST(x AS JSON[]), 1), CAST(unnest(CAST(x AS JSON[])) AS DOUBLE[][][]) FROM g WHERE kind = 'MultiPolygon'),
r AS (SELECT area_key, part, unnest(rings) AS ring FROM polygons),
i AS (SELECT area_key, part, ring, unnest(generate_series(1, len(ring) - 1)) AS i FROM r),
e AS (SELECT area_key, part, ring[i][1] AS x0, ring[i][2] AS y0, ring[i + 1][1] AS x1, ring[i + 1][2] AS y1 FROM i),
inside AS (SELECT cand_key, area_key, part FROM c JOIN e ON (e.y0 > c.lat) <> (e.y1 > c.lat) AND c.lon < (e.x1 - e.x0) * (c.lat - e.y0) / (e.y1 - e.y0) + e.x0
 GROUP BY ALL HAVING count(*) % 2 = 1)
SELECT * FROM near UNION ALL SELECT DISTINCT cand_key, 'area', area_key FROM inside""",
}
