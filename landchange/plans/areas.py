"""Queries of the geometry operators over the given outlines, each beside the SQL that checks it. Ids of the survey in brackets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from landchange.operators import geometry as G
from landchange.operators.splitting import unions

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


#: Edges e (k, x0, y0, x1, y1), x0 < x1, of all rings of areas; and boxes b around the entries of ml_regions, in degrees.
_EDGES = """j AS (SELECT area_key AS k, law, CASE WHEN json_extract_string(CAST(geometry AS JSON), '$.type') = 'Feature' THEN json_extract(CAST(geometry AS JSON), '$.geometry') ELSE CAST(geometry AS JSON) END AS j
 FROM (SELECT DISTINCT area_key, law, geometry FROM protected_areas WHERE kind = 'area' AND geometry IS NOT NULL)),
p AS (SELECT k, law, 1 AS part, CAST(json_extract(j, '$.coordinates') AS DOUBLE[][][]) AS rings FROM j WHERE json_extract_string(j, '$.type') = 'Polygon' UNION ALL
 SELECT k, law, generate_subscripts(CAST(json_extract(j, '$.coordinates') AS JSON[]), 1), CAST(unnest(CAST(json_extract(j, '$.coordinates') AS JSON[])) AS DOUBLE[][][]) FROM j WHERE json_extract_string(j, '$.type') = 'MultiPolygon'),
r AS (SELECT k, law, part, generate_subscripts(rings, 1) AS nr, unnest(rings) AS ring FROM p), s AS (SELECT k, law, part, nr, ring, unnest(range(1, len(ring))) AS i FROM r),
e0 AS (SELECT k, law, part, nr, ring[i][1] AS xa, ring[i][2] AS ya, ring[i + 1][1] AS xb, ring[i + 1][2] AS yb FROM s),
e AS (SELECT k, law, part, nr, least(xa, xb) AS x0, CASE WHEN xa < xb THEN ya ELSE yb END AS y0, greatest(xa, xb) AS x1, CASE WHEN xa < xb THEN yb ELSE ya END AS y1 FROM e0 WHERE xa <> xb)"""
_BOXES = """b AS (SELECT DISTINCT name, lon - box_km / 2 / (111.195 * cos(radians(lat))) AS w, lat - box_km / 2 / 111.195 AS s, lon + box_km / 2 / (111.195 * cos(radians(lat))) AS e, lat + box_km / 2 / 111.195 AS n
 FROM ml_regions WHERE lon BETWEEN -180 AND 180 AND abs(lat) < 90 AND box_km > 0)"""


def _areas(spark: SparkSession, d: str) -> DataFrame:
    """area_key, law, edges and bounds of areas that have an outline."""
    a = spark.read.parquet(f"{d}/protected_areas.parquet").where("kind = 'area' AND area_key IS NOT NULL").select("area_key", "law", "geometry").distinct()
    every = lambda i: F.filter("edges", lambda _, at: at % 4 == i)
    made = a.select("area_key", "law", "geometry", G.outline_of(F.col("geometry")).alias("edges")).where("edges IS NOT NULL")
    return made.withColumns({"x0": F.array_min(every(0)), "y0": F.least(F.array_min(every(1)), F.array_min(every(3))), "x1": F.array_max(every(2)), "y1": F.greatest(F.array_max(every(1)), F.array_max(every(3)))})


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    r = spark.read.parquet(f"{d}/ml_regions.parquet").where("lon BETWEEN -180 AND 180 AND abs(lat) < 90 AND box_km > 0")
    h, w = F.col("box_km") / 2 / 111.195, F.col("box_km") / 2 / (111.195 * F.cos(F.radians("lat")))
    return r.select("name", (F.col("lon") - w).alias("west"), (F.col("lat") - h).alias("south"), (F.col("lon") + w).alias("east"), (F.col("lat") + h).alias("north")).distinct()


@query(f"""WITH {_EDGES}, {_BOXES}, bb AS (SELECT k, min(x0) AS x0, max(x1) AS x1, min(least(y0, y1)) AS y0, max(greatest(y0, y1)) AS y1 FROM e GROUP BY k),
c AS (SELECT k, name, b.w, b.s, b.e AS ee, b.n FROM bb JOIN b ON x0 < b.e AND x1 > b.w AND y0 < b.n AND y1 > b.s),
pe AS (SELECT k, name, 1 AS w, x0, y0, x1, y1 FROM c JOIN e USING (k) UNION ALL SELECT k, name, 2, c.w, c.s, c.ee, c.s FROM c UNION ALL SELECT k, name, 2, c.w, c.n, c.ee, c.n FROM c),
x AS (SELECT k, name, x0 AS x FROM pe UNION SELECT k, name, x1 FROM pe UNION SELECT k, name, x FROM
 (SELECT p.k, p.name, ((q.y0 - (q.y1 - q.y0) / (q.x1 - q.x0) * (q.x0 - p.x0)) - p.y0) / nullif((p.y1 - p.y0) / (p.x1 - p.x0) - (q.y1 - q.y0) / (q.x1 - q.x0), 0) + p.x0 AS x, greatest(p.x0, q.x0) AS lo, least(p.x1, q.x1) AS hi
  FROM pe p JOIN pe q ON p.k = q.k AND p.name = q.name AND p.x0 < q.x1 AND q.x0 < p.x1) WHERE x > lo AND x < hi),
sl AS (SELECT k, name, x AS l, lead(x) OVER (PARTITION BY k, name ORDER BY x) AS h FROM x),
y AS (SELECT sl.k, sl.name, l, h, w, y0 + (y1 - y0) * ((l + h) / 2 - x0) / (x1 - x0) AS y FROM sl JOIN pe ON pe.k = sl.k AND pe.name = sl.name AND x0 <= l AND x1 >= h),
iv AS (SELECT k, name, l, h, w, y AS lo, lead(y) OVER v AS hi, row_number() OVER v AS nr FROM y WINDOW v AS (PARTITION BY k, name, l, w ORDER BY y)), i AS (SELECT * FROM iv WHERE nr % 2 = 1),
ar AS (SELECT k, name, sum((h - l) * (hi - lo)) FILTER (WHERE w = 1) AS area, sum((h - l) * (hi - lo)) FILTER (WHERE w = 2) AS box FROM i GROUP BY k, name),
co AS (SELECT p.k, p.name, sum((p.h - p.l) * greatest(0, least(p.hi, q.hi) - greatest(p.lo, q.lo))) AS shared FROM i p JOIN i q ON p.k = q.k AND p.name = q.name AND p.l = q.l AND p.w = 1 AND q.w = 2 GROUP BY p.k, p.name)
SELECT name, k AS area_key, round(shared, 9) AS common, round(area + box - shared, 9) AS joint, round(area - shared, 9) AS outside FROM co JOIN ar USING (k, name) WHERE shared > 1e-12""")
def areas_in_boxes(spark, d):
    """[J6, J7, U6, X7] protected areas that reach into the boxes of ml_regions: common area, union and difference, in square degrees"""
    found = G.areas_in_boxes(_areas(spark, d), "area_key", _boxes(spark, d), "name").where("area_both > 1e-12")
    c = lambda x, n: F.round(x, 9).alias(n)
    return found.select("name", "area_key", c(F.col("area_both"), "common"), c(F.col("area_a") + F.col("area_b") - F.col("area_both"), "joint"), c(F.col("area_a") - F.col("area_both"), "outside"))


@query(f"""WITH {_EDGES}, {_BOXES}, a AS (SELECT k, xa AS x0, ya AS y0, xb AS x1, yb AS y1 FROM e0),
c AS (SELECT a.*, b.* FROM a JOIN b ON least(x0, x1) <= b.e AND greatest(x0, x1) >= b.w AND least(y0, y1) <= b.n AND greatest(y0, y1) >= b.s),
t AS (SELECT name, k, sqrt(pow(x1 - x0, 2) + pow(y1 - y0, 2)) AS len,
 greatest(0.0, CASE WHEN x1 > x0 THEN (w - x0) / (x1 - x0) WHEN x1 < x0 THEN (e - x0) / (x1 - x0) ELSE 0 END, CASE WHEN y1 > y0 THEN (s - y0) / (y1 - y0) WHEN y1 < y0 THEN (n - y0) / (y1 - y0) ELSE 0 END) AS t0,
 least(1.0, CASE WHEN x1 > x0 THEN (e - x0) / (x1 - x0) WHEN x1 < x0 THEN (w - x0) / (x1 - x0) ELSE 1 END, CASE WHEN y1 > y0 THEN (n - y0) / (y1 - y0) WHEN y1 < y0 THEN (s - y0) / (y1 - y0) ELSE 1 END) AS t1 FROM c)
SELECT name, k AS area_key, round(sum((t1 - t0) * len), 9) AS length, count(*) AS pieces FROM t WHERE t1 > t0 AND len > 0 GROUP BY ALL""")
def boundaries_in_boxes(spark, d):
    """[X9] length, in degrees, and pieces of the areas' boundaries inside the boxes"""
    a = spark.read.parquet(f"{d}/protected_areas.parquet").where("kind = 'area' AND area_key IS NOT NULL").select("area_key", "geometry").distinct()
    rings = a.select("area_key", F.explode(G.geojson_polygons(F.col("geometry"))).alias("polygon"))
    boxes = _boxes(spark, d)
    cells = lambda df, w, s, e, n: df.withColumn("_cx", F.explode(F.sequence(F.floor(w), F.floor(e)))).withColumn("_cy", F.explode(F.sequence(F.floor(s), F.floor(n))))
    ed = cells(G.edges(rings, ["area_key"], "polygon").withColumn("_id", F.monotonically_increasing_id()), F.least("x0", "x1"), F.least("y0", "y1"), F.greatest("x0", "x1"), F.greatest("y0", "y1"))
    met = ed.join(cells(boxes, F.col("west"), F.col("south"), F.col("east"), F.col("north")), ["_cx", "_cy"]).dropDuplicates(["_id", "name", "west", "south", "east", "north"])
    begin, end = G.in_box(F.col("west"), F.col("south"), F.col("east"), F.col("north"))
    length = F.sqrt(F.pow(F.col("x1") - F.col("x0"), F.lit(2)) + F.pow(F.col("y1") - F.col("y0"), F.lit(2)))
    part = met.select("name", "area_key", (end - begin).alias("share"), length.alias("len")).where("share > 0 AND len > 0")
    return part.groupBy("name", "area_key").agg(F.round(F.sum(F.col("share") * F.col("len")), 9).alias("length"), F.count("*").alias("pieces"))


@query(f"""WITH {_EDGES}, x AS (SELECT law, x0 AS x FROM e UNION SELECT law, x1 FROM e UNION SELECT law, x FROM
 (SELECT p.law, ((q.y0 - (q.y1 - q.y0) / (q.x1 - q.x0) * (q.x0 - p.x0)) - p.y0) / nullif((p.y1 - p.y0) / (p.x1 - p.x0) - (q.y1 - q.y0) / (q.x1 - q.x0), 0) + p.x0 AS x, greatest(p.x0, q.x0) AS lo, least(p.x1, q.x1) AS hi
  FROM e p JOIN e q ON p.law = q.law AND p.x0 < q.x1 AND q.x0 < p.x1) WHERE x > lo AND x < hi),
sl AS (SELECT law, x AS l, lead(x) OVER (PARTITION BY law ORDER BY x) AS h FROM x),
y AS (SELECT sl.law, l, h, k, part, y0 + (y1 - y0) * ((l + h) / 2 - x0) / (x1 - x0) AS y FROM sl JOIN e ON e.law = sl.law AND x0 <= l AND x1 >= h),
iv AS (SELECT law, l, h, y AS lo, lead(y) OVER v AS hi, row_number() OVER v AS nr FROM y WINDOW v AS (PARTITION BY law, l, k, part ORDER BY y)), i AS (SELECT * FROM iv WHERE nr % 2 = 1),
m AS (SELECT law, l, h, lo, hi, max(hi) OVER (PARTITION BY law, l ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i),
u AS (SELECT law, sum((h - l) * greatest(0, hi - greatest(lo, coalesce(reach, lo)))) AS area FROM m GROUP BY law), n AS (SELECT law, count(DISTINCT (k, part)) AS polygons FROM e GROUP BY law)
SELECT law, polygons, round(area, 9) AS area FROM u JOIN n USING (law) WHERE law IS NOT NULL""")
def united_areas(spark, d):
    """[A17, U6] per law: polygons of its areas and the area that any of them covers"""
    a = spark.read.parquet(f"{d}/protected_areas.parquet").where("kind = 'area' AND area_key IS NOT NULL AND law IS NOT NULL").select("area_key", "law", "geometry").distinct()
    return unions(a, "law", "geometry").withColumn("area", F.round("area", 9))


@query(f"""WITH {_EDGES}, n AS (SELECT *, row_number() OVER () AS id FROM e0), o AS (SELECT a.k, a.xa, a.ya, a.xb, a.yb, b.xa AS xc, b.ya AS yc, b.xb AS xd, b.yb AS yd FROM n a JOIN n b ON a.k = b.k AND a.id < b.id),
t AS (SELECT k, bool_or(((xb - xa) * (yc - ya) - (yb - ya) * (xc - xa)) * ((xb - xa) * (yd - ya) - (yb - ya) * (xd - xa)) < 0 AND ((xd - xc) * (ya - yc) - (yd - yc) * (xa - xc)) * ((xd - xc) * (yb - yc) - (yd - yc) * (xb - xc)) < 0) AS crossed FROM o GROUP BY k)
SELECT k AS area_key, crossed FROM t""")
def self_crossing(spark, d):
    """[X4, X11, D4] whether an area's boundary crosses itself"""
    a = spark.read.parquet(f"{d}/protected_areas.parquet").where("kind = 'area' AND area_key IS NOT NULL").select("area_key", "geometry").distinct()
    return a.select("area_key", G.self_crossing(F.col("geometry")).alias("crossed")).where("crossed IS NOT NULL")


@query("""WITH c AS (SELECT s_nationkey AS area_id, s_suppkey AS n, (117 + s_suppkey % 9) || '-' || (s_suppkey % 60) || '-' || (s_suppkey * 7 % 61) AS lon_dms, (5 + s_suppkey % 12) || '-' || (s_suppkey * 3 % 60) || '-' || (s_suppkey * 5 % 60) AS lat_dms FROM supplier)
SELECT area_id, n, CASE WHEN n % 10 = 3 THEN '121-0-30' ELSE lon_dms END AS lon_dms, CASE WHEN n % 10 = 7 THEN '12-30-0' ELSE lat_dms END AS lat_dms FROM c""")
def corner_corrections(spark, d):
    """[X12] corners read from suppliers, one axis of some of them corrected by number"""
    n = F.col("s_suppkey")
    dms = lambda a, b, c: F.concat_ws("-", a.cast("string"), b.cast("string"), c.cast("string"))
    corners = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_nationkey").alias("area_id"), n.alias("n"), dms(117 + n % 9, n % 60, n * 7 % 61).alias("lon_dms"), dms(5 + n % 12, n * 3 % 60, n * 5 % 60).alias("lat_dms"))
    fixes = corners.where("n % 10 IN (3, 7)").select("area_id", "n", F.when(F.col("n") % 10 == 3, "121-0-30").alias("longitude"), F.when(F.col("n") % 10 == 7, "12-30-0").alias("latitude"))
    return G.corrected(corners, fixes)


#: A shift of (-133, -77, -51) m from the Clarke 1866 ellipsoid to WGS84, written out for the check.
_E66, _E84 = "(1 - pow(6356583.8 / 6378206.4, 2))", "(2 / 298.257223563 - pow(1 / 298.257223563, 2))"
_ROUND = lambda i: f"p{i} AS (SELECT *, atan2(z + {_E84} * 6378137.0 / sqrt(1 - {_E84} * pow(sin(f{i - 1}), 2)) * sin(f{i - 1}), h) AS f{i} FROM p{i - 1})"


@query(f"""WITH k AS (SELECT s_suppkey AS site, radians((117 + (s_suppkey * 7 % 100) / 10.0)::DOUBLE) AS lam, radians((5 + (s_suppkey * 13 % 140) / 10.0)::DOUBLE) AS phi FROM supplier),
n AS (SELECT *, 6378206.4 / sqrt(1 - {_E66} * pow(sin(phi), 2)) AS nu FROM k),
c AS (SELECT site, nu * cos(phi) * cos(lam) - 133 AS x, nu * cos(phi) * sin(lam) - 77 AS y, nu * (1 - {_E66}) * sin(phi) - 51 AS z FROM n), q AS (SELECT *, sqrt(x * x + y * y) AS h FROM c),
p0 AS (SELECT *, atan2(z, h * (1 - {_E84})) AS f0 FROM q), {", ".join(map(_ROUND, range(1, 9)))}
SELECT site, round(degrees(atan2(y, x)), 9) AS lon, round(degrees(f8), 9) AS lat FROM p8""")
def datum_shift(spark, d):
    """[G9] Luzon 1911 to WGS84"""
    from landchange.functions import crs
    from landchange.plans import layers as L

    lon, lat = crs.luzon_to_wgs84(F.col("lon"), F.col("lat"))
    return L.sites(spark, d).select("site", F.round(lon, 9).alias("lon"), F.round(lat, 9).alias("lat"))


@query("""WITH s AS (SELECT s_suppkey AS site, (117 + (s_suppkey * 7 % 100) / 10.0)::DOUBLE AS lon, (5 + (s_suppkey * 13 % 140) / 10.0)::DOUBLE AS lat FROM supplier)
SELECT site, round((lon - 117) / 0.25, 9) AS col, round((20 - lat) / 0.25, 9) AS row FROM s""")
def world_to_pixel(spark, d):
    """[G6] fractional column and row on one lattice"""
    from landchange.functions import crs
    from landchange.plans import layers as L

    col, row = crs.to_pixel(F.col("lon"), F.col("lat"), F.lit(117.0), F.lit(20.0), F.lit(0.25))
    return L.sites(spark, d).select("site", F.round(col, 9).alias("col"), F.round(row, 9).alias("row"))
