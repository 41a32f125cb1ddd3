"""Layers that the engine's queries run on, out of the given tables, and the same layers as SQL for the checks.

The tables hold no rasters: observations come from events (a pixel per user), a 50 x 50 lattice from lineitem, scenes from
orders, sites from supplier. All arithmetic is on integers, so both engines have the same layers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

OBS = """obs AS (SELECT event_id, user_id AS pixel, CAST(user_id // 15 AS INTEGER) AS r, CAST(user_id % 15 AS INTEGER) AS c,
 CAST(ts AS DATE) AS day, ts, CAST(json_extract(props, '$.k') AS INTEGER) AS qa, CAST(json_extract(props, '$.k') AS INTEGER) % 12 AS scl,
 (event_id * 37) % 10007 AS dn_b, (event_id * 53) % 10007 AS dn_g, (event_id * 71) % 10007 + 9000 AS dn_r, (event_id * 91) % 20011 + 9000 AS dn_n,
 value, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'before' ELSE 'after' END AS side FROM events)"""


def obs(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    side = F.when(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), "before").otherwise("after")
    dn = lambda m, p, a: ((F.col("event_id") * m) % p + a)
    return e.select(
        "event_id", F.col("user_id").alias("pixel"), F.floor(F.col("user_id") / 15).cast("int").alias("r"), (F.col("user_id") % 15).cast("int").alias("c"),
        F.col("ts").cast("date").alias("day"), "ts", k.alias("qa"), (k % 12).alias("scl"), dn(37, 10007, 0).alias("dn_b"), dn(53, 10007, 0).alias("dn_g"), dn(71, 10007, 9000).alias("dn_r"), dn(91, 20011, 9000).alias("dn_n"), "value", side.alias("side"),
    )


LATTICE = """lat AS (SELECT CAST(l_partkey % 50 AS INTEGER) AS r, CAST(l_suppkey % 50 AS INTEGER) AS c, avg(l_quantity) AS elevation,
 CAST(sum(l_linenumber) AS BIGINT) % 101 AS cover, CAST(sum(l_linenumber) AS BIGINT) % 8 AS loss, count(*) AS n, 50 AS height, 50 AS width
 FROM lineitem GROUP BY 1, 2)"""


def lattice(spark: SparkSession, d: str) -> DataFrame:
    t = spark.read.parquet(f"{d}/lineitem.parquet")
    lines = F.sum("l_linenumber").cast("bigint")
    grouped = t.groupBy((F.col("l_partkey") % 50).cast("int").alias("r"), (F.col("l_suppkey") % 50).cast("int").alias("c"))
    return grouped.agg(F.avg("l_quantity").alias("elevation"), (lines % 101).alias("cover"), (lines % 8).alias("loss"), F.count("*").alias("n")).withColumns({"height": F.lit(50), "width": F.lit(50)})


SCENES = """scenes AS (SELECT o_orderkey AS id, o_orderdate AS datetime, CAST(floor(o_totalprice) AS BIGINT) % 100 AS cloud,
 CASE o_orderkey % 3 WHEN 0 THEN 'landsat-5' WHEN 1 THEN 'landsat-7' ELSE 'landsat-8' END AS platform,
 CAST(o_custkey % 50 AS INTEGER) AS site, lpad(CAST(o_custkey % 6 AS VARCHAR), 2, '0') || '.00' AS baseline,
 DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) AS day FROM orders)"""


def scenes(spark: SparkSession, d: str) -> DataFrame:
    o = spark.read.parquet(f"{d}/orders.parquet")
    key = F.col("o_orderkey")
    return o.select(
        key.alias("id"), F.col("o_orderdate").alias("datetime"), (F.floor("o_totalprice") % 100).alias("cloud"), F.when(key % 3 == 0, "landsat-5").when(key % 3 == 1, "landsat-7").otherwise("landsat-8").alias("platform"),
        (F.col("o_custkey") % 50).cast("int").alias("site"), F.concat(F.lpad((F.col("o_custkey") % 6).cast("string"), 2, "0"), F.lit(".00")).alias("baseline"), F.date_add(F.lit("2024-01-01").cast("date"), (key % 30).cast("int")).alias("day"),
    )


SITES = """sites AS (SELECT s_suppkey AS site, s_name AS name, 117 + (s_suppkey * 7 % 100) / 10.0 AS lon, 5 + (s_suppkey * 13 % 140) / 10.0 AS lat,
 4 + s_suppkey % 9 AS box_km, n_name AS province, r_name AS island FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def sites(spark: SparkSession, d: str) -> DataFrame:
    s, n, r = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("supplier", "nation", "region"))
    k = F.col("s_suppkey")
    joined = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(k.alias("site"), F.col("s_name").alias("name"), (117 + (k * 7 % 100) / F.lit(10.0)).alias("lon"), (5 + (k * 13 % 140) / F.lit(10.0)).alias("lat"), (4 + k % 9).alias("box_km"), F.col("n_name").alias("province"), F.col("r_name").alias("island"))


#: Zones in lattice coordinates: a square with a hole, an L, a triangle.
ZONES = {
    "hole": [[(5, 5), (30, 5), (30, 30), (5, 30), (5, 5)], [(10, 10), (20, 10), (20, 20), (10, 20), (10, 10)]],
    "ell": [[(32, 2), (48, 2), (48, 8), (38, 8), (38, 20), (32, 20), (32, 2)]],
    "tri": [[(10, 35), (40, 35), (25, 49), (10, 35)]],
}
EDGES = "edges(zone, x0, y0, x1, y1) AS (VALUES " + ", ".join(f"('{z}', {a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for z, rings in ZONES.items() for ring in rings for a, b in zip(ring, ring[1:])) + ")"


def zones(spark: SparkSession) -> DataFrame:
    rows = [(z, [[(float(x), float(y)) for x, y in ring] for ring in rings]) for z, rings in ZONES.items()]
    return spark.createDataFrame(rows, "zone STRING, polygon ARRAY<ARRAY<STRUCT<x:DOUBLE,y:DOUBLE>>>")
