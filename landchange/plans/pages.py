"""Queries over records, pages, candidates and reviews, each beside the SQL that checks it. Ids of the survey stand in brackets."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from landchange.functions import pixels as P, text
from landchange.operators import geometry as G, learn, records
from landchange.operators.sequence import running_sum
from landchange.plans import engine, layers as L

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---- candidates and runs

@query("""WITH c AS (SELECT DISTINCT cand_key, "touchesMappedMine" AS t, "areaHa" * "meanProbability" AS v FROM candidates WHERE cand_key IS NOT NULL)
SELECT cand_key, row_number() OVER (ORDER BY coalesce(t, false), coalesce(v, 0) DESC, cand_key) AS place FROM c""")
def candidates_ordered(spark, d):
    """[O3, K6] not touching a mapped mine first, then by area times probability; missing ones count 0"""
    c = _t(spark, d, "candidates").where("cand_key IS NOT NULL").select("cand_key", F.coalesce("touchesMappedMine", F.lit(False)).alias("t"), F.coalesce(F.col("areaHa") * F.col("meanProbability"), F.lit(0.0)).alias("v")).distinct()
    return running_sum(c, [], [F.col("t"), F.col("v").desc(), F.col("cand_key")], None, "place").select("cand_key", "place")


@query("""WITH c AS (SELECT DISTINCT run_id, region, year, id, "reviewId" AS rid FROM candidates WHERE run_id IS NOT NULL),
r AS (SELECT DISTINCT "reviewId" AS rid FROM reviews WHERE "reviewId" IS NOT NULL), n AS (SELECT DISTINCT "runId" AS run_id, "candidateId" AS id FROM reviews WHERE "runId" IS NOT NULL AND "candidateId" IS NOT NULL)
SELECT c.run_id, count(DISTINCT c.id) AS candidates, count(DISTINCT c.id) FILTER (WHERE r.rid IS NOT NULL OR n.id IS NOT NULL) AS reviewed FROM c LEFT JOIN r ON c.rid = r.rid LEFT JOIN n ON c.run_id = n.run_id AND c.id = n.id GROUP BY c.run_id""")
def run_meta(spark, d):
    """[A32, K7] candidates of each run and how many of them have a review, by its id or by run and candidate"""
    c = _t(spark, d, "candidates").where("run_id IS NOT NULL").select("run_id", "id", "reviewId").distinct()
    r = _t(spark, d, "reviews")
    by_id = r.where("reviewId IS NOT NULL").select("reviewId", F.lit(True).alias("_a")).distinct()
    by_run = r.where("runId IS NOT NULL AND candidateId IS NOT NULL").select(F.col("runId").alias("run_id"), F.col("candidateId").alias("id"), F.lit(True).alias("_b")).distinct()
    seen = c.join(by_id, "reviewId", "left").join(by_run, ["run_id", "id"], "left").withColumn("_r", F.when(F.col("_a").isNotNull() | F.col("_b").isNotNull(), F.col("id")))
    return seen.groupBy("run_id").agg(F.count_distinct("id").alias("candidates"), F.count_distinct("_r").alias("reviewed"))


@query("""WITH r AS (SELECT DISTINCT run_id, region, year FROM candidates WHERE run_id IS NOT NULL AND region IS NOT NULL AND year IS NOT NULL)
SELECT run_id, region, year, row_number() OVER (PARTITION BY region ORDER BY year DESC, run_id) AS place FROM r""")
def runs_ordered(spark, d):
    """[O4, S21] a region's runs, newest year first"""
    r = _t(spark, d, "candidates").select("run_id", "region", "year").dropna().distinct()
    return running_sum(r, ["region"], [F.col("year").desc(), F.col("run_id")], None, "place")


@query("""SELECT rev_key, array_to_string(list_sort(list_distinct(list_filter(signs, lambda s: s IN ('colour', 'engineered-shapes', 'haul-road', 'cut-into-slope', 'stays-bare', 'near-mining', 'muddy-water-downstream')))), ' ') AS known FROM reviews""")
def known_signs(spark, d):
    """[U7] signs that are on the list"""
    # fixed values: the signs there are
    signs = ["colour", "engineered-shapes", "haul-road", "cut-into-slope", "stays-bare", "near-mining", "muddy-water-downstream"]
    both = F.array_join(F.array_sort(F.array_intersect(F.array_compact("signs"), F.array(*map(F.lit, signs)))), " ")
    return _t(spark, d, "reviews").select("rev_key", both.alias("known"))


@query("""WITH u AS (SELECT DISTINCT rev_key, batch, "reviewId" AS rid, "runId" AS run, "candidateId" AS cand, decision, reason, note FROM reviews),
st AS (SELECT * FROM u WHERE batch = 0), k AS (SELECT run, cand, arg_min(rid, rev_key) AS old FROM st WHERE rid IS NOT NULL AND run IS NOT NULL AND cand IS NOT NULL GROUP BY ALL),
ch AS (SELECT rev_key, coalesce(rid, old) AS rid, decision, CASE WHEN decision = 'reject' THEN coalesce(reason, 'other') END AS reason, left(note, 2000) AS note FROM u LEFT JOIN k ON u.run = k.run AND u.cand = k.cand WHERE batch > 0),
l AS (SELECT rid, max(rev_key) AS rev_key FROM ch WHERE rid IS NOT NULL GROUP BY rid)
SELECT rid AS "reviewId", rev_key, decision, reason, note FROM st WHERE rid IS NOT NULL AND rid NOT IN (SELECT rid FROM l)
UNION ALL SELECT ch.rid, ch.rev_key, decision, reason, note FROM ch JOIN l ON ch.rid = l.rid AND ch.rev_key = l.rev_key WHERE decision IS NOT NULL""")
def reviews_saved(spark, d):
    """[R1, R2] the store of batch 0 after the batches that follow"""
    r = _t(spark, d, "reviews").select("reviewId", "rev_key", "batch", "runId", "candidateId", "decision", "reason", "note").distinct()
    return records.save_reviews(r.where("batch = 0").drop("batch"), r.where("batch > 0").drop("batch")).select("reviewId", "rev_key", "decision", "reason", "note")


# ---- records

@query("""SELECT rec_id, center[1] AS lon, center[2] AS lat, bounds[1] AS west, bounds[2] AS south, bounds[3] AS east, bounds[4] AS north, footprint.geojson AS outline FROM analysis""")
def site_map(spark, d):
    """[P39] point, box and footprint of each record"""
    at = lambda c, i: F.try_element_at(F.col(c), F.lit(i))
    return _t(spark, d, "analysis").select("rec_id", at("center", 1).alias("lon"), at("center", 2).alias("lat"), *(at("bounds", i + 1).alias(n) for i, n in enumerate(("west", "south", "east", "north"))), F.col("footprint.geojson").alias("outline"))


@query("""WITH a AS (SELECT rec_id, comparisons, unnest("protectedAreas") AS p FROM analysis), c AS (SELECT rec_id, p, unnest(comparisons) AS c FROM a WHERE p IS NOT NULL)
SELECT rec_id, p.id AS area, c.id AS comparison, p.change[c.id]."insideHa" AS inside_ha, p.change[c.id]."bufferHa" AS buffer_ha FROM c WHERE c.id IS NOT NULL AND p.change[c.id] IS NOT NULL""")
def change_by_area(spark, d):
    """[J16] a protected area's change in each comparison of its record that it has one for"""
    a = _t(spark, d, "analysis").select("rec_id", "comparisons", F.explode("protectedAreas").alias("p")).where("p IS NOT NULL")
    both = a.select("rec_id", "p", F.explode("comparisons").alias("c")).where("c.id IS NOT NULL")
    found = both.withColumn("k", F.try_element_at(F.col("p.change"), F.col("c.id"))).where("k IS NOT NULL")
    return found.select("rec_id", F.col("p.id").alias("area"), F.col("c.id").alias("comparison"), F.col("k.insideHa").alias("inside_ha"), F.col("k.bufferHa").alias("buffer_ha"))


@query("""WITH c AS (SELECT rec_id, unnest(comparisons) AS c FROM analysis)
SELECT rec_id, c.id AS id, CASE WHEN c.change."insideFootprintHa" IS NULL THEN NULL WHEN c.change."insideFootprintHa" < 0.5 THEN 'almost none' ELSE CAST(round(c.change."insideFootprintHa") AS BIGINT) || ' ha' END AS inside,
 CAST(round(100 * c.before."clearFraction") AS BIGINT) AS clear_percent FROM c WHERE c IS NOT NULL""")
def inside_clauses(spark, d):
    """[P35, P36] hectares inside the footprint in words, and the share of clear pixels as a whole percent"""
    c = _t(spark, d, "analysis").select("rec_id", F.explode("comparisons").alias("c")).where("c IS NOT NULL")
    return c.select("rec_id", "c.id", text.hectares_or_none(F.col("c.change.insideFootprintHa")).alias("inside"), F.round(100 * F.col("c.before.clearFraction")).cast("bigint").alias("clear_percent"))


@query("""WITH c AS (SELECT rec_id, unnest(comparisons) AS c FROM analysis), s AS (SELECT rec_id, c.before AS s FROM c WHERE c IS NOT NULL UNION ALL SELECT rec_id, c."after" FROM c WHERE c IS NOT NULL),
n AS (SELECT rec_id, count(*) FILTER (WHERE s."sceneCount" <= 0) AS bad FROM s GROUP BY rec_id)
SELECT a.rec_id, coalesce(len(a.comparisons), 0) = 0 AS no_comparison, coalesce(n.bad, 0) AS bad_counts, coalesce(len(a."protectedAreas"), 0) AS areas FROM analysis a LEFT JOIN n USING (rec_id)""")
def record_faults(spark, d):
    """[D9] records without a comparison, sides whose scene count isn't positive; no list of protected areas is an empty one"""
    a = _t(spark, d, "analysis")
    sides = F.flatten(F.transform(F.filter("comparisons", lambda c: c.isNotNull()), lambda c: F.array(c["before"]["sceneCount"], c["after"]["sceneCount"])))
    bad = F.size(F.filter(F.coalesce(sides, F.array().cast("array<int>")), lambda n: n <= 0)).cast("bigint")
    size = lambda c: F.when(F.col(c).isNull(), 0).otherwise(F.size(c)).cast("bigint")
    return a.select("rec_id", (size("comparisons") == 0).alias("no_comparison"), bad.alias("bad_counts"), size("protectedAreas").alias("areas"))


_TITLES = {"sentinel-2-2017-2022": "Five years", "landsat-1990-2000": "A decade"}


@query("""WITH c AS (SELECT rec_id, generate_subscripts(comparisons, 1) - 1 AS i, unnest(comparisons) AS c FROM analysis)
SELECT rec_id, CAST(i AS INTEGER) AS i, c.id AS id, CASE c.id WHEN 'sentinel-2-2017-2022' THEN 'Five years' WHEN 'landsat-1990-2000' THEN 'A decade' ELSE c.title END AS title FROM c WHERE c IS NOT NULL""")
def retitled(spark, d):
    """[K2] titles of comparisons after a patch by id"""
    done = records.retitle(_t(spark, d, "analysis"), _TITLES)
    return done.select("rec_id", F.posexplode("comparisons").alias("i", "c")).where("c IS NOT NULL").select("rec_id", "i", "c.id", "c.title")


@query("""WITH c AS (SELECT rec_id, unnest(comparisons) AS c FROM analysis) SELECT DISTINCT c.id AS id FROM c WHERE c.id IS NOT NULL AND c.id NOT IN ('sentinel-2-2017-2022', 'landsat-1990-2000')""")
def unknown_titles(spark, d):
    """[J14, D5] ids of comparisons that a list of titles lacks"""
    ids = _t(spark, d, "analysis").select(F.explode("comparisons.id").alias("id"))
    return records.missing_references(ids, "id", spark.createDataFrame([(k,) for k in _TITLES], "known STRING"), "known").distinct()


@query("""SELECT rec_id, CAST(CASE WHEN footprint IS NOT NULL THEN 0 ELSE coalesce(len("protectedAreas"), -1) END AS INTEGER) AS areas, "generatedAt" IS NULL AS undated, false AS resized FROM analysis""")
def protect_patch(spark, d):
    """[K3, D5] protectedAreas of records with a footprint replaced by none, the rest as it was; no grid changed"""
    a = _t(spark, d, "analysis")
    fresh = a.where("footprint IS NOT NULL").select("rec_id", "sizePx", F.array().cast(a.schema["protectedAreas"].dataType).alias("protectedAreas"))
    changed = records.resized(a, fresh, "rec_id").withColumn("resized", F.lit(True))
    done = records.protect(a, fresh, "rec_id").join(changed, "rec_id", "left")
    return done.select("rec_id", F.when(F.col("protectedAreas").isNull(), -1).otherwise(F.size("protectedAreas")).alias("areas"), F.col("generatedAt").isNull().alias("undated"), F.coalesce("resized", F.lit(False)).alias("resized"))


# ---- pages

@query("""WITH l AS (SELECT slug, source, row_number() OVER (PARTITION BY slug ORDER BY source) AS number FROM (SELECT DISTINCT slug, source FROM documents WHERE slug IS NOT NULL AND source IS NOT NULL AND lang = 'en')),
c AS (SELECT DISTINCT slug, source FROM documents WHERE slug IS NOT NULL AND source IS NOT NULL AND lang IS DISTINCT FROM 'en')
SELECT slug, array_to_string(list_sort(list(DISTINCT number)), ',') AS numbers FROM c JOIN l USING (slug, source) GROUP BY slug""")
def citation_numbers(spark, d):
    """[J15, O8] a page lists its English documents' sources; its other documents cite them by number"""
    docs = _t(spark, d, "documents").where("slug IS NOT NULL AND source IS NOT NULL")
    numbered = records.numbered_sources(docs.where("lang = 'en'"), "slug", "source")
    cited = records.cited_numbers(docs.where("NOT lang <=> 'en'").select("slug", "source").distinct(), numbered, "slug", "source")
    return cited.select("slug", F.array_join(F.transform("numbers", lambda n: n.cast("string")), ",").alias("numbers"))


@query("""WITH l AS (SELECT slug, source FROM documents WHERE lang = 'en'), c AS (SELECT slug, source FROM documents WHERE lang IS DISTINCT FROM 'en')
SELECT slug, source FROM c WHERE slug IS NOT NULL AND source IS NOT NULL EXCEPT SELECT slug, source FROM l""")
def unlisted_citations(spark, d):
    """[D1, J13, U5] cited sources that a page doesn't list"""
    docs = _t(spark, d, "documents").where("slug IS NOT NULL AND source IS NOT NULL").select("slug", "source", "lang")
    return docs.where("NOT lang <=> 'en'").select("slug", "source").distinct().join(docs.where("lang = 'en'").select("slug", "source"), ["slug", "source"], "left_anti")


@query(f"WITH {L.SITES} SELECT site, name, CAST(row_number() OVER (ORDER BY name, site) AS BIGINT) AS place FROM sites")
def sites_by_name(spark, d):
    """[O5]"""
    return running_sum(L.sites(spark, d).select("site", "name"), [], [F.col("name"), F.col("site")], None, "place")


@query(f"WITH {L.SITES} SELECT site, lat::DOUBLE AS lat, CAST(row_number() OVER (ORDER BY lat DESC, site) AS BIGINT) AS place FROM sites WHERE island = 'ASIA'")
def range_sites(spark, d):
    """[O6] the sites of one range, from north to south"""
    return running_sum(L.sites(spark, d).where("island = 'ASIA'").select("site", "lat"), [], [F.col("lat").desc(), F.col("site")], None, "place")


# ---- settings and scans

@query("SELECT name, box_km, coalesce(pixel_m, 20.0) AS pixel_m, coalesce(max_scene_cloud, 60.0) AS max_scene_cloud, 1 AS month_from, 5 AS month_to FROM ml_regions WHERE box_km IS NOT NULL AND lon IS NOT NULL AND lat IS NOT NULL")
def region_settings(spark, d):
    """[P31a] a region's own pixel size and cloud limit, else the defaults; months are always those of the defaults; a region without
    centre or size is none"""
    r = _t(spark, d, "ml_regions").dropna(subset=["box_km", "lon", "lat"])
    merged = records.merge_defaults(r, {"pixel_m": 20.0, "max_scene_cloud": 60.0})
    return merged.select("name", "box_km", "pixel_m", "max_scene_cloud", F.lit(1).alias("month_from"), F.lit(5).alias("month_to"))


@query("SELECT name, split FROM ml_regions WHERE split = 'train' UNION ALL SELECT name, split FROM ml_regions WHERE split = 'test'")
def region_splits(spark, d):
    """[U2] training and test regions as one table"""
    r = _t(spark, d, "ml_regions").select("name", "split")
    return r.where("split = 'train'").unionByName(r.where("split = 'test'"))


@query(f"""WITH {L.SCENES} SELECT id, site, CAST(year(datetime) AS INTEGER) AS year FROM scenes JOIN (SELECT 1995 AS y UNION ALL SELECT 1996) ON CAST(datetime AS DATE) BETWEEN make_date(y, 1, 1) AND make_date(y, 6, 1) AND cloud <= 100 WHERE platform <> 'landsat-7'""")
def radar_scan(spark, d):
    """[S6, S6a, U4] scenes with both polarisations; a window ends with the first day after it"""
    assets = F.when(F.col("platform") == "landsat-7", F.array(F.lit("vv"))).otherwise(F.array(F.lit("vh"), F.lit("vv"), F.lit("angle")))
    dual = records.radar_pairs(L.scenes(spark, d).withColumn("assets", assets), ["vv", "vh"])
    return records.scene_search(dual, [1995, 1996], (1, 5), 100).select("id", "site", F.year("datetime").alias("year"))


@query(f"WITH {L.OBS} SELECT pixel, day, scl FROM obs WHERE year(day) BETWEEN 2019 AND 2024")
def cloud_record(spark, d):
    """[S3] the scene classes alone, by year, whatever the clouds"""
    return L.obs(spark, d).where(F.year("day").between(2019, 2024)).select("pixel", "day", "scl")


@query(f"WITH {L.LATTICE} SELECT r, c, n % 3 = 1 AS land, cover >= 30 AND loss > 0 AS lost FROM lat")
def masks_of_layers(spark, d):
    """[P19, S20] land where the data mask is 1, and the loss mask read back from its overlay's alpha"""
    lat = L.lattice(spark, d).withColumn("datamask", F.col("n") % 3)
    colour = P.loss_colour(P.counted_loss_year(F.col("loss"), F.col("cover")), 2001, 2025)
    return lat.select("r", "c", (F.col("datamask") == 1).alias("land"), (colour["a"] > 0).alias("lost"))


# ---- features and patches

@query(f"""SELECT region, count(*) AS pixels, count(*) FILTER (WHERE coalesce(inside, false)) AS mining FROM features WHERE {engine._OPEN} AND (coalesce(inside, false) OR NOT coalesce(near, false)) GROUP BY region""")
def scoring_set(spark, d):
    """[L5, A22] open pixels that count in an evaluation, and those inside a mine"""
    return learn.scoring_set(_t(spark, d, "features")).groupBy("region").agg(F.count("*").alias("pixels"), F.count_if("mining").alias("mining"))


_GAPS = " + ".join(f'CAST("{c}" IS NULL OR isnan("{c}") AS INTEGER)' for c in learn.MODEL_COLUMNS)


@query(f"SELECT region, year, row, col, CAST({_GAPS} AS INTEGER) AS missing, coalesce(\"{learn.MODEL_COLUMNS[0]}\", -999) AS first, coalesce(\"{learn.MODEL_COLUMNS[-1]}\", -999) AS last FROM features")
def model_matrix(spark, d):
    """[P32] the model's columns as one vector, in order, gaps as -999"""
    x = vector_to_array("x")
    return learn.assemble(_t(spark, d, "features")).select("region", "year", "row", "col", F.size(F.filter(x, lambda v: v == learn.MISSING)).alias("missing"), x[0].alias("first"), x[30].alias("last"))


@query(f"""WITH RECURSIVE {L.LATTICE}, f AS (SELECT r, c, r * 2147483648 + c AS id, cover, n FROM lat WHERE cover / 100.0 >= 0.45),
 t AS (SELECT a.id AS a, b.id AS b FROM f a JOIN f b ON {engine._EIGHT}), reach AS (SELECT id AS a, id AS b FROM f UNION SELECT reach.a, t.b FROM reach JOIN t ON reach.b = t.a),
 p AS (SELECT a AS id, CAST(min(b) AS BIGINT) AS patch FROM reach GROUP BY a)
SELECT patch, count(*) AS pixels, round(avg(cover / 200.0), 9)::DOUBLE AS mean_p, bool_or(n % 7 = 0) AS touches FROM f JOIN p USING (id) GROUP BY patch HAVING count(*) >= 3""")
def predicted_patches(spark, d):
    """[L9] flags by the raw score, mean of the calibrated one"""
    lat = L.lattice(spark, d).select("r", "c", (F.col("cover") / 100.0).alias("p"), (F.col("cover") / 200.0).alias("calibrated"), (F.col("n") % 7 == 0).alias("near"))
    return learn.flagged_patches(lat, [], 0.45, 3, tile=16).withColumn("mean_p", F.round("mean_p", 9))


@query(f"{engine._patch_sql(engine._EIGHT)} SELECT patch, CAST(count(*) AS DOUBLE) AS area FROM q GROUP BY patch")
def outline_areas(spark, d):
    """[X13] the area that a patch's outlines and holes bound: its pixels"""
    signed = F.transform("rings", lambda ring: F.aggregate(F.transform(G.ring_pairs(ring), lambda s: s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"]), F.lit(0.0), lambda a, v: a + v))
    return G.patch_outlines(engine._patched(spark, d, 8), []).select("patch", (F.abs(F.aggregate(signed, F.lit(0.0), lambda a, v: a + v)) / 2).alias("area"))


@query("SELECT 'hole' AS zone, 300.0::DOUBLE AS area UNION ALL SELECT 'ell', 120.0 UNION ALL SELECT 'tri', 0.0")
def clipped_zones(spark, d):
    """[X3] the zones' outer rings cut to the box from (10, 0) to (40, 20)"""
    box = F.struct(F.lit(10.0).alias("a"), F.lit(0.0).alias("b"), F.lit(40.0).alias("c"), F.lit(20.0).alias("d"))
    return L.zones(spark).select("zone", F.coalesce(G.ring_area(G.clipped(F.col("polygon")[0], box)), F.lit(0.0)).alias("area"))


@query("""WITH t AS (SELECT "meanProbability" AS p, count(*) AS n, count(*) FILTER (WHERE "touchesMappedMine") AS s FROM candidates WHERE "meanProbability" IS NOT NULL AND "touchesMappedMine" IS NOT NULL GROUP BY 1),
o AS (SELECT *, row_number() OVER (ORDER BY p) AS k, sum(n) OVER (ORDER BY p) AS cn, sum(s) OVER (ORDER BY p) AS cs FROM t),
m AS (SELECT a.k AS i, b.k AS j, (b.cs - a.cs + a.s)::DOUBLE / (b.cn - a.cn + a.n)::DOUBLE AS mean FROM o a JOIN o b ON a.k <= b.k),
w AS (SELECT i, j, min(mean) OVER (PARTITION BY i ORDER BY j DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS low FROM m)
SELECT p, round(max(low), 9) AS calibrated FROM w JOIN o ON o.k = w.j GROUP BY p""")
def calibration_curve(spark, d):
    """[L7] the calibrated probability of each score there is"""
    return engine.isotonic_calibration(spark, d).select("p", F.round("calibrated", 9).alias("calibrated")).distinct()
