"""Queries of the problems tagged llm, and SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from landchange.llm import dedup, mixing, ranking, sampling, splits, subjects, tokens

SCORES = ["areaHa", "meanProbability", "ndviThreeYearsEarlier"]
CLASSES = [0, 1, 2, 3, 4, 5]
PIXEL = ["region", "year", "row", "col"]
SPLIT_SHARES = {"train": 0.7, "validation": 0.15, "test": 0.15}


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p3_ranked(spark: SparkSession, d: str) -> DataFrame:
    """All candidates, best first; scores differ from run to run, so percentiles are taken within the run."""
    ranked = ranking.leximin_rank(_table(spark, d, "candidates"), "cand_key", SCORES, within=["run_id"])
    return ranked.select("cand_key", *(F.round(F.col("weakest")[i], 9).alias(f"weak_{i + 1}") for i in range(3)), "rank")


def _pixels(spark: SparkSession, d: str) -> DataFrame:
    return sampling.usable_rows(_table(spark, d, "features").select(*PIXEL, "y"), PIXEL, "y", CLASSES)


def _class_report(spark: SparkSession, d: str) -> DataFrame:
    return sampling.sample_report(_pixels(spark, d), _table(spark, d, "sample_targets"), "region", "y")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _class_report(spark, d).where("short").select("sample_id", F.col("category").alias("y"))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return _class_report(spark, d)


def p4_samples(spark: SparkSession, d: str) -> DataFrame:
    return sampling.draw(_pixels(spark, d), PIXEL, _table(spark, d, "sample_targets"), "region", "y")


def _grounds(spark: SparkSession, d: str) -> DataFrame:
    return splits.components(splits.same_ground(_table(spark, d, "ml_regions"), "name", "lon", "lat", "box_km"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.tied_pairs(_grounds(spark, d))


def p5_splits(spark: SparkSession, d: str) -> DataFrame:
    """Every entry's split, its ground and how many records it brings."""
    records = _table(spark, d, "features").groupBy("region").agg(F.count("*").alias("records"))
    entries = _grounds(spark, d).join(records, F.col("node") == F.col("region"), "left").select("node", "root", F.coalesce("records", F.lit(0)).alias("records"))
    grounds = entries.groupBy("root").agg(F.sum("records").alias("records"))
    dealt = splits.deal(grounds, "root", "records", SPLIT_SHARES)
    return entries.join(dealt, "root").select(F.col("node").alias("name"), F.col("root").alias("ground"), "records", "split")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return dedup.repeats_by_batch(_table(spark, d, "reviews"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(_table(spark, d, "documents"), "doc_id", "text")


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return tokens.token_counts(_table(spark, d, "documents").where("source IS NOT NULL"), "doc_id", "text", ["source"])


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Sources whose slots of the mix ask for more tokens than their blocks hold in max_repeats rounds."""
    from landchange.session import stage

    return mixing.fall_short(stage(_sizes(spark, d), "sizes"), "doc_id", _table(spark, d, "mix_targets")).select("mix_id", "source")


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    from landchange.session import stage

    return mixing.drawn_report(stage(_sizes(spark, d), "sizes"), "doc_id", _table(spark, d, "mix_targets"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    from landchange.session import stage

    return mixing.mix(stage(_sizes(spark, d), "sizes"), "doc_id", _table(spark, d, "mix_targets"))


def _subjects(spark: SparkSession, d: str) -> DataFrame:
    return subjects.classify(_table(spark, d, "documents"), _table(spark, d, "doc_subject_labels"), _table(spark, d, "subject_areas"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _subjects(spark, d).select("doc_id", "subject")


def p9_composition(spark: SparkSession, d: str) -> DataFrame:
    """Documents and sentences of each subject."""
    return _subjects(spark, d).groupBy("subject").agg(F.count("*").alias("documents"), F.sum("about").alias("sentences"))


QUERIES = {f.__name__: f for f in (p3_ranked, p4_found, p4_report, p4_samples, p5_found, p5_splits, p6_found, p7_ids, p8_found, p8_report, p8_mix, p9_found, p9_composition)}

ORACLE = {
    "p3_ranked": """
WITH c AS (SELECT DISTINCT cand_key, run_id, "areaHa" a, "meanProbability" p, "ndviThreeYearsEarlier" n FROM candidates WHERE cand_key IS NOT NULL),
l AS (SELECT cand_key, run_id, 1 s, a v FROM c UNION ALL SELECT cand_key, run_id, 2, p FROM c UNION ALL SELECT cand_key, run_id, 3, n FROM c),
m AS (SELECT *, (v IS NOT NULL AND NOT isnan(v)) ok FROM l),
q AS (SELECT cand_key, CASE WHEN ok THEN
  (rank() OVER (PARTITION BY run_id, s, ok ORDER BY v) - 1 + count(*) OVER (PARTITION BY run_id, s, ok, v) / 2.0)
  / count(*) OVER (PARTITION BY run_id, s, ok) ELSE 0.0 END pct FROM m),
v AS (SELECT cand_key, list_sort(list(pct)) w FROM q GROUP BY cand_key)
SELECT cand_key, round(w[1], 9) weak_1, round(w[2], 9) weak_2, round(w[3], 9) weak_3,
  row_number() OVER (ORDER BY round(w[1], 12) DESC, round(w[2], 12) DESC, round(w[3], 12) DESC, cand_key) AS rank FROM v""",
    "p4_found": """
WITH u AS (SELECT DISTINCT region, year, row, col, y FROM features WHERE y BETWEEN 0 AND 5),
s AS (SELECT t.sample_id, t.y, t.min_rows, t.sample_share, t.target_share,
  (SELECT count(*) FROM u WHERE (t.region IS NULL OR u.region = t.region)) usable,
  (SELECT count(*) FROM u WHERE (t.region IS NULL OR u.region = t.region) AND u.y = t.y) available FROM sample_targets t)
SELECT sample_id, CAST(y AS INTEGER) AS y FROM s WHERE available < greatest(min_rows, sample_share * target_share * usable)""",
    "p6_found": r"""
WITH RECURSIVE u AS (SELECT DISTINCT rev_key, batch, year, "reviewId" AS rid, geometry AS g FROM reviews WHERE rev_key IS NOT NULL AND batch IS NOT NULL),
n AS (SELECT rev_key AS k, year, row_number() OVER (ORDER BY batch, rev_key) AS pos, nullif(regexp_replace(regexp_replace(lower(rid), '^\s*urn:uuid:', ''), '[^\p{L}\p{N}]', '', 'g'), '') AS id,
 CASE WHEN json_valid(g) THEN CAST(g AS JSON) END AS j FROM u),
o AS (SELECT k, CASE WHEN json_extract_string(j, '$.type') = 'Feature' THEN json_extract(j, '$.geometry') WHEN json_extract_string(j, '$.type') = 'FeatureCollection' THEN json_extract(j, '$.features[0].geometry')
 WHEN json_extract_string(j, '$.type') = 'GeometryCollection' THEN json_extract(j, '$.geometries[0]') ELSE j END AS j FROM n WHERE year IS NOT NULL AND j IS NOT NULL),
p AS (SELECT k, CAST(json_extract(j, '$.coordinates') AS DOUBLE[][][]) AS rings FROM o WHERE json_extract_string(j, '$.type') = 'Polygon' UNION ALL
 SELECT k, CAST(unnest(CAST(json_extract(j, '$.coordinates') AS JSON[])) AS DOUBLE[][][]) FROM o WHERE json_extract_string(j, '$.type') = 'MultiPolygon'),
r AS (SELECT k, unnest(rings) AS ring FROM p), s AS (SELECT k, ring, unnest(range(1, len(ring) + 1)) AS i FROM r),
e0 AS (SELECT k, ring[i][1] AS xa, ring[i][2] AS ya, ring[i % len(ring) + 1][1] AS xb, ring[i % len(ring) + 1][2] AS yb FROM s),
e AS (SELECT k, least(xa, xb) AS x0, CASE WHEN xa < xb THEN ya ELSE yb END AS y0, greatest(xa, xb) AS x1, CASE WHEN xa < xb THEN yb ELSE ya END AS y1 FROM e0 WHERE xa <> xb),
b AS (SELECT k, any_value(year) AS year, any_value(pos) AS pos, min(x0) AS x0, min(least(y0, y1)) AS y0, max(x1) AS x1, max(greatest(y0, y1)) AS y1 FROM e JOIN n USING (k) GROUP BY k),
c AS (SELECT p.k AS a, q.k AS b FROM b p JOIN b q ON p.year = q.year AND p.pos < q.pos AND p.x0 < q.x1 AND q.x0 < p.x1 AND p.y0 < q.y1 AND q.y0 < p.y1),
pe AS (SELECT a, b, 1 AS w, e.* EXCLUDE k FROM c JOIN e ON k = a UNION ALL SELECT a, b, 2, e.* EXCLUDE k FROM c JOIN e ON k = b),
x AS (SELECT a, b, x0 AS x FROM pe UNION SELECT a, b, x1 FROM pe UNION
 SELECT a, b, x FROM (SELECT p.a, p.b, ((q.y0 - (q.y1 - q.y0) / (q.x1 - q.x0) * (q.x0 - p.x0)) - p.y0) / nullif((p.y1 - p.y0) / (p.x1 - p.x0) - (q.y1 - q.y0) / (q.x1 - q.x0), 0) + p.x0 AS x, greatest(p.x0, q.x0) AS lo, least(p.x1, q.x1) AS hi
  FROM pe p JOIN pe q ON p.a = q.a AND p.b = q.b AND p.x0 < q.x1 AND q.x0 < p.x1) WHERE x > lo AND x < hi),
sl AS (SELECT a, b, x AS l, lead(x) OVER (PARTITION BY a, b ORDER BY x) AS h FROM x),
y AS (SELECT sl.a, sl.b, l, h, w, y0 + (y1 - y0) * ((l + h) / 2 - x0) / (x1 - x0) AS y FROM sl JOIN pe ON pe.a = sl.a AND pe.b = sl.b AND x0 <= l AND x1 >= h),
iv AS (SELECT a, b, l, h, w, y AS lo, lead(y) OVER v AS hi, row_number() OVER v AS nr FROM y WINDOW v AS (PARTITION BY a, b, l, w ORDER BY y)), i AS (SELECT * FROM iv WHERE nr % 2 = 1),
ar AS (SELECT a, b, sum((h - l) * (hi - lo)) AS total FROM i GROUP BY a, b),
co AS (SELECT p.a, p.b, sum((p.h - p.l) * greatest(0, least(p.hi, q.hi) - greatest(p.lo, q.lo))) AS shared FROM i p JOIN i q ON p.a = q.a AND p.b = q.b AND p.l = q.l AND p.w = 1 AND q.w = 2 GROUP BY p.a, p.b),
t AS (SELECT a, b FROM co JOIN ar USING (a, b) WHERE shared >= 0.7 * (total - shared) UNION SELECT p.k, q.k FROM n p JOIN n q ON p.id = q.id AND p.pos < q.pos),
nb AS (SELECT q.pos, any_value(q.k) AS k, coalesce(list(t.a) FILTER (WHERE t.a IS NOT NULL), []) AS own FROM n q LEFT JOIN t ON q.k = t.b GROUP BY q.pos),
go AS (SELECT 0::BIGINT AS pos, []::BIGINT[] AS acc, NULL::BIGINT AS a, NULL::BIGINT AS b UNION ALL
 SELECT nb.pos, CASE WHEN len(list_intersect(own, acc)) = 0 THEN list_append(acc, nb.k) ELSE acc END, list_min(list_intersect(own, acc)), nb.k FROM go JOIN nb ON nb.pos = go.pos + 1)
SELECT a AS rev_key_a, b AS rev_key_b FROM go WHERE a IS NOT NULL""",
    "p5_found": """
WITH RECURSIVE e AS (SELECT name, lon, lat, box_km / 2 / 111.195 h, box_km / 2 / (111.195 * cos(radians(lat))) w,
  regexp_replace(strip_accents(lower(name)), '[^a-z0-9]', '', 'g') p FROM ml_regions),
ties AS (SELECT a.name a, b.name b FROM e a JOIN e b ON a.name <> b.name AND (a.p = b.p
  OR (abs(a.lon - b.lon) < a.w + b.w AND abs(a.lat - b.lat) < a.h + b.h))),
reach AS (SELECT a, b FROM ties UNION SELECT r.a, t.b FROM reach r JOIN ties t ON r.b = t.a)
SELECT a AS name_a, b AS name_b FROM reach WHERE a < b""",
}
