"""Scenes, configuration, reviews and site pages as tables. Survey ids stand in brackets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def scene_search(scenes: DataFrame, years: list[int], months: tuple[int, int], max_cloud: float, platforms: list[str] | None = None) -> DataFrame:
    """[S2, S2a, U1, O1] scenes of the years' month windows under a cloud limit, with the year they were found for, in order of
    time (`datetime`, then `id` where there is one). A window ends on the first day of the month after, included. A month range that passes the turn of the year ends in
    the next year."""
    first, last = months
    rows = scenes.where(F.col("cloud") <= max_cloud)
    if platforms:
        rows = rows.where(F.col("platform").isin(platforms))
    day = F.col("datetime").cast("date")
    found = F.array(*(F.lit(y) for y in years))
    begin = lambda y: F.make_date(y, F.lit(first), F.lit(1))
    end = lambda y: F.add_months(F.make_date(y + (1 if last < first else 0), F.lit(last), F.lit(1)), 1)
    hits = F.filter(found, lambda y: (day >= begin(y)) & (day <= end(y)))
    return rows.withColumn("year", F.explode(hits)).orderBy("datetime", *(["id"] if "id" in scenes.columns else []), "year")


def merge_defaults(rows: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """[P31] a row's own value, else the default."""
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def radar_pairs(scenes: DataFrame, needed: list[str]) -> DataFrame:
    """[S6, U4] scenes that have all needed assets."""
    return scenes.where(F.size(F.array_except(F.array(*map(F.lit, needed)), "assets")) == 0)


def link_reviews(candidates: DataFrame, reviews: DataFrame) -> DataFrame:
    """[J11] candidates with their review: by reviewId, else by (runId, candidateId); the last of several counts.

    candidates: id, run_id, reviewId; reviews: reviewId, runId, candidateId, ord and the rest.
    """
    last = lambda keys: reviews.dropna(subset=keys).groupBy(*keys).agg(F.max_by(F.struct("reviewId", "decision"), "ord").alias("_r"))
    by_id = last(["reviewId"]).select(F.col("reviewId").alias("_id"), F.col("_r").alias("_by_id"))
    by_run = last(["runId", "candidateId"]).select(F.col("runId").alias("_run"), F.col("candidateId").alias("_cand"), F.col("_r").alias("_by_run"))
    joined = candidates.join(by_id, F.col("reviewId") == F.col("_id"), "left").join(by_run, (F.col("run_id") == F.col("_run")) & (F.col("id") == F.col("_cand")), "left")
    review = F.coalesce("_by_id", "_by_run")
    return joined.select(*candidates.columns, review["reviewId"].alias("linked"), review["decision"].alias("decision"))


def reviews_of_run(reviews: DataFrame, candidates: DataFrame) -> DataFrame:
    """[J12] reviews that a candidate links to, or that name its run and id: two semi joins instead of one with OR."""
    linked = reviews.join(candidates.select("reviewId"), "reviewId", "left_semi")
    named = reviews.join(candidates.select(F.col("run_id").alias("runId"), F.col("id").alias("candidateId")), ["runId", "candidateId"], "left_semi")
    return linked.select(reviews.columns).union(named.select(reviews.columns)).distinct()


def upsert(store: DataFrame, changes: DataFrame, key: str, order: str, delete: Column) -> DataFrame:
    """[R1, R2] the store after the changes: each key's last change replaces its row, or deletes it where `delete` holds."""
    last = changes.groupBy(key).agg(F.max_by(F.struct(*changes.columns), order).alias("_c")).select("_c.*")
    kept = store.join(last.select(key), key, "left_anti")
    return kept.select(store.columns).unionByName(last.where(~delete).select(store.columns))


#: Columns of a band of the lattice; a run of cells lies in one band.
BAND = 64


def relink(candidates: DataFrame, reviews: DataFrame, least: float = 0.3) -> DataFrame:
    """[J8, X15, C12] (candidate, review, iou) by cells on one lattice: each candidate's review of highest IoU, later reviews win
    ties. candidates: candidate, r, c0, c1; reviews: review, ord, r, c0, c1: runs of cells c0 <= c < c1 of row r that don't pass
    a multiple of BAND. Runs of one row and band meet in an equi-join, so an outline's rows count, not its cells."""
    band = lambda df: df.withColumn("_band", F.floor(F.col("c0") / BAND))
    size = lambda df, k: df.groupBy(k).agg(F.sum(F.col("c1") - F.col("c0")).alias(f"n_{k}"))
    p, q = band(candidates).alias("p"), band(reviews).alias("q")
    both = F.least("p.c1", "q.c1") - F.greatest("p.c0", "q.c0")
    shared = p.join(q, (F.col("p.r") == F.col("q.r")) & (F.col("p._band") == F.col("q._band")) & (both > 0)).groupBy("candidate", "review", "ord").agg(F.sum(both).alias("n"))
    scored = shared.join(size(candidates, "candidate"), "candidate").join(size(reviews, "review"), "review")
    iou = scored.withColumn("iou", F.col("n") / (F.col("n_candidate") + F.col("n_review") - F.col("n"))).where(F.col("iou") >= least)
    return iou.groupBy("candidate").agg(F.max_by(F.struct("review", "iou"), F.struct("iou", "ord")).alias("_b")).select("candidate", "_b.*")


def missing_references(rows: DataFrame, ref: str, known: DataFrame, key: str) -> DataFrame:
    """[J10, J13, J14, D1, D8] rows whose reference has no counterpart: a violated constraint."""
    return rows.where(F.col(ref).isNotNull()).join(known.select(F.col(key).alias(ref)).distinct(), ref, "left_anti")


def require_none(violations: DataFrame, what: str) -> None:
    """Fails, naming up to ten of the rows, where a constraint is violated."""
    bad = violations.limit(10).collect()
    if bad:
        raise ValueError(f"{what}: {[r.asDict() for r in bad]}")


def require_some(rows: DataFrame, what: str) -> DataFrame:
    """[D3] the rows; fails where there are none."""
    if not rows.limit(1).count():
        raise ValueError(f"no {what}")
    return rows


def require_known(names: list[str], known: DataFrame, key: str) -> None:
    """[D6] fails, naming them, where asked-for names aren't in a table."""
    have = {r[0] for r in known.where(F.col(key).isin(names)).select(key).distinct().collect()}  # at most as many as were asked for
    if missing := sorted(set(names) - have):
        raise ValueError(f"unknown {key}: {', '.join(missing)}")


def exactly_one(rows: DataFrame, what: str) -> dict:
    """[S15] the only row; fails where there is none or another."""
    found = rows.limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{what}: {'none' if not found else 'more than one'}")
    return found[0].asDict()


def protect(documents: DataFrame, protected: DataFrame, key: str) -> DataFrame:
    """[K3] documents with protectedAreas recomputed, from (key, sizePx, protectedAreas); all else, generatedAt too, stays. A
    document without a row keeps its own. Check `resized` first."""
    fresh = protected.select(F.col(key).alias("_key"), F.col("protectedAreas").alias("_fresh"), F.lit(True).alias("_there"))
    joined = documents.join(fresh, documents[key] == F.col("_key"), "left")
    return joined.withColumn("protectedAreas", F.when(F.col("_there"), F.col("_fresh")).otherwise(F.col("protectedAreas"))).select(documents.columns)


def resized(documents: DataFrame, protected: DataFrame, key: str) -> DataFrame:
    """[D5] keys whose grid no longer has the document's size: a violated constraint."""
    new = protected.select(key, F.col("sizePx").alias("_size"))
    return documents.select(key, "sizePx").join(new, key).where(~F.col("sizePx").eqNullSafe(F.col("_size"))).select(key)


def save_reviews(store: DataFrame, changes: DataFrame) -> DataFrame:
    """[R1, R2] the store after the changes, by reviewId. Columns: reviewId, rev_key (order) and the rest, decision, reason and note
    among them. A reason is kept with `reject` only, by default `other`; notes end after 2000 characters; a null decision
    deletes. A change without reviewId replaces the row of its runId and candidateId and keeps that row's reviewId."""
    known = store.where("reviewId IS NOT NULL AND runId IS NOT NULL AND candidateId IS NOT NULL").groupBy("runId", "candidateId").agg(F.min_by("reviewId", "rev_key").alias("_old"))
    named = changes.join(known, ["runId", "candidateId"], "left").withColumn("reviewId", F.coalesce("reviewId", "_old")).where("reviewId IS NOT NULL").select(changes.columns)
    clean = named.withColumns({"reason": F.when(F.col("decision") == "reject", F.coalesce("reason", F.lit("other"))), "note": F.left("note", F.lit(2000))})
    return upsert(store.where("reviewId IS NOT NULL"), clean, "reviewId", "rev_key", F.col("decision").isNull())


def numbered_sources(listed: DataFrame, page: str, source: str) -> DataFrame:
    """[J15] (page, source, number): a page's different sources, numbered from 1 in order of their text."""
    from pyspark.sql.window import Window

    return listed.where(F.col(source).isNotNull()).select(page, source).distinct().withColumn("number", F.row_number().over(Window.partitionBy(page).orderBy(source)))


def cited_numbers(citations: DataFrame, numbered: DataFrame, page: str, source: str) -> DataFrame:
    """[J15, O8] (page, numbers): the different numbers of a page's citations, ascending."""
    return citations.join(numbered, [page, source]).groupBy(page).agg(F.array_sort(F.collect_set("number")).alias("numbers"))


def retitle(documents: DataFrame, titles: dict[str, str]) -> DataFrame:
    """[K2] comparisons' titles by id; other fields, generatedAt too, stay."""
    names = F.create_map(*(F.lit(x) for kv in titles.items() for x in kv)) if titles else F.create_map().cast("map<string,string>")
    change = lambda c: F.when(c.isNotNull(), c.withField("title", F.coalesce(F.try_element_at(names, c["id"]), c["title"])))
    return documents.withColumn("comparisons", F.transform("comparisons", change))


def site_card(analysis: DataFrame) -> DataFrame:
    """[P33] slug, footprint area, first comparison's vegetation loss, first and last year."""
    first = F.try_element_at("comparisons", F.lit(1))
    years = lambda side, at: F.try_element_at(first[side]["years"], F.lit(at))
    return analysis.select("rec_id", "slug", F.col("footprint.areaHa").alias("footprint_ha"), first["change"]["vegetationToBareHa"].alias("bare_ha"), years("before", 1).alias("from_year"), years("after", -1).alias("to_year"))


def loss_series(analysis: DataFrame) -> DataFrame:
    """[P37] a row per record and year of the loss chart: box, footprint (0 where unknown)."""
    box = analysis.select("rec_id", F.explode("forest.box.lossByYear").alias("year", "box_ha"), F.col("forest.footprint.lossByYear").alias("_f"))
    return box.select("rec_id", "year", "box_ha", F.coalesce(F.try_element_at("_f", F.col("year")), F.lit(0.0)).alias("footprint_ha"))
