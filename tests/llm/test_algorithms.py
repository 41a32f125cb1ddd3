"""Ranking, sampling, splits, dedup, mixing and subjects on small and odd tables, against brute force."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from landchange.llm import dedup as D, mixing as M, ranking as R, sampling as P, splits as S, subjects as U


# ---- ranking

def test_leximin(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice(["a", "b", None]), rnd.choice([None, float("nan"), 1.0, 2.0, 1e9]), rnd.random()) for i in range(120)]
    df = spark.createDataFrame([*rows, rows[0], (None, "a", 1.0, 1.0)], "k BIGINT, g STRING, x DOUBLE, y DOUBLE").withColumns({"percentile": F.lit(1), "rank": F.lit(2), "_k": F.lit(3)})
    bad = lambda v: v is None or math.isnan(v)

    def pct(i, j):
        own = [r[j] for r in rows if r[1] == rows[i][1] and not bad(r[j])]
        v = rows[i][j]
        return 0.0 if bad(v) else (sum(o < v for o in own) + sum(o == v for o in own) / 2) / len(own)

    vectors = {r[0]: sorted([pct(i, 2), pct(i, 3)]) for i, r in enumerate(rows)}
    expected = sorted(vectors, key=lambda k: ([-round(v, 12) for v in vectors[k]], k))
    got = R.leximin_rank(df, "k", ["x", "y"], ["g"]).orderBy("rank").collect()
    assert [r.k for r in got] == expected and [r["rank"] for r in got] == list(range(1, 121))
    assert R.leximin_rank(df.limit(0), "k", ["x", "y"], ["g"]).count() == 0


def test_weak_score_is_not_masked(spark):
    df = spark.createDataFrame([(1, 1e9, 0.0), (2, 5.0, 0.5), (3, 1.0, 0.9)], "k BIGINT, x DOUBLE, y DOUBLE")
    assert [r.k for r in R.leximin_rank(df, "k", ["x", "y"]).orderBy("rank").collect()][0] == 2


# ---- sampling

@pytest.mark.parametrize("seed", range(5))
def test_swap_repair(seed):
    rng = np.random.default_rng(seed)
    available, floor = rng.integers(0, 300, 6), rng.integers(0, 20, 6)
    share = rng.random(6)
    share /= share.sum()
    size = int(available.sum() * 0.4)
    counts = P.swap_repair(available, floor, share, size, seed)
    low = np.minimum(floor, available)
    assert counts.sum() == max(size, low.sum()) and (counts <= available).all() and (counts >= low).all()
    miss = lambda c: ((c - share * size) ** 2).sum()
    for a in range(6):  # no exchange of one record helps
        for b in range(6):
            if a != b and counts[a] > low[a] and counts[b] < available[b]:
                other = counts.copy()
                other[a], other[b] = other[a] - 1, other[b] + 1
                assert miss(other) >= miss(counts) - 1e-6


def test_hypergeometric_beyond_the_generators_range():
    rng = np.random.default_rng(1)
    for good, bad, n in ((3 * 10**9, 5 * 10**9, 10**9), (10**12, 10**10, 7 * 10**11), (10**9, 10**9, 500), (0, 10**10, 10**6), (10**10, 0, 10**6)):
        got = np.array([P.hypergeometric(rng, good, bad, n) for _ in range(40)])
        p = good / (good + bad)
        sd = math.sqrt(n * p * (1 - p) * (good + bad - n) / (good + bad - 1))
        assert (got >= 0).all() and (got <= min(good, n)).all() and abs(got.mean() - n * p) <= 4 * sd / math.sqrt(40) + 1e-9
        assert sd == 0 or 0.5 * sd < got.std() < 1.6 * sd


@pytest.mark.parametrize("most,buckets", [(0, 4096), (100_000, 2)])
def test_draw_is_exact_with_salts_and_with_few_buckets(spark, monkeypatch, most, buckets):
    monkeypatch.setattr(P, "MAX_TARGETS", most)
    monkeypatch.setattr(P, "DRAW_BUCKETS", buckets)
    rows = spark.range(900).select(F.when(F.col("id") < 600, "r").otherwise("s").alias("region"), "id", (F.col("id") % 3).cast("int").alias("y"))
    targets = spark.createDataFrame([(s, g, y, sh, 5, 0.4) for s, g in (("all", None), ("r", "r"), ("none", "x")) for y, sh in ((0, 0.6), (1, 0.3), (2, 0.1))], "sample_id STRING, region STRING, y INT, target_share DOUBLE, min_rows INT, sample_share DOUBLE")
    report = {(r.sample_id, r.category): r.drawn for r in P.sample_report(rows, targets, "region", "y").collect() if r.drawn}
    drawn = P.draw(rows, ["region", "id"], targets, "region", "y").collect()
    counts = {}
    for r in drawn:
        counts[r.sample_id, r.category] = counts.get((r.sample_id, r.category), 0) + 1
        assert r.id % 3 == r.category and (r.sample_id == "all" or r.region == r.sample_id)
    assert counts == report and len(set(drawn)) == len(drawn)


def test_sample_of_odd_rows(spark):
    rows = [("r", i, 0) for i in range(50)] + [("s", i, 1) for i in range(3)] + [("r", 1, 0)] * 3 + [("r", 90, None), ("r", 91, 9), (None, 1, 1)]
    df = spark.createDataFrame(rows, "region STRING, id BIGINT, y INT").withColumn("sample_id", F.lit("clash"))
    use = P.usable_rows(df, ["region", "id"], "y", [0, 1])
    assert use.count() == 54
    targets = spark.createDataFrame([("all", None, 0, 0.5, 1, 0.5), ("all", None, 1, 0.5, 1, 0.5), ("s", "s", 0, 0.5, 1, 1.0), ("s", "s", 1, 0.5, 1, 1.0), ("s", "s", 1, 0.5, 1, 1.0)], "sample_id STRING, region STRING, y INT, target_share DOUBLE, min_rows INT, sample_share DOUBLE")
    report = {(r.sample_id, r.category): r for r in P.sample_report(use, targets, "region", "y").collect()}
    assert {k for k, r in report.items() if r.short} == {("all", 1), ("s", 0)}
    assert report["all", 1].drawn == 4 and report["all", 0].drawn == 23
    drawn = P.draw(use, ["region", "id"], targets, "region", "y").collect()
    assert len(drawn) == len(set(drawn)) == sum(r.drawn for r in report.values())
    assert P.sample_report(use.limit(0), targets, "region", "y").where("short").count() == 4
    assert P.draw(use.limit(0), ["region", "id"], targets, "region", "y").count() == 0
    assert P.sample_report(use, targets.limit(0), "region", "y").count() == 0


# ---- splits

def union_find(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for link in links for x in link}


@pytest.mark.parametrize("most", [1_000_000, 10])
def test_components(spark, monkeypatch, most):
    monkeypatch.setattr(S, "MERGE_LINKS", most)
    rnd = random.Random(most)
    links = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(500, 560)]
    df = spark.createDataFrame([*links, (None, 1), (2, None)], "a BIGINT, b BIGINT")
    assert {r.node: r.root for r in S.components(df).collect()} == union_find(links)
    assert S.components(df.limit(0)).count() == 0


def test_same_ground(spark):
    rows = [("Ábc-1", None, None, None), ("abc 1", 0.0, 0.0, 10.0), ("far", 1.0, 0.0, 10.0), ("near", 0.08, 0.0, 10.0), ("!!", None, None, None), ("??", 9.0, 95.0, 1.0), ("east", 179.99, 0.0, 10.0), ("west", -179.99, 0.0, 10.0), (None, 0.0, 0.0, 10.0), ("nil", 0.0, 0.0, 0.0)]
    df = spark.createDataFrame([*rows, rows[1]], "name STRING, x DOUBLE, y DOUBLE, s DOUBLE").withColumn("n", F.lit("clash"))
    pairs = {(r.name_a, r.name_b) for r in S.tied_pairs(S.components(S.same_ground(df, "name", "x", "y", "s"))).collect()}
    assert pairs == {("abc 1", "Ábc-1"), ("abc 1", "near"), ("near", "Ábc-1"), ("east", "west")}


def one_by_one(sizes, goal):
    gaps, held = list(goal), [0] * len(goal)
    for n in sorted(sizes, reverse=True):
        to = max(range(len(gaps)), key=lambda j: gaps[j])
        gaps[to] -= n
        held[to] += 1
    return held, gaps


@pytest.mark.parametrize("seed", range(30))
def test_a_class_is_dealt_as_one_by_one(seed):
    rng = np.random.default_rng(seed)
    gaps, size, count = rng.uniform(-50, 200, rng.integers(1, 6)), int(rng.integers(1, 20)), int(rng.integers(0, 60))
    assert S.deal_class(gaps, size, count).tolist() == one_by_one([size] * count, gaps)[0]
    assert S.deal_class(gaps, 10, 10**12).sum() == 10**12 and S.deal_class(gaps, 0, 5).max() == 5


def test_deal(spark):
    sizes = [1 + i % 5 for i in range(400)] + [300, 0]
    groups = spark.createDataFrame([(f"g{i}", n or None) for i, n in enumerate(sizes)] + [(None, 7)], "k STRING, n BIGINT")
    rows = S.deal(groups, "k", "n", {"train": 0.8, "test": 0.2}).join(groups, "k").groupBy("split").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()
    counts, gaps = one_by_one(sizes, [1200, 300])
    assert {r.split: (r.k, r.n) for r in rows} == {"train": (counts[0], 1200 - gaps[0]), "test": (counts[1], 300 - gaps[1])}
    assert S.deal(groups.limit(0), "k", "n", {"a": 1.0}).count() == 0


@pytest.mark.parametrize("parts", ["1", "4", "64", "200"])
def test_partitions_without_links(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame([("b", "a"), ("b", "c")], "a STRING, b STRING")
        assert {(r.node, r.root) for r in S.components(df).collect()} == {("a", "a"), ("b", "a"), ("c", "a")}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_same_ground_equals_all_pairs(spark):
    rnd = random.Random(5)
    rows = [(f"n{i:03}", rnd.choice([rnd.uniform(-1, 1), rnd.uniform(179, 180), rnd.uniform(-180, -179)]), rnd.choice([rnd.uniform(-1, 1), rnd.uniform(88, 89.9), 60.0]), rnd.choice([0.5, 3.0, 40.0, 200.0]) * rnd.uniform(0.5, 1.5)) for i in range(250)]
    rows += [(f"m{i:03}", 50 + i * 1e-4, 10.0, 5.0) for i in range(60)]  # a crowd of boxes that all overlap
    links = [(a[0], a[0]) for a in rows]
    for i, a in enumerate(rows):
        for b in rows[:i]:
            w = [min(180, r[3] / 2 / 111.195 / math.cos(math.radians(r[2]))) for r in (a, b)]
            apart = abs(a[1] - b[1])
            if min(apart, 360 - apart) < sum(w) and abs(a[2] - b[2]) < (a[3] + b[3]) / 2 / 111.195:
                links.append((a[0], b[0]))
    df = spark.createDataFrame(rows, "name STRING, x DOUBLE, y DOUBLE, s DOUBLE")
    ground = S.same_ground(df, "name", "x", "y", "s")
    assert {r.node: r.root for r in S.components(ground).collect()} == union_find(links)
    assert ground.count() < 2 * len(links)


# ---- dedup

def square(x, y, w, h=None):
    h = h or w
    return json.dumps({"type": "Polygon", "coordinates": [[[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]]]})


def test_areas():
    a, b = D.outline_edges(square(0, 0, 2)), D.outline_edges(square(1, 1, 2))
    assert D.areas(a, b) == pytest.approx((4, 4, 1))
    star = D.outline_edges(json.dumps({"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], [[1, 1], [3, 1], [3, 3], [1, 3], [1, 1]]]}))
    assert D.areas(star, a) == pytest.approx((12, 4, 3))
    rng = np.random.default_rng(0)
    for _ in range(20):  # against points thrown at random
        rings = []
        for _ in range(2):
            t = np.sort(rng.uniform(0, 2 * np.pi, 9))
            p = np.c_[np.cos(t), np.sin(t)] * rng.uniform(0.3, 1, (9, 1))
            rings.append([*p.tolist(), p[0].tolist()])
        e = [D.outline_edges(json.dumps({"type": "Polygon", "coordinates": [r]})) for r in rings]
        pts = rng.uniform(-1, 1, (40_000, 2))
        hit = [((pts[:, None, 0] >= x[:, 0]) & (pts[:, None, 0] < x[:, 2]) & (x[:, 1] + (pts[:, None, 0] - x[:, 0]) * (x[:, 3] - x[:, 1]) / (x[:, 2] - x[:, 0]) <= pts[:, None, 1])).sum(1) % 2 == 1 for x in e]
        assert D.areas(*e) == pytest.approx((4 * hit[0].mean(), 4 * hit[1].mean(), 4 * (hit[0] & hit[1]).mean()), abs=0.05)


def sequential(rows):
    accepted, out = [], set()
    for key, batch, rid, year, geometry in sorted(set(rows), key=lambda r: (r[1], r[0])):
        rid = None if rid is None else "".join(c for c in rid.lower().replace("urn:uuid:", "") if c.isalnum()) or None
        e = D.outline_edges(geometry) if year is not None else np.zeros((0, 4))
        for k, r, y, f in accepted:
            a, b, both = D.areas(e, f) if y == year and len(e) and len(f) else (1, 1, 0)
            if (rid and r == rid) or both >= 0.7 * (a + b - both):
                out.add((k, key))
                break
        else:
            accepted.append((key, rid, year, e))
    return out


@pytest.mark.parametrize("cell,local", [(64, 200_000), (2, 200_000), (3, 0)])
def test_batches_equal_one_by_one(spark, monkeypatch, cell, local):
    monkeypatch.setattr(D, "FIRST_OF_CELL", cell)
    monkeypatch.setattr(D, "LOCAL_ROWS", local)
    rnd = random.Random(4)
    ids = ["ab-1", "AB1", "{ab-1}", "urn:uuid:ab-1", "zz", "-", "", None] + [f"id{i}" for i in range(30)]
    shapes = [None, "{", '{"type":"Point","coordinates":[1,2]}', square(5, 5, 0)]
    shapes += [square(10 + 0.02 * i, 0, 0.1) for i in range(20)]  # a chain: each like the next, not like all
    shapes += [square(10, 5, 0.1, 0.1 * (1 + i / 10)) for i in range(8)] + [square(0, 0, 0.001 * 1.3**i) for i in range(20)]
    rows = [(i, i // 50, rnd.choice(ids), rnd.choice([2020, 2020, 2021, None]), rnd.choice(shapes)) for i in range(150)]
    rows += [(200 + i, 3, "hot", 2022, square(40, 0, 1)) for i in range(60)]
    df = spark.createDataFrame([*rows, rows[3], (None, 1, "x", 2020, None)], "rev_key BIGINT, batch INT, reviewId STRING, year INT, geometry STRING").withColumns({"first": F.lit(1), "cls": F.lit("clash")})
    got = [(r.rev_key_a, r.rev_key_b) for r in D.repeats_by_batch(df).collect()]
    assert len(got) == len(set(got)) and set(got) == sequential(rows)
    assert D.repeats_by_batch(df.limit(0)).count() == 0


def test_cells_hold_every_part():
    sliver = json.dumps({"type": "Polygon", "coordinates": [[[0, 0], [1, 1], [1.0000001, 1], [0.0000001, 0], [0, 0]]]})
    for text in (sliver, square(0.3, 0.3, 0.01, 5), square(-7, 3, 2), json.dumps({"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]], [[[900, 900], [901, 900], [901, 901], [900, 900]]]]})):
        e = D.all_edges(text)
        area = D.areas(D.bounding_edges(e), np.zeros((0, 4)))[0]
        for level in D.levels_of(np.array([area])):
            _, cx, cy = D.cells_met(e, np.zeros(len(e), np.int64), level)
            side = 2.0 ** level[0]
            held = sum(D.areas(D.bounding_edges(e), D.outline_edges(square(x * side, y * side, side)))[2] for x, y in zip(cx, cy))
            length = np.hypot(e[:, 2] - e[:, 0], e[:, 3] - e[:, 1]).sum()
            assert held == pytest.approx(area, rel=1e-6) and len(cx) <= 3 * length / side + 4 * len(e)


def test_history_is_opened_with_its_own_buckets(spark, tmp_path):
    rows = [(i, 0, f"id{i}", 2020, square(i, 0, 0.5)) for i in range(60)] + [(100 + i, 1, f"ID-{i}", 2020, None) for i in range(60)] + [(200 + i, 2, None, 2020, square(i + 0.001, 0, 0.5)) for i in range(60)]
    read = D.with_heads(D.read_reviews(spark.createDataFrame(rows, "rev_key BIGINT, batch INT, reviewId STRING, year INT, geometry STRING")))
    first = D.History(spark, str(tmp_path / "h"), buckets=8)
    assert first.check(read.where("batch = 0")).count() == 0
    first.close()
    with pytest.raises(ValueError):
        D.History(spark, str(tmp_path / "h"), buckets=3)
    with pytest.raises(ValueError):
        D.History(spark, str(tmp_path / "h"), least=0.9)
    again = D.History(spark, str(tmp_path / "h"))
    assert again.buckets == 8 and {tuple(r) for r in again.check(read.where("batch = 1")).collect()} == {(i, 100 + i) for i in range(60)}
    again.compact()
    again.close()
    later = D.History(spark, str(tmp_path / "h"))
    assert later.version == 1 and {tuple(r) for r in later.check(read.where("batch = 2")).collect()} == {(i, 200 + i) for i in range(60)}
    later.close()


# ---- mixing

def test_mix_of_odd_rows(spark):
    docs = [(i, "a", 100) for i in range(200)] + [(1000 + i, "b", 10) for i in range(20)] + [(2000, None, 50), (2001, "a", 0), (2002, "c", 9000)]
    df = spark.createDataFrame(docs, "doc_id BIGINT, source STRING, tokens BIGINT").withColumn("block", F.lit(1))
    targets = spark.createDataFrame([("m", "a", 0.6, 1, 0.5), ("m", "b", 0.3, 3, 0.5), ("m", "c", 0.1, 2, 0.5), ("m", "gone", 0.0, 1, 0.5), ("n", "gone", 1.0, 2, 0.5), (None, "a", 1.0, 1, 1.0), ("m", "a", 0.6, 1, 0.5)], "mix_id STRING, source STRING, target_share DOUBLE, max_repeats INT, corpus_share DOUBLE")
    report = {(r.mix_id, r.source): r for r in M.mix_report(df, targets).collect()}
    assert {k for k, r in report.items() if r.short} == {("m", "b")} and report["n", "gone"].source_tokens == 0
    rows = M.mix(df, "doc_id", targets, block_tokens=100).collect()
    uses = {}
    for r in rows:
        uses[r.source, r.doc_id] = uses.get((r.source, r.doc_id), 0) + 1
    assert max(v for (s, _), v in uses.items() if s == "b") == 3 and max(v for (s, _), v in uses.items() if s == "a") == 1
    assert abs(sum(r.tokens for r in rows if r.source == "a") - report["m", "a"].wanted) < 300
    assert M.mix(df.limit(0), "doc_id", targets).count() == 0 and M.mix(df, "doc_id", targets.limit(0)).count() == 0


# ---- subjects

def test_sentences():
    assert U.sentences("<p># Head</p>\n<p>One 2.5 ha fell. Two!  Three?</p>\n…\n") == ["One 2.5 ha fell.", "Two!", "Three?"]
    assert U.sentences(None) == U.sentences("  ") == U.sentences("… — !") == []
    assert U.words("Fami1ies m0ved 12,5 km in 1990") == ["families", "moved", "0", "0", "km", "in", "0"]


def test_long_words_and_tags_are_whole():
    long = "x" * 300
    assert len(set(U.word_features(long + "y")) - set(U.word_features(long))) >= 4
    assert U.sentences(f"One.<a href='{long}'>Two.</a>") == ["One.", "Two."]


def test_gradients_sum_over_shards_and_are_right():
    texts, own = ["Pits and ore. Roads.", "Trees and birds. More trees 12 m0re.", "Ore and trees."], [[0], [1], [0, 1]]
    weights = U.start_weights(2)

    def loss(w, arrays):
        s = U.Shard(arrays)
        word, _ = U._mean_rows(w["e"][s.feats].astype(float), s.feat_at, len(s.feats))
        mean, _ = U._mean_rows(word[s.word], s.word_at, len(s.word))
        z, t = mean @ w["w"] + w["b"], s.allowed / np.maximum(s.allowed.sum(1, keepdims=True), 1)
        return float((np.log1p(np.exp(z)) - t * z).sum())

    def dense(g):
        e = np.zeros_like(weights["e"])
        e[g["rows"]] = g["e"]
        return {"e": e, "w": g["w"], "b": g["b"]}

    every = U.make_shard(texts, own, 2)
    whole = dense(U.Shard(every).gradient(weights, True))
    parts = [dense(U.Shard(U.make_shard([t], [o], 2)).gradient(weights, True)) for t, o in zip(texts, own)]
    for k in whole:
        assert np.allclose(whole[k], sum(p[k] for p in parts), atol=1e-6)
    row = int(U.Shard(every).by_feat.keys[3])
    for k, at in (("e", (row, 5)), ("w", (2, 1)), ("b", (0,))):
        up, down = ({n: v.astype(float) for n, v in weights.items()} for _ in range(2))
        up[k][at] += 1e-4
        down[k][at] -= 1e-4
        assert (loss(up, every) - loss(down, every)) / 2e-4 == pytest.approx(float(whole[k][at]), rel=1e-3, abs=1e-5)


def test_subjects_of_odd_rows(spark):
    docs = spark.createDataFrame([(i, "Pits and ore. More ore in the pit." if i % 2 else "Trees and birds. More birds in a tree.", 1) for i in range(40)] + [(100, None, 1), (101, "", 1), (102, "ore " * 20_000, 1), (None, "ore", 1)], "doc_id BIGINT, text STRING, about INT")
    labels = spark.createDataFrame([(i, "mining" if i % 2 else "forest", "a") for i in range(20)] * 2 + [(None, "mining", "a"), (3, "unknown", None), (999, "forest", "b")], "doc_id BIGINT, subject STRING, labelled_by STRING")
    areas = spark.createDataFrame([("mining", ""), ("forest", None), (None, "")], "subject STRING, description STRING")
    got = {(r.doc_id, r.subject) for r in U.classify(docs, labels, areas).collect()}
    assert got == {(i, "mining" if i % 2 else "forest") for i in range(40)} | {(102, "mining")}
    assert U.classify(docs, labels.limit(0), areas).count() == 0
    assert U.classify(docs.limit(0), labels, areas).count() == 0
    assert U.classify(docs, labels, areas.limit(0)).count() == 0
