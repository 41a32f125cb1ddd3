"""The sources that fall short are read off the slots and blocks of the mix."""

import random

import pytest

from landchange.llm import mixing as M, queries as Q

DOCS = "doc_id BIGINT, source STRING, tokens BIGINT"
TARGETS = "mix_id STRING, source STRING, target_share DOUBLE, max_repeats INT, corpus_share DOUBLE"


def test_p8_found_goes_through_slots_and_blocks(spark, data, monkeypatch):
    sums, plain = [], M.running_sum
    monkeypatch.setattr(M, "running_sum", lambda *a: (sums.append((a[1], a[4])), plain(*a))[1])
    found = Q.p8_found(spark, data)
    assert sorted(sums) == [(["mix_id"], "_place"), (["mix_id", "target"], "_rank"), (["source"], "_through")]
    report = M.mix_report(Q._sizes(spark, data), spark.read.parquet(f"{data}/mix_targets.parquet"))
    assert sorted(map(tuple, found.collect())) == sorted((r.mix_id, r.source) for r in report.where("short").collect())


def test_one_token_decides(spark):
    docs = spark.createDataFrame([(0, "a", 1000), (1, "b", 999), (2, "b", 0), (3, "c", 1), (4, "rest", 8000)], DOCS)
    targets = spark.createDataFrame([("m", "a", 0.1, 1, 1.0), ("m", "b", 0.1, 1, 1.0), ("m", "c", 0.1, 999, 1.0), ("m", "rest", 0.7, 1, 1.0), ("n", "c", 1.0, 1, 1.0), ("n", "gone", 0.1, 9, 1.0)], TARGETS)
    found = {(r.mix_id, r.source): r.found for r in M.fall_short(docs, "doc_id", targets, block_tokens=100).collect()}
    assert found == {("m", "b"): 999, ("m", "c"): 999, ("n", "gone"): 0}
    met = spark.createDataFrame([("m", s, w, r, 1.0) for s, w, r in (("a", 0.1, 1), ("b", 0.0999, 1), ("c", 0.1, 1000), ("rest", 0.8, 1))], TARGETS)
    assert M.fall_short(docs, "doc_id", met, block_tokens=100).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_short_as_the_sizes_tell(spark, seed):
    rnd = random.Random(seed)
    names = "abcdefgh"
    docs = [(i, rnd.choice([*names[:7], None]), rnd.choice([0, 1, 7, 40, 300, 2000, None])) for i in range(120)]
    targets = [(m, s, rnd.choice([0.0, 1e-6, 0.01, 0.2, 0.5, -0.1, float("nan") if m == "odd" else 0.3, None]), rnd.choice([0, 1, 2, 50, None]), rnd.choice([0.1, 1.0, 2.0])) for m in ("m", "n", "odd") for s in names]
    docs, targets = spark.createDataFrame(docs, DOCS), spark.createDataFrame([*targets, targets[0]], TARGETS)
    expected = {(r.mix_id, r.source) for r in M.mix_report(docs, targets).where("short").collect()}
    found = [(r.mix_id, r.source) for r in M.fall_short(docs, "doc_id", targets, block_tokens=[256, 100, 7][seed]).collect()]
    assert sorted(found) == sorted(expected)


def test_a_small_source_used_often_reaches_its_share(spark):
    docs = spark.createDataFrame([(0, "small", 10), *((i, "large", 100) for i in range(1, 100)), (200, "large", 0)], DOCS)
    targets = spark.createDataFrame([("m", "small", 0.5, 1000, 1.0), ("m", "large", 0.5, 1, 1.0)], TARGETS)
    rows = M.mix(docs, "doc_id", targets).collect()
    drawn = {s: sum(r.tokens for r in rows if r.source == s) for s in ("small", "large")}
    assert 4955 <= drawn["small"] < 4965 and 4955 <= drawn["large"] < 5055
    small = [r["repeat"] for r in rows if r.source == "small"]
    assert sorted(small) == list(range(len(small)))
    assert len({r.slot for r in rows if r.source == "small"}) == 20 and M.fall_short(docs, "doc_id", targets).count() == 0
