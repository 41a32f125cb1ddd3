"""The report's drawn shares are those of the mix."""

from pyspark.sql import functions as F

from landchange.llm import mixing as M, queries as Q


def test_a_long_document_shows_in_the_drawn_share(spark):
    docs = spark.createDataFrame([(0, "long", 5000)] + [(i, "short", 100) for i in range(1, 51)], "doc_id BIGINT, source STRING, tokens INT")
    targets = spark.createDataFrame([("m", "long", 0.5, 1, 0.1), ("m", "short", 0.5, 1, 0.1), ("m", "gone", 0.0, 1, 0.1)], "mix_id STRING, source STRING, target_share DOUBLE, max_repeats INT, corpus_share DOUBLE")
    report = {r.source: r for r in M.drawn_report(docs, "doc_id", targets).collect()}
    assert report["long"].share == report["short"].share == 0.5  # planned
    assert report["long"].drawn == 5000 and report["long"].drawn_share == 5000 / (5000 + report["short"].drawn) > 0.8 and report["gone"].drawn == 0


def test_report_counts_the_mix(spark, data):
    rows = Q.p8_mix(spark, data).groupBy("mix_id", "source").agg(F.sum("tokens").alias("tokens")).collect()
    report = Q.p8_report(spark, data).collect()
    assert {(r.mix_id, r.source): r.drawn for r in report if r.drawn} == {(r.mix_id, r.source): r.tokens for r in rows if r.tokens}
    assert all(abs(sum(r.drawn_share for r in report if r.mix_id == m) - 1) < 1e-9 for m in {r.mix_id for r in report if r.drawn})
