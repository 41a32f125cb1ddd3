"""One ranking from several scores on unlike scales: leximin over percentiles.

Each score becomes a percentile among the rows of its group, from counts of distinct values; an item's percentiles are sorted
ascending and items are compared by these vectors from the weakest score on, so a high score can't mask a weak one and no
score's range matters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from landchange.operators.sequence import running_sum


def percentiles(long: DataFrame, by: list[str], value: str, out: str = "percentile") -> DataFrame:
    """Adds the mid-rank percentile, in (0, 1), of `value` among its group's values: (rows below + half of the equal ones) /
    rows. Null and NaN values have 0, below every value, and aren't counted.

    Rows are pre-aggregated to distinct values before any order is made, so ties and large groups cost nothing more.
    """
    valid = F.col(value).isNotNull() & ~F.coalesce(F.isnan(value), F.lit(False))
    counts = long.where(valid).groupBy(*by, value).agg(F.count("*").alias("_n"))
    totals = counts.groupBy(*by).agg(F.sum("_n").alias("_all"))
    ranked = running_sum(counts, by, [F.col(value)], F.col("_n"), "_below")
    with_all = ranked.join(totals, [ranked[c].eqNullSafe(totals[c]) for c in by], "inner").select(ranked["*"], totals["_all"])
    table = with_all.select(*(F.col(c).alias(f"_t_{c}") for c in by), F.col(value).alias("_t_value"), ((F.col("_below") - F.col("_n") / 2) / F.col("_all")).alias(out))
    match = F.col("_t_value") == F.col(value)
    for c in by:
        match &= F.col(f"_t_{c}").eqNullSafe(F.col(c))
    # rows without a score, however many, meet nothing and don't move
    found = long.where(valid).join(table, match).select(*long.columns, out)
    return found.unionByName(long.where(~valid).select(*long.columns, F.lit(0.0).alias(out)))


def leximin_rank(df: DataFrame, key: str, scores: list[str], within: list[str] = []) -> DataFrame:
    """(key, weakest ARRAY<DOUBLE>, rank BIGINT): rank 1 is the item whose ascending percentile vector is the largest.

    scores: columns where more is better. within: columns of the group a percentile is taken in, where scores of different
    groups aren't comparable; null is a group of its own. Equal vectors rank by key. A missing (null, NaN) score counts as
    percentile 0. key must be unique once exact copies are dropped, which this does; an empty table gives none.
    """
    groups = [f"_g{i}" for i in range(len(within))]
    clean = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_k"), *(F.col(c).alias(g) for c, g in zip(within, groups)), *(F.col(s).cast("double").alias(f"_s{i}") for i, s in enumerate(scores))).distinct()
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("score"), F.col(f"_s{i}").alias("value")) for i in range(len(scores)))))
    long = clean.select("_k", *groups, each.alias("_e")).select("_k", *groups, "_e.score", "_e.value")
    vectors = percentiles(long, [*groups, "score"], "value").groupBy("_k").agg(F.array_sort(F.collect_list("percentile")).alias("weakest"))
    order = [F.col("weakest").desc(), F.col("_k")]
    return running_sum(vectors, [], order, None, "rank").select(F.col("_k").alias(key), "weakest", "rank")
