"""Precision, recall and thresholds by ranked scores. Survey ids stand in brackets.

Scores are first counted by distinct value; the running sums over distinct scores are made without a single-task window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from landchange.operators.sequence import running_sum


def pr_curve(scored: DataFrame, p: str, y: str, by: list[str] = []) -> DataFrame:
    """[W4] (by, threshold, precision, recall, tp, n) per distinct score: what "p >= threshold" selects. Null scores or labels are
    left out. recall is NULL where there are no positives."""
    counted = scored.where(F.col(p).isNotNull() & F.col(y).isNotNull()).groupBy(*by, F.col(p).alias("threshold")).agg(F.count("*").alias("_n"), F.count_if(F.col(y)).alias("_tp"))
    totals = counted.groupBy(*by).agg(F.sum("_tp").alias("_pos")) if by else counted.agg(F.sum("_tp").alias("_pos"))
    order = [F.col("threshold").desc()]
    n = running_sum(counted, by, order, F.col("_n"), "n")
    tp = running_sum(n, by, order, F.col("_tp"), "tp")
    joined = tp.join(totals, by) if by else tp.join(F.broadcast(totals))  # one row
    return joined.select(*by, "threshold", (F.col("tp") / F.col("n")).alias("precision"), F.try_divide(F.col("tp"), F.col("_pos")).alias("recall"), "tp", "n", F.col("_tp").alias("step_tp"), F.col("_pos").alias("positives"))


def average_precision(curve: DataFrame, by: list[str] = []) -> DataFrame:
    """[A21] sum of precision times the step in recall; NULL without positives."""
    return curve.groupBy(*by).agg(F.try_divide(F.sum(F.col("precision") * F.col("step_tp")), F.max("positives")).alias("ap"))


def threshold_for(curve: DataFrame, target: float, by: list[str] = []) -> DataFrame:
    """[A24] the point of highest recall among those of at least the target precision, equal recall by the lowest threshold; where
    no point is that precise, the point of highest precision."""
    point = F.struct("threshold", "precision", "recall")
    good = F.max_by(point, F.when(F.col("precision") >= target, F.struct(F.col("recall"), -F.col("threshold"))))
    best = F.max_by(point, F.struct(F.col("precision"), -F.col("threshold")))
    return curve.groupBy(*by).agg(F.coalesce(good, best).alias("_p")).select(*by, "_p.*")


def precision_at_recall(curve: DataFrame, levels: list[float], by: list[str] = []) -> DataFrame:
    """[A25] highest precision at or above each recall level."""
    return curve.groupBy(*by).agg(*(F.max(F.when(F.col("recall") >= x, F.col("precision"))).alias(f"p_at_{round(100 * x)}") for x in levels))


def at_threshold(scored: DataFrame, p: str, y: str, threshold: float, by: list[str] = []) -> DataFrame:
    """[A22, A23] share of positives, precision and recall of "p >= threshold"; NULL where undefined."""
    hit, yes = F.col(p) >= threshold, F.col(y)
    return scored.groupBy(*by).agg(F.avg(yes.cast("double")).alias("positive_share"), F.try_divide(F.count_if(hit & yes), F.count_if(hit)).alias("precision"), F.try_divide(F.count_if(hit & yes), F.count_if(yes)).alias("recall"))
