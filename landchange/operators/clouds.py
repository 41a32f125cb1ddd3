"""Which month range sees the ground best. Survey ids stand in brackets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def usable_days(obs: DataFrame, by: list[str], scl: str = "scl") -> DataFrame:
    """[P26] days on which at least half of the pixels have data."""
    return obs.groupBy(*by, "day").agg(F.avg((F.col(scl) > 0).cast("double")).alias("data_share")).where("data_share >= 0.5")


def month_windows(spark, shortest: int = 3, longest: int = 6) -> DataFrame:
    """[W9] (length, first, last): every month range of 3 to 6 months within a year."""
    lengths = spark.range(shortest, longest + 1).select(F.col("id").cast("int").alias("length"))
    starts = lengths.withColumn("first", F.explode(F.sequence(F.lit(1), F.lit(13) - F.col("length"))))
    return starts.withColumn("last", F.col("first") + F.col("length") - 1)


def window_ranking(clear: DataFrame, sites: list[str], keys: list[str], years: list[int], views: int = 3) -> DataFrame:
    """[A13, A15, O2] worst and mean share, over the years, of pixels seen at least `views` times in a month window.

    clear: site, pixel keys, day, clear. Windows that lack a year are dropped; order: worst share to two digits, then length,
    then first month. Views are counted per pixel and month first, so a pixel's days meet its 34 windows only as 12 counts.
    """
    spark = clear.sparkSession
    seen = clear.withColumn("year", F.year("day")).withColumn("month", F.month("day")).where(F.col("year").isin(years))
    monthly = seen.groupBy(*sites, *keys, "year", "month").agg(F.count_if(F.col("clear")).alias("n"))
    windows = F.broadcast(month_windows(spark))  # 34 rows
    months = windows.withColumn("month", F.explode(F.sequence("first", "last")))
    per_pixel = monthly.join(F.broadcast(months), "month").groupBy(*sites, *keys, "year", "length", "first", "last").agg(F.sum("n").alias("n"))
    per_year = per_pixel.groupBy(*sites, "year", "length", "first", "last").agg(F.avg((F.col("n") >= views).cast("double")).alias("share"))
    ranked = per_year.groupBy(*sites, "length", "first", "last").agg(F.min("share").alias("worst"), F.avg("share").alias("mean"), F.count("*").alias("years"))
    return ranked.where(F.col("years") == len(years)).drop("years")


def monthly_clear_share(clear: DataFrame, sites: list[str]) -> DataFrame:
    """[A14] mean over a month's days of the day's mean over pixels, not pooled."""
    daily = clear.groupBy(*sites, "day").agg(F.avg(F.col("clear").cast("double")).alias("share"))
    return daily.groupBy(*sites, F.month("day").alias("month")).agg(F.avg("share").alias("share"), F.count("*").alias("days"))
