"""Samples whose categories have given shares, by swap repair.

Only counts are searched: records are counted by category signature, a random floor-satisfying start is drawn from these
counts, and one signature's records are exchanged for another's while that lowers the deviation from the targets. The final
counts are then drawn from the records at random, exactly, without sorting a category.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from landchange.session import stage

#: Hash buckets per sample and signature that narrow down, twice over, where a draw ends.
DRAW_BUCKETS = 4096
#: Targets up to which the plan of a draw is sent to all executors; above, rows meet it by key and one of SALTS salts.
MAX_TARGETS, SALTS = 100_000, 64


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of n records, drawn at random from good + bad, are good; exact for any counts.

    Beyond the generator's own range every record is first drawn on its own with probability n / (good + bad), and the
    shortfall or surplus, some sqrt(n) records, is drawn or taken back at random in the same way."""
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, n)) if n else 0
    if n <= 1000:
        hits = 0
        for i in range(n):
            hits += int(rng.integers(good + bad - i)) < good - hits
        return hits
    p = n / (good + bad)
    a, b = int(rng.binomial(good, p)), int(rng.binomial(bad, p))
    if a + b > n:
        return a - hypergeometric(rng, a, b, a + b - n)
    return a + hypergeometric(rng, good - a, bad - b, n - a - b)


def swap_repair(available: np.ndarray, floor: np.ndarray, share: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """How many records of each signature to draw: at most `available`, at least `floor` where available allows it, `size` in
    all, and with shares from which no exchange between two signatures comes closer to `share` in squared deviation.

    Floors that exceed `size` together enlarge the sample.
    """
    rng = np.random.default_rng(seed)
    counts = np.minimum(floor, available).astype(np.int64)
    size = int(min(max(size, counts.sum()), available.sum()))
    left = available - counts
    more = size - int(counts.sum())
    if more > 0 and left.sum() > 0:  # the random start: the rest of the sample is drawn blindly
        rest, remaining = more, int(left.sum())
        for i in range(len(left)):
            take = hypergeometric(rng, int(left[i]), remaining - int(left[i]), rest)
            counts[i] += take
            rest, remaining = rest - take, remaining - int(left[i])
            if remaining <= 0:
                break
    goal, low = share * size, np.minimum(floor, available)
    while True:
        over = counts - goal
        a = int(np.argmax(np.where(counts > low, over, -np.inf)))
        b = int(np.argmin(np.where(counts < available, over, np.inf)))
        if counts[a] <= low[a] or counts[b] >= available[b]:
            return counts
        # moving s records from a to b lowers the squared deviation by 2 s (over a - over b - s)
        step = int(min(max(1, (over[a] - over[b]) // 2), counts[a] - low[a], available[b] - counts[b]))
        if over[a] - over[b] - step <= 1e-9:
            return counts
        counts[a], counts[b] = counts[a] - step, counts[b] + step


def usable_rows(features: DataFrame, keys: list[str], category: str, categories: list[int]) -> DataFrame:
    """Distinct keys with a category that counts; a key delivered with several such categories has the least."""
    return features.where(F.col(category).isin(categories)).groupBy(*keys).agg(F.min(category).cast("int").alias(category))


def sample_report(rows: DataFrame, targets: DataFrame, group: str, category: str, seed: int = 0) -> DataFrame:
    """The draw per sample and category: sample_id, category, target_share, available, usable, required, drawn, share, short.

    rows: one row per record with `group` and `category`. targets: sample_id, `group` (null: all records), `category`,
    target_share, min_rows, sample_share. required is the greater of min_rows and sample_share x target_share x the sample's
    records; short says that there are fewer records. Categories without a target are in the sample's record count but
    aren't drawn. Null target values count as 0; a target given twice counts once; no targets, no rows.
    """
    counts = rows.groupBy(group, category).agg(F.count("*").alias("n"))  # as many rows as there are signatures
    wanted = targets.where(F.col("sample_id").isNotNull()).select("sample_id", F.col(group).alias("_group"), F.col(category).cast("int").alias("_category"), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("target_share", "min_rows", "sample_share"))).distinct()
    scopes = wanted.select("sample_id", F.col("_group").isNull().alias("_all"), F.coalesce(F.col("_group").cast("string"), F.lit("")).alias("_in")).distinct()
    whole = counts.groupBy(category).agg(F.sum("n").alias("n")).select(F.lit(True).alias("_all"), F.lit("").alias("_in"), category, "n")
    parted = counts.where(F.col(group).isNotNull()).select(F.lit(False).alias("_all"), F.col(group).cast("string").alias("_in"), category, "n")
    per_sample = scopes.join(whole.unionByName(parted), ["_all", "_in"]).select("sample_id", category, "n")
    totals = per_sample.groupBy("sample_id").agg(F.sum("n").alias("usable"))
    joined = (
        wanted.join(per_sample, (wanted["sample_id"] == per_sample["sample_id"]) & (F.col("_category") == per_sample[category]), "left")
        .select(wanted["*"], F.coalesce("n", F.lit(0)).alias("available"))
        .join(totals, "sample_id", "left")
        .withColumn("usable", F.coalesce("usable", F.lit(0)))
    )
    required = F.greatest(F.col("min_rows").cast("double"), F.col("sample_share") * F.col("target_share") * F.col("usable"))

    def repair(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values("category").reset_index(drop=True)
        size = int(np.floor(sample["sample_share"].iloc[0] * sample["usable"].iloc[0] + 0.5))
        share = sample["target_share"].to_numpy(float)
        share = share / share.sum() if share.sum() > 0 else share
        drawn = swap_repair(sample["available"].to_numpy(np.int64), sample["min_rows"].to_numpy(np.int64), share, size, seed)
        sample["drawn"] = drawn
        sample["share"] = drawn / max(1, drawn.sum())
        return sample[["sample_id", "category", "target_share", "available", "usable", "required", "drawn", "share"]]

    ready = joined.select("sample_id", F.col("_category").alias("category"), "target_share", "min_rows", "sample_share", "available", "usable", required.alias("required"))
    ddl = "sample_id STRING, category INT, target_share DOUBLE, available BIGINT, usable BIGINT, required DOUBLE, drawn BIGINT, share DOUBLE"
    return ready.groupBy("sample_id").applyInPandas(repair, ddl).withColumn("short", F.col("available") < F.col("required"))


def draw(rows: DataFrame, keys: list[str], targets: DataFrame, group: str, category: str, seed: int = 0) -> DataFrame:
    """The samples themselves: (sample_id, *keys, category), each category's drawn count of records at random.

    A record's place in a sample is its hash. Counts per hash bucket tell in which bucket a category's draw ends, counts of
    that bucket's parts in which part; what lies below is taken whole, and only that part, one of DRAW_BUCKETS squared, is put
    in order, so the draw is exact and repeatable at every size. Equal keys must not repeat (`usable_rows` sees to it).
    """
    report = sample_report(rows, targets, group, category, seed).select("sample_id", "category", "drawn")
    scopes = targets.where(F.col("sample_id").isNotNull()).select("sample_id", F.col(group).alias("_group"), F.col(category).cast("int").alias("category")).distinct()
    plan = scopes.join(report, ["sample_id", "category"]).where("drawn > 0")  # as many rows as targets
    member = stage(_members(rows, keys, plan, targets.count() <= MAX_TARGETS, group, category, seed), "members")
    target = ["sample_id", "category"]
    first = _ends(member, target, "_b1", F.col("drawn"))
    whole = member.join(F.broadcast(first) if targets.count() <= MAX_TARGETS else first, target)
    edge = stage(whole.where("_b1 = _end").drop("drawn", "_end").withColumnRenamed("_left", "drawn"), "edge")
    second = _ends(edge, target, "_b2", F.col("drawn"))
    parts = edge.join(second, target)
    order = Window.partitionBy(*target, "_b2").orderBy("_mark", *keys)
    last = parts.where("_b2 = _end").withColumn("_at", F.row_number().over(order)).where("_at <= _left")
    out = ["sample_id", *keys, "category"]
    return whole.where("_b1 < _end").select(out).unionByName(parts.where("_b2 < _end").select(out)).unionByName(last.select(out))


def _members(rows: DataFrame, keys: list[str], plan: DataFrame, small: bool, group: str, category: str, seed: int) -> DataFrame:
    """Each record of each sample it may be drawn for: (sample_id, category, drawn, *keys, _mark, _b1, _b2)."""
    held = [k for k in keys if k != group]
    plain = rows.select(F.col(group).alias("_g"), F.col(category).alias("_c"), *(F.col(k).alias(f"_k_{k}") for k in held))
    match = F.col("category") == F.col("_c")
    if small:
        joined = plain.join(F.broadcast(plan), match & (F.col("_group").isNull() | (F.col("_group") == F.col("_g"))))
    else:  # hot categories and groups are spread by a salt
        salted = plain.withColumn("_salt", F.pmod(F.xxhash64(*plain.columns), F.lit(SALTS)).cast("int"))
        wide = plan.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        match &= F.col("_salt") == F.col("_s")
        joined = salted.join(wide.where("_group IS NULL"), match).unionByName(salted.join(wide.where("_group IS NOT NULL"), match & (F.col("_group") == F.col("_g"))))
    named = joined.select("sample_id", "category", "drawn", *(F.col("_g" if k == group else f"_k_{k}").alias(k) for k in keys))
    mark = F.xxhash64(F.lit(seed), "sample_id", *keys)
    bucket = lambda shift: F.shiftrightunsigned(F.col("_mark"), shift).bitwiseAND(DRAW_BUCKETS - 1)
    return named.withColumn("_mark", mark).withColumn("_b1", bucket(52)).withColumn("_b2", bucket(40))


def _ends(rows: DataFrame, target: list[str], bucket: str, wanted: Column) -> DataFrame:
    """(target, _end, _left): the bucket in which the draw ends and how many of its rows it takes."""
    filled = rows.groupBy(*target, bucket).agg(F.count("*").alias("_n"), F.first("drawn").alias("drawn"))  # at most targets x DRAW_BUCKETS rows
    upto = Window.partitionBy(*target).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    placed = filled.withColumn("_upto", F.sum("_n").over(upto)).where(F.col("_upto") >= wanted)
    return placed.groupBy(*target).agg(F.min_by(F.struct(F.col(bucket).alias("_end"), (wanted - F.col("_upto") + F.col("_n")).alias("_left")), bucket).alias("_e")).select(*target, "_e.*")
