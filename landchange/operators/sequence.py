"""Running sums and ranks over orders of any length, without one task that sees the whole order.

Rows are range-partitioned by (group, order); each partition's totals, one row per partition and group, give the offset of
the next partition. A group may span any number of partitions, so a group with a third of all rows is no hot task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from landchange.session import shuffle_parts, stage


def running_sum(df: DataFrame, by: list[str], order: list[Column], value: Column | None, out: str) -> DataFrame:
    """Adds `out`: the sum of `value` (1 where None) over the rows of the same group up to and including this one.

    order must be total within a group (end it with a unique key) for a repeatable result. Null values count 0. An empty
    frame stays empty.
    """
    spark = df.sparkSession
    at, held = f"_part_{out}", f"_value_{out}"
    keys = [F.col(c) for c in by]
    valued = df.withColumn(held, F.lit(1).cast("long") if value is None else F.coalesce(value, F.lit(0)))
    # the rows are written before they are read twice: range bounds are sampled, and a second run may cut elsewhere
    ranged = stage(valued.repartitionByRange(shuffle_parts(spark), *keys, *order).withColumn(at, F.spark_partition_id()), "ranged")
    before = Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(at, *by).agg(F.sum(held).alias("_total"))
    offsets = offsets.withColumn("_offset", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    within = Window.partitionBy(at, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    match = [ranged[at] == offsets[at], *(ranged[c].eqNullSafe(offsets[c]) for c in by)]
    joined = ranged.join(offsets, match, "inner").select(ranged["*"], offsets["_offset"])
    return joined.withColumn(out, F.sum(held).over(within) + F.col("_offset")).drop(at, held, "_offset")
