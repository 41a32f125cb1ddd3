"""Observations as a stream: views count however late their file arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from landchange.functions.pixels import clear_landsat


def observation_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stream over Parquet files that arrive under path; without files_per_trigger all new files make one batch."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def clear_counts_by_window(obs: DataFrame, key: str, ts: str, qa: str, window: str = "1 day") -> DataFrame:
    """Views and clear views per key and window."""
    timed = obs.withColumn("_ts", F.col(ts).cast("timestamp"))
    counts = timed.groupBy(F.window("_ts", window), key).agg(F.count("*").alias("views"), F.count_if(clear_landsat(F.col(qa))).alias("clear_views"))
    return counts.select(key, F.col("window.start").alias("begin"), "views", "clear_views")


def run_once(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Takes what is there, leaves the counts of all windows so far as Parquet under path, and stops. A further call goes on
    from the checkpoint. No window is closed by a watermark, so the state is as large as the result."""
    def replace(counts: DataFrame, _: int) -> None:
        counts.write.mode("overwrite").parquet(path)

    stream.writeStream.outputMode("complete").foreachBatch(replace).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
