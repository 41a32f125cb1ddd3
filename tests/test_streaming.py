"""The stream's counts against a plain aggregate of the same rows."""

from pyspark.sql import functions as F

from landchange.plans import engine, layers as L
from landchange.streaming.observations import clear_counts_by_window, observation_stream, run_once

SCHEMA = "pixel BIGINT, ts TIMESTAMP_NTZ, qa INT"


def counted(df):
    return sorted(tuple(r) for r in df.select("pixel", "begin", "views", "clear_views").collect())


def test_all_windows_come_out(spark, data):
    plain = clear_counts_by_window(L.obs(spark, data), "pixel", "ts", "qa")
    found = engine.clear_counts_stream(spark, data)
    assert counted(found) == counted(plain)
    assert found.agg(F.sum("views")).first()[0] == spark.read.parquet(f"{data}/events.parquet").count()


def test_files_out_of_order_and_a_further_call(spark, tmp_path):
    rows = spark.sql("SELECT id % 3 AS pixel, TIMESTAMP_NTZ '2024-03-01' - make_interval(0, 0, 0, CAST(id AS INT)) AS ts, CAST(id AS INT) AS qa FROM range(40)")
    for part in ("id < 20", "id >= 20"):  # the second call's rows are all older
        rows.where(part.replace("id", "qa")).repartition(4).write.mode("append").parquet(f"{tmp_path}/in")
        stream = observation_stream(spark, f"{tmp_path}/in", SCHEMA, 1)
        run_once(clear_counts_by_window(stream, "pixel", "ts", "qa"), f"{tmp_path}/out", f"{tmp_path}/state")
    out = spark.read.schema("pixel BIGINT, begin TIMESTAMP, views BIGINT, clear_views BIGINT").parquet(f"{tmp_path}/out")
    assert counted(out) == counted(clear_counts_by_window(rows, "pixel", "ts", "qa"))
