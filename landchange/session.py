"""Session settings and the places where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, name: str = "landchange", **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings a session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only where that is unset and the session is local (tests) a
    temporary folder of this machine takes its place, once for the session; on a cluster there must be a shared one."""
    set_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.landchange.dir", None)
    if not set_dir:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        set_dir = tempfile.mkdtemp(prefix="landchange-")
        spark.conf.set("spark.landchange.dir", set_dir)
    return set_dir.rstrip("/")


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends here, and a lost executor costs no recomputation.
    The files stay until the folder is cleared, as the returned frame is read lazily."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
