"""Writers. Survey ids stand in brackets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def as_document(df: DataFrame, key: str) -> DataFrame:
    """[K1] (key, body): each row as one JSON document, nulls kept."""
    return df.select(key, F.to_json(F.struct(*(c for c in df.columns if c != key)), {"ignoreNullFields": "false", "pretty": "true"}).alias("body"))


def write_documents(df: DataFrame, key: str, path: str) -> None:
    """[K1] one folder per key, a JSON text in it."""
    as_document(df, key).repartition(key).write.mode("overwrite").partitionBy(key).text(path)


def feature(properties: Column, geometry: Column) -> Column:
    """[K4-K6] a GeoJSON feature as text; geometry is GeoJSON text."""
    return F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(properties), F.lit(',"geometry":'), F.coalesce(geometry, F.lit("null")), F.lit("}"))


def feature_collection(df: DataFrame, by: list[str], body: str) -> DataFrame:
    """[K5] the features of each group as one collection, in order of their text."""
    joined = F.array_join(F.array_sort(F.collect_list(body)), ",")
    return df.groupBy(*by).agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), joined, F.lit("]}")).alias("body"))


def write_candidates(df: DataFrame, path: str) -> None:
    """[K6] CSV with a header, without the outline columns."""
    flat = [f.name for f in df.schema if f.dataType.typeName() not in ("array", "map", "struct")]
    df.select(flat).write.mode("overwrite").option("header", True).csv(path)


def write_features(df: DataFrame, path: str) -> None:
    """[K11] partitioned by region and year, so that a reader prunes both."""
    df.repartition("region", "year").write.mode("overwrite").partitionBy("region", "year").parquet(path)


def replace_regions(df: DataFrame, path: str) -> None:
    """[K13] rewrites only the regions that df has, all or nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("region").parquet(path)
