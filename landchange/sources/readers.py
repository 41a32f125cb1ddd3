"""Readers of the project's files. Survey ids stand in brackets."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from landchange.types import analysis_schema

_GEOJSON = "type STRING, features ARRAY<STRUCT<type:STRING,properties:MAP<STRING,STRING>,geometry:STRING>>"


def analysis_documents(spark: SparkSession, path: str) -> DataFrame:
    """[S17] one row per JSON file, by the fixed schema; a file that doesn't fit it fails."""
    return spark.read.schema(analysis_schema()).option("multiLine", True).option("mode", "FAILFAST").json(path)


def analysis_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, body) of JSON files of any layout, for `child_rows`."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("body"))


def geojson_features(spark: SparkSession, path: str) -> DataFrame:
    """[S14] (properties, geometry) of feature collections; geometry stays GeoJSON text."""
    return spark.read.schema(_GEOJSON).option("multiLine", True).json(path).select(F.explode("features").alias("f")).select("f.properties", "f.geometry")


def candidate_runs(spark: SparkSession, path: str) -> DataFrame:
    """[S21] runs that have a meta.json, newest first within a region."""
    meta = spark.read.option("multiLine", True).json(f"{path}/*/meta.json")
    return meta.orderBy("region", F.desc("year"))


def pixel_layers(spark: SparkSession, path: str, columns: list[str], regions: list[str] | None = None) -> DataFrame:
    """[S19, L10] a feature table partitioned by region and year: only the asked columns and partitions are read."""
    rows = spark.read.parquet(path)
    return (rows.where(F.col("region").isin(regions)) if regions else rows).select(columns)


def footprints_in_box(spark: SparkSession, path: str, box: tuple[float, float, float, float]) -> DataFrame:
    """[S13, J7] polygons whose bounds (columns xmin, ymin, xmax, ymax) meet a box; the comparison reaches the row groups."""
    x0, y0, x1, y1 = box
    return spark.read.parquet(path).where((F.col("xmin") <= x1) & (F.col("xmax") >= x0) & (F.col("ymin") <= y1) & (F.col("ymax") >= y0))


def config_rows(spark: SparkSession, text: str, table: str) -> DataFrame:
    """[S16] a list of records of a JSON or, where a YAML library is installed, YAML configuration."""
    try:
        value = json.loads(text)
    except ValueError:
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("reading YAML needs the yaml package; JSON needs nothing") from e
        value = yaml.safe_load(text)
    rows = value[table]
    rows = [{"id": k, **v} for k, v in rows.items()] if isinstance(rows, dict) else rows
    return spark.read.json(spark.sparkContext.parallelize([json.dumps(r) for r in rows], 1))


def front_matter(spark: SparkSession, path: str) -> DataFrame:
    """[S18] (page, field, value) of the top-level scalar fields of Markdown pages' front matter."""
    pages = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.md$", 1).alias("page"), F.regexp_extract("value", r"(?s)^---\n(.*?)\n---", 1).alias("head"))
    line = F.explode(F.split("head", "\n"))
    fields = pages.select("page", line.alias("line")).where(F.col("line").rlike(r"^\w+: *\S"))
    value = F.regexp_replace(F.regexp_extract("line", r"^\w+: *(.*)$", 1), "^[\"']|[\"']$", "")
    return fields.select("page", F.regexp_extract("line", r"^(\w+):", 1).alias("field"), value.alias("value"))


def clean_name(name: str) -> str:
    """A table or column name in lower case and underscores."""
    return re.sub(r"\W+", "_", name).strip("_").lower()
