"""Schemas of the project's records."""

from __future__ import annotations

from pyspark.sql.types import StructType, _parse_datatype_string

_SIDE = (
    "STRUCT<years:ARRAY<INT>,months:ARRAY<INT>,platforms:ARRAY<STRING>,platformLabel:STRING,sceneCount:INT,"
    "sceneDates:ARRAY<STRING>,sceneIds:ARRAY<STRING>,clearFraction:DOUBLE,medianClearObservations:DOUBLE,"
    "image:STRING,geotiff:STRING>"
)
_LOSS = "STRUCT<areaHa:DOUBLE,treeCover2000Ha:DOUBLE,lossHa:DOUBLE,lossByYear:MAP<STRING,DOUBLE>>"

#: The analysis document, one per site.
ANALYSIS_DDL = f"""
slug STRING, generatedAt TIMESTAMP, center ARRAY<DOUBLE>, boxKm DOUBLE, bounds ARRAY<DOUBLE>, crs STRING, pixelM DOUBLE,
sizePx ARRAY<INT>, stretch ARRAY<DOUBLE>, gamma DOUBLE,
comparisons ARRAY<STRUCT<id:STRING,title:STRING,sensor:STRING,nativeResolutionM:INT,attribution:STRING,
  before:{_SIDE},after:{_SIDE},
  change:STRUCT<ndviVegetated:DOUBLE,ndviBare:DOUBLE,comparableFraction:DOUBLE,vegetatedBeforeHa:DOUBLE,
    vegetationToBareHa:DOUBLE,insideFootprintHa:DOUBLE,overlay:STRING>,
  water:STRUCT<ndwiWater:DOUBLE,ndwiDry:DOUBLE,landToWaterHa:DOUBLE,waterToLandHa:DOUBLE,
    landToWaterInsideFootprintHa:DOUBLE,overlay:STRING>>>,
footprint STRUCT<source:STRING,citation:STRING,url:STRING,polygons:INT,areaHa:DOUBLE,svgPath:STRING,geojson:STRING>,
forest STRUCT<dataset:STRING,citation:STRING,canopyThresholdPct:DOUBLE,years:ARRAY<INT>,box:{_LOSS},footprint:{_LOSS},
  overlay:STRING>,
protectedAreas ARRAY<STRUCT<id:STRING,name:STRING,short:STRING,law:STRING,url:STRING,bufferKm:DOUBLE,
  areaSvgPath:STRING,boundarySvgPath:STRING,bufferSvgPath:STRING,footprintDistanceKm:DOUBLE,footprintInsideHa:DOUBLE,
  footprintInBufferHa:DOUBLE,change:MAP<STRING,STRUCT<insideHa:DOUBLE,bufferHa:DOUBLE>>>>
""".replace("\n", " ")


def analysis_schema() -> StructType:
    return _parse_datatype_string(ANALYSIS_DDL)
