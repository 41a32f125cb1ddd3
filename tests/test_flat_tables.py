"""The registered flat tables hold every value of comparisons, footprint and protectedAreas."""

import pytest
from pyspark.sql import functions as F

from landchange.operators.nested import scalar_columns
from landchange.plans import problems
from landchange.types import analysis_schema

EXPECTED = {  # table: (source of its elements, columns that were missing: field)
    "p1_comparisons": ("c", {"attribution": "attribution", "change_overlay": "change.overlay", "change_comparableFraction": "change.comparableFraction", "water_ndwiWater": "water.ndwiWater", "water_overlay": "water.overlay"}),
    "p1_sides": ("side", {"medianClearObservations": "medianClearObservations", "geotiff": "geotiff", "platformLabel": "platformLabel"}),
    "p1_footprints": ("footprint", {"citation": "citation", "url": "url", "svgPath": "svgPath", "areaHa": "areaHa"}),
    "p1_protected_areas": ("p", {"short": "short", "law": "law", "url": "url", "areaSvgPath": "areaSvgPath", "bufferSvgPath": "bufferSvgPath"}),
    "p1_years": ("years", {"value": ""}), "p1_months": ("months", {"value": ""}), "p1_platforms": ("platforms", {"value": ""}), "p1_scene_dates": ("sceneDates", {"value": ""}),
}


def elements(analysis, what):
    """(rec_id, x) of the nested column, nulls left out."""
    if what == "footprint":
        rows = analysis.select("rec_id", F.col("footprint").alias("x"))
    elif what == "p":
        rows = analysis.select("rec_id", F.explode("protectedAreas").alias("x"))
    else:
        rows = analysis.select("rec_id", F.explode("comparisons").alias("x"))
        if what != "c":
            rows = rows.select("rec_id", F.explode(F.array("x.before", "x.after")).alias("x"))
            if what != "side":
                rows = rows.select("rec_id", F.explode(f"x.{what}").alias("x"))
    return rows.where("x IS NOT NULL")


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_no_value_is_lost(spark, data, name):
    what, columns = EXPECTED[name]
    analysis = spark.read.parquet(f"{data}/analysis.parquet")
    table = problems.QUERIES[name](spark, data).join(analysis.select("rec_id"), "rec_id", "left_semi")
    plain = elements(analysis, what).select("rec_id", *(F.col(f"x.{f}" if f else "x").alias(c) for c, f in columns.items()))
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(key, table.select("rec_id", *columns).collect())) == sorted(map(key, plain.collect()))
    if what not in ("c", "footprint", "p"):
        parents = problems.QUERIES["p1_sides" if what != "side" else "p1_comparisons"](spark, data).select("rec_id", F.col("path").alias("parent"))
        assert table.join(parents, ["rec_id", "parent"], "left_anti").count() == 0


def test_columns_follow_the_schema():
    counts = {child: len(scalar_columns(analysis_schema(), child)) for child in ("comparison", "side", "footprint", "protected_area", "area_change", "scene")}
    assert counts == {"comparison": 18, "side": 6, "footprint": 7, "protected_area": 12, "area_change": 2, "scene": 1}


def test_found_takes_the_triple_stream(spark, data):
    plan = problems.p1_found(spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Generate" not in plan
