"""Nested records: both readers, and every kind of damage."""

import json

import pytest
from pyspark.sql import functions as F

from landchange.operators.nested import ANALYSIS_TABLES, as_bodies, child_rows, flat_table, shape, triples
from landchange.types import analysis_schema
from tests.columns_reader import child_rows_of_columns

NAMES = {"comparisons": [{"id": "a", "before": {"sceneIds": ["x", None, "y"]}, "after": None}, None, {"id": None, "before": {}}], "footprint": {}, "protectedAreas": [{"change": {"k": {"insideHa": 1.5}, "n": None}}]}
PATHS = {
    "comparisons/0", "comparisons/0/before", "comparisons/0/before/sceneIds/0", "comparisons/0/before/sceneIds/2", "comparisons/2", "comparisons/2/before",
    "footprint", "protectedAreas/0", "protectedAreas/0/change/k",
}


def found(spark, *bodies):
    rows = spark.createDataFrame(list(enumerate(bodies)), "rec_id BIGINT, body STRING")
    got = child_rows(rows, "rec_id", "body", analysis_schema(), {k: v for k, v in ANALYSIS_TABLES.items() if k != "record"}, fields=False).collect()
    return {i: {r.path for r in got if r.rec_id == i} for i in range(len(bodies))}


def test_layouts_that_mean_the_same(spark):
    plain = json.dumps(NAMES)
    snake = plain.replace("sceneIds", "scene_ids").replace("protectedAreas", "protected_areas").replace("insideHa", "inside_ha")
    texts = json.dumps(NAMES | {"comparisons": json.dumps(NAMES["comparisons"]), "footprint": "{}", "protectedAreas": NAMES["protectedAreas"][0]})
    got = found(spark, plain, "﻿" + plain, snake, json.dumps({"data": NAMES}), texts)
    assert all(paths == PATHS for paths in got.values())


def test_one_scene_is_a_list_of_one(spark):
    assert found(spark, json.dumps({"comparisons": {"before": {"sceneIds": "S2"}}, "x": 1}))[0] == {"comparisons/0", "comparisons/0/before", "comparisons/0/before/sceneIds/0"}


def test_bodies_that_are_no_object(spark):
    bad = [None, "", "  ", "[]", "null", '{"a": 1', '{"a": 1} x', '{"footprint": {}, "b": NaN}', "[" * 100_000, "text"]
    assert all(not paths for paths in found(spark, *bad).values())


def test_strange_text_survives(spark):
    body = json.dumps({"protectedAreas": [{"id": "\ud800", "change": {"\ud800é/x": {}}}], "footprint": {"source": "z" * 1_000_000}})
    assert len(found(spark, body)[0]) == 3


def test_readers_agree(spark, data):
    a = spark.read.parquet(f"{data}/analysis.parquet")
    native = child_rows_of_columns(a, "rec_id")
    text = child_rows(a.select("rec_id", F.to_json(F.struct(*a.columns[1:])).alias("body")), "rec_id", "body", analysis_schema())
    fields = lambda df: df.where("child <> 'record'").select("rec_id", "child", "path", "parent", "ordinal", "label", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("fields")))).alias("f"))
    assert fields(native).exceptAll(fields(text)).count() == 0 and fields(text).exceptAll(fields(native)).count() == 0
    assert native.where("child = 'record'").count() == a.count()


def test_every_child_points_to_its_parent(spark, data):
    from landchange.plans.problems import _analysis_rows

    rows = _analysis_rows(spark, data, list(ANALYSIS_TABLES))
    orphans = rows.where("child <> 'record'").join(rows.select("rec_id", F.col("path").alias("parent")), ["rec_id", "parent"], "left_anti")
    assert orphans.count() == 0


def test_flat_columns(spark):
    rows = spark.createDataFrame([(1, json.dumps({"footprint": {"areaHa": "4.5", "polygons": "many"}, "z": 0}))], "rec_id BIGINT, body STRING")
    t = flat_table(child_rows(rows, "rec_id", "body", analysis_schema()), "rec_id", "footprint", {"areaHa": "double", "polygons": "int"}).first()
    assert (t.areaHa, t.polygons, t.path, t.parent) == (4.5, None, "footprint", "")


def test_empty_tables_and_clashing_columns(spark, data):
    a = spark.read.parquet(f"{data}/analysis.parquet")
    assert child_rows_of_columns(a.limit(0), "rec_id").count() == 0
    clash = a.withColumn("_row", F.lit(1)).withColumn("child", F.lit("x")).withColumn("path", F.lit("y"))
    assert child_rows_of_columns(clash, "rec_id", fields=False).count() == child_rows_of_columns(a, "rec_id", fields=False).count()
    raw = spark.createDataFrame([(1, "{}", "x")], "rec_id BIGINT, body STRING, fields STRING")
    assert child_rows(raw.limit(0), "rec_id", "body", analysis_schema()).count() == 0
    assert child_rows(raw, "rec_id", "body", analysis_schema()).count() == 1


@pytest.mark.parametrize("text,keys", [('{"x": {"b": {"c": 1}}}', ["b"]), ('{"a": {"b": {"c": 1}}}', ["b"]), ('{"c": 1}', ["c"]), ('{"a": {}, "b": {}}', ["a", "b"]), ('{"x": {"x": {"a": {}}}}', [])])
def test_one_wrapper_is_opened(text, keys):
    from pyspark.sql.types import _parse_datatype_string

    kind = shape(_parse_datatype_string("a STRUCT<c:INT>, b STRUCT<c:INT>, c INT"))
    assert sorted({p.split("/")[0] for p, _, _ in triples(text, kind)} - {""}) == keys


TWICE = [
    ('{"areaHa": 1, "areaHa": 2, "x": 0}', "2"), ('{"area_ha": 1, "areaHa": 2, "x": 0}', "2"), ('{"areaHa": 2, "area_ha": 1, "x": 0}', "2"), ('{"areaHa": null, "area_ha": 1, "x": 0}', "1"),
    ('{"area_ha": 1, "areaHa": null, "x": 0}', "1"), ('{"areaHa": 1.50, "x": [[], {}]}', "1.5"), ('{"areaHa": "1.50", "x": 1}', "1.50"), ('{"areaHa": {"v": [1, "é"]}, "x": 1}', '{"v": [1, "é"]}'), ('{"areaHa": true, "x": 1}', "true"),
]


@pytest.mark.parametrize("inner,value", TWICE)
def test_fields_given_twice_and_odd_values(inner, value):
    got = [v for p, _, v in triples(f' {{"footprint": {inner}, "crs": "u"}} ', shape(analysis_schema())) if p == "footprint/areaHa"]
    assert got == [value]


def test_stream_equals_the_library(data):
    """Any damage: the stream takes a body exactly where the library's parser takes it as one object."""
    import random

    rnd = random.Random(3)
    bodies = [json.dumps(NAMES | {"crs": "a\u00e9 \"b", "gamma": -1.5e3}), json.dumps({"d": NAMES, "e": [True, None]}, indent=1)]
    kind = shape(analysis_schema())
    for _ in range(4000):
        text = rnd.choice(bodies)
        at = rnd.randrange(len(text))
        text = rnd.choice([text[:at], text[:at] + rnd.choice('{}[]",:0x \\n') + text[at + rnd.randrange(2) :], text + rnd.choice(["", " ", "}", "1"])])
        try:
            ok = isinstance(json.loads(text, parse_constant=lambda c: 1 / 0), dict)
        except (ValueError, ZeroDivisionError):
            ok = False
        assert bool(triples(text, kind)) == ok, text
