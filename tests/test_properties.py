"""Properties whose schema is found in the data."""

import json
import random

import pytest
from pyspark.sql.types import DataType

from beatwise.sources import properties as p


def texts(spark, rows):
    return spark.createDataFrame([(json.dumps(r) if not isinstance(r, str) else r,) for r in rows], "feature string").repartition(3)


def test_schema_of_all_features(spark):
    rows = [{"properties": {"POP20": 3, "ZCTA20": "90001", "mixed": 1, "nested": {"a": 1}, "list": [1, 2]}},
            {"properties": {"POP20": None, "HOUSING20": 2, "mixed": "x", "nested": {"b": "y"}, "list": []}},
            {"properties": {"ZCTA20": "9", "mixed": {"k": [1]}, "none": None, "rate": 0.5}}, {"properties": None}, {}, "no json",
            {"properties": {"rate": 2, "late": True, "two words": 7, "quo'te": "q", "dot.ted": 1, "b\"o'th": 5, "": 6}}]
    out = p.properties_of(texts(spark, rows))
    kinds = dict(out.dtypes)
    assert kinds["POP20"] == kinds["HOUSING20"] == kinds["two words"] == "bigint" and kinds["late"] == "boolean"
    assert kinds["mixed"] == kinds["none"] == kinds["ZCTA20"] == "string" and kinds["rate"].startswith(("decimal", "double"))
    assert out.count() == len(rows)
    got = {r["mixed"]: r for r in out.collect() if r["mixed"] is not None}
    assert set(got) == {"1", "x", '{"k":[1]}'}
    assert got["1"]["POP20"] == 3 and got["1"]["ZCTA20"] == "90001" and got["1"]["list"] == [1, 2] and got["1"]["nested"]["a"] == 1
    assert got["x"]["HOUSING20"] == 2 and got["x"]["POP20"] is None
    last = [r for r in out.collect() if r["late"]][0]
    assert float(last["rate"]) == 2.0 and last["two words"] == 7 and last["quo'te"] == "q" and last["dot.ted"] == 1 and last["b\"o'th"] == 5 and last[""] == 6


@pytest.mark.parametrize("rows", [[], [{}], ["no json"], [{"properties": 3}], [{"properties": {}}]])
def test_no_properties(spark, rows):
    assert p.properties_of(texts(spark, rows)).columns == []


def test_schema_does_not_depend_on_the_order(spark):
    rng = random.Random(1)
    rows = [{"properties": {f"c{rng.randrange(6)}": rng.choice([1, 2.5, "t", None, True])}} for _ in range(200)]
    schemas = {p.properties_of(texts(spark, rng.sample(rows, len(rows)))).schema.simpleString() for _ in range(3)}
    assert len(schemas) == 1


def test_schema_text():
    assert p.variant_schema(None).fields == [] and p.variant_schema("BIGINT").fields == []
    assert p.variant_schema("OBJECT<a: BIGINT, `VARIANT`: VARIANT, o: OBJECT<>, v: VOID, s: ARRAY<OBJECT<x: VOID>>>") == DataType.fromDDL(
        "struct<a: bigint, `VARIANT`: string, o: string, v: string, s: array<struct<x: string>>>")
