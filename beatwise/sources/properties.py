"""Feature properties without a given schema.

The properties of all features are parsed to VARIANT; one aggregate over them
gives the schema that fits every value (names, and the narrowest type that
holds all values of a name), with partial results in every task.

Types: whole numbers are ``bigint``, numbers with a fraction ``decimal`` or
``double``, objects and arrays keep their structure.  Values of a name that no
one type holds are ``string``, as JSON text where they are not text themselves;
so is a name that is null in every feature.  A feature without an object of
properties has null in every column; a missing property is null; a text that
is no JSON is a feature without properties.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from beatwise.sources.features import split_features

#: A name in backticks, or what the aggregate calls an object, or a value without one type.
_TOKEN = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<>|\bOBJECT\b|\bVARIANT\b|\bVOID\b")
_WORDS = {"OBJECT<>": "STRING", "OBJECT": "STRUCT", "VARIANT": "STRING", "VOID": "STRING"}


def variant_schema(text: str | None) -> StructType:
    """Struct type of an aggregated VARIANT schema such as ``OBJECT<a: BIGINT, b: VARIANT>``; empty if it is no object."""
    if not text or not text.startswith("OBJECT<") or text == "OBJECT<>":
        return StructType()
    found = DataType.fromDDL(_TOKEN.sub(lambda m: _WORDS.get(m[0], m[0]), text))
    return found if isinstance(found, StructType) else StructType()


def properties_of(features: DataFrame, feature: str = "feature", field: str = "properties") -> DataFrame:
    """Properties of JSON texts of features as columns, with the schema that all of them have together."""
    parsed = features.select(F.variant_get(F.try_parse_json(feature), f"$.{field}", "variant").alias("v"))
    schema = variant_schema(parsed.agg(F.schema_of_variant_agg("v")).first()[0])  # one line of text
    if not len(schema):
        return features.select()
    return parsed.select(*[_value(f.name, f.dataType.simpleString()).alias(f.name) for f in schema.fields])


def _value(name: str, kind: str) -> Column:
    """One property; null where there are none, or no such one."""
    if name and not ("'" in name and '"' in name):  # what a path can say
        quote = '"' if "'" in name else "'"
        return F.try_variant_get("v", f"$[{quote}{name}{quote}]", kind)
    held = F.try_variant_get("v", "$", "map<string,variant>")
    return F.try_variant_get(F.try_element_at(held, F.lit(name)), "$", kind)


def read_properties(spark: SparkSession, path: str) -> DataFrame:
    """Properties of the feature collections at ``path`` as columns; no schema is given."""
    return properties_of(split_features(spark, path))
