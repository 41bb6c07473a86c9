"""Column-level functions (all JVM-side except the explicit UDF variant)."""

from beatwise.functions.columns import (
    DAY_PART_DEFAULT,
    DAY_PARTS,
    EARTH_RADIUS_KM,
    WHEN_TEXT_FORMAT,
    bucket_ranges,
    clean_money,
    day_part,
    haversine_km,
    parse_when,
    to_double,
    to_int,
    unit_vector,
)
from beatwise.functions.udfs import day_part_py, day_part_udf

__all__ = [
    "DAY_PARTS", "DAY_PART_DEFAULT", "EARTH_RADIUS_KM", "WHEN_TEXT_FORMAT",
    "bucket_ranges", "clean_money", "day_part", "haversine_km", "parse_when",
    "to_double", "to_int", "unit_vector", "day_part_py", "day_part_udf",
]
