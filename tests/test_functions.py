import math

import pytest

from beatwise.functions import (
    DAY_PART_DEFAULT, bucket_ranges, clean_money, day_part, day_part_py, day_part_udf,
    haversine_km, parse_when,
)


def _one_col(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_day_part_ranges(spark):
    values = ["0459", "0500", "1159", "1160", "1200", "1659", "1660", "1700", "2059", "2100"]
    got = [r[0] for r in _one_col(spark, values).select(day_part("v")).collect()]
    assert got == ["LateNight", "Morning", "Morning", "LateNight", "Afternoon", "Afternoon",
                   "LateNight", "Night", "Night", "LateNight"]


def test_day_part_unparsable_is_default(spark):
    got = [r[0] for r in _one_col(spark, [None, "", "abc", "12.5", " 1200 "]).select(day_part("v")).collect()]
    assert got == ["LateNight"] * 4 + ["Afternoon"]


def test_udf_variant_keeps_python_int_rules(spark):
    values = ["0459", "0500", "1200", "1700", "2100", None, "abc", "12.5", "1_200", " 1200 ",
              "+0600", "-5", "\u0661\u0663\u0660\u0660", "99999999999999999999", "1160", ""]
    df = _one_col(spark, values)
    native = [r[0] for r in df.select(day_part("v")).collect()]
    udf = [r[0] for r in df.select(day_part_udf("v")).collect()]
    assert udf == [day_part_py(v) for v in values]
    # Python's int() accepts '1_200'; the native cast does not.
    assert native[8] == DAY_PART_DEFAULT and udf[8] == "Afternoon"
    assert native[:8] == udf[:8]
    # Arabic-Indic digits: int() reads 1300.
    assert udf[12] == "Afternoon"


def test_bucket_ranges_generic(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (None,)], "v double")
    got = [r[0] for r in df.select(bucket_ranges("v", [("low", 0, 2), ("mid", 2.5, 5)], "other")).collect()]
    assert got == ["low", "mid", "other"]


def test_clean_money(spark):
    got = [r[0] for r in _one_col(spark, ["$52,806", "41000.5", "-", None]).select(clean_money("v")).collect()]
    assert got == [52806.0, 41000.5, None, None]


def test_parse_when(spark):
    import datetime as dt
    values = ["2010 Feb 20 12:00:00 AM", "2020 Sep 01 01:30:00 PM", "02/20/2010", "2010 Feb 2 1:00:00 AM", None]
    got = [r[0] for r in _one_col(spark, values).select(parse_when("v")).collect()]
    assert got[:2] == [dt.datetime(2010, 2, 20, 0, 0), dt.datetime(2020, 9, 1, 13, 30)]
    assert got[2:] == [None, None, None]


def test_haversine(spark):
    df = spark.createDataFrame([(34.0, -118.0, 34.0, -118.0), (0.0, 0.0, 0.0, 180.0)],
                               "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert got[0] == 0.0
    assert got[1] == pytest.approx(math.pi * 6371, rel=1e-12)


def test_haversine_clamps_rounding(spark):
    # Antipodal points: the arcsine argument rounds to just above 1 without the clamp.
    df = spark.createDataFrame([(45.0, 10.0, -45.0, -170.0)], "a double, b double, c double, d double")
    got = df.select(haversine_km("a", "b", "c", "d")).first()[0]
    assert not math.isnan(got) and got == pytest.approx(math.pi * 6371, rel=1e-9)


def test_udf_variant_on_numbers(spark):
    df = spark.createDataFrame([(459,), (600,), (1300,), (1800,), (None,)], "v int")
    got = [r[0] for r in df.select(day_part_udf("v")).collect()]
    assert got == ["LateNight", "Morning", "Afternoon", "Night", "LateNight"]
