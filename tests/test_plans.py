import pytest
from pyspark.sql import functions as F

from beatwise.plans import daypart, income, months, stations
from beatwise.schemas import CENSUS_DOC_SCHEMA
from tests.conftest import plan_text


def _incidents(spark, rows):
    return spark.createDataFrame(rows, "`Premis Desc` string, `TIME OCC` string")


def test_daypart_share_forms(spark):
    rows = [("STREET", t) for t in ["0600", "0700", "1300", "1800", "2300", None]] + [("PARK", "0600")]
    df = _incidents(spark, rows)
    share = daypart.daypart_share(df, "STREET").collect()
    assert [r.day_part for r in share] == ["LateNight", "Morning", "Afternoon", "Night"]  # equal shares by label
    assert {r.day_part: r.crime_count for r in share} == {"Morning": 2, "Afternoon": 1, "Night": 1, "LateNight": 2}
    assert sum(r.percentage for r in share) == pytest.approx(100)
    udf = {r.day_part: r.percentage for r in daypart.daypart_share_udf(df, "STREET").collect()}
    scaled = daypart.daypart_share_scaled(df, "STREET")
    assert scaled.columns == ["day_part", "percentage"]
    for r in scaled.collect():
        assert r.percentage == pytest.approx(udf[r.day_part])


def test_daypart_filter_reaches_scan(spark, tmp_dir):
    _incidents(spark, [("STREET", "0600")]).write.parquet(f"{tmp_dir}/inc")
    out = daypart.daypart_share(spark.read.parquet(f"{tmp_dir}/inc"), "STREET")
    text = plan_text(out)
    assert "EqualTo(`Premis Desc`,STREET)" in text
    assert "ReadSchema: struct<Premis Desc:string,TIME OCC:string>" in text


def test_top_months_tie_break_and_null_group(spark):
    dates = (["2010 Jan 05 10:00:00 AM"] * 5 + ["2010 Feb 05 10:00:00 AM"] * 5
             + ["2010 Mar 05 10:00:00 AM"] * 4 + ["2010 Apr 05 10:00:00 AM"] * 4 + ["garbage"] * 2)
    df = spark.createDataFrame([(d,) for d in dates], "`DATE OCC` string")
    got = [tuple(r) for r in months.top_months_from_text(df).collect()]
    assert got == [(None, None, 2, 1), (2010, 1, 5, 1), (2010, 2, 5, 2), (2010, 3, 4, 3)]
    sql = [tuple(r) for r in months.top_months_sql(spark, df).collect()]
    assert sql == got
    dropped = months.top_months(df.select(F.try_to_timestamp("DATE OCC", F.lit("yyyy MMM dd hh:mm:ss a"))
                                          .alias("occurred")), drop_unparsed=True)
    assert [r.month for r in dropped.collect()] == [1, 2, 3]


def _docs(spark, features):
    return spark.createDataFrame([({"features": [{"properties": f} for f in features]},)],
                                 f"d struct<{CENSUS_DOC_SCHEMA.simpleString()[7:-1]}>").select("d.*")


def test_income_semantics(spark):
    docs = _docs(spark, [
        {"ZCTA20": "90001", "POP20": 10, "HOUSING20": 4}, {"ZCTA20": "90001", "POP20": 30, "HOUSING20": 16},
        {"ZCTA20": None, "POP20": 5, "HOUSING20": 5},
        {"ZCTA20": "90002", "POP20": 0, "HOUSING20": 3},
        {"ZCTA20": "90003", "POP20": 7, "HOUSING20": None},
        {"ZCTA20": "90004", "POP20": 10, "HOUSING20": 5},
    ])
    inc = spark.createDataFrame([("90001", "A", "$50,000"), ("90002", "B", "$1"), ("90003", "C", "$2,000"),
                                 ("90004", "D", "-"), ("90004", "D2", "$10"), ("90001", "A2", "$100")],
                                "Zip_Code string, Community string, Estimated_Median_Income string")
    got = sorted((r.Zip_Code, r.per_person_income) for r in income.income_per_person(docs, inc).collect())
    # 90001: (40 pop, 20 housing) twice via the duplicated income row; 90002 no population;
    # 90003 all-null housing keeps a null; 90004 '-' income dropped.
    assert got == sorted([("90001", 25000.0), ("90001", 50.0), ("90003", None), ("90004", 5.0)],
                         key=lambda t: (t[0], t[1] or 0))


def test_income_lenient_form(spark):
    docs = _docs(spark, [{"ZCTA20": "90003", "POP20": 7, "HOUSING20": None},
                         {"ZCTA20": "90005", "POP20": 10, "HOUSING20": 5}])
    fields = spark.createDataFrame([("90003", "C", "$2,000"), ("90005", "E", "12.5"), ("90005", "E", " $40 ")],
                                   "Zip_Code string, Community string, Estimated_Median_Income string")
    got = sorted((r.Zip_Code, r.per_person_income) for r in income.income_per_person_lenient(docs, fields).collect())
    # Missing housing counts as 0; '12.5' is not digits-only and is skipped.
    assert got == [("90003", 0.0), ("90005", 20.0)]


def test_station_load_invariants(spark):
    pts = spark.createDataFrame([(i, 34.0 + i * 0.01, -118.0 - i * 0.01) for i in range(1, 60)] + [(1, 34.5, -118.5)],
                                "DR_NO long, LAT double, LON double")
    sts = spark.createDataFrame([("N", "0", "0"), ("A", "-118.05", "34.05"), ("B", "-118.45", "34.45")],
                                "DIVISION string, X string, Y string")
    got = stations.station_load(pts, sts).collect()
    assert sum(r.num_of_crimes for r in got) == 59
    assert [r.num_of_crimes for r in got] == sorted((r.num_of_crimes for r in got), reverse=True)
    # The zero station is a real site unless dropped; the SQL form drops it.
    sql = {r.DIVISION: r.num_of_crimes for r in stations.station_load_sql(spark, pts, sts).collect()}
    assert "N" not in sql and sum(sql.values()) == 59
