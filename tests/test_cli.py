"""The command line over tiny files in the public input formats."""

import json
import os

import pytest

from beatwise import cli
from beatwise.schemas import INCIDENT_COLUMNS


def _incident_line(dr, date, time, premise, lat, lon):
    values = dict.fromkeys(INCIDENT_COLUMNS, "")
    values.update({"DR_NO": dr, "DATE OCC": date, "TIME OCC": time, "Premis Desc": premise,
                   "LAT": lat, "LON": lon})
    return ",".join(values[c] for c in INCIDENT_COLUMNS)


@pytest.fixture
def files(tmp_dir):
    header = ",".join(INCIDENT_COLUMNS)
    a = [_incident_line("1", "2010 Jan 05 10:00:00 AM", "0600", "STREET", "34.05", "-118.25"),
         _incident_line("2", "2010 Jan 06 10:00:00 AM", "1300", "STREET", "34.10", "-118.30"),
         _incident_line("3", "2010 Feb 06 10:00:00 AM", "2300", "PARK", "0", "0")]
    b = [_incident_line("4", "2011 Mar 01 01:00:00 PM", "0700", "STREET", "34.20", "-118.40")]
    for name, rows in (("a.csv", a), ("b.csv", b)):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write("\n".join([header, *rows]) + "\n")
    with open(os.path.join(tmp_dir, "stations.csv"), "w") as f:
        f.write("X,Y,FID,DIVISION,LOCATION,PREC\n-118.25,34.05,1,Central,x,1\n-118.40,34.20,2,West,y,2\n")
    with open(os.path.join(tmp_dir, "income.csv"), "w") as f:
        f.write("Zip Code;Community;Estimated Median Income\n90001;A;$50,000\n90002;B;$1,000\n")
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"ZCTA20": "90001", "POP20": 10, "HOUSING20": 4, "NAME": "n"},
         "geometry": {"type": "Polygon", "coordinates": [[["-118.1", "34.0"], ["-118.2", "34.1"]]]}},
        {"type": "Feature", "properties": {"ZCTA20": "90001", "POP20": 30, "HOUSING20": 16},
         "geometry": None},
        {"type": "Feature", "properties": {"ZCTA20": "90002", "POP20": 0, "HOUSING20": 3}, "geometry": None}]}
    with open(os.path.join(tmp_dir, "blocks.geojson"), "w") as f:
        json.dump(doc, f, indent=2)
    return tmp_dir


def test_cli_daypart(spark, files):
    args = ["daypart", "--incidents", f"{files}/a.csv", f"{files}/b.csv", "--output", f"{files}/q1"]
    rows = {r.day_part: r.crime_count for r in cli.main(args)}
    assert rows == {"Morning": 2, "Afternoon": 1}
    udf = {r.day_part: r.crime_count for r in cli.main([*args[:-1], f"{files}/q1u", "--udf"])}
    assert udf == rows
    text = cli.main(["daypart", "--incidents", f"{files}/*.csv", "--incident-format", "text",
                     "--output", f"{files}/q1t", "--single-file"])
    assert sorted(r.day_part for r in text) == ["Afternoon", "Morning"]
    assert any(p.endswith(".csv") for p in os.listdir(f"{files}/q1"))


def test_cli_top_months(spark, files):
    base = ["top-months", "--incidents", f"{files}/a.csv", f"{files}/b.csv"]
    rows = [tuple(r) for r in cli.main([*base, "--output", f"{files}/q2"])]
    assert rows == [(2010, 1, 2, 1), (2010, 2, 1, 2), (2011, 3, 1, 1)]
    assert [tuple(r) for r in cli.main([*base, "--sql", "--output", f"{files}/q2s"])] == rows


def test_cli_income(spark, files):
    base = ["income", "--census", f"{files}/blocks.geojson", "--income", f"{files}/income.csv"]
    rows = [tuple(r) for r in cli.main([*base, "--output", f"{files}/q3"])]
    assert rows == [("90001", 25000.0)]
    for extra in (["--join", "merge"], ["--join", "shuffle_hash"], ["--text"], ["--census-format", "ranges"], ["--census-format", "inferred"]):
        assert [tuple(r) for r in cli.main([*base, *extra, "--output", f"{files}/q3x"])] == rows


def test_cli_census_convert(spark, files):
    cli.main(["convert", "--census", f"{files}/blocks.geojson", "--output", f"{files}/census"])
    rows = cli.main(["income", "--census", f"{files}/census", "--census-format", "parquet",
                     "--income", f"{files}/income.csv", "--output", f"{files}/q3p"])
    assert [tuple(r) for r in rows] == [("90001", 25000.0)]
    with pytest.raises(SystemExit):
        cli.main(["convert", "--output", f"{files}/x"])


def test_cli_drop_unparsed(spark, files):
    with open(f"{files}/a.csv", "a") as f:
        f.write(_incident_line("9", "never", "0600", "STREET", "34", "-118") + "\n")
    base = ["top-months", "--incidents", f"{files}/a.csv", "--output", f"{files}/q2d"]
    for form in ([], ["--sql"]):
        assert None in {r.year for r in cli.main([*base, *form])}
        assert None not in {r.year for r in cli.main([*base, *form, "--drop-unparsed"])}


def test_cli_stations_and_convert(spark, files, capsys):
    base = ["stations", "--incidents", f"{files}/a.csv", f"{files}/b.csv", "--stations", f"{files}/stations.csv"]
    rows = {r.DIVISION: r.num_of_crimes for r in cli.main([*base, "--output", f"{files}/q4"])}
    assert rows == {"Central": 2, "West": 1}
    sql = {r.DIVISION: r.num_of_crimes for r in cli.main([*base, "--sql", "--float", "--output", f"{files}/q4s"])}
    assert sql == rows
    capsys.readouterr()
    cli.main(["convert", "--incidents", f"{files}/a.csv", f"{files}/b.csv", "--output", f"{files}/pq"])
    said = dict(x.split("=", 1) for x in capsys.readouterr().out.splitlines() if "=" in x)
    assert int(said["rows"]) == spark.read.parquet(f"{files}/pq").count() and int(said["nulls:DR_NO"]) == 0
    by_records = cli.main(["daypart", "--incidents", f"{files}/a.csv", f"{files}/b.csv", "--incident-format", "records",
                           "--output", f"{files}/q1r"])
    from_parquet = cli.main(["daypart", "--incidents", f"{files}/pq", "--incident-format", "parquet",
                             "--output", f"{files}/q1p"])
    assert {r.day_part: r.crime_count for r in from_parquet} == {"Morning": 2, "Afternoon": 1}
    assert by_records == from_parquet
