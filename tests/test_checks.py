"""Rejected rows and observed figures."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from beatwise.sources import checks as c
from beatwise.sources import split_features
from tests.conftest import plan_text

SCHEMA = StructType([StructField(n, StringType()) for n in ("id", "when", "time", "money")])


def rules():
    return {"date": c.bad_date("when"), "time": c.bad_time("time"), "money": c.bad_money("money"), "no id": c.missing("id")}


LINES = ["1;2010 Feb 20 12:00:00 AM;0600;$1,000", "2;2010 Feb 30 12:00:00 AM;2460;$x", "3;;;", "4;short", "5;2010 Feb 20 12:00:00 AM;1;-3.5;more",
         ";2010 Feb 20 12:00:00 AM;2359;$1", "7;2010 Feb 20 12:00:00 AM;2400;", "8;2010 Feb 20 12:00:00 AM;-1;$", "9;never;1160;1e3"]
WANT = {"1": [], "2": ["date", "time", "money"], "3": [], "4": ["malformed"], "5": ["malformed"], None: ["no id"], "7": ["time"],
        "8": ["time", "money"], "9": ["date", "time"]}


@pytest.fixture
def lines(spark, tmp_dir):
    with open(f"{tmp_dir}/lines.csv", "w") as out:
        out.write("id;when;time;money\n" + "\n".join(LINES) + "\n")
    return f"{tmp_dir}/lines.csv"


def by_csv(spark, lines):
    return c.read_csv_checked(spark, lines, SCHEMA, sep=";")


def by_text(spark, lines):
    return c.parse_lines_checked(spark.read.text(lines).filter("value not like 'id;%'"), SCHEMA, sep=";")


@pytest.mark.parametrize("read", [by_csv, by_text])
def test_good_and_rejected_rows_are_the_input(spark, lines, tmp_dir, read):
    rows = c.checked(read(spark, lines), rules())
    assert {r["id"]: r["reasons"] for r in rows.collect()} == WANT
    good, rejected, figures = c.write_checked(rows, f"{tmp_dir}/out")
    assert figures == {"rows": len(LINES), "rejected": 7}
    assert good.columns == SCHEMA.fieldNames() and {r["id"] for r in good.collect()} == {"1", "3"}
    assert {r["id"]: r["reasons"] for r in rejected.collect()} == {k: v for k, v in WANT.items() if v}
    assert {r["_corrupt_record"] for r in rejected.collect()} - {None} == {LINES[3], LINES[4]}
    assert good.count() + rejected.count() == len(LINES)


def test_json_features(spark, tmp_dir):
    schema = StructType([StructField("properties", StructType([StructField("POP20", LongType()), StructField("ZCTA20", StringType())]))])
    doc = {"features": [{"properties": {"POP20": 3, "ZCTA20": "9"}}, {"properties": {"POP20": "x}", "ZCTA20": "8"}}, {"properties": {"POP20": 1}}]}
    with open(f"{tmp_dir}/doc.json", "w") as out:
        json.dump(doc, out)
    parsed = c.parse_json_checked(split_features(spark, f"{tmp_dir}/doc.json"), schema, "feature")
    rows = c.checked(parsed, {"no area": F.col("properties.ZCTA20").isNull()})
    good, rejected, figures = c.write_checked(rows, f"{tmp_dir}/out")
    assert figures == {"rows": 3, "rejected": 2} and good.collect()[0]["properties"]["ZCTA20"] == "9"
    assert sorted(r["reasons"] for r in rejected.collect()) == [["malformed"], ["no area"]]


def test_without_rules_or_rows(spark, tmp_dir):
    empty = spark.createDataFrame([], SCHEMA)
    good, rejected, figures = c.write_checked(c.checked(empty, rules()), f"{tmp_dir}/out")
    assert figures == {"rows": 0, "rejected": 0} and good.count() == rejected.count() == 0
    assert c.checked(spark.createDataFrame([("1", None, None, None)], SCHEMA), {}).first()["reasons"] == []


def test_figures_of_a_write(spark, tmp_dir):
    rows = [(i, None if i % 3 else "x", {"k": i}) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, `a.b` string, m map<string,int>")
    first = c.write_observed(df.repartition(7), f"{tmp_dir}/a")
    assert (first["rows"], first["nulls:a.b"], first["nulls:id"]) == (100, 66, 0)
    back = spark.read.parquet(f"{tmp_dir}/a")
    again = c.write_observed(back.select("id", "`a.b`", "m").coalesce(1), f"{tmp_dir}/b", "json")
    assert again["checksum"] == first["checksum"]
    assert c.write_observed(df.withColumn("id", F.col("id") + 1), f"{tmp_dir}/c")["checksum"] != first["checksum"]
    measured, _ = c.observed(back)
    text = plan_text(measured)
    assert text.count("FileScan") == 1 and "InMemoryTableScan" not in text
