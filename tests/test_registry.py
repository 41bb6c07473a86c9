import re

import pytest

import __spark_entry__ as entry
from beatwise.plans.registry import ORACLE_SQL, QUERIES
from tests.conftest import plan_text
from tools.oracle_check import compare, duckdb_views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF)
    assert "CartesianProduct" not in r["plan"] and "BroadcastNestedLoopJoin" not in r["plan"]
    assert r["columns_match"], r["columns"]
    assert r["match"], (r["only_spark"], r["only_oracle"])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["day_part", "crime_count", "percentage"]
    assert df.count() > 0


def test_plan_shapes(spark):
    q = entry.queries()
    daypart = plan_text(q["daypart_share"](spark, SF))
    assert "EqualTo(event_type,click)" in daypart and "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in daypart
    assert "WindowGroupLimit" in plan_text(q["top_months"](spark, SF))
    for name in ("income_join_merge", "income_join_shuffle_hash"):
        node = {"income_join_merge": "SortMergeJoin", "income_join_shuffle_hash": "ShuffledHashJoin"}[name]
        text = plan_text(q[name](spark, SF))
        assert node in text
        # The aggregate's shuffle on the postal code also serves the join:
        # one exchange per side, none added for the join.
        assert text.count("Exchange hashpartitioning") == 2
    for name in ("station_load", "station_load_sql", "station_load_suppliers"):
        text = plan_text(q[name](spark, SF))
        assert "NestedLoop" not in text and "CartesianProduct" not in text
        assert name == "station_load_suppliers" or "Join" not in text  # few sites: one array, measured as a whole


@pytest.mark.parametrize("name,columns", [
    ("daypart_share_udf_csv", ["TIME OCC", "Premis Desc"]), ("top_months_csv", ["DATE OCC"]),
    ("top_months_sql_csv", ["DATE OCC"]), ("station_load_csv", ["DR_NO", "LAT", "LON"])])
def test_csv_scans_read_few_of_28_columns(spark, name, columns):
    text = plan_text(QUERIES[name](spark, SF))
    schemas = re.findall(r"FileScan csv .*?ReadSchema: struct<(.*?)>", text)
    assert schemas and all([c.split(":")[0] for c in x.split(",")] == columns for x in schemas)


def test_sql_forms_leave_no_views(spark):
    QUERIES["top_months_sql"](spark, SF)
    QUERIES["station_load_sql"](spark, SF)
    assert not [t for t in spark.catalog.listTables() if t.isTemporary]


@pytest.mark.parametrize("name", ["daypart_share", "daypart_share_csv", "top_months_parsed", "top_months_sql"])
def test_time_queries_do_not_depend_on_session_time_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        r = compare(spark, con, name, SF)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r["match"], (r["only_spark"], r["only_oracle"])


def test_global_total_reuses_the_grouped_shuffle(spark):
    # The scalar-subquery total reads the same grouped exchange as the main
    # query, so the source is scanned once.
    df = entry.queries()["daypart_total"](spark, SF)
    df.collect()
    assert "ReusedExchange" in plan_text(df)
