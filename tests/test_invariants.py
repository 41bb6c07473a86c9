"""Invariants and cross-variant agreement on the sf0.01 test tables."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"


def _rows(spark, name):
    return [tuple(r) for r in entry.queries()[name](spark, SF).collect()]


def test_shares_sum_to_100_and_variants_agree(spark):
    base = sorted(_rows(spark, "daypart_share"))
    assert sum(r[2] for r in base) == pytest.approx(100.0)
    for name in ("daypart_share_udf", "daypart_share_csv", "daypart_share_parquet"):
        assert sorted(_rows(spark, name)) == base
    scaled = dict(_rows(spark, "daypart_share_text"))
    assert scaled == pytest.approx({r[0]: r[2] for r in base}, rel=1e-12)


def test_ranks_run_one_to_three_per_year(spark):
    rows = _rows(spark, "top_months")
    years = {r[0] for r in rows}
    assert sorted((r[0], r[3]) for r in rows) == sorted((y, k) for y in years for k in (1, 2, 3))
    for y in years:
        totals = [r[2] for r in sorted((r for r in rows if r[0] == y), key=lambda r: r[3])]
        assert totals == sorted(totals, reverse=True)
    assert sorted(_rows(spark, "top_months_parsed")) == sorted(rows)
    assert sorted(_rows(spark, "top_months_sql")) == sorted(rows)


def test_income_variants_agree(spark):
    base = sorted(_rows(spark, "income_per_person"))
    for name in ("income_join_merge", "income_join_shuffle_hash", "income_join_broadcast", "income_from_text"):
        assert sorted(_rows(spark, name)) == base


def test_station_counts_cover_every_located_incident(spark):
    customers = spark.read.parquet(f"{SF}/customer.parquet").count()
    for name in ("station_load", "station_load_sql", "station_load_float", "station_load_suppliers"):
        rows = _rows(spark, name)
        assert sum(r[2] for r in rows) == customers, name
        assert [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True)
    assert sorted(_rows(spark, "station_load")) == sorted(_rows(spark, "station_load_sql"))
