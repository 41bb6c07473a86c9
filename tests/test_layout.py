"""Partitioned and bucketed tables."""

import pytest
from pyspark.sql import functions as F

from beatwise.plans.registry import QUERIES
from beatwise.sources.layout import write_bucketed, write_partitioned
from tests.conftest import plan_text

SF = "/root/testdata/sf0.001"


def test_one_value_is_written_anew_and_the_others_stay(spark, tmp_dir):
    path = f"{tmp_dir}/by_year"
    rows = spark.range(3000).select((2010 + F.col("id") % 3).alias("year"), "id", F.lit("old").alias("kind"))
    write_partitioned(rows, path, "year")
    fresh = spark.range(5).select(F.lit(2011).cast("long").alias("year"), "id", F.lit("new").alias("kind"))
    write_partitioned(fresh, path, "year")
    got = {(r["year"], r["kind"]): r["count"] for r in spark.read.parquet(path).groupBy("year", "kind").count().collect()}
    assert got == {(2010, "old"): 1000, (2011, "new"): 5, (2012, "old"): 1000}
    with pytest.raises(ValueError):
        write_partitioned(fresh, path)


def test_a_filter_reads_one_folder(spark):
    text = plan_text(QUERIES["daypart_share_partitioned"](spark, SF))
    assert "PartitionFilters: [isnotnull(Premis Desc" in text and "= click" in text.split("PartitionFilters")[1][:120]


def test_buckets_are_summed_and_joined_without_a_shuffle(spark):
    text = plan_text(QUERIES["income_bucketed"](spark, SF))
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_buckets_hold_all_rows(spark, tmp_dir):
    name = write_bucketed(spark.range(1000).withColumn("k", F.when(F.col("id") % 2 == 0, 1)), f"{tmp_dir}/t", "k", buckets=4)
    back = spark.table(name)
    assert back.count() == 1000 and back.filter("k is null").count() == 500
    spark.sql(f"DROP TABLE {name}")
