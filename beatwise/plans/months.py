"""The busiest months of every year.

Per (year, month) partial + final count (at most 12 groups per year, so the
shuffle is tiny), then ``row_number`` per year with the month as the last
key so ties are resolved the same way on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beatwise.functions.columns import WHEN_TEXT_FORMAT, parse_when
from beatwise.operators.topk import top_k_per_group

TOP_K = 3


def month_counts(occurred: Column, df: DataFrame) -> DataFrame:
    """``(year, month, crime_total)``; unparsed dates form the (null, null) group."""
    return (df.select(F.year(occurred).alias("year"), F.month(occurred).alias("month"))
              .groupBy("year", "month")
              .agg(F.count(F.lit(1)).alias("crime_total")))


def top_months(df: DataFrame, occurred: str | Column = "occurred", k: int = TOP_K,
               drop_unparsed: bool = False) -> DataFrame:
    """``(year, month, crime_total, ranking)``: the ``k`` largest months per year."""
    ts = F.col(occurred) if isinstance(occurred, str) else occurred
    counts = month_counts(ts, df)
    if drop_unparsed:
        counts = counts.filter(F.col("year").isNotNull())
    ranked = top_k_per_group(counts, ["year"], [F.col("crime_total").desc(), F.col("month").asc()], k)
    return ranked.orderBy(F.col("year").asc(), F.col("crime_total").desc(), F.col("month").asc())


def top_months_from_text(df: DataFrame, text_col: str = "DATE OCC", fmt: str = WHEN_TEXT_FORMAT,
                         k: int = TOP_K, drop_unparsed: bool = False) -> DataFrame:
    """Same, parsing the occurrence date from text first."""
    return top_months(df, parse_when(F.col(text_col), fmt), k, drop_unparsed)


def top_months_sql(spark: SparkSession, df: DataFrame, text_col: str = "DATE OCC",
                   fmt: str = WHEN_TEXT_FORMAT, k: int = TOP_K, drop_unparsed: bool = False) -> DataFrame:
    """SQL form: one statement; the input is a view only while it is analysed.

    Dates are parsed once and cut to their month, months are counted, and the
    rank is taken over the few counted rows.
    """
    return spark.sql("""
        WITH dated AS (
            SELECT date_trunc('MONTH', try_to_timestamp({text}, :fmt)) AS first_day FROM {incidents}
        ), counted AS (
            SELECT first_day, count(*) AS crime_total FROM dated
            WHERE first_day IS NOT NULL OR NOT :drop_unparsed
            GROUP BY first_day
        ), placed AS (
            SELECT year(first_day) AS year, month(first_day) AS month, crime_total,
                   row_number() OVER (PARTITION BY year(first_day) ORDER BY crime_total DESC, first_day) AS ranking
            FROM counted
        )
        SELECT * FROM placed WHERE ranking <= :k ORDER BY year, ranking
    """, args={"fmt": fmt, "k": int(k), "drop_unparsed": drop_unparsed}, incidents=df, text=F.col(text_col))
