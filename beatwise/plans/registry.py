"""Registered queries over the bundled test tables, and their SQL oracles.

Every query reads whole tables from ``sf_dir`` (or files Spark writes from
them into the shared checkpoint folder) and returns a DataFrame.  Each
``ORACLE_SQL`` entry is the same computation written for DuckDB over the
raw tables; column names match the Spark result.  Means of distances are
rounded to 6 decimals on both sides: the mean itself is exact here, but the
engines' trigonometric functions differ in the last digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from beatwise.functions.columns import haversine_km
from beatwise.plans import daypart, income, months, stations
from beatwise.schemas import CENSUS_DOC_SCHEMA, INCIDENT_SCHEMA, INCOME_SCHEMA
from beatwise.session import staging_path
from beatwise.sources import checks, layout, readers, sinks, testdata
from beatwise.sources.features import read_features
from beatwise.sources.properties import read_properties
from beatwise.sources.records import read_csv_records

Query = Callable[[SparkSession, str], DataFrame]

STREET = testdata.STREET_EVENT_TYPE
# Reference-shaped incident columns written to the CSV / text sources.
INCIDENT_TEXT_SCHEMA = StructType([StructField(c, StringType())
                                   for c in ("DR_NO", "DATE OCC", "TIME OCC", "Premis Desc")])
ROUND_DIGITS = 6

_staged: dict[tuple[str, str, str], str] = {}
# Catalog names of the bucketed tables, by their folder.
_tables: dict[str, str] = {}


def _stage(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]) -> str:
    """Write a derived input once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _staged:
        path = staging_path(spark, name)
        write(path)
        _staged[key] = path
    return _staged[key]


# ---------------------------------------------------------------- day parts

def _incident_csv_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """Incidents written as two CSV folders (first / second half of each month)."""
    def write(path: str) -> None:
        rows = testdata.incidents_from_events(spark, sf_dir, keep_ts=True)
        first = F.coalesce(F.dayofmonth("occurred") <= 15, F.lit(False))
        sinks.write_csv(rows.filter(first).drop("occurred"), f"{path}/first")
        sinks.write_csv(rows.filter(~first).drop("occurred"), f"{path}/second")
    base = _stage(spark, sf_dir, "incidents-csv", write)
    return [f"{base}/first", f"{base}/second"]


def _full_csv(spark: SparkSession, sf_dir: str, name: str, rows: Callable[[], DataFrame]) -> DataFrame:
    """Incidents staged as a CSV of all 28 columns, read with the published schema."""
    path = _stage(spark, sf_dir, f"{name}-28-columns", lambda p: sinks.write_csv(testdata.full_incidents(rows()), p))
    return readers.read_csv(spark, path, INCIDENT_SCHEMA)


def _events_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_csv(spark, sf_dir, "events", lambda: testdata.incidents_from_events(spark, sf_dir))


def _orders_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_csv(spark, sf_dir, "orders", lambda: testdata.dated_orders(spark, sf_dir).drop("occurred"))


def _points_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_csv(spark, sf_dir, "points", lambda: testdata.incident_points(spark, sf_dir))


def daypart_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daypart.daypart_share(testdata.incidents_from_events(spark, sf_dir), STREET)


def daypart_share_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daypart.daypart_share_udf(testdata.incidents_from_events(spark, sf_dir), STREET)


def daypart_share_udf_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daypart.daypart_share_udf(_events_csv(spark, sf_dir), STREET)


def daypart_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daypart.daypart_share_scaled(testdata.incidents_from_events(spark, sf_dir), STREET)


def daypart_share_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _incident_csv_files(spark, sf_dir)
    return daypart.daypart_share(readers.read_csv(spark, files, INCIDENT_TEXT_SCHEMA), STREET)


def daypart_share_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = [f"{p}/*.csv" for p in _incident_csv_files(spark, sf_dir)]
    rows = readers.read_csv_lines(spark, files, INCIDENT_TEXT_SCHEMA)
    return daypart.daypart_share_scaled(rows, STREET)


def daypart_share_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _incident_csv_files(spark, sf_dir)
    path = _stage(spark, sf_dir, "incidents-parquet", lambda p: sinks.write_parquet(
        readers.read_csv(spark, files, INCIDENT_TEXT_SCHEMA), p))
    return daypart.daypart_share(readers.read_parquet(spark, path), STREET)


def daypart_share_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents whose locations hold quotes and line breaks, from a text scan of the 28-column CSV."""
    path = _stage(spark, sf_dir, "incidents-quoted", lambda p: sinks.write_csv(testdata.with_line_breaks(
        testdata.full_incidents(testdata.incidents_from_events(spark, sf_dir))), p))
    return daypart.daypart_share(read_csv_records(spark, path, INCIDENT_SCHEMA), STREET)


def daypart_share_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents laid out by premise: the filter picks a folder."""
    path = _stage(spark, sf_dir, "incidents-by-premise", lambda p: layout.write_partitioned(
        testdata.incidents_from_events(spark, sf_dir), p, "Premis Desc"))
    return daypart.daypart_share(readers.read_parquet(spark, path), STREET)


def parquet_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stage(spark, sf_dir, "orders-parquet",
                  lambda p: sinks.write_parquet(testdata.table(spark, sf_dir, "orders"), p))
    return readers.read_parquet(spark, path)


# ------------------------------------------------------------------ months

def top_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return months.top_months(testdata.dated_orders(spark, sf_dir), "occurred")


def top_months_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return months.top_months_from_text(testdata.dated_orders(spark, sf_dir), "DATE OCC")


def top_months_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return months.top_months_sql(spark, testdata.dated_orders(spark, sf_dir), "DATE OCC")


def top_months_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return months.top_months_from_text(_orders_csv(spark, sf_dir), "DATE OCC")


def top_months_sql_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return months.top_months_sql(spark, _orders_csv(spark, sf_dir), "DATE OCC")


# ------------------------------------------------------------------ income

def _census_docs(spark: SparkSession, sf_dir: str) -> str:
    return _stage(spark, sf_dir, "census-docs", lambda p: sinks.write_feature_docs(
        testdata.census_features(spark, sf_dir), p, key_col="key",
        rows=testdata.table(spark, sf_dir, "customer").count()))


def _income_csv(spark: SparkSession, sf_dir: str) -> str:
    return _stage(spark, sf_dir, "income-csv", lambda p: sinks.write_csv(
        testdata.income_rows(spark, sf_dir), p, sep=";"))


def _income_query(strategy: str | None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = readers.read_feature_docs(spark, _census_docs(spark, sf_dir), CENSUS_DOC_SCHEMA)
        inc = readers.read_csv(spark, _income_csv(spark, sf_dir), INCOME_SCHEMA, sep=";")
        return income.income_per_person(docs, inc, strategy)
    return run


def income_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = readers.read_feature_docs_text(spark, _census_docs(spark, sf_dir), CENSUS_DOC_SCHEMA)
    fields = readers.read_delimited_fields(
        spark, f"{_income_csv(spark, sf_dir)}/*.csv", INCOME_SCHEMA.fieldNames(), sep=";",
        header_first_field="Zip_Code")
    return income.income_per_person_lenient(docs, fields)


def income_per_person_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census documents ingested once to Parquet, then queried."""
    docs = _census_docs(spark, sf_dir)
    path = _stage(spark, sf_dir, "census-parquet",
                  lambda p: readers.ingest_census(spark, docs, CENSUS_DOC_SCHEMA, p))
    inc = readers.read_csv(spark, _income_csv(spark, sf_dir), INCOME_SCHEMA, sep=";")
    return income.income_per_person_flat(readers.read_parquet(spark, path), inc)


def income_per_person_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census documents read by byte ranges, many tasks a document."""
    feature = CENSUS_DOC_SCHEMA["features"].dataType.elementType
    features = read_features(spark, _census_docs(spark, sf_dir), feature).select("properties.*")
    inc = readers.read_csv(spark, _income_csv(spark, sf_dir), INCOME_SCHEMA, sep=";")
    return income.income_per_person_flat(features, inc)


def income_per_person_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census properties with the schema that the features themselves have."""
    inc = readers.read_csv(spark, _income_csv(spark, sf_dir), INCOME_SCHEMA, sep=";")
    return income.income_per_person_flat(read_properties(spark, _census_docs(spark, sf_dir)), inc)


def income_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census and income in sorted buckets of the postal code: summed and joined without a shuffle."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs, money = _census_docs(spark, sf_dir), _income_csv(spark, sf_dir)
    tables: dict[str, str] = {}

    def table(name: str, key: str, rows: Callable[[], DataFrame]) -> DataFrame:
        def write(path: str) -> None:
            tables[name] = layout.write_bucketed(rows(), path, key, buckets)
        path = _stage(spark, sf_dir, f"{name}-{buckets}-buckets", write)
        return spark.table(_tables.setdefault(path, tables.get(name, "")))

    features = table("census", income.ZIP, lambda: income.census_from_docs(
        readers.read_feature_docs(spark, docs, CENSUS_DOC_SCHEMA)))
    inc = table("income", "Zip_Code", lambda: readers.read_csv(spark, money, INCOME_SCHEMA, sep=";"))
    return income.income_per_person_flat(features, inc, "merge")


def income_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer balances as ``;`` lines of which some are short or hold no money: rows per reason, and good ones."""
    path = _stage(spark, sf_dir, "balances-broken", lambda p: testdata.broken_balance_lines(spark, sf_dir).write.text(p))
    rows = checks.checked(checks.read_csv_checked(spark, path, INCOME_SCHEMA, sep=";", header=False),
                          {"money": checks.bad_money("Estimated_Median_Income")})
    good, rejected, _ = checks.write_checked(rows, staging_path(spark, "balances-checked"))
    counts = good.select(F.lit("good").alias("reason")).unionByName(rejected.select(F.explode("reasons").alias("reason")))
    return counts.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def income_csv_semicolon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``;`` money-table reader and cleaning, on customer balances (grows with the data)."""
    path = _stage(spark, sf_dir, "balances-csv", lambda p: sinks.write_csv(
        testdata.balance_rows(spark, sf_dir), p, sep=";"))
    return income.clean_income(readers.read_csv(spark, path, INCOME_SCHEMA, sep=";"))


# ---------------------------------------------------------------- stations

def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("average_distance", F.round("average_distance", ROUND_DIGITS))


def station_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stations.station_load(testdata.incident_points(spark, sf_dir),
                                          testdata.station_sites(spark, sf_dir)))


def station_load_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stations.station_load(testdata.incident_points(spark, sf_dir),
                                          testdata.station_sites(spark, sf_dir), coord_kind="float"))


def station_load_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stations.station_load_sql(spark, testdata.incident_points(spark, sf_dir),
                                              testdata.station_sites(spark, sf_dir)))


def station_load_sql_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stations.station_load_sql(spark, testdata.incident_points(spark, sf_dir),
                                              testdata.station_sites(spark, sf_dir), coord_type="FLOAT"))


def station_load_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stations.station_load(_points_csv(spark, sf_dir), testdata.station_sites(spark, sf_dir)))


def station_load_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stations.station_load(testdata.incident_points(spark, sf_dir),
                                          testdata.supplier_sites(spark, sf_dir)))


def haversine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of every supplier to the station of its own nation (an equi-join)."""
    sta = testdata.station_sites(spark, sf_dir)
    k = F.col("s_suppkey")
    located = testdata.table(spark, sf_dir, "supplier").select(
        k, "s_nationkey", testdata.synthetic_lat(k).alias("lat"), testdata.synthetic_lon(k).alias("lon"))
    joined = located.join(sta, located["s_nationkey"] == sta["FID"])
    return joined.select(
        "s_suppkey", "DIVISION",
        F.round(haversine_km("lat", "lon", "Y", "X"), ROUND_DIGITS).alias("distance_km"))


QUERIES: dict[str, Query] = {
    "daypart_share": daypart_share,
    "daypart_share_udf": daypart_share_udf,
    "daypart_share_udf_csv": daypart_share_udf_csv,
    "daypart_total": daypart_total,
    "daypart_share_csv": daypart_share_csv,
    "daypart_share_text": daypart_share_text,
    "daypart_share_parquet": daypart_share_parquet,
    "daypart_share_quoted": daypart_share_quoted,
    "daypart_share_partitioned": daypart_share_partitioned,
    "parquet_rewrite": parquet_rewrite,
    "top_months": top_months,
    "top_months_parsed": top_months_parsed,
    "top_months_sql": top_months_sql,
    "top_months_csv": top_months_csv,
    "top_months_sql_csv": top_months_sql_csv,
    "income_per_person": _income_query(None),
    "income_join_merge": _income_query("merge"),
    "income_join_shuffle_hash": _income_query("shuffle_hash"),
    "income_join_broadcast": _income_query("broadcast"),
    "income_per_person_parquet": income_per_person_parquet,
    "income_per_person_ranges": income_per_person_ranges,
    "income_per_person_inferred": income_per_person_inferred,
    "income_bucketed": income_bucketed,
    "income_rejected": income_rejected,
    "income_from_text": income_from_text,
    "income_csv_semicolon": income_csv_semicolon,
    "station_load": station_load,
    "station_load_float": station_load_float,
    "station_load_sql": station_load_sql,
    "station_load_sql_float": station_load_sql_float,
    "station_load_csv": station_load_csv,
    "station_load_suppliers": station_load_suppliers,
    "haversine_pairs": haversine_pairs,
}


# ------------------------------------------------------------ SQL oracles

_DAYPART_COUNTS = """
    SELECT day_part, COUNT(*) AS crime_count
    FROM (
        SELECT CASE WHEN t BETWEEN 500 AND 1159 THEN 'Morning'
                    WHEN t BETWEEN 1200 AND 1659 THEN 'Afternoon'
                    WHEN t BETWEEN 1700 AND 2059 THEN 'Night'
                    ELSE 'LateNight' END AS day_part
        FROM (SELECT TRY_CAST(strftime(ts, '%H%M') AS INTEGER) AS t
              FROM events WHERE event_type = 'click')
    )
    GROUP BY day_part
"""

_DAYPART_SHARE = f"""
    WITH g AS ({_DAYPART_COUNTS})
    SELECT day_part, crime_count,
           CAST(crime_count AS DOUBLE) / CAST(SUM(crime_count) OVER () AS DOUBLE) * 100 AS percentage
    FROM g ORDER BY percentage DESC
"""

_DAYPART_SCALED = f"""
    WITH g AS ({_DAYPART_COUNTS})
    SELECT day_part,
           CAST(100 * crime_count AS DOUBLE) / CAST((SELECT SUM(crime_count) FROM g) AS DOUBLE) AS percentage
    FROM g ORDER BY percentage DESC
"""

# A month's rank is one more than the number of months of its year that beat it.
_TOP_MONTHS = """
    WITH m AS (
        SELECT date_part('year', o_orderdate)::INTEGER AS year, date_part('month', o_orderdate)::INTEGER AS month,
               COUNT(*) AS crime_total
        FROM orders GROUP BY ALL)
    SELECT m.year, m.month, m.crime_total, (1 + COUNT(b.month))::INTEGER AS ranking
    FROM m LEFT JOIN m AS b
      ON b.year = m.year AND (b.crime_total > m.crime_total
                              OR (b.crime_total = m.crime_total AND b.month < m.month))
    GROUP BY ALL HAVING COUNT(b.month) < 3
"""

_INCOME = """
    WITH oc AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey),
    f AS (SELECT CAST(c.c_nationkey AS VARCHAR) AS zcta, COALESCE(oc.n, 0) AS pop, 1 AS housing
          FROM customer c LEFT JOIN oc ON c.c_custkey = oc.o_custkey),
    z AS (SELECT zcta, SUM(housing) AS housing, SUM(pop) AS pop FROM f
          WHERE zcta IS NOT NULL GROUP BY zcta HAVING SUM(pop) > 0),
    inc AS (SELECT CAST(n_nationkey AS VARCHAR) AS zip,
                   CAST(n_nationkey * 1234 + 20000 AS DOUBLE) AS income FROM nation)
    SELECT inc.zip AS Zip_Code, inc.income * z.housing / z.pop AS per_person_income
    FROM z JOIN inc ON z.zcta = inc.zip
"""

_INCOME_TABLE = """
    SELECT CAST(c_custkey AS VARCHAR) AS Zip_Code, c_name AS Community,
           c_acctbal AS Estimated_Median_Income
    FROM customer
"""

_INCOME_REJECTED = """
    SELECT CASE WHEN c_custkey % 11 = 0 THEN 'malformed' WHEN c_custkey % 7 = 0 THEN 'money' ELSE 'good' END AS reason,
           COUNT(*) AS n
    FROM customer GROUP BY reason
"""

_POINTS = """
    SELECT c_custkey AS DR_NO,
           33.7e0 + (c_custkey % 997) / 997e0 * 0.7e0 AS LAT,
           -118.7e0 + (c_custkey % 991) / 991e0 * 0.6e0 AS LON
    FROM customer
"""

_NATION_SITES = """
    SELECT n_name AS DIVISION,
           -118.7e0 + ((n_nationkey * 577) % 991) / 991e0 * 0.6e0 AS X,
           33.7e0 + ((n_nationkey * 131) % 997) / 997e0 * 0.7e0 AS Y
    FROM nation
"""

_SUPPLIER_SITES = """
    SELECT s_name AS DIVISION,
           -118.7e0 + (s_suppkey % 991) / 991e0 * 0.6e0 AS X,
           33.7e0 + (s_suppkey % 997) / 997e0 * 0.7e0 AS Y
    FROM supplier
"""

_HAVERSINE = """2 * 6371e0 * ASIN(LEAST(1e0, SQRT(
        POWER(SIN((RADIANS({lat2}) - RADIANS({lat1})) / 2), 2)
        + COS(RADIANS({lat1})) * COS(RADIANS({lat2})) * POWER(SIN((RADIANS({lon2}) - RADIANS({lon1})) / 2), 2))))"""


def _station_oracle(sites_sql: str, coord: str = "DOUBLE") -> str:
    dist = _HAVERSINE.format(lat1="p.LAT", lon1="p.LON", lat2="s.Y", lon2="s.X")
    return f"""
    WITH p AS (SELECT DR_NO, CAST(CAST(LAT AS {coord}) AS DOUBLE) AS LAT,
                      CAST(CAST(LON AS {coord}) AS DOUBLE) AS LON FROM ({_POINTS})),
    s AS (SELECT DIVISION, CAST(CAST(X AS {coord}) AS DOUBLE) AS X,
                 CAST(CAST(Y AS {coord}) AS DOUBLE) AS Y FROM ({sites_sql})),
    d AS (SELECT p.DR_NO, s.DIVISION, {dist} AS distance
          FROM p, s
          WHERE p.LAT IS NOT NULL AND p.LON IS NOT NULL AND p.LAT <> 0 AND p.LON <> 0
            AND s.X IS NOT NULL AND s.Y IS NOT NULL),
    b AS (SELECT DR_NO, DIVISION, distance FROM (
            SELECT DR_NO, DIVISION, distance,
                   ROW_NUMBER() OVER (PARTITION BY DR_NO ORDER BY distance, DIVISION) AS rn FROM d)
          WHERE rn = 1)
    SELECT DIVISION, ROUND(AVG(distance), 6) AS average_distance, COUNT(*) AS num_of_crimes
    FROM b GROUP BY DIVISION ORDER BY num_of_crimes DESC, DIVISION
    """


_HAVERSINE_PAIRS = f"""
    WITH s AS (SELECT s_suppkey, s_nationkey,
                      33.7e0 + (s_suppkey % 997) / 997e0 * 0.7e0 AS lat,
                      -118.7e0 + (s_suppkey % 991) / 991e0 * 0.6e0 AS lon FROM supplier),
    st AS (SELECT n_nationkey, n_name,
                  -118.7e0 + ((n_nationkey * 577) % 991) / 991e0 * 0.6e0 AS X,
                  33.7e0 + ((n_nationkey * 131) % 997) / 997e0 * 0.7e0 AS Y FROM nation)
    SELECT s.s_suppkey, st.n_name AS DIVISION,
           ROUND({_HAVERSINE.format(lat1="s.lat", lon1="s.lon", lat2="st.Y", lon2="st.X")}, 6) AS distance_km
    FROM s JOIN st ON s.s_nationkey = st.n_nationkey
"""

ORACLE_SQL: dict[str, str] = {
    "daypart_share": _DAYPART_SHARE,
    "daypart_share_udf": _DAYPART_SHARE,
    "daypart_share_udf_csv": _DAYPART_SHARE,
    "daypart_total": _DAYPART_SCALED,
    "daypart_share_csv": _DAYPART_SHARE,
    "daypart_share_text": _DAYPART_SCALED,
    "daypart_share_parquet": _DAYPART_SHARE,
    "daypart_share_quoted": _DAYPART_SHARE,
    "daypart_share_partitioned": _DAYPART_SHARE,
    "parquet_rewrite": "SELECT * FROM orders",
    "top_months": _TOP_MONTHS,
    "top_months_parsed": _TOP_MONTHS,
    "top_months_sql": _TOP_MONTHS,
    "top_months_csv": _TOP_MONTHS,
    "top_months_sql_csv": _TOP_MONTHS,
    "income_per_person": _INCOME,
    "income_join_merge": _INCOME,
    "income_join_shuffle_hash": _INCOME,
    "income_join_broadcast": _INCOME,
    "income_per_person_parquet": _INCOME,
    "income_per_person_ranges": _INCOME,
    "income_per_person_inferred": _INCOME,
    "income_bucketed": _INCOME,
    "income_rejected": _INCOME_REJECTED,
    "income_from_text": _INCOME,
    "income_csv_semicolon": _INCOME_TABLE,
    "station_load": _station_oracle(_NATION_SITES),
    "station_load_float": _station_oracle(_NATION_SITES, "FLOAT"),
    "station_load_sql": _station_oracle(_NATION_SITES),
    "station_load_sql_float": _station_oracle(_NATION_SITES, "FLOAT"),
    "station_load_csv": _station_oracle(_NATION_SITES),
    "station_load_suppliers": _station_oracle(_SUPPLIER_SITES),
    "haversine_pairs": _HAVERSINE_PAIRS,
}
