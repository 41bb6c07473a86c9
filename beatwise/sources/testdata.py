"""Adapters from the bundled test tables to the reference's input shapes.

The reference reads public incident, station, income and census files.  The
test tables are a TPC-H-like schema plus an event stream; the functions here
derive reference-shaped inputs from them with Spark, so every analysis runs
over whole tables and its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beatwise.functions.columns import WHEN_TEXT_FORMAT
from beatwise.schemas import INCIDENT_COLUMNS

# --- Fixed mapping values (the fixture contract shared with the SQL oracle). ---
# Events whose type is this value play the role of incidents on a street.
STREET_EVENT_TYPE = "click"
# Synthetic coordinates: a latitude/longitude box (degrees) and the moduli
# that spread keys over it.
LAT_BASE, LAT_SPAN, LAT_MOD = 33.7, 0.7, 997
LON_BASE, LON_SPAN, LON_MOD = -118.7, 0.6, 991
# Station positions are spread by these key multipliers.
STATION_LAT_MULT, STATION_LON_MULT = 131, 577
# Median income of a nation key k is INCOME_BASE + INCOME_STEP * k.
INCOME_BASE, INCOME_STEP = 20000, 1234


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def synthetic_lat(key: Column) -> Column:
    return F.lit(LAT_BASE) + (key % LAT_MOD) / F.lit(float(LAT_MOD)) * F.lit(LAT_SPAN)


def synthetic_lon(key: Column) -> Column:
    return F.lit(LON_BASE) + (key % LON_MOD) / F.lit(float(LON_MOD)) * F.lit(LON_SPAN)


def incidents_from_events(spark: SparkSession, sf_dir: str, keep_ts: bool = False) -> DataFrame:
    """Incident-shaped text rows: number, occurrence date/time, premise.

    ``keep_ts`` also returns the source timestamp as ``occurred``.
    """
    ev = table(spark, sf_dir, "events")
    cols = [
        F.col("event_id").cast("string").alias("DR_NO"),
        F.date_format("ts", WHEN_TEXT_FORMAT).alias("DATE OCC"),
        F.date_format("ts", "HHmm").alias("TIME OCC"),
        F.col("event_type").alias("Premis Desc"),
    ]
    if keep_ts:
        cols.append(F.col("ts").alias("occurred"))
    return ev.select(*cols)


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as dated incidents: the timestamp and its reference-format text."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("DR_NO"),
        F.col("o_orderdate").alias("occurred"),
        F.date_format("o_orderdate", WHEN_TEXT_FORMAT).alias("DATE OCC"),
    )


def full_incidents(rows: DataFrame) -> DataFrame:
    """Incident rows in all 28 columns of the published table, as text.

    Columns that ``rows`` lacks hold filler text that depends on the row, so a
    CSV of them has the width that a reader must skip.
    """
    have = set(rows.columns)
    filler = lambda name: F.concat(F.lit(f"{name} "), F.pmod(F.xxhash64("DR_NO", F.lit(name)), F.lit(1000)))
    return rows.select(*[(F.col(name) if name in have else filler(name)).cast("string").alias(name)
                         for name in INCIDENT_COLUMNS])


def with_line_breaks(incidents: DataFrame, column: str = "LOCATION") -> DataFrame:
    """Incidents with quotes, separators and line breaks in a text column, by the row's number."""
    kind = F.pmod(F.xxhash64("DR_NO"), F.lit(4))
    broken = F.when(kind == 0, F.concat(F.lit('at "the corner"\n, '), column)).when(
        kind == 1, F.concat(column, F.lit('\n\n"x",\n'))).otherwise(F.col(column))
    return incidents.withColumn(column, broken)


def census_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One census feature per customer: postal area = nation key,
    population = the customer's orders, housing units = 1.

    Columns: ``key`` (unique), ``type``, ``properties``, ``geometry`` – the
    layout of a GeoJSON feature.  Order counts are a partial + final
    aggregate, joined back on the customer key.
    """
    c = table(spark, sf_dir, "customer")
    per_customer = (table(spark, sf_dir, "orders")
                    .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders")))
    joined = c.join(per_customer, c.c_custkey == per_customer.o_custkey, "left")
    return joined.select(
        F.col("c_custkey").alias("key"),
        F.lit("Feature").alias("type"),
        F.struct(
            F.col("c_nationkey").cast("string").alias("ZCTA20"),
            F.coalesce(F.col("n_orders"), F.lit(0)).cast("long").alias("POP20"),
            F.lit(1).cast("long").alias("HOUSING20"),
            F.col("c_mktsegment").alias("SEGMENT"),
        ).alias("properties"),
        F.struct(
            F.lit("Point").alias("type"),
            F.array(synthetic_lon(F.col("c_custkey")), synthetic_lat(F.col("c_custkey"))).alias("coordinates"),
        ).alias("geometry"),
    )


def income_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Income table text rows keyed by nation: ``'$21,234'``-style money."""
    n = table(spark, sf_dir, "nation")
    money = F.concat(F.lit("$"), F.format_number(
        F.col("n_nationkey") * INCOME_STEP + INCOME_BASE, 0))
    return n.select(
        F.col("n_nationkey").cast("string").alias("Zip_Code"),
        F.col("n_name").alias("Community"),
        money.alias("Estimated_Median_Income"),
    )


def balance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Income-table-shaped text rows that grow with the data: each customer's
    account balance as money text (``'$1,234.56'``, ``'$-846.69'``)."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("Zip_Code"),
        F.col("c_name").alias("Community"),
        F.concat(F.lit("$"), F.format_number("c_acctbal", 2)).alias("Estimated_Median_Income"),
    )


def broken_balance_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``balance_rows`` as ``;`` lines, every 11th customer's cut short, every 7th other's without an amount."""
    rows, key = balance_rows(spark, sf_dir), F.col("Zip_Code").cast("bigint")
    money = F.when(key % 7 == 0, "n/a").otherwise(F.col("Estimated_Median_Income"))
    whole = F.concat_ws(";", "Zip_Code", F.concat(F.lit('"'), "Community", F.lit('"')), money)
    return rows.select(F.when(key % 11 == 0, F.col("Zip_Code")).otherwise(whole).alias("value"))


def incident_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as located incidents: ``DR_NO``, ``LAT``, ``LON``."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(key.alias("DR_NO"), synthetic_lat(key).alias("LAT"), synthetic_lon(key).alias("LON"))


def station_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as police stations: ``DIVISION``, ``X`` (lon), ``Y`` (lat), ``FID`` (nation key)."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    return n.select(
        F.col("n_name").alias("DIVISION"),
        synthetic_lon(k * STATION_LON_MULT).alias("X"),
        synthetic_lat(k * STATION_LAT_MULT).alias("Y"),
        k.alias("FID"),
    )


def supplier_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as stations (a site table that grows with the data)."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(F.col("s_name").alias("DIVISION"), synthetic_lon(k).alias("X"), synthetic_lat(k).alias("Y"),
                    F.col("s_nationkey"))
