"""Command line for the four analyses over files in the public formats.

    python -m beatwise.cli daypart    --incidents a.csv b.csv --output out [--udf | --text] [--premise STREET]
    python -m beatwise.cli top-months --incidents a.csv b.csv --output out [--sql]
    python -m beatwise.cli income     --census blocks.geojson --income income.csv --output out
                                      [--join merge|shuffle_hash|broadcast] [--text]
    python -m beatwise.cli stations   --incidents a.csv b.csv --stations stations.csv --output out
                                      [--sql] [--float]
    python -m beatwise.cli convert    --incidents a.csv b.csv --output parquet_dir
    python -m beatwise.cli convert    --census blocks.geojson --output parquet_dir

``--incidents`` also takes a Parquet folder written by ``convert``
(``--incident-format parquet``), and ``--census`` one from ``convert --census``
(``--census-format parquet``).  Results are written as CSV with a header; those
with few rows by nature are printed whole, of the income per postal area only
the first rows.  ``--single-file`` merges the (small) result into one part
file; ``--cluster`` uses the session settings for large clusters.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from beatwise.functions.columns import WHEN_TEXT_FORMAT
from beatwise.plans import daypart, income, months, stations
from beatwise.schemas import CENSUS_DOC_SCHEMA, INCIDENT_SCHEMA, INCOME_SCHEMA, STATION_SCHEMA
from beatwise.session import get_session
from beatwise.sources import readers, sinks
from beatwise.sources.checks import write_observed
from beatwise.sources.features import read_features
from beatwise.sources.properties import read_properties
from beatwise.sources.records import read_csv_records


# Rows of a result per postal area that are printed.
PRINTED_ROWS = 20


def _incidents(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.incident_format == "parquet":
        return readers.read_parquet(spark, *args.incidents)
    if args.incident_format == "text":
        return readers.read_csv_lines(spark, args.incidents, INCIDENT_SCHEMA)
    if args.incident_format == "records":
        return read_csv_records(spark, args.incidents, INCIDENT_SCHEMA)
    return readers.read_csv(spark, args.incidents, INCIDENT_SCHEMA)


def _daypart(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    inc = _incidents(spark, args)
    if args.udf:
        return daypart.daypart_share_udf(inc, args.premise)
    if args.incident_format == "text":
        return daypart.daypart_share_scaled(inc, args.premise)
    return daypart.daypart_share(inc, args.premise)


def _top_months(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    inc = _incidents(spark, args)
    if args.sql:
        return months.top_months_sql(spark, inc, "DATE OCC", args.date_format, drop_unparsed=args.drop_unparsed)
    return months.top_months_from_text(inc, "DATE OCC", args.date_format, drop_unparsed=args.drop_unparsed)


def _income(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.text:
        docs = readers.read_feature_docs_text(spark, args.census, CENSUS_DOC_SCHEMA)
        fields = readers.read_delimited_fields(spark, args.income, INCOME_SCHEMA.fieldNames(), sep=";",
                                               header_first_field=args.income_header)
        return income.income_per_person_lenient(docs, fields)
    inc = readers.read_csv(spark, args.income, INCOME_SCHEMA, sep=";")
    if args.census_format == "parquet":
        return income.income_per_person_flat(readers.read_parquet(spark, args.census), inc, args.join)
    if args.census_format in ("ranges", "inferred"):
        return income.income_per_person_flat(_census(spark, args.census, args.census_format == "inferred"), inc, args.join)
    docs = readers.read_feature_docs(spark, args.census, CENSUS_DOC_SCHEMA)
    return income.income_per_person(docs, inc, args.join)


def _census(spark: SparkSession, path: str, inferred: bool = False) -> DataFrame:
    """Properties of census features, a document read by many tasks."""
    if inferred:
        return read_properties(spark, path)
    return read_features(spark, path, CENSUS_DOC_SCHEMA["features"].dataType.elementType).select("properties.*")


def _stations(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    inc = _incidents(spark, args)
    sites = readers.read_csv(spark, args.stations, STATION_SCHEMA)
    if args.sql:
        return stations.station_load_sql(spark, inc, sites, "FLOAT" if args.float else "DOUBLE")
    return stations.station_load(inc, sites, coord_kind="float" if args.float else "double")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m beatwise.cli", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, incidents: bool = True) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        c.add_argument("--output", required=True)
        c.add_argument("--single-file", action="store_true")
        c.add_argument("--master", default=None)
        c.add_argument("--cluster", action="store_true")
        if incidents:
            c.add_argument("--incidents", nargs="+", required=name != "convert")
            c.add_argument("--incident-format", choices=("csv", "text", "records", "parquet"), default="csv")
        return c

    d = command("daypart")
    d.add_argument("--premise", default="STREET")
    d.add_argument("--udf", action="store_true")
    t = command("top-months")
    t.add_argument("--sql", action="store_true")
    t.add_argument("--date-format", default=WHEN_TEXT_FORMAT)
    t.add_argument("--drop-unparsed", action="store_true")
    i = command("income", incidents=False)
    i.add_argument("--census", required=True)
    i.add_argument("--income", required=True)
    i.add_argument("--join", choices=("merge", "shuffle_hash", "broadcast"), default=None)
    i.add_argument("--text", action="store_true")
    i.add_argument("--census-format", choices=("geojson", "ranges", "inferred", "parquet"), default="geojson")
    i.add_argument("--income-header", default="Zip Code")
    s = command("stations")
    s.add_argument("--stations", required=True)
    s.add_argument("--sql", action="store_true")
    s.add_argument("--float", action="store_true")
    v = command("convert")
    v.add_argument("--census", default=None)
    return p


def main(argv: Sequence[str] | None = None) -> list:
    """Run one command; returns the rows printed ([] for ``convert``)."""
    parser = _parser()
    args = parser.parse_args(argv)
    if args.command == "convert" and bool(args.incidents) == bool(args.census):
        parser.error("convert takes either --incidents or --census")
    spark = get_session(args.master, app_name=f"beatwise-{args.command}", cluster=args.cluster)
    if args.command == "convert":
        rows = _census(spark, args.census) if args.census else _incidents(spark, args)
        for name, figure in write_observed(rows, args.output).items():
            print(f"{name}={figure}")
        return []
    if args.command == "income":  # a row per postal area: as many as the data has
        sinks.write_csv(_income(spark, args), args.output, single_file=args.single_file)
        rows = spark.read.schema("Zip_Code string, per_person_income double").option("header", True).csv(
            args.output).limit(PRINTED_ROWS).collect()
        for row in rows:
            print(", ".join(f"{k}={v}" for k, v in row.asDict().items()))
        return rows
    build = {"daypart": _daypart, "top-months": _top_months, "stations": _stations}[args.command]
    rows = sinks.collect_then_write(build(spark, args), args.output, single_file=args.single_file)
    for row in rows:
        print(", ".join(f"{k}={v}" for k, v in row.asDict().items()))
    return rows


if __name__ == "__main__":
    main()
