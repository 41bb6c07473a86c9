"""Rows that do not hold what they should, kept with the reason; figures measured while writing.

A rule names a reason and says which rows have it.  Good and rejected rows come
from one scan: a row carries its reasons, and one write lays both kinds out in
folders of their own.  Figures of a write (rows, nulls of each column, a
checksum) are observed by the write itself, so no second action reads the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from beatwise.functions.columns import WHEN_TEXT_FORMAT, clean_money, parse_when, to_double, to_int

#: Column that holds the text of a record its reader could not parse, and the reason it gives.
CORRUPT, MALFORMED = "_corrupt_record", "malformed"
#: Columns that a check adds.
REASONS, REJECTED = "reasons", "rejected"


def _given(column: str, parsed: Column) -> Column:
    """A text is there, but does not parse."""
    return F.col(column).isNotNull() & (F.trim(F.col(column)) != "") & parsed.isNull()


def bad_time(column: str) -> Column:
    """Not a time of day as HHMM."""
    t = to_int(column)
    return _given(column, F.when((t >= 0) & (t < 2400) & (t % 100 < 60), t))


def bad_date(column: str, fmt: str = WHEN_TEXT_FORMAT) -> Column:
    return _given(column, parse_when(column, fmt))


def bad_money(column: str) -> Column:
    return _given(column, clean_money(column))


def bad_number(column: str) -> Column:
    """Not a finite number."""
    return _given(column, F.when(F.abs(to_double(column)) < float("inf"), to_double(column)))


def missing(column: str) -> Column:
    """Null or blank."""
    return F.col(column).isNull() | (F.trim(F.col(column)) == "")


def with_corrupt(schema: StructType) -> StructType:
    """``schema`` with the column for records that do not parse."""
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def read_csv_checked(spark: SparkSession, paths: str | Sequence[str], schema: StructType, sep: str = ",",
                     header: bool = True) -> DataFrame:
    """CSV rows with the text of lines that have too few or too many fields, or a value that is not of its type."""
    reader = spark.read.schema(with_corrupt(schema)).options(header=header, sep=sep, columnNameOfCorruptRecord=CORRUPT)
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def parse_lines_checked(lines: DataFrame, schema: StructType, sep: str = ",", column: str = "value") -> DataFrame:
    """The same for lines (or records) of text."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in with_corrupt(schema).fields)
    parsed = F.from_csv(F.col(column), F.lit(ddl), {"sep": sep, "columnNameOfCorruptRecord": CORRUPT})
    return lines.filter(F.trim(column) != "").select(parsed.alias("r")).select("r.*")


def parse_json_checked(texts: DataFrame, schema: StructType, column: str = "value") -> DataFrame:
    """The same for JSON objects, such as ``split_features`` gives."""
    parsed = F.from_json(F.col(column), with_corrupt(schema), {"columnNameOfCorruptRecord": CORRUPT})
    return texts.select(parsed.alias("r")).select("r.*")


def checked(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``rows`` with the array ``reasons``: ``malformed`` and the names of the rules that a row breaks, in their order.

    A malformed row is not held against the rules; a rule that is null is not broken.
    """
    malformed = F.col(CORRUPT).isNotNull() if CORRUPT in rows.columns else F.lit(False)
    broken = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()], F.lit(None).cast("string")))
    return rows.withColumn(REASONS, F.when(malformed, F.array(F.lit(MALFORMED))).otherwise(broken))


def _checksum(df: DataFrame) -> Column:
    """A sum over rows in any order; equal tables have equal ones."""
    return F.sum(F.xxhash64(F.to_json(F.struct("*"))).cast("decimal(38,0)")).alias("checksum")


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with figures that whatever action reads it measures: ``rows``, ``checksum``, and ``nulls:<column>``."""
    figures = Observation()
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls:{c}") for c in df.columns]
    return df.observe(figures, F.count(F.lit(1)).alias("rows"), _checksum(df), *nulls), figures


def write_observed(df: DataFrame, path: str, fmt: str = "parquet", **options) -> dict:
    """Overwrite ``path``; the figures of what was written, from the write's own scan."""
    measured, figures = observed(df)
    measured.write.mode("overwrite").options(**options).format(fmt).save(path)
    return figures.get


def write_checked(rows: DataFrame, path: str) -> tuple[DataFrame, DataFrame, dict]:
    """Good rows, rejected rows with their reasons, and how many there are of each, from one scan of ``rows`` (as ``checked`` gives them)."""
    figures = Observation()
    bad = F.size(REASONS) > 0
    out = rows.observe(figures, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rejected"))
    out.withColumn(REJECTED, bad).write.mode("overwrite").partitionBy(REJECTED).parquet(path)
    there = rows.sparkSession.read.schema(StructType([*rows.schema.fields, StructField(REJECTED, StringType())])).parquet(path)
    drop = [c for c in (CORRUPT, REASONS) if c in rows.columns]
    return (there.filter(F.col(REJECTED) == "false").drop(REJECTED, *drop),
            there.filter(F.col(REJECTED) == "true").drop(REJECTED), figures.get)
