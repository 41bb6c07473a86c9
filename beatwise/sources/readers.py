"""Readers: every source becomes a DataFrame with a declared schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet scan (vectorised, with filter and column push-down)."""
    return spark.read.parquet(*paths)


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType,
             sep: str = ",", header: bool = True) -> DataFrame:
    """One table from one or more CSV files (or globs) with a fixed schema.

    Columns are matched by position; the header line, if any, is skipped.
    No inference pass over the data.
    """
    return spark.read.schema(schema).option("header", header).option("sep", sep).csv(
        paths if isinstance(paths, str) else list(paths))


def read_csv_lines(spark: SparkSession, paths: str | Sequence[str], schema: StructType,
                   sep: str = ",") -> DataFrame:
    """CSV parsed line by line from a text scan (``from_csv`` per line).

    Each physical line is one record.  As in ``read_csv``, blank lines are no
    records and missing fields are null; a line whose parsed fields are the
    column names, quoted or not, is a header and dropped.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    parsed = F.from_csv(F.col("value"), F.lit(_ddl(schema)), {"sep": sep})
    rows = lines.filter(F.trim("value") != "").select("value", parsed.alias("r"))
    # names as text: a typed column never equals its own name
    named = F.from_csv(F.col("value"), F.lit(", ".join(f"`{n}` string" for n in schema.fieldNames())), {"sep": sep})
    header = F.struct(*[F.lit(n).alias(n) for n in schema.fieldNames()])
    return rows.filter(~named.eqNullSafe(header)).select("r.*")


def read_delimited_fields(spark: SparkSession, paths: str | Sequence[str], names: Sequence[str],
                          sep: str = ";", header_first_field: str | None = None) -> DataFrame:
    """Text lines split on ``sep`` (no quoting rules), fields picked by position.

    A line whose first field equals ``header_first_field`` is dropped, and so
    are blank lines; fields that a short line lacks are null.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    parts = F.split(F.col("value"), _regex_literal(sep))
    rows = lines.filter(F.trim("value") != "").select(parts.alias("f"))
    if header_first_field is not None:
        rows = rows.filter(F.get("f", F.lit(0)) != header_first_field)
    return rows.select(*[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_feature_docs(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Multi-line JSON documents (one per file), parsed with an explicit schema.

    Giving only the fields that are used keeps the reader from inferring the
    schema in an extra pass and from materialising geometry and unused
    properties.  One file is one task, so large collections should be split
    over many files (see ``sinks.write_feature_docs``).
    """
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_feature_docs_text(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The same documents through a whole-file text scan and ``from_json``."""
    docs = spark.read.text(path, wholetext=True)
    return docs.select(F.from_json(F.col("value"), schema).alias("d")).select("d.*")


def ingest_census(spark: SparkSession, path: str, schema: StructType, out: str, files: int | None = None) -> str:
    """Turn census documents once into a Parquet folder of flat feature rows.

    A document is read by one task; the rows are spread over ``files`` part
    files (by default as many as the session has shuffle partitions), so that
    later queries scan them in parallel and read single columns.
    """
    rows = read_feature_docs(spark, path, schema).selectExpr("inline(features)").select("properties.*")
    rows.repartition(files or int(spark.conf.get("spark.sql.shuffle.partitions"))).write.mode("overwrite").parquet(out)
    return out


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _regex_literal(text: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in text)
