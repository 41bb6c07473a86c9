"""Helpers the operators share: staged tables, row packing, text measures."""

from __future__ import annotations

import contextlib
import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beatwise.session import staging_path

#: Fixed value: the white space that separates words (space, tab to carriage return).
SPACES = r"[\x20\x09-\x0D]+"


#: Paths of the tables staged, by application.
_staged: dict[str, list[str]] = {}


def materialize(df: DataFrame, name: str, files: int | None = None, parts: list[str] | None = None) -> DataFrame:
    """Write ``df`` to a fresh table in the shared checkpoint folder and read it back.

    Cuts the lineage without ``localCheckpoint``: a lost executor only costs
    the tasks that were running on it.  ``files`` bounds the number of files
    of a table known to be small; ``parts`` are columns to lay it out by.
    ``staged_tables_removed`` cleans up.
    """
    path = staging_path(df.sparkSession, f"llm-{name}")
    _staged.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    writer = (df.coalesce(files) if files else df).write
    (writer.partitionBy(*parts) if parts else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextlib.contextmanager
def staged_tables_removed(spark: SparkSession) -> Iterator[None]:
    """Remove at the end the tables staged inside: results that read them must be written by then."""
    staged = _staged.setdefault(spark.sparkContext.applicationId, [])
    before = len(staged)
    try:
        yield
    finally:
        for path in staged[before:]:
            remove(spark, path)
        del staged[before:]


def pack(df: DataFrame, keep: list[str] | None = None, **columns: Column) -> DataFrame:
    """Columns of ``df`` (all, or those in ``keep``) as one struct ``row`` beside computed ``columns``.

    Whatever names the caller's columns have, they cannot clash with an
    operator's own.
    """
    return df.select(F.struct(*keep or ["*"]).alias("row"), *[c.alias(k) for k, c in columns.items()])


def words_of(text: Column) -> Column:
    """Words of a whole text: runs of anything but white space; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def text_bytes(df: DataFrame, column: str) -> int:
    """UTF-8 bytes of a whole text column (one narrow scan, one number)."""
    return df.agg(F.sum(F.octet_length(F.col(column))).alias("n")).first().n or 0


def parts_for(spark: SparkSession, size: int, target: int) -> int:
    """Number of pieces of about ``target`` bytes, at least Spark's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / target), 1)
