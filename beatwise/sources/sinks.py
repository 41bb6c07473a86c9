"""Writers and the persist-then-act helper."""

from __future__ import annotations

import contextlib
import io
import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Features per written document; one document is read by one task.
FEATURES_PER_DOC = 50_000
# Most rows that ``collect_then_write`` brings to the driver.
MAX_COLLECT = 100_000


def write_csv(df: DataFrame, path: str, *, sep: str = ",", header: bool = True,
              single_file: bool = False) -> str:
    """Overwrite ``path`` with CSV part files.

    ``single_file`` merges partitions first (``coalesce(1)``): one task
    writes everything, so use it only for small results.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)
    return path


def write_parquet(df: DataFrame, path: str) -> str:
    """Overwrite ``path`` with Parquet part files."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_feature_docs(features: DataFrame, path: str, key_col: str,
                       features_per_doc: int = FEATURES_PER_DOC, rows: int | None = None) -> str:
    """Write ``{"type": "FeatureCollection", "features": [...]}`` documents.

    ``features`` holds one feature per row (a struct column per feature
    field) plus ``key_col``, a unique feature key.  Features are spread over
    ``ceil(rows / features_per_doc)`` documents by a hash of the key, so no
    document grows with the data, and each document goes to its own file.
    ``rows`` is the number of features where the caller knows it.
    """
    n_docs = max(1, math.ceil((features.count() if rows is None else rows) / features_per_doc))
    fields = [c for c in features.columns if c != key_col]
    docs = (features
            .withColumn("_doc", F.pmod(F.xxhash64(F.col(key_col)), F.lit(n_docs)))
            .groupBy("_doc")
            .agg(F.collect_list(F.struct(*fields)).alias("features"))
            .select(F.lit("FeatureCollection").alias("type"), "features"))
    docs.write.mode("overwrite").option("maxRecordsPerFile", 1).json(path)
    return path


def collect_then_write(df: DataFrame, path: str, max_rows: int = MAX_COLLECT, **csv_options) -> list:
    """Collect a small result and also write it as CSV, computing it once.

    More than ``max_rows`` rows are refused: a result that grows with the
    data belongs into files only.
    """
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = df.limit(max_rows + 1).collect()
        if len(rows) > max_rows:
            raise ValueError(f"more than {max_rows} rows; write the result instead of collecting it")
        write_csv(df, path, **csv_options)
    finally:
        df.unpersist()
    return rows


def formatted_plan(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints, returned as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
