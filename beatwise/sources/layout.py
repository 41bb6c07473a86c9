"""Tables laid out for the queries that read them.

Partitioned: one folder per value, so that a filter on the column reads only
its folders and one value can be written anew without the others.  Bucketed:
rows dealt by the hash of a key and sorted, so that grouping and joining on the
key need no shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

#: Buckets of a table: about the tasks that join it; both sides of a join need the same number.
BUCKETS = 64


def write_partitioned(df: DataFrame, path: str, *columns: str) -> str:
    """Write ``df`` under ``path``, a folder per value of ``columns``; folders of other values stay as they are.

    Rows of a value meet in few files; a value that holds most rows is split
    over tasks by adaptive execution.
    """
    if not columns:
        raise ValueError("name the columns to lay the table out by")
    (df.hint("rebalance", *[f"`{c}`" for c in columns]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*columns).parquet(path))
    return path


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int = BUCKETS, table: str | None = None) -> str:
    """Write ``df`` under ``path`` in sorted buckets of ``key``; returns the name of its table in the session's catalog."""
    name = table or f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).sortWithinPartitions(key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(name))
    return name

