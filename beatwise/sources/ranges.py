"""Text files scanned by byte ranges whose meaning depends on what comes before.

Spark deals a file out as byte ranges.  A reader here scans the ranges twice:
first for what each range does to the state it may start in, then, with the
state at each start known, for its output.  An item that crosses ranges leaves
parts in them: part 1 goes on from the range before, part 2 begins and goes on
in the next, part 0 is whole.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHOLE, GOES_ON, BEGINS = 0, 1, 2
FOUND = "file bigint, block bigint, part int, text binary"


def ranged_records(spark: SparkSession, paths: str | Sequence[str], sep: str) -> DataFrame:
    """``(file, block, value)``: records that end in ``sep``, in file order inside each range."""
    records = spark.read.option("lineSep", sep).text(paths if isinstance(paths, str) else list(paths))
    return records.select(F.xxhash64("_metadata.file_path").alias("file"),
                          F.col("_metadata.file_block_start").alias("block"), "value")


@contextlib.contextmanager
def same_ranges(spark: SparkSession) -> Iterator[None]:
    """Keeps the byte ranges of scans the same while executors come and go."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    if before is None:
        spark.conf.set(name, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)


def by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """``((file, block), values)`` in file order, each of one range."""
    for batch in batches:
        file, block = (batch.column(i).to_numpy() for i in (0, 1))
        edge = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
        for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(file)], strict=True):
            if b > a:
                yield (int(file[a]), int(block[a])), batch.column(2).slice(a, b - a)


def found_batch(key: tuple[int, int], parts: Sequence[int], texts: Sequence[bytes] | pa.Array) -> pa.RecordBatch:
    """Output rows of a range, as ``FOUND``."""
    n = len(parts)
    return pa.RecordBatch.from_arrays(
        [pa.array([key[0]] * n, pa.int64()), pa.array([key[1]] * n, pa.int64()), pa.array(parts, pa.int32()),
         texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary())], ["file", "block", "part", "text"])


def start_of(states: dict, key: tuple[int, int]):
    """State at the start of a range."""
    if key not in states:
        raise RuntimeError("the byte ranges changed between two scans of the file")
    return states[key]


def stitched(found: DataFrame, name: str) -> DataFrame:
    """``name``: the text of every item, whole ones as they are, the others put together from their parts."""
    crossing = Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, 0)
    begun = F.sum((F.col("part") == BEGINS).cast("int")).over(crossing)
    # which item a part belongs to is found without the texts, which then meet item by item
    places = found.filter(F.col("part") != WHOLE).select("file", "block", "part").withColumn("item", begun)
    parts = found.filter(F.col("part") != WHOLE).join(places, ["file", "block", "part"]).groupBy("file", "item").agg(
        F.sort_array(F.collect_list(F.struct("block", "part", "text"))).alias("parts"))
    whole = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["text"])).cast("string")
    return found.filter(F.col("part") == WHOLE).select(F.col("text").cast("string").alias(name)).unionByName(
        parts.select(whole.alias(name)))
