"""Shards by extendible hashing.

A directory maps prefixes of a row's hash bits to shards.  A shard above the
byte limit splits on one more bit, all others stay, until every shard fits.

The bytes of all prefixes come from one histogram of a few bits more than the
expected depth; only buckets that do not fit even there are looked at again
with more bits.  The directory stays a table: neither rows nor buckets reach
the driver.

Defined results: the hash covers id and text, so a hot id splits too; rows
equal in both share all bits and stay in one shard, even above the limit
(``depth`` is then ``HASH_BITS``); a row longer than the limit has a shard of
its own; null texts have no bytes; no rows: no shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, pack, text_bytes

HASH_BITS = 60
SHARD_BYTES = 1 << 20
#: Bits the histogram has beyond the expected depth, and each further round adds.
SPARE_BITS = 5


def hash_bits(id_col: Column, text: Column) -> Column:
    """``HASH_BITS`` leading bits of the MD5 of id and text."""
    whole = F.concat_ws("|", F.coalesce(id_col.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(whole), 1, HASH_BITS // 4), 16, 10).cast("long")


def prefix(bits: int) -> Column:
    return F.shiftright("hash", HASH_BITS - bits)


def _directory(histogram: DataFrame, least: int, most: int, limit: int) -> DataFrame:
    """For each bucket of ``most`` bits its shard: the shortest prefix, from ``least`` bits on, that fits.

    ``histogram`` has ``bucket`` and ``size``; a bucket without a fitting prefix gets a null depth.
    """
    levels = histogram.select("bucket", "size", F.explode(F.sequence(F.lit(least), F.lit(most))).alias("depth"))
    place = F.expr(f"shiftright(bucket, {most} - depth)")
    sums = levels.groupBy("depth", place.alias("place")).agg(F.sum("size").alias("shard_bytes")).filter(
        (F.col("shard_bytes") <= limit) | (F.col("depth") == HASH_BITS))
    fits = levels.withColumn("place", place).join(sums, ["depth", "place"]).groupBy("bucket").agg(
        F.min_by(F.struct("depth", "place", "shard_bytes"), "depth").alias("shard"))
    return histogram.select("bucket").join(fits, "bucket", "left").select("bucket", "shard.*")


def assign_shards(df: DataFrame, id_col: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES,
                  keep: list[str] | None = None) -> DataFrame:
    """Columns of ``df`` (or those in ``keep``) plus the struct ``shard``: ``name`` (its bits), ``depth``, ``bytes``."""
    if limit < 1:
        raise ValueError("limit must be positive")
    keep = [c for c in keep or df.columns if c.lower() != "shard"]
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    rows = pack(df, keep, hash=hash_bits(F.col(id_col), F.col(text)), size=size)
    total = text_bytes(df, text)
    depth = min(HASH_BITS, math.ceil(math.log2(max(1.0, total / limit))) + SPARE_BITS)
    pending, least, parts = rows, 0, []
    while True:
        histogram = pending.groupBy(prefix(depth).alias("bucket")).agg(F.sum("size").alias("size"))
        directory = materialize(_directory(histogram, least, depth, limit), "directory")
        placed = pending.withColumn("bucket", prefix(depth)).join(directory, "bucket")
        parts.append(placed.filter("depth IS NOT NULL"))
        if depth == HASH_BITS or directory.filter("depth IS NULL").isEmpty():
            break
        pending = placed.filter("depth IS NULL").select("row", "hash", "size")
        least, depth = depth + 1, min(HASH_BITS, depth + SPARE_BITS)
    done = parts[0]
    for part in parts[1:]:
        done = done.unionByName(part)
    name = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.lpad(F.bin("place"), F.col("depth"), F.lit("0")))
    return done.select(*[F.col("row").getField(c).alias(c) for c in keep],
                       F.struct(name.alias("name"), "depth", F.col("shard_bytes").alias("bytes")).alias("shard"))


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard; a shard's rows meet in one task, which the limit bounds."""
    name = F.concat(F.lit("s"), F.col("shard.name"))
    assigned.withColumn("shard_name", name).drop("shard").repartition("shard_name").write.partitionBy("shard_name").parquet(path)
