"""Mixing sources to target weights by systematic sampling.

Every source has a target number of words: a share of all words by weight,
at most ``cap`` times its own words, the excess reshared by weight among the
others until none is above.  Inside a source every document has the same
expected number of copies, the target over the source's words.  The expected
copies are summed up along an order of the documents, one random offset a
source is added, and a document is taken once per integer its stretch crosses:
``floor`` or ``ceil`` of the expected copies, so never above ``cap``.

The order goes by size, so a source's taken words differ from its target by
the size of its longest document at most (a systematic sample of an ascending
sequence errs by no more than its range); documents of one size stand in the
order of a hash, whatever order the table has.

The prefix sums of a source of any size are spread: rows are sorted into
ranges of all sources, each range sums its own rows, and the sums of the ranges
before it (a row per range and source) are joined to it.

Defined results: a null text has size 0; null is a source of its own, after
all others; a source without words has the target 0 and nothing is taken of
it; rows equal in all kept columns and text stand side by side, and which of
them is taken once more is the same in any order of the table; no rows: no rows;
kept columns called ``mix`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, pack, parts_for

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: Most copies of a document, and of a source's words in its target.
CAP = 3
SEED = 13
#: Rows of a sorted range, about.
RANGE_ROWS = 500_000

_WORD = r"[^\x20\x09-\x0D]+"


def running_sums(df: DataFrame, within: str, order: list[Column], weight: str, rows: int) -> DataFrame:
    """``df`` plus ``upto``: the sum of ``weight`` in ``order`` up to the row, inside its group ``within``.

    No group lands in one task, however large: the rows are dealt into sorted
    ranges, summed inside each, and lifted by what the ranges before hold.
    """
    spark = df.sparkSession
    parts = parts_for(spark, rows, RANGE_ROWS)
    dealt = df.repartitionByRange(parts, F.col(within), *order).withColumn("_range", F.spark_partition_id())
    dealt = materialize(dealt, "ranges")
    inside = Window.partitionBy(within, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(within, "_range").agg(F.sum(weight).alias("_sum"))
    sums = sums.select(F.col(within).alias("_within"), F.col("_range").alias("_place"),
                       F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    summed = dealt.withColumn("_own", F.sum(weight).over(inside))
    here = summed[within].eqNullSafe(sums["_within"]) & (summed["_range"] == sums["_place"])
    return summed.join(sums, here).withColumn("upto", F.col("_own") + F.col("_base")).drop(
        "_own", "_base", "_within", "_place", "_range")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``(source, source_size)`` plus ``target``, for a table with one row per source.

    Sums are exact; of each round only two numbers reach the driver.
    """
    if cap < 1 or not weights or min(weights) < 1:
        raise ValueError("weights and cap must be positive")
    sources = materialize(sources.withColumn("one", F.lit(1).cast("long")).withColumn("all", F.lit(0)), "sources")
    total, rows = sources.agg(F.sum(F.col("source_size").cast("decimal(38,0)")), F.count("all")).first()
    total = int(total or 0)
    ranked = running_sums(sources, "all", [F.col("source").asc_nulls_last()], "one", rows)
    turn = ((F.col("upto") - 1) % len(weights)).cast("int")
    weighed = materialize(ranked.select("source", "source_size", F.get(F.array(*[F.lit(w) for w in weights]), turn)
                                        .cast("decimal(38,0)").alias("weight")), "weights")
    most = F.col("source_size").cast("decimal(38,0)") * cap
    capped, rest, shared = F.lit(False), total, weighed.agg(F.sum("weight")).first()[0]
    while shared:
        capped = F.col("weight") * F.lit(rest).cast("decimal(38,0)") > most * F.lit(int(shared)).cast("decimal(38,0)")
        full, left = weighed.agg(F.sum(F.when(capped, most)), F.sum(F.when(~capped, F.col("weight")))).first()
        if (now := (total - int(full or 0), int(left or 0))) == (rest, int(shared)):
            break
        rest, shared = now
    else:
        capped = F.lit(True)
    share = (F.col("weight") * F.lit(rest).cast("decimal(38,0)")).cast("double") / F.lit(float(shared or 1))
    return weighed.select("source", "source_size", F.when(capped, most.cast("double")).otherwise(share).alias("target"))


def random_offset(source: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that a source always gets."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(16 ** 13)


def mix_sources(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
                weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED,
                keep: list[str] | None = None) -> DataFrame:
    """Columns of ``df`` (or those in ``keep``) plus the struct ``mix``.

    ``mix`` has ``size`` (words), ``source_size``, ``target`` (both of the
    row's source), ``copies`` and ``taken`` (copies times size).
    """
    keep = [c for c in keep or df.columns if c.lower() != "mix"]
    size = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(_WORD)).cast("long")
    name = F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                       F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    rows = pack(df, keep, source=F.col(source).cast("string"), size=size, key=F.md5(name.cast("binary")))
    rows = materialize(rows.withColumn("mark", F.xxhash64(F.to_json("row"))), "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("size").alias("rows"))
    targets = materialize(source_targets(sources.select("source", "source_size"), weights, cap), "targets")
    # equal rows of one scan task are one row with a count, so a row that repeats a million times is no hot key
    alike = rows.groupBy("source", "size", "key", "mark", F.spark_partition_id().alias("part"), "row").agg(
        F.count(F.lit(1)).alias("n"))
    order = [F.col(c) for c in ("size", "key", "mark", "part")]
    summed = running_sums(alike, "source", order, "n", rows.count())
    rated = summed.alias("d").join(targets.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "d.row", "d.size", "d.key", "d.part", "d.n", "d.upto", "s.source_size", "s.target",
        (F.col("s.target") / F.nullif("s.source_size", F.lit(0))).alias("rate"),
        random_offset(F.col("d.source"), seed).alias("offset"))
    each = rated.repartition("key", "part").withColumn(
        "place", F.explode(F.sequence(F.col("upto") - F.col("n") + 1, F.col("upto"))))
    crossed = lambda at: F.floor(F.col("rate") * at + F.col("offset"))
    copies = F.coalesce(crossed(F.col("place")) - crossed(F.col("place") - 1), F.lit(0)).cast("long")
    return each.withColumn("copies", copies).select(
        *[F.col("row").getField(c).alias(c) for c in keep],
        F.struct("size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")).alias("mix"))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it is taken, with its ``copy`` number from 0."""
    taken = mixed.filter("mix.copies > 0")
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("mix.copies") - 1)).alias("copy")
    return taken.select(*[F.col(f"`{c}`") for c in mixed.columns if c not in ("mix", "copy")], copy)
