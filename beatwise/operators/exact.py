"""Means of doubles that do not depend on the order of the rows.

A sum of doubles changes in its last digits with the order of its terms, so
with the partitioning.  Here every value is cut into integers of 24 bits, each
belonging to a bin of binary places; the integers of a bin add up exactly in
any order, with partial sums in every task.  A group's few bins are put
together in exact arithmetic and rounded once, so the mean is the double
nearest to the true mean.
"""

from __future__ import annotations

from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Binary places of a bin: sums of up to 2**39 values of one group fit 64 bits.
BITS = 24
#: Parts of one value: 53 bits touch at most 4 bins, and the logarithm may name the bin above.
PARTS = 5
#: Values below 2**-900 are lifted by this many bins, since the scale of their bins has no double.
LIFT = 10
#: Bins that count instead: rows, values, NaN, infinity, minus infinity.
ROWS, VALUES, NAN, UP, DOWN = 1000, 1001, 1002, 1003, 1004


def binned(value: Column) -> Column:
    """``array<struct<bin int, part bigint>>``: a value's parts and what it counts as."""
    tiny = F.abs(value) < 2.0 ** -900
    scaled = F.when(tiny, value * 2.0 ** (BITS * LIFT)).otherwise(value)
    shift = F.when(tiny, -LIFT).otherwise(0)
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    top = F.floor(F.log2(F.abs(scaled)) / BITS).cast("int")
    rest, parts = scaled, []
    for k in range(PARTS):
        place = F.pow(F.lit(2.0), F.greatest(top - k, F.lit(-44)) * BITS)
        whole = (rest / place).cast("bigint")
        parts.append(F.struct((F.greatest(top - k, F.lit(-44)) + shift).alias("bin"), whole.alias("part")))
        rest = rest - whole * place
    one = lambda at: F.struct(F.lit(at).alias("bin"), F.lit(1).cast("bigint").alias("part"))
    odd = F.when(F.isnan(value), NAN).when(value > 0, UP).otherwise(DOWN)
    cut = F.when(value.isNull(), F.array(one(ROWS)))
    cut = cut.when(~finite, F.array(one(ROWS), one(VALUES), F.struct(odd.alias("bin"), F.lit(1).cast("bigint").alias("part"))))
    cut = cut.when(value == 0, F.array(one(ROWS), one(VALUES)))
    return cut.otherwise(F.array(one(ROWS), one(VALUES), *parts))


def mean_of_bins(bins: dict[int, int]) -> float | None:
    """The mean that a group's bins stand for, rounded once; null without values."""
    n = bins.get(VALUES, 0)
    if not n:
        return None
    if bins.get(NAN) or (bins.get(UP) and bins.get(DOWN)):
        return float("nan")
    if bins.get(UP) or bins.get(DOWN):
        return float("inf") if bins.get(UP) else float("-inf")
    total = sum((Fraction(2) ** (BITS * k) * v for k, v in bins.items() if k < ROWS), Fraction(0))
    return float(total / n)


@F.arrow_udf(DoubleType())
def _mean(bins: pa.Array) -> pa.Array:
    return pa.array([mean_of_bins({b["bin"]: b["part"] for b in row}) for row in bins.to_pylist()], pa.float64())


def exact_mean(df: DataFrame, keys: list[str], value: str, mean_col: str, count_col: str) -> DataFrame:
    """``keys`` with the mean of the non-null ``value`` and the number of rows, one row per group."""
    parts = df.select(*keys, F.inline(binned(F.col(value).cast("double"))))
    sums = parts.filter("part <> 0").groupBy(*keys, "bin").agg(F.sum("part").alias("part"))
    rows = F.sum(F.when(F.col("bin") == ROWS, F.col("part")))
    whole = sums.groupBy(*keys).agg(F.collect_list(F.struct("bin", "part")).alias("_bins"), rows.alias(count_col))
    return whole.select(*keys, _mean("_bins").alias(mean_col), count_col)
