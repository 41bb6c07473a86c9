"""Share of street incidents per part of day.

Scan -> premise filter (pushed into the scan) -> day-part label -> partial +
final count over at most four labels -> share of the grand total -> sort.
The only shuffle carries four rows per task, whatever the input size; the
share window runs over those four rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatwise.functions.columns import day_part
from beatwise.functions.udfs import day_part_udf
from beatwise.operators.share import share_of_total

PREMISE_COL = "Premis Desc"
TIME_COL = "TIME OCC"


def daypart_counts(incidents: DataFrame, premise: str, *, premise_col: str = PREMISE_COL,
                   time_col: str = TIME_COL,
                   label: Callable[[Column], Column] = day_part) -> DataFrame:
    """``(day_part, crime_count)`` for incidents whose premise equals ``premise``."""
    return (incidents
            .filter(F.col(premise_col) == premise)
            .select(label(F.col(time_col)).alias("day_part"))
            .groupBy("day_part")
            .agg(F.count(F.lit(1)).alias("crime_count")))


def daypart_share(incidents: DataFrame, premise: str, **kw) -> DataFrame:
    """``(day_part, crime_count, percentage)``, largest share first."""
    counts = daypart_counts(incidents, premise, **kw)
    return (share_of_total(counts, "crime_count", "percentage", bounded=True)
            .orderBy(F.col("percentage").desc(), "day_part"))


def daypart_share_udf(incidents: DataFrame, premise: str, **kw) -> DataFrame:
    """Same result with the day part computed by the Arrow-batched Python UDF."""
    return daypart_share(incidents, premise, label=day_part_udf, **kw)


def daypart_share_scaled(incidents: DataFrame, premise: str, **kw) -> DataFrame:
    """``(day_part, percentage)`` with ``100 * count / total`` (text-variant form).

    The total is a global sum over the (four) grouped rows, taken as a scalar
    subquery.
    """
    counts = daypart_counts(incidents, premise, **kw)
    return (share_of_total(counts, "crime_count", "percentage", bounded=False, scale_first=True)
            .select("day_part", "percentage")
            .orderBy(F.col("percentage").desc(), "day_part"))
