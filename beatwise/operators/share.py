"""Share of a grand total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def share_of_total(counts: DataFrame, count_col: str, out_col: str = "percentage",
                   *, bounded: bool = False, scale_first: bool = False) -> DataFrame:
    """Add ``out_col`` = ``count_col`` / sum(``count_col``) * 100.

    ``counts`` is an aggregate (one row per group).  The total is a scalar
    subquery, which keeps every row where it is and only ships one number.
    Callers whose keys are a small fixed set (e.g. four day parts) may say
    ``bounded=True``: an un-partitioned window over those few rows, which
    meet in one task, is then the cheapest form.

    ``scale_first`` computes ``100 * c / total`` (multiplication first), the
    text-variant order, which may differ from ``c / total * 100`` in the last
    bit.
    """
    if bounded:
        total = F.sum(count_col).over(Window.partitionBy())
    else:
        total = counts.select(F.sum(count_col)).scalar()
    c = F.col(count_col)
    share = (F.lit(100) * c / total) if scale_first else (c / total * 100)
    return counts.withColumn(out_col, share)
