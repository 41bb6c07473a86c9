"""Equi-joins with a caller-selected physical strategy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Strategies a caller may request.  ``None`` leaves the choice to Catalyst and
# AQE (which can switch to a broadcast at run time from measured sizes).
JOIN_STRATEGIES = (None, "broadcast", "merge", "shuffle_hash")

# Largest right side, in estimated bytes, that an explicit ``broadcast`` request ships.
BROADCAST_BYTES = 256 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Size of the optimized plan as Spark's statistics see it; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def join_by_key(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                strategy: str | None = None, how: str = "inner",
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join ``left.left_key == right.right_key`` using ``strategy``.

    * ``None``: optimizer's choice.
    * ``"merge"`` / ``"shuffle_hash"``: join hint on the left side, the
      shuffle of an upstream aggregate on the same key is reused.
    * ``"broadcast"``: ships ``right`` to every task; a right side estimated
      above ``broadcast_bytes`` is refused with a ``ValueError``.

    A replicated nested-loop strategy is deliberately not offered: it
    compares every pair of rows.
    """
    if strategy not in JOIN_STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}; choose from {JOIN_STRATEGIES}")
    if strategy in ("merge", "shuffle_hash"):
        left = left.hint(strategy)
    elif strategy == "broadcast":
        size = estimated_bytes(right)
        if size > broadcast_bytes:
            raise ValueError(f"the right side is estimated at {size} bytes, above the broadcast limit of "
                             f"{broadcast_bytes}; leave the strategy to the optimizer or raise the limit")
        right = F.broadcast(right)
    return left.join(right, left[left_key] == right[right_key], how)
