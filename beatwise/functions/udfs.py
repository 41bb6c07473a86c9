"""The Python-UDF variant of the day-part mapping.

The native ``columns.day_part`` is the default.  This variant keeps Python's
``int()`` parsing rules (``'1_200'`` is accepted, ``'12.5'`` is not) and runs
as an Arrow-batched pandas UDF so rows cross the JVM/Python boundary in
columnar batches rather than one at a time.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from beatwise.functions.columns import DAY_PART_DEFAULT, DAY_PARTS


def day_part_py(value) -> str:
    """Plain-Python day part of one HHMM value."""
    try:
        t = int(value)
    except (TypeError, ValueError):
        return DAY_PART_DEFAULT
    for label, low, high in DAY_PARTS:
        if low <= t <= high:
            return label
    return DAY_PART_DEFAULT


# Text that int() reads the same as a plain base-10 number of at most 15 digits.
_PLAIN_INT = r"[+-]?[0-9]{1,15}"


def _labels(t: np.ndarray) -> np.ndarray:
    conds = [(t >= low) & (t <= high) for _, low, high in DAY_PARTS]
    return np.select(conds, [label for label, _, _ in DAY_PARTS], default=DAY_PART_DEFAULT)


@F.pandas_udf(StringType())
def day_part_udf(values: pd.Series) -> pd.Series:
    """Vectorised per Arrow batch.

    Plain integers (the usual case) are parsed and bucketed with pandas /
    numpy; anything else that is not null (underscores, other digit
    scripts, junk) goes through ``day_part_py`` one value at a time.
    """
    out = pd.Series(DAY_PART_DEFAULT, index=values.index, dtype=object)
    if not (pd.api.types.is_object_dtype(values) or pd.api.types.is_string_dtype(values)):
        known = values.notna()
        out[known] = _labels(values[known].to_numpy())
        return out
    stripped = values.str.strip()
    fast = stripped.str.fullmatch(_PLAIN_INT).fillna(False).astype(bool)
    if fast.any():
        out[fast] = _labels(pd.to_numeric(stripped[fast]).to_numpy())
    slow = values.notna() & ~fast
    if slow.any():
        out[slow] = values[slow].map(day_part_py)
    return out
