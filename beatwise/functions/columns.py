"""Scalar column expressions.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so
the work stays inside whole-stage code generation.  Casts use ``try_cast``
because Spark 4 runs with ANSI mode on: text that does not parse becomes
null instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values that must equal the reference's for identical results. ---
# Day parts are inclusive HHMM ranges; every other value, including null,
# unparsable text and impossible minutes such as 1160-1199, is the default.
DAY_PARTS: tuple[tuple[str, int, int], ...] = (
    ("Morning", 500, 1159),
    ("Afternoon", 1200, 1659),
    ("Night", 1700, 2059),
)
DAY_PART_DEFAULT = "LateNight"
# Mean Earth radius used by the distance formula, in kilometres.
EARTH_RADIUS_KM = 6371.0
# Text layout of occurrence dates, e.g. "2010 Feb 20 12:00:00 AM".
WHEN_TEXT_FORMAT = "yyyy MMM dd hh:mm:ss a"
# Characters stripped from money text such as "$52,806".
MONEY_NOISE_PATTERN = "[$,]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: Column | str) -> Column:
    """Text -> int, null when the text is not an integer."""
    return _col(c).try_cast("int")


def to_double(c: Column | str, kind: str = "double") -> Column:
    """Text -> double (or ``float`` when ``kind='float'``), null when unparsable."""
    return _col(c).try_cast(kind)


def bucket_ranges(value: Column | str, ranges: Sequence[tuple[str, float, float]],
                  default: str) -> Column:
    """Searched CASE over inclusive ``(label, low, high)`` ranges.

    A null value matches no range and falls through to ``default``.
    """
    v = _col(value)
    expr = None
    for label, low, high in ranges:
        cond = v.between(low, high)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.lit(default) if expr is None else expr.otherwise(default)


def day_part(time_text: Column | str) -> Column:
    """HHMM text (or int) -> part of day label."""
    return bucket_ranges(to_int(time_text), DAY_PARTS, DAY_PART_DEFAULT)


def clean_money(text: Column | str) -> Column:
    """``'$52,806'`` -> 52806.0; anything that is not a number -> null."""
    return F.regexp_replace(_col(text), MONEY_NOISE_PATTERN, "").try_cast("double")


def parse_when(text: Column | str, fmt: str = WHEN_TEXT_FORMAT) -> Column:
    """Occurrence-date text -> timestamp, null when it does not match ``fmt``."""
    return F.try_to_timestamp(_col(text), F.lit(fmt))


def haversine_km(lat1: Column | str, lon1: Column | str,
                 lat2: Column | str, lon2: Column | str) -> Column:
    """Great-circle distance in km between two points given in degrees.

    The arcsine argument is clamped to 1: rounding can push it just above,
    which would otherwise give NaN for (nearly) antipodal points.  A NaN
    coordinate stays NaN (Spark orders NaN above every number, so a plain
    ``least`` would turn it into half the Earth's circumference).
    """
    p1, l1 = F.radians(_col(lat1)), F.radians(_col(lon1))
    p2, l2 = F.radians(_col(lat2)), F.radians(_col(lon2))
    a = (F.pow(F.sin((p2 - p1) / 2), 2)
         + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2), 2))
    half = F.sqrt(a)
    return 2 * EARTH_RADIUS_KM * F.asin(F.when((half > 1) & ~F.isnan(half), F.lit(1.0)).otherwise(half))


def unit_vector(lat: Column | str, lon: Column | str) -> tuple[Column, Column, Column]:
    """Degrees -> (x, y, z) on the unit sphere."""
    p, l = F.radians(_col(lat)), F.radians(_col(lon))
    return F.cos(p) * F.cos(l), F.cos(p) * F.sin(l), F.sin(p)
