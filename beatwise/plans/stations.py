"""Incident load per nearest police station.

Each located incident is assigned to its closest station by great-circle
distance (``operators.nearest.nearest_site``: joins of spherical cells),
repeated incident numbers keep their closest pair, and the stations are
summarised by mean distance and incident count.  The mean does not depend on
the order of the rows (``operators.exact``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatwise.operators.exact import exact_mean
from beatwise.operators.nearest import nearest_site


def _summary(nearest: DataFrame) -> DataFrame:
    means = exact_mean(nearest, ["DIVISION"], "distance", "average_distance", "num_of_crimes")
    return means.orderBy(F.col("num_of_crimes").desc(), F.col("DIVISION").asc())


def station_load(points: DataFrame, stations: DataFrame, *, coord_kind: str = "double",
                 drop_zero_sites: bool = False, **search) -> DataFrame:
    """``(DIVISION, average_distance, num_of_crimes)``, busiest station first.

    ``points``: ``DR_NO``, ``LAT``, ``LON``; ``stations``: ``DIVISION``,
    ``X`` (longitude), ``Y`` (latitude); text or numbers.
    """
    nearest = nearest_site(points, stations, point_id="DR_NO", point_lat="LAT", point_lon="LON",
                           site_id="DIVISION", site_lat="Y", site_lon="X",
                           coord_kind=coord_kind, drop_zero_sites=drop_zero_sites, **search)
    return _summary(nearest)


def station_load_sql(spark: SparkSession, points: DataFrame, stations: DataFrame,
                     coord_type: str = "DOUBLE") -> DataFrame:
    """SQL form: the inputs, the pick per incident number and the summary are SQL.

    The search between incidents and stations is the operator, one row per
    incident row; views only exist while a statement is analysed.
    """
    if coord_type not in ("DOUBLE", "FLOAT"):
        raise ValueError("coord_type must be DOUBLE or FLOAT")
    located = spark.sql(f"""
        SELECT * FROM (SELECT DR_NO, try_cast(LAT AS {coord_type}) AS LAT, try_cast(LON AS {coord_type}) AS LON
                       FROM {{points}})
        WHERE LAT <> 0 AND LON <> 0
    """, points=points)
    nearest = nearest_site(located, stations, point_id="DR_NO", point_lat="LAT", point_lon="LON",
                           site_id="DIVISION", site_lat="Y", site_lon="X", coord_kind=coord_type.lower(),
                           drop_zero_sites=True, per_point_id=False)
    closest = spark.sql("""
        SELECT pick.DIVISION, pick.distance
        FROM (SELECT min(struct(distance, DIVISION)) AS pick FROM {nearest} GROUP BY DR_NO)
    """, nearest=nearest)
    return spark.sql("SELECT * FROM {means} ORDER BY num_of_crimes DESC, DIVISION", means=exact_mean(
        closest, ["DIVISION"], "distance", "average_distance", "num_of_crimes"))
