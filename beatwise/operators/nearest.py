"""Nearest-site assignment by great-circle distance, as joins of cells.

Points and sites live in cells of an octree around the unit sphere.  Level by
level, every point cell keeps the site cells that can hold the nearest site of
any of its points: those whose box is no farther than the closest box is at
most.  Both boxes are the extents of what a cell holds.  The next level joins
the kept pairs with the children of the site cell (pruned by the bound of the
parent) and then of the point cell; work is per pair of cells, not of rows, and
the bound shrinks with the cells, so a point meets few sites however many
there are.  A point cell is done once its site cells hold at most
``leaf_sites`` sites; its points are joined to those as one array.  Chord
lengths only prune, with room for rounding; the distance reported and compared
(ties go to the smaller site id) is the haversine.

Everything that grows is a table: no site reaches the driver but the at most
``leaf_sites`` of a site table that is known to be that small, which travel as
one scalar and need no join; of each level the driver sees two counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatwise.functions.columns import EARTH_RADIUS_KM, to_double, unit_vector
from beatwise.session import write_staged

#: Sites that a point measures itself against, at most (but for sites within metres of each other).
LEAF_SITES = 32
#: Finest level: cells of 2 / 2**20 Earth radii (12 m).  Levels go down by two: 16 children on a surface.
FINEST, STEP = 20, 2
#: Copies of the children of a site cell that many point cells look at.
SALTS = 8
#: Points of a cell above which its points and their candidates are salted, this many points a salt.
HOT_POINTS = 1_000_000
#: Relative and absolute room for rounding in squared chords.
MARGIN, SLACK = 1e-9, 1e-18

_AXES = ("x", "y", "z")


def prepare_points(df: DataFrame, id_col: str, lat_col: str, lon_col: str,
                   coord_kind: str = "double", drop_zero: bool = True) -> DataFrame:
    """``(_id, _lat, _lon)`` without unparsable, null, non-finite and (optionally) zero coordinates.

    ``coord_kind='float'`` rounds the coordinates to single precision first.
    """
    lat = to_double(lat_col, coord_kind).cast("double")
    lon = to_double(lon_col, coord_kind).cast("double")
    out = df.select(F.col(id_col).alias("_id"), lat.alias("_lat"), lon.alias("_lon"))
    # NaN is the largest double in Spark, so this also drops it.
    keep = (F.abs("_lat") < float("inf")) & (F.abs("_lon") < float("inf"))
    if drop_zero:
        keep = keep & (F.col("_lat") != 0) & (F.col("_lon") != 0)
    return out.filter(keep)


def cell_at(level: int) -> Column:
    """Cell of ``(_x, _y, _z)`` at a level: its three grid numbers in one long."""
    grid = lambda a: F.least(F.floor((F.col(f"_{a}") + 1) * 2.0 ** (level - 1)), F.lit(2 ** level - 1)).cast("bigint")
    x, y, z = map(grid, _AXES)
    return F.shiftleft(x, 42).bitwiseOR(F.shiftleft(y, 21)).bitwiseOR(z)


def _on_sphere(df: DataFrame) -> DataFrame:
    x, y, z = unit_vector("_lat", "_lon")
    return df.withColumns({"_x": x, "_y": y, "_z": z})


def _cells(df: DataFrame, level: int, name: str, parent: int | None = None) -> DataFrame:
    """Cells of a level with the extents of their rows: ``name``, ``name_n``, ``name_box`` (and ``name_up``)."""
    box = F.struct(*[f(f"_{a}").alias(f"{a}{end}") for a in _AXES for f, end in ((F.min, "0"), (F.max, "1"))])
    above = [] if parent is None else [cell_at(parent).alias(f"{name}_up")]
    return df.groupBy(cell_at(level).alias(name), *above).agg(F.count(F.lit(1)).alias(f"{name}_n"), box.alias(f"{name}_box"))


def _squares(a: str, b: str, far: bool) -> Column:
    """Square of the least (or, ``far``, the largest) chord between two boxes."""
    total = F.lit(0.0)
    for axis in _AXES:
        ahead = F.col(f"{a}.{axis}{1 if far else 0}") - F.col(f"{b}.{axis}{0 if far else 1}")
        behind = F.col(f"{b}.{axis}{1 if far else 0}") - F.col(f"{a}.{axis}{0 if far else 1}")
        gap = F.greatest(ahead, behind) if far else F.greatest(ahead, behind, F.lit(0.0))
        total = total + gap * gap
    return total


def _kept(pairs: DataFrame) -> DataFrame:
    """Pairs ``(p, p_n, p_box, s, s_n, s_box)`` within the bound of their point cell, with bound and sites left."""
    own = Window.partitionBy("p")
    least = F.min(_squares("p_box", "s_box", far=True)).over(own)
    bounded = pairs.withColumn("bound", least * (1 + MARGIN) + SLACK)
    near = bounded.filter(_squares("p_box", "s_box", far=False) <= F.col("bound"))
    return near.withColumn("left", F.sum("s_n").over(own))


def _first_level(sites: DataFrame) -> int:
    """Finest level at which the sites touch at most two cells along each axis."""
    span = sites.agg(*[(F.max(f"_{a}") - F.min(f"_{a}")).alias(a) for a in _AXES]).first()
    widest = max(span[a] for a in _AXES)
    return min(FINEST, max(0, math.floor(math.log2(2 / widest)))) if widest > 0 else FINEST


def _best(candidates: Column) -> Column:
    """Closest of an array of sites by haversine, as ``struct<d, sid>``.

    In two steps, since inside a function of an array a value that is named
    three times is worked out three times.
    """
    p1, l1 = F.radians("_lat"), F.radians("_lon")

    def half(c: Column) -> Column:
        p2, l2 = F.radians(c["lat"]), F.radians(c["lon"])
        return F.sqrt(F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2), 2))

    halves = F.transform(candidates, lambda c: F.struct(half(c).alias("h"), c["id"].alias("sid")))
    far = lambda x: 2 * EARTH_RADIUS_KM * F.asin(F.least(F.lit(1.0), x["h"]))
    return F.array_min(F.transform(halves, lambda x: F.struct(far(x).alias("d"), x["sid"].alias("sid"))))


def _measured(points: DataFrame, done: DataFrame, sites: DataFrame, level: int, hot: int, leaf_sites: int) -> DataFrame:
    """Points whose cell is in ``done`` (its pairs), each with its closest site.

    ``hot`` is the number of cells with more than ``HOT_POINTS`` points: at
    most the points over that number, so their list may be broadcast.
    """
    places = sites.select(cell_at(level).alias("s"), F.struct(F.col("_lat").alias("lat"), F.col("_lon").alias("lon"),
                                                              F.col("_id").alias("id")).alias("site"))
    # one array a cell; only sites that the finest cells cannot part make more
    parts = F.greatest(F.lit(1), F.ceil(F.col("left") / leaf_sites)) if level == FINEST else F.lit(1)
    salts = (F.floor(F.col("p_n") / HOT_POINTS) + 1).cast("int")
    # left outer: outer joins that keep the array's side small are still split by AQE on the points' side
    rows = done.select("p", "s", parts.cast("int").alias("parts"), salts.alias("salts")).join(places, "s")
    many = rows.groupBy("p", "salts", F.pmod(F.xxhash64("site"), F.col("parts")).alias("part")).agg(
        F.collect_list("site").alias("sites"))
    here = points.withColumn("p", cell_at(level))
    key = ["p"]
    if hot:
        crowded = F.broadcast(done.filter(F.col("p_n") > HOT_POINTS).select("p", salts.alias("deal")).distinct())
        salt = F.pmod(F.xxhash64("_row"), F.coalesce("deal", F.lit(1))).cast("int")
        here = here.join(crowded, "p", "left").withColumn("salt", salt)
        many, key = many.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))), ["p", "salt"]
    best = here.join(many, key).select("_row", "_id", _best(F.col("sites")).alias("_best"))
    if level < FINEST:
        return best
    return best.groupBy("_row", "_id").agg(F.min("_best").alias("_best"))


def _searched(points: DataFrame, sites: DataFrame, leaf_sites: int) -> DataFrame:
    """``(_id, _best)`` of every point, over the levels."""
    spark = points.sparkSession
    points = write_staged(_on_sphere(points).withColumn("_row", F.monotonically_increasing_id()), "points")
    level, parts, pairs = _first_level(sites), [], None
    while True:
        if pairs is None:  # at most two cells along each axis: eight
            top = _cells(sites, level, "s").agg(F.collect_list(F.struct("s", "s_n", "s_box"))).scalar()
            pairs = _cells(points, level, "p").withColumn("_top", top).select("p", "p_n", "p_box", F.inline("_top"))
        kept = write_staged(_kept(pairs), "pairs")
        done = (F.col("left") <= leaf_sites) | F.lit(level >= FINEST)
        open_pairs, hot = kept.agg(F.count_if(~done), F.count_if(done & (F.col("p_n") > HOT_POINTS))).first()
        parts.append(_measured(points, kept.filter(done), sites, level, hot, leaf_sites))
        if not open_pairs:
            break
        rest = kept.filter(~done)
        points = write_staged(points.withColumn("p", cell_at(level)).join(
            rest.select("p").distinct(), "p", "left_semi").drop("p"), "points")
        below = min(FINEST, level + STEP)
        salt = lambda c: F.pmod(F.xxhash64(c), F.lit(SALTS)).cast("int")
        children = _cells(sites, below, "c", level).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        asks = rest.select("p", "p_box", "bound", F.col("s").alias("c_up"), salt("p").alias("salt"))
        closer = asks.join(children, ["c_up", "salt"]).filter(_squares("p_box", "c_box", far=False) <= F.col("bound"))
        closer = closer.select(F.col("p").alias("p_up"), F.col("c").alias("s"), F.col("c_n").alias("s_n"),
                               F.col("c_box").alias("s_box"))
        pairs = _cells(points, below, "p", level).join(closer, "p_up").drop("p_up")
        level = below
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.select("_id", "_best")


def nearest_site(points: DataFrame, sites: DataFrame, *,
                 point_id: str, point_lat: str, point_lon: str,
                 site_id: str, site_lat: str, site_lon: str,
                 coord_kind: str = "double", drop_zero_sites: bool = False,
                 per_point_id: bool = True, leaf_sites: int = LEAF_SITES, few_sites: int | None = None,
                 distance_col: str = "distance") -> DataFrame:
    """Closest site of every point by great-circle distance (km).

    Returns ``(point_id, site_id, distance_col)``.  With ``per_point_id``
    there is one row per distinct point id (a repeated id keeps its closest
    point/site pair; all null ids count as one id); otherwise one row per
    point row, repeated ones included.  Points with null, unparsable,
    non-finite or zero coordinates are skipped; sites too, but zero ones only
    with ``drop_zero_sites``.

    Building runs a small job over the sites.  A table of at most
    ``few_sites`` places (by default ``leaf_sites``) is then measured as a
    whole in one lazy plan without a join; above that, building stages the
    points and walks down the levels.
    """
    if leaf_sites < 1:
        raise ValueError("leaf_sites must be positive")
    found = prepare_points(points, point_id, point_lat, point_lon, coord_kind, True)
    located = prepare_points(sites, site_id, site_lat, site_lon, coord_kind, drop_zero_sites)
    # of sites at one place only the smallest id can be the answer
    places = located.groupBy("_lat", "_lon").agg(F.min("_id").alias("_id"))
    few = leaf_sites if few_sites is None else few_sites
    seen = places.limit(few + 1).count()
    if seen <= few:
        listed = places.agg(F.collect_list(F.struct(F.col("_lat").alias("lat"), F.col("_lon").alias("lon"),
                                                    F.col("_id").alias("id")))).scalar()
        found = (found if seen else found.limit(0)).withColumn("_sites", listed)
        rows = found.select("_id", _best(F.col("_sites")).alias("_best"))
    else:
        rows = _searched(found, write_staged(_on_sphere(places), "sites"), leaf_sites)
    if per_point_id:
        rows = rows.groupBy("_id").agg(F.min("_best").alias("_best"))
    return rows.select(F.col("_id").alias(point_id), F.col("_best.sid").alias(site_id),
                       F.col("_best.d").alias(distance_col))
