import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from beatwise.functions.columns import haversine_km
from beatwise.operators import (
    explode_features, flatten_properties, join_by_key, nearest_site, share_of_total, top_k_per_group,
)
from beatwise.operators import exact, nearest
from tests.conftest import plan_text


def test_share_of_total_sums_to_100(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 1), ("c", 4)], "k string, n long")
    for bounded in (True, False):
        rows = share_of_total(counts, "n", bounded=bounded).collect()
        assert sum(r["percentage"] for r in rows) == pytest.approx(100.0)
        assert {r["k"]: r["percentage"] for r in rows}["b"] == pytest.approx(12.5)


def test_top_k_with_ties_uses_last_key(spark):
    df = spark.createDataFrame([(1, m, c) for m, c in [(1, 5), (2, 5), (3, 4), (4, 4)]],
                               "year int, month int, total long")
    got = top_k_per_group(df, ["year"], [F.col("total").desc(), F.col("month").asc()], 3).orderBy("ranking")
    assert [(r.month, r.ranking) for r in got.collect()] == [(1, 1), (2, 2), (3, 3)]


def test_top_k_plans_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").alias("v"))
    out = top_k_per_group(df, ["g"], [F.col("v").desc()], 2)
    assert out.count() == 14
    assert "WindowGroupLimit" in plan_text(out)


def test_flatten_properties(spark):
    docs = spark.createDataFrame(
        [([("Feature", ("90001", 10, 4), ("Point",)), ("Feature", ("90002", 30, None), ("Point",))],)],
        "features array<struct<type:string, properties:struct<ZCTA20:string, POP20:long, HOUSING20:long>,"
        " geometry:struct<type:string>>>")
    flat = flatten_properties(explode_features(docs), "properties")
    assert flat.columns == ["ZCTA20", "POP20", "HOUSING20"]
    assert sorted(tuple(r) for r in flat.collect()) == [("90001", 10, 4), ("90002", 30, None)]


@pytest.mark.parametrize("strategy,node", [
    ("merge", "SortMergeJoin"), ("shuffle_hash", "ShuffledHashJoin"), ("broadcast", "BroadcastHashJoin"),
])
def test_join_strategies(spark, strategy, node):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(100).select(F.col("id").cast("string").alias("a"), F.col("id").alias("v"))
        right = spark.range(50).select(F.col("id").cast("string").alias("b"))
        out = join_by_key(left.groupBy("a").agg(F.sum("v").alias("v")), right, "a", "b", strategy)
        assert out.count() == 50
        assert node in plan_text(out)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_join_strategy_rejects_nested_loop(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        join_by_key(df, df, "id", "id", "shuffle_replicate_nl")


# ---------------------------------------------------------------- nearest site

def _hav(lat1, lon1, lat2, lon2):
    p1, l1, p2, l2 = map(math.radians, (lat1, lon1, lat2, lon2))
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(a)))


def _brute(points, sites):
    best = {}
    for pid, lat, lon in points:
        for sid, slat, slon in sites:
            cand = (_hav(lat, lon, slat, slon), sid)
            if pid not in best or cand < best[pid]:
                best[pid] = cand
    return best


def _run(spark, points, sites, **kw):
    p = spark.createDataFrame(points, "DR_NO long, LAT double, LON double")
    s = spark.createDataFrame(sites, "DIVISION string, Y double, X double")
    out = nearest_site(p, s, point_id="DR_NO", point_lat="LAT", point_lon="LON",
                       site_id="DIVISION", site_lat="Y", site_lon="X", **kw)
    return {r.DR_NO: (r.distance, r.DIVISION) for r in out.collect()}


def _check(got, want):
    assert set(got) == set(want)
    for k, (d, sid) in want.items():
        assert got[k][1] == sid, (k, got[k], want[k])
        assert got[k][0] == pytest.approx(d, rel=1e-9, abs=1e-9)


LAYOUTS = ["spread", "line", "cluster_far", "single", "global", "dense", "uneven"]


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("leaf", [500, 7])
def test_nearest_matches_brute_force(spark, layout, leaf):
    rnd = random.Random(1000 * LAYOUTS.index(layout) + leaf % 1000)
    points = [(i, 33.7 + rnd.random() * 0.7, -118.7 + rnd.random() * 0.6) for i in range(1, 400)]
    if layout == "spread":
        sites = [(f"s{i:03d}", 33.7 + rnd.random() * 0.7, -118.7 + rnd.random() * 0.6) for i in range(40)]
    elif layout == "line":
        sites = [(f"s{i:03d}", 33.7 + i * 0.0007, -118.7 + i * 0.0006) for i in range(120)]
    elif layout == "cluster_far":
        sites = [(f"s{i:03d}", 40.0 + rnd.random() * 0.01, -74.0 + rnd.random() * 0.01) for i in range(30)]
    elif layout == "single":
        sites = [("only", 34.05, -118.25)]
    elif layout == "dense":
        # Sites a few metres apart, points among them: the smallest cells.
        sites = [(f"s{i:03d}", 34.0 + rnd.random() * 1e-4, -118.0 + rnd.random() * 1e-4) for i in range(80)]
        points = [(i, 34.0 + rnd.random() * 1.2e-4, -118.0 + rnd.random() * 1.2e-4) for i in range(1, 300)]
    elif layout == "uneven":
        # As many sites over the globe as in one city, and points in both.
        sites = [(f"g{i:03d}", rnd.uniform(-89, 89), rnd.uniform(-179, 179)) for i in range(80)]
        sites += [(f"c{i:03d}", 34.0 + rnd.random() * 0.01, -118.0 + rnd.random() * 0.01) for i in range(80)]
        points += [(1000 + i, 34.0 + rnd.random() * 0.01, -118.0 + rnd.random() * 0.01) for i in range(200)]
    else:
        sites = [(f"s{i:03d}", rnd.uniform(-89, 89), rnd.uniform(-179, 179)) for i in range(60)]
        points += [(1000 + i, rnd.uniform(-89, 89), rnd.uniform(-179, 179)) for i in range(200)]
    _check(_run(spark, points, sites, leaf_sites=leaf), _brute(points, sites))


def test_nearest_skips_bad_coordinates(spark):
    p = spark.createDataFrame([(1, "34.0", "-118.0"), (2, None, "-118.0"), (3, "0", "-118.0"),
                               (4, "abc", "-118.0"), (5, "34.1", "0")], "DR_NO long, LAT string, LON string")
    s = spark.createDataFrame([("A", "34.0", "-118.0")], "DIVISION string, Y string, X string")
    out = nearest_site(p, s, point_id="DR_NO", point_lat="LAT", point_lon="LON",
                       site_id="DIVISION", site_lat="Y", site_lon="X")
    assert [r.DR_NO for r in out.collect()] == [1]


def test_nearest_repeated_id_keeps_closest_pair(spark):
    got = _run(spark, [(7, 34.0, -118.0), (7, 34.3, -118.3), (None, 34.1, -118.1), (None, 34.2, -118.2)],
               [("A", 34.0, -118.01), ("B", 34.3, -118.3)])
    assert set(got) == {7, None}
    assert got[7][1] == "B" and got[7][0] == pytest.approx(0.0)


def test_nearest_tie_goes_to_smaller_site(spark):
    # Two sites at the same spot are exactly equally far from every point.
    got = _run(spark, [(1, 34.0, -118.0), (2, 34.5, -118.5)],
               [("Z", 34.1, -118.1), ("A", 34.1, -118.1), ("M", 34.3, -118.0)])
    assert got[1][1] == "A"


def test_nearest_without_sites_is_empty(spark):
    assert _run(spark, [(1, 34.0, -118.0)], []) == {}


def test_nearest_without_points_is_empty(spark):
    assert _run(spark, [], [("A", 34.0, -118.0)]) == {}
    assert _run(spark, [(1, 0.0, 0.0)], [("A", 34.0, -118.0)]) == {}


@pytest.mark.parametrize("few", [32, 0])
def test_nearest_keeps_repeated_points(spark, few):
    p = spark.createDataFrame([(1, 34.0, -118.0)] * 3 + [(2, 34.2, -118.2)], "DR_NO long, LAT double, LON double")
    s = spark.createDataFrame([("A", 34.0, -118.0), ("B", 34.2, -118.2), ("C", 40.0, -100.0)],
                              "DIVISION string, Y double, X double")
    args = dict(point_id="DR_NO", point_lat="LAT", point_lon="LON", site_id="DIVISION", site_lat="Y", site_lon="X")
    rows = nearest_site(p, s, per_point_id=False, few_sites=few, **args).collect()
    assert sorted((r.DR_NO, r.DIVISION) for r in rows) == [(1, "A")] * 3 + [(2, "B")]
    assert nearest_site(p, s, few_sites=few, **args).count() == 2


@pytest.mark.parametrize("bad", ["NaN", "Infinity", "-Infinity"])
def test_nearest_drops_non_finite_coordinates(spark, bad):
    p = spark.createDataFrame([(1, "34.0", "-118.0"), (2, bad, "-118.0"), (3, "34.0", bad)],
                              "DR_NO long, LAT string, LON string")
    s = spark.createDataFrame([("0", bad, "-118.0"), ("A", "34.0", "-118.1"), ("B", "34.0", bad)],
                              "DIVISION string, Y string, X string")
    out = nearest_site(p, s, point_id="DR_NO", point_lat="LAT", point_lon="LON",
                       site_id="DIVISION", site_lat="Y", site_lon="X")
    assert [(r.DR_NO, r.DIVISION) for r in out.collect()] == [(1, "A")]


def test_nearest_many_sites_at_one_place(spark):
    got = _run(spark, [(1, 34.0, -118.0), (2, 35.0, -118.0)],
               [(f"s{i:04d}", 34.0, -118.0) for i in range(300)] + [("far", 35.0, -118.0)], few_sites=0)
    assert got[1][1] == "s0000" and got[2][1] == "far"


def test_nearest_of_sites_that_no_cell_parts(spark):
    """More sites within a metre than a candidate array holds."""
    rnd = random.Random(8)
    sites = [(f"s{i:03d}", 34.0 + rnd.random() * 1e-6, -118.0 + rnd.random() * 1e-6) for i in range(60)]
    points = [(i, 34.0 + rnd.random() * 2e-6, -118.0 + rnd.random() * 2e-6) for i in range(50)] + [(99, 10.0, 10.0)]
    _check(_run(spark, points, sites, leaf_sites=5), _brute(points, sites))


def test_nearest_with_hot_cells(spark, monkeypatch):
    monkeypatch.setattr(nearest, "HOT_POINTS", 20)
    rnd = random.Random(9)
    sites = [(f"s{i:03d}", 33.7 + rnd.random() * 0.7, -118.7 + rnd.random() * 0.6) for i in range(150)]
    points = [(i, 34.0, -118.5) for i in range(500)] + [(1000 + i, 33.7 + rnd.random(), -118.7 + rnd.random()) for i in range(100)]
    _check(_run(spark, points, sites, leaf_sites=8), _brute(points, sites))


def _sites_met(spark, monkeypatch, n):
    """Mean number of sites that a point measures itself against, among ``n``, and the pairs of cells looked at."""
    met, pairs, write = [], [], nearest.write_staged

    def staged(df, name):
        out = write(df, name)
        if name == "pairs":
            pairs.append(out.count())
        return out

    def measured(points, done, *rest):
        at = points.groupBy(nearest.cell_at(rest[1]).alias("p")).count()
        left = done.select("p", "left").distinct()
        met.extend((r["count"], r["left"]) for r in at.join(left, "p").collect())
        return real(points, done, *rest)

    real = nearest._measured
    with monkeypatch.context() as m:
        m.setattr(nearest, "write_staged", staged)
        m.setattr(nearest, "_measured", measured)
        p = spark.range(1, 2000).select(F.col("id").alias("DR_NO"), (33.7 + F.rand(1) * 0.7).alias("LAT"), (-118.7 + F.rand(2) * 0.6).alias("LON"))
        s = spark.range(n).select(F.col("id").alias("DIVISION"), (33.7 + F.rand(3) * 0.7).alias("Y"), (-118.7 + F.rand(4) * 0.6).alias("X"))
        out = nearest_site(p, s, point_id="DR_NO", point_lat="LAT", point_lon="LON", site_id="DIVISION", site_lat="Y", site_lon="X")
        assert out.count() == 1999
    return sum(a * b for a, b in met) / 1999, sum(pairs)


def test_nearest_work_grows_far_less_than_the_sites(spark, monkeypatch):
    (few, few_pairs), (many, many_pairs) = (_sites_met(spark, monkeypatch, n) for n in (100, 10_000))
    assert few <= 32 and many <= 32  # a hundred times the sites
    assert many_pairs < 20 * few_pairs


def test_nearest_of_few_sites_is_one_lazy_plan_without_a_join(spark):
    p = spark.range(1, 2000).select(F.col("id").alias("DR_NO"), (33.7 + F.rand(1) * 0.7).alias("LAT"),
                                    (-118.7 + F.rand(2) * 0.6).alias("LON"))
    s = spark.range(25).select(F.col("id").cast("string").alias("DIVISION"), (33.7 + F.rand(3) * 0.7).alias("Y"),
                               (-118.7 + F.rand(4) * 0.6).alias("X"))
    args = dict(point_id="DR_NO", point_lat="LAT", point_lon="LON", site_id="DIVISION", site_lat="Y", site_lon="X")
    out = nearest_site(p, s, per_point_id=False, **args)
    text = plan_text(out)
    assert "Join" not in text and "FileScan" not in text and "Python" not in text
    assert out.count() == 1999
    # many sites: equi-joins of staged cells, nothing in Python, no pairs of all with all
    text = plan_text(nearest_site(p, s, few_sites=0, leaf_sites=4, **args))
    assert "Join" in text and "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text


# ---------------------------------------------------------------- exact means

def _exact(values):
    return float(sum(map(Fraction, values), Fraction(0)) / len(values)) if values else None


def test_bins_hold_every_double(spark):
    rnd = random.Random(12)
    double = lambda: struct.unpack("<d", rnd.randbytes(8))[0]
    groups = {g: [v for v in (double() for _ in range(6)) if math.isfinite(v) and abs(v) < 1e307] + [2.0 ** g, 0.0] for g in range(-1074, 1000, 3)}
    rows = spark.createDataFrame([(g, v) for g, own in groups.items() for v in own], "g int, v double")
    got = {r["g"]: r["mean"] for r in exact.exact_mean(rows, ["g"], "v", "mean", "n").collect()}
    assert got == {g: _exact(own) for g, own in groups.items()}


def test_exact_mean_is_the_same_in_any_order(spark):
    rnd = random.Random(6)
    rows = [(g, rnd.choice([1, -1]) * rnd.random() * 10.0 ** rnd.randrange(-12, 13)) for g in "abc" for _ in range(3000)]
    rows += [("big", 1e300), ("big", 1.0), ("big", -1e300), ("none", None), ("nan", float("nan")), ("nan", 1.0),
             ("inf", float("inf")), ("inf", 1.0), ("both", float("inf")), ("both", float("-inf")), ("zero", 0.0), ("zero", None),
             ("tiny", 5e-324), ("tiny", 1.5e-323), (None, 2.0)]
    want = {g: _exact([v for h, v in rows if h == g and v is not None]) for g in ("a", "b", "c", "big", "zero", "tiny", None)}
    for parts in (1, 3, 17):
        df = spark.createDataFrame(rows, "g string, v double").repartition(parts)
        got = {r["g"]: r for r in exact.exact_mean(df, ["g"], "v", "mean", "n").collect()}
        assert {g: got[g]["mean"] for g in want} == want
        assert got["none"]["mean"] is None and got["none"]["n"] == 1 and got["zero"]["n"] == 2
        assert math.isnan(got["nan"]["mean"]) and math.isnan(got["both"]["mean"]) and got["inf"]["mean"] == float("inf")


def test_haversine_keeps_nan(spark):
    df = spark.createDataFrame([(float("nan"), 0.0), (0.0, 180.0)], "lat double, lon double")
    a, b = (r[0] for r in df.select(haversine_km(F.lit(0.0), F.lit(0.0), "lat", "lon")).collect())
    assert math.isnan(a) and b == pytest.approx(math.pi * 6371)


def test_broadcast_above_the_limit_is_refused(spark):
    df = spark.range(1000)
    with pytest.raises(ValueError, match="broadcast limit"):
        join_by_key(df, df.select(F.col("id").alias("k")), "id", "k", "broadcast", broadcast_bytes=100)


def test_share_defaults_to_a_scalar_total(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 1)], "k string, n long")
    assert "Window" not in plan_text(share_of_total(counts, "n"))
    assert "Window" in plan_text(share_of_total(counts, "n", bounded=True))
